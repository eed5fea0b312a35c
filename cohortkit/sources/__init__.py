"""Reading and writing tables, uploads and selection logs."""
