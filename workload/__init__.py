"""The operators applied to the given tables, with equivalent SQL."""
