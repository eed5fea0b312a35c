"""Cohort analytics over phenotype and genotype tables, on Spark DataFrames."""

__version__ = "0.1.0"
