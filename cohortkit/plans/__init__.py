"""Compositions of operators: cleaning, features, cohort and patient workflows, analyses."""
