"""Relational operators of the cohort pipeline (DataFrame in, DataFrame out)."""
