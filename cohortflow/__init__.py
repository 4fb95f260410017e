"""cohortflow — Spark-native cohort analytics over a product-event stream.

Raw events (parquet, nested parameter bags) are deduplicated and typed into a
staging table, rolled up into a user dimension and a sparse user-day fact, and
densified into retention / monetization marts by cohort, day number and any
slice. Everything is a lazy DataFrame plan; Catalyst and AQE pick the physical
strategy.
"""

from cohortflow.plans.pipeline import Pipeline, build

__all__ = ["Pipeline", "build"]
