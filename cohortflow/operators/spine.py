"""Day spine D0..Dmax (``max_day`` is a parameter, never a literal)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow import constants as C


def day_numbers(spark: SparkSession, max_day: int = C.MAX_DAY_NUMBER) -> DataFrame:
    return spark.range(0, max_day + 1, numPartitions=1).select(F.col("id").cast("int").alias("day_number"))


def day_number_array(max_day: int = C.MAX_DAY_NUMBER) -> Column:
    """The spine as an array literal: densifying with ``explode`` is a
    Generate on each cohort row — no join, no cross product of tables."""
    return F.sequence(F.lit(0), F.lit(max_day))


def published(mart: DataFrame, max_day: int = C.MAX_DAY_NUMBER) -> DataFrame:
    """The spine as the cohorts of a dense mart have it: 0..max_day once each, if all is well.

    A day that some cohort lacks gives a NULL, a day that some cohort holds n times comes n times, and
    a day out of range comes too, so that the spine's checks see a fault in any cohort.
    """
    cells = mart.groupBy("cohort_date", "day_number").agg(F.count(F.lit(1)).alias("_n"))
    days = cells.groupBy("day_number").agg(F.max("_n").alias("_copies"), F.count(F.lit(1)).alias("_cohorts"))
    cohorts = mart.agg(F.count_distinct("cohort_date")).scalar()
    wanted = mart.sparkSession.range(max_day + 1).select(F.col("id").cast("int").alias("_day"))
    found = wanted.join(days, F.col("_day") == F.col("day_number"), "full_outer")
    lacks = F.col("_day").isNotNull() & (F.coalesce("_cohorts", F.lit(0)) < cohorts)
    rows = F.concat(F.when(lacks, F.array(F.lit(None).cast("int"))).otherwise(F.array().cast("array<int>")),
                    F.array_repeat(F.col("day_number").cast("int"), F.coalesce("_copies", F.lit(0)).cast("int")))
    return found.select(F.explode(rows).alias("day_number"))
