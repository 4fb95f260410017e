"""The pipeline graph as lazy DataFrames.

raw -> stg_events -> user_day_rollup -+-> int_user_install -> dim_users
                                       +-> activity / revenue
                                       +-> fact (rollup ⋈ install) -> marts

Shuffles before the marts: (1) the dedup exchange on the event key (after a
partial top-1), (2) the user-day rollup exchange (after map-side partial
aggregation), (3) one exchange of user-day rows into user buckets. The install
aggregate and the fact join then read bucketed files without any exchange.
Marts work on cohort x day rows only.

``persist=True`` writes staging (bucketed by event key) and the user-keyed tables (rollup,
install, dimension and fact, bucketed by user) to the shared checkpoint folder
(``spark.checkpoint.dir``) and re-reads them: lineage is cut there, an executor
loss later re-reads files instead of re-running the dedup, every downstream
table starts from a pruned file scan, and the bucketed rollup feeds the install
aggregate and the fact join without any exchange. The fact is written once, as
the reference's table is, and each mart and check scans it. The row-level
quality checks are counted by these writes. ``close`` deletes the written tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow import constants as C
from cohortflow.operators import daily, marts, quality, spine, staging, users
from cohortflow.session import Scratch, path_bytes
from cohortflow.sources.adapter import adapt_events, adapt_orders
from cohortflow.sources.schema import EVENT_KEY


#: Staged bytes a bucket, and the buckets of a small table.
BUCKET_BYTES, MIN_BUCKETS = 128 << 20, 8


class Pipeline:
    def __init__(self, raw: DataFrame, max_day: int = C.MAX_DAY_NUMBER, trailing: int = C.TRAILING_COHORTS,
                 persist: bool = False, p99: float = C.OUTLIER_PERCENTILE):
        self.raw = raw
        self.spark: SparkSession = raw.sparkSession
        self.max_day = max_day
        self.trailing = trailing
        self.persist = persist
        self.p99 = p99
        self.scratch = Scratch(self.spark)
        self._metrics: dict[str, dict[str, int]] = {}  # row-level checks counted by the writes

    def close(self) -> None:
        """Delete what ``persist`` has written; the pipeline's tables cannot be read afterwards."""
        self.scratch.close()

    @cached_property
    def buckets(self) -> int:
        """Buckets of the user-keyed tables, by the bytes of the written staging table.

        All of them share one number, so that joins on the user stay bucket to bucket. A user-day
        row folds at least one staged event, so a bucket holds ``BUCKET_BYTES`` at most on average.
        """
        self.stg_events  # noqa: B018 - written first
        return max(MIN_BUCKETS, -(-path_bytes(self.spark, self.scratch.path_of["stg_events"]) // BUCKET_BYTES))

    def _bucketed(self, df: DataFrame, name: str, *tables: tuple[str, Column | None]) -> DataFrame:
        if not self.persist:
            return df
        return self.scratch.bucketed(df, name, "user_pseudo_id", self.buckets, self._watch(name, *tables))

    def _watch(self, name: str, *tables: tuple[str, Column | None]) -> dict:
        """Counts to take while ``name`` is written: the row-level checks of the tables that are its rows, or some of them."""
        checks = quality.pipeline_checks(self.max_day)
        self._metrics[name] = {k: v for table, only in tables for k, v in quality.row_metrics(checks, table, only).items()}
        return self._metrics[name]

    @property
    def counted(self) -> dict[str, int]:
        """Violations of row-level checks by check id, as counted while the tables were written."""
        if self.persist:
            self.tables()
        return {check: n for found in self._metrics.values() for check, n in found.items()}

    # -- constructors over the driver tables --------------------------------
    @classmethod
    def from_events(cls, spark: SparkSession, sf_dir: str, **kw) -> "Pipeline":
        return cls(adapt_events(spark, sf_dir), **kw)

    @classmethod
    def from_orders(cls, spark: SparkSession, sf_dir: str, **kw) -> "Pipeline":
        return cls(adapt_orders(spark, sf_dir), **kw)

    # -- staging --------------------------------------------------------------
    @cached_property
    def stg_events(self) -> DataFrame:
        stg = staging.stg_events(self.raw)
        # the dedup's own exchange is on the event key: its partitions become the buckets, so a check or
        # aggregate on that key reads them without shuffling the events again
        return self.scratch.bucketed(stg, "stg_events", EVENT_KEY, None, self._watch("stg_events", ("stg_events", None))) \
            if self.persist else stg

    # -- user / user-day --------------------------------------------------------
    @cached_property
    def rollup(self) -> DataFrame:
        r = daily.user_day_rollup(self.stg_events)
        # user-day rows: a hot user has one row per active day here, so the
        # bucketing exchange is skew-safe.
        return self._bucketed(r, "user_day", ("int_user_daily_activity", None), ("int_user_daily_revenue", F.col("n_purchases") > 0))

    @cached_property
    def int_user_install(self) -> DataFrame:
        inst = users.int_user_install(self.rollup)
        # user grain, bucketed like the rollup: the dimension, the p99 and the
        # fact join all read it without recomputing the first-event aggregate,
        # and the fact join stays a bucket-to-bucket merge join.
        return self._bucketed(inst, "install", ("int_user_install", None))

    @cached_property
    def dim_users(self) -> DataFrame:
        dim = users.dim_users(self.int_user_install, self.p99)
        # written once: the global p99 is evaluated a single time, and every
        # consumer (grids, checks, reports) reads the bucketed dimension
        return self._bucketed(dim, "dim_users", ("dim_users", None))

    @cached_property
    def int_user_daily_activity(self) -> DataFrame:
        return daily.int_user_daily_activity(self.rollup)

    @cached_property
    def int_user_daily_revenue(self) -> DataFrame:
        return daily.int_user_daily_revenue(self.rollup)

    @cached_property
    def fact_enriched(self) -> DataFrame:
        return self._bucketed(daily.fact_enriched(self.rollup, self.int_user_install), "fct_enriched", ("fct_user_daily", None))

    @cached_property
    def fct_user_daily(self) -> DataFrame:
        return daily.fct_user_daily(self.fact_enriched)

    @cached_property
    def day_numbers(self) -> DataFrame:
        return spine.day_numbers(self.spark, self.max_day)

    # -- marts ------------------------------------------------------------------
    def retention(self, slice_cols: Sequence[str] = (), null_label: str | None = None) -> DataFrame:
        return marts.retention_mart(self.dim_users, self.fact_enriched, slice_cols,
                                    self.max_day, self.trailing, null_label)

    def revenue(self, slice_cols: Sequence[str] = (), null_label: str | None = None) -> DataFrame:
        return marts.revenue_mart(self.dim_users, self.fact_enriched, slice_cols,
                                  self.max_day, self.trailing, null_label)

    @cached_property
    def mart_retention_overall(self) -> DataFrame:
        return self._published(self.retention(), "mart_retention_overall")

    @cached_property
    def mart_retention_by_platform(self) -> DataFrame:
        return self._published(self.retention(["install_platform"]), "mart_retention_by_platform")

    @cached_property
    def mart_revenue_overall(self) -> DataFrame:
        return self._published(self.revenue(), "mart_revenue_overall")

    @cached_property
    def mart_revenue_by_platform(self) -> DataFrame:
        return self._published(self.revenue(["install_platform"]), "mart_revenue_by_platform")

    def _published(self, df: DataFrame, name: str) -> DataFrame:
        """Marts are final tables (cohort x day x slice rows): written once so
        every report and check reads the small table instead of rescanning
        the user-day rollup."""
        return self.scratch.table(df, name, self._watch(name, (name, None))) if self.persist else df

    @cached_property
    def report_dates(self) -> DataFrame:
        """One row: the last activity date and the default report cohort, the latest one whose whole
        D0..Dmax window lies in the data. Published beside the marts, so that a report reads no fact."""
        last = self.rollup.agg(F.max("activity_date").alias("max_activity_date"))
        cohorts = self.mart_retention_overall.where("day_number = 0").select("cohort_date")
        full = cohorts.where(F.col("cohort_date") <= F.date_sub(last.scalar(), self.max_day))
        row = last.select(full.agg(F.max("cohort_date")).scalar().alias("selected_cohort"), "max_activity_date")
        return self._published(row, "report_dates")

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in (
            "stg_events", "int_user_install", "int_user_daily_activity", "int_user_daily_revenue",
            "day_numbers", "dim_users", "fct_user_daily", "mart_retention_overall",
            "mart_retention_by_platform", "mart_revenue_overall", "mart_revenue_by_platform")}


def build(spark: SparkSession, raw: DataFrame | None = None, sf_dir: str | None = None,
          max_day: int = C.MAX_DAY_NUMBER, **kw) -> dict[str, DataFrame]:
    """All pipeline tables as lazy DataFrames."""
    pipe = Pipeline(raw, max_day=max_day, **kw) if raw is not None else \
        Pipeline.from_events(spark, sf_dir, max_day=max_day, **kw)
    return pipe.tables()
