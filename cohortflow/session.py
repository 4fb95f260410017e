"""Session helpers: sane defaults for tests/bench, lineage-cutting storage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession

DEFAULT_CHECKPOINT_DIR = "/tmp/cohortflow-checkpoints"


def local_session(cores: int | str = 8, shuffle_partitions: int | None = None,
                  app_name: str = "cohortflow") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("COHORTFLOW_DRIVER_MEMORY", "8g"))
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    event_log = os.environ.get("COHORTFLOW_EVENT_LOG_DIR")
    if event_log:  # stage / task timings without the web UI
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session; a default is set only
    where it is unset (tests / local runs).
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                           "(written tables and checkpoints must survive executor loss)")
    target = conf_dir or DEFAULT_CHECKPOINT_DIR
    spark.sparkContext.setCheckpointDir(target)
    return spark.sparkContext.getCheckpointDir() or target


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """The JVM compiles no method of more than 8,000 bytes; within this, Spark generates no longer ones for a stage
    and splits its expressions instead."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "8000")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shared_scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is on; a missing one is fine."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def rename_new(spark: SparkSession, path: str, to: str) -> bool:
    """Rename to a name that is not taken; False, and nothing done, if it is."""
    jvm = spark._jvm
    source, target = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(to)
    conf = spark._jsc.hadoopConfiguration()
    fs = source.getFileSystem(conf)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(fs.makeQualified(source), fs.makeQualified(target), options)
    except Exception:
        if fs.exists(target):
            return False
        raise
    return True


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path`` (a listing, no job)."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


def swap_in(spark: SparkSession, staged: str, path: str) -> None:
    """Put the finished folder ``staged`` in the place of ``path``.

    The old folder is renamed first and deleted last, so a failure on the way leaves either the
    old or the new table whole under one of the two names.
    """
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    new, here, old = jvm_path(staged), jvm_path(path), jvm_path(f"{path.rstrip('/')}__replaced-{uuid.uuid4().hex[:8]}")
    fs = here.getFileSystem(spark._jsc.hadoopConfiguration())
    had = fs.exists(here)
    if had and not fs.rename(here, old):
        raise OSError(f"cannot set {path} aside")
    if not fs.rename(new, here):
        if had:
            fs.rename(old, here)
        raise OSError(f"cannot move {staged} to {path}")
    if had:
        fs.delete(old, True)


#: Rows a page and bytes a row group of clustered files: a look-up by the cluster column reads a page or two of a file.
PAGE_ROWS, GROUP_BYTES = 5_000, 32 << 20


def clustered(writer: DataFrameWriter, column: str) -> DataFrameWriter:
    """Parquet options for files sorted by ``column``, so that their own statistics skip most of them: row groups
    and pages by smallest and largest value, and by a bloom filter those whose range holds a value that is not there."""
    return (writer.option("parquet.block.size", str(GROUP_BYTES)).option("parquet.page.row.count.limit", str(PAGE_ROWS))
            .option(f"parquet.bloom.filter.enabled#{column}", "true")
            # as large as the values need: sizes from 1 MB down to 2 KB are tried
            .option("parquet.bloom.filter.adaptive.enabled", "true").option(f"parquet.bloom.filter.candidates.number#{column}", "10"))


def _observed(df: DataFrame, metrics: dict[str, Column] | None) -> tuple[DataFrame, Observation | None]:
    if not metrics:
        return df, None
    observation = Observation()
    return df.observe(observation, *[c.alias(f"m{i}") for i, c in enumerate(metrics.values())]), observation


def _collect(observation: Observation | None, metrics: dict | None) -> None:
    """Put the counted values in the place of their expressions."""
    if observation is not None:
        found = observation.get
        for i, name in enumerate(list(metrics)):
            metrics[name] = found[f"m{i}"]


class Scratch:
    """Written intermediates of one run; ``close`` deletes them and their catalog entries.

    ``metrics`` are counted while a table is written (``DataFrame.observe``): no scan of their own.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths, self.tables = spark, [], []
        self.path_of: dict[str, str] = {}  # the last path written under a name

    def _path(self, name: str) -> str:
        path = self.path_of[name] = shared_scratch_path(self.spark, name)
        self.paths.append(path)
        return path

    def table(self, df: DataFrame, name: str, metrics: dict[str, Column] | None = None) -> DataFrame:
        path = self._path(name)
        watched, observation = _observed(df, metrics)
        watched.write.mode("overwrite").parquet(path)
        _collect(observation, metrics)
        return self.spark.read.schema(df.schema).parquet(path)  # no job to read footers

    def bucketed(self, df: DataFrame, name: str, key: str | Sequence[str], buckets: int | None = None,
                 metrics: dict[str, Column] | None = None) -> DataFrame:
        """Write ``df`` bucketed by ``key`` and read it back.

        The re-read scan reports HashPartitioning(key), so every later aggregate or join on
        ``key`` runs without another exchange (co-located buckets). The hash matches
        ``repartition(n, key)``, so each task writes one file per bucket it owns. Without
        ``buckets``, ``df`` must come out of an exchange on ``key``: that exchange's partitions
        are the buckets, and nothing is shuffled for them.
        """
        path, table = self._path(name), f"cohortflow_{name}_{uuid.uuid4().hex[:12]}"
        self.tables.append(table)
        keys = [key] if isinstance(key, str) else list(key)
        spread = df.repartition(buckets, *keys) if buckets else df
        watched, observation = _observed(spread, metrics)
        writer = watched.write.mode("overwrite").bucketBy(buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions")), *keys)
        (writer.sortBy(*keys) if buckets else writer).option("path", path).format("parquet").saveAsTable(table)
        _collect(observation, metrics)
        return self.spark.table(table)

    def close(self) -> None:
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        for path in self.paths:
            remove_path(self.spark, path)
        self.paths, self.tables = [], []

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *exc) -> None:
        self.close()


def materialize(df: DataFrame, name: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Cut lineage by writing ``df`` to the shared folder and reading it back.

    Unlike a local checkpoint, the written files survive executor loss; the
    re-read plan starts from a file scan, so pushdown and pruning still apply.
    """
    spark = df.sparkSession
    path = shared_scratch_path(spark, name)
    df.write.mode("overwrite").format(fmt).options(**options).save(path)
    return spark.read.format(fmt).load(path)
