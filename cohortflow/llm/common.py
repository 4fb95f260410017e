"""Helpers shared by the training-data operators: tables, words, landed intermediates."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

import cohortflow
from cohortflow.session import materialize

#: The six ASCII separators that end a word; everything else belongs to one.
SPACES = " \t\n\x0b\x0c\r"
SPLIT = r"[\x20\x09-\x0D]+"
#: Rows and bytes handed to one Arrow batch: bounds a task's memory when texts are long.
ARROW_ROWS, ARROW_BYTES = 1000, 8 << 20
#: Bits of a hash filter (a broadcast of 2 MB, however many hashes it holds), and the tasks that
#: build one; each gives the driver one bit array.
FILTER_BITS, FILTER_TASKS = 24, 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, in order; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPLIT), lambda w: w != F.lit(""))


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def unsigned_hash(*cols: Column, bits: int) -> Column:
    """The top ``bits`` bits of xxhash64 as a non-negative long."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 64 - bits)


def land(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write to the shared folder of ``spark.checkpoint.dir`` and read back (cuts lineage)."""
    return materialize(df, f"llm_{name}", **options)


def packed(df: DataFrame, **keys: Column) -> DataFrame:
    """The row as one struct ``_row`` beside the operator's own columns, so that no name can clash."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"),
                     *[c.alias(name) for name, c in keys.items()])


def unpacked(df: DataFrame, *added: str) -> DataFrame:
    """The row's columns again, and the named new ones (an input column of such a name is replaced)."""
    own = [f.name for f in df.schema["_row"].dataType.fields if f.name not in added]
    return df.select(*[F.col(f"_row.`{c}`") for c in own], *added)


_SHIPPED: set[str] = set()


def python_tasks(spark: SparkSession) -> None:
    """Prepare the session for Python tasks: bounded Arrow batches, so that a batch of long texts or
    whole files fits a worker, and this package on the workers' path, wherever they run."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(cohortflow.__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="cohortflow-")) / "cohortflow.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for file in sorted(package.rglob("*.py")):
                z.write(file, file.relative_to(package.parent))
        context.addPyFile(str(archive.resolve()))  # Spark copies it to every executor
        _SHIPPED.add(context.applicationId)


def gapless(df: DataFrame, group: str, order: list[Column], block_key: Column, rows: int,
            out: str, rows_per_block: int = 50_000) -> DataFrame:
    """Number the rows of each group from 0 without gaps, never a whole group in one task.

    Each group is cut into hash blocks of about ``rows_per_block`` rows. The counts by
    (group, block) give each block's offset; a window numbers the rows of one block.
    ``rows`` is the number of rows of ``df`` divided by the number of groups.
    """
    blocks = max(1, -(-rows // rows_per_block))
    cut = df.withColumn("_block", F.pmod(F.xxhash64(block_key, F.lit("block")), F.lit(blocks)))
    before = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (cut.groupBy(group, "_block").agg(F.count(F.lit(1)).alias("_n"))
               .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    inside = Window.partitionBy(group, "_block").orderBy(*order)
    return (cut.withColumn("_rank", F.row_number().over(inside) - 1)
            .join(offsets, [group, "_block"])
            .withColumn(out, F.col("_rank") + F.col("_offset")).drop("_block", "_rank", "_offset"))


def bit_filter(hashed: DataFrame, col: str) -> np.ndarray:
    """Bit array over the top bits of 64-bit hashes: of fixed size, from a few tasks.

    It lets every listed hash pass and others as often as their bits are taken; a full one only
    stops sparing work.
    """
    python_tasks(hashed.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS, np.bool_)
        for batch in batches:
            bits[np.asarray(batch.column(0)).view(np.uint64) >> np.uint64(64 - FILTER_BITS)] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()], pa.binary())], ["bits"])

    out = np.zeros(1 << FILTER_BITS >> 3, np.uint8)
    for row in hashed.select(col).coalesce(FILTER_TASKS).mapInArrow(run, "bits binary").collect():
        out |= np.frombuffer(row["bits"], np.uint8)
    return out


def passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes the filter lets through."""
    top = hashes.astype(np.uint64, copy=False) >> np.uint64(64 - FILTER_BITS)
    return (bits[top >> np.uint64(3)] >> (np.uint8(7) - (top & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
