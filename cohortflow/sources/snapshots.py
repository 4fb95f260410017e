"""Tables that change together, published in one step.

New partitions are written aside, into a folder of their own generation; a small pointer file then
names, for every table, the generation that holds each of its partitions. Renaming that file into
place is the only switch: a reader, or a crash before it, sees the old set of all tables, afterwards
the new one. Folders that no pointer names are left-overs of failed runs; ``clean`` removes them.

A pointer has one entry a partition and is read by the driver. A read names the partitions it wants,
so only their folders are listed. Two writers cannot publish the same version: the second one fails
and starts again from the new state. The file system must rename atomically (HDFS, POSIX).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cohortflow.session import clustered, remove_path, rename_new

POINTERS = "_snapshots"
GENERATION = "_generation"
WHOLE = ""  # the one partition of an unpartitioned table
NULL_PART = "__HIVE_DEFAULT_PARTITION__"


class ConcurrentRefreshError(RuntimeError):
    pass


def part_name(value) -> str:
    """A partition value as its folder name has it (dates and integers)."""
    return NULL_PART if value is None else str(value)


class Snapshot:
    """One published state: reads never change under it."""

    def __init__(self, store: "SnapshotStore", version: int, tables: dict, meta: dict):
        self.store, self.version, self.tables, self.meta = store, version, tables, meta
        #: partitions opened by ``read``, by table
        self.opened: dict[str, int] = {}

    def parts(self, table: str) -> list[str]:
        return sorted(self.tables.get(table, {}).get("parts", {}))

    def read(self, table: str, schema: T.StructType | None = None, parts: Sequence | None = None) -> DataFrame:
        """The table, or only the named partitions of it; without rows it has ``schema``."""
        spark, entry = self.store.spark, self.tables.get(table)
        if entry is None:
            if schema is None:
                raise KeyError(f"no table {table} in {self.store.root}")
            return spark.createDataFrame([], schema)
        whole = T.StructType.fromJson(entry["schema"])
        wanted = entry["parts"] if parts is None else {p: g for p in map(part_name, parts) if (g := entry["parts"].get(p))}
        self.opened[table] = self.opened.get(table, 0) + len(wanted)
        if not wanted:
            return spark.createDataFrame([], whole)
        base, col = f"{self.store.root}/{table}", entry["part_col"]
        paths = [f"{base}/{GENERATION}={g}" + (f"/{col}={p}" if col else "") for p, g in sorted(wanted.items())]
        read_as = T.StructType([*whole.fields, T.StructField(GENERATION, T.StringType())])
        return spark.read.schema(read_as).option("basePath", base).parquet(*paths).select(*whole.fieldNames())


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # -- pointer files ------------------------------------------------------------
    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name)

    def _fs(self):
        return self._path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        folder = self._path(f"{self.root}/{POINTERS}")
        fs = self._fs()
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("_"))

    def current(self) -> Snapshot:
        known = self.versions()
        if not known:
            return Snapshot(self, 0, {}, {})
        return Snapshot(self, known[-1], **self._pointer(known[-1]))

    def _pointer(self, version: int) -> dict:
        lines = self.spark.read.text(f"{self.root}/{POINTERS}/{version:08d}.json", wholetext=True).collect()
        return json.loads(lines[0][0])

    def _switch(self, version: int, content: dict) -> None:
        """Write the pointer under a hidden name, then rename it; an existing version is never replaced."""
        fs = self._fs()
        folder = f"{self.root}/{POINTERS}"
        draft, final = self._path(f"{folder}/_draft-{uuid.uuid4().hex}.json"), self._path(f"{folder}/{version:08d}.json")
        out = fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
        finally:
            out.close()
        if not rename_new(self.spark, draft.toString(), final.toString()):
            fs.delete(draft, False)
            raise ConcurrentRefreshError(f"version {version} of {self.root} was published by another writer")

    # -- writing --------------------------------------------------------------------
    def refresh(self) -> "Refresh":
        return Refresh(self, self.current())

    def clean(self, keep: int = 2) -> int:
        """Remove all but the last ``keep`` pointers, and the folders that none of those names. Not to be run
        beside a writer, nor beside readers of older states. Returns the number of folders removed."""
        fs, known = self._fs(), self.versions()
        used: dict[str, set] = {}
        for version in known[-keep:]:
            for name, entry in self._pointer(version)["tables"].items():
                col = entry["part_col"]
                used.setdefault(name, set()).update((g, f"{col}={p}" if col else None) for p, g in entry["parts"].items())
        removed = 0
        for version in known[:-keep]:
            fs.delete(self._path(f"{self.root}/{POINTERS}/{version:08d}.json"), False)
        for table in (s.getPath() for s in fs.listStatus(self._path(self.root)) if s.getPath().getName() != POINTERS):
            live = used.get(table.getName(), set())
            for generation in (s.getPath() for s in fs.listStatus(table)):
                name = generation.getName().split("=", 1)[-1]
                if (name, None) in live:
                    continue
                inside = [s.getPath() for s in fs.listStatus(generation) if "=" in s.getPath().getName()]
                dead = [p for p in inside if (name, p.getName()) not in live]
                for p in ([generation] if len(dead) == len(inside) else dead):
                    remove_path(self.spark, p.toString())
                    removed += 1
        return removed


class Refresh:
    """Changes to some partitions of some tables, on top of one snapshot; nothing shows before ``publish``."""

    def __init__(self, store: SnapshotStore, base: Snapshot):
        self.store, self.base = store, base
        self.generation = f"{base.version + 1:08d}-{uuid.uuid4().hex[:8]}"
        self.tables = json.loads(json.dumps(base.tables))
        self.meta = dict(base.meta)
        #: partitions written, by table
        self.written: dict[str, int] = {}

    def replace(self, table: str, df: DataFrame, part_col: str | None = None, parts: Sequence | None = None,
                sort_by: Sequence[str] = ()) -> None:
        """The partitions ``parts`` (all, if None) will hold exactly the rows of ``df``; a named one without rows goes."""
        path = f"{self.store.root}/{table}/{GENERATION}={self.generation}"
        out = df.hint("rebalance", part_col) if part_col else df.coalesce(1)
        if sort_by:
            out = out.sortWithinPartitions(*[c for c in (part_col,) if c], *sort_by)
        writer = out.write.partitionBy(part_col) if part_col else out.write
        writer = clustered(writer, sort_by[0]) if sort_by else writer
        writer.mode("overwrite").parquet(path)
        entry = self.tables.setdefault(table, {"parts": {}, "part_col": part_col})
        entry["schema"] = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields]).jsonValue()
        if part_col is None:
            filled = [WHOLE]
        else:
            names = [s.getPath().getName() for s in self.store._fs().listStatus(self.store._path(path))]
            filled = [n.split("=", 1)[1] for n in names if n.startswith(f"{part_col}=")]
        gone = list(entry["parts"]) if parts is None else map(part_name, parts)
        for part in gone:
            entry["parts"].pop(part, None)
        stray = [] if parts is None else set(filled) - set(map(part_name, parts))
        if stray:
            raise ValueError(f"{table}: rows outside the named partitions: {sorted(stray)[:5]}")
        entry["parts"].update({p: self.generation for p in filled})
        self.written[table] = len(filled)

    def publish(self) -> Snapshot:
        """The switch. Fails if another writer has published since the refresh began."""
        version = self.base.version + 1
        self.store._switch(version, {"tables": self.tables, "meta": self.meta})
        return Snapshot(self.store, version, self.tables, self.meta)
