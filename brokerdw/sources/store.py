"""Tables as lists of immutable Parquet folders.

A commit row names the folders a load adds and which earlier ones stay, so the log grows
with the loads and not with their square. A load writes new folders first and commits
last, so a table can be read while it is being replaced and a lost executor or a failed
job leaves the previous version intact. Replacing only the folder of current rows keeps a
type 2 batch from rewriting history.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brokerdw.operators.hotkeys import stored
from brokerdw.sources.clustering import cluster

_COMMIT = "version BIGINT, parts STRING, flow STRING, fresh BOOLEAN, keep STRING"
# Which folders of the version before a commit keeps: all, none, those with this label, or all but a list of labels.
ALL, NONE, BUT = "*", "", "!"
# Tables laid out by key have a folder a bucket.
BUCKET, BUCKETS = "_bucket", 64


def _keeps(keep: str, label: str) -> bool:
    return label not in json.loads(keep[1:]) if keep.startswith(BUT) else keep in (ALL, label)


class TableStore:
    """Versioned Parquet tables under one root folder that all executors reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._known: dict[str, list] = {}

    # -- commits ------------------------------------------------------------
    def _log(self, name: str) -> str:
        return f"{self.root}/{name}/_log"

    def commits(self, name: str) -> list[Row]:
        """Commit rows of a table, oldest first (one per load); empty if there is none.

        A store object is the only writer of its tables and remembers their commits;
        :meth:`refresh` forgets them.
        """
        if name not in self._known:
            try:
                rows = self.spark.read.schema(_COMMIT).json(self._log(name)).collect()
            except AnalysisException as err:
                if err.getCondition() != "PATH_NOT_FOUND":
                    raise
                rows = []
            self._known[name] = sorted(rows, key=lambda r: r.version)
        return self._known[name]

    def refresh(self) -> None:
        self._known.clear()

    def exists(self, name: str) -> bool:
        return bool(self.commits(name))

    def has_flow(self, name: str, flow: str) -> bool:
        """Whether a load named ``flow`` is part of the table, that is, came after it was last loaded afresh."""
        for row in reversed(self.commits(name)):
            if row.flow == flow:
                return True
            if row.fresh:
                return False
        return False

    def parts(self, name: str) -> list[dict]:
        """The folders of the current version."""
        parts: list[dict] = []
        for row in self.commits(name):
            parts = [p for p in parts if _keeps(row.keep, p["label"])] + json.loads(row.parts)
        return parts

    def commit(self, name: str, parts: list[dict], flow: str = "", keep: str = NONE, fresh: bool = False) -> None:
        """Add folders to a table; ``fresh`` starts it anew, so that loads before count as not done."""
        done = self.commits(name)
        entry = Row(version=len(done) + 1, parts=json.dumps(parts), flow=flow, fresh=fresh, keep=keep)
        row = self.spark.range(1, numPartitions=1).select(*[F.lit(v).alias(k) for k, v in entry.asDict().items()])
        row.write.mode("append").json(self._log(name))
        self._known[name] = [*done, entry]

    # -- data ---------------------------------------------------------------
    def write_part(
        self,
        name: str,
        df: DataFrame,
        label: str = "data",
        partition_by: Sequence[str] = (),
        cluster_by: Sequence[str] = (),
        derived: dict[str, Column] | None = None,
    ) -> dict:
        """Write one folder without committing it."""
        if derived:
            df = df.withColumns(derived)
        if cluster_by:
            df = cluster(df, cluster_by)
        path = f"{self.root}/{name}/part-{uuid.uuid4().hex}"
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        return {"path": path, "label": label, "schema": df.schema.json()}

    def write(
        self,
        name: str,
        df: DataFrame,
        mode: str = "overwrite",
        partition_by: Sequence[str] = (),
        cluster_by: Sequence[str] = (),
        derived: dict[str, Column] | None = None,
        flow: str = "",
        label: str = "data",
    ) -> DataFrame:
        """Load a table: ``overwrite``, ``append``, ``ignore`` (create if absent) or ``error``."""
        before = self.parts(name)
        if before and mode == "ignore":
            return self.read(name)
        if before and mode == "error":
            raise ValueError(f"table {name} exists")
        part = self.write_part(name, df, label, partition_by, cluster_by, derived)
        self.commit(name, [part], flow, ALL if mode == "append" else NONE, fresh=mode != "append")
        return self.read(name)

    def read(self, name: str, label: str | None = None) -> DataFrame:
        """The current version, or only its folders with ``label``."""
        parts = [p for p in self.parts(name) if label is None or p["label"] == label]
        if not parts:
            raise ValueError(f"table {name} has no data")
        return self._union(parts)

    def _union(self, parts: list[dict]) -> DataFrame:
        """Bucket folders of one schema, which hold files only, are one relation."""
        alike: dict[tuple, list[dict]] = {}
        for i, p in enumerate(parts):
            alike.setdefault((p["schema"], -1 if "bucket" in p else i), []).append(p)
        frames = [self._read_part(same[0], *[p["path"] for p in same]) for same in alike.values()]
        out = frames[0]
        for more in frames[1:]:
            out = out.unionByName(more, allowMissingColumns=True)
        return out

    def _read_part(self, part: dict, *paths: str) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(part["schema"]))
        df = self.spark.read.schema(schema).parquet(*(paths or [part["path"]])).select(*schema.fieldNames())
        return df.filter(part["only"]) if "only" in part else df

    def compact(self, name: str, combine: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """Rewrite a table into one folder, optionally through a combining plan."""
        df = self.read(name)
        part = self.write_part(name, combine(df) if combine else df)
        self.commit(name, [part], "compact", NONE)
        return self.read(name)

    def view(self, name: str, df: DataFrame | None = None) -> DataFrame:
        """Register a frame, or the stored table, as a temporary view."""
        out = self.read(name) if df is None else df
        out.createOrReplaceTempView(name)
        return out

    # -- tables laid out by key ---------------------------------------------
    def buckets_of(self, df: DataFrame, keys: Sequence[str], count: int = BUCKETS) -> list[str]:
        """The buckets that hold the keys of ``df``; ``count`` labels at most."""
        found = df.select(_bucket(keys, count).alias("b")).distinct().collect()
        return sorted(str(r["b"]) for r in found)

    def read_buckets(self, name: str, labels: Sequence[str]) -> DataFrame | None:
        """The rows of some buckets; no other folder is opened."""
        parts = [p for p in self.parts(name) if p["label"] in set(labels)]
        return self._union(parts) if parts else None

    def replace_buckets(
        self,
        name: str,
        df: DataFrame,
        keys: Sequence[str],
        labels: Sequence[str],
        flow: str = "",
        count: int = BUCKETS,
        final: Column | None = None,
    ) -> None:
        """Write ``df`` as the new content of the buckets ``labels``; all others stay as they are.

        Rows for which ``final`` holds never change again: they are added to the table beside
        the buckets and not read by later loads. A large bucket is written by several tasks.
        """
        path = f"{self.root}/{name}/part-{uuid.uuid4().hex}"
        df = df if final is None else stored(df, "buckets")
        moving = df if final is None else df.filter(~F.coalesce(final, F.lit(False)))
        moving.withColumn(BUCKET, _bucket(keys, count)).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(path)
        files = self.spark.read.schema(df.schema).parquet(path).inputFiles()
        there = {f.rsplit(f"/{BUCKET}=", 1)[1].split("/")[0] for f in files}
        parts = [{"path": f"{path}/{BUCKET}={b}", "label": b, "schema": df.schema.json(), "bucket": b} for b in sorted(there)]
        if final is not None:
            parts.append(self.write_part(name, df.filter(final), "final"))
        if not parts and not [p for p in self.parts(name) if p["label"] not in labels]:
            parts = [self.write_part(name, df.limit(0), "none")]  # a table without rows has its columns still
        self.commit(name, parts, flow, BUT + json.dumps(list(labels)))

    def update_buckets(
        self,
        name: str,
        source: DataFrame,
        keys: Sequence[str],
        plan: Callable[[DataFrame, DataFrame], DataFrame],
        flow: str = "",
        count: int = BUCKETS,
        final: Column | None = None,
    ) -> DataFrame:
        """Merge a batch: ``plan`` makes the new rows of the buckets of its keys from their rows and the batch.

        Neither the other buckets nor the final rows are read, so a batch's cost follows the
        buckets it touches. A batch that the table has already is left out.
        """
        if not (flow and self.has_flow(name, flow)):
            source = stored(source, "batch")
            labels = self.buckets_of(source, keys, count)
            target = self.read_buckets(name, labels)
            if target is None:
                target = self.spark.createDataFrame([], T.StructType.fromJson(json.loads(self.parts(name)[0]["schema"])))
            self.replace_buckets(name, plan(target, source), keys, labels, flow, count, final)
        return self.read(name)

    # -- tables with a final part -------------------------------------------
    def write_split(
        self, name: str, df: DataFrame, flag: str, final: bool, flow: str = "", keep: str = NONE
    ) -> DataFrame:
        """Write a table once, split by a flag whose value ``final`` marks rows that never change.

        Later loads replace the ``open`` part and only add to the ``final`` ones, so
        their cost follows the open rows and not the history.
        """
        part = self.write_part(name, df, partition_by=[flag])
        yes, no = ("final", "open") if final else ("open", "final")
        split = [{**part, "label": yes, "only": flag}, {**part, "label": no, "only": f"NOT {flag}"}]
        self.commit(name, split, flow, keep, fresh=keep == NONE)
        return self.read(name)

    def merge_split(self, name: str, rows: DataFrame, flag: str, final: bool, flow: str = "") -> DataFrame:
        """Keep all final parts; ``rows`` are the new open rows and those that became final."""
        return self.write_split(name, rows, flag, final, flow, "final")

    def write_scd2(self, name: str, df: DataFrame, flow: str = "") -> DataFrame:
        """First load of a type 2 table; closed versions are final."""
        return self.write_split(name, df, "iscurrent", False, flow)

    def merge_scd2(self, name: str, merged, flow: str = "") -> DataFrame:
        return self.merge_split(name, merged.rows, "iscurrent", False, flow)


def _bucket(keys: Sequence[str], count: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(count)).cast("int")
