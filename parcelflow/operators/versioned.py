"""Parquet tables whose every change becomes visible at once.

Rows of one commit lie below ``data/load=<commit>/part=<part>``. Nothing there counts until the commit's rows are appended to the
manifest, a small table of (commit, part, what it replaces); that append is one file and one rename. A
job that dies before it leaves the table as it was, its files are in no manifest, and readers that resolved the
table earlier keep the files they read: only ``vacuum`` removes what no commit refers to.

One writer at a time per table. Spark, not this class, guards nothing against a second one.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelflow.schemas import COMPRESSION, create_if_absent, empty_rows

# a row per part written, and one without part that carries the commit's mark, columns and what it was derived from
_MANIFEST = (
    "commit bigint, load string, part bigint, replaces boolean, row_count bigint, key_sum decimal(38,0), "
    "key_sum2 decimal(38,0), mark timestamp, columns string, inputs string"
)
# Commits that may pile up in the manifest before vacuum sums them up.
_MANIFEST_COMMITS = 32


def key_digest(columns: list[str]) -> list[Column]:
    """``key_sum, key_sum2``: a digest of a multiset of keys.

    Sums of two independent 64-bit hashes. Repeated keys add up (an exclusive or would cancel them), and the digests
    of two batches add up to that of both.
    """
    hashes = {"key_sum": F.xxhash64(*columns), "key_sum2": F.xxhash64(F.lit(1), *columns)}
    return [F.sum(h.cast("decimal(20,0)")).cast("decimal(38,0)").alias(name) for name, h in hashes.items()]


@dataclass(frozen=True)
class State:
    """What the manifest says at one moment: a row per part and load, as many as Spark's own file index holds anyway."""

    rows: list[Row]

    @property
    def last(self) -> int:
        """The number of the last commit, 0 before the first."""
        return max((r["commit"] for r in self.rows), default=0)

    @property
    def first(self) -> int:
        return min((r["commit"] for r in self.rows), default=0)

    def told(self, column: str) -> str | None:
        """What the last commit that has it says in a column of the rows without part."""
        found = [(r["commit"], r[column]) for r in self.rows if r["part"] is None and r[column] is not None]
        return max(found)[1] if found else None

    @property
    def schema(self) -> T.StructType | None:
        columns = self.told("columns")
        return None if columns is None else T.StructType.fromJson(json.loads(columns))

    @property
    def inputs(self) -> dict | None:
        inputs = self.told("inputs")
        return None if inputs is None else json.loads(inputs)

    def active(self, at: int | None = None) -> list[Row]:
        """One row for each load of each part that readers see, or saw after commit ``at``."""
        rows = [r for r in self.rows if r["part"] is not None and (at is None or r["commit"] <= at)]
        since: dict[int, int] = {}
        for r in rows:
            if r["replaces"]:
                since[r["part"]] = max(since.get(r["part"], 0), r["commit"])
        kept = {(r["load"], r["part"]): r for r in rows if r["row_count"] > 0 and r["commit"] >= since.get(r["part"], 0)}
        return list(kept.values())

    def crowded(self, loads: int) -> list[int]:
        """Parts that readers put together from more than so many loads."""
        return [part for part, n in Counter(part for _, part in self.folders()).items() if n > loads]

    def folders(self, parts: Iterable[int] | None = None, at: int | None = None) -> list[tuple[str, int]]:
        wanted = None if parts is None else set(parts)
        return [(r["load"], r["part"]) for r in self.active(at) if wanted is None or r["part"] in wanted]

    def gained(self, commit: int) -> int | None:
        """How many rows were added after that commit, None if parts were replaced since."""
        later = [r for r in self.rows if r["part"] is not None and r["commit"] > commit]
        return None if any(r["replaces"] for r in later) else sum(r["row_count"] for r in later)

    def count(self) -> int:
        return sum(r["row_count"] for r in self.active())


class VersionedTable:
    """A table in parts; ``key`` are the columns whose digest the manifest keeps per part.

    Without ``schema`` it is that of the last commit.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType | None = None,
        key: str | list[str] | None = None,
    ):
        self.spark, self.path, self._given = spark, path.rstrip("/"), schema
        self.key = [key] if isinstance(key, str) else key
        create_if_absent(spark, f"{self.path}/manifest", _MANIFEST)

    # --- reading ---------------------------------------------------------

    def manifest(self) -> DataFrame:
        return self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifest")

    def state(self) -> State:
        mark = F.unix_micros("mark").alias("mark")
        return State(self.manifest().withColumn("mark", mark).collect())

    @property
    def schema(self) -> T.StructType:
        return self._given or self._schema(self.state())

    def _schema(self, state: State) -> T.StructType:
        found = self._given or state.schema
        if found is None:
            raise ValueError(f"nothing was written to {self.path} yet")
        return found

    def active(self) -> DataFrame:
        """(part, load, row_count, key_sum, key_sum2) of what readers see now."""
        rows = self.manifest().filter("part is not null")
        since = F.coalesce(F.max(F.when(F.col("replaces"), F.col("commit"))), F.lit(0))
        kept = rows.join(rows.groupBy("part").agg(since.alias("since")), "part")
        kept = kept.filter((F.col("row_count") > 0) & (F.col("commit") >= F.col("since")))
        return kept.select("part", "load", "row_count", "key_sum", "key_sum2").dropDuplicates(["part", "load"])

    def read(self, parts: Iterable[int] | None = None, at: int | None = None) -> DataFrame:
        """The rows as of now, or after commit ``at``; only the folders of these parts are listed and opened."""
        return self.with_part(parts, at).drop("part")

    def with_part(
        self, parts: Iterable[int] | None = None, at: int | None = None, state: State | None = None
    ) -> DataFrame:
        state = state or self.state()
        return self._folders(state.folders(parts, at), state)

    def _folders(self, folders: list[tuple[str, int]], state: State) -> DataFrame:
        paths = [f"{self.path}/data/load={load}/part={part}" for load, part in folders]
        own = self._schema(state).fields
        files = T.StructType([*own, T.StructField("load", T.StringType()), T.StructField("part", T.LongType())])
        if not paths:
            return empty_rows(self.spark, files).drop("load")
        return self.spark.read.schema(files).option("basePath", f"{self.path}/data").parquet(*paths).drop("load")

    def count(self) -> int:
        """From the manifest alone."""
        return self.state().count()

    def mark(self) -> int | None:
        """The greatest committed mark in microseconds, None before the first."""
        return max((r["mark"] for r in self.state().rows if r["mark"] is not None), default=None)

    def changes_since(self, commit: int, key: str | None = None) -> DataFrame | None:
        """Rows with ``added``: how many more of them there are now than after that commit, or fewer.

        Loads that only added rows are read as they are; parts that were replaced are compared with what they held.
        None when the manifest does not go back that far. With ``key`` only that column comes out beside ``added``; rows of
        replaced parts are then compared by it and two 64-bit hashes of the whole row, so that they are not shuffled.
        """
        state = self.state()
        if commit < state.first:
            return None
        later = [r for r in state.rows if r["part"] is not None and r["commit"] > commit]
        replaced = {r["part"] for r in later if r["replaces"]}
        fresh = {(r["load"], r["part"]) for r in later} & set(state.folders())
        added = self._folders([f for f in fresh if f[1] not in replaced], state).drop("part")
        added = added.withColumn("added", F.lit(1).cast("bigint"))
        if not replaced:
            return added
        before = self._folders(state.folders(replaced, commit), state).withColumn("added", F.lit(-1).cast("bigint"))
        after = self._folders(state.folders(replaced), state).withColumn("added", F.lit(1).cast("bigint"))
        columns = self._schema(state).fieldNames()
        both, by = before.unionByName(after), [F.col(c) for c in columns]
        if key is not None:
            row = [*columns, *[F.isnull(c) for c in columns]]  # a hash alone passes over nulls
            by = [F.col(key), F.xxhash64(*row).alias("_row"), F.xxhash64(F.lit(1), *row).alias("_row2")]
        compared = both.groupBy(*by).agg(F.sum("added").alias("added")).filter("added <> 0")
        wanted = [*(columns if key is None else [key]), "added"]
        return added.select(wanted).unionByName(compared.select(wanted))

    def sql(self, columns: list[str]) -> str:
        """A SELECT over the files that shows the current state whenever it runs."""
        manifest = f"parquet.`{self.path}/manifest`"
        return f"""
            SELECT {', '.join(columns)} FROM parquet.`{self.path}/data`
            WHERE (CAST(load AS STRING), CAST(part AS BIGINT)) IN (
                SELECT m.load, m.part FROM {manifest} m
                JOIN (SELECT part, coalesce(max(CASE WHEN replaces THEN commit END), 0) AS since
                      FROM {manifest} GROUP BY part) s ON s.part = m.part
                WHERE m.row_count > 0 AND m.commit >= s.since)"""

    # --- writing ---------------------------------------------------------

    def replace_all(self, rows: DataFrame, only_changed: bool = False) -> None:
        """A full rebuild: readers see the old rows, then the new ones.

        ``only_changed`` needs all columns as ``key``; rows of the same number and digest as those stored are then not committed.
        """
        load = self._write(rows.withColumn("part", F.lit(0).cast("bigint")))
        state = self.state()
        stored = [(r["row_count"], r["key_sum"], r["key_sum2"]) for r in state.active()] if only_changed else []
        if stored and state.schema == self.schema and stored == [tuple(r)[1:] for r in self._written(load).collect()]:
            return
        self._commit(load, [0], state=state)

    def commit(
        self,
        added: DataFrame,
        replaced: list[int] = (),
        mark: int | None = None,
        inputs: dict | None = None,
        state: State | None = None,
    ) -> None:
        """Add rows (with ``part``); in the ``replaced`` parts they take the place of all earlier rows.

        ``state`` is that of the last commit, if it is known already.
        """
        self._commit(self._write(added), list(replaced), mark, inputs, state)

    def _write(self, rows: DataFrame) -> str:
        load = f"n{uuid.uuid4().hex}"
        declared = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]  # a wider type would be unreadable
        rows.select(*declared, "part").write.option("compression", COMPRESSION).partitionBy("part").parquet(f"{self.path}/data/load={load}")
        return load

    def _written(self, load: str) -> DataFrame:
        """(part, row_count, key_sum, key_sum2) of a load."""
        schema = T.StructType([*self.schema.fields, T.StructField("part", T.LongType())])
        written = self.spark.read.schema(schema).parquet(f"{self.path}/data/load={load}")
        none = F.lit(None).cast("decimal(38,0)")
        digest = key_digest(self.key) if self.key else [F.first(none).alias("key_sum"), F.first(none).alias("key_sum2")]
        return written.groupBy("part").agg(F.count("*").alias("row_count"), *digest)

    def _commit(
        self,
        load: str,
        replaced: list[int],
        mark: int | None = None,
        inputs: dict | None = None,
        state: State | None = None,
    ) -> None:
        state = state or self.state()
        rows = self._written(load).withColumn("replaces", F.col("part").isin(replaced) if replaced else F.lit(False))
        # a replaced part may be left without rows, and so without a folder
        extra = [(p, 0, True) for p in replaced] + [(None, 0, False)]
        extra = self.spark.createDataFrame(extra, "part bigint, row_count bigint, replaces boolean")
        rows = rows.unionByName(extra, allowMissingColumns=True)
        last = F.col("part").isNull()
        entry = rows.select(
            F.lit(state.last + 1).cast("bigint").alias("commit"),
            F.lit(load).alias("load"),
            "part",
            "replaces",
            "row_count",
            "key_sum",
            "key_sum2",
            F.when(last, F.timestamp_micros(F.lit(mark).cast("bigint"))).alias("mark"),
            F.when(last, F.lit(self._schema(state).json())).alias("columns"),
            F.when(last, F.lit(None if inputs is None else json.dumps(inputs)).cast("string")).alias("inputs"),
        )
        entry.coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")

    def merge(self, parts: list[int]) -> None:
        """Rewrite parts that consist of many loads as one; their rows stay the same."""
        if parts:
            self.commit(self.with_part(parts).hint("rebalance", "part"), parts)

    def vacuum(self) -> State:
        """Delete what no reader of the current state opens, and sum up a long manifest.

        Returns that state. The folders of replaced parts and of loads that died go. Once the manifest holds many commits, the current state is
        written as one file that says the same, and the earlier files go; no reader may be starting meanwhile.
        """
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        data = hadoop.Path(f"{self.path}/data")
        fs = data.getFileSystem(self.spark._jsc.hadoopConfiguration())
        state = self.state()
        if not fs.exists(data):
            return state
        used: dict[str, set[str]] = defaultdict(set)
        for load, part in state.folders():
            used[f"load={load}"].add(f"part={part}")
        for load in fs.listStatus(data):
            name = load.getPath().getName()
            if name not in used:
                fs.delete(load.getPath(), True)
                continue
            for part in fs.listStatus(load.getPath()):
                if part.isDirectory() and part.getPath().getName() not in used[name]:
                    fs.delete(part.getPath(), True)
        if len({r["commit"] for r in state.rows}) > _MANIFEST_COMMITS:
            self._sum_up(state, hadoop, fs)
        return state

    def _sum_up(self, state: State, hadoop, fs) -> None:
        """One manifest file in place of all: every active load, as of the last commit."""
        folder = hadoop.Path(f"{self.path}/manifest")
        earlier = [status.getPath() for status in fs.listStatus(folder) if status.isFile()]
        last = F.lit(state.last).cast("bigint")
        told = self.manifest().filter("part is null").agg(
            F.max("mark").alias("mark"),
            F.max_by("columns", F.when(F.col("columns").isNotNull(), F.col("commit"))).alias("columns"),
            F.max_by("inputs", F.when(F.col("inputs").isNotNull(), F.col("commit"))).alias("inputs"),
        )
        parts = self.active().withColumns({"replaces": F.lit(True), "commit": last})
        head = told.withColumns({"replaces": F.lit(False), "commit": last})
        rows = parts.unionByName(head, allowMissingColumns=True)
        names = [f.name for f in T.StructType.fromDDL(_MANIFEST)]
        rows.select(*names).coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
        for path in earlier:
            if path.getName().endswith(".parquet"):
                fs.delete(path, False)
