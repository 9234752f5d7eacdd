"""Incremental loads: which raw rows are new, and a keyed upsert into Parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelflow.functions import event_id, offset_block
from parcelflow.functions.keys import BLOCK_BITS
from parcelflow.operators.joins import with_key_in, without_key_in
from parcelflow.operators.positions import bit_pages, with_flags
from parcelflow.operators.versioned import VersionedTable, key_digest
from parcelflow.schemas import MESSAGE_KEY

# Fixed value: the mark of a table without rows.
EMPTY_MARK = "1900-01-01"

# A part that readers put together from more loads than this is rewritten as one.
_MAX_LOADS = 16

# Up to here changed blocks are a literal folder filter, beyond it a join; the rows are the same.
_MAX_BLOCK_FILTER = 2000

# Stored events of such parts are broadcast as a bit each, in up to so many pages of 1024 offsets (some 150 MB).
_BROADCAST_PAGES = 1_000_000


def high_water_mark(df: DataFrame, column: str = "ingested_at") -> int | None:
    """The greatest value of a timestamp column in microseconds, None for no rows."""
    return df.agg(F.unix_micros(F.max(column))).head()[0]


def incremental_filter(df: DataFrame, mark: int | None, column: str = "ingested_at") -> DataFrame:
    """Rows strictly above the mark.

    A literal, so that it reaches the Parquet statistics. Rows that share the
    mark, or became visible late with an older time, are skipped by design; use
    :meth:`IncrementalTable.missing_rows` to get those too.
    """
    limit = F.lit(EMPTY_MARK).cast("timestamp") if mark is None else F.timestamp_micros(F.lit(mark))
    return df.filter(F.col(column) > limit)


class IncrementalTable:
    """A keyed Parquet table in parts that follow from the key.

    The parts of ``event_id`` are offset blocks: an event's key is a function of its offset, so equal
    keys share a block, and a batch touches few blocks. Any other key is dealt into ``buckets`` parts by its hash.
    Every load is one commit: readers see all of it or nothing, and a load that died is simply repeated.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        key: str = "event_id",
        block_bits: int = BLOCK_BITS,
        buckets: int = 64,
    ):
        self.spark, self.key, self.block_bits, self.buckets = spark, key, block_bits, buckets
        self.table = VersionedTable(spark, path, schema, key)
        self._columns = schema.fieldNames()
        self._known: DataFrame | None = None  # pages that the rows found last are looked up in

    def read(self) -> DataFrame:
        return self.table.read()

    def mark(self) -> int | None:
        """High-water mark of the committed loads, None before the first; kept in the manifest."""
        return self.table.mark()

    def load_strict(self, source: DataFrame) -> None:
        """Upsert the source rows above the mark; all of them on the first run."""
        mark = self.mark()
        self.upsert(source if mark is None else incremental_filter(source, mark))

    def load_keyed(self, source: DataFrame) -> None:
        """Insert every source row whose key the table lacks, however late it came."""
        # taken while writing; a task that runs twice cannot change a maximum
        seen = Observation()
        try:
            rows = self._with_part(self.missing_rows(source))
            load = self.table._write(rows.observe(seen, F.unix_micros(F.max("ingested_at")).alias("mark")))
        finally:
            self._forget()
        mark = seen.get["mark"]
        if mark is not None:
            self.table._commit(load, [], mark)

    def tidy(self) -> None:
        """Merge parts of many loads, and delete what no reader of the current state opens.

        Between loads: readers that resolved the table before the last load are done by then.
        """
        self.table.merge(self.table.vacuum().crowded(_MAX_LOADS))

    def missing_rows(self, source: DataFrame) -> DataFrame:
        """Source rows whose key is not in the table.

        Parts whose multisets of keys are the same on both sides, by number and additive digest, hold nothing
        new. The table's side comes from its manifest, the source's from one pass over the key column, which
        moves a row per part and task. Parts the table lacks are taken whole; only
        those that differ are compared key by key: events by the bits of the stored positions, so that no row is moved.
        """
        self._forget()
        digest = ["key_sum", "key_sum2"]
        have = self.table.active().groupBy("part").agg(
            F.sum("row_count").alias("have"), *[F.sum(c).cast("decimal(38,0)").alias(f"have_{c}") for c in digest]
        )
        by_place = F.bool_and(_named_by_place(source)) if self._has_places(source) else F.lit(False)
        want = source.groupBy(self._part(source).alias("part")).agg(
            F.count(F.lit(1)).alias("want"), by_place.alias("by_place"), *key_digest([self.key])
        )
        same = F.col("have").eqNullSafe(F.col("want"))
        for c in digest:
            same = same & F.col(f"have_{c}").eqNullSafe(F.col(c))
        unequal = want.join(have, "part", "left").filter(~same).select("part", F.col("have").isNotNull().alias("partial"), "by_place")
        few = unequal.limit(_MAX_BLOCK_FILTER + 1).collect()
        rows = source.withColumn("_part", self._part(source))
        if len(few) > _MAX_BLOCK_FILTER:
            changed = rows.join(unequal.select(F.col("part").alias("_part")), "_part", "left_semi")
            stored = self.table.with_part().join(unequal.filter("partial").select("part"), "part", "left_semi")
            return changed.drop("_part").join(stored.select(self.key), self.key, "left_anti")
        partial = [r["part"] for r in few if r["partial"]]
        new = rows.filter(F.col("_part").isin([r["part"] for r in few if not r["partial"]])).drop("_part")
        if not partial:
            return new
        known, rest = self.table.read(partial), rows.filter(F.col("_part").isin(partial)).drop("_part")
        unknown = self._not_in_bits(rest, known) if all(r["by_place"] for r in few if r["partial"]) else None
        return new.unionByName(rest.join(known.select(self.key), self.key, "left_anti") if unknown is None else unknown)

    def _has_places(self, source: DataFrame) -> bool:
        return self.key == "event_id" and set(MESSAGE_KEY) <= set(self._columns) & set(source.columns)

    def _not_in_bits(self, rows: DataFrame, known: DataFrame) -> DataFrame | None:
        """The rows, events named by their places, whose event is not among the known; None if those are not all named so, or too many."""
        named = known.select(*MESSAGE_KEY, _named_by_place(known).alias("_stored"))
        self._known = bit_pages(named, MESSAGE_KEY, ["_stored"], F.bool_and("_stored").alias("_named")).persist()
        pages, sound = self._known.agg(F.count(F.lit(1)), F.bool_and("_named")).head()
        if pages > _BROADCAST_PAGES or not sound:
            return None
        return with_flags(rows, self._known, MESSAGE_KEY, ["_stored"]).filter("not _stored").drop("_stored")

    def _forget(self) -> None:
        if self._known is not None:
            self._known.unpersist()
            self._known = None

    def upsert(self, batch: DataFrame) -> None:
        """Replace rows with the batch's keys, insert the others, in one commit.

        Only parts in which a key repeats are rewritten; the others of the batch are added to.
        """
        batch = self._with_part(batch)
        mark, low, high = batch.agg(F.unix_micros(F.max("ingested_at")), F.min("part"), F.max("part")).head()
        if mark is None:
            return
        state = self.table.state()
        near = {part for _, part in state.folders() if low <= part <= high}
        keys = batch.select(self.key)
        stored = self.table.with_part(near, state=state)
        # at most the parts near the batch
        rewritten = [r[0] for r in with_key_in(stored.select(self.key, "part"), keys, self.key).select("part").distinct().collect()] if near else []
        rows = batch
        if rewritten:
            kept = without_key_in(self.table.with_part(rewritten, state=state), keys, self.key)
            # joined rows are spread by key: gather each part into few files again
            rows = kept.unionByName(batch).hint("rebalance", "part")
        self.table.commit(rows, rewritten, mark, state=state)

    def _with_part(self, batch: DataFrame) -> DataFrame:
        return batch.select(*self._columns, self._part(batch).alias("part"))

    def _part(self, df: DataFrame) -> Column:
        if self.key != "event_id":
            return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("bigint")
        if "offset_block" in df.columns:
            return F.col("offset_block").cast("bigint")
        return offset_block(F.col("kafka_offset"), self.block_bits).cast("bigint")


def _named_by_place(events: DataFrame) -> Column:
    """True where the event's id is that of its topic, partition and offset, and of no other place."""
    place = [F.col(c) for c in MESSAGE_KEY[1:]]
    return F.coalesce((F.col("event_id") == event_id()) & (place[0] >= 0) & (place[1] >= 0) & F.col(MESSAGE_KEY[0]).isNotNull(), F.lit(False))


__all__ = ["EMPTY_MARK", "IncrementalTable", "high_water_mark", "incremental_filter"]
