"""Left joins that stay balanced when one key holds much of the right side."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What one task may hold of a key. A key with more rows is cut into pieces of this size, at any size of the table.
ROWS_PER_TASK = 1_000_000
# Lists up to this length are literals and broadcast; longer ones stay a DataFrame.
MAX_LISTED = 1000
# Left rows of the listed keys up to this number are broadcast; more of them visit the pieces of the right side.
BROADCAST_ROWS = 100_000
# Broadcast left rows of a key that come out together, for one right row after the other.
_TILE = 256
# Hash buckets for each task's worth of rows, when the buckets without a hot key are ruled out.
_BUCKETS = 64
_MAX_TASKS = 1000
# From so many keys on, and up to so many, rows are sieved by hashed bits of the keys before they meet the keys themselves.
SIEVE_FROM, _SIEVE_TO = 50_000, 50_000_000
_WORDS = 16

HotKeys = DataFrame | list[tuple[object, int]]


def hot_keys(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> HotKeys:
    """Keys with more rows than a task should hold, and in how many pieces to cut each.

    Measure the right side of the join itself. The counts are exact. First rows are counted by buckets of hashed keys, which
    combine before the shuffle: a key with too many rows is in a bucket with too many, and only the keys of such buckets are
    counted, and moved. A table of no more than ``rows_per_task`` rows has no such key, and its size is in the file footers.
    """
    rows = df.count()
    if rows <= rows_per_task:
        return []
    keyed = df.filter(F.col(key).isNotNull()).select(key)
    buckets = _BUCKETS * -(-rows // rows_per_task)
    if buckets <= rows // _BUCKETS:  # else there are nearly as many buckets as keys
        bucket = F.pmod(F.xxhash64(key), F.lit(buckets))
        full = keyed.groupBy(bucket.alias("bucket")).count().filter(F.col("count") > rows_per_task).select("bucket")
        found = [r[0] for r in full.limit(MAX_LISTED + 1).collect()]
        if not found:
            return []
        if len(found) <= MAX_LISTED:
            keyed = keyed.filter(bucket.isin(found))
    pieces = F.ceil(F.count("*") / F.lit(rows_per_task)).cast("int").alias("pieces")
    counted = keyed.groupBy(key).agg(pieces).filter("pieces > 1")
    few = counted.limit(MAX_LISTED + 1).collect()
    return counted if len(few) > MAX_LISTED else [tuple(row) for row in few]


def left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    right_spread: str,
    hot: HotKeys = (),
) -> DataFrame:
    """``left LEFT JOIN right USING (key)``; the right rows of ``hot`` keys are split.

    A hot left side needs no help: AQE cuts its partitions. It cannot cut the
    right side of a left join. Where few left rows have a listed key that the right side holds, these rows are
    broadcast to the right rows of the key, dealt over all tasks by the hash of ``right_spread``. Otherwise the right rows are dealt into
    pieces by that hash and each left row of that key visits
    all pieces; copies that find nothing are dropped. That is exact for any list: keys the right side does
    not hold are taken off the list first, so every key left on it matches in some piece.
    """
    if isinstance(hot, list | tuple):
        if not hot:
            return left.join(right, key, "left")
        if len(hot) > MAX_LISTED:
            raise ValueError(f"more than {MAX_LISTED} hot keys: pass them as a DataFrame")
        spark, short = left.sparkSession, right.select(key).schema.add("_pieces", T.IntegerType())
        listed = F.broadcast(spark.createDataFrame([(k, max(1, n)) for k, n in hot], short))  # at most MAX_LISTED short rows
        held = {r[0] for r in right.join(listed, key, "left_semi").select(key).distinct().collect()}
        if not held:
            return left.join(right, key, "left")
        most: dict[object, int] = {}
        for k, n in hot:
            if k in held:
                most[k] = max(1, n, most.get(k, 1))
        pieces_of = F.broadcast(spark.createDataFrame(list(most.items()), short))
        n = left.join(pieces_of, key, "left_semi").limit(BROADCAST_ROWS + 1).count()
        if n <= BROADCAST_ROWS:
            return _few_left(left, right, key, right_spread, pieces_of, sum(most.values()) * -(-n // _TILE))
    else:
        listed = hot.toDF(key, "_pieces")  # Spark decides by the size it measures
        held = right.join(listed, key, "left_semi").select(key).distinct()
        pieces_of = listed.join(held, key, "left_semi").groupBy(key).agg(F.max("_pieces").alias("_pieces"))
    pieces = F.col("_pieces")
    visits = F.when(pieces.isNotNull(), F.sequence(F.lit(0), pieces - 1)).otherwise(F.array(F.lit(0)))
    dealt = F.coalesce(F.pmod(F.xxhash64(right_spread), pieces).cast("int"), F.lit(0))

    probe = left.join(pieces_of, key, "left").withColumn("_piece", F.explode(visits))
    build = (
        right.join(pieces_of, key, "left")
        .withColumns({"_piece": dealt, "_found": F.lit(True)})
        .drop("_pieces")
    )
    joined = probe.join(build, [key, "_piece"], "left")
    return joined.filter(pieces.isNull() | F.col("_found").isNotNull()).drop("_pieces", "_piece", "_found")


def _few_left(left: DataFrame, right: DataFrame, key: str, right_spread: str, held: DataFrame, pieces: int) -> DataFrame:
    """The join when few left rows have a ``held`` key: neither side's rows of such a key are shuffled in copies or gathered by it.

    The result has the product of a key's rows, so their order decides how much disk it takes. A task goes through its right
    rows once for each tile of left rows: the left rows repeat at short range and the right rows stand in runs, which
    column files store in a fraction of a byte a row. For that a task sorts a copy of its right rows for each tile.
    """
    tasks = max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(pieces, _MAX_TASKS))
    spread = right.join(held, key, "left_semi").repartition(tasks, F.xxhash64(right_spread))
    place = F.row_number().over(Window.partitionBy(key).orderBy(key)) - 1
    tiles = left.join(held, key, "left_semi").withColumn("_tile", F.floor(place / _TILE))  # counted before
    copies = F.broadcast(tiles.select(key, "_tile").distinct()).join(spread, key).sortWithinPartitions(key, "_tile")
    kept = copies.filter(F.monotonically_increasing_id() >= 0)  # always true; without it the optimizer takes the sort away
    found = F.broadcast(tiles).join(kept, [key, "_tile"]).drop("_tile")
    rest = left.join(held, key, "left_anti").join(right.join(held, key, "left_anti"), key, "left")
    return rest.unionByName(found)


def with_key_in(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose key is among ``keys``: a left semi join that shuffles few of the other rows. Keep ``keys`` persisted."""
    sieved = _sieved(rows, keys, key)
    if sieved is None:
        return rows.join(keys, key, "left_semi")
    return sieved.filter("_may").drop("_may").join(keys, key, "left_semi")


def without_key_in(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose key is not among ``keys``: a left anti join, as :func:`with_key_in`."""
    sieved = _sieved(rows, keys, key)
    if sieved is None:
        return rows.join(keys, key, "left_anti")
    rest = sieved.filter("_may").drop("_may").join(keys, key, "left_anti")
    return sieved.filter("not _may").drop("_may").unionByName(rest)


def _sieved(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame | None:
    """The rows with ``_may``, which is true for every key in ``keys`` and for one in sixteen others at most.

    Sixteen bits or more for a key, in broadcast pages of 1024 bits. None where Spark's own join does as well.
    """
    if rows.schema[key].dataType != keys.schema[key].dataType:
        return None
    n = keys.count()
    if not SIEVE_FROM <= n <= _SIEVE_TO:
        return None
    place = F.xxhash64(key).bitwiseAND(F.lit((1 << (16 * n).bit_length()) - 1))
    page, word = F.shiftright(place, 10), F.shiftright(place, 6).bitwiseAND(F.lit(_WORDS - 1)).cast("int")
    bit = place.bitwiseAND(F.lit(63)).cast("int")
    names = [f"_bits_{i}" for i in range(_WORDS)]
    dealt = keys.select(page.alias("_page"), word.alias("_word"), bit.alias("_bit")).distinct().repartition("_page")
    set_bits = [F.bit_or(F.when(F.col("_word") == i, F.expr("shiftleft(1L, _bit)"))).alias(c) for i, c in enumerate(names)]
    pages = F.broadcast(dealt.groupBy("_page").agg(*set_bits))  # about 3 bytes a key
    may = F.coalesce(F.getbit(F.get(F.array(*names), word), bit) == 1, F.lit(False))
    return rows.withColumn("_page", page).join(pages, "_page", "left").select(*rows.columns, may.alias("_may"))
