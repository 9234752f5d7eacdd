"""Exact Jaccard self-join over word shingles by prefix filters under several global orders.

Two documents link when ``100 * |A & B| >= percent * |A | B|`` for their sets of distinct n-word shingles.

1. One pass hashes every text's shingles. Documents of equal sets are one *node*, named by a digest
   of the set, so copies cost nothing further. Very frequent shingles (at most ``MAX_HEAVY``, found
   by counts that tasks combine first) are put aside.
2. The shingles are dealt by hash range, packed into binary columns; each range counts in how
   many nodes its shingles occur. Those of a single node can be in no overlap and go no further.
3. A node with fewer shared shingles than any partner must have in common with it is out. The others keep their shared
   shingles with a frequency class. Every global order puts rare before frequent; orders differ in how finely they class and in the hash
   that breaks ties. The first ``n - ceil(n * percent / 100) + 1`` shingles under *each* order must meet
   those of any partner.
4. Candidates meet on prefix shingles of the first order, pass length and position filters, must then share prefix
   shingles under each other order, and are verified on the whole sets.
5. A shingle that is in many prefixes would give all pairs of a large group. There, each node is first tried with
   one common leader, that with the most common shingles; once links have joined most of the group, only pairs across the remaining components are tried. No cap: every pair that
   passes the filters is verified or already connected.

Sets are compared by 64-bit hashes of their shingles. Defined results: null and empty text have the empty set, n_shingles 0, and are linked
with nothing; fewer than n words make one shingle; repeated rows are linked copies, each returned; null
doc_ids are ignored when the smallest is chosen; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import hash_runs, mix, random_words, shuffle_width, stored, text_chunks, whole_text, word_runs
from parcelflow.llm.components import components

GROUP_BYTES = 4 << 20  # texts whose shingles are packed together
MAX_HEAVY = 32_768  # broadcast as 8 bytes each
SMALL_LIST = 16  # up to here all pairs of a prefix shingle are tried at once
_HEAVY_CLASS = 255

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row of UTF-8 bytes."""
    starts, ends, rows = word_runs(~_SPACE[data], offsets)
    hashed = hash_runs(_LOWER[data], starts, ends)
    weight = random_words(words, 21)
    with np.errstate(over="ignore"):
        n = len(hashed) - words + 1
        if n > 0:
            total = hashed[:n] * weight[0]
            for i in range(1, words):
                total = total + mix(hashed[i : i + n] + weight[i]) * weight[i]
            total = mix(total)
        bounds = np.searchsorted(rows, np.arange(len(offsets)))
        sets = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if b - a >= words:
                sets.append(np.unique(total[a : b - words + 1]))
            elif b > a:
                short = np.uint64(b - a) * np.uint64(0x9E3779B97F4A7C15)
                for i in range(b - a):
                    short = mix(short + hashed[a + i : a + i + 1] * weight[i])
                sets.append(short)
            else:
                sets.append(np.zeros(0, np.uint64))
    return sets


def _digest(tokens: np.ndarray) -> int:
    """Names a set: the mixed sum of its mixed members and its size."""
    with np.errstate(over="ignore"):
        total = mix(tokens + np.uint64(0x632BE59BD9B4E019)).sum(dtype=np.uint64)
        return int(mix(np.array([total + np.uint64(len(tokens))], np.uint64)).view(np.int64)[0])


def _need(n, percent: int):
    """The least overlap that a partner of a set of n can have with it."""
    return -(-n * percent // 100)


def _groups(batches: Iterator[pa.RecordBatch], words: int):
    """(first row, batch, sets) for about GROUP_BYTES of text at a time."""
    for batch in batches:
        for first, end, data, offsets in text_chunks(batch["text"], GROUP_BYTES):
            sets: list[np.ndarray] = []
            for at in range(0, len(offsets) - 1, 256):
                part = offsets[at : at + 257]
                sets.extend(shingle_sets(data[part[0] : part[-1]], part - part[0], words))
            yield batch.slice(first, end - first), sets


def _members(docs: DataFrame, words: int) -> DataFrame:
    """Per document (doc_id, n, node); beside them, per task, shingles frequent there (token, n)."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("token", pa.int64())])

    def scan(batches):
        for rows, sets in _groups(batches, words):
            nodes = [_digest(s) if len(s) else None for s in sets]
            sizes = pa.array([len(s) for s in sets], pa.int64())
            none = pa.nulls(len(rows), pa.int64())
            yield pa.RecordBatch.from_arrays([rows["doc_id"], sizes, pa.array(nodes, pa.int64()), none], schema=schema)
            distinct = list({n: s for n, s in zip(nodes, sets, strict=True) if n is not None}.values())
            if len(distinct) < 8:
                continue
            tokens = np.sort(np.concatenate(distinct))
            cut = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1], [True]]))
            counts = np.diff(cut)
            often = counts >= max(8, len(distinct) // 64)
            found = tokens[cut[:-1][often]].view(np.int64)
            none = pa.nulls(len(found), pa.int64())
            yield pa.RecordBatch.from_arrays([none, pa.array(counts[often], pa.int64()), none, pa.array(found)], schema=schema)

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(scan, "doc_id long, n long, node long, token long")


_PACKED = "dest int, kind int, tokens binary, classes binary, nodes binary, counts binary"
_PACKED_ARROW = pa.schema(
    [("dest", pa.int32()), ("kind", pa.int32()), *((c, pa.binary()) for c in ("tokens", "classes", "nodes", "counts"))]
)


def _pack(dest: np.ndarray, kind: int, tokens, classes, nodes) -> Iterator[pa.RecordBatch]:
    """One row per destination: tokens ordered by node, each node once with its count of tokens."""
    order = np.lexsort((nodes, dest))
    dest, tokens, nodes = dest[order], tokens[order], nodes[order]
    classes = classes[order] if classes is not None else None
    cut = np.flatnonzero(np.concatenate([[True], dest[1:] != dest[:-1], [True]])) if len(dest) else np.zeros(1, int)
    out: dict[str, list] = {name: [] for name in _PACKED_ARROW.names}
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        new = np.concatenate([[True], nodes[a + 1 : b] != nodes[a : b - 1]])
        at = np.flatnonzero(new)
        out["dest"].append(int(dest[a]))
        out["kind"].append(kind)
        out["tokens"].append(tokens[a:b].tobytes())
        out["classes"].append(classes[a:b].tobytes() if classes is not None else None)
        out["nodes"].append(nodes[a:b][at].tobytes())
        out["counts"].append(np.diff(np.append(at, b - a)).astype(np.uint32).tobytes())
    if out["dest"]:
        yield pa.RecordBatch.from_pydict(out, schema=_PACKED_ARROW)


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    tokens = np.frombuffer(row["tokens"], np.uint64)
    nodes = np.repeat(np.frombuffer(row["nodes"], np.uint64), np.frombuffer(row["counts"], np.uint32))
    classes = np.frombuffer(row["classes"], np.uint8) if row["classes"] is not None else None
    return tokens, nodes, classes


def _dealt(docs: DataFrame, words: int, heavy: np.ndarray, width: int) -> DataFrame:
    """Kind 0: shingles by hash range. Kind 1: heavy shingles, and each node's size, by node."""

    def deal(batches):
        for _, sets in _groups(batches, words):
            distinct = {_digest(s) & (2**64 - 1): s for s in sets if len(s)}
            if not distinct:
                continue
            tokens = np.concatenate(list(distinct.values()))
            names = np.fromiter(distinct, np.uint64, len(distinct))
            sizes = np.fromiter(map(len, distinct.values()), np.int64, len(distinct))
            nodes = np.repeat(names, sizes)
            is_heavy = np.zeros(len(tokens), bool)
            if len(heavy):
                at = np.minimum(np.searchsorted(heavy, tokens), len(heavy) - 1)
                is_heavy = heavy[at] == tokens
            light, light_nodes = tokens[~is_heavy], nodes[~is_heavy]
            yield from _pack(((light >> np.uint64(40)) % np.uint64(width)).astype(np.int32), 0, light, None, light_nodes)
            # a size travels as a pseudo shingle of class 0
            tokens = np.concatenate([tokens[is_heavy], sizes.astype(np.uint64)])
            nodes = np.concatenate([nodes[is_heavy], names])
            classes = np.full(len(tokens), _HEAVY_CLASS, np.uint8)
            classes[len(tokens) - len(sizes) :] = 0
            yield from _pack((nodes % np.uint64(width)).astype(np.int32), 1, tokens, classes, nodes)

    return docs.select(whole_text().alias("text")).mapInArrow(deal, _PACKED)


def _shared(dealt: DataFrame, width: int) -> DataFrame:
    """Per hash range: shingles of two nodes or more with their frequency class, dealt by node."""

    def count(batches):
        light: dict[int, list[dict]] = defaultdict(list)
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            yield from rows.filter(pc.equal(rows["kind"], 1)).to_batches()
            for row in rows.filter(pc.equal(rows["kind"], 0)).to_pylist():
                light[row["dest"]].append(row)
        for dest in list(light):  # a hash range at a time
            yield from count_range([_unpack(row)[:2] for row in light.pop(dest)])

    def count_range(parts):
        tokens, nodes = (np.concatenate([x[i] for x in parts]) for i in (0, 1))
        del parts
        order = np.argsort(tokens)
        tokens, nodes = tokens[order], nodes[order]
        same = tokens[1:] == tokens[:-1]
        kept = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        tokens, nodes = tokens[kept], nodes[kept]
        order = np.lexsort((nodes, tokens))
        tokens, nodes = tokens[order], nodes[order]
        first = np.ones(len(tokens), bool)
        first[1:] = (tokens[1:] != tokens[:-1]) | (nodes[1:] != nodes[:-1])
        tokens, nodes = tokens[first], nodes[first]
        if not len(tokens):
            return
        cut = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1], [True]]))
        often = np.repeat(np.diff(cut), np.diff(cut))
        kept = often > 1
        # frequencies in steps of a sixteenth of a power of two, from 1
        classes = np.minimum(16 * np.log2(often[kept]) - 15, _HEAVY_CLASS - 1).astype(np.uint8)
        tokens, nodes = tokens[kept], nodes[kept]
        yield from _pack((nodes % np.uint64(width)).astype(np.int32), 2, tokens, classes, nodes)

    return dealt.repartition(width, "dest").mapInArrow(count, _PACKED)


_SETS = "node long, n int, tokens binary, classes binary"


def _survivors(shared: DataFrame, percent: int, width: int) -> DataFrame:
    """Nodes with enough shared shingles to have a partner: their size and shared shingles."""
    schema = pa.schema([("node", pa.int64()), ("n", pa.int32()), ("tokens", pa.binary()), ("classes", pa.binary())])

    def gather(batches):
        parts = [_unpack(row) for batch in batches for row in batch.to_pylist()]
        if not parts:
            return
        tokens, nodes, classes = (np.concatenate([p[i] for p in parts]) for i in range(3))
        del parts
        order = np.lexsort((tokens, classes > 0, nodes))  # a node's size comes first
        tokens, nodes, classes = tokens[order], nodes[order], classes[order]
        first = np.ones(len(tokens), bool)
        first[1:] = (tokens[1:] != tokens[:-1]) | (nodes[1:] != nodes[:-1]) | ((classes[1:] > 0) != (classes[:-1] > 0))
        tokens, nodes, classes = tokens[first], nodes[first], classes[first]
        cut = np.flatnonzero(np.concatenate([[True], nodes[1:] != nodes[:-1], [True]]))
        out: dict[str, list] = {name: [] for name in schema.names}
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            n = int(tokens[a])
            if b - a - 1 >= _need(n, percent):
                out["node"].append(int(nodes[a : a + 1].view(np.int64)[0]))
                out["n"].append(n)
                out["tokens"].append(tokens[a + 1 : b].tobytes())
                out["classes"].append(classes[a + 1 : b].tobytes())
        yield pa.RecordBatch.from_pydict(out, schema=schema)

    return shared.repartition(width, "dest").mapInArrow(gather, _SETS)


def _orders(tokens: np.ndarray, classes: np.ndarray):
    """The global orders: position of each shared shingle under each, rare ones first."""
    salt = random_words(2, 31)
    with np.errstate(over="ignore"):
        yield np.lexsort((tokens, classes))
        yield np.lexsort((mix(tokens ^ salt[0]), classes // 32))
        yield np.lexsort((mix(tokens ^ salt[1]), classes == _HEAVY_CLASS))


def _prefix_size(n: int, shared: int, percent: int) -> int:
    """How many shared shingles are in the prefix; those of a single node come first in any order."""
    return n - _need(n, percent) + 1 - (n - shared)


def _postings(sets: DataFrame, percent: int) -> DataFrame:
    """(token, node, n, rest, weight): prefix shingles under the first order; rest shingles follow.

    ``weight`` is how common the node's shingles are on average: of near copies, that of the fewest edits has most.
    """
    schema = pa.schema(
        [("token", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("rest", pa.int32()), ("weight", pa.float64())]
    )

    def post(batches):
        for batch in batches:
            for row in batch.to_pylist():
                tokens, classes = np.frombuffer(row["tokens"], np.uint64), np.frombuffer(row["classes"], np.uint8)
                size = _prefix_size(row["n"], len(tokens), percent)
                prefix = tokens[next(_orders(tokens, classes))[:size]]
                rest = len(tokens) - 1 - np.arange(size, dtype=np.int32)
                columns = [
                    pa.array(prefix.view(np.int64)),
                    pa.array(np.full(size, row["node"], np.int64)),
                    pa.array(np.full(size, row["n"], np.int32)),
                    pa.array(rest),
                    pa.array(np.full(size, classes.sum(dtype=np.int64) / row["n"])),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return sets.mapInArrow(post, "token long, node long, n int, rest int, weight double")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that share prefixes under every order and enough shingles in all."""

    def test(batches):
        for batch in batches:
            linked = []
            for row in batch.to_pylist():
                sides = [
                    (row[f"n_{s}"], np.frombuffer(row[f"t_{s}"], np.uint64), np.frombuffer(row[f"c_{s}"], np.uint8))
                    for s in "ab"
                ]
                prefixes = [
                    [t[o[: _prefix_size(n, len(t), percent)]] for o in _orders(t, c)] for n, t, c in sides
                ]
                meet = all(len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(*prefixes, strict=True))
                if meet:
                    common = len(np.intersect1d(sides[0][1], sides[1][1], assume_unique=True))
                    meet = 100 * common >= percent * (sides[0][0] + sides[1][0] - common)
                linked.append(bool(meet))
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], names=["a", "b"]).filter(pa.array(linked))

    first, second = (sets.toDF(s, f"n_{s}", f"t_{s}", f"c_{s}") for s in "ab")
    return pairs.join(first, "a").join(second, "b").mapInArrow(test, "a long, b long")


def _fits(n_a, n_b, rest_a, rest_b, percent: int):
    """Length and position filters of a pair that meets on a prefix shingle."""
    least = F.ceil((n_a + n_b) * percent / F.lit(100 + percent))
    return (100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)) & (1 + F.least(rest_a, rest_b) >= least)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _links(sets: DataFrame, percent: int) -> DataFrame:
    """(node, label) of all nodes that have a partner."""
    postings = _postings(sets, percent)
    leader = F.max(F.struct("weight", "node", "n", "rest")).alias("leader")
    sizes = postings.groupBy("token").agg(F.count("*").alias("m"), leader).filter("m > 1")
    # written first, here and below: a join with a table, not with an aggregate in place, can be split where a key is hot
    sizes = stored(sizes, "lists", narrow=True)
    postings = stored(postings.join(sizes, "token"), "postings")
    small, large = postings.filter(F.col("m") <= SMALL_LIST), postings.filter(F.col("m") > SMALL_LIST)

    # all pairs of short lists: at most SMALL_LIST rows are collected per shingle
    lists = small.groupBy("token").agg(F.sort_array(F.collect_list(F.struct("node", "n", "rest"))).alias("list"))
    one = lists.select(F.posexplode("list").alias("i", "x"), "list")
    two = one.select("x", F.explode(F.expr("slice(list, i + 2, size(list))")).alias("y"))
    short = two.filter(_fits(F.col("x.n"), F.col("y.n"), F.col("x.rest"), F.col("y.rest"), percent))
    # long lists: every node with the weightiest of the leaders it fits with
    met = large.filter(
        (F.col("node") != F.col("leader.node"))
        & _fits(F.col("n"), F.col("leader.n"), F.col("rest"), F.col("leader.rest"), percent)
    )
    best = met.groupBy("node").agg(F.max(F.struct("leader.weight", "leader.node"))["node"].alias("leader"))
    tried = short.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).union(best.select("leader", "node"))
    tried = stored(_ordered(tried), "pairs", narrow=True)
    links = stored(_verified(tried, sets, percent), "links")
    labels = components(links)

    # long lists again: pairs across components, of which the largest needs none within
    known = large.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    known = stored(known.select("token", "node", "n", "rest", "label"), "labelled")
    largest = known.groupBy("token", "label").agg(F.count("*").alias("k"))
    largest = largest.groupBy("token").agg(
        F.max(F.struct("k", "label"))["label"].alias("main"), F.count("*").alias("labels")
    )
    largest = stored(largest.filter("labels > 1"), "open-lists", narrow=True)
    open_lists = stored(known.join(largest, "token"), "open-postings")
    outside = open_lists.filter("label <> main").select("token", *(F.col(c).alias(f"{c}_a") for c in ("node", "n", "rest", "label")))
    inside = open_lists.select("token", "main", *(F.col(c).alias(f"{c}_b") for c in ("node", "n", "rest", "label")))
    across = outside.join(inside, "token").filter(
        (F.col("label_a") != F.col("label_b"))
        & ((F.col("label_b") == F.col("main")) | (F.col("node_a") < F.col("node_b")))
        & _fits(F.col("n_a"), F.col("n_b"), F.col("rest_a"), F.col("rest_b"), percent)
    )
    more = _ordered(across.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")))
    more = stored(more.join(tried, ["a", "b"], "left_anti"), "pairs", narrow=True)
    if more.isEmpty():
        return labels
    found = stored(_verified(more, sets, percent), "links")
    return components(links.union(found))


def link_documents(docs: DataFrame, words: int = 5, percent: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id): the smallest doc_id reachable by links, for every row."""
    width = shuffle_width(docs.sparkSession)
    scanned = stored(_members(docs, words), "members")
    frequent = scanned.filter("token is not null").groupBy("token").agg(F.sum("n").alias("n"))
    heavy = [r["token"] for r in frequent.orderBy(F.desc("n"), "token").limit(MAX_HEAVY).collect()]
    heavy = np.sort(np.array(heavy, np.int64).view(np.uint64))
    sets = stored(_survivors(_shared(_dealt(docs, words, heavy, width), width), percent, width), "sets")
    labels = _links(sets, percent)
    members = scanned.filter("token is null").join(labels, "node", "left")
    members = members.select("doc_id", "n", F.coalesce("label", "node").alias("label"))
    smallest = stored(members.groupBy("label").agg(F.min("doc_id").alias("smallest")), "smallest", narrow=True)
    return members.join(smallest, "label", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("smallest")).alias("component_id"),
    )
