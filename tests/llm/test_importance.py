"""Importance resampling against a plain computation."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from parcelflow.llm import importance
from parcelflow.llm.expected_sql import ORACLE
from parcelflow.llm.queries import QUERIES
from tests.compare import database, difference


def features(text, words):
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return [" ".join(found[i : i + n]) for n in range(1, words + 1) for i in range(len(found) - n + 1)], len(found)


def plain(docs, target, words, buckets, percent, least, seed=2024):
    def bucket(feature):
        return zlib.crc32(feature.encode()) % buckets

    s = Counter(bucket(f) for _, text in docs for f in features(text, words)[0])
    t = Counter(bucket(f) for text in target for f in features(text, words)[0])
    total_s, total_t = sum(s.values()), sum(t.values())
    rows = []
    for doc_id, text in docs:
        found, n = features(text, words)
        gains = [
            math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets))))
            for b in map(bucket, found)
        ]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(found), weight, score, n))
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = [(*r[:4], i + 1) for i, r in enumerate(able[: percent * len(able) // 100])]
    rest = [(*r[:4], None) for r in able[percent * len(able) // 100 :]] + [(*r[:4], None) for r in rows if r[4] < least]
    return Counter(drawn + rest)


def result(documents, spark, docs, target, **how):
    items = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    found = importance.importance_resample(documents(*docs), items, keep=["doc_id", "text", "rank"], **how)
    return Counter((r.kept.doc_id, r.n_features, r.weight, r.score, r.rank) for r in found.collect())


def sample(seed, n):
    rng = random.Random(seed)
    vocabulary = ["Aé", "b", "C3", "übung", "don't", "x-y", "ÀB", "日本", "__", "9"] + [f"w{i}" for i in range(30)]
    texts = [rng.choice([" ", "\n", ", "]).join(rng.choices(vocabulary, k=rng.randrange(12))) for _ in range(n)]
    return [(i if i % 17 else None, t if i % 13 else None) for i, t in enumerate(texts)]


@pytest.mark.parametrize("words,buckets,percent", [(1, 10_000, 10), (3, 500, 50), (2, 100_000, 100)])
def test_equals_plain_computation(spark, documents, words, buckets, percent):
    docs, target = sample(1, 120), ["b C3 w1 w2", None, "", "W1 w2 übung"]
    docs += [docs[5], docs[5], (docs[6][0], "w1 w2 w3 w4 w5"), (7000, "w " * 30_000)]
    got = result(documents, spark, docs, target, words=words, buckets=buckets, percent=percent, min_words=4)
    assert got == plain(docs, target, words, buckets, percent, 4)


def test_spans_overlap_and_keep_to_words():
    scan = importance.bucket_scanner(3, 1 << 31)
    n, found = scan("One,two\tthree - four_five")
    wanted = ["one", "two", "three", "four", "five"]
    assert n == 5
    grams = [" ".join(wanted[i : i + k]) for k in (1, 2, 3) for i in range(6 - k)]
    assert found.tolist() == [zlib.crc32(g.encode()) % (1 << 31) for g in grams]


def test_empty_tables(spark, documents):
    assert not result(documents, spark, [], ["a b"])
    docs = [(1, "a b c"), (2, ""), (3, None)]
    assert result(documents, spark, docs, [], percent=100, min_words=1) == plain(docs, [], 1, 10_000, 100, 1)
    assert result(documents, spark, docs, ["a"], percent=10, min_words=1) == plain(docs, ["a"], 1, 10_000, 10, 1)


def test_query_equals_sql(spark, tables):
    name = "op13_importance_resampling"
    assert difference(QUERIES[name](spark, tables), database(tables), ORACLE[name]) is None
