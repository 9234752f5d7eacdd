"""The Jaccard join and its components against brute force."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest

from parcelflow.llm import ngram_join
from parcelflow.llm.common import table
from parcelflow.llm.components import components
from parcelflow.llm.queries import QUERIES


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def shingles(text, words=5):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(found) < words:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + words]) for i in range(len(found) - words + 1))


def brute(docs, percent=75):
    """{doc_id: (n, component)} by counting every shared shingle."""
    sets = {d: shingles(t) for d, t in docs}
    holders, union = defaultdict(list), Union()
    for d, own in sets.items():
        shared = defaultdict(int)
        for s in own:
            for other in holders[s]:
                shared[other] += 1
            holders[s].append(d)
        for other, n in shared.items():
            if 100 * n >= percent * (len(own) + len(sets[other]) - n):
                union.join(d, other)
    return {d: (len(s), union.find(d)) for d, s in sets.items()}


def result(rows):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in rows}


def test_query(spark, tables):
    docs = [(r.doc_id, r.text) for r in table(spark, tables, "documents").collect()]
    assert result(QUERIES["op10_ngram_jaccard_join"](spark, tables).collect()) == brute(docs)


def edited(words, share, dice, vocabulary):
    return [dice.choice(vocabulary) if dice.random() < share else w for w in words]


@pytest.mark.parametrize("seed", [1, 2])
def test_large_groups_chains_and_shared_passages(documents, seed):
    """Groups beyond SMALL_LIST, links only through others, and a passage that makes up most of unrelated texts."""
    dice = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = dice.choices(vocabulary, k=60)
    texts = []
    for _ in range(4):
        base = dice.choices(vocabulary, k=120)
        texts += [edited(base, dice.choice([0, 0.005, 0.02, 0.05]), dice, vocabulary) for _ in range(45)]
        chain = base
        for _ in range(25):
            chain = edited(chain, 0.025, dice, vocabulary)
            texts.append(chain)
    for k in (2, 5, 8, 12, 20, 40):
        texts += [passage + dice.choices(vocabulary, k=k) for _ in range(8)]
    texts += [dice.choices(vocabulary, k=dice.randrange(0, 9)) for _ in range(60)]
    dice.shuffle(texts)
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    assert result(ngram_join.link_documents(documents(*docs)).collect()) == brute(docs)


def test_threshold_is_met_exactly(documents):
    words = [f"a{i}" for i in range(11)]  # 7 shingles
    docs = [(1, " ".join(words)), (2, " ".join([*words, "x"])), (3, " ".join([*words, "x", "y"])), (4, " ".join([*words, "p", "q", "r"]))]
    got = result(ngram_join.link_documents(documents(*docs)).collect())
    assert got == brute(docs) == {1: (7, 1), 2: (8, 1), 3: (9, 1), 4: (10, 4)}


def test_edges(documents):
    docs = [(5, None), (6, ""), (7, " \n"), (8, "One two"), (9, "one TWO"), (9, "one two"), (None, "one two"), (None, ""), (10, "one  two three"), (11, "É é"), (12, "é é")]
    got = sorted(((r.doc_id or -1, r.n_shingles, r.component_id) for r in ngram_join.link_documents(documents(*docs)).collect()), key=str)
    want = [(-1, 0, None), (-1, 1, 8), (5, 0, 5), (6, 0, 6), (7, 0, 7), (8, 1, 8), (9, 1, 8), (9, 1, 8), (10, 1, 10), (11, 1, 11), (12, 1, 12)]
    assert got == sorted(want, key=str)
    assert ngram_join.link_documents(documents()).count() == 0


def test_very_long_text(documents):
    long = " ".join(f"w{i % 997}x{i % 1009}" for i in range(300_000))
    got = result(ngram_join.link_documents(documents((1, long), (2, long + " end"), (3, "other words"))).collect())
    assert got[2][1] == 1 and got[1][0] == 299_996 and got[3] == (1, 3)


def test_components(spark):
    dice = random.Random(4)
    star = [(7, 1000 + i) for i in range(300)]
    path = [(5000 + i, 5001 + i) for i in range(120)]
    edges = star + path + [(dice.randrange(9000, 9400), dice.randrange(9000, 9400)) for _ in range(250)]
    union = Union()
    for a, b in edges:
        union.join(a, b)
    got = defaultdict(set)
    for r in components(spark.createDataFrame(edges, "a long, b long")).collect():
        got[r.label].add(r.node)
    want = defaultdict(set)
    for x in {n for e in edges if e[0] != e[1] for n in e}:
        want[union.find(x)].add(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
