"""Learned decision lists: statistics against a plain count, learning on made statistics and held-out labels."""

from __future__ import annotations

import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from parcelflow.llm import rules
from parcelflow.llm.common import table
from parcelflow.llm.queries import QUERIES


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(repeated),
        "n_distinct_words": len(set(words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_upper": len(re.findall("[A-Z]", text)),
        "n_digits": len(re.findall("[0-9]", text)),
        "n_shouts": len(re.findall("[!?]", text)),
        "n_stops": text.count("."),
    }


def test_counts_equal_plain_counts():
    rng = random.Random(0)
    pieces = ["a", "b", "Cé", "日本", "#x|", "\n", "\n\n", " ", "\t", "\x0b", "\r\n", "9.", "!?", "\xa0", "\x1c", "<b>"]
    texts = ["".join(rng.choices(pieces, k=rng.randrange(60))) for _ in range(400)]
    texts += [None, "", " ", "\n", "a b c " * 5, "a b\na b\na b \n", "x" * 3_000_000, "a b c d " * 300_000]
    found = rules.count_texts(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert {name: int(found[name][i]) for name in rules.COUNTS} == plain_counts(text), repr(text)[:80]


def statistics(n, seed):
    rng = np.random.default_rng(seed)
    x = {name: rng.random(n) for name in rules.STATISTICS}
    y = ~((x["upper_share"] > 0.7) & (x["words"] <= 0.5) | (x["digit_share"] > 0.9))
    return x, y.astype(int)


def test_learns_conjunctions_in_order():
    x, y = statistics(3000, 1)
    found = rules.learn(x, y)
    z, t = statistics(3000, 2)
    assert np.mean(found.decide(z, len(t)) == t) > 0.98
    assert {c.statistic for r in found.rules for c in r.conditions} >= {"upper_share", "words", "digit_share"}
    noisy = np.where(np.random.default_rng(3).random(len(y)) < 0.1, 1 - y, y)
    learned = rules.learn(x, noisy, precision=0.8)
    assert len(learned.rules) <= 24 and np.mean(learned.decide(z, len(t)) == t) > 0.9


def test_pruning_keeps_the_shortest_best_beginning():
    x = {"words": np.array([1.0, 2, 3, 4]), "upper_share": np.array([0.0, 0, 1, 1])}
    first, second = rules.Condition("words", True, 2.5), rules.Condition("upper_share", True, 0.5)
    assert rules._prune(x, np.array([0, 0, 1, 1], bool), np.ones(4, bool), [first, second])[1] == [first]


def test_without_two_classes():
    x, y = statistics(50, 1)
    assert rules.learn(x, np.ones(50, int)) == rules.DecisionList((), 1)
    assert rules.learn(x, np.zeros(50, int)) == rules.DecisionList((), 0)
    assert rules.learn({name: np.zeros(0) for name in x}, np.zeros(0, int)) == rules.DecisionList((), 1)
    constant = {name: np.zeros(50) for name in x}
    assert rules.learn(constant, (np.arange(50) < 10).astype(int)) == rules.DecisionList((), 0)


def test_expressions_equal_decisions(spark, documents):
    texts = [plain for plain in ("A B c.", "WORD!! WORD!!", "", None, "a a a a a a", "1 2 3\n1 2 3\n")]
    docs = documents(*enumerate(texts))
    first = rules.Rule((rules.Condition("upper_share", True, 0.5), rules.Condition("shouts_per_word", True, 1.0)), 0)
    second = rules.Rule((rules.Condition("distinct_per_root", False, 0.6),), 0)
    learned = rules.DecisionList((first, second), 1)
    assert str(learned).splitlines()[0] == "upper_share > 0.5 and shouts_per_word > 1 -> 0"
    got = rules.document_counts(docs, ["doc_id", "n"]).select("kept.doc_id", learned.verdict().alias("v")).collect()
    assert {r.doc_id: r.v for r in got} == {0: 1, 1: 0, 2: 0, 3: 0, 4: 0, 5: 1}
    plan = rules.document_counts(docs, ["doc_id"]).select(learned.verdict())._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan


@pytest.fixture(scope="module")
def larger(tables):
    path = os.path.join(os.path.dirname(tables), "sf0.1")
    return path if os.path.isdir(path) else tables


def test_query_on_held_out_labels(spark, larger):
    labels = {r.doc_id: r.quality for r in table(spark, larger, "labels").collect()}
    texts = {r.doc_id: r.text for r in table(spark, larger, "documents").collect()}
    rows = QUERIES["op11_quality_rules"](spark, larger).collect()
    assert len(rows) == len(texts)
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for r in rows:
        if r.doc_id % 20 == 0:
            wanted = plain_counts(texts[r.doc_id])
            assert all(r[name] == wanted[name] for name in base)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.doc_id in labels and not r.base_failed]
    good, bad = ([r.kept for r in held if labels[r.doc_id] == y] for y in (1, 0))
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.1


def test_held_out_and_contradicting_labels_have_no_effect(spark, documents):
    docs = documents(*[(i, "good words here. " * 9 if i % 2 else "BAD!! ### " * 9) for i in range(40)], (None, "x"), (3, "dup"))
    rows = [(i, i % 2, 0) for i in range(40)] + [(4, 1, 0), (None, 1, 0), (5, None, 0)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    x, y = rules.labelled_statistics(docs, labels, 20_000)
    used = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5]
    assert y.tolist() == [i % 2 for i in used] and all(len(v) == len(used) for v in x.values())
    assert len(rules.labelled_statistics(docs, labels, 7)[1]) == 7


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert rules.document_counts(documents(), ["doc_id"]).collect() == []
    assert rules.fit_rules(documents((1, "a")), none) == rules.DecisionList((), 1)
