"""Syncmer fingerprints against a plain Python version."""

from __future__ import annotations

import hashlib
import random
import struct
from collections import Counter

import regex
import xxhash

from parcelflow.llm import fingerprints as fp
from parcelflow.llm.common import table
from parcelflow.llm.queries import QUERIES


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def hash_text(text):
    return signed(xxhash.xxh64_intdigest(text.encode(), seed=42))


def hash_longs(values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", v), seed=seed)
    return signed(seed)


UNIT = regex.compile(r"[\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u9FFF\uF900-\uFAFF\U00020000-\U0003FFFF]"
                     r"|[^ \t\n\x0b\f\r\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u9FFF\uF900-\uFAFF\U00020000-\U0003FFFF]{1,16}")


def sketch(text):
    k, s = fp.K, fp.S
    h = [hash_text(u) for u in UNIT.findall(text)]
    if not h:
        return []
    h = [0] * (k - 1) + h + [0] * (k - 1)
    pieces = [hash_longs(h[i : i + s]) for i in range(len(h) - s + 1)]
    chosen = [i for i in range(len(h) - k + 1) if min(pieces[i : i + k - s + 1]) in (pieces[i], pieces[i + k - s])]
    seen, found = Counter(), []
    for x in (hash_longs(h[i : i + k]) for i in chosen):
        seen[x] += 1
        found.append(signed(xxhash.xxh64_intdigest(struct.pack("<i", seen[x]), seed=hash_longs([x]) & (2**64 - 1))))
    assert len(set(found)) == len(found)
    return found


def likeness(a, b):
    if not a and not b:
        return 1.0
    place = {x: i for i, x in enumerate(b)}
    theirs = [place[x] for x in a if x in place]
    behind = sum(x > max(theirs[:i], default=-1) for i, x in enumerate(theirs))
    before = sum(x < min(theirs[i + 1 :], default=len(b)) for i, x in enumerate(theirs))
    return 2 * max(behind, before) / (len(a) + len(b))


def as_text(hashes):
    return "".join(f"{h & (2**64 - 1):016X}" for h in hashes)


def check(rows, docs):
    order = sorted(docs, reverse=True)
    assert len(rows) == len(docs)
    for r in rows:
        text = docs[r.doc_id]
        following = docs[order[(order.index(r.doc_id) + 1) % len(order)]]
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        own, changed = sketch(text), sketch(edited)
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (as_text(own), as_text(changed))
        assert abs(r.near_edited - likeness(own, changed)) < 1e-12
        assert abs(r.near_next - likeness(own, sketch(following))) < 1e-12


def test_query(spark, tables):
    docs = {r.doc_id: r.text or "" for r in table(spark, tables, "documents").collect()}
    rows = QUERIES["op6_document_fingerprints"](spark, tables).collect()
    check(rows, docs)
    equal = {}
    for r in rows:
        assert equal.setdefault(docs[r.doc_id], r.fingerprint) == r.fingerprint


def test_short_and_odd_texts(documents):
    docs = {3: "", 9: "a", 12: "é" * 7, 40: "日本語のテキスト", 41: " \n ", 77: "one two three four five six seven eight nine ten eleven"}
    docs |= {100 + i: "word " * i for i in range(14)}
    check(fp.fingerprint_edits(documents(*docs.items())).collect(), docs)


def test_nulls_repeats_single_and_empty(documents):
    assert fp.fingerprint_edits(documents()).count() == 0
    only = fp.fingerprint_edits(documents((1, "abc def"))).collect()[0]
    assert only.near_next == 1.0
    rows = fp.fingerprint_edits(documents((2, "second text"), (2, "first text"), (2, "first text"), (5, "xyzxyz"), (None, None))).collect()
    assert len(rows) == 5
    five = next(r for r in rows if r.doc_id == 5)
    assert five.edited_sha256 == hashlib.sha256(b"xyzxfi").hexdigest()  # the smallest text of the repeated id
    null = next(r for r in rows if r.doc_id is None)
    assert (null.n_chars, null.fingerprint) == (0, "")
    assert null.edited_sha256 == hashlib.sha256(b"").hexdigest()


def test_the_smallest_id_is_not_null(documents):
    low = -(2**63)
    rows = fp.fingerprint_edits(documents((low, "lowest text"), (None, "abcdef"), (7, "seventh"), (None, "zz"))).collect()
    edited = {(r.doc_id, r.n_chars): r.edited_sha256 for r in rows}
    wanted = {(7, 7): "seventh"[:5] + "lo", (low, 11): "lowest text"[:8] + "abc", (None, 6): "abcdse", (None, 2): "zz"}
    assert edited == {k: hashlib.sha256(v.encode()).hexdigest() for k, v in wanted.items()}


def near(documents, one, two):
    docs = {1: one, 2: two}
    rows = fp.fingerprint_edits(documents(*docs.items())).collect()
    check(rows, docs)
    assert abs(rows[0].near_next - rows[1].near_next) < 0.2
    return rows[0].near_next


def test_no_jump_between_lengths(documents):
    words = " ".join(f"word{i}" for i in range(56))
    for end in ("ending", "other ending"):  # texts that were of two kinds once: below and above 400 code points
        assert near(documents, words + " last", words + f" {end}") > 0.9
    for n in (1, 3, 6, 12):  # few words share anchors with some more of them
        assert near(documents, " ".join(f"w{i}" for i in range(n)), " ".join(f"w{i}" for i in range(n + 1))) > 0.2


def test_order_counts(documents):
    rng = random.Random(2)
    blocks = [" ".join(f"b{i}w{j}" for j in range(20)) for i in range(20)]
    mixed = rng.sample(blocks, len(blocks))
    ordered = " ".join(blocks)
    assert near(documents, ordered, " ".join(mixed)) < 0.4
    assert near(documents, ordered, " ".join([*blocks[:7], "some words put in between", *blocks[7:]])) > 0.95
    assert near(documents, ordered, " ".join([*blocks[1:], blocks[0]])) > 0.85  # one block moved to the end
    assert near(documents, ordered, " ".join([blocks[-1], *blocks[:-1]])) > 0.85  # or to the front


def test_repeats_and_scripts_without_spaces(documents):
    line = "the same line over and over. "
    assert near(documents, line * 40, line * 30) > 0.8
    text = "吾輩は猫である。名前はまだ無い。どこで生れたかとんと見当がつかぬ。" * 2
    assert near(documents, text, "或" + text) > 0.9
    assert near(documents, "x" * 5000, "x" * 4000 + "y" * 1000) > 0.7


def test_anchors_are_context_free(spark):
    from pyspark.sql import functions as F

    passage = " ".join(f"p{i}" for i in range(150))
    rows = spark.createDataFrame([(passage,), ("a b c " + passage + " d e",)], "text string").select(fp.anchors(F.col("text")).alias("a")).collect()
    alone = {(x.position, x.hash) for x in rows[0].a if 0 <= x.position <= 150 - fp.K}  # but for those at the text's ends
    within = {(x.position - 3, x.hash) for x in rows[1].a}
    assert alone and alone <= within


def test_a_small_common_passage_of_long_texts(documents):
    passage = " ".join(f"p{i}" for i in range(60))
    one = " ".join(f"a{i}" for i in range(1500)) + f" {passage} " + " ".join(f"b{i}" for i in range(1500))
    two = " ".join(f"c{i}" for i in range(2000)) + f" {passage} " + " ".join(f"d{i}" for i in range(1000))
    docs = {1: one, 2: two}
    rows = fp.fingerprint_edits(documents(*docs.items())).collect()
    check(rows, docs)
    for r in rows:
        assert 0.01 < r.near_next < 0.03
        assert len(r.fingerprint) > 16 * 1000  # about every second window
