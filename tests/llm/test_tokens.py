"""Token ids, counts, files and packing against the tokenizers library."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from parcelflow.llm import bpe, packing, token_counts, token_files
from parcelflow.llm.common import stored, table
from parcelflow.llm.queries import QUERIES

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = ["", None, "x <|endoftext|> y", "<|startoftext|>A b", "it's 'tis don't !'s", "日本 １２ é İI", "a\x1cb\x85c\xa0d  e\n\n f\t g ", "À×÷µª²½ 12345 a1b2", "   ", "…“Œ” œ"]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_ids_equal_the_library(path):
    dice = random.Random(1)
    alphabet = "abAB 12'\n\t!.éÉ×²\x1c\x85\xa0<|œ"
    texts = ODD + ["".join(dice.choices(alphabet, k=dice.randrange(40))) for _ in range(1500)] + ["z" * 5000]
    library = Tokenizer.from_file(path)
    for text, ids in zip(texts, bpe.ids_of(path, pa.array(texts)), strict=True):
        assert ids.tolist() == library.encode(text or "", add_special_tokens=False).ids


def ids_of(path, docs):
    library = Tokenizer.from_file(path)
    return {d: library.encode(t or "", add_special_tokens=False).ids for d, t in docs}


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.fixture(scope="module")
def texts(spark, tables):
    return [(r.doc_id, r.text) for r in table(spark, tables, "documents").collect()]


def check_packing(rows, ids, max_len=1024):
    pieces, filled = defaultdict(dict), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]][r["piece"]] = r
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(ids)
    for doc_id, own in pieces.items():
        whole, at = [*ids[doc_id], 2], 0
        assert len(own) == -(-len(whole) // max_len)
        for i in range(len(own)):
            assert own[i]["start"] == at and (i == 0 or own[i]["length"] == max_len)
            assert own[i]["ids_crc32"] == crc(whole[at : at + own[i]["length"]])
            at += own[i]["length"]
        assert at == len(whole)
    for places in filled.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= max_len
    return len(filled)


def test_packing_query(spark, tables, texts):
    rows = [r.asDict() for r in QUERIES["op3_best_fit_packing"](spark, tables).collect()]
    ids = ids_of(BYTE, texts)
    used = check_packing(rows, ids)
    assert used <= 1.02 * -(-sum(len(x) + 1 for x in ids.values()) // 1024) + 1


def one_by_one(lengths, max_len):
    """Best-fit decreasing over single pieces."""
    room = []
    for length in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(room) if r >= length]
        if fits:
            room[min(fits, key=lambda i: room[i])] -= length
        else:
            room.append(max_len - length)
    return len(room)


def test_plan_over_counts_equals_plan_over_pieces():
    dice = random.Random(3)
    for _ in range(60):
        max_len = dice.randrange(5, 60)
        lengths = [dice.randrange(1, max_len + 1) for _ in range(dice.randrange(1, 200))]
        counts = {n: lengths.count(n) for n in set(lengths)}
        slots = packing.plan_slots(counts, max_len)
        taken = defaultdict(list)
        for n in counts:
            ranks = sorted((first, first + count) for length, first, count, _, _ in slots if length == n)
            assert ranks[0][0] == 0 and ranks[-1][1] == counts[n]
            assert all(a[1] == b[0] for a, b in zip(ranks, ranks[1:], strict=False))
        for length, _, count, first, offset in slots:
            for i in range(count):
                taken[first + i].append((offset, length))
        for places in taken.values():
            ends = [0, *(o + n for o, n in sorted(places))]
            assert [o for o, _ in sorted(places)] == ends[:-1] and ends[-1] <= max_len
        assert len(taken) == one_by_one(lengths, max_len)


def test_plan_size_follows_lengths_not_counts():
    few, many = ({n: c * (1 + n % 7) for n in range(1, 1025)} for c in (3, 3_000_000))
    assert len(packing.plan_slots(many, 1024)) < 20_000 and len(packing.plan_slots(few, 1024)) < 20_000


def test_packing_edges(spark, documents):
    docs = [(1, None), (2, ""), (3, "a"), (3, "a"), (None, "b c d"), (5, "word " * 3000)]
    packed = packing.pack(documents(*docs), BYTE, max_len=64).collect()
    assert sum(1 for r in packed if r.doc_id == 3) == 2 and sum(1 for r in packed if r.doc_id is None) == 1
    assert {r.length for r in packed if r.doc_id in (1, 2)} == {1}
    long = sorted((r for r in packed if r.doc_id == 5), key=lambda r: r.piece)
    ids = b"".join(bytes(r.ids) for r in long)
    assert np.frombuffer(ids, "<u4").tolist() == [*ids_of(BYTE, [(5, "word " * 3000)])[5], 2]
    assert packing.pack(documents(), BYTE).count() == 0


def test_sequences_are_the_pieces_end_to_end(spark, documents):
    packed = stored(packing.pack(documents((1, "a b"), (2, "c"), (3, "d e f")), BYTE, max_len=16), "packed")
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)


def test_token_counts(spark, tables, texts):
    ids = ids_of(BYTE, texts)
    for r in QUERIES["op7_token_counts"](spark, tables).collect():
        assert (r.n_tokens, r.over_limit) == (len(ids[r.doc_id]), len(ids[r.doc_id]) > 1024)
        assert r.n_bytes == len(dict(texts)[r.doc_id].encode())


def test_counts_come_from_the_cache(spark, folder, documents):
    path = f"{folder}/cache"
    first = documents((1, "one two"), (2, "one two"), (2, "one two"), (3, None), (None, "x"))
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(first, BYTE, path).collect())
    assert got == [(-1, 1, 1), (1, 7, 2), (2, 7, 2), (2, 7, 2), (3, 0, 0)]
    assert spark.read.parquet(path).count() == 3  # distinct contents
    # a wrong stored count is believed: nothing known is encoded again, and only the new text is added
    spark.read.parquet(path).withColumn("n_tokens", F.lit(99).cast("long")).write.parquet(f"{folder}/other")
    again = token_counts.count_tokens(documents((1, "one two"), (9, "brand new")), BYTE, f"{folder}/other")
    assert {r.doc_id: r.n_tokens for r in again.collect()} == {1: 99, 9: 2}
    assert spark.read.parquet(f"{folder}/other").count() == 4
    assert token_counts.count_tokens(documents(), BYTE, f"{folder}/none").count() == 0


def test_token_files_query(spark, tables, texts):
    ids, start = ids_of(WORD, texts), 0
    got = {r.doc_id: r for r in QUERIES["op4_token_files"](spark, tables).collect()}
    for doc_id in sorted(ids):
        whole = [*ids[doc_id], 1]
        assert (got[doc_id].start, got[doc_id].n_tokens, got[doc_id].ids_crc32) == (start, len(whole), crc(whole))
        start += len(whole)
    assert len(got) == len(ids)


def test_random_access_and_edges(spark, folder, documents):
    docs = [(4, "a b c"), (4, "a a"), (None, "x"), (7, None), (9, "long " * 900), (-3, "")]
    manifest = token_files.write_token_files(documents(*docs), folder, WORD, seq_len=16, batch_rows=4)
    ordered = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or ""))
    rows = sorted(token_files.read_token_files(spark, folder, manifest).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [d for d, _ in ordered]
    want = [list(x) + [1] for x in bpe.ids_of(WORD, pa.array([t for _, t in ordered]))]
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in rows] == want
    for file in manifest.collect():
        flat = [i for r, w in zip(rows, want, strict=True) for i in w if file.first_position <= r.start < file.first_position + file.n_tokens]
        for row in range(-(-len(flat) // 16)):
            tokens, mask = token_files.sequence(folder, file.file, row, file.first, file.stride, file.batch_rows)
            held = [t for t, m in zip(tokens.to_pylist(), mask.to_pylist(), strict=True) if m]
            assert held == flat[16 * row : 16 * row + 16]
    empty = token_files.write_token_files(documents(), f"{folder}/none", WORD)
    assert token_files.read_token_files(spark, f"{folder}/none", empty).count() == 0
