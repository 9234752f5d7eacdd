"""Personal data: patterns against Python's re, disclosure against its formula, and the sanitised text."""

from __future__ import annotations

import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from parcelflow.llm import pii
from parcelflow.llm.common import table
from parcelflow.llm.queries import QUERIES

# the patterns as published
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def brute(text):
    found = []
    for kind in pii.KINDS:
        for m in re.finditer(PLAIN[kind], text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            found.append((kind, m.start(), m.end()))
    return found


def spans_of(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    rows = frame.select("i", pii.entity_spans(F.col("text")).alias("s")).collect()
    return [[(s.kind, s.start, s.end) for s in r.s] for r in sorted(rows, key=lambda r: r.i)]


def test_patterns_on_any_text(spark):
    dice = random.Random(2)
    parts = ["a", "b.c", "@", ".", "x-y", "1", "22", "255", "256", "+", "+1", " ", "-", "(", ")", "4539 1488 0343 6467", "4539148803436467", "é", "日", "😀", "a@b.c", "1.2.3.4", "+1 (415) 555-0199", "\n", "_", "%"]
    texts = ["".join(dice.choices(parts, k=dice.randrange(12))) for _ in range(1500)]
    texts += ["", "é😀 +49 30 123456 x@y.zz,a@b.c_d@e.f 1.1.1.1.1.1.1.1 999.1.1.1"]
    assert spans_of(spark, texts) == [brute(t) for t in texts]


def test_long_runs_end(spark):
    texts = ["9" * 60_000, "a" * 60_000, "a" * 30_000 + "@", "1." * 20_000, "+1" + "." * 30_000, "a@" + "b." * 20_000 + "c", "1 " * 20_000]
    got = spans_of(spark, texts)
    assert got[5] == [("email", 0, len(texts[5]))] and got[0] == got[1] == got[2] == []
    assert len(got[3]) == 5000


def test_query_base(spark, tables):
    docs = {r.doc_id: r.text or "" for r in table(spark, tables, "documents").collect()}
    rows = QUERIES["op9_pii"](spark, tables).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = brute(docs[r.doc_id])
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(x[0] == k for x in want) for k in pii.KINDS]
        assert r.spans == base or r.spans.startswith(base)


def test_terms_that_disclose(documents):
    mails = [f"m{i}@host.org" for i in range(8)]
    near = [f"text number{'abcdefgh'[i]} reachme {m} please" for i, m in enumerate(mails)]
    others = [f"please read this text {'xyz' * (i % 3 + 1)}" for i in range(40)] + ["reachme not"]
    docs = documents(*enumerate(near + others + [near[0]] * 5))
    rows = {}
    for r in pii.find_personal_data(docs, keep=["doc_id", "text"], threshold=0.8, support=5).collect():
        rows[r.kept.doc_id] = [(s.kind, r.kept.text[s.start : s.end]) for s in r.spans]
    # 13 of 54 texts hold an address; 'reachme' stands in 14, 13 times near one; 'please' and 'text' in far more
    disclosure = 1 - math.log(13 / 14) / math.log(13 / 54)
    assert 0.8 < disclosure < 1
    assert rows[0] == [("email", "m0@host.org"), ("term", "reachme")]
    assert rows[len(near)] == [] == rows[len(near) + 40]
    # a stricter threshold, or support beyond the eight different contexts, finds no term
    for threshold, support in ((disclosure + 0.01, 5), (0.8, 9)):
        found = pii.find_personal_data(docs, ["doc_id"], threshold, support).collect()
        assert all(s.kind == "email" for r in found for s in r.spans)


def test_terms_that_reveal_an_entity_anywhere(documents):
    """With production parameters, far from the address, and in texts without one."""
    filler = "ordinary words of the kind that stand in all the texts here "
    words = ["one", "two", "three", "four", "five", "six"]
    holding = [f"Zyskowski {filler} {w} write to anna@host.org" for w in words[:5]] + [f"{words[5]} ANNA@host.org, {filler} zyskowski!"]
    clean = [f"{filler} write number {'abcdefghij'[i % 10]}{'klmno'[i // 10]}q" for i in range(50)]
    other = f"{filler} and (Zyskowski) said zyskowskis"
    docs = documents(*enumerate([*holding, *clean, other]))
    rows = {r.kept.doc_id: [(x.kind, r.kept.text[x.start : x.end]) for x in r.spans]
            for r in pii.find_personal_data(docs, keep=["doc_id", "text"]).collect()}
    assert 1 - math.log(6 / 7) / math.log(6 / 57) >= 0.9
    assert rows[0] == [("email", "anna@host.org"), ("term", "Zyskowski")] and rows[5][-1] == ("term", "zyskowski")
    assert rows[56] == [("term", "Zyskowski")] and not any(rows[i] for i in range(6, 56))
    # copies of one text are one: they neither give support nor hide a term
    copied = documents(*enumerate([*holding[:4], *[holding[0]] * 5, *clean, other]))
    assert all(x.kind == "email" for r in pii.find_personal_data(copied, ["doc_id"]).collect() for x in r.spans)
    hidden = documents(*enumerate([*holding, *clean, *[other] * 30]))
    assert sum(x.kind == "term" for r in pii.find_personal_data(hidden, ["doc_id"]).collect() for x in r.spans) == 36


def _near_terms(docs):
    rows = pii.find_personal_data(docs, keep=["doc_id", "text"], count_copies=False).collect()
    return [(r.kept.doc_id, r.kept.text[s.start : s.end]) for r in rows for s in r.spans if s.kind == "term"]


def test_copies_change_no_term(documents):
    """With production parameters, as the query and the pipeline count."""
    near = [f"text {c}{c}{c} reachme {c}@host.org please {c}{c}{c}" for c in "abcdefghij"]
    others = [f"please read this text number {'abcdefghij'[i % 10]}{'klmno'[i // 10]}q" for i in range(50)]
    want = [(i, "reachme") for i in range(10)]
    assert sorted(_near_terms(documents(*enumerate(near + others)))) == want
    # copies of a clean text with the term do not hide it: 10 of 11 distinct texts, not 10 of 70
    clean = "reachme is a word of this text"
    once = sorted(_near_terms(documents(*enumerate([*near, *others, clean]))))
    assert 1 - math.log(10 / 11) / math.log(10 / 61) >= 0.9 and once == want
    assert sorted(_near_terms(documents(*enumerate([*near, *others, *[clean] * 60])))) == want
    # nor do copies of a text with an address make its words disclose: 'often' near one in 6 of 12 distinct texts
    often = [f"often {c}{c}{c} at {c}@host.org" for c in "klmnop"] + [f"often {c}{c}{c}" for c in "qrstuv"]
    assert _near_terms(documents(*enumerate([*often, *others]))) == []
    assert _near_terms(documents(*enumerate([*often, *[often[0]] * 300, *others, *others * 20]))) == []


def test_production_counts_distinct_texts(spark, documents, tmp_path):
    import corpus_pipeline

    near = [f"text {c}{c}{c} reachme {c}@host.org please" for c in "abcdefghij"]
    others = [f"please read this text number {'abcdefghij'[i % 10]}{'klmno'[i // 10]}q" for i in range(50)]
    docs = documents(*enumerate([*near, *others, *["reachme is a word of this text"] * 60]))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = QUERIES["op9_pii"](spark, str(tmp_path)).collect()
    assert sum("term:" in r.spans for r in rows) == 10
    clean = corpus_pipeline.remove_personal_data(spark, docs, str(tmp_path)).filter("contains(text, '[TERM]')")
    assert clean.count() == 10


def test_sanitise(spark):
    text = "é call +1 415 555 0199 or x@y.org, +4539148803436467 end"
    schema = "text string, spans array<struct<kind:string,start:bigint,end:bigint>>"
    rows = [(text, brute(text)), ("none", []), (None, []), ("abcdef", [("a", 0, 2), ("b", 1, 4), ("c", 4, 5)])]
    got = [r[0] for r in spark.createDataFrame(rows, schema).select(pii.sanitise(F.col("text"), F.col("spans"))).collect()]
    assert got == ["é call [PHONE] or [EMAIL], +[CARD] end", "none", None, "[A][C]f"]


def test_many_matches_end(spark, documents):
    """80,000 addresses in one text, located, looked around and replaced within seconds."""
    import time

    text = " ".join(f"é to m{i}@host{i % 7}.org" for i in range(80_000))
    start = time.time()
    rows = pii.find_personal_data(documents((1, text), (2, "write to me@host.org")), ["doc_id", "text"], count_copies=False)
    rows = rows.select("spans", pii.sanitise(F.col("kept.text"), F.col("spans")).alias("clean"), "kept.doc_id").collect()
    found = {r.doc_id: r for r in rows}
    assert [(x.start, x.end) for x in found[1].spans if x.kind == "email"] == [m.span() for m in re.finditer(PLAIN["email"], text)]
    assert found[1].clean == " ".join(["é to [EMAIL]"] * 80_000) and found[2].clean == "write to [EMAIL]"
    assert time.time() - start < 90


def test_running_cut_and_free(spark):
    dice = random.Random(3)
    rows = []
    for i in range(200):
        n = dice.choice([0, 1, 5, 255, 256, 257, 600])
        text = "".join(dice.choices("aé日😀\n ", k=dice.choice([0, 1, 1023, 1024, 1025, 3000])))
        a = dice.randrange(len(text) + 2)
        spans = sorted((dice.randrange(60), dice.randrange(1, 6)) for _ in range(dice.randrange(5)))
        places = [(k, k + dice.randrange(3, 6)) for k in range(0, 60, 7)]
        rows.append((i, [dice.randrange(-9, 99) for _ in range(n)], text, a, a + dice.choice([0, 1, 40, 1100]),
                     [("x", k, k + w) for k, w in spans], [("term", k, e) for k, e in places]))
    span = "array<struct<kind:string,start:bigint,end:bigint>>"
    frame = spark.createDataFrame(rows, f"i int, v array<bigint>, text string, a bigint, b bigint, s {span}, p {span}")
    got = frame.select(
        "*",
        pii._running(F.col("v"), lambda x, y: x + y).alias("sums"),
        pii._cut(pii._blocks(F.col("text")), F.col("a"), F.col("b")).alias("cut"),
        pii._free(F.col("s"), F.col("p")).alias("free"),
    )
    for r in got.collect():
        assert r.sums == [sum(r.v[: k + 1]) for k in range(len(r.v))]
        assert r.cut == r.text[r.a : r.b]
        assert r.free == [p for p in r.p if not any(x.start < p.end and p.start < x.end for x in r.s)]


def _formulas(texts, kinds_of, support):
    """Terms by both formulas, from plain counts over distinct texts."""
    texts = sorted(set(texts))
    letters = {t: {w for w in re.split(r"[^a-z]+", t.lower()) if len(w) >= 3} for t in texts}
    with_term = {w: {t for t in texts if w in letters[t]} for w in set().union(*letters.values())}
    near, contexts, beside, values, kinds = {}, {}, {}, {}, {}
    for t in texts:
        spans = kinds_of(t)
        outside = t
        for _, a, b in reversed(sorted(spans, key=lambda x: x[1])):
            outside = outside[:a] + "[]" + outside[b:]
        out = set(re.split(r"[^a-z]+", outside.lower()))
        for kind, a, b in spans:
            kinds.setdefault(kind, set()).add(t)
            value = (kind, re.sub("[^0-9]", "", t[a:b]) if kind in ("card", "phone") else t[a:b].lower())
            values.setdefault(value, set()).add(t)
            for w in letters[t] & out:
                beside.setdefault((value, w), set()).add(t)
            for m in re.finditer("[A-Za-z]{3,}", t):
                if max(0, a - 40) <= m.start() and m.end() <= a or b <= m.start() and m.end() <= b + 40:
                    near.setdefault((kind, m[0].lower()), set()).add(t)
                    contexts.setdefault((kind, m[0].lower()), set()).add((t[max(0, a - 40) : a], t[b : b + 40]))

    def share(together, entity, w):
        p, n = len(together) / len(with_term[w]), len(entity) / len(texts)
        return 0 if n == 1 else 1 - math.log(min(p, 1)) / math.log(n)

    of_kind = {(w, k): share(g, kinds[k], w) for (k, w), g in near.items() if len(contexts[k, w]) >= support}
    of_value = {}
    for (v, w), out in beside.items():
        if len(values[v]) >= support and len(out) >= support:
            of_value[w] = max(of_value.get(w, -9), share(values[v] & with_term[w], values[v], w))
    return of_kind, of_value


@pytest.mark.parametrize("listed", [1000, 0])
def test_both_formulas_on_random_texts(documents, monkeypatch, listed):
    monkeypatch.setattr(pii, "MAX_LISTED", listed)
    dice = random.Random(6)
    words = [c * 3 for c in "abcdefghijklmnop"]
    texts = []
    for _ in range(160):
        own = dice.choices(words, k=dice.randrange(3, 12))
        if dice.random() < 0.4:
            own.insert(dice.randrange(len(own)), dice.choice(["qq@host.org", "rr@host.org", "1.2.3.4"]))
            own += ["zzz"] * (dice.random() < 0.8) + [" , " * 30 + "yyy"] * ("qq@host.org" in own)
        texts.append(" ".join(own))
    texts += texts[:30]
    for threshold in (0.05, 0.2, 0.6):
        of_kind, of_value = _formulas(texts, brute, 3)
        kinds = {(w, k) for (w, k), d in of_kind.items() if d >= threshold}
        anywhere = {w for w, d in of_value.items() if d >= threshold}
        rows = pii.find_personal_data(documents(*enumerate(texts)), ["text"], threshold, 3, count_copies=False).collect()
        assert len(rows) == len(texts) and (anywhere or kinds)
        for r in rows:
            t, spans = r.kept.text, brute(r.kept.text)
            want = set()
            for m in re.finditer("[A-Za-z]{3,}", t):
                inside = any(a < m.end() and m.start() < b for _, a, b in spans)
                if m[0].lower() in anywhere and not inside:
                    want.add(m.span())
                for kind, a, b in spans:
                    beside = a - 40 <= m.start() and m.end() <= a or b <= m.start() and m.end() <= b + 40
                    if beside and (m[0].lower(), kind) in kinds:
                        want.add(m.span())
            assert [(x.start, x.end) for x in r.spans if x.kind == "term"] == sorted(want)


def test_edges(documents):
    assert pii.find_personal_data(documents(), ["doc_id"]).count() == 0
    docs = documents((1, None), (2, ""), (3, "a@b.c"), (3, "a@b.c"), (None, "1.2.3.4"))
    got = sorted((str(r.kept.doc_id), [s.kind for s in r.spans]) for r in pii.find_personal_data(docs, docs.columns).collect())
    assert got == [("1", []), ("2", []), ("3", ["email"]), ("3", ["email"]), ("None", ["ip"])]
