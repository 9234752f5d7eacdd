"""The license scan against a plain Python version."""

from __future__ import annotations

import re

from parcelflow.llm import licenses
from parcelflow.llm.common import table
from parcelflow.llm.queries import QUERIES

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text))


def brute(text, percent=90, windows=0):
    own = words(text)
    places = [
        (i, label)
        for phrase, label in licenses.PHRASES.items()
        for i in range(len(own))
        if own[i : i + len(phrase.split())] == phrase.split()
    ]
    found = {}
    for label, template in licenses.TEMPLATES.items():
        t, n = set(words(template)), windows * len(words(template))
        # a window that starts at no template word holds no more than the next that does
        parts = [own[k : k + n] for k in range(len(own)) if own[k] in t] if n else map(words, re.split(r"[\r\n]+", text))
        best = max((len(t.intersection(b)) for b in parts), default=0)
        if 100 * best >= percent * len(t):
            found[label] = best / len(t)
    base = {label for _, label in places}
    at = [i for i, _ in places]
    score = 1.0 if at else max(found.values(), default=0.0)
    return (len(own), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | set(found))), score)


def values(r):
    return (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score)


def test_query(spark, tables):
    docs = {r.doc_id: r.text or "" for r in table(spark, tables, "documents").collect()}
    got = {r.doc_id: values(r) for r in QUERIES["op8_license_scan"](spark, tables).collect()}
    assert got == {d: brute(t, windows=2) for d, t in docs.items()}


def test_edges(documents):
    texts = [
        "", "...", "The MIT\nLicense, MIT license mit LICENSE", "cc-by cc by by cc BY", "GNU General Public Licenses",
        "gnu general public license gnu general public license", "apache 2 license", "Éapache license", "x" * 50_000,
        "Released\nunder the MIT License.", "the the License MIT, under: released!", "Licensed under CC BY-NC 4.0.",
        "Permission is hereby granted, free of charge, to any person who obtains a copy of this software and associated documentation files",
        "permission is hereby granted free of charge", "mit license " * 2000, "4 5 6",
    ]
    docs = dict(enumerate(texts))
    got = licenses.scan_licenses(documents(*docs.items(), (90, None), (91, "MIT license"), (91, "MIT license"), (91, "x"), (None, "cc by"))).collect()
    assert {r.doc_id: values(r) for r in got if r.doc_id in docs} == {d: brute(t) for d, t in docs.items()}
    rest = sorted((str(r.doc_id), r.n_base) for r in got if r.doc_id not in docs)
    assert rest == [("90", 0), ("91", 0), ("91", 1), ("91", 1), ("None", 1)]
    assert licenses.scan_licenses(documents()).count() == 0


def test_filters_lose_nothing(documents):
    """Templates of random words with random thresholds find what a full comparison finds."""
    import random

    dice = random.Random(8)
    vocabulary = [f"v{i}" for i in range(25)]
    templates = {f"t{i}": " ".join(dice.sample(vocabulary, dice.randrange(1, 9))) for i in range(6)}
    texts = {i: "\n".join(" ".join(dice.choices(vocabulary, k=dice.randrange(0, 14))) for _ in range(3)) for i in range(150)}
    for percent in (60, 85, 100):
        got = {r.doc_id: r.labels for r in licenses.scan_licenses(documents(*texts.items()), templates=templates, percent=percent).collect()}
        for i, text in texts.items():
            want = set()
            for label, template in templates.items():
                t = set(template.split())
                if any(100 * len(t & set(b.split())) >= percent * len(t) for b in text.split("\n")):
                    want.add(label)
            assert got[i] == ",".join(sorted(want))


def test_wrapped_headers(spark, tmp_path, documents):
    import textwrap

    texts, want = {}, {}
    for i, (label, template) in enumerate(licenses.TEMPLATES.items()):
        for j, width in enumerate((72, 30)):
            lines = textwrap.wrap(template, width)
            texts[10 * i + j] = "\n".join(["Some code", "", *(f" * {line}" for line in lines), "", "more code"])
            want[10 * i + j] = label
    # enough words, scattered over one long line, are no notice
    texts[900] = " ".join(f"filler words go here {w} and on and on" for w in words(licenses.TEMPLATES["mit-notice"]))
    texts[901] = "Released\nunder the MIT License."
    documents(*texts.items()).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op8_license_scan"](spark, str(tmp_path)).collect()}
    assert all(label in got[i].labels.split(",") and got[i].score == 1 for i, label in want.items())
    assert got[900].labels == "" and got[901].labels == "mit,mit-notice"


def test_windows_lose_nothing(documents):
    """Word windows of random templates find what trying every window finds."""
    import random

    dice = random.Random(9)
    vocabulary = [f"v{i}" for i in range(14)]
    templates = {f"t{i}": " ".join(dice.choices(vocabulary, k=dice.randrange(1, 9))) for i in range(6)}
    texts = {i: "".join(w + dice.choice(" \n") for w in dice.choices(vocabulary + ["x", "y"], k=dice.randrange(0, 40))) for i in range(120)}
    for percent, windows in ((60, 1), (85, 2), (100, 2)):
        got = {r.doc_id: (r.labels, r.score) for r in licenses.scan_licenses(documents(*texts.items()), phrases={"no phrase": "z"}, templates=templates, percent=percent, windows=windows).collect()}
        for i, text in texts.items():
            want = {}
            for label, template in templates.items():
                t, w, n = set(template.split()), text.split(), windows * len(template.split())
                most = max((len(t & set(w[k : k + n])) for k in range(len(w))), default=0)
                if 100 * most >= percent * len(t):
                    want[label] = most / len(t)
            assert got[i] == (",".join(sorted(want)), max(want.values(), default=0.0))


def test_many_templates_in_one_plan(documents):
    """500 random templates against every window; the plan does not grow with them."""
    import random

    dice = random.Random(10)
    vocabulary = [f"v{i}" for i in range(60)]
    templates = {f"t{i}": " ".join(dice.choices(vocabulary, k=dice.randrange(3, 12))) for i in range(500)}
    texts = {i: " ".join(dice.choices([*vocabulary, "x"], k=dice.randrange(0, 90))) for i in range(40)}
    for i in range(40, 60):  # copies of templates with a word changed, between other words
        own = templates[f"t{i}"].split()
        own[dice.randrange(len(own))] = "y"
        texts[i] = " ".join([*dice.choices(vocabulary, k=30), *own, *dice.choices(vocabulary, k=30)])
    docs = documents(*texts.items())
    scans = {n: licenses.scan_licenses(docs, phrases={"no phrase": "z"}, templates=dict(list(templates.items())[:n]), percent=80, windows=2) for n in (10, 500)}
    plans = {n: len(scan._jdf.queryExecution().optimizedPlan().treeString().splitlines()) for n, scan in scans.items()}
    assert plans[10] == plans[500]
    want = {}
    for i, text in texts.items():
        w, found = text.split(), {}
        for label, template in templates.items():
            t, n = set(template.split()), 2 * len(template.split())
            most = max((len(t.intersection(w[k : k + n])) for k in range(len(w))), default=0)
            if 100 * most >= 80 * len(t):
                found[label] = most / len(t)
        want[i] = (",".join(sorted(found)), max(found.values(), default=0.0))
    assert sum(bool(labels) for labels, _ in want.values()) > 10
    assert {r.doc_id: (r.labels, r.score) for r in scans[500].collect()} == want


def test_long_text_is_cut_into_blocks(documents):
    """A notice across the border of two blocks, and 300,000 words that hold a prefix word each."""
    notice = "Licensed under CC BY-NC 4.0."
    texts = {i: "word " * (i + 40) + notice + " end" * 200 for i in range(30)}
    texts[99] = "nc " * 300_000
    got = {r.doc_id: r.labels for r in licenses.scan_licenses(documents(*texts.items()), windows=2).collect()}
    assert got == {i: "cc-by,cc-by-nc-notice" if i < 99 else "" for i in texts}
