"""Template decontamination on planted copies, re-parameterised copies and look-alikes."""

from __future__ import annotations

from parcelflow.llm import decontaminate
from parcelflow.llm.common import table
from parcelflow.llm.queries import QUERIES

ITEM = "A train leaves the old station at 9 and covers 120 km before Anna meets it near the bridge after 3 hours of travel"


def items(spark, *rows):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def found(docs, benchmark):
    return {(r.doc_id, r.item_id): r.exact for r in decontaminate.find_contamination(docs, benchmark).collect()}


def test_copies_and_other_fillings(spark, documents):
    other = ITEM.replace("9", "7").replace("120", "95").replace("Anna", "Peter").replace("3 hours", "2 hours")
    docs = documents(
        (1, f"some words first. {ITEM} and more after it"),
        (2, ITEM.lower().replace("anna", "Anna") + "!!"),
        (3, f"intro, {other}."),
        (4, "nothing of the kind at 9 or 120 km here, only words that go on and on without an item in them"),
        (5, " ".join(ITEM.split()[:10])),
        (6, None),
        (7, ""),
        (3, f"intro, {other}."),
    )
    got = found(docs, items(spark, (10, ITEM), (11, None), (12, "")))
    assert got == {(1, 10): True, (2, 10): True, (3, 10): False, (5, 10): got.get((5, 10), True)} or got == {
        (1, 10): True, (2, 10): True, (3, 10): False}
    kept = [r.doc_id for r in decontaminate.decontaminate(docs, items(spark, (10, ITEM))).collect()]
    assert {4, 6, 7} <= set(kept) and not {1, 2, 3} & set(kept)


def test_slots_must_be_consistent(spark, documents):
    item = "if 5 apples cost 8 coins then 5 pears and 8 plums cost what in total for the buyer of 5 apples"
    swapped = item.replace("5", "6").replace("8", "9")
    mixed = "if 6 apples cost 9 coins then 7 pears and 4 plums cost what in total for the buyer of 2 apples"
    docs = documents((1, swapped), (2, mixed))
    assert found(docs, items(spark, (1, item))) == {(1, 1): False}


def test_slots_rate_an_alignment(spark, documents):
    equal = ITEM.replace("3 hours", "9 hours")  # two values of the item become one
    friends = "Tom has 5 apples and 5 friends so how many does every one of them get"
    split = "Tom has 6 apples and 4 friends so how many does every one of them get"  # and one becomes two
    docs = documents((1, equal), (2, split), (3, f"before it. {equal} after it"))
    got = found(docs, items(spark, (10, ITEM), (11, friends)))
    assert got == {(1, 10): False, (2, 11): False, (3, 10): False}
    # little but placeholders, with unrelated fillings
    row, mixed = "add 1 2 1 2 1 2 1 2 1 2", "add 3 4 5 6 7 8 9 10 11 12"
    swapped = row.replace("1", "7").replace("2", "1")
    assert found(documents((1, mixed), (2, swapped)), items(spark, (1, row))) == {(2, 1): False}


def test_short_items_and_empty_tables(spark, documents):
    docs = documents((1, "so: what is two plus two, then?"), (2, "what is two plus"), (None, "what is two plus two"))
    assert set(found(docs, items(spark, (1, "What is two plus two?")))) == {(1, 1), (None, 1)}
    assert found(documents(), items(spark, (1, ITEM))) == {} == found(docs, items(spark))
    assert decontaminate.decontaminate(docs, items(spark)).count() == 3


def test_parts_of_long_items(spark, documents):
    words = [f"word{i}".translate(str.maketrans("0123456789", "abcdefghij")) for i in range(1000)]
    sixty = words[:59]
    docs = documents(
        (1, "intro here " + " ".join(words[300:540])),
        (2, " ".join(sixty[20:38]) + " and on"),
        (3, " ".join(sixty[20:32])),  # a run of twelve is neither long enough nor a quarter
        (4, " ".join(w for k in range(0, 200, 20) for w in [*words[k : k + 12], "gap"])),
    )
    got = found(docs, items(spark, (1, " ".join(words)), (2, " ".join(sixty))))
    assert got == {(1, 1): True, (2, 2): True, (2, 1): True}


def test_first_word_of_an_item(spark, documents):
    short = "What is two plus two?"
    docs = documents(
        (1, f"Quiz\n{short}"), (2, f"1 {short}"), (3, f"Quiz. {short}"), (4, f"quiz {short} yes"), (5, "Quiz\nWho is two plus two?"),
        (6, "chapter 3\nDays are long"), (7, "chapter 3 days are long"),
        (8, "Quiz\nWhat is"),
    )
    got = found(docs, items(spark, (1, short), (2, "Days are long"), (3, "days are long"), (4, "Paris"), (5, "  What is")))
    assert {k: v for k, v in got.items() if k[1] == 1} == {(1, 1): True, (2, 1): True, (3, 1): True, (4, 1): True}
    assert {(6, 2), (6, 3), (7, 2), (7, 3), (8, 5)} <= set(got)
    assert not [k for k in got if k[1] == 4]
    long = f"What {ITEM}"
    rows = decontaminate.find_contamination(documents((1, f"Quiz\n{long}"), (2, long)), items(spark, (1, long))).collect()
    assert {r.doc_id: (r.matched == r.windows, r.exact) for r in rows} == {1: (True, True), 2: (True, True)}


def test_columns_stay(spark, documents):
    docs = documents((1, ITEM), (2, "clean"))
    assert decontaminate.decontaminate(docs, items(spark, (1, ITEM))).columns == docs.columns


def test_shuffled_join_gives_the_same(spark, documents, monkeypatch):
    docs = documents((1, ITEM), (2, "clean"))
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST", 0)
    assert found(docs, items(spark, (10, ITEM))) == {(1, 10): True}


def test_query_against_plain_text_search(spark, tables):
    docs = [(r.doc_id, " ".join((r.text or "").split())) for r in table(spark, tables, "documents").collect()]
    texts = [(r.item_id, " ".join(r.text.split())) for r in table(spark, tables, "benchmark").collect()]
    got = {r.doc_id: set(r.item_ids) for r in QUERIES["op5_benchmark_decontamination"](spark, tables).collect()}
    assert len(got) == len(docs)
    for doc_id, text in docs:
        held = {i for i, t in texts if t in text}
        assert held <= got[doc_id]
        if not held:  # nothing is found where not even eight words in a row are shared
            words = text.lower().split()
            runs = {" ".join(words[k : k + 6]) for k in range(len(words) - 5)}
            assert all(any(" ".join(t.lower().split()[k : k + 6]) in runs for k in range(len(t.split()) - 5)) for i, t in texts if i in got[doc_id])


def test_query_tells_rows_of_one_id_apart(spark, documents, folder):
    item = "How many apples does the tall merchant carry home when the market closes early on a rainy day in spring?"
    docs = documents((1, f"Once upon a time. {item} That is all."), (1, "nothing of the kind here"), (None, item), (None, "clean"))
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(5, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    rows = QUERIES["op5_benchmark_decontamination"](spark, folder).collect()
    assert sorted((r.doc_id or 0, r.contaminated, r.item_ids) for r in rows) == [
        (0, False, []), (0, True, [5]), (1, False, []), (1, True, [5]),
    ]
