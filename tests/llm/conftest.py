"""Every test of the training-data operators runs on a prepared session."""

from __future__ import annotations

import pytest

from parcelflow.llm.common import ready


@pytest.fixture(autouse=True)
def prepared(spark):
    return ready(spark)


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) pairs, with columns named like the operators' own."""

    def make(*rows):
        clash = ["label", "node", "token", "key", "spans", "row", "part", "rank", "spaced", "text_hash", "kept"]
        clash += ["doc", "kept_id", "nth", "held_id", "quality_score", "hash", "n", "piece", "offset", "ids", "tokens"]
        schema = "doc_id long, text string, lang string, source string, n_chars long, "
        schema += ", ".join(f"{c} string" for c in clash)
        values = [(i, t, None, "x", None if t is None else len(t), *["?"] * len(clash)) for i, t in rows]
        return spark.createDataFrame(values, schema)

    return make
