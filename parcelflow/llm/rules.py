"""Quality rules: a decision list of threshold conjunctions, learned from labelled statistics.

*Statistics.* One pass in numpy counts words, characters, symbols, repeated lines, words in repeated 3-word windows and the like; the ratios that
rules speak of (``STATISTICS``) are Spark expressions over these counts.

*Learning.* Sequential covering: a rule for either verdict is grown on two thirds of the rows left, by the threshold condition of the highest
information gain (all thresholds between neighbouring values are tried), and pruned on the other third, by dropping its last conditions while
that does not lower its precision there. The better rule of the two enters the list, the rows it covers leave, and so on until no rule
is precise enough. At most ``max_train`` labelled rows, those of the smallest hashes of doc_id, reach the driver, as statistics; rows with crc32(doc_id as text) mod 5 = 0 are never learned from.

*Use.* ``DecisionList.verdict`` is one chain of Spark conditions in the order learned; no Python runs where rules are applied.

Defined results: null text has no words and all statistics 0; null labels and ids are not learned from; of contradicting labels, or repeated ids, the smallest
counts; without two classes among the labels the list is empty and every verdict the one class (1 without labels); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import hash_runs, mix, random_words, text_chunks, whole_text, word_runs

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_KINDS = {  # counted bytes
    "n_symbols": b"#*$%&|<>",
    "n_upper": bytes(range(65, 91)),
    "n_digits": bytes(range(48, 58)),
    "n_shouts": b"!?",
    "n_stops": b".",
}
COUNTS = ("n_words", "word_chars", "n_lines", "n_dup_lines", "n_repeat_words", "n_distinct_words", *_KINDS)


# Each a count over another (at least 1); ``root`` takes the square root of the latter, as the number of different words grows
# more slowly than that of words.
STATISTICS = {
    "words": ("n_words", None),
    "chars_per_word": ("word_chars", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
    "words_per_stop": ("n_words", "n_stops"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "shouts_per_word": ("n_shouts", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "distinct_share": ("n_distinct_words", "n_words"),
    "distinct_per_root": ("n_distinct_words", "root n_words"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
}


def statistic(name: str) -> Column:
    """A statistic as an expression over COUNTS."""
    part, whole = STATISTICS[name]
    if whole is None:
        return F.col(part).cast("double")
    least = F.greatest(F.col(whole.removeprefix("root ")), F.lit(1))
    return F.col(part) / (F.sqrt(least) if whole.startswith("root ") else least)


# --- statistics --------------------------------------------------------------


def _groups(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(group of each element, size of each group) for equal hashes within a row."""
    with np.errstate(over="ignore"):
        named = mix(hashes + rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, group, sizes = np.unique(named, return_inverse=True, return_counts=True)
    return group, sizes


def _distinct(rows: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Different hashes in each of n rows."""
    if not len(rows):
        return np.zeros(n, np.int64)
    group, sizes = _groups(rows, hashes)
    owner = np.zeros(len(sizes), np.int64)
    owner[group] = rows
    return np.bincount(owner, minlength=n)


def _sums(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(marks)])[offsets])


def count_texts(texts: pa.Array) -> dict[str, np.ndarray]:
    """COUNTS for every text."""
    found = {name: np.zeros(len(texts), np.int64) for name in COUNTS}
    weights = random_words(3, 51)
    for first, end, data, offsets in text_chunks(texts):
        n = end - first
        here = {name: found[name][first:end] for name in COUNTS}
        solid = ~_SPACE[data]
        here["word_chars"][:] = _sums(solid & ((data & 0xC0) != 0x80), offsets)
        for name, kind in _KINDS.items():
            wanted = np.zeros(256, bool)
            wanted[list(kind)] = True
            here[name][:] = _sums(wanted[data], offsets)
        starts, ends, rows = word_runs(solid, offsets)
        words = hash_runs(data, starts, ends)
        here["n_words"][:] = np.bincount(rows, minlength=n)
        here["n_distinct_words"][:] = _distinct(rows, words, n)
        if len(words) > 2:
            with np.errstate(over="ignore"):
                windows = mix(words[:-2] * weights[0] + words[1:-1] * weights[1] + words[2:] * weights[2])
            at = np.flatnonzero(rows[:-2] == rows[2:])
            group, sizes = _groups(rows[at], windows[at])
            repeated = at[sizes[group] > 1]
            covered = np.zeros(len(words), bool)
            for k in range(3):
                covered[repeated + k] = True
            here["n_repeat_words"][:] = np.bincount(rows[covered], minlength=n)
        starts, ends, rows = word_runs(data != 10, offsets)
        upto = np.concatenate([[0], np.cumsum(solid)])
        worded = upto[ends] > upto[starts]
        starts, ends, rows = starts[worded], ends[worded], rows[worded]
        lines = np.bincount(rows, minlength=n)
        here["n_lines"][:] = lines
        here["n_dup_lines"][:] = lines - _distinct(rows, hash_runs(data, starts, ends), n)
    return found


def document_counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """(kept, COUNTS) for every document; ``kept`` is a struct of the columns to keep."""
    wanted = docs.select(F.struct(*keep).alias("kept"), whole_text().alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = count_texts(batch["text"])
            yield pa.RecordBatch.from_arrays([batch["kept"], *map(pa.array, found.values())], ["kept", *found])

    schema = wanted.select("kept").schema
    for name in COUNTS:
        schema = schema.add(name, "long")
    return wanted.mapInArrow(count, schema)


# --- learning ----------------------------------------------------------------


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return (x[self.statistic] > self.threshold) == self.above

    def column(self) -> Column:
        value = statistic(self.statistic)
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.statistic} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    verdict: int

    def covers(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return np.logical_and.reduce([c.holds(x) for c in self.conditions])

    def column(self) -> Column:
        found = self.conditions[0].column()
        for condition in self.conditions[1:]:
            found = found & condition.column()
        return found

    def __str__(self) -> str:
        return f"{' and '.join(map(str, self.conditions))} -> {self.verdict}"


@dataclass(frozen=True)
class DecisionList:
    """The first rule that covers a document decides; ``default`` where none does."""

    rules: tuple[Rule, ...]
    default: int

    def verdict(self) -> Column:
        """An expression over COUNTS."""
        found = None
        for rule in self.rules:
            found = (F if found is None else found).when(rule.column(), F.lit(rule.verdict))
        return F.lit(self.default) if found is None else found.otherwise(F.lit(self.default))

    def decide(self, x: dict[str, np.ndarray], n: int) -> np.ndarray:
        found = np.full(n, self.default)
        for rule in reversed(self.rules):
            found[rule.covers(x)] = rule.verdict
        return found

    def __str__(self) -> str:
        return "\n".join([*map(str, self.rules), f"-> {self.default}"])


def _best_condition(x: dict[str, np.ndarray], y: np.ndarray, inside: np.ndarray) -> tuple[float, Condition] | None:
    """The condition of the highest gain, p1 * (log2 share after - log2 share before), among the rows inside."""
    wanted = y[inside]
    p0, n0 = wanted.sum(), len(wanted)
    best = None
    for name, values in x.items():
        order = np.argsort(values[inside], kind="stable")
        v, hits = values[inside][order], np.cumsum(wanted[order])
        cuts = np.flatnonzero(v[1:] > v[:-1])
        if not len(cuts):
            continue
        for above in (False, True):
            p1 = p0 - hits[cuts] if above else hits[cuts]
            n1 = n0 - cuts - 1 if above else cuts + 1
            gain = np.where(p1 > 0, p1 * (np.log2(np.maximum(p1, 1) / n1) - np.log2(p0 / n0)), 0)
            k = int(np.argmax(gain))
            if gain[k] > 1e-9 and (best is None or gain[k] > best[0]):
                best = (gain[k], Condition(name, above, float((v[cuts[k]] + v[cuts[k] + 1]) / 2)))
    return best


def _grow(x: dict[str, np.ndarray], y: np.ndarray, rows: np.ndarray, longest: int) -> list[Condition]:
    conditions: list[Condition] = []
    inside = rows.copy()
    while len(conditions) < longest and y[inside].any() and not y[inside].all():
        found = _best_condition(x, y, inside)
        if found is None:
            break
        conditions.append(found[1])
        inside &= found[1].holds(x)
    return conditions


def _precision(y: np.ndarray, covered: np.ndarray) -> float:
    """Share of wanted rows among those covered, drawn towards one half where they are few."""
    return float((y[covered].sum() + 1) / (covered.sum() + 2))


def _prune(x: dict[str, np.ndarray], y: np.ndarray, rows: np.ndarray, conditions: list[Condition]) -> tuple[float, list[Condition]]:
    """The shortest beginning of the conditions that is as precise as any."""
    best: tuple[float, list[Condition]] = (0.0, [])
    covered = rows.copy()
    for k, condition in enumerate(conditions):
        covered = covered & condition.holds(x)
        precision = _precision(y, covered)
        if precision > best[0]:
            best = (precision, conditions[: k + 1])
    return best


def learn(
    x: dict[str, np.ndarray], y: np.ndarray, precision: float = 0.9, longest: int = 4, most: int = 24, seed: int = 0
) -> DecisionList:
    """Grow, prune and append rules until none reaches ``precision`` on the rows set aside for pruning."""
    if len(set(y.tolist())) < 2:
        return DecisionList((), int(y[0]) if len(y) else 1)
    aside = np.zeros(len(y), bool)
    aside[np.random.default_rng(seed).permutation(len(y))[: len(y) // 3]] = True
    left = np.ones(len(y), bool)
    rules: list[Rule] = []
    while len(rules) < most:
        found: list[tuple[float, Rule]] = []
        for verdict in (0, 1):
            wanted = y == verdict
            conditions = _grow(x, wanted, left & ~aside, longest)
            score, conditions = _prune(x, wanted, left & aside, conditions)
            # a rule must also beat the verdict that its rows would get anyway
            if conditions and score > max(precision, _precision(wanted, left)):
                found.append((score, Rule(tuple(conditions), verdict)))
        if not found:
            break
        rule = max(found, key=lambda f: f[0])[1]
        covered = left & rule.covers(x)
        if not covered.any():
            break
        rules.append(rule)
        left &= ~covered
    rest = y[left] if left.any() else y
    return DecisionList(tuple(rules), int(rest.mean() >= 0.5))


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text is 0 modulo 5; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_statistics(docs: DataFrame, labels: DataFrame, max_train: int) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """STATISTICS and labels of at most ``max_train`` documents outside the held-out fold."""
    known = labels.filter("doc_id is not null and quality is not null").filter(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("label"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)  # at most 12 bytes a row: safe to broadcast
    counted = document_counts(docs.join(F.broadcast(sample), "doc_id", "left_semi"), ["doc_id"])
    values = F.struct(*[statistic(name).alias(name) for name in STATISTICS])
    # rows that repeat a doc_id do not count twice
    once = counted.groupBy(F.col("kept.doc_id").alias("doc_id")).agg(F.min(values).alias("values"))
    got = once.join(F.broadcast(sample), "doc_id").select("doc_id", "label", "values.*").orderBy("doc_id").collect()
    return {name: np.array([r[name] for r in got], float) for name in STATISTICS}, np.array([int(r["label"] == 1) for r in got])


def fit_rules(docs: DataFrame, labels: DataFrame, max_train: int = 20_000) -> DecisionList:
    """Learn ``quality`` from labelled documents."""
    return learn(*labelled_statistics(docs, labels, max_train))
