"""Learned decision lists over text statistics, applied as ordered Spark conditionals.

Statistics of whole texts are computed once per document. A list of rules, each a conjunction of thresholds, is learned
from labelled statistics by sequential covering: a rule is grown condition by condition on one part of the rows, pruned
on the other, and what it covers is taken away before the next. The list becomes one CASE WHEN expression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spherecube.llm import texts as tx
from spherecube.llm.common import id_and_text, schema_with

#: statistics the query returns
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: statistics rules may test
FEATURES = (
    "n_words", "mean_word_chars", "symbol_ratio", "dup_line_ratio", "repeat_word_ratio", "upper_ratio", "digit_ratio",
    "punct_ratio", "distinct_word_ratio", "bar_ratio", "mark_ratio", "lines_per_word",
)
SYMBOLS = tx.byte_class(inside=b"#*$%&|<>")
UPPER = tx.byte_class(inside=bytes(range(0x41, 0x5B)))
DIGIT = tx.byte_class(inside=bytes(range(0x30, 0x3A)))
PUNCT = tx.byte_class(inside=b".,;:?")
MARK = tx.byte_class(inside=b"!")
BAR = tx.byte_class(inside=b"|")
POINT = tx.byte_class(outside=bytes(range(0x80, 0xC0)))
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WINDOW = 8


def statistics(texts: tx.Texts) -> dict[str, np.ndarray]:
    """Statistics of each text of a chunk; a null or empty text has zeros."""
    data, n = texts.data, texts.n
    words = texts.words(tx.SPACED, lower=False)
    counts = words.counts
    inside = tx.SPACED[data]
    sums = texts.sums(lower=False)

    # lines that hold a word, without those equal to one seen before in the same text
    line_row, line_start, line_end = texts.runs(data != 0x0A)
    filled = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(inside, out=filled[1:])
    full = filled[line_end] > filled[line_start]
    line_row, line_start, line_end = line_row[full], line_start[full], line_end[full]
    keys = tx.salted(texts.hashes(line_start, line_end, sums), line_row)
    _, first = np.unique(keys, return_index=True)
    n_lines = np.bincount(line_row, minlength=n)
    dup_lines = n_lines - np.bincount(line_row[first], minlength=n)

    # words that lie in a window found twice or more in the text
    position, grams = words.grams(REPEAT_WINDOW)
    _, inverse, times = np.unique(tx.salted(grams, words.row[position]), return_inverse=True, return_counts=True)
    again = position[times[inverse] > 1]
    steps = np.zeros(len(words.row) + 1, dtype=np.int64)
    np.add.at(steps, again, 1)
    np.subtract.at(steps, again + REPEAT_WINDOW, 1)
    repeated = np.bincount(words.row[np.cumsum(steps[:-1]) > 0], minlength=n)

    _, first_word = np.unique(tx.salted(words.hashes, words.row), return_index=True)
    distinct = np.bincount(words.row[first_word], minlength=n)
    chars = texts.per_row(inside & POINT[data])
    per_word, per_char = np.maximum(counts, 1), np.maximum(chars, 1)
    symbols = texts.per_row(SYMBOLS[data])
    return {
        "n_words": counts, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup_lines, "n_repeat_words": repeated.astype(np.int64),
        "mean_word_chars": chars / per_word, "symbol_ratio": symbols / per_word, "dup_line_ratio": dup_lines / np.maximum(n_lines, 1),
        "repeat_word_ratio": repeated / per_word, "upper_ratio": texts.per_row(UPPER[data]) / per_char,
        "digit_ratio": texts.per_row(DIGIT[data]) / per_char, "punct_ratio": texts.per_row(PUNCT[data]) / per_word,
        "distinct_word_ratio": distinct / per_word, "bar_ratio": texts.per_row(BAR[data]) / per_word,
        "mark_ratio": texts.per_row(MARK[data]) / per_word, "lines_per_word": n_lines / per_word,
    }


_STATS = {c: "bigint" for c in BASE} | {c: "double" for c in FEATURES if c not in BASE}


def with_statistics(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with one struct column ``_stats`` behind its own columns, which pass through untouched."""
    struct = ", ".join(f"{c}: {t}" for c, t in _STATS.items())

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in tx.chunks(batches, text_col):
            stats = statistics(texts)
            arrays = [pa.array(stats[c], type=pa.int64() if t == "bigint" else pa.float64()) for c, t in _STATS.items()]
            column = pa.StructArray.from_arrays(arrays, names=list(_STATS))
            yield pa.RecordBatch.from_arrays([*part.columns, column], names=[*part.schema.names, "_stats"])

    return docs.mapInArrow(compute, schema_with(docs, f"_stats struct<{struct}>"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, table: pd.DataFrame) -> np.ndarray:
        x = table[self.feature].to_numpy()
        return x > self.threshold if self.above else x <= self.threshold

    def column(self, stats: Column) -> Column:
        x = stats.getField(self.feature)
        return x > F.lit(self.threshold) if self.above else x <= F.lit(self.threshold)


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]

    def covers(self, table: pd.DataFrame) -> np.ndarray:
        hit = np.ones(len(table), dtype=bool)
        for c in self.conditions:
            hit &= c.holds(table)
        return hit

    def column(self, stats: Column) -> Column:
        out = F.lit(True)
        for c in self.conditions:
            out = out & c.column(stats)
        return out


def _grow(table: pd.DataFrame, bad: np.ndarray, max_conditions: int) -> list[Condition]:
    """Add the condition with the largest information gain until the rule covers bad rows only."""
    inside = np.ones(len(table), dtype=bool)
    found: list[Condition] = []
    while len(found) < max_conditions and bad[inside].any() and not bad[inside].all():
        y, n = bad[inside], int(inside.sum())
        before = np.log2(y.mean())
        best: tuple[float, Condition | None] = (1e-9, None)
        for feature in FEATURES:
            x = table[feature].to_numpy()[inside]
            order = np.argsort(x, kind="stable")
            xs, hits = x[order], np.cumsum(y[order])
            cut = np.flatnonzero(xs[1:] > xs[:-1])
            if not len(cut):
                continue
            for above in (False, True):
                good = hits[-1] - hits[cut] if above else hits[cut]
                size = n - cut - 1 if above else cut + 1
                gain = np.where(good > 0, good * (np.log2(np.maximum(good, 1) / size) - before), 0)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (float(gain[k]), Condition(feature, above, float((xs[cut[k]] + xs[cut[k] + 1]) / 2)))
        if best[1] is None:
            break
        found.append(best[1])
        inside &= best[1].holds(table)
    return found


def _prune(rule: list[Condition], table: pd.DataFrame, bad: np.ndarray) -> list[Condition]:
    """Cut trailing conditions where (right - wrong) / covered on unseen rows does not suffer."""

    def worth(conditions: list[Condition]) -> float:
        hit = Rule(tuple(conditions)).covers(table)
        return (2 * bad[hit].sum() - hit.sum()) / max(hit.sum(), 1) if hit.any() else -1.0

    best = rule
    for k in range(len(rule) - 1, 0, -1):
        if worth(rule[:k]) >= worth(best):
            best = rule[:k]
    return best


def learn(table: pd.DataFrame, bad: np.ndarray, max_rules: int = 12, max_conditions: int = 4, precision: float = 0.9, min_covered: int = 3) -> list[Rule]:
    """Decision list for the bad rows. ``table`` has :data:`FEATURES`; every third row is kept for pruning.

    A rule enters the list when it is right for at least ``precision`` of what it covers, in the growing and in the
    pruning part. Learning ends at the first rule that isn't. No bad rows, or none good, give an empty list.
    """
    if bad.all() or not bad.any():
        return []
    held = np.arange(len(table)) % 3 == 2
    rules: list[Rule] = []
    left = np.ones(len(table), dtype=bool)
    while len(rules) < max_rules:
        grow, prune = left & ~held, left & held
        if bad[grow].sum() < min_covered:
            break
        conditions = _grow(table[grow], bad[grow], max_conditions)
        if not conditions:
            break
        rule = Rule(tuple(_prune(conditions, table[prune], bad[prune])))
        hit = rule.covers(table)
        right = [bad[hit & part].mean() if (hit & part).any() else 0.0 for part in (grow, prune)]
        if (hit & grow).sum() < min_covered or min(right) < precision:
            break
        rules.append(rule)
        left &= ~hit
    return rules


def labelled_statistics(docs: DataFrame, labels: DataFrame, sample: int, id_col: str, text_col: str, label_col: str) -> tuple[pd.DataFrame, np.ndarray]:
    """Statistics and labels of at most ``sample`` labelled documents, those whose hashed ids come first."""
    marks = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label")).dropna()
    chosen = F.broadcast(marks.orderBy(F.xxhash64("_id"), "_id", "_label").limit(sample))
    rows = id_and_text(docs, id_col, text_col).join(chosen, F.col("doc_id") == F.col("_id")).select("text", "doc_id", "_label")
    stats = with_statistics(rows, "text").select("doc_id", "_label", "_stats.*")
    table = stats.limit(2 * sample).toPandas().sort_values(["doc_id", "_label", *FEATURES], ignore_index=True)
    order = pd.util.hash_array(table["doc_id"].astype(str).to_numpy()).argsort(kind="stable")
    table = table.iloc[order].reset_index(drop=True)
    return table, table["_label"].to_numpy() == 0


def assess(docs: DataFrame, labels: DataFrame, sample: int = 20_000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """``docs`` with columns ``_stats`` (struct), ``_base_failed``, ``_rule`` (number of the rule that rejects, or null) and ``_kept``.

    Rows: one for each input row, all input columns kept. A null or empty text has zero statistics and fails the base.
    Labels are fitted on at most ``sample`` labelled documents; without usable labels the list is empty and only the
    base rules decide. Input columns named like the four above are replaced.
    """
    rules = learn(*labelled_statistics(docs, labels, sample, id_col, text_col, label_col))
    own = [c for c in docs.columns if c not in ("_stats", "_base_failed", "_rule", "_kept")]
    out = with_statistics(docs.select(*own), text_col)
    s = F.col("_stats")
    failed = (s["n_words"] < MIN_WORDS) | (s["n_repeat_words"] * 100 > s["n_words"] * MAX_REPEAT_PERCENT)
    number = F.lit(None).cast("int")
    if rules:
        number = F.when(rules[0].column(s), F.lit(0))
        for k, rule in enumerate(rules[1:], 1):
            number = number.when(rule.column(s), F.lit(k))
    return out.withColumn("_base_failed", failed).withColumn("_rule", number).withColumn("_kept", ~failed & F.col("_rule").isNull())
