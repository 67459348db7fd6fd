"""Toxicity by compression distance.

Two zstandard dictionaries are made: one trained on ordinary text, and one of the words that set toxic text apart, behind the
same ordinary content. Every window of a few words is compressed with each; it is the shorter with the toxic dictionary the
more it has in common with toxic text. How many windows gain how many bytes is turned into a probability by
thresholds and weights calibrated on labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spherecube.llm import texts as tx
from spherecube.llm.common import id_and_text, stored
from spherecube.llm.labels import held_out, logistic, training_rows

PARTS, HELD_OUT = 5, 0
SAMPLE = 20_000
WINDOWS = (4, 6)
ORDINARY_BYTES = 262_144
ORDINARY_WINDOWS = 200_000
TOXIC_WORDS = 120
GAINS = (1, 2, 3, 4, 5)
LEVEL = 3


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]


@lru_cache(maxsize=2)
def _compressors(ordinary: bytes, toxic: bytes):
    out = []
    for content in (ordinary, ordinary + toxic):
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(level=LEVEL)
        out.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=False, write_content_size=False, write_dict_id=False))
    return out


def windows(words: tx.Words, raw: bytes, size: int) -> tuple[np.ndarray, list[bytes]]:
    """Row and bytes of all windows of ``size`` words, the last of a text with what is left; ``raw`` is the lower-cased text."""
    inside = np.arange(len(words.row)) - words.bounds[words.row]
    first = np.flatnonzero(inside % size == 0)
    last = np.minimum(first + size, words.bounds[words.row[first] + 1]) - 1
    cut = zip(words.starts[first].tolist(), words.ends[last].tolist(), strict=True)
    return words.row[first], [b" " + raw[a:b] + b" " for a, b in cut]


def features(texts: tx.Texts, ordinary: bytes, toxic: bytes) -> np.ndarray:
    """For each text and window size: largest gain, share and (log) number of windows that gain each of GAINS, log number of windows."""
    plain, marked = _compressors(ordinary, toxic)
    words, raw = texts.words(tx.SPACED, lower=True), tx.LOWER[texts.data].tobytes()
    columns: list[np.ndarray] = []
    for size in WINDOWS:
        row, parts = windows(words, raw, size)
        gain = np.array([len(plain.compress(x)) - len(marked.compress(x)) for x in parts], dtype=np.int64)
        count = np.bincount(row, minlength=texts.n)
        most = np.zeros(texts.n)
        np.maximum.at(most, row, gain)
        over = [np.bincount(row[gain >= g], minlength=texts.n) for g in GAINS]
        columns += [most, *[30 * x / (count + 4) for x in over], *[np.log1p(x) for x in over], np.log1p(count)]
    return np.column_stack(columns)


def _distinctive(rows: DataFrame, words: int) -> list[str]:
    """Words of toxic documents that ordinary ones hardly have, the most telling last (nearest in a dictionary)."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in tx.chunks(batches, "text"):
            w = texts.words(tx.ALNUM, lower=True)
            _, first = np.unique(tx.salted(w.hashes, w.row), return_index=True)
            raw = tx.LOWER[texts.data].tobytes()
            spelled = [raw[a:b].decode() for a, b in zip(w.starts[first].tolist(), w.ends[first].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(spelled, pa.string()), part.column("label").take(pa.array(w.row[first]))], names=["word", "label"])

    totals = rows.groupBy().agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("o")).first()
    counts = rows.select("text", "label").mapInArrow(compute, "word string, label int").filter(F.length("word") > 3)
    counts = counts.groupBy("word").agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("o")).filter("t > 1")
    lift = F.log(((F.col("t") + 0.1) / float(totals["t"])) / ((F.col("o") + 0.5) / float(totals["o"])))
    best = counts.withColumn("lift", lift).filter("lift > 2").orderBy((F.col("t") * F.col("lift")).desc(), "word").limit(words)
    return [r["word"] for r in best.select("word", "t", "lift").collect()][::-1]


def _ordinary(rows: DataFrame, limit: int, size: int) -> bytes:
    """Content of a dictionary trained on windows of ordinary documents."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in tx.chunks(batches, "text"):
            yield pa.RecordBatch.from_arrays([pa.array(windows(texts.words(tx.SPACED, lower=True), tx.LOWER[texts.data].tobytes(), 8)[1], pa.binary())], names=["part"])

    parts = rows.filter("label = 0").select("text").mapInArrow(compute, "part binary")
    samples = [bytes(r[0]) for r in parts.orderBy(F.xxhash64("part"), "part").limit(limit).collect()]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself
        return b"".join(samples)[:size]


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model | float:
    """Dictionaries and weights from at most ``sample`` labelled rows; with one class only, that class as a number."""
    rows = stored(training_rows(docs, labels, label_col, PARTS, HELD_OUT, sample, id_col, text_col), "training")
    count = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if count[1] in (0, count[0]):
        return 1.0 if count[1] else 0.0
    ordinary = _ordinary(rows, ORDINARY_WINDOWS, ORDINARY_BYTES)
    toxic = b" ".join([b"", *[w.encode() for w in _distinctive(rows, TOXIC_WORDS)], b""])

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in tx.chunks(batches, "text"):
            x = features(texts, ordinary, toxic)
            yield pa.RecordBatch.from_arrays([part.column("label"), pa.array(list(x), pa.list_(pa.float64()))], names=["label", "x"])

    table = rows.select("text", "label").mapInArrow(compute, "label int, x array<double>").toPandas()
    mean, scale, weights = logistic(np.vstack(table["x"]), table["label"].to_numpy())
    return Model(ordinary, toxic, tuple(mean), tuple(scale), tuple(weights))


def score(docs: DataFrame, model: Model | float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every row; null and empty texts are scored as texts without windows."""
    docs = id_and_text(docs, id_col, text_col)
    if isinstance(model, float):
        return docs.select("doc_id", F.lit(model).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        mean, scale, weights = (np.array(x) for x in (m.mean, m.scale, m.weights))
        for part, texts in tx.chunks(batches, "text"):
            x = (features(texts, m.ordinary, m.toxic) - mean) / scale
            p = 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(p)], names=["doc_id", "score"])

    return docs.mapInArrow(compute, f"doc_id {dict(docs.dtypes)['doc_id']}, score double")


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """doc_id, held_out, score, predicted (score >= 0.5) of every row, repeated rows included.

    Learns from rows that aren't held out (CRC of the id modulo 5 is not 0). Without labels every score is 0.
    """
    scored = score(docs, fit(docs, labels, sample, id_col, text_col, label_col), id_col, text_col)
    return scored.select("doc_id", held_out("doc_id", PARTS, HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
