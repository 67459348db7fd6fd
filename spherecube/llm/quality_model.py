"""Quality classifier: a factorisation machine over hashed words, structure statistics and size.

Every pair of features interacts through the product of short vectors. Scoring is linear in the number of features:
the sum over pairs of <v_i, v_j> x_i x_j is half of (sum of v x) squared minus the sum of (v x) squared.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spherecube.llm import quality_rules
from spherecube.llm import texts as tx
from spherecube.llm.common import id_and_text
from spherecube.llm.labels import held_out, training_rows

PARTS, HELD_OUT = 4, 2
SAMPLE = 8_000
BUCKETS = 1 << 16
RANK = 8
BINS = 8
EPOCHS = 8
THRESHOLD = 0.7
STATS = tuple(f for f in quality_rules.FEATURES if f != "n_words")
#: what the text's size says: words, characters and bytes, by powers of two
SIZES = ("n_words", "word_chars", "n_bytes")
SIZE_BINS = 32


@dataclass
class Model:
    edges: np.ndarray  # (statistics, BINS - 1)
    bias: float
    linear: np.ndarray
    factors: np.ndarray


def raw_features(texts: tx.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket) of the distinct hashed words of each text, sorted by row; statistics; sizes as powers of two."""
    words = texts.words(tx.SPACED, lower=False)
    bucket = (words.hashes & np.uint64(BUCKETS - 1)).astype(np.int64)
    pair = np.unique(words.row * BUCKETS + bucket)
    stats = quality_rules.statistics(texts)
    stats["n_bytes"] = np.diff(texts.offsets)
    sizes = np.column_stack([np.log2(stats[s] + 1.0).astype(np.int64) for s in SIZES])
    return pair // BUCKETS, pair % BUCKETS, np.column_stack([stats[s] for s in STATS]), np.minimum(sizes, SIZE_BINS - 1)


def assemble(row, bucket, stats, sizes, edges) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value) of all features, sorted by row. Words of a text have together the length one."""
    n, k = stats.shape
    count = np.bincount(row, minlength=n)
    bins = np.column_stack([np.searchsorted(edges[j], stats[:, j], side="right") for j in range(k)]) if n else np.zeros((0, k), np.int64)
    own = np.concatenate([BUCKETS + np.arange(k) * BINS + bins, BUCKETS + k * BINS + np.arange(len(SIZES)) * SIZE_BINS + sizes], axis=1)
    rows = np.concatenate([row, np.repeat(np.arange(n), own.shape[1])])
    features = np.concatenate([bucket, own.ravel()])
    values = np.concatenate([1 / np.sqrt(np.maximum(count[row], 1)), np.full(own.size, 1 / np.sqrt(own.shape[1]))])
    order = np.argsort(rows, kind="stable")
    return rows[order], features[order], values[order]


def margins(model: Model, row: np.ndarray, feature: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Score before the logistic function, and the sums of v x by factor. Every text has features, so no row is empty."""
    begin = np.searchsorted(row, np.arange(n))
    vx = model.factors[feature] * value[:, None]
    total = np.add.reduceat(vx, begin, axis=0) if n else np.zeros((0, RANK))
    square = np.add.reduceat((vx * vx).sum(axis=1), begin) if n else np.zeros(0)
    linear = np.add.reduceat(model.linear[feature] * value, begin) if n else np.zeros(0)
    return model.bias + linear + 0.5 * ((total * total).sum(axis=1) - square), total


def train(row, bucket, stats, sizes, label: np.ndarray, epochs: int = EPOCHS, rate: float = 0.1, decay: float = 1e-4, batch: int = 128) -> Model:
    """Adaptive gradient descent on the logistic loss over shuffled batches."""
    n = len(label)
    edges = np.array([np.quantile(stats[:, j], np.linspace(0, 1, BINS + 1)[1:-1]) for j in range(stats.shape[1])])
    row, feature, value = assemble(row, bucket, stats, sizes, edges)
    random = np.random.default_rng(5)
    size = BUCKETS + stats.shape[1] * BINS + len(SIZES) * SIZE_BINS
    share = np.clip(label.mean(), 1e-3, 1 - 1e-3)
    model = Model(edges, float(np.log(share / (1 - share))), np.zeros(size), random.normal(0, 0.05, (size, RANK)))
    linear_sum, factor_sum = np.full(size, 1e-3), np.full((size, RANK), 1e-3)
    bounds = np.searchsorted(row, np.arange(n + 1))
    for _ in range(epochs):
        order = random.permutation(n)
        for at in range(0, n, batch):
            chosen = np.sort(order[at : at + batch])
            take = np.concatenate([np.arange(bounds[i], bounds[i + 1]) for i in chosen])
            local = np.repeat(np.arange(len(chosen)), bounds[chosen + 1] - bounds[chosen])
            f, x = feature[take], value[take]
            z, total = margins(model, local, f, x, len(chosen))
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label[chosen])[local]
            used, slot = np.unique(f, return_inverse=True)
            g_linear = np.bincount(slot, error * x) + decay * model.linear[used]
            each = (error * x)[:, None] * (total[local] - model.factors[f] * x[:, None])
            g_factor = np.column_stack([np.bincount(slot, each[:, k]) for k in range(RANK)]) + decay * model.factors[used]
            linear_sum[used] += g_linear**2
            factor_sum[used] += g_factor**2
            model.linear[used] -= rate * g_linear / np.sqrt(linear_sum[used])
            model.factors[used] -= rate * 0.5 * g_factor / np.sqrt(factor_sum[used])
            model.bias -= rate * 0.1 * float(error[np.searchsorted(local, np.arange(len(chosen)))].mean())
    return model


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model | float:
    """A model from at most ``sample`` labelled rows; with one class only, that class as a number; without rows 1."""
    rows = training_rows(docs, labels, label_col, PARTS, HELD_OUT, sample, id_col, text_col)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in tx.chunks(batches, "text"):
            row, bucket, stats, sizes = raw_features(texts)
            bounds = np.searchsorted(row, np.arange(texts.n + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("label"), pa.ListArray.from_arrays(pa.array(bounds), pa.array(bucket.astype(np.int32))), pa.array(list(stats), pa.list_(pa.float64())), pa.array(list(sizes), pa.list_(pa.int64()))],
                names=["doc_id", "label", "buckets", "stats", "sizes"],
            )

    kind = dict(rows.dtypes)["doc_id"]
    table = rows.mapInArrow(compute, f"doc_id {kind}, label int, buckets array<int>, stats array<double>, sizes array<bigint>")
    table = table.limit(2 * sample).toPandas()
    label = table["label"].to_numpy(dtype=np.float64)
    if not len(label) or label.min() == label.max():
        return float(label[0]) if len(label) else 1.0
    keys = table["doc_id"].astype(str) + " " + table["stats"].astype(str)
    table = table.iloc[np.argsort(keys.to_numpy(), kind="stable")]
    label = table["label"].to_numpy(dtype=np.float64)
    lengths = table["buckets"].map(len).to_numpy()
    row = np.repeat(np.arange(len(table)), lengths)
    bucket = np.concatenate([np.asarray(b, dtype=np.int64) for b in table["buckets"]])
    return train(row, bucket, np.vstack(table["stats"]), np.vstack(table["sizes"]), label)


def score(docs: DataFrame, model: Model | float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every row; null and empty texts are scored by their statistics and sizes."""
    docs = id_and_text(docs, id_col, text_col)
    if isinstance(model, float):
        return docs.select("doc_id", F.lit(model).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for part, texts in tx.chunks(batches, "text"):
            z, _ = margins(m, *assemble(*raw_features(texts), m.edges), texts.n)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], names=["doc_id", "score"])

    return docs.mapInArrow(compute, f"doc_id {dict(docs.dtypes)['doc_id']}, score double")


def quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """doc_id, held_out, score, predicted (score >= 0.7) of every row, repeated rows included.

    Learns from rows that aren't held out (CRC of the id modulo 4 is not 2); neither labels nor lang, source or doc_id
    are inputs of a score. Without labels every score is 1.
    """
    scored = score(docs, fit(docs, labels, sample, id_col, text_col, label_col), id_col, text_col)
    return scored.select("doc_id", held_out("doc_id", PARTS, HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
