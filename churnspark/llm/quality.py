"""Quality scores by nearest-neighbour voting among labelled latent-semantic vectors."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark.llm.labelled import draw_labelled
from churnspark.llm.rows import blocks_of, with_text_columns
from churnspark.llm.words import LOWER, split_words, word_hashes

EACH = 2_000  # distinct labelled texts of each label that vote, at most
WORDS, ENDS, SHAPES = 4096, 2048, 2048  # hashed words; hashed last three bytes; shapes and repeats
REPEATS = (0.05, 0.1, 0.2, 0.3, 0.5)  # shares of immediately repeated words, each a feature once it is reached
FEATURES = WORDS + ENDS + SHAPES
DIMENSIONS = 48
NEIGHBOURS = 15
SHARPNESS = 4  # power of the similarity that weighs a neighbour

# Kinds of bytes: 0 other signs, 1 digit, 2 lower case, 3 upper case, 4 end of sentence, 5 beyond ASCII
KIND = np.zeros(256, np.int64)
KIND[48:58], KIND[97:123], KIND[65:91], KIND[128:] = 1, 2, 3, 5
KIND[[44, 46]] = 4


def features(texts: list[bytes | None]) -> np.ndarray:
    """One row per text: log(1 + count) of its words, word ends, word shapes and repeats."""
    words = split_words(texts)
    lowered = words._replace(data=LOWER[words.data])
    hashes = word_hashes(lowered)
    data, last = words.data, words.ends - 1
    size = words.ends - words.starts
    end = data[last].astype(np.int64)
    end += np.where(size > 1, data[np.maximum(last - 1, 0)], 0).astype(np.int64) * 256
    end += np.where(size > 2, data[np.maximum(last - 2, 0)], 0).astype(np.int64) * 65536
    ending = (end * 2654435761 >> 7) % ENDS
    middle = (words.starts + last) // 2
    shape = ((KIND[data[words.starts]] * 6 + KIND[data[middle]]) * 6 + KIND[data[last]]) * 8 + np.minimum(size, 7) if len(size) else size
    text_of = words.text_of
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (text_of[1:] == text_of[:-1])
    row = text_of * FEATURES
    cells = np.concatenate([
        row + (hashes % np.uint64(WORDS)).astype(np.int64),
        row + WORDS + ending,
        row + WORDS + ENDS + shape,
    ])
    counts = np.bincount(cells, minlength=len(texts) * FEATURES).reshape(len(texts), FEATURES)
    n = np.diff(words.first)
    share = np.bincount(text_of[again], minlength=len(texts)) / np.maximum(n, 1)
    counts[:, FEATURES - len(REPEATS) :] = (share[:, None] >= np.array(REPEATS)) * n[:, None]
    return np.log1p(counts, dtype=np.float32)


def unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length > 0, length, 1)


class QualityModel(NamedTuple):
    rarity: np.ndarray  # inverse document frequency of each feature
    space: np.ndarray  # features x dimensions
    vectors: np.ndarray  # labelled documents in that space, unit length
    labels: np.ndarray
    weights: np.ndarray  # how many distinct labelled texts each stands for
    base: float  # share of label 1


def latent_space(rows: np.ndarray, dimensions: int, seed: int = 7) -> np.ndarray:
    """The leading right singular vectors, by subspace iteration."""
    dimensions = min(dimensions, *rows.shape)
    basis = np.random.default_rng(seed).standard_normal((rows.shape[1], min(dimensions + 16, *rows.shape))).astype(np.float32)
    for _ in range(5):
        basis = np.linalg.qr(rows.T @ (rows @ basis))[0]
    _, _, turn = np.linalg.svd(rows @ basis, full_matrices=False)
    return (basis @ turn.T)[:, :dimensions].astype(np.float32)


def fit_quality_model(
    docs: DataFrame, text_col: str = "text", label_col: str = "quality", each: int = EACH, labels: DataFrame | None = None, id_col: str = "doc_id"
) -> QualityModel:
    """Fit on at most ``each`` distinct texts of label 0 and of label 1, drawn by hash rank.

    The label is a column of ``docs`` or, joined by ``id_col``, of ``labels``; texts themselves do not take part in
    that join. The term vectors of the drawn texts (sparse, computed by the executors) come to the driver, which
    finds the latent space; the bound is the parameter. Copies of a text vote once, and a vote weighs as many
    distinct texts of its label as it was drawn from. Without labelled rows every text scores one half.
    """
    known = draw_labelled(docs, label_col, each, text_col, labels, id_col).where("CAST(label AS INT) IN (0, 1)")
    known = known.select("text", F.col("label").cast("int").alias("label"), "of")

    def sparse(batches):
        for batch in batches:
            start = 0
            for texts in blocks_of(batch.column(0).cast(pa.large_binary())):
                rows = features(texts)
                at = [np.flatnonzero(r).astype(np.int32) for r in rows]
                yield pa.RecordBatch.from_pydict({
                    "at": pa.array(at, pa.list_(pa.int32())),
                    "value": pa.array([r[i] for r, i in zip(rows, at, strict=True)], pa.list_(pa.float32())),
                    "label": batch.column(1).slice(start, len(texts)),
                    "of": batch.column(2).slice(start, len(texts)),
                })
                start += len(texts)

    got = known.mapInArrow(sparse, "at array<int>, value array<float>, label int, of long").collect()
    if not got:
        none = np.zeros((0, 1), np.float32)
        return QualityModel(np.ones(FEATURES, np.float32), np.zeros((FEATURES, 1), np.float32), none, np.zeros(0), np.zeros(0), 0.5)
    got.sort(key=lambda r: (r.label, r.at, r.value))  # the fit does not depend on the order of partitions
    rows = np.zeros((len(got), FEATURES), np.float32)
    for i, r in enumerate(got):
        rows[i, r.at] = r.value
    labels = np.array([r.label for r in got], np.float64)
    weights = np.array([r.of for r in got], np.float64)
    for label in (0, 1):
        weights[labels == label] /= max(1, (labels == label).sum())
    del got
    rarity = (np.log((1 + len(rows)) / (1 + (rows > 0).sum(axis=0))) + 0.1).astype(np.float32)
    rows = unit(rows * rarity)
    space = latent_space(rows, DIMENSIONS)
    return QualityModel(rarity, space, unit(rows @ space), labels, weights, float(np.average(labels, weights=weights)))


def vote(model: QualityModel, texts: list[bytes | None]) -> np.ndarray:
    """Similarity-weighted share of label 1 among the nearest labelled documents of each text."""
    found = np.full(len(texts), model.base)
    if not len(model.vectors):
        return found
    latent = unit((features(texts) * model.rarity) @ model.space)
    likeness = latent @ model.vectors.T  # exact cosines with every labelled document
    k = min(NEIGHBOURS, likeness.shape[1])
    near = np.argpartition(-likeness, k - 1, axis=1)[:, :k]
    weight = np.maximum(np.take_along_axis(likeness, near, axis=1), 0).astype(np.float64) ** SHARPNESS * model.weights[near]
    total = weight.sum(axis=1)
    some = total > 0
    found[some] = (weight * model.labels[near]).sum(axis=1)[some] / total[some]
    return np.clip(found, 0.0, 1.0)


def score_quality(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with score (0 to 1, higher: label 1 likelier) and predicted (score >= 0.5).

    Every text is compared with all labelled vectors; the nearest 15 vote, weighted by the fourth power of
    their cosine and the number of texts they stand for. A null, empty or wordless text has no direction and gets the labels' base rate. Columns named
    score or predicted are replaced, repeated rows score alike, an empty table gives no rows.
    """
    schema = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(texts: list[bytes | None]) -> dict[str, pa.Array]:
        score = vote(model, texts)
        return {"score": pa.array(score), "predicted": pa.array((score >= 0.5).astype(np.int32))}

    return with_text_columns(docs, text_col, run, schema)
