"""Quality classifier on document statistics.

Random Fourier features approximate a Gaussian kernel over standardised statistics of a
text; every task sums its part of the normal equations, Spark adds the parts up, and the
small ridge system is solved once.  Scores of rows that the fit has not seen are binned
and made monotone by isotonic regression, which turns a score into a probability.
Labels enter the fit and the calibration only; the score of a document is a function of
its text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.document_stats import measure
from marketlake.llm.text import Chunk, filter_rows, map_chunks
from marketlake.session import materialize

FEATURES = [
    "log_words", "word_length", "symbols", "dup_lines", "repeats", "capitals", "digits", "shouts",
    "stops", "high_bytes", "short_words", "distinct", "top_word", "bare_symbols", "longest",
    "lines", "echoes",
]
N_FOURIER = 160
RIDGE = 1e-3
SCORE_BINS = 400


@dataclass
class QualityModel:
    """Everything a score needs; its size does not depend on the data."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def embed(self, rows: np.ndarray) -> np.ndarray:
        unit = np.clip((rows - self.mean) / self.scale, -6, 6)
        waves = np.cos(unit @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([waves, np.ones((len(rows), 1))])

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return self.embed(rows) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(rows), self.knots, self.levels), 0.0, 1.0)


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; -1 for a null id, which has no label."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts, F.lit(-1))


def feature_table(chunk: Chunk) -> np.ndarray:
    """A row of ``FEATURES`` a document of the chunk."""
    m = {k: v.astype(np.float64) for k, v in measure(chunk).items()}
    words = np.maximum(m["n_words"], 1)
    letters = np.maximum(m["n_upper"] + m["n_lower"], 1)
    share = lambda name, whole=words: np.sqrt(m[name] / whole)
    return np.column_stack([
        np.log1p(m["n_words"]), m["word_chars"] / words, share("n_symbols"),
        share("n_dup_lines", np.maximum(m["n_lines"], 1)), share("n_repeat_words"),
        share("n_upper", letters), share("n_digits"), share("n_shouts"), share("n_stops"),
        share("n_high", np.maximum(m["word_chars"], 1)), share("n_short_words"),
        m["n_distinct_words"] / words, share("n_top_word"), share("n_bare_symbols"),
        np.log1p(m["longest_word"]), share("n_lines"), share("n_echoes"),
    ])


def text_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ``features``): statistics of every whole text; null and empty texts count as zero words.

    Only the two columns are read, so further columns and their names do not matter.
    """
    def features(chunk: Chunk) -> dict[str, pa.Array]:
        table = feature_table(chunk)
        at = np.arange(0, table.size + 1, len(FEATURES), dtype=np.int32)
        flat = pa.array(table.ravel().astype(np.float32))
        return {"features": pa.ListArray.from_arrays(pa.array(at), flat)}

    return map_chunks(docs, [id_col], text_col, features, "features array<float>")


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    column = batch.column(batch.schema.names.index(name))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES)).astype(np.float64)


def _normal_equations(model: QualityModel, train: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sums of z zT and z y over all rows, added up per task and then by Spark."""
    size = N_FOURIER + 1
    above = np.triu_indices(size)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, right = np.zeros((size, size)), np.zeros(size)
        seen = 0
        for batch in batches:
            z = model.embed(_matrix(batch, "features"))
            y = batch.column(batch.schema.names.index("label")).to_numpy(zero_copy_only=False)
            gram += z.T @ z
            right += z.T @ y
            seen += len(z)
        if seen:
            values = np.concatenate([gram[above], right])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], ["k", "v"])

    sums = train.select("features", "label").mapInArrow(parts, "k int, v double")
    found = sums.groupBy("k").agg(F.sum("v").alias("v")).toPandas().sort_values("k")["v"].to_numpy()
    gram, right = np.zeros((size, size)), np.zeros(size)
    if len(found):
        gram[above] = found[: len(above[0])]
        gram = gram + np.triu(gram, 1).T
        right = found[len(above[0]):]
    return gram, right


def _isotonic(bins: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over (x, n, positives), sorted by x; returns knots and levels."""
    blocks: list[list[float]] = []
    for x, n, positive in bins.sort_values("x")[["x", "n", "positive"]].itertuples(index=False):
        blocks.append([x * n, n, positive])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    knots = np.array([b[0] / b[1] for b in blocks])
    levels = np.array([(b[2] + 0.5) / (b[1] + 1.0) for b in blocks])
    return knots, np.maximum.accumulate(levels)


def _score_frame(rows: DataFrame, model: QualityModel, output: str, calibrated: bool) -> DataFrame:
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = _matrix(batch, "features")
            found = model.score(table) if calibrated else model.raw(table)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*names, output])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{fields}, `{output}` double")


def fit(train: DataFrame, features: DataFrame, seed: int = 11) -> QualityModel:
    """Fit on ``train`` (features, label 0/1, ``calibrate`` boolean).

    ``features`` gives mean and spread over all documents, labelled or not.  Rows with
    ``calibrate`` are left out of the regression and shape the isotonic map.  Without
    labelled rows every score is 0.5.
    """
    at = [F.col("features")[k].cast("double") for k in range(len(FEATURES))]
    moments = features.agg(
        *[F.avg(c).alias(f"m{k}") for k, c in enumerate(at)],
        *[F.stddev_pop(c).alias(f"s{k}") for k, c in enumerate(at)],
    ).first()
    mean = np.array([moments[f"m{k}"] or 0.0 for k in range(len(FEATURES))])
    scale = np.array([moments[f"s{k}"] or 0.0 for k in range(len(FEATURES))])
    rng = np.random.default_rng(seed)
    model = QualityModel(
        mean, np.where(scale > 1e-9, scale, 1.0),
        rng.normal(0, 1 / np.sqrt(len(FEATURES)), (len(FEATURES), N_FOURIER)),
        rng.uniform(0, 2 * np.pi, N_FOURIER), np.zeros(N_FOURIER + 1),
        np.array([0.0, 1.0]), np.array([0.5, 0.5]),
    )
    gram, right = _normal_equations(model, train.filter(~F.col("calibrate")))
    n = gram[-1, -1]
    if n == 0:
        return model
    penalty = RIDGE * n * np.eye(len(gram))
    penalty[-1, -1] = 1e-9 * n
    model.weights = np.linalg.solve(gram + penalty, right)
    raw = _score_frame(train.filter("calibrate").select("features", "label"), model, "raw", False)
    bins = raw.groupBy(F.round(F.col("raw") * SCORE_BINS).alias("bin")).agg(
        F.avg("raw").alias("x"), F.count(F.lit(1)).alias("n"), F.sum("label").alias("positive")
    ).filter(F.col("x").between(-10, 10)).toPandas()
    if len(bins):
        model.knots, model.levels = _isotonic(bins)
    else:
        share = right[-1] / n
        model.levels = np.array([share, share])
    return model


def training_rows(features: DataFrame, labels: DataFrame, held_out: Column,
                  label: str = "quality", id_col: str = "doc_id") -> DataFrame:
    """Features with a 0/1 label for documents outside the held-out fold.

    A document with several labels takes their mean; null labels and ids are ignored.
    A fifth of the rows, by a hash of the id, is set apart for calibration.
    """
    marked = labels.filter(F.col(id_col).isNotNull() & F.col(label).isNotNull()).groupBy(
        F.col(id_col)).agg(F.avg(F.col(label).cast("double")).alias("label"))
    rows = features.select(id_col, "features").filter(~held_out).join(marked, id_col)
    return rows.withColumn("calibrate", F.pmod(F.xxhash64(id_col), F.lit(5)) == 0)


def _fitted(docs: DataFrame, labels: DataFrame, parts: int, held: int) -> tuple[DataFrame, QualityModel]:
    features = materialize(text_features(docs), "quality-features")
    held_out = fold("doc_id", parts) == held
    return features, fit(training_rows(features, labels, held_out), features)


def classify(docs: DataFrame, labels: DataFrame, parts: int = 5, held: int = 0,
             threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Rows whose id has crc32 modulo ``parts`` equal to ``held`` never lend a label.
    """
    features, model = _fitted(docs, labels, parts, held)
    held_out = fold("doc_id", parts) == held
    scored = _score_frame(features, model, "score", True)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )




def accepted(docs: DataFrame, labels: DataFrame, parts: int = 5, held: int = 0,
             threshold: float = 0.3) -> DataFrame:
    """Rows of ``docs`` that score ``threshold`` at least, with all their columns.

    Rows are scored again where they are read, which costs time but moves no text.
    """
    _, model = _fitted(docs, labels, parts, held)
    return filter_rows(docs, "text", lambda chunk: model.score(feature_table(chunk).astype(np.float32)
                                                               .astype(np.float64)) >= threshold)
