"""Quality by compression: a text is like the labelled texts whose dictionary shortens it more.

Two zstandard dictionaries are built, from texts labelled good and bad. A text is compressed whole with
each; the difference of the two sizes, divided by the square root of its length (the spread of the
difference grows like that), becomes a probability by a logistic curve fitted to labelled texts that
neither dictionary has seen. The curve also knows how far the good dictionary shortens the text: both
dictionaries shorten endless repetition alike, so their difference alone says little about it.

Fitting uses a bounded sample: at most ``PER_LABEL`` rows of each label, chosen by a hash of id and text, each
text whole. Scoring uses every text whole.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scoremill.llm.common import fold, per_batch, table

PER_LABEL = 2_400
DICTIONARY_BYTES = 112_640
LEVEL = 3
#: Added to the length, so that the difference counts less in very short texts.
SHORT = 500
CUT = 0.3

_loaded: dict = {}


@dataclass(frozen=True)
class Model:
    """Dictionaries and the curve ``1 / (1 + exp(-(measures @ slopes + offset)))``."""

    good: bytes
    bad: bytes
    slopes: tuple[float, ...]
    offset: float


class Sizes:
    """Normalised size difference under the two dictionaries, and the log of the shortening."""

    def __init__(self, good: bytes, bad: bytes):
        self.good, self.bad = self._compressor(good), self._compressor(bad)

    @staticmethod
    def _compressor(dictionary: bytes):
        data = zstandard.ZstdCompressionDict(dictionary)
        data.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(
            level=LEVEL, dict_data=data, write_checksum=False, write_content_size=False, write_dict_id=False
        )

    def __call__(self, text: str | None) -> tuple[float, float]:
        data = text.encode() if text else b""
        good, bad = len(self.good.compress(data)), len(self.bad.compress(data))
        return (bad - good) / (len(data) + SHORT) ** 0.5, math.log((good + 20) / (len(data) + 50))


def dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary, or the texts themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(texts)[-DICTIONARY_BYTES:]


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 60) -> tuple[tuple[float, ...], float]:
    """Slopes and offset of greatest likelihood, held back a little so that they always exist."""
    inputs = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    weights = np.zeros(inputs.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(inputs @ weights, -30, 30)))
        slope = inputs.T @ (y - p) - 0.01 * weights
        curve = (inputs * (p * (1 - p))[:, None]).T @ inputs + 0.01 * np.eye(len(weights))
        step = np.clip(np.linalg.solve(curve, slope), -5, 5)
        weights = weights + step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(weights[:-1].tolist()), float(weights[-1])


def fit(texts: list[str], labels: list[int]) -> Model | float:
    """A model, or the share of label 1 (0.5 of none) if there are no two labels to tell apart.

    Texts alternate between building the dictionaries and fitting the curve.
    """
    halves: dict[int, list[list[str]]] = {0: [[], []], 1: [[], []]}
    seen = [0, 0]
    for text, label in zip(texts, labels, strict=True):
        halves[label][seen[label] % 2].append(text)
        seen[label] += 1
    if min(seen) < 2:
        return (seen[1] + 1) / (sum(seen) + 2)
    good, bad = (dictionary([t.encode() for t in halves[label][0]]) for label in (1, 0))
    sizes = Sizes(good, bad)
    x = np.array([sizes(t) for label in (0, 1) for t in halves[label][1]])
    y = np.repeat([0.0, 1.0], [len(halves[0][1]), len(halves[1][1])])
    return Model(good, bad, *logistic(x, y))


def learn(docs: DataFrame, labels: DataFrame, held_out_fold: int = 0, folds: int = 5) -> Model | float:
    """Fit on rows of ``docs (doc_id, text)`` with a label 0 or 1, but for those of the held-out fold.

    Rows without a text play no part. An id with both labels gives a row of each; rows equal in id, text and label
    are one. Ties of the hash go by id and label, so the choice is the same in every run.
    """
    usable = labels.where(F.col("quality").isin(0, 1) & (fold("doc_id", folds) != held_out_fold))
    usable = usable.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_label"))
    keys = docs.where(F.col("text") != "").select("doc_id", F.xxhash64("text").alias("_key"))
    rows = keys.join(usable, F.col("doc_id") == F.col("_id")).select("_id", "_key", "_label")
    counts = dict(rows.groupBy("_label").count().collect())  # two rows
    if not counts:
        return 0.5
    order = Window.partitionBy("_label").orderBy(F.xxhash64("_id", "_key"), "_id", "_key")
    chosen = rows.distinct().withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= PER_LABEL)
    # 2 * PER_LABEL keys at most, and as many texts.
    same = (docs["doc_id"] == F.col("_id")) & (F.xxhash64(docs["text"]) == F.col("_key"))
    texts = docs.join(F.broadcast(chosen), same).select("_label", "_place", "_id", "text").distinct()
    kept = sorted(texts.collect(), key=lambda r: (r["_label"], r["_place"], r["text"]))
    model = fit([r["text"] for r in kept], [r["_label"] for r in kept])
    if isinstance(model, float):
        return model
    taken = {label: sum(r["_label"] == label for r in kept) for label in (0, 1)}
    # The sample may hold the labels in other shares than the tables do.
    shift = np.log(counts[1] / counts[0]) - np.log(taken[1] / taken[0])
    return Model(model.good, model.bad, model.slopes, float(model.offset + shift))


def score(docs: DataFrame, model: Model | float, text: str = "text") -> DataFrame:
    """``docs`` with ``score``: the probability of label 1.

    Null and empty texts are scored alike, repeated rows each; a ``score`` column is replaced, others stay.
    """
    if isinstance(model, float):
        return docs.withColumn("score", F.lit(model))

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        sizes = per_batch(_loaded, Sizes, model.good, model.bad)
        measures = np.array([sizes(t) for t in texts], float).reshape(-1, 2)
        return pd.Series(1 / (1 + np.exp(-np.clip(measures @ model.slopes + model.offset, -500, 500))))

    return docs.withColumn("score", scored(F.col(text)))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all ``documents`` by what ``labels`` mark; nulls, repeats and empty tables as in ``learn``, ``score``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    scored = score(docs, model).select("doc_id", held_out, "score")
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
