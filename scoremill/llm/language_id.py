"""Language of a text by a convolutional network over bytes, trained in numpy.

Windows of ``LENGTH`` bytes pass filters of several widths; the strongest response of each filter in the
window goes to a softmax over languages. A text's probabilities are the mean over all its windows.

Training uses a bounded sample: at most ``PER_LANGUAGE`` rows of each language, chosen by a hash of id and
text, and of each ``WINDOWS_PER_TEXT`` windows from anywhere in the text. Prediction reads every text whole.
There, the embedding is folded into the filters, and neighbouring bytes are looked up as pairs.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scoremill.llm.common import fold, per_batch, table

LENGTH, EMBEDDED, FILTERS, WIDTHS = 128, 8, 16, (2, 3, 4)
PER_LANGUAGE, WINDOWS_PER_TEXT = 500, 8
EPOCHS, BATCH, RATE = 10, 64, 0.01
UNKNOWN = "und"
#: Windows that are looked up at a time.
AT_ONCE = 512

_loaded: dict = {}


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    embedding: np.ndarray
    filters: tuple[np.ndarray, ...]
    biases: tuple[np.ndarray, ...]
    out: np.ndarray
    out_bias: np.ndarray


def windows(text: str) -> np.ndarray:
    """All bytes of a text in windows; the last one reaches back, a short text is padded with zeros."""
    data = np.frombuffer(text.encode(), np.uint8)
    if len(data) <= LENGTH:
        return np.pad(data, (0, LENGTH - len(data)))[None]
    full = data[: len(data) // LENGTH * LENGTH].reshape(-1, LENGTH)
    return full if len(data) % LENGTH == 0 else np.concatenate([full, data[None, -LENGTH:]])


def train(texts: list[str], languages: list[str], seed: int = 7) -> Model | None:
    """A network fitted by Adam on windows of the texts; none without texts."""
    return train_on_windows([drawn_windows(text) for text in texts], languages, seed)


def drawn_windows(text: str) -> np.ndarray:
    """Some windows of a text, from anywhere in it; the same ones each time."""
    own = windows(text)
    return own[np.random.default_rng(zlib.crc32(text.encode())).permutation(len(own))[:WINDOWS_PER_TEXT]]


def train_on_windows(drawn: list[np.ndarray], languages: list[str], seed: int = 7) -> Model | None:
    names = tuple(sorted(set(languages)))
    if not names:
        return None
    random = np.random.default_rng(seed)
    marks = np.repeat([names.index(language) for language in languages], [len(own) for own in drawn])
    inputs = np.concatenate(drawn)
    draw = lambda *shape: random.normal(0, shape[0] ** -0.5, shape).astype(np.float32)
    params = [random.normal(0, 1, (256, EMBEDDED)).astype(np.float32)]
    params += [draw(width * EMBEDDED, FILTERS) for width in WIDTHS]
    params += [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
    params += [draw(FILTERS * len(WIDTHS), len(names)), np.zeros(len(names), np.float32)]
    mean, square, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(EPOCHS):
        order = random.permutation(len(inputs))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            step += 1
            slopes = _slopes(params, inputs[some], marks[some])
            for p, g, m, v in zip(params, slopes, mean, square, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    k = len(WIDTHS)
    return Model(names, params[0], tuple(params[1 : 1 + k]), tuple(params[1 + k : 1 + 2 * k]), *params[-2:])


def _slopes(params: list[np.ndarray], inputs: np.ndarray, marks: np.ndarray) -> list[np.ndarray]:
    """Slope of the mean loss by each parameter."""
    k, n = len(WIDTHS), len(inputs)
    embedding, filters, biases, out, out_bias = params[0], params[1 : 1 + k], params[1 + k : 1 + 2 * k], *params[-2:]
    embedded = embedding[inputs]
    pooled, best, columns = [], [], []
    for width, weights, bias in zip(WIDTHS, filters, biases, strict=True):
        places = LENGTH - width + 1
        column = np.concatenate([embedded[:, i : i + places] for i in range(width)], axis=2)
        response = column @ weights + bias
        where = response.argmax(axis=1)
        columns.append(column)
        best.append(where)
        pooled.append(np.take_along_axis(response, where[:, None], axis=1)[:, 0])
    hidden = np.concatenate(pooled, axis=1)
    active = np.maximum(hidden, 0)
    logits = active @ out + out_bias
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    p[np.arange(n), marks] -= 1
    p /= n
    back = (p @ out.T) * (hidden > 0)
    to_embedding = np.zeros_like(embedding)
    to_filters, to_biases = [], []
    for i, width in enumerate(WIDTHS):
        own = back[:, i * FILTERS : (i + 1) * FILTERS]
        taken = columns[i][np.arange(n)[:, None], best[i]]  # rows, filters, inputs of the best place
        to_filters.append(np.einsum("nf,nfc->cf", own, taken))
        to_biases.append(own.sum(axis=0))
        down = (own[:, :, None] * filters[i].T[None]).reshape(n, FILTERS, width, EMBEDDED)
        for offset in range(width):
            letters = np.take_along_axis(inputs, best[i] + offset, axis=1)
            np.add.at(to_embedding, letters, down[:, :, offset])
    return [to_embedding, *to_filters, *to_biases, active.T @ p, p.sum(axis=0)]


class Network:
    """A model made ready for prediction: responses of single bytes and of pairs in tables."""

    def __init__(self, model: Model):
        self.model = model
        single = []  # by width: response of each byte at each offset
        for width, weights in zip(WIDTHS, model.filters, strict=True):
            parts = weights.reshape(width, EMBEDDED, FILTERS)
            single.append([model.embedding @ part for part in parts])
        pair = lambda a, b: (a[:, None] + b[None]).reshape(1 << 16, FILTERS)
        self.first = np.concatenate([pair(s[0], s[1]) + b for s, b in zip(single, model.biases, strict=True)], axis=1)
        self.third, self.last_pair = single[1][2], pair(single[2][2], single[2][3])

    def probabilities(self, inputs: np.ndarray) -> np.ndarray:
        pairs = (inputs[:, :-1].astype(np.uint16) << 8) | inputs[:, 1:]
        f = FILTERS
        start = self.first[pairs]
        hidden = np.concatenate(
            [
                start[:, :, :f].max(axis=1),
                (start[:, :-1, f : 2 * f] + self.third[inputs[:, 2:]]).max(axis=1),
                (start[:, :-2, 2 * f :] + self.last_pair[pairs[:, 2:]]).max(axis=1),
            ],
            axis=1,
        )
        logits = np.maximum(hidden, 0) @ self.model.out + self.model.out_bias
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and its probability; ``und`` and 0 for null and for texts without a letter."""
        usable = [bool(t) and any(map(str.isalpha, t)) for t in texts]
        sums = np.zeros((len(texts), len(self.model.languages)))
        counts = np.ones(len(texts))
        pending, owners, held = [], [], 0

        def flush():
            rows, whose = np.concatenate(pending), np.repeat([o for o, _ in owners], [n for _, n in owners])
            for at in range(0, len(rows), AT_ONCE):
                p = self.probabilities(rows[at : at + AT_ONCE])
                np.add.at(sums, whose[at : at + AT_ONCE], p)

        for i, text in enumerate(texts):
            if usable[i]:
                own = windows(text)
                counts[i] = len(own)
                pending.append(own)
                owners.append((i, len(own)))
                held += len(own)
                if held >= AT_ONCE * 16:
                    flush()
                    pending, owners, held = [], [], 0
        if pending:
            flush()
        means = sums / counts[:, None]
        best = means.argmax(axis=1)
        names = [self.model.languages[b] if ok else UNKNOWN for b, ok in zip(best, usable, strict=True)]
        scores = np.where(usable, means[np.arange(len(texts)), best], 0.0)
        return names, np.clip(scores, 0, 1).tolist()


def learn(docs: DataFrame, held_out_fold: int = 2, folds: int = 4) -> Model | None:
    """Train on ``docs (doc_id, text, lang)`` with a language and a text, but for the held-out fold.

    Of each language at most ``PER_LANGUAGE`` rows are taken, by a hash of id and text, and of each text some windows
    from anywhere in it. Rows equal in id, text and language are one; a null id is in no fold and left out.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold("doc_id", folds) != held_out_fold))
    key = F.xxhash64("text").alias("_key")
    rows = usable.select("lang", "doc_id", key).distinct()
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", "_key"), "doc_id", "_key")
    chosen = rows.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= PER_LANGUAGE)
    chosen = chosen.select(F.col("lang").alias("_lang"), F.col("doc_id").alias("_id"), F.col("_key").alias("_k"), "_place")
    same = (usable["lang"] == F.col("_lang")) & (usable["doc_id"] == F.col("_id")) & (F.xxhash64(usable["text"]) == F.col("_k"))

    @F.pandas_udf("binary")
    def drawn(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: drawn_windows(text).tobytes())

    # At most PER_LANGUAGE rows of each language, a kilobyte of windows each.
    found = usable.join(F.broadcast(chosen), same).select("lang", "_place", "doc_id", drawn("text").alias("own")).distinct()
    kept = sorted(found.collect(), key=lambda r: (r["lang"], r["_place"], r["doc_id"], bytes(r["own"])))
    return train_on_windows(
        [np.frombuffer(r["own"], np.uint8).reshape(-1, LENGTH) for r in kept], [r["lang"] for r in kept]
    )


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``.

    Null texts, and texts without a letter, are ``und`` with score 0, as is everything if nothing was
    learned. Repeated rows are predicted each; columns of these names are replaced.
    """
    if model is None:
        return docs.withColumn("lang_pred", F.lit(UNKNOWN)).withColumn("score", F.lit(0.0))

    @F.pandas_udf("lang_pred string, score double")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        network = per_batch(_loaded, lambda _: Network(model), model.out.tobytes())
        names, scores = network.predict(texts.tolist())
        return pd.DataFrame({"lang_pred": names, "score": scores})

    rest = [c for c in docs.columns if c not in ("lang_pred", "score")]
    return docs.withColumn("_p", predicted(F.col(text))).select(*rest, "_p.lang_pred", "_p.score")


def filter_documents(docs: DataFrame, model: Model | None, least: float = 0.4) -> DataFrame:
    """Rows of ``docs`` with a language of at least that probability; without a model all rows."""
    if model is None:
        return docs
    wrapped = docs.select(F.struct("*").alias("_row"), F.col("text").alias("_text"))
    told = predict(wrapped, model, "_text")
    return told.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select("_row.*")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all ``documents``; nulls, repeats and empty tables as in ``learn`` and ``predict``."""
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.select("doc_id", "text", "lang"))
    held_out = F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out, "lang_pred", "score")
