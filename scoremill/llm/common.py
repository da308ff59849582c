"""What several of the text operators share: tables, words, folds and number formats."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoremill.session import materialise

#: White space between words: space and the five ASCII controls 9 to 13.
BLANK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str, folds: int) -> Column:
    """``crc32`` of the key's decimal text modulo ``folds``; null keys give null."""
    return F.crc32(F.col(key).cast("string")) % folds


def words(text: Column) -> Column:
    """Words of a text as an array of strings, empty for null and for blank text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANK), lambda word: word != "")


class HashOfWord(dict):
    """64-bit hash of each word (bytes) asked for; forgets all when it holds too many."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def word_hashes(text: str | None, known: HashOfWord) -> np.ndarray:
    """Hashes of a text's words, A-Z in lower case.

    ``bytes.lower`` and ``bytes.split`` know ASCII only, which is the definition asked for.
    """
    parts = text.encode().lower().split() if text else []
    return np.fromiter(map(known.__getitem__, parts), np.uint64, len(parts))


def mixed(values: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def shingle_set(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` words; the whole sequence if it is shorter."""
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    runs = np.zeros(len(hashes) - size + 1, np.uint64)
    for offset in range(size):
        runs = mixed(runs + np.uint64(0x9E3779B97F4A7C15)) + hashes[offset : offset + len(runs)]
    return np.unique(mixed(runs))


#: Keys of rows up to this number are broadcast (16 bytes each), more are joined by a shuffle.
BROADCAST_KEYS = 1_000_000


def without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id and text are not among ``keys (doc_id, text_key)``; nulls are values."""
    return _by_key(docs, keys, "left_anti")


def matching(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id and text are among ``keys (doc_id, text_key)``."""
    return _by_key(docs, keys, "left_semi")


def _by_key(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    keys = materialise(keys.select(F.col("doc_id").alias("_key_id"), F.col("text_key").alias("_key_text")), "keys")
    if keys.count() <= BROADCAST_KEYS:
        keys = F.broadcast(keys)
    same = docs["doc_id"].eqNullSafe(F.col("_key_id")) & (F.xxhash64(docs["text"]) == F.col("_key_text"))
    return docs.join(keys, same, how)


#: Rows that go to a Python worker at a time: whole texts, so the library's default is some 30 MB on both sides.
ROWS_PER_BATCH = 1_000


def small_batches(spark: SparkSession) -> None:
    """Lower the session's limit of rows in an Arrow batch; a lower one that is set already stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ROWS_PER_BATCH:
        spark.conf.set(key, str(ROWS_PER_BATCH))


_holders: list[dict] = []


def per_batch(kept: dict, make: Callable, *key):
    """One object for each Python worker and key: models are loaded once, not for each batch.

    Workers outlive stages. What an earlier stage's module has loaded is dropped when another one's is made.
    """
    if key not in kept:
        for other in _holders:
            if other is not kept:
                other.clear()
        if not any(other is kept for other in _holders):
            _holders.append(kept)
        kept[key] = make(*key)
    return kept[key]


def rows_of(batches: Iterator, *columns: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch[column] for column in columns), strict=True)
