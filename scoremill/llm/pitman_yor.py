"""Language model score by a hierarchical Pitman-Yor model, its seating sampled by Gibbs.

Every class of previous words (``CONTEXTS`` classes, by hash) has a restaurant; a dish is a word. A table
of a context restaurant is a customer of the root restaurant, which all contexts share as parent; the
root's parent gives each of the ``V`` words seen in training, and the one class of all others, the same
chance. Words are runs of other characters than white space, A-Z in lower case; each text ends with an
end token.

Documents are cut into blocks. A block sends what it has of a word to the word's bucket, so that one shuffle
brings together all counts of a word and all places where it is to be scored. The words that are frequent
in a sample (it decides about nothing else) are spread over buckets by their context; what their parts
have in common is then kept by the driver, like the totals of the contexts: both have a fixed bound.
Gibbs sweeps read the counts only. All tables of a dish in a restaurant are drawn at once from their
conditional distribution, given the totals of the sweep before; for dishes of more than ``EXACT`` customers
the further ones are seated in growing batches. A sweep is a function of the totals before it and a seed,
so buckets keep no state: they repeat the earlier sweeps. Probabilities are averaged over the last sweeps.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoremill.llm.common import HashOfWord, fold, mixed, per_batch, table, word_hashes, words
from scoremill.session import materialise

CONTEXTS = 1 << 16
SWEEPS, BURN_IN = 4, 1
STRENGTH = 1.0
EXACT = 32
BLOCK_TOKENS, BLOCK_DOCS = 1_000_000, 50_000
#: Texts and share of tokens by which frequent words are found, and how many there may be.
SAMPLE_TEXTS, FREQUENT, MOST_FREQUENT = 2_000, 1 / 1_000, 1_000
END, START = xxhash.xxh3_64_intdigest(b" end"), xxhash.xxh3_64_intdigest(b" start")

_loaded: dict = {}


def pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def unpack(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def context_of(previous: np.ndarray) -> np.ndarray:
    return (mixed(previous) & np.uint64(CONTEXTS - 1)).astype(np.uint16)


# Blocks

BLOCKS = (
    "bucket long, block long, words binary, runs binary, contexts binary, places binary, trained binary, "
    "doc_ids array<long>, held_out array<boolean>, sizes array<long>"
)


def blocks(docs: DataFrame, buckets: int, frequent: np.ndarray) -> DataFrame:
    """Tokens by block and bucket, sorted by word; a row with a bucket below zero names the documents."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = per_batch(_loaded, HashOfWord)
        block, tokens, documents = TaskContext.get().partitionId() << 24, [], []
        count = 0
        for batch in batches:
            for doc_id, held, text in zip(batch["doc_id"], batch["held_out"], batch["text"], strict=True):
                own = np.append(word_hashes(text, known), np.uint64(END))
                tokens.append(own)
                documents.append((None if pd.isna(doc_id) else int(doc_id), bool(held), len(own)))
                count += len(own)
                if count >= BLOCK_TOKENS or len(tokens) >= BLOCK_DOCS:
                    yield _block(block, tokens, documents, buckets, frequent)
                    block, tokens, documents, count = block + 1, [], [], 0
        if tokens:
            yield _block(block, tokens, documents, buckets, frequent)

    return docs.select("doc_id", "held_out", "text").mapInPandas(cut, BLOCKS)


def _block(block: int, tokens: list, documents: list, buckets: int, frequent: np.ndarray) -> pd.DataFrame:
    ids, held, sizes = map(list, zip(*documents, strict=True))
    word = np.concatenate(tokens)
    place = np.repeat(np.arange(len(sizes), dtype=np.uint16), sizes)
    before = np.append(np.uint64(START), word[:-1])
    before[np.cumsum([0, *sizes[:-1]])] = np.uint64(START)
    context = context_of(before)
    spread = word.copy()
    often = np.isin(word, frequent)
    spread[often] = mixed(word[often] + context[often])
    bucket = (spread >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    order = np.lexsort((word, bucket))
    word, context, place, bucket = word[order], context[order], place[order], bucket[order]
    cuts = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
    trained = np.packbits(~np.array(held)).tobytes()
    rows = []
    for number in np.flatnonzero(np.diff(cuts)):
        a, b = cuts[number], cuts[number + 1]
        names, runs = np.unique(word[a:b], return_counts=True)
        data = (pack(names), pack(runs.astype(np.uint32)), pack(context[a:b]), pack(place[a:b]))
        rows.append((int(number), block, *data, trained, None, None, None))
    rows.append((-1 - block, block, None, None, None, None, None, ids, held, sizes))
    return pd.DataFrame(rows, columns=[part.split()[0] for part in BLOCKS.split(", ")])


# Buckets

BUCKETS = (
    "bucket long, words binary, pairs binary, contexts binary, seen binary, uses binary, block_ids binary, "
    "block_sizes binary, at_block binary, at_place binary, block long, "
    "doc_ids array<long>, held_out array<boolean>, sizes array<long>"
)


def gathered(blocks_: DataFrame) -> DataFrame:
    """One row per bucket: its words, their contexts with training counts, and all their places."""

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        columns = [part.split()[0] for part in BUCKETS.split(", ")]
        number = int(group["bucket"].iloc[0])
        if number < 0:
            return group.reindex(columns=columns)
        group = group.sort_values("block")
        words_, runs = [unpack(x, "<u8") for x in group["words"]], [unpack(x, "<u4") for x in group["runs"]]
        contexts, places = [unpack(x, "<u2") for x in group["contexts"]], [unpack(x, "<u2") for x in group["places"]]
        sizes = [len(x) for x in places]
        trained = [
            np.unpackbits(np.frombuffer(bits, np.uint8))[place] for bits, place in zip(group["trained"], places, strict=True)
        ]
        names, inverse = np.unique(np.concatenate(words_), return_inverse=True)
        pair = np.repeat(inverse.astype(np.uint64), np.concatenate(runs)) << np.uint64(16)
        pair |= np.concatenate(contexts)
        order = np.argsort(pair, kind="stable")
        pair = pair[order]
        first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
        seen = np.add.reduceat(np.concatenate(trained)[order].astype(np.uint32), first)
        uses = np.diff(np.append(first, len(pair)))
        own = np.bincount((pair[first] >> np.uint64(16)).astype(np.int64), minlength=len(names))
        at_block = np.repeat(np.arange(len(sizes), dtype=np.uint32), sizes)[order]
        packed = [
            pack(x)
            for x in (
                names, own.astype(np.uint32), (pair[first] & np.uint64(CONTEXTS - 1)).astype(np.uint16),
                seen.astype(np.uint32), uses.astype(np.uint32), group["block"].to_numpy(np.int64),
                np.array([len(x) * 8 for x in group["trained"]], np.int64), at_block, np.concatenate(places)[order],
            )
        ]
        return pd.DataFrame([(number, *packed, None, None, None, None)], columns=columns)

    return blocks_.groupBy("bucket").applyInPandas(gather, BUCKETS)


# Seating


def tables_of(count: np.ndarray, weight: np.ndarray, chance: np.ndarray, discount: float, random) -> np.ndarray:
    """Number of tables of each dish, drawn given everything else.

    ``count`` customers, ``weight`` the restaurant's ``strength + discount * other tables``, ``chance`` of
    the dish at the parent. The number ``t`` has the weight ``chance^t * weight (weight + discount) ...
    (t factors) * S(count, t)`` with generalised Stirling numbers ``S``.
    """
    tables = np.minimum(count, 1).astype(np.int64)
    log_stirling = stirling(discount)
    exact = np.minimum(count, EXACT)
    order = np.argsort(exact, kind="stable")
    borders = np.searchsorted(exact[order], np.arange(2, EXACT + 2))
    for c in range(2, EXACT + 1):
        rows = order[borders[c - 2] : borders[c - 1]]
        for at in range(0, len(rows), 100_000):
            some = rows[at : at + 100_000]
            steps = np.log(weight[some, None] + discount * np.arange(c)) + np.log(chance[some, None])
            logs = np.cumsum(steps, axis=1) + log_stirling[c, 1 : c + 1]
            share = np.exp(logs - logs.max(axis=1, keepdims=True)).cumsum(axis=1)
            tables[some] = 1 + (share < random.random(len(some))[:, None] * share[:, -1:]).sum(axis=1)
    rest = np.flatnonzero(count > EXACT)
    seated = np.full(len(rest), EXACT, np.int64)
    while len(rest):
        batch = np.minimum(count[rest] - seated, seated // 8 + 1)
        own = tables[rest]
        new = (weight[rest] + discount * own) * chance[rest]
        tables[rest] = own + random.binomial(batch, new / (new + seated - discount * own))
        seated = seated + batch
        rest, seated = rest[seated < count[rest]], seated[seated < count[rest]]
    return tables


def stirling(discount: float) -> np.ndarray:
    """Logarithms of generalised Stirling numbers up to ``EXACT`` customers."""
    if ("stirling", discount) not in _loaded:
        logs = np.full((EXACT + 1, EXACT + 2), -np.inf)
        logs[1, 1] = 0.0
        for n in range(1, EXACT):
            for t in range(1, n + 2):
                stay = logs[n, t] + math.log(n - t * discount) if t <= n else -np.inf
                logs[n + 1, t] = np.logaddexp(logs[n, t - 1], stay)
        _loaded["stirling", discount] = logs
    return _loaded["stirling", discount]


@dataclass
class Totals:
    """What all buckets need of a seating: tables by context, and the root's customers and tables."""

    tables: np.ndarray
    root_customers: float
    root_tables: float
    often_customers: np.ndarray
    often_tables: np.ndarray


@dataclass
class Model:
    """Fixed numbers of a training text, and the totals of each sweep so far; ``history[0]`` has one table each."""

    tokens: float
    distinct: float
    discount: float
    root_discount: float
    customers: np.ndarray
    frequent: np.ndarray
    often_seen: np.ndarray
    history: list[Totals] = field(default_factory=list)

    def root_chance(self, customers: np.ndarray, tables: np.ndarray, totals: Totals) -> np.ndarray:
        every = (STRENGTH + self.root_discount * totals.root_tables) / (self.distinct + 1)
        return (customers - self.root_discount * tables + every) / (STRENGTH + totals.root_customers)


class Bucket:
    """Counts of one bucket and their seating."""

    def __init__(self, row: dict, model: Model | None = None):
        self.number = row["bucket"]
        self.words = unpack(row["words"], "<u8")
        self.pairs = unpack(row["pairs"], "<u4").astype(np.int64)
        self.context = unpack(row["contexts"], "<u2")
        self.seen = unpack(row["seen"], "<u4").astype(np.int64)
        self.word = np.repeat(np.arange(len(self.words)), self.pairs)
        self.tables = np.minimum(self.seen, 1)
        self.seen_by_word = self.by_word(self.seen)
        self.model = model
        if model is not None:
            self.place_often(model.frequent)
            self.root_tables = np.minimum(self.seen_by_word, 1)

    def by_word(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.word, weights=values, minlength=len(self.words)).astype(np.int64)

    def place_often(self, frequent: np.ndarray) -> None:
        self.often = np.flatnonzero(np.isin(self.words, frequent))
        self.often_index = np.searchsorted(frequent, self.words[self.often])

    def chance(self, totals: Totals) -> np.ndarray:
        """Chance of each word at the root, under the seating whose totals these are."""
        customers, tables = self.by_word(self.tables), self.root_tables.copy()
        customers[self.often] = totals.often_customers[self.often_index]
        tables[self.often] = totals.often_tables[self.often_index]
        return self.model.root_chance(customers, tables, totals)

    def sweep(self, number: int) -> None:
        """Seat all customers anew, given the totals of the sweep before."""
        model, totals = self.model, self.model.history[number]
        random = np.random.default_rng([3, number, self.number])
        chance = self.chance(totals)
        open_ = np.flatnonzero(self.seen > 1)
        others = totals.tables[self.context[open_]] - self.tables[open_]
        weight = STRENGTH + model.discount * np.maximum(others, 0)
        drawn = tables_of(self.seen[open_], weight, chance[self.word[open_]], model.discount, random)
        self.tables = self.tables.copy()
        self.tables[open_] = drawn
        customers = self.by_word(self.tables)
        customers[self.often] = 0  # seated by the driver
        self.root_tables = _root_tables(model, totals, customers, self.root_tables, random)


def _root_tables(model: Model, totals: Totals, customers: np.ndarray, before: np.ndarray, random) -> np.ndarray:
    weight = STRENGTH + model.root_discount * np.maximum(totals.root_tables - before, 0)
    chance = np.full(len(customers), 1 / (model.distinct + 1))
    return tables_of(customers, weight, chance, model.root_discount, random)


COUNTED = ["bucket", "words", "pairs", "contexts", "seen"]


def _sums(buckets: DataFrame, measure) -> dict[str, np.ndarray]:
    """Sums over all buckets of what ``measure`` gives for each: arrays by name, of a fixed length."""

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_dict("records"):
                for name, values in measure(row).items():
                    sums[name] = sums[name] + values if name in sums else values
        for name, values in sums.items():
            at = np.flatnonzero(values)
            yield pd.DataFrame({"name": name, "at": at, "value": np.asarray(values, float)[at]})

    counted = buckets.where("bucket >= 0").select(*COUNTED)
    summed = counted.mapInPandas(measured, "name string, at long, value double")
    rows = summed.groupBy("name", "at").agg(F.sum("value").alias("value")).toPandas()
    return {name: own.set_index("at")["value"] for name, own in rows.groupby("name")}


def _dense(sums: dict, name: str, size: int) -> np.ndarray:
    out = np.zeros(size)
    if name in sums:
        out[sums[name].index.to_numpy(int)] = sums[name].to_numpy()
    return out


def train(buckets: DataFrame, frequent: np.ndarray) -> Model:
    """Sample the seating; sweeps are jobs over the buckets' counts."""

    def first(row: dict) -> dict[str, np.ndarray]:
        bucket = Bucket(row)
        bucket.place_often(frequent)
        one = bucket.tables
        rare = np.ones(len(bucket.words), bool)
        rare[bucket.often] = False
        contexts = bucket.by_word(one)
        facts = [bucket.seen.sum(), (bucket.seen_by_word[rare] > 0).sum(), (bucket.seen == 1).sum(), (bucket.seen == 2).sum()]
        facts += [(contexts[rare] == 1).sum(), (contexts[rare] == 2).sum(), one.sum()]
        often = lambda v: np.bincount(bucket.often_index, v[bucket.often], len(frequent))
        return {
            "facts": np.array(facts, float),
            "tables": np.bincount(bucket.context, one, CONTEXTS),
            "customers": np.bincount(bucket.context, bucket.seen, CONTEXTS),
            "often_seen": often(bucket.seen_by_word),
            "often_customers": often(contexts),
        }

    sums = _sums(buckets, first)
    tokens, distinct, n1, n2, r1, r2, root = _dense(sums, "facts", 7)
    often_seen = _dense(sums, "often_seen", len(frequent))
    distinct += (often_seen > 0).sum()
    share = lambda a, b: float(np.clip(a / max(a + 2 * b, 1), 0.05, 0.95))
    model = Model(tokens, distinct, share(n1, n2), share(r1, r2), _dense(sums, "customers", CONTEXTS), frequent, often_seen)
    often_customers = _dense(sums, "often_customers", len(frequent))
    model.history.append(Totals(_dense(sums, "tables", CONTEXTS), root, distinct, often_customers, np.minimum(often_seen, 1)))
    for number in range(SWEEPS):
        model.history.append(_swept(buckets, model, number))
    return model


def _swept(buckets: DataFrame, model: Model, number: int) -> Totals:
    def again(row: dict) -> dict[str, np.ndarray]:
        bucket = Bucket(row, model)
        for k in range(number + 1):
            bucket.sweep(k)
        customers = bucket.by_word(bucket.tables)
        return {
            "tables": np.bincount(bucket.context, bucket.tables, CONTEXTS),
            "root": np.array([customers.sum(), bucket.root_tables.sum()], float),
            "often_customers": np.bincount(bucket.often_index, customers[bucket.often], len(model.frequent)),
        }

    sums, before = _sums(buckets, again), model.history[number]
    customers, tables = _dense(sums, "root", 2)
    often = _dense(sums, "often_customers", len(model.frequent))
    random = np.random.default_rng([4, number])
    often_tables = _root_tables(model, before, often.astype(np.int64), before.often_tables, random)
    return Totals(_dense(sums, "tables", CONTEXTS), customers, tables + often_tables.sum(), often, often_tables)


# Scores


def scores(buckets: DataFrame, model: Model) -> DataFrame:
    """Rows of the result from the buckets' shares of each document's sums."""

    def shares(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                if row["bucket"] < 0:
                    names = {c: [row[c]] for c in ("block", "doc_ids", "held_out", "sizes")}
                    yield pd.DataFrame(names | {"score": [None], "base": [None], "known": [None]})
                else:
                    yield _shares(row, model)

    partial = buckets.mapInPandas(
        shares,
        "block long, doc_ids array<long>, held_out array<boolean>, sizes array<long>, "
        "score binary, base binary, known binary",
    )

    def total(group: pd.DataFrame) -> pd.DataFrame:
        names = group[group["sizes"].notna()].iloc[0]
        n = len(names["sizes"])
        out = {"doc_id": pd.array(names["doc_ids"], "Int64"), "held_out": names["held_out"], "n_tokens": names["sizes"]}
        parts = group[group["score"].notna()].sort_values("part")
        for name, kind in (("known", "<i4"), ("base", "<f8"), ("score", "<f8")):
            out[name] = sum((unpack(x, kind)[:n] for x in parts[name]), np.zeros(n, kind))
        return pd.DataFrame(out)

    summed = partial.withColumn("part", F.xxhash64("score", "base")).groupBy("block")
    rows = summed.applyInPandas(total, "doc_id long, held_out boolean, n_tokens long, known long, base double, score double")
    return rows.select(
        "doc_id", "held_out", "n_tokens", F.col("known").alias("n_known"), F.lit(int(model.tokens)).alias("train_tokens"),
        F.col("base").alias("base_score"), "score",
    )


def _shares(row: dict, model: Model) -> pd.DataFrame:
    bucket = Bucket(row, model)
    weight = STRENGTH + model.customers[bucket.context]
    chance = np.zeros(len(bucket.seen))
    for number in range(SWEEPS):
        bucket.sweep(number)
        if number >= BURN_IN:
            totals = model.history[number + 1]
            back = (STRENGTH + model.discount * totals.tables[bucket.context]) * bucket.chance(totals)[bucket.word]
            chance += (np.maximum(bucket.seen - model.discount * bucket.tables, 0) + back) / weight
    logs = np.log10(chance / (SWEEPS - BURN_IN))
    seen = bucket.seen_by_word.astype(float)
    seen[bucket.often] = model.often_seen[bucket.often_index]
    base = np.log10((seen + 0.5) / (model.tokens + 0.5 * (model.distinct + 1)))[bucket.word]
    known = (seen > 0)[bucket.word]
    uses = unpack(row["uses"], "<u4").astype(np.int64)
    ids, sizes = unpack(row["block_ids"], "<i8"), unpack(row["block_sizes"], "<i8")
    starts = np.append(0, np.cumsum(sizes))
    place = starts[unpack(row["at_block"], "<u4")] + unpack(row["at_place"], "<u2")
    sums = [np.bincount(place, np.repeat(x.astype(float), uses), starts[-1]) for x in (logs, base, known)]
    rows = []
    for block, a, b in zip(ids.tolist(), starts[:-1], starts[1:], strict=True):
        rows.append((block, None, None, None, pack(sums[0][a:b]), pack(sums[1][a:b]), pack(sums[2][a:b].astype("<i4"))))
    return pd.DataFrame(rows, columns=["block", "doc_ids", "held_out", "sizes", "score", "base", "known"])


def frequent_words(docs: DataFrame) -> np.ndarray:
    """Hashes of words with a share of ``FREQUENT`` in about ``SAMPLE_TEXTS`` texts, at most ``MOST_FREQUENT``."""
    total = docs.count()
    some = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(min(1, SAMPLE_TEXTS / max(total, 1)) * (1 << 20)))
    counted = some.select(F.explode(words(F.col("text"))).alias("word")).groupBy("word").count()
    counted = counted.orderBy(F.desc("count"), "word").limit(4 * MOST_FREQUENT).collect()
    least = FREQUENT * sum(row["count"] for row in counted)
    found = {row["word"].encode().lower() for row in counted if row["count"] >= least}
    hashes = [xxhash.xxh3_64_intdigest(word) for word in sorted(found)[:MOST_FREQUENT]]
    return np.unique(np.array([END, *hashes], np.uint64))


def score(docs: DataFrame) -> DataFrame:
    """Score rows of ``docs (doc_id, text, held_out)``; train on those with ``held_out`` false.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``, a row for each row.
    Null, empty and blank texts have the end token alone. Null ids stay null; a null ``held_out`` is
    false; other columns are ignored. The input must be read alike each time (a stored table is).
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("held_out", F.lit(False)).alias("held_out"), "text")
    frequent = frequent_words(docs)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * docs.rdd.getNumPartitions())
    buckets = materialise(gathered(blocks(docs, parts, frequent)), "model-buckets")
    return scores(buckets, train(buckets, frequent))


def op6_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs.select("doc_id", "text", (fold("doc_id", 5) == 1).alias("held_out")))
