"""Spelling variants by a trie that lives in a table and a frontier of states that walk it.

Two words are near if one inserted, deleted or replaced code point makes one of them the other. A state is
``(word, position, node, edits)``: the word as far as its position has led to the node. The trie's edges are rows, so
a step of all states at once is one join, and states that reach the end of a word of the trie after one edit give a
pair. Three things keep frontier and levels small:

- An edit leaves the same text before and behind it, and the longer of both is at least half the word. Words are read
  from the left where the text before is the longer one, from the right elsewhere. So states start at the node of
  that longer text, deep in the trie, where few edges branch off.
- Behind the edit the walk is exact. Its edges carry runs of 1, 2, 4, .. code points (the largest power of two that
  still fits), so a rest of length r takes as many joins as r has binary ones. A node knows how much has to follow.
- Of the two directions of a pair one is walked: the longer word is the one that drops a code point, and the smaller
  code point is the one that is replaced.

Nodes, runs and words are 64-bit hashes; pairs are compared as strings in the end, so equal hashes of different
strings can't add a pair, and equal strings have equal hashes.

Both sides of every join grow with the words, and Spark sizes them too low: some twenty edges of a word count as one
row, strings as what they take in a compressed file. So joins are merged (``_merged``); only a frontier that was
counted and is small is broadcast.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoremill.llm.common import mixed, table
from scoremill.session import materialise

LETTERS = "A-Za-zÀ-ÿ"
RUN, BREAK = re.compile(f"[{LETTERS}]+"), re.compile(f"[^{LETTERS}]")
LOWER = {code: code + 32 for code in range(ord("A"), ord("Z") + 1)}

#: One pair of document and run in so many loses a code point.
DAMAGED_ONE_IN = 97
SHORTEST, LEAST = 5, 3

#: Characters of a text looked at in one go, and distinct words a task counts before it passes them on.
CHARS_AT_ONCE, WORDS_AT_ONCE = 1_000_000, 100_000
#: Rows of texts that are Python objects at a time.
ROWS_AT_ONCE = 256
#: Code points of words that are turned into states or edges in one go.
CODES_AT_ONCE = 50_000

#: Open states of a frontier up to this number are broadcast (some 100 bytes each).
BROADCAST_STATES = 10_000

LEFT, RIGHT = np.uint64(0x51), np.uint64(0xA7)
BASE = 0x9E3779B97F4A7C15
UNBASE = pow(BASE, -1, 1 << 64)


# Words


def damaged(doc_id: object, run: str) -> str:
    """The run, short of one code point if the hash of id and run says so."""
    prefix = "" if doc_id is None else str(doc_id)
    value = zlib.crc32(f"{prefix}:{run}".encode())
    if value % DAMAGED_ONE_IN:
        return run
    at = value % len(run)
    return run[:at] + run[at + 1 :]


def _slices(text: str) -> Iterator[str]:
    """A text in parts; no run of letters is cut."""
    at = 0
    while len(text) - at > CHARS_AT_ONCE:
        found = BREAK.search(text, at + CHARS_AT_ONCE)
        end = found.start() if found else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def count_words(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """``word, n``: words of at least ``shortest`` code points that occur ``least`` times or more.

    Whole texts are read; null texts have no words, a null id counts as empty text before the colon, repeated rows
    count each. Words are counted in the task first, so a word of a third of all rows is a few rows in the shuffle.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for doc_id, text in _python_rows(batch):
                prefix = zlib.crc32(b":" if doc_id is None else f"{doc_id}:".encode())
                for part in _slices(text) if text else ():
                    for run, n in Counter(RUN.findall(part)).items():
                        run = run.lower() if run.isascii() else run.translate(LOWER)
                        value = zlib.crc32(run.encode(), prefix)
                        if not value % DAMAGED_ONE_IN:
                            at = value % len(run)
                            run = run[:at] + run[at + 1 :]
                        if len(run) >= shortest:
                            total[run] += n
                    if len(total) >= WORDS_AT_ONCE:
                        yield _counted(total)
                        total = Counter()
        if total:
            yield _counted(total)

    counts = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(count, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def _python_rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    for at in range(0, batch.num_rows, ROWS_AT_ONCE):
        part = batch.slice(at, ROWS_AT_ONCE)
        yield from zip(*(column.to_pylist() for column in part.columns), strict=True)


def _counted(total: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"word": list(total.keys()), "n": pa.array(list(total.values()), pa.int64())})


# Trie


class Spans:
    """Hashes of any part of the words of a batch, all taken from one array of running sums."""

    def __init__(self, words: list[str]):
        text = "".join(words)
        self.codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths
        n = len(self.codes) + 1
        self.powers, self.unpowers = _powers(BASE, n), _powers(UNBASE, n)
        terms = mixed(self.codes.astype(np.uint64) + np.uint64(1)) * self.powers[:-1]
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(terms, dtype=np.uint64)])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the code points from ``start`` up to ``end``."""
        return mixed((self.sums[end] - self.sums[start]) * self.unpowers[start])

    def without(self, start: np.ndarray, at: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of what is left from ``start`` to ``end`` when the code point at ``at`` goes."""
        before = (self.sums[at] - self.sums[start]) * self.unpowers[start]
        behind = (self.sums[end] - self.sums[at + 1]) * self.unpowers[start + 1]
        return mixed(before + behind)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _node(passed: np.ndarray, rest: np.ndarray, side: np.uint64) -> np.ndarray:
    """A node: what was read so far, from which side, and how many code points have to follow."""
    return mixed(passed + side) ^ mixed(rest.astype(np.uint64) + np.uint64(0x1F))


def _stride(rest: np.ndarray) -> np.ndarray:
    """The largest power of two up to each rest; 0 for none."""
    bits = np.frexp(rest.astype(np.float64))[1]
    return np.where(rest > 0, np.int64(1) << np.maximum(bits - 1, 0).astype(np.int64), 0)


def _positions(spans: Spans) -> tuple[np.ndarray, np.ndarray]:
    """Every code point of every word: number of its word, and its place in the batch."""
    return np.repeat(np.arange(len(spans.lengths)), spans.lengths), np.arange(len(spans.codes))


class _Side:
    """The places whose edits are walked from one side: what was passed, and the rest still to be read."""

    def __init__(self, spans: Spans, side: np.uint64):
        self.spans, self.side = spans, side
        word, at = _positions(spans)
        start, end = spans.starts[word], spans.ends[word]
        before, behind = at - start, end - 1 - at
        own = before >= behind if side == LEFT else before < behind
        self.word, self.at, self.start, self.end = word[own], at[own], start[own], end[own]
        self.rest = (behind if side == LEFT else before)[own]

    def passed(self) -> np.ndarray:
        if self.side == LEFT:
            return self.spans.of(self.start, self.at)
        return self.spans.of(self.at + 1, self.end)

    def run(self, done: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Hashes of ``size`` code points of the rest, of which ``done`` were read before."""
        if self.side == LEFT:
            first = self.at + 1 + done
            return self.spans.of(first, first + size)
        last = self.at - done
        return self.spans.of(last - size, last)

    def beyond(self, size: np.ndarray) -> np.ndarray:
        """Nodes behind the edited code point and ``size`` more; the word itself where nothing follows."""
        if self.side == LEFT:
            passed = self.spans.of(self.start, self.at + 1 + size)
        else:
            passed = self.spans.of(self.at - size, self.end)
        whole = self.spans.of(self.start, self.end)
        return np.where(self.rest == size, whole, _node(passed, self.rest - size, self.side))


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _states(spans: Spans) -> Iterator[pa.RecordBatch]:
    """All states with one edit spent: ``word, node, run, code, rest``, ``done`` where nothing has to be read.

    ``rest`` are the runs behind the first one. The state stands for both edits: to drop the code point and to
    replace it by a larger one. Of equal neighbours only the last is dropped, as all give the same word.
    """
    whole = spans.of(spans.starts, spans.ends)
    for side in (LEFT, RIGHT):
        own = _Side(spans, side)
        first = _stride(own.rest)
        done, left = first.copy(), own.rest - first
        rows, runs = [], []
        while (left > 0).any():
            size = _stride(left)
            some = np.flatnonzero(size > 0)
            rows.append(some)
            runs.append(own.run(done, size)[some])
            done, left = done + size, left - size
        counts = np.zeros(len(own.at) + 1, np.int64)
        values = np.empty(0, np.uint64)
        if rows:
            at, values = np.concatenate(rows), np.concatenate(runs)
            counts[1:] = np.bincount(at, minlength=len(own.at))
            values = values[np.argsort(at, kind="stable")]
        rest = pa.ListArray.from_arrays(pa.array(np.cumsum(counts).astype(np.int32)), _signed(values))
        last = own.at + 1 == own.end
        alone = last | (spans.codes[own.at] != spans.codes[np.minimum(own.at + 1, len(spans.codes) - 1)])
        dropped = np.where(
            own.rest == 0, spans.without(own.start, own.at, own.end), _node(own.passed(), own.rest, side)
        )
        yield pa.RecordBatch.from_arrays(
            [
                _signed(whole[own.word]),
                _signed(_node(own.passed(), own.rest, side)),
                _signed(own.run(np.zeros_like(first), first)),
                pa.array(spans.codes[own.at].astype(np.int32)),
                pa.array(alone),
                pa.array(dropped.view(np.int64), mask=own.rest != 0),
                rest,
            ],
            ["word", "node", "run", "code", "drops", "done", "rest"],
        )


def _branches(spans: Spans) -> Iterator[pa.RecordBatch]:
    """Edges that pass one code point, whatever it is, and the run behind it: ``node, run, code, child``."""
    for side in (LEFT, RIGHT):
        own = _Side(spans, side)
        size = _stride(own.rest)
        yield _edges(
            _node(own.passed(), own.rest, side),
            own.run(np.zeros_like(size), size),
            pa.array(spans.codes[own.at].astype(np.int32)),
            own.beyond(size),
        )


def _plain(spans: Spans, longest: int | None = None) -> Iterator[pa.RecordBatch]:
    """Edges of the exact walk, ``code`` null; ``longest`` leaves out nodes with more to follow."""
    word, at = _positions(spans)
    start, end = spans.starts[word], spans.ends[word]
    whole = spans.of(start, end)
    for side in (LEFT, RIGHT):
        # The rest begins at this code point, or ends with it when read from the right.
        rest = end - at if side == LEFT else at + 1 - start
        own = 2 * rest <= spans.lengths[word]
        if longest is not None:
            own &= rest <= longest
        rest, a, b, here = rest[own], start[own], end[own], at[own]
        size = _stride(rest)
        if side == LEFT:
            node, run, passed = spans.of(a, here), spans.of(here, here + size), spans.of(a, here + size)
        else:
            border = here + 1
            node, run, passed = spans.of(border, b), spans.of(border - size, border), spans.of(border - size, b)
        child = np.where(size == rest, whole[own], _node(passed, rest - size, side))
        yield _edges(_node(node, rest, side), run, pa.nulls(len(rest), pa.int32()), child)


def _edges(node: np.ndarray, run: np.ndarray, code: pa.Array, child: np.ndarray) -> pa.RecordBatch:
    columns = [_signed(node), _signed(run), code, _signed(child)]
    return pa.RecordBatch.from_arrays(columns, ["node", "run", "code", "child"])


EDGE = "node long, run long, code int, child long"
STATE = "word long, node long, run long, code int, drops boolean, done long, rest array<long>"


def _from_words(words: DataFrame, schema: str, *makers) -> DataFrame:
    """Rows that ``makers`` derive from batches of words, a bounded number of code points at a time."""

    def derive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in _bounded(batch.column("word").to_pylist()):
                spans = Spans(some)
                for make in makers:
                    yield from make(spans)

    return words.select("word").mapInArrow(derive, schema)


def _bounded(words: list[str]) -> Iterator[list[str]]:
    taken, size = [], 0
    for word in words:
        taken.append(word)
        size += len(word)
        if size >= CODES_AT_ONCE:
            yield taken
            taken, size = [], 0
    if taken:
        yield taken


def _keyed(df: DataFrame) -> DataFrame:
    """Node and run as the one key that states and edges meet by."""
    return df.withColumn("key", F.xxhash64("node", "run")).drop("node", "run")


def _merged(df: DataFrame) -> DataFrame:
    """One side of a join of which neither side is to be broadcast, however small Spark takes them for."""
    return df.hint("merge")


def near_pairs(words: DataFrame) -> DataFrame:
    """``word_id, near_id``: hashes of near words, each pair once, from the distinct words of ``words (word)``."""
    states = _from_words(words, STATE, _states)
    ended = states.filter("drops AND done IS NOT NULL").select("word", F.col("done").alias("node"))
    edges = _from_words(words, EDGE, _branches, _plain)
    longest = words.agg(F.max(F.length("word"))).first()[0] or 0

    step, edge = _keyed(states).alias("s"), _merged(_keyed(edges)).alias("e")
    allowed = F.when(F.col("e.code").isNull(), F.col("s.drops")).otherwise(F.col("s.code") < F.col("e.code"))
    frontier = materialise(
        step.join(edge, (F.col("s.key") == F.col("e.key")) & allowed).select("s.word", "e.child", "s.rest"),
        "frontier",
    )
    found = [frontier.filter("size(rest) = 0").select("word", F.col("child").alias("node"))]
    # The first join took the highest binary one of each rest, the next ones take those below.
    below = (1 << max(0, (longest // 2).bit_length() - 1)) - 1
    while below > 0:
        open_ = frontier.filter("size(rest) > 0")
        few = open_.count() <= BROADCAST_STATES
        open_ = open_.distinct()
        key = F.xxhash64(F.col("child"), F.element_at("rest", 1))
        open_ = open_.select("word", key.alias("key"), F.expr("slice(rest, 2, size(rest))").alias("rest"))
        reach = below
        plain = _keyed(_from_words(words, EDGE, lambda spans, reach=reach: _plain(spans, reach))).drop("code")
        open_ = F.broadcast(open_) if few else _merged(open_)
        frontier = materialise(open_.join(plain, "key").select("word", "child", "rest"), "frontier")
        found.append(frontier.filter("size(rest) = 0").select("word", F.col("child").alias("node")))
        below >>= 1
    pairs = ended
    for part in found:
        pairs = pairs.unionByName(part)
    return pairs.select(F.col("word").alias("word_id"), F.col("node").alias("near_id"))


def _identified(words: DataFrame) -> DataFrame:
    """``words`` with ``id``, the hash by which the trie knows a word."""

    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for some in _bounded(batch.column("word").to_pylist()):
                spans = Spans(some)
                part = batch.slice(at, len(some))
                at += len(some)
                yield part.append_column("id", _signed(spans.of(spans.starts, spans.ends)))

    return words.mapInArrow(identify, "word string, n long, id long")


def spelling_variants(words: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of each of the distinct ``words (word, n)``.

    A word's form is its near word of largest ``n`` (the smallest in code-point order of equals) if that is at least
    twice the word's own, else null; ``root`` follows forms to the last one and is the word itself without a form.
    No words give no rows.
    """
    known = materialise(_identified(words.select("word", "n")), "words")
    pairs = near_pairs(known)
    both = pairs.unionByName(pairs.select(F.col("near_id").alias("word_id"), F.col("word_id").alias("near_id")))
    near = known.select(F.col("id").alias("near_id"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    own = known.withColumnRenamed("id", "word_id")
    best = F.min(F.struct((-F.col("near_n")).alias("minus_n"), F.col("near")))
    stats = (
        both.join(_merged(near), "near_id")
        .drop("near_id")
        .join(_merged(own), "word_id")
        .filter(F.levenshtein("word", "near", 1) == 1)
        .groupBy("word_id", "word", "n")
        .agg(F.count("*").alias("n_near"), best.alias("best"))
        .select("word", "n_near", (-F.col("best.minus_n")).alias("form_n"), F.col("best.near").alias("form"), "n")
        .withColumn("is_form", F.col("form_n") >= 2 * F.col("n"))
        .select(
            "word",
            "n_near",
            F.when(F.col("is_form"), F.col("form")).alias("form"),
            F.when(F.col("is_form"), F.col("form_n")).alias("form_n"),
        )
    )
    stats = materialise(stats, "near")
    roots = _roots(stats.filter("form IS NOT NULL").select("word", "form"))
    return (
        known.join(_merged(stats), "word", "left")
        .join(_merged(roots), "word", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            "form_n",
        )
    )


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: each round doubles the number of forms followed; counts at least double, so none goes round."""
    reached = forms.select("word", F.col("form").alias("root"))
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        both = reached.join(_merged(onward), "root", "left")
        longer = materialise(both.select("word", "root", "next"), "roots")
        reached = longer.select("word", F.coalesce("next", "root").alias("root"))
        if longer.filter("next IS NOT NULL").isEmpty():
            return reached


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of ``documents`` with their near words, form and root; nulls and repeats as in ``count_words``."""
    return spelling_variants(count_words(table(spark, sf_dir, "documents")))
