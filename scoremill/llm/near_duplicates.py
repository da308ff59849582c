"""Near duplicates by a chosen-path set similarity join over minwise tokens.

A document is the set of its word shingles; documents of equal sets form one class, and only classes are
compared. Each class has ``TOKENS`` minwise tokens. A tree starts with all classes in one node; a node
chooses each token position with chance ``1 / (similarity * TOKENS)``, by a hash of its path, and for each
chosen position sends its classes on to a child named by the token they have there. So a pair as similar
as asked for shares more than one child on average and a less similar pair fewer than one: its chance
falls with depth. Nodes of at most ``SMALL`` classes are compared pair by pair; larger ones branch on.
``TREES`` independent trees bring the chance to miss a pair down.

Two things keep the work in proportion. In every node all classes are first compared with one of them
(its pivot), and linked classes form components; afterwards only nodes that still hold several components
go on, and only pairs across components are compared, since others can't change the result. And a pair is
only confirmed on the full sets if its 1-bit sketches agree as far as those of a similar pair do (six
standard deviations are allowed for). What is still in a large node at ``DEPTH`` is joined exactly, by the
rare shingles that a similar pair has to share.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scoremill.llm.common import HashOfWord, matching, per_batch, shingle_set, table, without, word_hashes
from scoremill.session import discard, materialise

TOKENS, TREES, SMALL, DEPTH = 128, 32, 12, 3
#: Columns of the sketch, 64 bits each.
SKETCH = [f"s{k}" for k in range(TOKENS // 64)]
SPREAD = 1_000_003
#: Classes whose texts are fetched by a broadcast of their ids; beyond it the join is shuffled.
BROADCAST_CLASSES = 200_000
#: Texts that are Python objects at a time, and word hashes a worker keeps.
TEXTS_AT_ONCE, WORDS_KEPT = 256, 100_000

_loaded: dict = {}


# Sets and tokens


class Minwise:
    """Smallest value of a set under each of ``TOKENS`` hash functions."""

    def __init__(self, seed: int = 11):
        random = np.random.default_rng(seed)
        self.factors = random.integers(0, 1 << 31, TOKENS, np.uint32) * np.uint32(2) + np.uint32(1)
        self.shifts = random.integers(0, 1 << 32, TOKENS, np.uint32)

    def __call__(self, members: np.ndarray) -> np.ndarray:
        values = (members >> np.uint64(32)).astype(np.uint32)
        lowest = np.full(TOKENS, np.iinfo(np.uint32).max, np.uint32)
        for at in range(0, len(values), 1024):
            some = values[at : at + 1024, None] * self.factors + self.shifts
            np.minimum(lowest, some.min(axis=0), out=lowest)
        return lowest


def sketch(tokens: np.ndarray) -> np.ndarray:
    """One bit of each token, as 64-bit integers."""
    bits = (tokens * np.uint32(0x9E3779B1) >> np.uint32(31)).astype(np.uint8)
    return np.packbits(bits).view(np.int64)


def set_name(members: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(members.tobytes())


def _known() -> HashOfWord:
    return per_batch(_loaded, HashOfWord, WORDS_KEPT)


def describe(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, text_key, n_shingles, set_id, tokens, sketch`` of each document; no set without words."""

    def describe_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minwise = Minwise()
        for part in _parts(batches):
            counts, names, tokens, sketches = [], [], [], []
            for text in part.column("text").to_pylist():
                members = shingle_set(word_hashes(text, _known()), size)
                lowest = minwise(members) if len(members) else None
                counts.append(len(members))
                names.append(set_name(members) if len(members) else None)
                tokens.append(None if lowest is None else lowest.view(np.int32))
                sketches.append(None if lowest is None else sketch(lowest))
            columns = [*(part.column(k) for k in range(2)), pa.array(counts, pa.int64()), pa.array(names, pa.binary()),
                       pa.array(tokens, pa.list_(pa.int32())), pa.array(sketches, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, DESCRIBED)

    schema = "doc_id long, text_key long, n_shingles long, set_id binary, tokens array<int>, sketch array<long>"
    named = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text")
    return named.mapInArrow(describe_all, schema)


DESCRIBED = ["doc_id", "text_key", "n_shingles", "set_id", "tokens", "sketch"]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
            yield batch.slice(at, TEXTS_AT_ONCE)


# Links


class Join:
    """One run of the similarity join over the classes of ``docs``."""

    def __init__(self, docs: DataFrame, size: int, percent: int):
        self.docs, self.size, self.percent = docs, size, percent
        described = materialise(describe(docs, size), "shingles")
        self.members = described.select("doc_id", "text_key", "n_shingles", "set_id")
        classes = described.where(F.col("set_id").isNotNull()).groupBy("set_id")
        one = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key"))
        classes = classes.agg(
            one.alias("one"), F.first("tokens").alias("tokens"), *[F.first("sketch")[k].alias(s) for k, s in enumerate(SKETCH)]
        )
        classes = classes.select("set_id", "one.doc_id", "one.text_key", "tokens", *SKETCH)
        # The ids are those of the written rows: a class has the same one in every later pass.
        self.classes = materialise(classes.withColumn("c", F.monotonically_increasing_id()), "classes")
        self.tested = self.edges = self.spark.createDataFrame([], "a long, b long")
        self.labels = self.spark.createDataFrame([], "c long, label long")

    @property
    def spark(self) -> SparkSession:
        return self.docs.sparkSession

    def run(self) -> DataFrame:
        """``set_id, component`` of classes with links; the component is a class number."""
        rows, spent = self.roots(), []
        for depth in range(1, DEPTH + 1):
            members = self.grouped(rows)
            discard(*spent)
            self.link(self.first_pivots(members))
            nodes = self.open_nodes(members)
            discard(members)
            self.link(self.small_and_pivot_pairs(nodes))
            large = self.open_nodes(nodes.where(F.col("n") > SMALL))
            discard(nodes)
            if large.isEmpty():
                break
            if depth == DEPTH:
                placed = self.set_shingles(large)
                self.link(self.central_pairs(large, placed))
                self.link(self.rare_pairs(self.open_nodes(large), placed))
            else:
                rows = self.branches(large)
                spent = [large, rows]
        return self.labels.join(self.classes.select("c", "set_id"), "c").select("set_id", F.col("label").alias("component"))

    def chance(self) -> float:
        return 100 / (self.percent * TOKENS)

    def roots(self) -> DataFrame:
        """Children of the roots: ``node, c``, a row for each tree's chosen positions."""
        random = np.random.default_rng(5)
        chosen = [(tree, i) for tree in range(TREES) for i in range(TOKENS) if random.random() < self.chance()]
        names = [F.xxhash64(F.lit(tree), F.lit(i), F.col("tokens")[i]) for tree, i in chosen]
        return self.classes.select(F.explode(F.array(*names)).alias("node"), "c")

    def branches(self, large: DataFrame) -> DataFrame:
        """Children of large nodes."""
        chosen = F.expr(
            f"filter(sequence(0, {TOKENS - 1}), i -> pmod(xxhash64(node, i), {SPREAD}) < {round(self.chance() * SPREAD)})"
        )
        rows = large.select("node", "c").join(self.some_classes(large).select("c", "tokens"), "c")
        rows = rows.select("node", "c", "tokens", F.explode(chosen).alias("i"))
        rows = rows.select(F.expr("xxhash64(node, i, tokens[i])").alias("node"), "c")
        return materialise(rows, "branches")  # read twice, and the join sends all tokens around

    def some_classes(self, wanted: DataFrame) -> DataFrame:
        """Classes that occur in ``wanted``; few are found by a broadcast of their numbers, so the rest isn't shuffled."""
        numbers = materialise(wanted.select("c").distinct(), "class-numbers")
        numbers = F.broadcast(numbers) if numbers.count() <= BROADCAST_CLASSES else numbers
        return self.classes.join(numbers, "c", "left_semi")

    def grouped(self, rows: DataFrame) -> DataFrame:
        """Rows of nodes with several classes, with the node's size and pivot.

        Most rows are alone in their node, so sketches are fetched for those that are left.
        """
        nodes = rows.groupBy("node").agg(F.count("*").alias("n"), F.min("c").alias("pivot")).where(F.col("n") > 1)
        own = self.classes.select(F.col("c").alias("pivot"), *[F.col(s).alias(f"pivot_{s}") for s in SKETCH])
        counted = materialise(nodes, "nodes")
        nodes = materialise(counted.join(own, "pivot"), "pivots")
        shared = materialise(rows.select("node", "c").join(nodes, "node"), "shared")
        members = materialise(shared.join(self.classes.select("c", *SKETCH), "c"), "node-members")
        discard(counted, nodes, shared)
        return members

    def open_nodes(self, nodes: DataFrame) -> DataFrame:
        """Nodes that hold several components, with each class's component."""
        rest = [c for c in nodes.columns if c != "component"]
        placed = nodes.select(*rest).join(self.labels, "c", "left")
        placed = placed.select(*rest, F.coalesce("label", "c").alias("component"))
        placed = materialise(placed, "placed")
        several = placed.groupBy("node").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        several = materialise(several.where(F.col("low") < F.col("high")).select("node"), "open-nodes")
        members = materialise(placed.join(several, "node"), "open-members")
        discard(placed, several)
        return members

    # Pairs that may be linked

    def likely(self, left: str, right: str) -> Column:
        """Whether two sketches differ no more than those of a similar pair may."""
        share = (1 - self.percent / 100) / 2
        most = int(TOKENS * share + 6 * (TOKENS * share * (1 - share)) ** 0.5)
        words = [F.bit_count(F.expr(f"{left}{s} ^ {right}{s}")) for s in SKETCH]
        return reduce(Column.__add__, words) <= most

    def pivot_pairs(self, nodes: DataFrame) -> DataFrame:
        pairs = nodes.where((F.col("c") != F.col("pivot")) & self.likely("", "pivot_"))
        return pairs.withColumn("a", F.col("pivot"))

    def first_pivots(self, nodes: DataFrame) -> DataFrame:
        """Each class with the first of its likely pivots."""
        return self.pivot_pairs(nodes).groupBy(F.col("c").alias("b")).agg(F.min("a").alias("a")).select("a", "b")

    def small_and_pivot_pairs(self, nodes: DataFrame) -> DataFrame:
        """Pairs across components: of pivots with their nodes, and all those of small nodes."""
        own = self.labels.select(F.col("c").alias("a"), F.col("label").alias("of_a"))
        pivots = self.pivot_pairs(nodes).select("a", F.col("c").alias("b"), "component").distinct()
        pivots = pivots.join(own, "a", "left").where(F.coalesce("of_a", "a") != F.col("component")).select("a", "b")
        small = nodes.where(F.col("n").between(3, SMALL))
        return pivots.unionByName(self.pairs_between(small, small.where(F.col("c") != F.col("pivot")))).distinct()

    def pairs_between(self, left: DataFrame, right: DataFrame) -> DataFrame:
        """Likely pairs of one node but two components, smaller class first."""
        one, two = (
            side.select("node", F.col("c").alias(c), F.col("component").alias(f"{c}_of"), *[F.col(s).alias(f"{c}_{s}") for s in SKETCH])
            for side, c in ((left, "a"), (right, "b"))
        )
        pairs = one.join(two, "node").where((F.col("a_of") != F.col("b_of")) & self.likely("a_", "b_"))
        pairs = pairs.where(F.col("a") != F.col("b"))
        return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))

    def set_shingles(self, large: DataFrame) -> DataFrame:
        """``c, n, shingle, common``: shingles that several classes of large nodes hold, and how many of these do."""
        sets = self.sets(large.select("c").distinct())
        placed = sets.select("c", F.size("members").alias("n"), F.explode("members").alias("shingle"))
        counts = placed.groupBy("shingle").agg(F.count("*").alias("common"))
        counts = materialise(counts.where(F.col("common") > 1), "shingle-counts")
        return materialise(placed.join(counts, "shingle"), "set-shingles")

    def central_pairs(self, large: DataFrame, placed: DataFrame) -> DataFrame:
        """Each class with the most central one of a node, whose shingles are the most common there.

        Unequal copies of one text are closer to it than to each other; this links most of them.
        """
        # Shingles of one class only count 1 each.
        mean = (F.sum("common") + F.first("n") - F.count("*")) / F.first("n")
        weights = materialise(placed.groupBy("c").agg(mean.alias("weight")), "weights")
        weighted = large.select("node", "c").join(weights, "c", "left").fillna(1.0, ["weight"])
        weighted = materialise(weighted, "weighted")
        centres = weighted.groupBy("node").agg(F.max_by("c", F.struct("weight", "c")).alias("centre"))
        pairs = weighted.join(materialise(centres, "centres"), "node").where("c <> centre")
        return pairs.select(F.least("c", "centre").alias("a"), F.greatest("c", "centre").alias("b")).distinct()

    def rare_pairs(self, large: DataFrame, placed: DataFrame) -> DataFrame:
        """All pairs of nodes that stayed large which may be similar, across components, by rare shingles.

        With the shingles of each class in one order, rarest first, the first one that a pair shares is
        followed by all others it shares. So a similar pair has one early in both. Under a shingle, classes
        of its largest component meet only those of other components.
        """
        numbers = materialise(large.select("c").distinct(), "class-numbers")
        numbers = F.broadcast(numbers) if numbers.count() <= BROADCAST_CLASSES else numbers
        # Shingles of one class only stand before those that are in ``placed``.
        own = Window.partitionBy("c")
        at = F.col("n") - F.count("*").over(own) + F.row_number().over(own.orderBy("common", "shingle")) - 1
        ranked = placed.join(numbers, "c", "left_semi").withColumn("at", at)
        early = ranked.where(100 * F.col("at") <= (100 - self.percent) * F.col("n"))
        early = early.join(large.select("c", "component").distinct(), "c")
        early = materialise(early.select("shingle", "c", "component", (F.col("n") - F.col("at")).alias("left"), "n"), "early")
        sizes = early.groupBy("shingle", "component").count()
        most = sizes.groupBy("shingle").agg(F.max(F.struct("count", "component")).alias("most"), F.count("*").alias("k"))
        most = materialise(most.where("k > 1").select("shingle", F.col("most.component").alias("main")), "shingle-mains")
        early = materialise(early.join(most, "shingle"), "early-open")
        one, two = early.alias("one"), early.where(F.col("component") != F.col("main")).alias("two")
        shared = F.least("one.left", "two.left")
        enough = (100 + self.percent) * shared >= self.percent * (F.col("one.n") + F.col("two.n"))
        across = F.col("one.component") != F.col("two.component")
        pairs = one.join(two, (F.col("one.shingle") == F.col("two.shingle")) & across & enough)
        return pairs.select(F.least("one.c", "two.c").alias("a"), F.greatest("one.c", "two.c").alias("b")).distinct()

    # Confirmation and components

    def link(self, pairs: DataFrame) -> None:
        """Add the pairs that are similar enough on their full sets."""
        pairs = materialise(pairs.join(self.tested, ["a", "b"], "left_anti"), "pairs")
        if pairs.isEmpty():
            return
        self.tested = self.tested.unionByName(pairs)
        sets = self.sets(pairs.select(F.col("a").alias("c")).union(pairs.select("b")).distinct())
        one = sets.select(F.col("c").alias("a"), F.col("members").alias("of_a"))
        two = sets.select(F.col("c").alias("b"), F.col("members").alias("of_b"))
        both = F.size(F.array_intersect("of_a", "of_b"))
        sizes = pairs.join(one, "a").join(two, "b").select("a", "b", both.alias("both"), (F.size("of_a") + F.size("of_b")).alias("sum"))
        similar = sizes.where(100 * F.col("both") >= self.percent * (F.col("sum") - F.col("both")))
        found = materialise(similar.select("a", "b"), "edges")
        discard(*self.spent)
        if found.isEmpty():
            return
        self.edges = self.edges.unionByName(found)
        self.labels = components(self.edges, self.labels)

    def sets(self, wanted: DataFrame) -> DataFrame:
        """``c, members`` of classes, from the text of one document of each."""
        keys = self.classes.select("c", "set_id", F.col("doc_id").alias("_d"), F.col("text_key").alias("_k"))
        wanted = materialise(wanted.join(keys, "c"), "wanted")
        n_wanted = wanted.count()
        named = F.broadcast(wanted) if n_wanted <= BROADCAST_CLASSES else wanted
        texts = self.docs.select(F.col("doc_id").cast("long"), "text")
        same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.xxhash64("text") == F.col("_k"))
        texts = texts.join(named, same).select("c", "set_id", "text")
        size = self.size

        def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in _parts(batches):
                keys, sets = [], []
                for c, name, text in zip(*(column.to_pylist() for column in part.columns), strict=True):
                    found = shingle_set(word_hashes(text, _known()), size)
                    if len(found) and set_name(found) == name:  # another text may have the same key
                        keys.append(c)
                        sets.append(found.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["c", "members"]
                )

        made = materialise(texts.mapInArrow(members, "c long, members array<long>"), "sets")
        self.spent = [made, wanted]
        # Only rows that repeat an id and a text make a set twice.
        return made if made.count() == n_wanted else made.dropDuplicates(["c"])


def components(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """``c, label``: smallest class reachable over the edges; ``labels`` may hold earlier ones."""
    both = edges.select(F.col("a").alias("c"), F.col("b").alias("d")).union(edges.select("b", "a"))
    both = materialise(both.distinct(), "neighbours")
    known = both.select("c").distinct().join(labels, "c", "left")
    current = materialise(known.select("c", F.coalesce("label", "c").alias("label")), "labels")
    while True:
        seen = both.join(current.withColumnRenamed("c", "d"), "d").groupBy("c").agg(F.min("label").alias("near"))
        lower = current.join(seen, "c").select("c", "label", F.least("label", "near").alias("lower"))
        # A label is a class too: take the label that it has itself by now.
        over = current.select(F.col("c").alias("lower"), F.col("label").alias("further"))
        after = lower.join(over, "lower", "left")
        after = materialise(after.select("c", "label", F.least("lower", F.coalesce("further", "lower")).alias("next")), "labels")
        changed = not after.where(F.col("next") < F.col("label")).isEmpty()
        current = after.select("c", F.col("next").alias("label"))
        if not changed:
            return current


def find(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, text_key, n_shingles, component_id, kept`` of every row of ``docs (doc_id, text)``.

    Documents are linked if their sets of ``size``-word shingles (A-Z in lower case; a shorter text is one
    shingle) have ``100 * intersection >= percent * union``. ``component_id`` is the smallest ``doc_id``
    reachable, ``kept`` marks the document that bears it. Null, empty and blank texts have no set, are
    linked with nothing and kept. Rows that repeat an id are judged each; a null id is never the smallest
    unless there is no other. Other columns are ignored.
    """
    placed = _placed(docs, size, percent).drop("component")
    return placed.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _placed(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``doc_id, text_key, n_shingles, component_id, component``; the last one is a number, null without words."""
    join = Join(docs.select("doc_id", "text"), size, percent)
    linked = materialise(join.run(), "linked")
    by_class = join.classes.select("set_id", "doc_id", "c").join(linked, "set_id", "left")
    by_class = materialise(by_class.select("set_id", "doc_id", F.coalesce("component", "c").alias("component")), "by-class")
    lowest = by_class.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    lowest = materialise(lowest, "components")
    by_class = by_class.select("set_id", "component").join(lowest, "component").select("set_id", "component_id", "component")
    by_class = materialise(by_class, "class-components")
    columns = ["doc_id", "text_key", "n_shingles", "component_id", "component"]
    alone = join.members.where(F.col("set_id").isNull())
    alone = alone.withColumns({"component_id": F.col("doc_id"), "component": F.lit(None).cast("long")})
    placed = join.members.where(F.col("set_id").isNotNull()).join(by_class, "set_id")
    return placed.select(*columns).unionByName(alone.select(*columns))


def deduplicate(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, of equal ids that of the smallest text hash.

    A null id counts as larger than any other. Documents without words all stay.
    """
    found = materialise(_placed(docs, size, percent).where(F.col("component").isNotNull()), "found")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    chosen = found.groupBy(F.col("component").alias("of")).agg(F.min(order).alias("chosen"))
    found = found.join(chosen, F.col("component") == F.col("of"))
    found = materialise(found.select("doc_id", "text_key", order.eqNullSafe(F.col("chosen")).alias("stays")), "chosen")
    repeated = found.where("stays").groupBy("doc_id", "text_key").count().where("count > 1")
    repeated = materialise(repeated.select("doc_id", "text_key"), "repeated")
    kept = without(docs, found.where("NOT stays").select("doc_id", "text_key").distinct())
    if repeated.isEmpty():
        return kept
    again = matching(kept, repeated).dropDuplicates(["doc_id", "text"])
    return without(kept, repeated).unionByName(again)


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all ``documents`` by 4-word shingles; nulls, repeats and empty tables as in ``find``."""
    found = find(table(spark, sf_dir, "documents"), size=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")
