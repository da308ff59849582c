"""Seeded, stratified train/test split and cross-validation folds.

Rows are put in the order of the md5 of their key and the seed; a split is then a set of cut-off
hashes per label. Cut-offs are found by refining prefixes: each pass counts the rows of every cut's cell by
the next digits of their hash, for all labels and cuts at once, until a cell holds one hash. Passes read the
keys only, shuffle counts, and leave a few prefixes on the driver; two or three do for any number of rows.
Assigning rows then compares strings, so the rows themselves are never sorted or shuffled.

Rows that share a key (one label joined to several feature rows) follow each other in the order of the
md5 of their other columns, so shares are exact after such a join, too. With ``grouped`` they have one
hash and stay on one side, whatever that does to the shares. Rows that are equal in every column are told
apart only where a cut falls between them: they are stored, counted by partition and numbered where they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from scoremill.schemas import CUSTOMER, LABEL, LOAN
from scoremill.session import materialise

ROW_KEYS = (CUSTOMER, LOAN)
LABEL_VALUES = (0, 1)
PREFIX_DIGITS = 4
#: Low bits of a row's generated id: its place in the partition.
ID_BITS = 33


def row_hash(keys: Sequence[str], seed: int, others: Sequence[str] = ()) -> Column:
    """md5 of the keys and the seed, followed by the md5 of the other columns if there are any."""
    parts = ", ".join(f"CAST(`{key}` AS STRING)" for key in keys)
    first = f"md5(concat_ws('|', {parts}, '{seed}'))"
    if not others:
        return F.expr(first)
    shown = ", ".join(f"coalesce(CAST(`{name}` AS STRING), '')" for name in others)
    return F.expr(f"concat({first}, md5(concat_ws('|', {shown})))")


def stratified_split(
    df: DataFrame,
    label: str = LABEL,
    keys: Sequence[str] = ROW_KEYS,
    test_percent: int = 20,
    seed: int = 88,
    grouped: bool = False,
) -> DataFrame:
    """Add ``split``: ``test`` for the first ``ceil(test_percent %)`` of each label, else ``train``."""
    block = _block(df, label, keys, seed, [rows_to_test(test_percent)], grouped)
    split = "CASE block WHEN 0 THEN 'test' WHEN 1 THEN 'train' END AS split"
    return block.select(*df.columns, F.expr(split))


def cv_folds(
    df: DataFrame,
    folds: int = 3,
    label: str = LABEL,
    keys: Sequence[str] = ROW_KEYS,
    seed: int = 88,
    grouped: bool = False,
) -> DataFrame:
    """Add ``fold`` 0..folds-1: equal consecutive runs of the hash order within each label."""
    block = _block(df, label, keys, seed, fold_bounds("0", folds), grouped)
    return block.withColumnRenamed("block", "fold")


def split_and_folds(
    df: DataFrame,
    folds: int = 3,
    label: str = LABEL,
    keys: Sequence[str] = ROW_KEYS,
    test_percent: int = 20,
    seed: int = 88,
    grouped: bool = False,
) -> DataFrame:
    """Split of the ``train_test`` period plus folds of its training part, from one set of cut-offs.

    Needs the ``period`` column; rows of the out-of-time period get the split ``oot``.
    """
    tested = rows_to_test(test_percent)
    targets = [tested, *fold_bounds(tested, folds)]
    block = _block(df, label, keys, seed, targets, grouped, within="period <=> 'train_test'")
    split = (
        "CASE WHEN period = 'oot' THEN 'oot' WHEN NOT period <=> 'train_test' THEN NULL "
        "WHEN block = 0 THEN 'test' WHEN block > 0 THEN 'train' END AS split"
    )
    fold = "CASE WHEN split = 'train' THEN block - 1 END AS fold"
    return block.select("*", F.expr(split)).select(*df.columns, "split", F.expr(fold))


def rows_to_test(percent: int) -> str:
    """SQL text of ``ceil(n * percent / 100)`` in whole numbers."""
    return f"((n * {percent} + 99) div 100)"


def fold_bounds(start: str, folds: int) -> list[str]:
    """SQL text of the inner bounds of ``folds`` equal runs over the ranks after ``start``."""
    return [f"({start} + (n - {start}) * {fold} div {folds})" for fold in range(1, folds)]


def _block(
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    seed: int,
    targets: Sequence[str],
    grouped: bool,
    within: str = "true",
) -> DataFrame:
    """Add ``block``: the number of cut-offs before the row; null without a label.

    Raises ``ValueError`` for labels other than 0 and 1.
    """
    others = [] if grouped else [name for name in df.columns if name not in keys]
    hashed = df.withColumn("row_hash", row_hash(keys, seed, others))
    counted = hashed.filter(f"`{label}` IS NOT NULL AND {within}").select(label, "row_hash")
    # One row per label value and cut: a handful of hashes, put into the expression as literals.
    found = _cut_offs(counted, label, targets)
    unknown = {row[label] for row in found} - set(LABEL_VALUES)
    if unknown:
        raise ValueError(f"labels must be 0 or 1, found {sorted(unknown)}")
    shared = [] if grouped else [row for row in found if row["rank"] < row["copies"]]
    numbered = _numbered(hashed, label, within, shared)
    cases = []
    for value in LABEL_VALUES:
        passed = []
        for cut in range(len(targets)):
            # A cut-off before the first row is missing; the empty string sorts before every hash.
            own = next((row for row in found if row[label] == value and row["cut"] == cut), None)
            after = f"row_hash > '{own['row_hash'] if own else ''}'"
            if own in shared:
                after = f"({after} OR (row_hash = '{own['row_hash']}' AND copy > {own['rank']}))"
            passed.append(f"CAST({after} AS INT)")
        cases.append(f"WHEN {value} THEN {' + '.join(passed) or '0'}")
    return numbered.select(*df.columns, F.expr(f"CASE `{label}` {' '.join(cases)} END AS block"))


def _numbered(hashed: DataFrame, label: str, within: str, shared: Sequence) -> DataFrame:
    """Number the rows that are equal to the last row before a cut; there are seldom any."""
    if not shared:
        return hashed
    parts, equal = [], []
    for value, name in sorted({(row[label], row["row_hash"]) for row in shared}):
        own = f"`{label}` <=> {value} AND {within} AND row_hash = '{name}'"
        equal.append(f"({own})")
        stored = materialise(hashed.filter(own), "equal-rows").withColumn("id", F.monotonically_increasing_id())
        # Ids are the partition's number and the row's place in it: a row per partition says where it starts.
        place = f"shiftright(id, {ID_BITS})"
        sizes = stored.groupBy(F.expr(place).alias("part")).agg(F.count(F.lit(1)).alias("size"))
        before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        starts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
        met = stored.join(F.broadcast(starts), F.expr(place) == F.col("part"))
        copy = F.expr(f"CAST(start + (id & {(1 << ID_BITS) - 1}) + 1 AS INT)")
        parts.append(met.select(*hashed.columns, copy.alias("copy")))
    rest = hashed.filter(f"NOT coalesce({' OR '.join(equal)}, false)").withColumn("copy", F.lit(0))
    for part in parts:
        rest = rest.unionByName(part)
    return rest


def _cut_offs(rows: DataFrame, label: str, targets: Sequence[str]) -> list[dict]:
    """The last row before each cut: its hash, how many rows share it and how many of them are before.

    ``open_`` maps the cells under refinement to their cuts: label and prefix to cut and rank within the cell.
    """
    found: list[dict] = []
    open_: dict[tuple, list[tuple[int, int]]] = {}
    for row in _cells(rows, label, PREFIX_DIGITS, targets).collect():
        _settle(row, label, found, open_)
    digits = PREFIX_DIGITS
    while open_:
        digits += PREFIX_DIGITS
        asked, open_ = open_, {}
        for row in _refined(rows, label, digits, asked).collect():
            _settle(row, label, found, open_)
    return found


def _settle(row: Row, label: str, found: list[dict], open_: dict) -> None:
    if row["low"] == row["high"]:
        found.append({label: row[label], "cut": row["cut"], "row_hash": row["low"], "copies": row["n_cell"],
                      "rank": row["rank"]})
    else:
        open_.setdefault((row[label], row["prefix"]), []).append((row["cut"], row["rank"]))


CELL = ["count(1) AS n_cell", "min(row_hash) AS low", "max(row_hash) AS high"]


def _cells(rows: DataFrame, label: str, digits: int, targets: Sequence[str]) -> DataFrame:
    """The cells of the first prefix that the cuts of each label fall in, with the cut's rank there."""
    # At most 16**PREFIX_DIGITS counts per label reach the windows, at any input size.
    of_label = Window.partitionBy(label)
    counts = (
        rows.groupBy(label, F.expr(f"left(row_hash, {digits}) AS prefix"))
        .agg(*map(F.expr, CELL))
        .withColumn("upto", F.sum("n_cell").over(of_label.orderBy("prefix")))
        .withColumn("n", F.sum("n_cell").over(of_label))
    )
    wanted = counts.selectExpr("*", f"posexplode(array({', '.join(targets)})) AS (cut, target)")
    return wanted.filter("target > upto - n_cell AND target <= upto").selectExpr(
        label, "prefix", "cut", "target - (upto - n_cell) AS rank", "n_cell", "low", "high"
    )


def _refined(rows: DataFrame, label: str, digits: int, asked: dict[tuple, list[tuple[int, int]]]) -> DataFrame:
    """The same for the cells asked for, by a longer prefix: one pass for all of them."""
    cells = " OR ".join(f"(`{label}` <=> {value} AND startswith(row_hash, '{prefix}'))" for value, prefix in asked)
    ranks = ", ".join(
        f"struct({value} AS of_label, '{prefix}' AS of_prefix, {cut} AS cut, {rank}L AS wanted)"
        for (value, prefix), cuts in asked.items()
        for cut, rank in cuts
    )
    inside = Window.partitionBy(label, F.expr(f"left(prefix, {digits - PREFIX_DIGITS})")).orderBy("prefix")
    counts = (
        rows.filter(cells)
        .groupBy(label, F.expr(f"left(row_hash, {digits}) AS prefix"))
        .agg(*map(F.expr, CELL))
        .withColumn("upto", F.sum("n_cell").over(inside))
    )
    met = counts.selectExpr("*", f"inline(array({ranks}))").filter(
        f"of_label <=> `{label}` AND startswith(prefix, of_prefix) AND wanted > upto - n_cell AND wanted <= upto"
    )
    return met.selectExpr(label, "prefix", "cut", "wanted - (upto - n_cell) AS rank", "n_cell", "low", "high")
