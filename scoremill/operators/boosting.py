"""Second-order boosted trees: gradient histograms as Spark aggregates, any number of fits in one pass.

A fit is a parameter set and, in a cross-validation, the fold it leaves out. All fits grow in step: one pass over the
matrix gives the sums of gradients and hessians by (fit, node, feature, bin), Spark adds them up and picks the best
split of each node, and only these splits reach the driver (fits times nodes of a level). So a search takes as many
passes as its largest candidate has levels, not as many as it has fits.

- The matrix is binned once: one byte per value, in blocks of rows, in the shared folder. Passes read it from there.
- Tasks add up blocks before the shuffle; what is shuffled is bounded by fits, nodes, features and bins per task.
- Margins are written beside the blocks every few trees; a pass adds up the trees since, not all that are finished.
  A lost executor costs its share of one pass and nothing else.
- A missing value takes the direction that is better at its node.

Formulas (second-order gain with L1 and L2 terms, leaf weight, least child weight, least gain) and parameter names
are those of the original trees. Rows and columns are drawn by hashes of their keys, so SQL can draw the same.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoremill.functions.numeric import nan_to_null
from scoremill.schemas import LABEL
from scoremill.session import discard, materialise

SEED = 88
#: Rows are drawn by a linear hash modulo this prime.
PRIME = 2**31 - 1
MAX_BINS = 64
#: Error of the cut points: ranks are off by one in so many rows at most.
CUT_ACCURACY = 10_000
#: A split has to gain more than this; gains are compared after rounding to so many places.
LEAST_GAIN, GAIN_DIGITS = 1e-6, 9
NO_FOLD = -1
#: Rows of a block at most, and trees that passes add up before margins are written again.
ROWS_PER_BLOCK, TREES_PER_STEP = 10_000, 4
#: Trees of more splits are walked level by level, not split by split.
FEW_SPLITS = 15


@dataclass(frozen=True)
class Params:
    """Parameters of one fit, by the names and with the defaults of the original."""

    n_estimators: int = 100
    max_depth: int = 6
    learning_rate: float = 0.3
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    gamma: float = 0.0
    min_child_weight: float = 1.0
    reg_alpha: float = 0.0
    reg_lambda: float = 1.0

    @classmethod
    def of(cls, values: Mapping[str, object]) -> Params:
        """From a candidate of the search; unknown names are refused."""
        kinds = {name: int if name in ("n_estimators", "max_depth") else float for name in cls.__dataclass_fields__}
        if unknown := sorted(set(values) - set(kinds)):
            raise ValueError(f"no parameters of boosted trees: {', '.join(unknown)}")
        return cls(**{name: kinds[name](value) for name, value in values.items()})

    def weight(self, gradient: float, hessian: float) -> float:
        """Value of a leaf, shrunk by the learning rate."""
        pull = math.copysign(max(abs(gradient) - self.reg_alpha, 0.0), gradient)
        return -self.learning_rate * pull / (hessian + self.reg_lambda) if hessian + self.reg_lambda > 0 else 0.0


@dataclass(frozen=True)
class Split:
    """``x < cut`` goes left; ``cut`` is null where only missing values go right."""

    feature: int
    bin: int
    cut: float | None
    missing_left: bool
    gain: float


@dataclass
class Tree:
    """Nodes in heap order: the children of ``i`` are ``2i + 1`` and ``2i + 2``."""

    splits: dict[int, Split] = field(default_factory=dict)
    leaves: dict[int, float] = field(default_factory=dict)
    covers: dict[int, float] = field(default_factory=dict)


@dataclass
class BoostedModel:
    """Trees over named features; the margin is the sum of one leaf of each, from zero."""

    features: list[str]
    params: Params
    trees: list[Tree] = field(default_factory=list)

    def to_json(self) -> str:
        trees = [
            {
                "splits": {str(i): list(asdict(s).values()) for i, s in tree.splits.items()},
                "leaves": {str(i): value for i, value in tree.leaves.items()},
            }
            for tree in self.trees
        ]
        return json.dumps({"features": self.features, "params": asdict(self.params), "trees": trees})

    @classmethod
    def from_json(cls, text: str) -> BoostedModel:
        saved = json.loads(text)
        trees = [
            Tree(
                {int(i): Split(*values) for i, values in tree["splits"].items()},
                {int(i): value for i, value in tree["leaves"].items()},
            )
            for tree in saved["trees"]
        ]
        return cls(saved["features"], Params(**saved["params"]), trees)

    def importances(self) -> dict[str, float]:
        """Mean gain of a feature's splits, as shares of one."""
        gains: dict[str, list[float]] = {name: [] for name in self.features}
        for tree in self.trees:
            for split in tree.splits.values():
                gains[self.features[split.feature]].append(split.gain)
        means = {name: sum(of) / len(of) if of else 0.0 for name, of in gains.items()}
        total = sum(means.values()) or 1.0
        return {name: mean / total for name, mean in means.items()}


@dataclass
class Fit:
    """One model in the making, and the fold whose rows it doesn't see."""

    params: Params
    held_out: int | None = None


# Draws


def _number(*parts: object) -> int:
    return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:8], 16) % PRIME


def row_draw(tree: int) -> tuple[int, int]:
    """Factor and offset of the hash by which a tree draws its rows."""
    return _number(SEED, tree, "a"), _number(SEED, tree, "b")


def drawn_features(features: Sequence[str], tree: int, share: float) -> list[int]:
    """Positions of the columns a tree may split on: the first ones in the order of their hashes."""
    ordered = sorted(
        range(len(features)), key=lambda i: hashlib.md5(f"{SEED}|{tree}|{features[i]}".encode()).hexdigest()
    )
    return sorted(ordered[: max(1, int(share * len(features)))])


# Matrix


@dataclass(frozen=True)
class Matrix:
    """Binned training rows in blocks, and the cut points behind the bins."""

    blocks: DataFrame
    features: list[str]
    cuts: list[list[float]]
    max_bins: int


def cut_points(rows: DataFrame, features: Sequence[str], max_bins: int = MAX_BINS) -> list[list[float]]:
    """At most ``max_bins - 1`` cut points per feature, from mergeable quantile sketches in one pass.

    Missing values play no part. Up to some ten thousand rows the quantiles are exact.
    """
    shares = ", ".join(f"{i}D / {max_bins}" for i in range(1, max_bins))
    found = rows.agg(
        *(
            F.expr(f"percentile_approx({nan_to_null(name)}, array({shares}), {CUT_ACCURACY})").alias(f"c{i}")
            for i, name in enumerate(features)
        )
    ).first()
    return [sorted(set(found[i] or ())) for i in range(len(features))]


def binned(
    rows: DataFrame,
    features: Sequence[str],
    keys: Sequence[str],
    fold: str | None = None,
    label: str = LABEL,
    max_bins: int = MAX_BINS,
) -> Matrix:
    """Bin ``rows`` and write them once. ``keys`` name a row when rows are drawn; null folds are left out of none.

    Rows whose label is null are refused when the matrix is written.
    """
    if not 2 <= max_bins <= 255:
        raise ValueError("a bin is one byte: 2 to 255 bins")
    cuts = cut_points(rows, features, max_bins)
    key = "concat_ws('|', " + ", ".join(f"coalesce(CAST({k} AS STRING), '')" for k in keys) + ")"
    numbers = rows.select(
        *(F.expr(f"CAST({nan_to_null(name)} AS DOUBLE)").alias(f"x{i}") for i, name in enumerate(features)),
        F.expr(f"CAST(coalesce({label}, raise_error('a label is missing')) AS TINYINT) AS y"),
        (F.coalesce(F.col(fold), F.lit(NO_FOLD)) if fold else F.lit(NO_FOLD)).cast("int").alias("fold"),
        F.expr(f"CAST(conv(substr(md5({key}), 1, 8), 16, 10) AS BIGINT) % {PRIME} AS key"),
    )
    edges = [np.array(c) for c in cuts]

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (b.slice(at, ROWS_PER_BLOCK) for b in batches for at in range(0, b.num_rows, ROWS_PER_BLOCK))
        for batch in parts:
            bins = np.empty((len(edges), batch.num_rows), np.uint8)
            for i, edge in enumerate(edges):
                column = batch.column(i)
                values = column.fill_null(np.nan).to_numpy(zero_copy_only=False)
                bins[i] = np.searchsorted(edge, values, side="right")
                bins[i][np.isnan(values)] = max_bins
            rest = [batch.column(len(edges) + k).to_numpy() for k in range(3)]
            packed = [bins, rest[0].astype(np.int8), rest[1].astype(np.int32), rest[2].astype(np.int64)]
            yield pa.RecordBatch.from_pydict({
                name: pa.array([part.tobytes()], pa.binary())
                for name, part in zip(("bins", "y", "fold", "key"), packed, strict=True)
            })

    blocks = numbers.mapInArrow(block, "bins binary, y binary, fold binary, key binary")
    return Matrix(materialise(blocks, "binned"), list(features), cuts, max_bins)


# Passes


class Forest:
    """Trees of one fit as arrays, for rows of bins."""

    def __init__(self, trees: Sequence[Tree], depth: int):
        size = 2 ** (depth + 1) - 1
        self.depth = depth
        self.feature = np.full((len(trees), size), -1, np.int16)
        self.bin = np.zeros((len(trees), size), np.uint8)
        self.missing_left = np.zeros((len(trees), size), bool)
        self.value = np.zeros((len(trees), size))
        for t, tree in enumerate(trees):
            for i, split in tree.splits.items():
                self.feature[t, i], self.bin[t, i] = split.feature, split.bin
                self.missing_left[t, i] = split.missing_left
            for i, value in tree.leaves.items():
                self.value[t, i] = value

    def nodes(self, tree: int, bins: np.ndarray, missing: int) -> np.ndarray:
        """The node of a tree that each row ends in."""
        feature, cut, to_left = self.feature[tree], self.bin[tree], self.missing_left[tree]
        inner = np.flatnonzero(feature >= 0)
        if len(inner) <= FEW_SPLITS:
            at = np.zeros(bins.shape[1], np.min_scalar_type(len(feature)))
            for i in inner:
                value = bins[feature[i]]
                right = np.where(value == missing, not to_left[i], value > cut[i])
                at += (at == i) * (right + at.dtype.type(i + 1))
            return at.astype(np.int64)
        at = np.zeros(bins.shape[1], np.int64)
        rows = np.arange(bins.shape[1])
        for _ in range(self.depth):
            of = feature[at]
            value = bins[of, rows]
            left = np.where(value == missing, to_left[at], value <= cut[at])
            at = np.where(of >= 0, 2 * at + 2 - left, at)
        return at

    def margin(self, bins: np.ndarray, missing: int, before: np.ndarray | None = None) -> np.ndarray:
        """Sum of the trees' leaves, on top of the margin of the trees ``before``."""
        total = np.zeros(bins.shape[1]) if before is None else before.copy()
        for tree in range(len(self.feature)):
            total += self.value[tree][self.nodes(tree, bins, missing)]
        return total


#: Columns of a block as arrays: bins, label, fold, key, and the margins of fits where they are written.
KINDS = (np.uint8, np.int8, np.int32, np.int64, np.float64)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for row in range(batch.num_rows):
            columns = zip(batch.columns, KINDS, strict=False)
            bins, y, fold, key, *known = (np.frombuffer(c[row].as_buffer(), kind) for c, kind in columns)
            yield bins.reshape(-1, len(y)), y, fold, key, known[0].reshape(-1, len(y)) if known else None


@dataclass(frozen=True)
class Margins:
    """Blocks with the margins of some fits after their first ``n_trees`` trees."""

    blocks: DataFrame
    fits: list[int]
    n_trees: int

    def of(self, known: np.ndarray | None, fit: int) -> np.ndarray | None:
        return None if known is None else known[self.fits.index(fit)]


def with_margins(matrix: Matrix, before: Margins, forests: dict[int, Forest], n_trees: int) -> Margins:
    """Margins of the fits of ``forests``, which hold their trees from ``before`` up to ``n_trees``; written once."""
    missing, placed = matrix.max_bins, Margins(None, before.fits, before.n_trees)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bins, y, fold, key, known in _unpacked(batches):
            margins = np.stack([forest.margin(bins, missing, placed.of(known, i)) for i, forest in forests.items()])
            packed = zip(("bins", "y", "fold", "key", "margins"), (bins, y, fold, key, margins), strict=True)
            yield pa.RecordBatch.from_pydict({name: pa.array([part.tobytes()], pa.binary()) for name, part in packed})

    added = before.blocks.mapInArrow(add, "bins binary, y binary, fold binary, key binary, margins binary")
    # A block is megabytes here: row groups are cut by size at each row, not after a hundred.
    sizes = {"parquet.block.size": 32 << 20, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1}
    return Margins(materialise(added, "margins", **sizes), list(forests), n_trees)


def histograms(matrix: Matrix, fits: Sequence[Fit], forests: dict[int, Forest], growing: dict[int, Forest],
               open_: dict[int, list[int]], tree: int, margins: Margins | None = None) -> DataFrame:
    """``fit, node, feature, bin, g, h``: sums of gradients and hessians over the rows of each open node.

    ``forests`` hold the finished trees of each live fit that aren't in ``margins``, ``growing`` the tree at work.
    Each task gives its sums once.
    """
    margins = margins or Margins(matrix.blocks, [], 0)
    placed = Margins(None, margins.fits, margins.n_trees)
    features, missing = matrix.features, matrix.max_bins
    factor, offset = row_draw(tree)
    live = {i: (fits[i].params, NO_FOLD - 1 if fits[i].held_out is None else fits[i].held_out) for i in open_}
    columns = {i: drawn_features(features, tree, params.colsample_bytree) for i, (params, _) in live.items()}
    width = missing + 1
    alike: dict[tuple, list[int]] = {}  # fits that see the same rows
    for i, (params, held_out) in live.items():
        alike.setdefault((held_out, int(params.subsample * PRIME)), []).append(i)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {i: np.zeros((2, len(columns[i]), len(open_[i]) * width)) for i in live}
        for bins, y, fold, key, known in _unpacked(batches):
            draw = (key * factor + offset) % PRIME
            for (held_out, drawn), own in alike.items():
                used = np.flatnonzero((fold != held_out) & (draw < drawn))
                some, labels = bins[:, used], y[used]
                for i in own:
                    before = placed.of(known, i)
                    before = None if before is None else before[used]
                    p = 1 / (1 + np.exp(-forests[i].margin(some, missing, before)))
                    g, h = p - labels, p * (1 - p)
                    place = np.full(len(growing[i].value[0]), -1)
                    place[open_[i]] = np.arange(len(open_[i])) * width
                    start = place[growing[i].nodes(0, some, missing)]
                    inside = np.flatnonzero(start >= 0)
                    every = len(inside) == len(start)
                    start, g, h = (start, g, h) if every else (start[inside], g[inside], h[inside])
                    for k, f in enumerate(columns[i]):
                        at = start + (some[f] if every else some[f][inside])
                        sums[i][0, k] += np.bincount(at, g, sums[i].shape[2])
                        sums[i][1, k] += np.bincount(at, h, sums[i].shape[2])
        parts = []
        for i, both in sums.items():
            k, at = np.nonzero(both[1])
            parts.append((np.full(len(k), i), np.array(open_[i])[at // width], np.array(columns[i])[k], at % width,
                          both[0, k, at], both[1, k, at]))
        merged = [np.concatenate(column) for column in zip(*parts, strict=True)]
        if len(merged[0]):
            arrays = [pa.array(c.astype(np.int32)) for c in merged[:4]] + [pa.array(c) for c in merged[4:]]
            yield pa.RecordBatch.from_arrays(arrays, ["fit", "node", "feature", "bin", "g", "h"])

    found = margins.blocks.mapInArrow(add_up, "fit int, node int, feature int, bin int, g double, h double")
    # Tasks have summed up already; the windows behind need the bins of a feature together.
    found = found.repartition("fit", "node", "feature")
    return found.groupBy("fit", "node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


def best_splits(sums: DataFrame, settings: DataFrame, max_bins: int) -> DataFrame:
    """The best split of each node: ``fit, node, g, h`` and a struct ``best``, null where no split is allowed.

    ``settings (fit, l1, l2, child)`` is one row per fit. Ties go to the first feature, the lowest bin, missing
    values to the right.
    """
    # Bins of one feature of one node: bounded by max_bins.
    bins = "PARTITION BY fit, node, feature"
    sums = sums.selectExpr(
        "*",
        f"sum(g) OVER ({bins}) AS total_g",
        f"sum(h) OVER ({bins}) AS total_h",
        f"sum(IF(bin = {max_bins}, g, 0D)) OVER ({bins}) AS none_g",
        f"sum(IF(bin = {max_bins}, h, 0D)) OVER ({bins}) AS none_h",
        f"sum(g) OVER ({bins} ORDER BY bin ROWS UNBOUNDED PRECEDING) AS below_g",
        f"sum(h) OVER ({bins} ORDER BY bin ROWS UNBOUNDED PRECEDING) AS below_h",
    )
    both = sums.join(F.broadcast(settings), "fit").selectExpr(
        "*", "inline(array(struct(false AS missing_left, below_g AS left_g, below_h AS left_h), "
        "struct(true AS missing_left, below_g + none_g AS left_g, below_h + none_h AS left_h)))"
    )
    gain = "{0}(left_g, left_h) + {0}(total_g - left_g, total_h - left_h) - {0}(total_g, total_h)"
    for name in ("left_g", "total_g - left_g", "total_g"):
        hessian = name.replace("_g", "_h")
        gain = gain.replace(
            f"{{0}}({name}, {hessian})", f"pow(greatest(abs({name}) - l1, 0D), 2) / ({hessian} + l2)"
        )
    allowed = (
        f"bin < {max_bins} AND left_h >= child AND total_h - left_h >= child AND left_h > 0 AND total_h - left_h > 0"
    )
    rated = both.selectExpr("*", f"CASE WHEN {allowed} THEN {gain} END AS gain")
    rated = rated.selectExpr(
        "*",
        f"CASE WHEN gain > {LEAST_GAIN!r}D THEN struct(-round(gain, {GAIN_DIGITS}) AS minus_gain, feature, bin, "
        "missing_left, gain, left_g, left_h) END AS split",
    )
    return rated.groupBy("fit", "node").agg(
        F.min("split").alias("best"),
        F.expr("min_by(total_g, feature) AS g"),
        F.expr("min_by(total_h, feature) AS h"),
    )


def boost(matrix: Matrix, fits: Sequence[Fit]) -> list[BoostedModel]:
    """Grow all fits, one level of one tree of each at a time."""
    spark = matrix.blocks.sparkSession
    models = [BoostedModel(matrix.features, fit.params) for fit in fits]
    settings = spark.createDataFrame(
        [
            (i, float(p.reg_alpha), float(p.reg_lambda), float(p.min_child_weight))
            for i, p in enumerate(fit.params for fit in fits)
        ],
        "fit int, l1 double, l2 double, child double",
    )
    margins = Margins(matrix.blocks, [], 0)
    for round_ in range(max((fit.params.n_estimators for fit in fits), default=0)):
        live = [i for i, fit in enumerate(fits) if round_ < fit.params.n_estimators]
        forests = {i: Forest(models[i].trees[margins.n_trees :], fits[i].params.max_depth) for i in live}
        if round_ - margins.n_trees >= TREES_PER_STEP:
            spent, margins = margins, with_margins(matrix, margins, forests, round_)
            if spent.n_trees:
                discard(spent.blocks)
            forests = {i: Forest([], fits[i].params.max_depth) for i in live}
        trees = {i: Tree() for i in live}
        open_ = {i: [0] for i in live if fits[i].params.max_depth > 0}
        while open_:
            growing = {i: Forest([trees[i]], fits[i].params.max_depth) for i in open_}
            sums = histograms(matrix, fits, forests, growing, open_, round_, margins)
            rows = best_splits(sums, settings, matrix.max_bins).collect()
            deeper: dict[int, list[int]] = {}
            for row in rows:
                i, node, best = row["fit"], row["node"], row["best"]
                params, tree = fits[i].params, trees[i]
                if node == 0:
                    tree.leaves[0], tree.covers[0] = params.weight(row["g"], row["h"]), row["h"]
                if best is None or best["gain"] < params.gamma:
                    continue
                cuts = matrix.cuts[best["feature"]]
                cut = cuts[best["bin"]] if best["bin"] < len(cuts) else None
                tree.splits[node] = Split(best["feature"], best["bin"], cut, best["missing_left"], best["gain"])
                del tree.leaves[node]
                left, right = 2 * node + 1, 2 * node + 2
                sides = ((left, best["left_g"], best["left_h"]),
                         (right, row["g"] - best["left_g"], row["h"] - best["left_h"]))
                for child, g, h in sides:
                    tree.leaves[child], tree.covers[child] = params.weight(g, h), h
                if right < 2**params.max_depth - 1:
                    deeper.setdefault(i, []).extend([left, right])
            open_ = {i: sorted(nodes) for i, nodes in deeper.items()}
        for i in live:
            models[i].trees.append(trees[i])
    if margins.n_trees:
        discard(margins.blocks)
    return models


def held_out_counts(matrix: Matrix, fits: Sequence[Fit], models: Sequence[BoostedModel]) -> DataFrame:
    """``fit, y, predicted, n``: hard predictions of the rows each fit left out, counted in one pass."""
    missing = matrix.max_bins
    forests = [Forest(model.trees, model.params.max_depth) for model in models]
    folds = [fit.held_out for fit in fits]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros((len(folds), 4), np.int64)
        for bins, y, fold, *_ in _unpacked(batches):
            for i, held_out in enumerate(folds):
                if held_out is None:
                    continue
                own = fold == held_out
                predicted = forests[i].margin(bins[:, own], missing) > 0
                cells[i] += np.bincount(2 * y[own] + predicted, minlength=4)
        i, cell = np.nonzero(cells)
        yield pa.RecordBatch.from_pydict({
            "fit": pa.array(i.astype(np.int32)), "y": pa.array((cell // 2).astype(np.int32)),
            "predicted": pa.array((cell % 2).astype(np.int32)), "n": pa.array(cells[i, cell]),
        })

    counted = matrix.blocks.mapInArrow(count, "fit int, y int, predicted int, n long")
    return counted.groupBy("fit", "y", "predicted").agg(F.sum("n").alias("n"))


def tree_nodes(spark: SparkSession, model: BoostedModel) -> DataFrame:
    """A model as a table: one row per node, with the split or the weight it has."""
    rows = []
    for number, tree in enumerate(model.trees):
        for node, split in tree.splits.items():
            name = model.features[split.feature]
            rows.append((number, node, name, split.cut, split.missing_left, split.gain, None, tree.covers.get(node)))
        for node, weight in tree.leaves.items():
            rows.append((number, node, None, None, None, None, weight, tree.covers.get(node)))
    return spark.createDataFrame(
        rows,
        "tree int, node int, feature string, cut double, missing_left boolean, gain double, weight double, cover double",
    )
