"""Hard negatives by a GNAT-style multiway hyperplane tree.

Vectors become integers, ``floor(scale * x)``, and a score is their inner product.
One more coordinate gives every vector the same length M, and an anchor a 0
there; then ``distance**2 = |anchor|**2 + M**2 - 2 * score``, and a window of
scores is an annulus around the anchor.

A node of the tree has split points, and a vector goes to the nearest one.  Each
split point stores the distance range to the vectors of every sibling subtree,
taken over all rows.  By the triangle inequality the ranges bound an anchor's
distance to a subtree, and subtrees outside its annuli are left out.  Leaves are
compared exactly, in 64-bit floats that hold every integer score.

1. Positives: the anchor's own leaf first; its worst kept score is the least that
   other leaves must reach, and only those that can are compared.
2. Negatives: the leaves that a window of one of the positives meets.

Work is dealt by (block of anchors, leaf, tile of the leaf): blocks and tiles are
of bounded size, so neither a hot vector nor a hot label makes a group grow.  The
tree has at most ``MAX_LEAVES`` leaves and is fitted on at most ``FIT_ROWS`` rows;
every row is put into it."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.io import cut_lineage

#: Rows the tree is fitted on (at most), split points of a node, leaves (at most), rows a leaf is meant to have.
FIT_ROWS, FANOUT, MAX_LEAVES, LEAF = 16_384, 16, 4_096, 2_048
#: Anchors of a block, rows of a tile (about), scores held at a time in a task.
BLOCK, TILE, CELLS = 4_096, 4_096, 1 << 21
#: Scores below it are exact as 64-bit floats, and so is a hundred times a score.
EXACT = 2.0 ** 46
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


@dataclass
class Node:
    """Split points (lifted), and per split point its child: a node, or ``~leaf``."""
    pivots: np.ndarray
    children: list[int]
    low: np.ndarray = field(default_factory=lambda: np.zeros(0))      # [split point, sibling]: least distance
    high: np.ndarray = field(default_factory=lambda: np.zeros(0))


class Tree:
    """``size`` is M squared; without nodes there is a single leaf."""

    def __init__(self, dim: int, size: float):
        self.dim, self.size, self.nodes, self.n_leaves = dim, size, [], 1

    def lift(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.size - (x * x).sum(axis=1), 0))
        return np.concatenate([x, rest[:, None]], axis=1)

    def distances(self, lifted: np.ndarray, pivots: np.ndarray) -> np.ndarray:
        square = (lifted * lifted).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1) - 2 * lifted @ pivots.T
        return np.sqrt(np.maximum(square, 0))

    def grow(self, points: np.ndarray, leaves: int, fanout: int) -> None:
        """Split ``points`` (lifted) into about ``leaves`` leaves.  A child's share of
        them is that of its points, three quarters at most, rounded down: where one
        child takes nearly all points, splitting ends soon."""
        self.n_leaves = 0
        self._grow(points, leaves, fanout)

    def _grow(self, points: np.ndarray, leaves: int, fanout: int) -> int:
        chosen = self._split_points(points, min(fanout, leaves)) if leaves > 1 and len(points) > 1 else points[:1]
        if len(chosen) < 2:
            self.n_leaves += 1
            return ~(self.n_leaves - 1)
        number = len(self.nodes)
        node = Node(chosen, [])
        self.nodes.append(node)
        nearest = self.distances(points, chosen).argmin(axis=1)
        for j in range(len(chosen)):
            mine = points[nearest == j]
            node.children.append(self._grow(mine, int(leaves * min(len(mine) / len(points), 0.75)), fanout))
        return number

    def _split_points(self, points: np.ndarray, k: int) -> np.ndarray:
        """Of the first 3 k points, k that lie far from each other; equal ones count once."""
        some = points[:3 * k]
        chosen, gap = [0], self.distances(some, some[:1])[:, 0]
        while len(chosen) < k and gap.max() > self.slack():
            chosen.append(int(gap.argmax()))
            gap = np.minimum(gap, self.distances(some, some[chosen[-1:]])[:, 0])
        return some[chosen]

    def slack(self) -> float:
        """More than any rounding error of a distance."""
        return 1e-6 * math.sqrt(self.size) + 1e-9

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every vector."""
        out, lifted = np.zeros(len(x), np.int32), self.lift(x)
        todo = [(0, np.arange(len(x)))] if self.nodes else []
        while todo:
            number, at = todo.pop()
            node = self.nodes[number]
            nearest = self.distances(lifted[at], node.pivots).argmin(axis=1)
            for j, child in enumerate(node.children):
                mine = at[nearest == j]
                if child < 0:
                    out[mine] = ~child
                elif len(mine):
                    todo.append((child, mine))
        return out

    def paths(self) -> dict[int, list[tuple[int, int]]]:
        """Leaf -> the (node, child number) pairs above it."""
        out: dict[int, list[tuple[int, int]]] = {}
        todo = [(0, [])] if self.nodes else []
        while todo:
            number, above = todo.pop()
            for j, child in enumerate(self.nodes[number].children):
                here = [*above, (number, j)]
                if child < 0:
                    out[~child] = here
                else:
                    todo.append((child, here))
        return out

    def ranges(self, x: np.ndarray, leaf: np.ndarray, found: dict) -> None:
        """Widen ``found[node, child]`` = (least, greatest) distances of the node's
        split points to the vectors below that child."""
        lifted, paths = self.lift(x), self.paths()
        for one in np.unique(leaf).tolist():
            for number, j in paths.get(one, ()):
                d = self.distances(lifted[leaf == one], self.nodes[number].pivots)
                low, high = found.get((number, j), (np.inf, -np.inf))
                found[number, j] = np.minimum(low, d.min(axis=0)), np.maximum(high, d.max(axis=0))

    def reach(self, x: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[list[int]]:
        """Per anchor of ``x`` the leaves that can hold a score in one of its windows
        ``low <= score <= high``, each an array (anchors, windows)."""
        out: list[list[int]] = [[] for _ in range(len(x))]
        wanted = np.flatnonzero((low <= high).any(axis=1))
        if not self.nodes:
            for a in wanted.tolist():
                out[a].append(0)
            return out
        lifted = np.concatenate([x, np.zeros((len(x), 1))], axis=1)
        middle = ((x * x).sum(axis=1) + self.size) / 2
        step = max(1, CELLS // max(len(n.pivots) for n in self.nodes) ** 2)
        todo = [(0, wanted[i:i + step]) for i in range(0, len(wanted), step)]
        while todo:
            number, at = todo.pop()
            node = self.nodes[number]
            d = self.distances(lifted[at], node.pivots)[:, :, None]
            least = np.maximum(np.maximum(node.low - d, d - node.high).max(axis=1) - self.slack(), 0)
            most = (d + node.high).min(axis=1) + self.slack()
            best, worst = middle[at, None] - least ** 2 / 2, middle[at, None] - most ** 2 / 2
            room = 1e-9 * (middle[at] + 1)
            for j, child in enumerate(node.children):
                meets = (((best[:, j] + room)[:, None] >= low[at]) & ((worst[:, j] - room)[:, None] <= high[at])
                         & (low[at] <= high[at])).any(axis=1) & np.isfinite(node.low[:, j]).all()
                mine = at[meets]
                if child >= 0 and len(mine):
                    todo.append((child, mine))
                elif child < 0:
                    for a in mine.tolist():
                        out[a].append(~child)
        return out


def integers(rows: list, dim: int, scale: int) -> np.ndarray:
    """floor(scale * x) of every component; shorter vectors end in zeros."""
    sizes = np.array([len(r) for r in rows], np.int64)
    out = np.zeros((len(rows), dim))
    out[np.arange(dim) < sizes[:, None]] = np.floor(scale * np.concatenate(
        [np.zeros(0), *[np.asarray(r, np.float64) for r in rows]]))
    return out


def inner_products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """All scores, exact: in floats where they hold them, else in Python's integers."""
    size = max((np.abs(v).max(initial=0) for v in (x, y)), default=0)
    if size * size * x.shape[1] < EXACT:
        return x @ y.T
    whole = np.frompyfunc(int, 1, 1)
    return whole(x).astype(object) @ whole(y).astype(object).T


def _top(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's k highest allowed scores, ties by column."""
    masked = np.where(allowed, scores, -np.inf)
    if masked.shape[1] > k:
        kth = (np.sort(masked, axis=1)[:, -k] if masked.dtype == object
               else np.partition(masked, -k, axis=1)[:, -k])
        allowed = allowed & (masked >= kth[:, None])
    row, column = _ordered(scores, allowed)
    first = _places(row) < k
    return row[first], column[first]


def _ordered(scores: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the allowed scores, by row, then higher scores first, then by column."""
    row, column = np.nonzero(allowed)
    value = scores[row, column]
    order = (np.lexsort((column, -value, row)) if value.dtype != object else
             np.array(sorted(range(len(row)), key=lambda i: (row[i], -value[i], column[i])), np.int64))
    return row[order], column[order]


def _places(row: np.ndarray) -> np.ndarray:
    """The place of each element among those of its row, from 0."""
    return np.arange(len(row)) - np.searchsorted(row, row, "left")


def _longs(values: np.ndarray) -> np.ndarray:
    """As 64-bit integers; greater ones are cut to the range."""
    if values.dtype == object:
        return np.array([min(max(int(v), -2 ** 63), 2 ** 63 - 1) for v in values], np.int64)
    return values.astype(np.int64)


def _each(anchors: pd.DataFrame, rows: pd.DataFrame, tree: Tree, scale: int) -> Iterator[tuple]:
    """(some anchors, all rows in the order of vec_id, their scores), a bounded
    number of scores at a time."""
    rows = rows.sort_values(["late", "vec_id", "rid"])
    y = integers(rows["embedding"].tolist(), tree.dim, scale)
    step = max(1, CELLS // max(1, len(rows)))
    for a in range(0, len(anchors), step):
        some = anchors.iloc[a:a + step]
        yield some, rows, inner_products(integers(some["embedding"].tolist(), tree.dim, scale), y)


def _ids(rows: pd.DataFrame, at: np.ndarray) -> pd.arrays.IntegerArray:
    return pd.arrays.IntegerArray(rows["vec_id"].to_numpy(np.int64)[at], rows["late"].to_numpy(bool)[at])


def _same_label(some: pd.DataFrame, rows: pd.DataFrame) -> np.ndarray:
    number, _ = pd.factorize(pd.concat([some["label"], rows["label"]]))
    return number[:len(some), None] == number[len(some):]


def positives_in(anchors: pd.DataFrame, rows: pd.DataFrame, tree: Tree, scale: int, k: int) -> pd.DataFrame:
    """Per anchor its first k other rows of the same label among ``rows``."""
    out = [pd.DataFrame({"rid": [], "score": [], "found": pd.array([], "Int64")})]
    for some, rows, scores in _each(anchors, rows, tree, scale):
        allowed = _same_label(some, rows) & (some["rid"].to_numpy()[:, None] != rows["rid"].to_numpy())
        r, c = _top(scores, allowed, k)
        out.append(pd.DataFrame({"rid": some["rid"].to_numpy()[r], "score": _longs(scores[r, c]), "found": _ids(rows, c)}))
    return pd.concat(out[1:] or out)


def negatives_in(anchors: pd.DataFrame, rows: pd.DataFrame, tree: Tree, scale: int, k: int, low: int,
                 high: int) -> pd.DataFrame:
    """Per anchor and positive the first k rows of another label whose score is from
    ``low`` to ``high`` hundredths of the positive's."""
    out = [pd.DataFrame({"rid": [], "place": [], "score": [], "found": pd.array([], "Int64")})]
    for some, rows, scores in _each(anchors, rows, tree, scale):
        targets = [[int(p) if p >= 0 else None for p in t] for t in some["targets"]]     # below 0 no score fits
        fit = [[p for p in t if p is not None] for t in targets]
        least, most = (np.array([f(t) if t else -1 for t in fit], scores.dtype)[:, None] for f in (min, max))
        hundred = 100 * scores
        row, column = _ordered(scores, ~_same_label(some, rows) & (least >= 0) & (low * least <= hundred)
                               & (hundred <= high * most))
        value = hundred[row, column]
        for place in range(max(map(len, targets), default=0)):
            p = np.array([t[place] if place < len(t) and t[place] is not None else -1 for t in targets], scores.dtype)[row]
            at = np.flatnonzero((p >= 0) & (low * p <= value) & (value <= high * p))
            at = at[_places(row[at]) < k]
            r, c = row[at], column[at]
            out.append(pd.DataFrame({"rid": some["rid"].to_numpy()[r], "place": place,
                                     "score": _longs(scores[r, c]), "found": _ids(rows, c)}))
    return pd.concat(out[1:] or out)


def finite(vector: Column) -> Column:
    """Not null, and no null, NaN or infinite component."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def _batches(df: DataFrame, schema: str, step: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield step(batch)
    return df.mapInPandas(run, schema)


def fit_tree(rows: DataFrame, scale: int, fit_rows: int, leaf_rows: int, fanout: int) -> tuple[Tree, int]:
    """The tree over at most ``fit_rows`` rows (drawn by a hash of the row's
    number), and how many rows there are."""
    def measure(batch: pd.DataFrame) -> pd.DataFrame:
        dim = max(map(len, batch["embedding"]))
        x = integers(batch["embedding"].tolist(), dim, scale)
        return pd.DataFrame({"n": [len(x)], "dim": [dim], "size": [float((x * x).sum(axis=1).max())]})
    known = _batches(rows.select("embedding"), "n long, dim int, size double", measure).agg(
        F.sum("n").alias("n"), F.max("dim").alias("dim"), F.max("size").alias("size")).first()
    n = known["n"] or 0
    tree = Tree(known["dim"] or 0, known["size"] or 0.0)
    leaves = min(MAX_LEAVES, math.ceil(n / leaf_rows))
    if leaves > 1:
        h = F.xxhash64("rid", F.lit(11))
        share = min(1.0, 2 * fit_rows / n)
        drawn = (rows.where(F.pmod(h, F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).select(h.alias("h"), "rid", "embedding")
                 .orderBy("h", "rid").limit(fit_rows).select("embedding").toPandas())
        points = tree.lift(integers(drawn["embedding"].tolist(), tree.dim, scale))
        tree.grow(points, leaves, fanout)
    return tree, n


def _stored_ranges(rows: DataFrame, tree: Tree, scale: int) -> None:
    """Distance ranges of every split point to every sibling subtree, over all rows."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict = {}
        for batch in batches:
            if len(batch):
                tree.ranges(integers(batch["embedding"].tolist(), tree.dim, scale), batch["leaf"].to_numpy(), found)
        yield pd.DataFrame([(node, i, j, low[i], high[i]) for (node, j), (low, high) in found.items()
                            for i in range(len(low))], columns=["node", "i", "j", "low", "high"])
    got = (rows.select("embedding", "leaf").mapInPandas(run, "node int, i int, j int, low double, high double")
           .groupBy("node", "i", "j").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect())
    for node in tree.nodes:
        node.low = np.full((len(node.pivots),) * 2, np.inf)
        node.high = np.full((len(node.pivots),) * 2, -np.inf)
    for r in got:
        tree.nodes[r.node].low[r.i, r.j], tree.nodes[r.node].high[r.i, r.j] = r.low, r.high


def _first(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k first of each key by score, ties by vec_id."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("found").asc_nulls_last())
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine_hard_negatives(vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, low: int = 50,
                        high: int = 95, scale: int = 256, fit_rows: int = FIT_ROWS, leaf_rows: int = LEAF,
                        fanout: int = FANOUT) -> DataFrame:
    """For each anchor (a row of ``vectors`` where ``anchors`` holds) and each of its
    ``positives`` first other rows of the same label, the ``negatives`` first rows of
    another label whose score is from ``low`` to ``high`` hundredths of the
    positive's: anchor_id, positive_id, rank (from 1), negative_id, positive_score,
    negative_score.  Higher scores come first, ties by the smaller vec_id, a null
    one last.

    Rows with a null label, a null vector or a null or non-finite component take no
    part.  A shorter vector counts as ending in zeros.  Repeated rows are rows of
    their own, also as anchors.  An anchor without positives, or a positive without
    negatives, gives no rows, and so does an empty table.  Scores beyond 64 bits are
    cut to that range.  Only vec_id, embedding and label are read, besides what
    ``anchors`` names."""
    kind = vectors.schema["embedding"].dataType
    vector = F.col("embedding")
    if not (isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.FloatType, T.DoubleType))):
        vector = vector.cast("array<double>")
    element = "float" if isinstance(getattr(kind, "elementType", None), T.FloatType) else "double"
    rows = cut_lineage(
        vectors.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(0).cast("long")).alias("vec_id"),
                       F.col("vec_id").isNull().alias("late"), F.col("label").cast("string").alias("label"),
                       vector.alias("embedding"), F.coalesce(anchors, F.lit(False)).alias("anchor"))
        .where(F.col("label").isNotNull() & finite(F.col("embedding")))
        .withColumn("rid", F.monotonically_increasing_id()))
    tree, n = fit_tree(rows, scale, fit_rows, leaf_rows, fanout)
    spark = vectors.sparkSession
    if not n:
        return spark.createDataFrame([], RESULT)

    def settle(batch: pd.DataFrame) -> pd.DataFrame:
        batch["leaf"] = tree.leaf_of(integers(batch["embedding"].tolist(), tree.dim, scale))
        return batch
    row = f"rid long, vec_id long, late boolean, label string, embedding array<{element}>, anchor boolean"
    rows = cut_lineage(_batches(rows.select("rid", "vec_id", "late", "label", "embedding", "anchor"),
                                f"{row}, leaf int", settle))
    if tree.nodes:
        _stored_ranges(rows, tree, scale)
    sizes = rows.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("anchors")).orderBy("leaf").collect()
    starts, table = 0, []
    for r in sizes:
        table.append((r.leaf, math.ceil(r.n / TILE), starts, max(r.anchors, 1)))
        starts += r.anchors
    leaves = spark.createDataFrame(table, "leaf int, tiles int, start long, anchors long")
    tiles = {leaf: t for leaf, t, _, _ in table}
    tiled = rows.join(leaves, "leaf").withColumn("tile", F.pmod(F.xxhash64("rid", F.lit(13)), F.col("tiles")).cast("int"))
    asked = cut_lineage(
        rows.where("anchor").join(leaves, "leaf")
        .select("rid", F.when(~F.col("late"), F.col("vec_id")).alias("anchor_id"), "label", "embedding", "leaf",
                F.sequence(F.lit(0), F.col("tiles") - 1).alias("own"),
                F.floor((F.col("start") + F.pmod(F.xxhash64("rid", F.lit(17)), F.col("anchors"))) / BLOCK).alias("block")))

    def compare(placed: DataFrame, work: Callable, schema: str) -> DataFrame:
        """``work`` on the anchors and rows of every (block, leaf, tile) that has anchors."""
        unit = ["block", "leaf", "tile"]
        wanted = placed.withColumn("at", F.explode("places")).select("*", "at.leaf", "at.tile").drop("places", "at")
        units = wanted.select(F.col("block").alias("b"), F.col("leaf").alias("l"), F.col("tile").alias("t")).distinct()
        shipped = tiled.join(units, (F.col("leaf") == F.col("l")) & (F.col("tile") == F.col("t"))).select(
            F.col("b").alias("block"), F.col("l").alias("leaf"), F.col("t").alias("tile"), "rid", "vec_id", "late", "label", "embedding")
        return wanted.groupBy(*unit).cogroup(shipped.groupBy(*unit)).applyInPandas(work, schema)

    def placed(df: DataFrame, windows: Callable[[pd.DataFrame], tuple[np.ndarray, np.ndarray]], skip_own: bool) -> DataFrame:
        """Adds ``places``: the (leaf, tile) pairs that an anchor's windows reach."""
        def step(batch: pd.DataFrame) -> pd.DataFrame:
            reached = tree.reach(integers(batch["embedding"].tolist(), tree.dim, scale), *windows(batch))
            batch["places"] = [[{"leaf": leaf, "tile": t} for leaf in some if not (skip_own and leaf == own)
                                for t in range(tiles.get(leaf, 0))] for some, own in zip(reached, batch["leaf"])]
            return batch.drop(columns="leaf")
        columns = f"rid long, label string, embedding array<{element}>, block long, targets array<bigint>"
        return cut_lineage(_batches(df.select("rid", "label", "embedding", "block", "targets", "leaf"),
                                    f"{columns}, places array<struct<leaf: int, tile: int>>", step))

    def find_positives(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return positives_in(a, b, tree, scale, positives)

    def find_negatives(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return negatives_in(a, b, tree, scale, negatives, low, high)

    found = "rid long, score long, found long"
    own = asked.select("rid", "label", "embedding", "block", F.transform("own", lambda t: F.struct(
        F.col("leaf").alias("leaf"), t.alias("tile"))).alias("places"))
    near = cut_lineage(_first(compare(own, find_positives, found), ["rid"], positives))
    if tree.nodes:
        worst = near.groupBy("rid").agg(F.collect_list("score").alias("targets"))
        least = asked.join(worst, "rid", "left").withColumn("targets", F.coalesce("targets", F.array().cast("array<bigint>")))

        def at_least(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
            reach = [float(min(t)) if len(t) == positives else -np.inf for t in batch["targets"]]
            return np.array(reach)[:, None], np.full((len(batch), 1), np.inf)
        far = compare(placed(least, at_least, True), find_positives, found)
        near = cut_lineage(_first(near.select("rid", "score", "found").unionByName(far), ["rid"], positives))
    chosen = near.select("rid", (F.col("rank") - 1).alias("place"), F.col("score").alias("positive_score"),
                         F.col("found").alias("positive_id"))
    targets = near.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("t")).select(
        "rid", F.transform("t", lambda x: x["score"]).alias("targets"))

    def windows(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        below, above = np.full((2, len(batch), positives), np.nan)
        for i, t in enumerate(batch["targets"]):
            below[i, :len(t)], above[i, :len(t)] = np.asarray(t, float) * low / 100, np.asarray(t, float) * high / 100
        return below, above
    got = compare(placed(asked.join(targets, "rid"), windows, False), find_negatives,
                  "rid long, place int, score long, found long")
    ranked = _first(got, ["rid", "place"], negatives)
    return (ranked.join(chosen, ["rid", "place"]).join(asked.select("rid", "anchor_id"), "rid")
            .select("anchor_id", "positive_id", "rank", F.col("found").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))
