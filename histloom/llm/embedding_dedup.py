"""Embedding near-duplicates by sorted projection passes.

Each pass gives every vector a code, the concatenated signs of random
projections of its direction less its label's mean, and orders the vectors of a
label lexicographically by code.  Vectors within ``window`` places are compared by
exact cosine; the verified pairs of all passes are united.  Then links are
counted exactly: within a component all pairs are compared, in tiles of bounded
size, so a window never caps a vector's links.

How many passes a label takes follows from its number of vectors and from how much
they share a direction.  A linked vector lies at most ``asin(d / r)`` away, seen from
the mean (d: distance of directions at the least cosine, r: the vector's own from
the mean), so a bit agrees with probability ``a = 1 - asin(d / r) / pi`` at least.  In
a pass where ``b`` bits tell a vector from those beyond its window, it meets a linked
one with probability ``a**b``; b is measured in every pass.  Vectors that would by
this be missed with more than ``MISS`` are compared with all of their label, in
tiles of bounded size: the exact way for what windows cannot reach.

Equal vectors of a label are one class and are handled once.  The rank of a
vector in a pass comes from ranges and their counts, and windows run over
blocks of ranks, so no label or code, however frequent, makes a task grow."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.io import cut_lineage
from .components import connected_components
from .sharding import assign_slots

#: Passes of a label at most, places of a window, and how likely a link may be missed
#: before its vector is compared with all others.
MAX_PASSES, WINDOW, MISS = 48, 32, 0.002
#: Projections concatenated to a code, ranks per block, vectors per tile.
CODE_BITS, BLOCK, TILE = 48, 2048, 1024
#: Fixed value: least cosine of a link.
COSINE = 0.98


def agreement(radius: np.ndarray, cosine: float) -> np.ndarray:
    """Least probability that a random projection has one sign for two linked
    directions, one of which lies ``radius`` from the mean."""
    reach = np.sqrt(2 - 2 * cosine) / np.maximum(radius, 1e-12)
    return np.where(reach < 1, 1 - np.arcsin(np.minimum(reach, 1)) / np.pi, 0.0)


def passes_needed(n: int, spread: float, cosine: float, window: int, max_passes: int) -> int:
    """Passes for a label of ``n`` vectors with mean square distance ``spread`` from the
    mean; 0 if ``max_passes`` would not do."""
    if n <= window + 1:
        return 1                       # all of them lie within one window
    found = float(agreement(np.sqrt(max(spread, 0.0)), cosine)) ** (np.log2(n / window) + 2)
    if found >= 1:
        return 1
    passes = int(np.ceil(np.log(MISS) / np.log1p(-found))) if found > 1e-9 else max_passes + 1
    return passes if passes <= max_passes else 0


def projections(dim: int, passes: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, passes * CODE_BITS))


def codes(vectors: np.ndarray, passes: int, seed: int) -> np.ndarray:
    """(n, passes) codes: CODE_BITS signs each, the first in the highest bit."""
    signs = (vectors @ projections(vectors.shape[1], passes, seed) >= 0).reshape(len(vectors), passes, CODE_BITS)
    return signs @ (1 << np.arange(CODE_BITS - 1, -1, -1, dtype=np.int64))


def _unit(rows: pd.Series) -> np.ndarray:
    """The vectors in double precision, each scaled to a largest component of 1;
    shorter ones (which are never compared with longer ones) end in zeros."""
    sizes = rows.map(len).to_numpy()
    x = np.zeros((len(rows), sizes.max(initial=1)))
    x[np.arange(x.shape[1]) < sizes[:, None]] = np.concatenate([np.zeros(0), *rows.to_numpy()])
    return x / np.abs(x).max(axis=1, keepdims=True)


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row-wise cosines in double precision."""
    return (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))


def forest(names: np.ndarray, pairs: list[tuple[int, int]]) -> pd.DataFrame:
    """As few of the links ``pairs`` (places in ``names``) as join what all of them join."""
    parent = list(range(len(names)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x
    kept = []
    for x, y in pairs:
        p, q = root(x), root(y)
        if p != q:
            parent[p] = q
            kept.append((names[x], names[y]))
    return pd.DataFrame(kept, columns=["a", "b"])


def window_links(block: pd.DataFrame, window: int, block_size: int, cosine: float) -> pd.DataFrame:
    """(a, b, miss): a forest of the links between the block's own rows and the
    ``window`` next ones, and per own row (a, null) the logarithm of the estimated
    probability that a linked vector lies beyond its window."""
    block = block.sort_values("slot")
    place = (block["slot"] // block_size).to_numpy()
    own = np.flatnonzero(place == block["block"].to_numpy())
    x, names, labels = _unit(block["embedding"]), block["cid"].to_numpy(), block["part"].to_numpy()
    code, slot = block["code"].to_numpy(), block["slot"].to_numpy()
    pairs: list[tuple[int, int]] = []
    for step in range(1, window + 1):
        i = own[own + step < len(block)]
        near = (cosines(x[i], x[i + step]) >= cosine) & (labels[i] == labels[i + step])
        pairs += [(k, k + step) for k in i[near].tolist()]
    # bits that tell a row from the first ones beyond its window, on either side (0: none there)
    bits = np.zeros(len(own), np.int64)
    for shift in (window + 1, -window - 1):
        j = own + shift
        inside = (j >= 0) & (j < len(block))
        i, j = own[inside], j[inside]
        same = labels[i] == labels[j]
        shared = CODE_BITS - np.frexp((code[i] ^ code[j]).astype(float))[1]
        bits[inside] = np.maximum(bits[inside], np.where(same, np.minimum(shared + 1, CODE_BITS), 0))
    found = np.minimum(block["agree"].to_numpy()[own] ** bits, 1 - 1e-12)
    out = forest(names, pairs)
    out["miss"] = np.nan
    return pd.concat([out, pd.DataFrame({"a": names[own], "b": None, "miss": np.log1p(-found)})])


def rest_links(group: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """A forest of the links between a tile of left-over vectors and one of all."""
    x = _unit(group["embedding"])
    x = x / np.sqrt((x * x).sum(axis=1))[:, None]
    names, first = group["cid"].to_numpy(), np.flatnonzero(group["side"].to_numpy() == 0)
    second = np.flatnonzero(group["side"].to_numpy() == 1)
    near = x[first] @ x[second].T >= cosine - 1e-9
    i, j = first[np.nonzero(near)[0]], second[np.nonzero(near)[1]]
    exact = (names[i] != names[j]) & (cosines(x[i], x[j]) >= cosine)
    return forest(*_numbered(names, i[exact], j[exact]))


def _numbered(names: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The distinct names and the pairs as places among them (a vector may be in both tiles)."""
    known, at = np.unique(names, return_inverse=True)
    return known, list(zip(at[i].tolist(), at[j].tolist()))


def tile_links(tile: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Per class of the first tile of a pair of tiles, how many vectors of the
    second it is linked with (itself apart)."""
    x = _unit(tile["embedding"])
    first, second = tile["side"].to_numpy() == 0, tile["side"].to_numpy() == 1
    norm = np.sqrt((x * x).sum(axis=1))
    names, size = tile["cid"].to_numpy(), tile["size"].to_numpy()
    near = (x[first] @ x[second].T) / np.outer(norm[first], norm[second]) >= cosine
    near &= names[first][:, None] != names[second][None, :]
    return pd.DataFrame({"cid": names[first], "n": (near * size[second][None, :]).sum(axis=1)})


def usable(vector: Column) -> Column:
    """No null, NaN or infinite component, and not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def near_vectors(vectors: DataFrame, cosine: float = COSINE, window: int = WINDOW, seed: int = 1,
                 max_passes: int = MAX_PASSES) -> DataFrame:
    """Per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links (other
    vectors linked directly), component_id (smallest vec_id reached by links,
    its own included), kept (vec_id = component_id).

    Only vectors of the same non-null label and dimension are compared.  Null,
    zero or non-finite vectors and those without a label have no links and are
    alone.  Repeated rows are vectors of their own.  A null vec_id counts as
    larger than any.  An empty table gives no rows.  Only the three columns are read."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast("array<float>").alias("embedding"), "label")
    part = F.concat_ws(":", F.col("label").cast("string"), F.size("embedding").cast("string"))
    digest = F.concat_ws(":", *[F.hex(F.xxhash64(F.lit(s), "label", "embedding")) for s in (1, 2)])
    rows = rows.withColumn("cid", F.when(F.col("label").isNotNull() & usable(F.col("embedding")), digest))
    classes = cut_lineage(rows.where("cid IS NOT NULL").groupBy("cid").agg(
        F.first(part).alias("part"), F.first("embedding").alias("embedding"),
        F.count(F.lit(1)).alias("size"), F.min("vec_id").alias("least_id")))

    found = connected_components(cut_lineage(_found_links(classes, cosine, window, seed, max_passes)))
    classes = cut_lineage(classes.join(found, classes["cid"] == found["node"], "left")
                          .withColumn("component", F.coalesce("component", "cid")).drop("node"))
    counts = _link_counts(classes, cosine)
    least = classes.groupBy("component").agg(F.min("least_id").alias("component_id"))
    per_class = (classes.select("cid", "size", "component").join(least, "component")
                 .join(counts, "cid", "left")
                 .select("cid", "component_id", (F.col("size") - 1 + F.coalesce("n", F.lit(0))).alias("n_links")))
    return (rows.select("vec_id", "cid").join(per_class, "cid", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.when(F.col("cid").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))


def part_means(classes: DataFrame, window: int) -> DataFrame:
    """(part, n, mean): of each label with more vectors than a window, how many and
    the mean of their directions.  A task adds up its own rows first."""
    sizes = classes.groupBy("part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > window + 1)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[str, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for part, rows in batch.groupby("part"):
                x = _unit(rows["embedding"])
                n, total = found.get(part, (0, 0.0))
                found[part] = n + len(x), total + (x / np.sqrt((x * x).sum(axis=1))[:, None]).sum(axis=0)
            if len(found) > 1000:
                yield _sums(found)
                found = {}
        yield _sums(found)

    def mean(rows: pd.DataFrame) -> pd.DataFrame:
        n = int(rows["n"].sum())
        return pd.DataFrame({"part": rows["part"].iloc[:1], "n": [n], "mean": [np.sum(rows["total"].tolist(), axis=0) / n]})
    return (classes.join(sizes.select("part"), "part", "left_semi").select("part", "embedding")
            .mapInPandas(sums, "part string, n long, total array<double>")
            .groupBy("part").applyInPandas(mean, "part string, n long, mean array<double>"))


def _sums(found: dict[str, tuple[int, np.ndarray]]) -> pd.DataFrame:
    return pd.DataFrame([(part, n, total) for part, (n, total) in found.items()], columns=["part", "n", "total"])


def _coded(classes: DataFrame, means: DataFrame, cosine: float, window: int, seed: int, max_passes: int) -> DataFrame:
    """cid, part, codes (one per pass of its label; empty if passes would not do) and
    agree (the least probability that a bit of a linked vector agrees)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.reset_index(drop=True)
            out, agree = [None] * len(batch), np.ones(len(batch))
            for _, rows in batch.groupby("part"):
                n, mean = rows["n"].iloc[0], rows["mean"].iloc[0]
                for a in range(0, len(rows), 1024):
                    some = rows.iloc[a:a + 1024]
                    at = some.index.to_numpy()
                    if mean is None:                       # the label fits a window
                        got = np.zeros((len(some), 1), np.int64)
                    else:
                        x = _unit(some["embedding"])
                        x = x / np.sqrt((x * x).sum(axis=1))[:, None] - mean
                        agree[at] = agreement(np.sqrt((x * x).sum(axis=1)), cosine)
                        passes = passes_needed(int(n), 1 - float(mean @ mean), cosine, window, max_passes)
                        got = codes(x, passes, seed) if passes else np.zeros((len(some), 0), np.int64)
                    for i, c in zip(at.tolist(), got):
                        out[i] = c
            yield pd.DataFrame({"cid": batch["cid"], "part": batch["part"], "codes": out, "agree": agree})
    return classes.select("cid", "part", "embedding").join(means, "part", "left").mapInPandas(
        run, "cid string, part string, codes array<long>, agree double")


def _found_links(classes: DataFrame, cosine: float, window: int, seed: int, max_passes: int) -> DataFrame:
    """Verified links (a, b) that join all that is linked: those of the passes, and
    those of the vectors that passes are likely to miss."""
    coded = cut_lineage(_coded(classes, part_means(classes, window), cosine, window, seed, max_passes))
    ranked = assign_slots(coded.select("cid", "part", "agree", F.posexplode("codes").alias("pass", "code")),
                          "pass", ["pass", "part", "code", "cid"], "slot")
    own, place = F.floor(F.col("slot") / BLOCK), F.col("slot") % BLOCK
    near = F.filter(F.array(own, F.when((place <= window) & (own > 0), own - 1), F.when(place >= BLOCK - window - 1, own + 1)),
                    lambda b: b.isNotNull())
    blocks = (ranked.withColumn("block", F.explode(near))
              .select("pass", "block", "slot", "cid", "part", "code", "agree")
              .join(classes.select("cid", "embedding"), "cid"))

    def links(block: pd.DataFrame) -> pd.DataFrame:
        return window_links(block, window, BLOCK, cosine)
    got = cut_lineage(blocks.groupBy("pass", "block").applyInPandas(links, "a string, b string, miss double"))
    sure = (got.where("b IS NULL").groupBy(F.col("a").alias("cid")).agg(F.sum("miss").alias("miss"))
            .where(F.col("miss") <= float(np.log(MISS))))
    rest = classes.join(sure, "cid", "left_anti").select("cid", "part", "embedding")
    return got.where("b IS NOT NULL").select("a", "b").unionByName(_rest(classes, rest, cosine))


def _rest(classes: DataFrame, rest: DataFrame, cosine: float) -> DataFrame:
    """Links between ``rest`` and all vectors of the same label, tile by tile."""
    def tiles(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias(name))
    sizes = tiles(rest, "rows").join(tiles(classes, "columns"), "part")

    def side(df: DataFrame, mine: str, other: str, number: int) -> DataFrame:
        own = F.pmod(F.xxhash64("cid", F.lit(5 + number)), F.col(mine)).cast("int")
        at = [own.alias(mine[0]), F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other[0])]
        return (df.select("cid", "part", "embedding").join(sizes, "part")
                .select("part", "cid", "embedding", F.lit(number).alias("side"), *at))
    both = side(rest, "rows", "columns", 0).unionByName(side(classes, "columns", "rows", 1))

    def links(group: pd.DataFrame) -> pd.DataFrame:
        return rest_links(group, cosine)
    return both.groupBy("part", "r", "c").applyInPandas(links, "a string, b string")


def _link_counts(classes: DataFrame, cosine: float) -> DataFrame:
    """(cid, n): vectors of other classes that are linked, all pairs of a
    component compared; a component of m classes is cut into tiles of about
    ``TILE`` and every ordered pair of tiles is one group."""
    tiles = (classes.groupBy("component").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
             .select("component", F.ceil(F.col("m") / TILE).cast("int").alias("tiles")))
    rows = (classes.join(tiles, "component")
            .withColumn("tile", F.pmod(F.xxhash64("cid", F.lit(3)), F.col("tiles")).cast("int"))
            .select("component", "cid", "size", "embedding", "tile",
                    F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")))
    sides = rows.select("component", "cid", "size", "embedding", F.explode(F.array(
        F.struct(F.col("tile").alias("i"), F.col("other").alias("j"), F.lit(0).alias("side")),
        F.struct(F.col("other").alias("i"), F.col("tile").alias("j"), F.lit(1).alias("side")))).alias("at")
    ).select("component", "cid", "size", "embedding", "at.*")

    def count(tile: pd.DataFrame) -> pd.DataFrame:
        return tile_links(tile, cosine)
    return (sides.groupBy("component", "i", "j").applyInPandas(count, "cid string, n long")
            .groupBy("cid").agg(F.sum("n").alias("n")))
