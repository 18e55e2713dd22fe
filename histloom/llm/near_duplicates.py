"""MinHash near-duplicates: fast similarity sketches, banding, exact verification.

1. Every text gives its number of shingles, a digest of its shingle set and the
   band keys of its sketch.  Texts of one digest form a class; from here on
   one document stands for the class, so copies are never paired.
2. Classes that share a band key form a bucket.  Each bucket's members are
   compared with its hub (the member that collides most); the shingle sets are
   compared in full.
3. Buckets that still hold members in different components, besides the pairs
   with the hub, are compared in full, in tiles of bounded size; a tile pair
   returns a spanning forest of its links, not all of them.
4. Components of the confirmed links.

With bands of ``ROWS`` equal coordinates, a pair at the threshold t shares no
bucket with probability (1 - t**ROWS)**bands, and there are as many bands as bring
it below ``MISS``: 24 at 0.85, 35 at 0.80.  More similar pairs are missed still less."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.io import cut_lineage
from . import sketch
from .common import map_texts, packed
from .components import connected_components, split_join

#: Coordinates of a band, and how likely a pair at the threshold may be missed.
ROWS, MISS = 5, 1e-6
#: Bands of one sketch; more bands take further sketches with seeds of their own.
SKETCH_BANDS = 24
#: Fixed value of op6: a link needs 100 * intersection >= THRESHOLD * union.
THRESHOLD = 85
#: Bytes of text hashed at a time in a task; about how many shingles, and how
#: many texts at most, a tile holds.
CHUNK_BYTES = 1 << 20
TILE_SHINGLES, TILE_TEXTS = 100_000, 500


def bands(threshold: int) -> int:
    """Bands that miss a pair at ``threshold`` (in hundredths) with probability below ``MISS``."""
    if not 0 < threshold <= 100:
        raise ValueError(f"threshold {threshold}; must be above 0 and at most 100")
    miss = 1 - (threshold / 100) ** ROWS
    return math.floor(math.log(MISS) / math.log(miss)) + 1 if miss else 1


def keys_of(sets: list[np.ndarray], n_bands: int) -> np.ndarray:
    """(len(sets), n_bands) band keys of shingle sets."""
    return np.concatenate([
        sketch.band_keys(sketch.fast_similarity_sketch(sets, min(SKETCH_BANDS, n_bands - done) * ROWS, seed), ROWS)
        for seed, done in enumerate(range(0, n_bands, SKETCH_BANDS), 1)], axis=1)


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Slices of at most ``limit`` bytes (or one text)."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def _row_key(doc_id: Column, text: Column) -> Column:
    """128 bits of a row's doc_id and text (nulls apart from empty texts): equal
    for equal rows, and at any corpus size for no others."""
    marked = [F.coalesce(doc_id.cast("string"), F.lit("-")), F.when(text.isNull(), "n").otherwise("t"),
              F.coalesce(text, F.lit(""))]
    return F.unhex(F.md5(F.concat_ws(":", *marked).cast("binary")))


def _rows(docs: DataFrame) -> DataFrame:
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .select("doc_id", _row_key(F.col("doc_id"), F.col("text")).alias("row_key"), F.col("text").cast("binary").alias("text")))


def fingerprints(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, row_key (hash of doc_id and text), n_shingles, digest (of the
    shingle set; null if empty) and keys (of the bands for ``threshold``)."""
    n_bands = bands(threshold)

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or b"" for t in batch.column(2).to_pylist()]
            sizes, digests, keys = [], [], []
            for a, b in chunks(texts):
                sets = sketch.shingle_sets(texts[a:b])
                sizes += [len(s) for s in sets]
                digests += [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                keys.append(keys_of(sets, n_bands))
            flat = np.concatenate(keys).astype(np.int64).ravel()
            offsets = np.arange(0, len(flat) + 1, n_bands, dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), lists],
                names=["doc_id", "row_key", "n_shingles", "digest", "keys"])
        return step
    return map_texts(_rows(docs), ["doc_id", "row_key", "text"],
                     "doc_id long, row_key binary, n_shingles long, digest binary, keys array<long>", make)


def linked(inter, n_a, n_b, threshold: int = THRESHOLD):
    return 100 * inter >= threshold * (n_a + n_b - inter)


def _verify_pairs(pairs: DataFrame, threshold: int) -> DataFrame:
    """Of rows (a, b, text_a, text_b) the linked ones' (a, b)."""
    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            left, right = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            keep: list[bool] = []
            for a, b in chunks(left):
                known = list(dict.fromkeys(left[a:b]))       # a hub's text is hashed once a chunk
                sets = dict(zip(known, sketch.shingle_sets(known)))
                for x, other in zip(left[a:b], right[a:b]):
                    s, o = sets[x], sketch.shingle_sets([other])[0]
                    keep.append(bool(linked(len(np.intersect1d(s, o, assume_unique=True)), len(s), len(o), threshold)))
            mask = pa.array(keep, pa.bool_())
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(mask)
        return step
    return map_texts(pairs, ["a", "b", "text_a", "text_b"], "a binary, b binary", make)


def _forest(group: pd.DataFrame, threshold: int) -> pd.DataFrame:
    """Links between members of different components in one tile pair, as few
    as join what they join."""
    group = group.drop_duplicates("digest")
    sets = [s for a, b in chunks(list(group["text"])) for s in sketch.shingle_sets(list(group["text"])[a:b])]
    sizes = np.array([len(s) for s in sets])
    inter = sketch.intersections(sets)
    names, label = group["digest"].tolist(), group["component"].tolist()
    numbers = {c: i for i, c in enumerate(dict.fromkeys(label))}
    part = np.array([numbers[c] for c in label])
    hit = linked(inter, sizes[:, None], sizes[None, :], threshold) & (part[:, None] < part[None, :])
    parent = list(range(len(numbers)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x
    links = []
    for x, y in zip(*np.nonzero(hit)):
        p, q = root(part[x]), root(part[y])
        if p != q:
            parent[p] = q
            links.append((names[x], names[y]))
    return pd.DataFrame(links, columns=["a", "b"])


def _links(docs: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """Confirmed links (a, b) between classes that join all that is linked.
    ``classes``: digest, n_shingles, row_key, keys."""
    members = classes.select("digest", F.explode("keys").alias("key"))
    buckets = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = cut_lineage(split_join(members, buckets, "key").select("key", "digest", "n"))
    degree = members.groupBy("digest").agg(F.sum("n").alias("degree"))
    members = members.join(degree, "digest")
    hubs = members.groupBy("key").agg(F.max_by("digest", F.struct("degree", "digest")).alias("hub"))
    members = cut_lineage(split_join(members, hubs, "key").select("key", "digest", "hub"))

    needed = classes.join(members.select("digest").distinct(), "digest").select("digest", "n_shingles", "row_key")
    texts = cut_lineage(_rows(docs).drop("doc_id").join(needed, "row_key")
                        .select("digest", "n_shingles", "text").dropDuplicates(["digest"]))

    stars = members.where("digest <> hub").select(F.col("hub").alias("a"), F.col("digest").alias("b")).distinct()
    stars = (stars.join(texts.select(F.col("digest").alias("a"), F.col("text").alias("text_a")), "a")
             .join(texts.select(F.col("digest").alias("b"), F.col("text").alias("text_b")), "b"))
    links = cut_lineage(_verify_pairs(stars, threshold))
    found = connected_components(links)
    return links.unionByName(_rest(members, texts, found, threshold))


def _rest(members: DataFrame, texts: DataFrame, found: DataFrame, threshold: int) -> DataFrame:
    """Links in buckets that hold different components apart from the hub."""
    rows = (members.where("digest <> hub")
            .join(found, members["digest"] == found["node"], "left")
            .select("key", "digest", F.coalesce("component", "digest").alias("component"))
            .join(texts.select("digest", "n_shingles"), "digest"))
    h = F.xxhash64("digest")
    open_buckets = (rows.groupBy("key")
                    .agg(F.min("component").alias("low"), F.max("component").alias("high"),
                         F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"), F.sum(F.shiftright(h, 20)).alias("s"),
                         F.sum(F.greatest("n_shingles", F.lit(TILE_SHINGLES // TILE_TEXTS))).alias("size"))
                    .where("low <> high")
                    # buckets of the same members (in several bands) are done once
                    .groupBy("n", "x", "s").agg(F.min("key").alias("key"), F.min("size").alias("size"))
                    .select("key", F.ceil(F.col("size") / TILE_SHINGLES).cast("int").alias("tiles")))
    tiled = split_join(rows, open_buckets, "key").withColumn(
        "tile", F.pmod(F.xxhash64("digest", F.lit(7)), F.col("tiles")).cast("int"))
    spread = (tiled.select("key", "digest", "component", "tile",
                           F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
              .select("key", "digest", "component", F.least("tile", "other").alias("i"),
                      F.greatest("tile", "other").alias("j"))
              .join(texts.select("digest", "text"), "digest"))

    def forest(group: pd.DataFrame) -> pd.DataFrame:
        return _forest(group, threshold)
    return spread.groupBy("key", "i", "j").applyInPandas(forest, "a binary, b binary")


def _verdicts(docs: DataFrame, threshold: int) -> DataFrame:
    """near_duplicates and, per row, ``one``: the row_key that stands for its
    component (null without shingles)."""
    prints = cut_lineage(fingerprints(docs, threshold))
    some = prints.where("digest IS NOT NULL")
    classes = cut_lineage(some.groupBy("digest").agg(
        F.first("n_shingles").alias("n_shingles"),
        F.min_by(F.struct("doc_id", "row_key", "keys"), F.struct(F.col("doc_id").isNull(), "doc_id", "row_key"))
        .alias("one"))
        .select("digest", F.col("one.doc_id").alias("least_id"), "n_shingles", "one.row_key", "one.keys"))
    found = connected_components(cut_lineage(_links(docs, classes, threshold)))
    named = classes.select("digest", "least_id", "row_key").join(
        found, classes["digest"] == found["node"], "left").select(
        "digest", "least_id", "row_key", F.coalesce("component", "digest").alias("component"))
    least = named.groupBy("component").agg(
        F.min(F.struct(F.col("least_id").isNull(), "least_id", "row_key")).alias("first")).select(
        "component", F.col("first.least_id").alias("component_id"), F.col("first.row_key").alias("one"))
    ids = split_join(named.select("digest", "component"), least, "component").select("digest", "component_id", "one")
    return prints.join(ids, "digest", "left").select(
        "doc_id", "row_key", "n_shingles",
        F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "one").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Per document row: doc_id, row_key, n_shingles, component_id (smallest
    doc_id that links reach, its own included) and kept (doc_id = component_id).

    A null, empty or wordless text has no shingles and is alone.  Repeated rows
    are copies of each other and share a verdict.  A null doc_id never is a
    component's smallest unless all its members' are null; then component_id is
    null and kept true.  Shingle sets whose similarity is ``threshold`` hundredths
    or more are linked.  An empty table gives no rows; texts are hashed whole,
    however long.  Only doc_id and text are read."""
    return _verdicts(docs, threshold).drop("one")


def drop_near_duplicates(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """One row of each component of ``docs``, with its own columns.

    It is the row with the smallest doc_id (null last); among equal doc_ids the
    one with the smallest hash of doc_id and text, and of rows that repeat both,
    the one whose columns have the smallest hash.  Rows without shingles are in
    no component and all stay.  An empty table stays empty."""
    seen = cut_lineage(_verdicts(docs, threshold).where("one IS NOT NULL").select(
        "row_key", (F.col("row_key") == F.col("one")).alias("stays")))
    gone = seen.where("NOT stays").select("row_key").distinct()
    again = seen.where("stays").groupBy("row_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("row_key")
    keyed = docs.select(packed(docs), _row_key(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("row_key"))
    if again.isEmpty():
        return split_join(keyed, gone, "row_key", "left_anti").select("_row.*")
    marks = gone.select("row_key", F.lit(False).alias("repeated")).unionByName(
        again.select("row_key", F.lit(True).alias("repeated")))
    marked = cut_lineage(split_join(keyed, marks, "row_key", "left").where("repeated IS NULL OR repeated"))
    single = marked.where("repeated").groupBy("row_key").agg(
        F.min_by("_row", F.xxhash64(F.to_json("_row"))).alias("_row"))
    return marked.where("repeated IS NULL").select("_row.*").unionByName(single.select("_row.*"))
