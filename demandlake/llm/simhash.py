"""Operator 10: SimHash near-duplicates by tiled exact comparison.

Distinct fingerprints are dealt into tiles: two fingerprints that differ in at
most ``radius`` bits agree on at least one of ``radius + 1`` bit bands, so a tile
holds the fingerprints that agree on one band, and no link is lost.  Inside, tile
pairs are compared with numpy exclusive-or and bit counts; blocks whose population
counts differ beyond the radius are skipped.  A tile that grows too large is split
by the bands of its remaining bits, so no task holds an unbounded group.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlake.llm.scratch import written

BITS = 64
SEED = 42
#: A tile of more fingerprints is split by its remaining bits, LEVELS times at most; what is
#: left then differs in so few bits that a tile is small by itself (radius 2: 13 bits).
TILE = 2048
LEVELS = 4
#: Rows of one numpy block, and hashes whose bits are unpacked at once.
BLOCK = 256
CHUNK = 1 << 15


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of the word shingles (ASCII lower case, repeats count): a bit is set if over half the hashes have it."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = list(accumulate(len(w) + 1 for w in words))
        h = xxhash.xxh64_intdigest
        hashes = [h(joined[a : b - 1], SEED) for a, b in zip([0, *ends], ends[shingle - 1 :])]
    raw, counts = np.array(hashes, dtype="<u8"), np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(raw), CHUNK):
        counts += np.unpackbits(raw[at : at + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(raw), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_hash, fp): the text's XXH64, and the fingerprint's 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column(2)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps)], names=["doc_id", "text_hash", "fp"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return keyed.mapInArrow(run, "doc_id long, text_hash long, fp long")


def _bands(free: int, parts: int) -> list[int]:
    """Masks that split the set bits of ``free`` into ``parts`` runs of near-equal size."""
    bits = [k for k in range(BITS) if free >> k & 1]
    cuts = [len(bits) * i // parts for i in range(parts + 1)]
    return [sum(1 << k for k in bits[a:b]) for a, b in zip(cuts, cuts[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


class _Forest:
    """Components of the rows of one batch, as the least row index reached."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.root[a], self.root[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = self.root[self.root]
                if np.array_equal(up, self.root):
                    break
                self.root = up


def linked(fp: np.ndarray, key: np.ndarray, radius: int) -> np.ndarray:
    """For rows sorted by (key, population count): the least row of each row's component among rows of equal key."""
    count = np.bitwise_count(fp).astype(np.int16)
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, int)
    ends = np.r_[starts[1:], len(key)]
    forest = _Forest(len(fp))
    end_of = np.repeat(np.where(ends - starts <= BLOCK, ends, 0), ends - starts)
    live, k = np.arange(len(fp)), 1
    while len(live):  # small tiles, all at once: each row against the k-th after it
        live = live[live + k < end_of[live]]
        live = live[count[live + k] - count[live] <= radius]
        near = live[np.bitwise_count(fp[live] ^ fp[live + k]) <= radius]
        forest.link(near, near + k)
        k += 1
    for s, e in zip(starts[ends - starts > BLOCK], ends[ends - starts > BLOCK]):
        for a in range(s, e, BLOCK):
            a_end = min(a + BLOCK, e)
            for b in range(a, e, BLOCK):
                if count[b] - count[a_end - 1] > radius:
                    break  # this block's counts, and all later ones, lie beyond the radius
                b_end = min(b + BLOCK, e)
                i, j = np.nonzero(np.bitwise_count(fp[a:a_end, None] ^ fp[None, b:b_end]) <= radius)
                forest.link(i + a, j + b)
    return forest.root


def _tile_edges(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def out(t: pa.Table) -> pa.RecordBatch:
            fp = t["fp"].to_numpy().view(np.uint64)
            root = linked(fp, t["tile"].to_numpy(), radius)
            low = np.flatnonzero(root != np.arange(len(fp)))
            return pa.RecordBatch.from_arrays([pa.array(fp[low].view(np.int64)), pa.array(fp[root[low]].view(np.int64))], names=["u", "v"])

        for b in batches:  # a tile may lie in two batches: its first part waits
            t = pa.concat_tables([rest, pa.Table.from_batches([b])]) if rest is not None else pa.Table.from_batches([b])
            keys = t["tile"].to_numpy()
            cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            if cut:
                yield out(t.slice(0, cut))
            rest = t.slice(cut).combine_chunks()
        if rest is not None and rest.num_rows:
            yield out(rest)

    return run


def links(nodes: DataFrame, radius: int) -> DataFrame:
    """(u, v): a spanning forest of the links in each tile of distinct fingerprints ``nodes.fp``."""
    found = None
    # A row knows the mask of the bits on which its tile agrees; the masks of a level are few constants.
    rows = {0: nodes.select("fp")}
    for level in range(LEVELS):
        parts = []
        for agreed, some in rows.items():
            free = ((1 << BITS) - 1) & ~agreed
            for mask in _bands(free, radius + 1):
                both = agreed | mask
                parts.append((both, some.select("fp", F.lit(_signed(both)).alias("agreed"))))
        dealt = parts[0][1]
        for _, p in parts[1:]:
            dealt = dealt.unionAll(p)
        # Two tiles whose keys collide are compared as one: more work, the same links.
        dealt = dealt.withColumn("tile", F.xxhash64("agreed", F.col("fp").bitwiseAND(F.col("agreed"))))
        last = level == LEVELS - 1
        if not last:
            large = written(dealt.groupBy("agreed", "tile").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > TILE).select("agreed", "tile"), f"simhash-large{level}")
            masks = [r["agreed"] for r in large.select("agreed").distinct().collect()]
        if not last and masks:
            small = dealt.join(large, ["agreed", "tile"], "left_anti")
            split = written(dealt.join(large, ["agreed", "tile"], "left_semi").select("fp", "agreed"), f"simhash-split{level}")
            # The tile is told by its fingerprints' bits under the mask, so the mask alone need be carried on.
            rows = {m & ((1 << BITS) - 1): split.where(F.col("agreed") == m).select("fp") for m in masks}
        else:
            small, rows = dealt, {}
        tiles = small.select("fp", "tile").repartition("tile").sortWithinPartitions("tile", F.bit_count("fp"))
        edges = written(tiles.mapInArrow(_tile_edges(radius), "u long, v long"), f"simhash-links{level}")
        found = edges if found is None else found.unionAll(edges)
        if not rows:
            break
    return found.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of each linked node's component, by alternating large and small stars.

    Every round is a pre-aggregated minimum and a join, written to the shared
    folder; rounds grow with the logarithm of the longest chain.
    """
    edges = written(edges.where(F.col("u") != F.col("v")).distinct(), "components-edges")
    mark = None
    while True:
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where(F.col("u") != F.col("v")).distinct(), "components-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
        edges = written(small.where(F.col("u") != F.col("v")).distinct(), "components-small")
        r = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (r.n, r.h) == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = (r.n, r.h)


def simhash_components(docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) for every row of ``docs``.

    Fingerprints link at ``radius`` or fewer differing bits; ``root`` names the
    component by its least fingerprint, ``component_id`` is the least id reachable.  Null or empty text: fingerprint 0, linked like any
    other.  Null ids: take part, but are never a component's id (null if all its
    ids are).  Repeated rows stay.  Empty table: no rows.  Other columns are ignored.
    """
    fps = written(fingerprints(docs, shingle, id_col, text_col), "simhash-docs")
    nodes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    roots = components(links(nodes, radius))
    joined = nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    joined = written(joined, "simhash-roots")
    ids = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    named = joined.join(ids, "root").select("fp", "root", "component_id")
    return fps.join(named, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def without_near_copies(docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component: that of the least id, and of the least
    text hash where several rows have that id (or where no row has one).

    The rows that go are told by id and text; they are fewer than those that stay.
    Null and empty texts have fingerprint 0, so they are copies of each other.  Rows
    without an id go where their component has one with an id, else one stays.  Of
    rows that repeat as a whole one stays.  Empty table: no rows.  All columns of
    ``docs`` are kept as they are.
    """
    found = written(simhash_components(docs, shingle, radius, id_col, text_col), "simhash-found")
    first = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(F.min("text_hash").alias("stays"))
    beside = found.join(first, "root").where(~F.col("doc_id").eqNullSafe(F.col("component_id")) | (F.col("text_hash") != F.col("stays")))
    gone = written(beside.select(F.col("doc_id").alias("g1"), F.col("text_hash").alias("g2")).distinct(), "simhash-gone")
    key = (F.col(id_col).cast("long"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    kept = docs.join(gone, key[0].eqNullSafe(F.col("g1")) & (key[1] == F.col("g2")), "left_anti")
    again = written(found.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("doc_id").alias("g1"), F.col("text_hash").alias("g2")), "simhash-again")
    if again.limit(1).count():  # rows that repeat as a whole: one of them stays
        match = key[0].eqNullSafe(F.col("g1")) & (key[1] == F.col("g2"))
        kept = kept.join(again, match, "left_anti").unionAll(kept.join(again, match, "left_semi").dropDuplicates([id_col, text_col]))
    return kept
