"""Operator 11: MinHash near-duplicates from HyperMinHash sketches.

A document's distinct word shingles are dealt by hash into buckets; of each bucket's
least hash a register keeps the number of leading zeros and the mantissa bits that
follow.  Bands of registers name candidate groups; inside a group the collision-corrected
Jaccard estimate says which texts may be linked, with a margin of six deviations; what
it links are candidate clusters, in which every link is confirmed on the full sets.

Two sets differ in few shingles, and a shingle touches one band: sets with fewer
differing shingles than bands always share a band, and of larger ones at 0.85 about
1 pair in 10^10 doesn't.  Nothing is capped: a group that is too large for one task is split
by a second and third band after the texts near its leader were linked, and a cluster
that is too large is confirmed in rounds of query blocks against all its members.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlake.llm.arrow_groups import grouped_tables
from demandlake.llm.ordering import literal_list
from demandlake.llm.scratch import written
from demandlake.llm.simhash import components

SEED = 42
BUCKET_BITS = 7
MANTISSA_BITS = 10
#: Registers of a band: 8 bytes.
BAND = 4
BANDS = (1 << BUCKET_BITS) // BAND
#: Members of a band group that one task compares; a larger one is split.
TILE = 2048
LEVELS = 3
#: A pair at 0.85 agrees on none of so many bands once in 10^6 times.
ENOUGH = 19
#: Shingles of a cluster that one task holds (some 150 MB with its index), and of one block of queries.
HELD = 1 << 20
DEVIATIONS = 6.0
#: Bits of the filter that texts pass before they are shuffled to their clusters (0.5 MB).
FILTER_BITS = 1 << 22


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles (ASCII lower case); fewer words make one, none none."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h, last = xxhash.xxh64_intdigest, max(len(words) - shingle + 1, 1)
    return np.unique(np.array([h(b" ".join(words[i : i + shingle]), SEED) for i in range(last)], dtype=np.uint64))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Registers of sorted hashes: 0 is empty, else leading zeros + 1 above the mantissa."""
    out = np.zeros(1 << BUCKET_BITS, dtype=np.uint16)
    buckets, first = np.unique(hashes >> np.uint64(64 - BUCKET_BITS), return_index=True)
    rest = hashes[first] << np.uint64(BUCKET_BITS)
    seen = rest.copy()
    for k in (1, 2, 4, 8, 16, 32):
        seen |= seen >> np.uint64(k)
    zeros = 64 - np.bitwise_count(seen).astype(np.int64)  # of 64 - BUCKET_BITS bits that are given
    after = np.where(zeros < 63, rest << np.minimum(zeros + 1, 63).astype(np.uint64), np.uint64(0)) >> np.uint64(64 - MANTISSA_BITS)
    out[buckets.astype(np.int64)] = ((np.minimum(zeros, 62) + 1) << MANTISSA_BITS) | after.astype(np.int64)
    return out


@lru_cache(maxsize=1)
def _collisions() -> tuple[np.ndarray, np.ndarray]:
    """Share of equal registers by chance, for the logarithm of the shingles in a bucket."""
    low = np.exp2(-np.arange(1, 64.0))[:, None] * (1 + np.arange(1 << MANTISSA_BITS) / (1 << MANTISSA_BITS))
    width = np.exp2(-np.arange(1, 64.0))[:, None] / (1 << MANTISSA_BITS)
    at = np.arange(-8, 24, 0.5)
    share = []
    for rate in np.exp2(at):
        p = np.exp(-rate * low) - np.exp(-rate * (low + width))
        share.append((p * p).sum() / (1 - np.exp(-2 * rate)))
    return at, np.array(share)


def estimated(registers: np.ndarray, sizes: np.ndarray, own: np.ndarray, size: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimate of each row with ``own`` (one row, or one for each), less what equal
    registers come by chance; and the number of filled registers."""
    equal = ((registers == own) & (own != 0)).sum(axis=1)
    filled = np.maximum(((registers != 0) | (own != 0)).sum(axis=1), 1)
    rate = np.log2(np.maximum(np.sqrt(sizes * np.float64(size)), 1) / (1 << BUCKET_BITS))
    chance = np.interp(rate, *_collisions())
    return (equal / filled - chance) / (1 - chance), filled


def may_link(registers: np.ndarray, sizes: np.ndarray, own: np.ndarray, size: np.ndarray | int, percent: int) -> np.ndarray:
    found, filled = estimated(registers, sizes, own, size)
    least = percent / 100
    near = found >= least - DEVIATIONS * np.sqrt(least * (1 - least) / filled)
    return near & (100 * np.minimum(sizes, size) >= percent * np.maximum(sizes, size))


def linked_groups(n: int, links_of: Callable[[int], np.ndarray]) -> np.ndarray:
    """A label for each of ``n`` members, equal where links lead from one to the other.

    Members of the largest component so far are not asked: a link to another
    component is found from its other end.
    """
    label, asked, y = np.arange(n), np.zeros(n, dtype=bool), 0
    while True:
        asked[y] = True
        near = links_of(y)
        near[y] = True
        joined = np.unique(label[near])
        if len(joined) > 1:
            label[np.isin(label, joined)] = joined[0]
        largest = np.bincount(label).argmax()
        left = np.flatnonzero(~asked & (label != largest))
        if not len(left):
            return label
        y = int(left[0])


def _edges(pairs: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    u, v = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 2
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def _forest(nodes: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    apart = np.flatnonzero(label != np.arange(len(label)))
    return nodes[apart], nodes[label[apart]]


def described(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_hash, n, d1, d2, sketch): size, 128-bit digest and registers of each row's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, digests, sketches = [], [], []
            for t in b.column(2):
                s = shingle_set(t.as_py(), shingle)
                sizes.append(len(s))
                digests.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else bytes(16))
                sketches.append(sketch(s).tobytes() if len(s) else None)
            halves = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            columns = [b.column(0), b.column(1), pa.array(sizes, pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "n", "d1", "d2", "sketch"])

    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    return keyed.mapInArrow(run, "doc_id long, text_hash long, n long, d1 long, d2 long, sketch binary")


def band_keys(sketch_col: Column) -> Column:
    """(band, key) of every band that holds a shingle."""
    width = 2 * BAND
    parts = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.struct(i.alias("band"), F.substring(sketch_col, i * width + 1, F.lit(width)).alias("regs")))
    filled = F.filter(parts, lambda p: p["regs"] != F.lit(bytes(width)))
    return F.transform(filled, lambda p: F.struct(p["band"].alias("band"), F.xxhash64(p["band"], p["regs"]).alias("key")))


def _tile_links(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = []
        for t in grouped_tables(batches, "key"):
            registers = np.frombuffer(b"".join(t["sketch"].to_pylist()), dtype=np.uint16).reshape(t.num_rows, -1)
            sizes, nodes = t["n"].to_numpy(), t["node"].to_numpy()
            pairs.append(_forest(nodes, linked_groups(len(nodes), lambda y: may_link(registers, sizes, registers[y], sizes[y], percent))))
            if len(pairs) >= 1000:
                yield _edges(pairs)
                pairs = []
        yield _edges(pairs)

    return run


def _leader_links(percent: int):
    """For rows with their group's leader: whether the estimate links them to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = lambda c: b.column(b.schema.get_field_index(c))
            read = lambda c: np.frombuffer(b"".join(column(c).to_pylist()), dtype=np.uint16).reshape(b.num_rows, -1)
            near = np.zeros(0, dtype=bool)
            if b.num_rows:
                near = may_link(read("sketch"), column("n").to_numpy(), read("leader_sketch"), column("leader_n").to_numpy(), percent)
            yield pa.RecordBatch.from_arrays([*map(column, ("key", "used", "node", "leader")), pa.array(near)], names=["key", "used", "node", "leader", "near"])

    return run


def _told_elsewhere(n: Column, small_bands: Column, percent: int) -> Column:
    """Whether a text's bands in small groups tell all its links.

    A linked set differs in at most n * (100 - percent) / percent shingles, each in one
    band: with more bands than that one agrees for certain, and with ENOUGH bands, of
    which each agrees in more than half of all cases, as good as for certain.
    """
    return small_bands > F.least(F.floor(n * (100 - percent) / percent), F.lit(ENOUGH))


def _size_classes(n: Column, percent: int) -> Column:
    """Two numbers for each size, so that sizes which differ by less than ``percent`` share one."""
    at = F.floor(F.log(n.cast("double")) / F.lit(np.log(100 / percent) * 1.0001)).cast("long")
    return F.array(at, at + 1)


def candidate_links(nodes: DataFrame, percent: int) -> DataFrame:
    """(u, v): links that hold together every pair of ``nodes`` (node, n, sketch) which the estimate may link.

    A group's key is the exclusive-or of its bands' keys, ``used`` tells the bands by
    their bits.  A group too large for a tile keeps only the texts that no small
    group tells of, dealt by size; what is too large still is split by further bands.
    """
    banded = nodes.select("node", "n", band_keys(F.col("sketch")).alias("bands"))
    bit = lambda b: F.call_function("shiftleft", F.lit(1).cast("long"), b["band"])
    own = banded.select("node", "n", F.size("bands").alias("filled"), F.explode("bands").alias("b")).select(
        "node", "n", "filled", F.col("b.key").alias("key"), bit(F.col("b")).alias("used"))
    counted = lambda rows, name: written(rows.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), name)
    shared = counted(own, "hmh-groups")
    found = _tiled(own.join(shared.where(F.col("members") <= TILE).select("key"), "key", "left_semi"), nodes, percent)
    # Few keys: written, so that their size is known before anything is shuffled to meet them.
    hot = written(shared.where(F.col("members") > TILE).select("key"), "hmh-hot")
    if not hot.limit(1).count():
        return found
    hot_bands = own.join(hot, "key", "left_semi")
    in_hot = hot_bands.groupBy("node", "n", "filled").agg(F.count(F.lit(1)).alias("hot"))
    untold = written(in_hot.where(~_told_elsewhere(F.col("n"), F.col("filled") - F.col("hot"), percent)).select("node"), "hmh-untold")
    sized = hot_bands.join(untold, "node", "left_semi").withColumn("class", F.explode(_size_classes(F.col("n"), percent)))
    own = written(sized.select("node", F.col("key").bitwiseXOR(F.xxhash64("class")).alias("key"), "used", F.lit(False).alias("led")), "hmh-sized")
    for level in range(LEVELS):
        shared = written(own.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.bool_and("led").alias("done")).where("members > 1 AND NOT done").select("key", "members"), f"hmh-groups{level}")
        found = found.unionAll(_tiled(own.join(shared.where(F.col("members") <= TILE).select("key"), "key", "left_semi"), nodes, percent))
        many = shared.where(F.col("members") > TILE).select("key")
        if not many.limit(1).count():
            break
        large = own.join(many, "key", "left_semi")
        first = large.where(~F.col("led")).groupBy("key").agg(F.min("node").alias("leader"))
        if level == LEVELS - 1:  # they agree on as many bands as there are levels: one cluster, the sets decide
            found = found.unionAll(written(large.join(first, "key").select(F.col("node").alias("u"), F.col("leader").alias("v")), "hmh-whole"))
            break
        sketched = large.join(nodes, "node").select("key", "used", "node", "n", "sketch")
        leaders = first.join(nodes, F.col("leader") == F.col("node")).select("key", "leader", F.col("n").alias("leader_n"), F.col("sketch").alias("leader_sketch"))
        judged = written(sketched.join(leaders, "key").mapInArrow(_leader_links(percent), "key long, used long, node long, leader long, near boolean"), f"hmh-judged{level}")
        found = found.unionAll(judged.where("near AND node != leader").select(F.col("node").alias("u"), F.col("leader").alias("v")))
        # Texts near the leader hang together already: only groups of a further band with another text matter.
        further = F.transform(F.filter("bands", lambda b: F.col("used").bitwiseAND(bit(b)) == 0), lambda b: F.struct(F.col("key").bitwiseXOR(b["key"]).alias("key"), F.col("used").bitwiseOR(bit(b)).alias("used")))
        finer = judged.join(banded, "node").select("node", "near", F.explode(further).alias("b")).select("node", "near", "b.*")
        beside = finer.where(~F.col("near")).select("key").distinct()
        own = written(finer.join(beside, "key", "left_semi").groupBy("key", "used", "node").agg(F.bool_and("near").alias("led")), f"hmh-finer{level}")
    return found


def _tiled(placed: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Links inside each group of ``placed`` (key, node)."""
    tiles = placed.select("key", "node").join(nodes, "node").repartition("key").sortWithinPartitions("key").select("key", "node", "n", "sketch")
    return written(tiles.mapInArrow(_tile_links(percent), "u long, v long"), "hmh-links")


class Sets:
    """Sorted sets with an index from shingle to holders."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        self.values, place = np.unique(np.concatenate(sets), return_inverse=True)
        holder = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(place, kind="stable")
        self.holders = holder[order]
        self.at = np.searchsorted(place[order], np.arange(len(self.values) + 1))

    def linked_to(self, s: np.ndarray, percent: int) -> np.ndarray:
        """Which sets share enough with ``s``: 100 * intersection >= percent * union."""
        k = np.searchsorted(self.values, s)
        k = k[(k < len(self.values)) & (self.values[np.minimum(k, len(self.values) - 1)] == s)]
        length = self.at[k + 1] - self.at[k]
        place = np.arange(length.sum()) + np.repeat(self.at[k] - np.r_[0, np.cumsum(length)[:-1]], length)
        both = np.bincount(self.holders[place], minlength=len(self.sizes))
        return (both > 0) & (100 * both >= percent * (self.sizes + len(s) - both))


def _confirm(shingle: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in grouped_tables(batches, "cluster"):
            nodes, sets = t["node"].to_numpy(), [shingle_set(x, shingle) for x in t["text"].to_pylist()]
            held = Sets(sets)
            yield _edges([_forest(nodes, linked_groups(len(sets), lambda y: held.linked_to(sets[y], percent)))])

    return run


def _confirm_block(queries: list[tuple[int, int, bytes]], percent: int):
    """Links between a block of queries and the members that a task reads, of the same cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealt: dict[int, list[tuple[int, bytes]]] = {}
        for cluster, node, s in queries:
            dealt.setdefault(cluster, []).append((node, s))
        by = {c: (np.array([node for node, _ in own]), Sets([np.frombuffer(s, dtype=np.uint64) for _, s in own])) for c, own in dealt.items()}
        for b in batches:
            clusters, nodes = b.column(0).to_numpy(), b.column(1).to_numpy()
            pairs = []
            for i, s in enumerate(b.column(2).to_pylist()):
                if clusters[i] in by:
                    asked, held = by[clusters[i]]
                    near = asked[held.linked_to(np.frombuffer(s, dtype=np.uint64), percent)]
                    pairs.append((np.full(len(near), nodes[i]), near))
            # A spanning forest says as much as all pairs of this batch.
            u, v = (np.concatenate(x) for x in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 2
            names, ends = np.unique(np.r_[u, v], return_inverse=True)
            root = np.arange(len(names))
            a, z = ends[: len(u)], ends[len(u) :]
            while len(a):
                x, y = root[a], root[z]
                apart = x != y
                a, z, x, y = a[apart], z[apart], x[apart], y[apart]
                np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
                while not np.array_equal(root, root[root]):
                    root = root[root]
            yield _edges([_forest(names, root)])

    return run


def _confirm_large(members: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Confirmed links of clusters that no single task holds, in rounds.

    A block of queries (some HELD shingles, handed to every task) meets all members
    of their clusters.  First comes one query a cluster, then the members outside
    each cluster's largest component, until all of these have been asked.
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [shingle_set(t, shingle) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([s.tobytes() for s in own], pa.binary()), pa.array([len(s) for s in own], pa.int64())], names=["cluster", "node", "shingles", "n"])

    spark = members.sparkSession
    held = written(members.select("cluster", "node", "text").mapInArrow(sets, "cluster long, node long, shingles binary, n long"), "hmh-sets")
    links, asked = spark.createDataFrame([], "u long, v long"), spark.createDataFrame([], "node long")
    waiting = held.groupBy("cluster").agg(F.min("node").alias("node")).join(held.select("node", "n"), "node")
    while True:
        block, size = [], 0
        for r in waiting.select("node", "n").orderBy("node").limit(HELD // 16).collect():
            if block and size + r.n > HELD:
                break
            block.append((r.node,))
            size += r.n
        if not block:
            return links
        now = spark.createDataFrame(block, "node long")
        queries = [(r.cluster, r.node, bytes(r.shingles)) for r in held.join(F.broadcast(now), "node").select("cluster", "node", "shingles").collect()]
        found = held.select("cluster", "node", "shingles").mapInArrow(_confirm_block(queries, percent), "u long, v long").where("u != v").distinct()
        links = written(links.unionAll(found), "hmh-confirmed")
        asked = written(asked.unionAll(now), "hmh-asked")
        roots = components(links)
        at = held.select("cluster", "node", "n").join(roots, "node", "left").select("cluster", "node", "n", F.coalesce("root", "node").alias("root"))
        at = written(at, "hmh-at")
        largest = at.groupBy("cluster", "root").count().groupBy("cluster").agg(F.max_by("root", F.struct("count", "root")).alias("largest"))
        waiting = at.join(largest, "cluster").where("root != largest").join(asked, "node", "left_anti")


def bit_filter(keys: DataFrame, key: str) -> Callable[[Column], Column]:
    """A test that every ``key`` (long) of ``keys`` passes, and few others while the keys are few.

    At most FILTER_BITS bits, set by grouped sums, reach the driver and the plan,
    whatever the number of keys; with very many keys the test lets all pass.
    """
    bits = min(FILTER_BITS, max(64, 1 << (16 * keys.count()).bit_length()))
    at = F.pmod(F.col(key), F.lit(bits))
    words = keys.select(F.floor(at / 64).alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int")).alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).collect()
    table = [0] * (bits // 64)
    for r in words:
        table[r.w] = r.b
    known = literal_list([str(x) for x in table]).cast("array<long>")

    def test(value: Column) -> Column:
        place = F.pmod(value, F.lit(bits))
        return F.call_function("shiftrightunsigned", F.get(known, F.floor(place / 64).cast("int")), (place % 64).cast("int")).bitwiseAND(F.lit(1)) == 1

    return test


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Rows link where 100 * intersection >= percent * union of their sets of distinct
    word shingles (ASCII lower case); with fewer words the whole sequence is the one
    shingle.  ``component_id`` is the least id reachable, ``kept`` says whether it is
    the row's own.  Null, empty and blank texts have no shingles and link with nothing,
    not even each other.  Null ids take part, but are never a component's id (null if
    all its ids are) and are not kept.  Repeated rows stay.  Empty table: no rows.
    Other columns are ignored.
    """
    rows = written(described(docs, shingle, id_col, text_col), "hmh-docs")
    sets = rows.where("n > 0").groupBy("d1", "d2", "n").agg(
        F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id", "text_hash")).alias("shown"), F.first("sketch").alias("sketch"))
    nodes = written(sets.withColumn("node", F.monotonically_increasing_id()), "hmh-nodes")
    clusters = components(candidate_links(nodes.select("node", "n", "sketch"), percent))
    named = clusters.select("node", F.col("root").alias("cluster")).unionAll(clusters.select(F.col("root").alias("node"), F.col("root").alias("cluster")).distinct())
    placed = written(named.join(nodes.select("node", "n", "shown"), "node"), "hmh-clusters")
    sizes = placed.groupBy("cluster").agg(F.sum("n").alias("held"))
    shown = placed.join(sizes, "cluster").select("cluster", "node", "held", F.col("shown.doc_id").alias("id"), F.col("shown.text_hash").alias("hash"))
    shown = written(shown, "hmh-shown")  # its size is known before the texts meet it
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    # Only the texts that a cluster may need are shuffled.
    needed = bit_filter(shown.select(F.xxhash64("id", "hash").alias("k")), "k")
    members = texts.where(needed(F.xxhash64("doc_id", "text_hash"))).join(shown, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash"))).select("cluster", "node", "held", "text")
    members = members.groupBy("cluster", "node", "held").agg(F.first("text").alias("text"))  # rows that repeat as a whole
    members = written(members, "hmh-members")
    small = members.where(F.col("held") <= HELD).select("cluster", "node", "text").repartition("cluster").sortWithinPartitions("cluster")
    links = written(small.mapInArrow(_confirm(shingle, percent), "u long, v long"), "hmh-links")
    large = members.where(F.col("held") > HELD)
    if large.limit(1).count():
        links = links.unionAll(_confirm_large(large, shingle, percent))
    roots = written(components(links), "hmh-roots")
    placed = nodes.join(roots, "node", "left").select("d1", "d2", "n", "least", "copies", F.coalesce("root", "node").alias("root"), F.col("root").isNotNull().alias("moved"))
    grouped = written(placed, "hmh-placed")
    heads = grouped.where("moved").select("root").distinct()
    joined = grouped.join(heads, "root", "left_semi")  # components of two sets or more
    ids = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    told = joined.join(ids, "root").select("d1", "d2", "n", "component_id")
    copies = grouped.where("copies > 1").join(heads, "root", "left_anti").select("d1", "d2", "n", F.col("least").alias("component_id"))
    # Only rows with a partner are looked up; any other is its own component.
    known = written(told.unionAll(copies).withColumn("known", F.lit(True)), "hmh-known")
    out = rows.select("doc_id", "d1", "d2", "n").join(known, ["d1", "d2", "n"], "left")
    least = F.when(F.col("known"), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), least.alias("component_id"), F.coalesce(F.col("doc_id") == least, F.lit(False)).alias("kept"))
