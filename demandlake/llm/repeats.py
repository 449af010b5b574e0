"""Passages that occur more than once: the frame shared by operators 2 and 3.

1. scan: every text's anchors (see anchors.py) and a 128-bit key of the text;
2. candidates: anchors whose hash occurs at two places of the distinct texts;
3. blocks: the neighbourhood of each candidate anchor, as wide as any window that
   holds it, dealt by the anchor's hash; the operator's own method finds the
   repeated spans of the blocks of one anchor;
4. spans of a text are joined, and what they leave is kept.

A window that occurs twice holds the same anchor at the same place both times, so
the blocks of that anchor hold both; nothing is sampled away.  Texts that occur
twice as a whole are settled by their key.  An anchor of more than ``hot`` places
does not go to one task: its windows are counted by 128-bit hash instead, exactly
and pre-aggregated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlake.llm.anchors import Rule, anchors
from demandlake.llm.scratch import written

#: Places of one anchor that one task may hold as blocks (of less than 0.5 KB each; with the finder's
#: index of each block's windows 100 MB and more).
HOT = 20_000


@dataclass
class Block:
    """The units around one anchor (``raw``; words joined by one blank): unit ``at`` is the anchor's first.

    Equal blocks are one, with all its places: (text, number of unit 0 in it).
    """

    at: int
    raw: bytes
    places: list[tuple[tuple[int, int], int]]


#: Blocks of one anchor -> (index of the block, start, end) of repeated spans, in units of the block.
Finder = Callable[[list[Block], Rule], Iterator[tuple[int, int, int]]]


def _words(text: bytes) -> list[bytes]:
    return text.split()  # bytes: the ASCII blanks, no others


def _scan(docs: DataFrame, rule: Rule, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, sha, hs, ps = [], [], [], []
            for t in b.column(3):
                text = (t.as_py() or "").encode()
                if rule.words:
                    words = _words(text)
                    n.append(len(words))
                    sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
                else:
                    n.append(len(text))
                    sha.append(hashlib.sha256(text).hexdigest())
                p, h = anchors(text, rule)
                hs.append(h)
                ps.append(p)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(hs, pa.list_(pa.int64())), pa.array(ps, pa.list_(pa.int64()))],
                names=["doc_id", "t1", "t2", "n", "sha", "hashes", "places"],
            )

    return _keyed(docs, id_col, text_col).mapInArrow(run, "doc_id long, t1 long, t2 long, n long, sha string, hashes array<long>, places array<long>")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"), text.alias("text"))


def _units(text: bytes, rule: Rule) -> list[bytes] | bytes:
    return _words(text) if rule.words else text


def _joined(units: list[bytes] | bytes) -> bytes:
    return b" ".join(units) if isinstance(units, list) else bytes(units)


_BLOCKS = "h long, t1 long, t2 long, firsts longs, at long, block binary"
_SPANS = "t1 long, t2 long, s long, e long"
_WINDOWS = "w1 long, w2 long, t1 long, t2 long, s long"
#: Rows of one Arrow batch that a task sends on.
ROWS = 10_000


def _blocks(rule: Rule):
    """Blocks of a text's candidate anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side = rule.window - rule.gram
        for b in batches:
            rows: list[tuple] = []
            for t1, t2, text, places in _rows(b):
                units = _units(text.encode(), rule)
                own: dict[tuple, list[int]] = {}
                for x in places:
                    if not x["hot"]:
                        p = x["p"]
                        first = max(0, p - side)
                        own.setdefault((x["h"], p - first, _joined(units[first : p + rule.window])), []).append(first)
                rows += [(h, t1, t2, firsts, at, block) for (h, at, block), firsts in own.items()]
                if len(rows) >= ROWS:
                    yield from _batches(rows, _BLOCKS)
                    rows = []
            yield from _batches(rows, _BLOCKS)

    return run


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(c.to_pylist() for c in batch.columns))


def _batches(rows: list[tuple], ddl: str) -> Iterator[pa.RecordBatch]:
    kinds = {"long": pa.int64(), "longs": pa.list_(pa.int64()), "binary": pa.binary(), "string": pa.string()}
    fields = [f.split() for f in ddl.split(", ")]
    for at in range(0, len(rows), ROWS):
        cols = list(zip(*rows[at : at + ROWS]))
        yield pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(cols, fields)], names=[n for n, _ in fields])


def _matches(rule: Rule, find: Finder):
    """Rows sorted by anchor -> spans of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: dict[tuple[int, bytes], list] = {}
        anchor, rows = None, []

        def close() -> None:
            blocks = [Block(at, raw, places) for (at, raw), places in group.items()]
            if len(blocks) > 1 or blocks and len(blocks[0].places) > 1:
                for i, s, e in find(blocks, rule):
                    rows.extend((*text, first + s, first + e) for text, first in blocks[i].places)
            group.clear()

        for b in batches:
            for h, t1, t2, firsts, at, block in _rows(b):
                if h != anchor:
                    close()
                    anchor = h
                group.setdefault((at, block), []).extend(((t1, t2), first) for first in firsts)
            if len(rows) >= ROWS:
                yield from _batches(rows, _SPANS)
                rows.clear()
        close()
        yield from _batches(rows, _SPANS)

    return run


def _hot_windows(rule: Rule):
    """Each window of a text that holds a hot anchor: 128-bit hash and start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side = rule.window - rule.gram
        for b in batches:
            rows = []
            for t1, t2, text, places in _rows(b):
                hot = [x["p"] for x in places if x["hot"]]
                if not hot:
                    continue
                units = _units(text.encode(), rule)
                starts = {s for p in hot for s in range(max(0, p - side), min(p, len(units) - rule.window) + 1)}
                for s in sorted(starts):
                    d = xxhash.xxh3_128_digest(_joined(units[s : s + rule.window]))
                    rows.append((int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True), t1, t2, s))
                if len(rows) >= ROWS:
                    yield from _batches(rows, _WINDOWS)
                    rows = []
            yield from _batches(rows, _WINDOWS)

    return run


def _kept(rule: Rule):
    """What the spans leave of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for t1, t2, text, spans in _rows(b):
                raw = text.encode()
                units = _words(raw) if rule.words else raw
                turn = np.zeros(len(units) + 1, dtype=np.int64)
                np.add.at(turn, [x["s"] for x in spans], 1)
                np.add.at(turn, [x["e"] for x in spans], -1)
                gone = np.cumsum(turn[:-1]) > 0
                runs = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + (len(gone) > 0 and gone[0]))
                if rule.words:
                    left = b" ".join([w for w, g in zip(units, gone.tolist()) if not g])
                else:
                    left = np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes()
                rows.append((t1, t2, int(gone.sum()), runs, hashlib.sha256(left).hexdigest(), left))
            yield from _batches(rows, "t1 long, t2 long, n_removed long, n_spans long, sha string, left binary")

    return run


def _changes(scan: DataFrame, docs: DataFrame, rule: Rule, find: Finder, id_col: str, text_col: str, hot: int, with_text: bool) -> DataFrame:
    """(k1, k2, n_removed, n_spans, cut_sha, left) for each distinct text that loses something."""
    texts = scan.groupBy("t1", "t2").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("rep"), F.max("n").alias("n"))
    copied = written(texts.where("copies > 1").select(F.col("t1").alias("k1"), F.col("t2").alias("k2"), "rep", "n"), "repeats-copied")
    # One row of each text speaks for it.
    alone = scan.select("t1", "t2", "doc_id", "hashes", "places").join(copied, (F.col("t1") == F.col("k1")) & (F.col("t2") == F.col("k2")), "left")
    alone = alone.where(F.col("k1").isNull() | F.col("doc_id").eqNullSafe(F.col("rep")))
    pairs = F.explode(F.arrays_zip(F.col("hashes").alias("h"), F.col("places").alias("p")))
    places = alone.select("t1", "t2", "doc_id", pairs.alias("x")).select("t1", "t2", "doc_id", "x.h", "x.p")
    place = F.xxhash64("t1", "t2", "p")
    often = places.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("a"), F.max(place).alias("b")).where(F.col("a") != F.col("b"))
    often = written(often.select("h", (F.col("n") > hot).alias("hot")), "repeats-anchors")
    found = places.join(often, "h").groupBy("t1", "t2", "doc_id").agg(F.collect_set(F.struct("p", "h", "hot")).alias("places")).withColumnRenamed("doc_id", "rep")
    texted = _keyed(docs, id_col, text_col)
    same = (texted["t1"] == found["t1"]) & (texted["t2"] == found["t2"]) & texted["doc_id"].eqNullSafe(found["rep"])
    held = written(texted.join(found, same).select(texted["t1"], texted["t2"], "text", "places"), "repeats-texts")

    blocks = held.mapInArrow(_blocks(rule), _BLOCKS.replace("longs", "array<long>"))
    spans = blocks.repartition("h").sortWithinPartitions("h").mapInArrow(_matches(rule, find), _SPANS)
    if often.where("hot").limit(1).count():
        windows = written(held.mapInArrow(_hot_windows(rule), _WINDOWS), "repeats-windows")
        at = F.xxhash64("t1", "t2", "s")
        twice = windows.groupBy("w1", "w2").agg(F.min(at).alias("a"), F.max(at).alias("b")).where(F.col("a") != F.col("b")).select("w1", "w2")
        spans = spans.unionAll(windows.join(twice, ["w1", "w2"], "left_semi").select("t1", "t2", "s", (F.col("s") + rule.window).alias("e")))
    # A text that occurs twice goes whole; it was held only for what others have of it.
    whole = copied.where(F.col("n") >= rule.window).select("k1", "k2", F.col("n").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.lit(hashlib.sha256(b"").hexdigest()).alias("cut_sha"), F.lit(b"").alias("left"))
    spans = spans.join(whole.select("k1", "k2"), (F.col("t1") == F.col("k1")) & (F.col("t2") == F.col("k2")), "left_anti")
    # Written, so that their size is known before the texts are shuffled to meet them.
    spans = written(spans.groupBy("t1", "t2").agg(F.collect_set(F.struct("s", "e")).alias("spans")), "repeats-spans")
    cut = held.select("t1", "t2", "text").join(spans, ["t1", "t2"]).select("t1", "t2", "text", "spans")
    left = "left" if with_text else "cast(null as binary) as left"
    cut = cut.mapInArrow(_kept(rule), "t1 long, t2 long, n_removed long, n_spans long, sha string, left binary")
    cut = cut.selectExpr("t1 as k1", "t2 as k2", "n_removed", "n_spans", "sha as cut_sha", left).dropDuplicates(["k1", "k2"])
    return written(cut.unionAll(whole), "repeats-changes")


def remove_repeats(docs: DataFrame, rule: Rule, find: Finder, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """(doc_id, n, n_removed, n_spans, kept_sha256) for every row of ``docs``.

    A unit goes if a window that covers it starts anywhere else too, in any text.
    Null text: no units.  Repeated rows: all goes, unless shorter than a window.
    Null ids are kept.  Empty table: no rows.  Other columns are ignored.
    """
    scan = written(_scan(docs, rule, id_col, text_col), "repeats-scan")
    changes = _changes(scan, docs, rule, find, id_col, text_col, hot, False)
    out = scan.select("doc_id", "t1", "t2", "n", "sha").join(changes, (F.col("t1") == F.col("k1")) & (F.col("t2") == F.col("k2")), "left")
    count = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return out.select("doc_id", "n", count("n_removed"), count("n_spans"), F.coalesce("cut_sha", "sha").alias("kept_sha256"))


def without_repeats(docs: DataFrame, rule: Rule, find: Finder, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """``docs`` and a column ``kept`` (binary): what is left of the text, null where nothing goes.

    Same rules as ``remove_repeats``; a column of ``docs`` named kept is replaced.
    """
    scan = written(_scan(docs, rule, id_col, text_col), "repeats-scan")
    changes = _changes(scan, docs, rule, find, id_col, text_col, hot, True).select("k1", "k2", F.col("left").alias("kept"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.drop("kept")
    keyed = own.select(F.struct(*[F.col(f"`{c}`") for c in own.columns]).alias("row"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"))
    return keyed.join(changes, (F.col("t1") == F.col("k1")) & (F.col("t2") == F.col("k2")), "left").select("row.*", "kept")
