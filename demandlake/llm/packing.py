"""Operator 5: bulk-synchronous best-fit packing.

Pieces and gaps are whole numbers of at most ``capacity``, so range-sorted they
form runs of equal length: at most ``capacity`` of either, however many documents
there are.  A superstep takes the longest run of pieces not yet placed and sweeps
the runs of gaps upward from its successor (the smallest gap that holds a piece);
the k-th piece of the run gets the k-th place, which settles conflicts by rank;
what is left opens new sequences; the gaps are updated, and the next superstep
begins.  Only runs pass through the driver.  The pieces themselves are ranked and
placed by Spark.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandlake.llm.scratch import written
from demandlake.llm.tokens import tokenizer

END_ID = 1
#: Rows that one window of the ranking holds, about.
RANK_ROWS = 100_000
#: Texts tokenized together in a task.
BATCH = 512


def token_pieces(docs: DataFrame, path: str, capacity: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each text's ids and END_ID, cut into pieces of ``capacity`` ids.

    Null and empty texts are one piece, END_ID alone.  Null ids and repeated rows
    stay, each with pieces of its own.  Very long texts: any number of pieces.  Empty
    table: no rows.  Other columns are ignored, whatever their names.
    """
    end = END_ID.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path, keep_blanks=False)
        for b in batches:
            rows = []
            for at in range(0, b.num_rows, BATCH):
                part = b.slice(at, BATCH)
                for doc, ids in zip(part.column(0).to_pylist(), tok.ids([x or "" for x in part.column(1).to_pylist()])):
                    ids += end
                    for k in range(0, len(ids), 4 * capacity):
                        own = ids[k : k + 4 * capacity]
                        rows.append((doc, k // (4 * capacity), k // 4, len(own) // 4, zlib.crc32(own)))
            cols = list(zip(*rows)) or [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    thin = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return thin.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit_runs(lengths: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Supersteps over runs: (length, first rank, pieces in a sequence, first sequence, offset), by length and rank.

    Pieces of ``length`` ranked from ``first rank`` on fill consecutive sequences
    from ``first sequence``, so many in each, from ``offset`` on.
    """
    gaps: dict[int, list[list[int]]] = {}  # gap: runs [first sequence, sequences]
    plan, opened = [], 0
    for length in sorted(lengths, reverse=True):
        left, rank = lengths[length], 0
        new: dict[int, list[list[int]]] = {}

        def place(first: int, count: int, gap: int, each: int) -> None:
            nonlocal left, rank
            plan.append((length, rank, each, first, capacity - gap))
            rank += count * each
            left -= count * each
            if rest := gap - each * length:
                new.setdefault(rest, []).append([first, count])

        for gap in sorted(g for g in gaps if g >= length):
            runs, each = gaps[gap], gap // length
            while runs and left:
                first, count = runs[-1]
                take = min(count, left // each)
                if take:
                    place(first, take, gap, each)
                else:  # fewer pieces than one sequence could take
                    take = 1
                    place(first, 1, gap, left)
                if take == count:
                    runs.pop()
                else:
                    runs[-1] = [first + take, count - take]
            if not runs:
                del gaps[gap]
            if not left:
                break
        each = capacity // length
        if count := left // each:
            place(opened, count, capacity, each)
            opened += count
        if left:
            place(opened, 1, capacity, left)
            opened += 1
        for gap, runs in new.items():
            gaps.setdefault(gap, []).extend(runs)
    return plan


def ranked(pieces: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``pieces`` with ``rank``, 0-based within ``group``; a hot group is dealt over many windows."""
    slices = max(8, pieces.count() // RANK_ROWS)
    sliced = pieces.withColumn("slice", F.pmod(F.xxhash64(*order), F.lit(slices)).cast("int"))
    counts = sliced.groupBy(group, "slice").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(group).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(group, "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy(group, "slice").orderBy(*order)
    return sliced.withColumn("own", F.row_number().over(own) - 1).join(offsets, [group, "slice"]).withColumn("rank", F.col("own") + F.col("before")).drop("own", "before", "slice")


def _at_or_below(xs: Column, x: Column) -> Column:
    """Number of entries of the sorted array ``xs`` at or below ``x`` (binary search, up to 2**24 entries)."""
    halves = F.array(*[F.lit(1 << k) for k in range(23, -1, -1)])
    return F.aggregate(halves, F.lit(0), lambda lo, half: F.when(F.get(xs, lo + half - 1) <= x, lo + half).otherwise(lo))


def pack(pieces: DataFrame, capacity: int, order: list[str]) -> DataFrame:
    """``pieces`` (each ``length`` 1 to ``capacity``) with ``sequence_id`` and ``offset``, best fit, longest first.

    ``order`` names columns that tell the pieces apart; rows equal in all of them
    (repeated rows, pieces of equal ids) are interchangeable, each has a place of its
    own.  Nulls in ``order`` are values like others.  Empty table: no rows.  ``pieces``
    is what ``token_pieces`` returns, or has such columns; its own columns are kept.
    """
    pieces = written(pieces, "pack-pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    by_length: dict[int, list[list[int]]] = {}
    for length, *row in best_fit_runs(counts, capacity):
        runs = by_length.setdefault(length, [[], [], [], []])
        for values, x in zip(runs, row):
            values.append(x)
    longs = T.ArrayType(T.LongType())
    schema = T.StructType([T.StructField("length", T.LongType()), *[T.StructField(c, longs) for c in ("ranks", "eachs", "firsts", "offsets")]])
    runs = pieces.sparkSession.createDataFrame([(k, *v) for k, v in by_length.items()], schema)
    placed = ranked(pieces, "length", order).join(runs, "length").withColumn("at", _at_or_below(F.col("ranks"), F.col("rank")) - 1)
    placed = placed.withColumn("k", F.col("rank") - F.get("ranks", F.col("at"))).withColumn("each", F.get("eachs", F.col("at")))
    return placed.select(
        *pieces.columns,
        (F.get("firsts", F.col("at")) + F.floor(F.col("k") / F.col("each"))).alias("sequence_id"),
        (F.get("offsets", F.col("at")) + F.pmod(F.col("k"), F.col("each")) * F.col("length")).alias("offset"),
    )
