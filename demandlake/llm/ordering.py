"""Global order and prefix sums over any number of rows, without a global sort task.

Sampled splitters cut the key space into ranges; exact totals per range give
the offsets; a window inside each range gives the rest.  Only the splitters and
one total per range (both bounded by ``ranges``) reach the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Sampled keys for each splitter: the boundary of a range is off by about 1/sqrt(OVERSAMPLE).
OVERSAMPLE = 32
MAX_RANGES = 4096
ROWS_PER_RANGE = 200_000
ROUNDS = 4


def hex_key(value: Column) -> Column:
    """A long as 16 hex digits whose text order is the numeric order; null sorts first, as ''."""
    flipped = value.cast("long").bitwiseXOR(F.lit(-(2**63)))
    return F.coalesce(F.lpad(F.hex(flipped), 16, "0"), F.lit(""))


def hash_key(*values: Column) -> Column:
    """A 64-bit hash as 16 hex digits (a pseudo-random order in which equal values are neighbours)."""
    return F.lpad(F.hex(F.xxhash64(*values)), 16, "0")


def literal_list(values: list[str]) -> Column:
    return F.split(F.lit(",".join(values)), ",", -1)


def range_of(key: Column, splitters: list[str]) -> Column:
    """Number of splitters at or below ``key``, by binary search (one comparison per level)."""
    n = len(splitters)
    if not n:
        return F.lit(0)
    levels = [1 << k for k in range(n.bit_length() - 1, -1, -1)]
    bounds = literal_list(splitters)
    step = lambda lo, half: F.when(F.get(bounds, lo + half - 1) <= key, lo + half).otherwise(lo)  # noqa: E731  past the end: null, so not taken
    return F.aggregate(F.array(*[F.lit(x) for x in levels]), F.lit(0), step)


def sampled_splitters(keyed: DataFrame, key: str, weight: Column, total: int, parts: int, seed: int) -> list[str]:
    """Up to ``parts - 1`` increasing keys at the weight quantiles of a sample.

    A row is drawn with probability weight * OVERSAMPLE * parts / total (1 at
    most), decided by a hash of its key, so reruns draw the same rows; about
    OVERSAMPLE * parts keys come to the driver.
    """
    if parts < 2 or total <= 0:
        return []
    rate = OVERSAMPLE * parts / total
    uniform = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 52)) / F.lit(float(1 << 52))
    drawn = keyed.select(F.col(key).alias("k"), (weight * F.lit(rate)).cast("double").alias("w")).where(uniform < F.col("w"))
    sample = drawn.groupBy("k").agg(F.sum(F.greatest("w", F.lit(1.0))).alias("w")).collect()
    rows = sorted((r.k, r.w) for r in sample)
    step, seen, out = sum(w for _, w in rows) / parts, 0.0, []
    for k, w in rows:
        if seen >= step * (len(out) + 1) and len(out) < parts - 1 and (not out or k > out[-1]):
            out.append(k)
            while seen >= step * (len(out) + 1) and len(out) < parts - 1:
                out.append(k)  # a heavy key covers several quantiles
        seen += w
    return sorted(set(out))


def ranges_of(keyed: DataFrame, key: str, weight: Column, parts: int | None = None) -> tuple[list[str], list]:
    """Splitters and the totals (rows, weight) of every range, in order.

    A range of more than twice its fair share is overfull: it is sampled again
    on its own and subdivided, for ROUNDS rounds or until only equal keys remain.
    """
    whole = keyed.agg(F.count(F.lit(1)).alias("n"), F.sum(weight).alias("w")).first()
    n, total = whole.n, int(whole.w or 0)
    parts = parts or 1
    parts = min(MAX_RANGES, max(parts, math.ceil(n / ROWS_PER_RANGE), 1))
    splitters = sampled_splitters(keyed, key, weight, total, parts, 1)
    for round_ in range(ROUNDS + 1):
        totals = {r.range_id: r for r in keyed.groupBy(range_of(F.col(key), splitters).alias("range_id")).agg(F.count(F.lit(1)).alias("n"), F.sum(weight).alias("w")).collect()}
        limit = 2 * total / parts
        overfull = [i for i, r in totals.items() if r.w > limit and r.n > 1]
        if not overfull or round_ == ROUNDS:
            break
        more = set(splitters)
        at = range_of(F.col(key), splitters)
        inside = keyed.where(at.isin(overfull))
        share = sum(int(totals[i].w) for i in overfull)
        more.update(sampled_splitters(inside, key, weight, share, math.ceil(2 * share * parts / total), round_ + 2))
        if len(more) == len(splitters):
            break
        splitters = sorted(more)
    return splitters, [(totals[i].n, int(totals[i].w)) if i in totals else (0, 0) for i in range(len(splitters) + 1)]


def with_prefix(keyed: DataFrame, key: str, value: str, parts: int | None = None) -> DataFrame:
    """``keyed`` (read several times: pass a written table) with ``row_index``
    (0-based place in key order) and ``before`` (sum of ``value`` of all earlier rows).

    Rows with equal keys get an arbitrary order among themselves; make the key
    unique where that matters.  Values must not be null.
    """
    splitters, totals = ranges_of(keyed, key, F.col(value) + F.lit(1), parts)
    rows, sums = [0], [0]
    for n, w in totals:
        rows.append(rows[-1] + n)
        sums.append(sums[-1] + w - n)
    window = Window.partitionBy("range_id").orderBy(key)
    at = lambda xs: F.get(literal_list([str(x) for x in xs]).cast("array<long>"), F.col("range_id"))
    return (
        keyed.withColumn("range_id", range_of(F.col(key), splitters))
        .withColumn("row_index", F.row_number().over(window) - F.lit(1) + at(rows))
        .withColumn("before", F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col(value) + at(sums))
        .drop("range_id")
    )
