"""Operator 8: mixing sources to target weights by hash-threshold histograms.

Tokens are summed by source and hash bucket.  A source's budget is met by taking
every row whose hash lies below a threshold; the bucket that holds the threshold
is refined alone, level by level, and the rows are then filtered without a sort.
Budgets above one pass are nested: everything once, and the rows below the
threshold once more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandlake.llm.ordering import with_prefix
from demandlake.llm.scratch import written

#: Bits of the hash that a level resolves, and levels: the last cell is 2**-48 of a source.
LEVEL_BITS, LEVELS = 12, 4
HASH_BITS = LEVEL_BITS * LEVELS


def source_targets(sizes: DataFrame, weights: list[int], share: float, most: float) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row for each source.

    Sources in code point order, null last, weigh ``weights`` in turn.  The
    budget is ``share`` of all sizes; no target passes ``most`` times its
    source's size, and the excess is shared again by weight among the others.
    The level of that water-filling is found by sums alone: each round caps the
    sources that the level reaches, until none is added.
    """
    keyed = written(sizes.withColumn("key", F.coalesce(F.hex(F.col("source").cast("binary")), F.lit("~"))).withColumn("one", F.lit(0).cast("long")), "mix-sources")
    ranked = with_prefix(keyed, "key", "one").withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("row_index"), F.lit(len(weights))).cast("int")))
    ranked = written(ranked.select("source", "source_size", "weight"), "mix-weights")
    budget = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    limit, level, capped = F.lit(most) * F.col("source_size"), 0.0, -1
    while True:
        over = limit <= F.lit(level) * F.col("weight")
        r = ranked.agg(F.sum(F.when(over, 1).otherwise(0)).alias("n"), F.sum(F.when(over, limit).otherwise(0.0)).alias("used"), F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("w")).first()
        if not r.w or r.n == capped:
            break
        capped, level = r.n, (budget - r.used) / r.w
    return ranked.select("source", "source_size", F.least(limit, F.lit(level) * F.col("weight")).alias("target"))


def _thresholds(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, passes, threshold): rows are taken ``passes`` times, and once more where hash < threshold."""
    live = targets.withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    live = live.withColumn("left", F.col("target") - F.col("passes") * F.col("source_size")).select("source", "passes", "left", F.lit(0).cast("long").alias("low"))
    for level in range(LEVELS):
        shift = HASH_BITS - LEVEL_BITS * (level + 1)
        # Cells are numbered by all the bits resolved so far; only those inside the boundary cell are counted.
        cell = F.shiftright("h", shift)
        cells = rows.select(F.col("source").alias("s"), F.col("size").alias("z"), cell.alias("cell"), F.shiftright("h", shift + LEVEL_BITS).alias("parent"))
        inside = cells.join(live.select("source", "low"), F.col("s").eqNullSafe(F.col("source")) & (F.col("parent") == F.col("low")), "left_semi") if level else cells
        histogram = inside.groupBy("s", "cell").agg(F.sum("z").alias("z"))
        window = Window.partitionBy("s").orderBy("cell")
        running = histogram.withColumn("until", F.sum("z").over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        met = running.join(live, F.col("s").eqNullSafe(F.col("source")))
        # The boundary cell is the first whose running sum passes what is left.
        found = met.where(F.col("until") > F.col("left")).groupBy("s").agg(F.min(F.struct("cell", "until", "z")).alias("at"))
        live = live.join(found, F.col("source").eqNullSafe(F.col("s")), "left").select(
            "source", "passes",
            F.when(F.col("at").isNotNull(), F.col("left") - (F.col("at.until") - F.col("at.z"))).otherwise(F.col("left")).alias("left"),
            # No cell passes the rest (its rows have no size): everything inside goes.
            F.coalesce(F.col("at.cell"), (F.col("low") + 1) * (1 << LEVEL_BITS) - 1 if level else F.lit((1 << LEVEL_BITS) - 1)).cast("long").alias("low"),
            F.coalesce(F.col("at.z"), F.lit(0)).alias("cell_size"),
        )
        if level < LEVELS - 1:
            live = written(live.drop("cell_size"), f"mix-level{level}")
    # The last cell (rows of one hash value, in practice one document) goes in if that is nearer to the budget.
    return live.select("source", "passes", F.when(F.lit(2.0) * F.col("left") > F.col("cell_size"), F.col("low") + 1).otherwise(F.col("low")).alias("threshold"))


def mix(docs: DataFrame, size: Column, keys: list[Column], weights: list[int], share: float, most: float, source_col: str = "source") -> DataFrame:
    """``docs`` with ``source_size``, ``target`` and ``copies`` (how often the mix takes the row) added.

    ``size`` is the row's token count (null counts 0); ``keys`` identify the row
    and seed its hash, so reruns and other row orders agree.  Rows with equal
    keys share their fate.  ``most`` must be a whole number of passes or more
    than ``share``.  A null source is a source of its own.  Rows of size 0 are
    taken like others; an empty table gives no rows; columns of ``docs`` named
    like the added ones are replaced.
    """
    base = docs.drop("source_size", "target", "copies")
    size = F.coalesce(size.cast("long"), F.lit(0).cast("long"))
    h = F.shiftrightunsigned(F.xxhash64(*keys), 64 - HASH_BITS)
    rows = written(docs.select(F.col(source_col).cast("string").alias("source"), size.alias("size"), h.alias("h")), "mix-rows")
    targets = written(source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most), "mix-targets")
    cut = written(_thresholds(rows, targets), "mix-cuts")
    # Written, so that Spark knows its size before it plans the join with the whole rows: a row for each source.
    plan = cut.join(targets.select(F.col("source").alias("s"), "source_size", "target"), F.col("source").eqNullSafe(F.col("s"))).drop("source")
    plan = written(plan, "mix-plan")
    hashed = docs.select(F.struct(*[F.col(f"`{c}`") for c in base.columns]).alias("row"), F.col(source_col).cast("string").alias("source"), h.alias("h"))
    copies = (F.col("passes") + F.when(F.col("h") < F.col("threshold"), 1).otherwise(0)).cast("int")
    return hashed.join(plan, F.col("source").eqNullSafe(F.col("s"))).select("row.*", "source_size", "target", copies.alias("copies"))
