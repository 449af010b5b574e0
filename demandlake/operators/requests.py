"""Request validation (F2, F3, P5, P11) and run keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandlake import messages
from demandlake.constants import INVALID_PERIOD, INVALID_REQUEST
from demandlake.functions.dates import period_error_message, period_error_reason, requested_period
from demandlake.functions.text import slugify, strip
from demandlake.messages import sentence
from demandlake.session import fresh_dir

def validate_periods(requests: DataFrame, today) -> DataFrame:
    """F2 per request row: adds period_reason, error_code, error_message, requested_period."""
    g = F.lower(F.col("granularity"))
    reason = period_error_reason(g, F.col("date_from"), F.col("date_to"), today)
    return (
        requests.withColumn("period_reason", reason)
        .withColumn("error_code", F.when(F.col("period_reason").isNotNull(), F.lit(INVALID_PERIOD)))
        .withColumn("error_message", period_error_message(F.col("period_reason")))
        .withColumn("requested_period", requested_period(F.col("date_from"), F.col("date_to")))
    )


def validate_batches(requests: DataFrame, today) -> DataFrame:
    """one verdict per batch, first failing rule wins.

    ``requests(batch_id, phrase_ord, phrase, region, granularity, date_from,
    date_to, resume_run)``; batch-level fields are taken from the first phrase.
    The per-batch reduction is a partial aggregation, so a batch with a huge
    phrase list never gathers in one task.
    """
    per = requests.groupBy("batch_id").agg(
        F.count(F.col("phrase")).alias("n_phrases"),
        F.bool_or(strip(F.coalesce(F.col("phrase"), F.lit(""))) == "").alias("any_blank"),
        F.min_by(F.struct("region", "granularity", "date_from", "date_to", "resume_run"), "phrase_ord").alias("b"),
    )
    g = F.lower(F.col("b.granularity"))
    period = period_error_reason(g, F.col("b.date_from"), F.col("b.date_to"), today)
    out = per.withColumn("period_reason", period)
    rule = (
        F.when(F.col("period_reason").isNotNull(), F.col("period_reason"))
        .when(F.col("n_phrases") == 0, F.lit("no_phrases"))
        .when(strip(F.coalesce(F.col("b.region"), F.lit(""))) == "", F.lit("blank_region"))
        .when(F.col("any_blank"), F.lit("blank_phrase"))
        .when(F.col("b.resume_run").isNotNull() & (F.col("n_phrases") != 1), F.lit("resume_needs_one"))
    )
    msg = sentence(F.col("reason"), messages.PERIOD | messages.BATCH)
    return (
        out.withColumn("reason", rule)
        .withColumn("error_code", F.when(F.col("period_reason").isNotNull(), F.lit(INVALID_PERIOD))
                    .when(F.col("reason").isNotNull(), F.lit(INVALID_REQUEST)))
        .withColumn("error_message", msg)
        .drop("b", "any_blank", "period_reason")
    )


def _numbered(rows: DataFrame, key: str, order: str, name: str, bucket_size: int) -> DataFrame:
    """``rows`` with ``name``: 1, 2, ... in ``order`` (a unique whole number) inside each ``key``.

    Rows fall in (key, b1 = order div B) cells, cells in (key, b2 = b1 div B) blocks;
    running offsets are summed over block counts, then over cell counts inside a
    block, and only a cell is ranked row by row: a hot key spreads over many tasks.
    """
    placed = rows.withColumn("_b1", F.expr(f"`{order}` div {bucket_size}"))
    # Whatever the plan does with the rows, the counting needs the keys alone.
    cells = placed.groupBy(key, "_b1").agg(F.count(F.lit(1)).alias("_n")).withColumn("_b2", F.expr(f"_b1 div {bucket_size}"))
    blocks = cells.groupBy(key, "_b2").agg(F.sum("_n").alias("_n2"))
    earlier = lambda part, by: Window.partitionBy(*part).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(key, "_b2", F.coalesce(F.sum("_n2").over(earlier([key], "_b2")), F.lit(0)).alias("_off2"))
    offsets = cells.join(blocks, [key, "_b2"]).select(
        key, "_b1", (F.col("_off2") + F.coalesce(F.sum("_n").over(earlier([key, "_b2"], "_b1")), F.lit(0))).alias("_off"))
    rank = F.row_number().over(Window.partitionBy(key, "_b1").orderBy(order))
    return placed.join(offsets, [key, "_b1"]).withColumn(name, rank + F.col("_off")).drop("_b1", "_off")


def _free_numbers(ranked: DataFrame, taken: DataFrame, sizes: DataFrame, bucket_size: int) -> DataFrame:
    """``ranked(base_key, _rank)`` with ``collision_n``: the _rank-th number from 1 that isn't in ``taken(base_key, _k)``.

    The j-th taken number t of a base has t - j free numbers below it, so the
    taken numbers are intervals [.., t], one for each value of t - j, with j as
    their prefix count; the r-th free number is r plus the largest j whose t - j is
    below r.  That largest j is a running maximum over both kinds of rows in the
    order of their places, taken first inside cells of ``bucket_size`` places, then
    over the cells and blocks: no row holds more than one interval, and no task
    more than a cell of a base.  ``sizes(base_key, _total)``: requests of each base.
    """
    many = taken.groupBy("base_key").agg(F.count(F.lit(1)).alias("_many"))
    reach = sizes.join(many, "base_key").select("base_key", (F.col("_total") + F.col("_many")).alias("_reach"), "_total")
    # A number beyond all requests and taken numbers is never reached.
    near = taken.join(reach, "base_key").filter(F.col("_k") <= F.col("_reach")).select("base_key", "_k", "_total")
    counted = _numbered(near, "base_key", "_k", "_j", bucket_size).withColumn("_place", F.col("_k") - F.col("_j"))
    gaps = counted.filter(F.col("_place") < F.col("_total")).groupBy("base_key", "_place").agg(F.max("_j").alias("_j"))
    cell = lambda c, n: F.expr(f"`{c}` div {n}")
    cells = gaps.groupBy("base_key", cell("_place", bucket_size).alias("_b1")).agg(F.max("_j").alias("_j1"))
    wanted = ranked.groupBy("base_key", cell("_rank", bucket_size).alias("_b1")).agg(F.lit(None).cast("bigint").alias("_j1"))
    cells = cells.unionByName(wanted).groupBy("base_key", "_b1").agg(F.max("_j1").alias("_j1")).withColumn("_b2", cell("_b1", bucket_size))
    earlier = lambda part, by: Window.partitionBy(*part).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    blocks = cells.groupBy("base_key", "_b2").agg(F.max("_j1").alias("_j2"))
    blocks = blocks.select("base_key", "_b2", F.max("_j2").over(earlier(["base_key"], "_b2")).alias("_before2"))
    before = cells.join(blocks, ["base_key", "_b2"]).select(
        "base_key", "_b1", F.greatest("_before2", F.max("_j1").over(earlier(["base_key", "_b2"], "_b1"))).alias("_before"))
    asked = ranked.withColumns({"_place": F.col("_rank"), "_j": F.lit(None).cast("bigint"), "_asked": F.lit(True)})
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in ranked.schema.fields if f.name != "base_key"]
    both = asked.unionByName(gaps.select("base_key", *blank, "_place", "_j", F.lit(False).alias("_asked"))).withColumn("_b1", cell("_place", bucket_size))
    # At one place the request comes first: an interval counts for requests beyond its place only.
    inside = Window.partitionBy("base_key", "_b1").orderBy("_place", F.desc("_asked")).rowsBetween(Window.unboundedPreceding, -1)
    passed = F.greatest(F.max("_j").over(inside), F.col("_before"))
    found = both.join(before, ["base_key", "_b1"], "left").withColumn("_passed", passed).filter("_asked")
    return found.withColumn("collision_n", F.col("_rank") + F.coalesce("_passed", F.lit(0))).drop("_place", "_j", "_asked", "_b1", "_before", "_passed")


def run_keys(requests: DataFrame, order: str, now: str = "now", phrase: str = "phrase",
             existing: DataFrame | None = None, bucket_size: int = 4096) -> DataFrame:
    """S12 + W3: ``<UTC yyyyMMdd'T'HHmmss'Z'>-<slug>``, unique by '-2', '-3', ...

    Requests of one base are numbered in ``order`` (a unique integer); number 1
    is the base itself.  A number whose key is taken is passed over: taken are
    the keys of ``existing`` (column run_key), and the bases of other requests
    (a slug may itself end in '-2').  The k-th request gets the k-th free number.

    Requests and taken numbers of one base are ranked and met in cells (see
    ``_numbered`` and ``_free_numbers``), so either may hold a third of all rows.
    """
    base = F.concat(F.date_format(F.col(now), "yyyyMMdd'T'HHmmss'Z'"), F.lit("-"), slugify(F.col(phrase)))
    req = requests.withColumn("base_key", base)
    # A base may come from a text of any length: it is made once for all that follows, and once for the result.
    spark, path = requests.sparkSession, fresh_dir(requests.sparkSession, "run-keys")
    bases = req.select(F.col(order).alias(order), "base_key")
    bases.write.parquet(path)
    bases = spark.read.schema(bases.schema).parquet(path)
    sizes = bases.groupBy("base_key").agg(F.count(F.lit(1)).alias("_total"))
    # Keys that are taken whatever this batch does: existing ones, and every base of the batch.
    keys = sizes.select(F.col("base_key").alias("run_key"))
    if existing is not None:
        keys = keys.unionByName(existing.select("run_key")).distinct()
    number = F.regexp_extract("run_key", r"^(.*)-([1-9][0-9]*)$", 2).try_cast("bigint")
    taken = keys.select(F.regexp_extract("run_key", r"^(.*)-([1-9][0-9]*)$", 1).alias("base_key"), number.alias("_k")).filter(F.col("_k") >= 2)
    if existing is not None:
        taken = taken.unionByName(existing.select(F.col("run_key").alias("base_key"), F.lit(1).cast("bigint").alias("_k")).distinct())
    # The numbers are found on (base, order) alone; the requests meet them once.
    ranked = _numbered(bases.select("base_key", order), "base_key", order, "_rank", bucket_size)
    numbered = _free_numbers(ranked, taken, sizes, bucket_size).select(order, F.col("collision_n").cast("int").alias("collision_n"))
    return req.join(numbered, order).withColumn("run_key", F.when(F.col("collision_n") == 1, F.col("base_key"))
                                                .otherwise(F.concat(F.col("base_key"), F.lit("-"), F.col("collision_n").cast("string"))))
