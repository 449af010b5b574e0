"""Landing-zone rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandlake.functions.hof import let
from demandlake.constants import DOWNLOAD_ESCAPED, DOWNLOAD_TIMEOUT, INTERFACE_CHANGED


def is_csv(path: Column) -> Column:
    return F.lower(path).endswith(".csv")


def accepted(path: Column, length: Column) -> Column:
    """A regular '.csv' file (any case) is accepted once its size is > 0."""
    return is_csv(path) & (length > 0)


def normalise_path(path: Column) -> Column:
    """Resolve '.', '..' and repeated '/' lexically (absolute paths)."""
    parts = F.filter(F.split(path, "/"), lambda p: (p != "") & (p != "."))
    resolved = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, p: F.when(p == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.concat(acc, F.array(p))),
    )
    return F.concat(F.lit("/"), F.array_join(resolved, "/"))


def contained(path: Column, roots: Column) -> Column:
    """the normalised path lies under one of ``roots`` (ARRAY<STRING>)."""
    p = normalise_path(path)
    return let(p, lambda q: F.exists(roots, lambda r: F.startswith(q, F.concat(F.rtrim(normalise_path(r), F.lit("/")), F.lit("/")))))


def new_files(before: DataFrame, after: DataFrame, key: str = "norm_path") -> DataFrame:
    """J5 + U4: files present after and absent before, by normalised path."""
    return after.join(before.select(key), key, "left_anti")


def write_snapshot(files: DataFrame, path: str, snapshot: int) -> None:
    """U4: the listing ``files(path, length, modificationTime)`` kept as snapshot number
    ``snapshot`` under ``path``.  Writing a number again replaces that snapshot only.
    One row of nulls stands for the snapshot itself, which may hold no file."""
    kept = files.select(normalise_path(F.regexp_replace("path", "^[a-z]+:/*", "/")).alias("norm_path"), "length", "modificationTime")
    marker = files.sparkSession.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in kept.schema.fields])
    kept.unionByName(marker).write.mode("overwrite").parquet(f"{path}/snapshot={snapshot}")


def snapshot_changes(snapshots: DataFrame) -> DataFrame:
    """J5 + U4: what each snapshot changed against the one before, one row for each file
    that isn't the same: ``added``, ``changed`` (another size or time) or ``gone``.

    ``snapshots(snapshot, norm_path, length, modificationTime)``, numbered without
    gaps or not; the first counts as following an empty one.  Every file meets its
    own entry of the next snapshot by an equi-join, so neither a folder nor a
    history is gathered anywhere.
    """
    # One row a snapshot, however many files they hold.
    steps = snapshots.select("snapshot").distinct().select(F.col("snapshot").alias("after"), F.lead("snapshot").over(Window.orderBy("snapshot")).alias("next"))
    files = snapshots.filter(F.col("norm_path").isNotNull())
    old = files.join(steps.filter(F.col("next").isNotNull()), F.col("snapshot") == F.col("after")).select(F.col("next").alias("snapshot"), "norm_path", F.struct("length", "modificationTime").alias("was"))
    new = files.select("snapshot", "norm_path", F.struct("length", "modificationTime").alias("now"))
    both = new.join(old, ["snapshot", "norm_path"], "full")
    change = (
        F.when(F.col("was").isNull(), F.lit("added")).when(F.col("now").isNull(), F.lit("gone"))
        .when(~F.col("was").eqNullSafe(F.col("now")), F.lit("changed"))
    )
    return both.select("snapshot", "norm_path", change.alias("change"), F.col("was.length").alias("length_before"), F.col("now.length").alias("length")).filter(F.col("change").isNotNull())


def attempt_outcomes(attempts: DataFrame, keys: list[str], seq: str = "seq") -> DataFrame:
    """what the fetches of an export come to, for each of ``keys`` (a run, its session and a view).

    ``attempts(*keys, seq, view, row_count, error_code)`` in the order of ``seq``
    (unique inside a key).  An empty dynamics export isn't trusted at once: the
    first one is fetched again, a second one is a failure; rows, or an empty
    export of another view, are stored; any other error fails at once.  The first
    decision stands, later attempts change nothing.

    outcome: ``stored``, ``failed``, or ``pending`` (one empty export, not fetched
    again yet); ``decided_at`` is the attempt that decided, ``n_empty`` the
    untrusted exports up to there.  The order is folded by minima of ``seq``: two
    partial aggregations, however many attempts a key has.
    """
    empty = (F.col("view") == "dynamics") & (F.col("row_count") == 0) & F.col("error_code").isNull()
    kind = F.when(F.col("error_code").isNotNull(), "error").when(empty, "empty").otherwise("rows")
    told = attempts.select(*keys, F.col(seq).alias("_seq"), kind.alias("_kind"), "error_code")
    at = lambda k: F.min(F.when(F.col("_kind") == k, F.col("_seq")))
    first = told.groupBy(*keys).agg(
        at("rows").alias("_rows"), at("empty").alias("_empty"), at("error").alias("_error"),
        F.min_by("error_code", F.when(F.col("_kind") == "error", F.col("_seq"))).alias("_code"))
    again = told.filter("_kind = 'empty'").join(first.select(*keys, "_empty"), keys).filter(F.col("_seq") > F.col("_empty")).groupBy(*keys).agg(F.min("_seq").alias("_again"))
    folded = first.join(again, keys, "left")
    decided = F.least("_rows", "_again", "_error")
    outcome = F.when(decided.isNull(), "pending").when(decided == F.col("_rows"), "stored").otherwise("failed")
    code = F.when(decided == F.col("_again"), F.lit(INTERFACE_CHANGED)).when(decided == F.col("_error"), F.col("_code"))
    n_empty = F.when(F.col("_empty") <= F.coalesce(decided, F.col("_empty")), 1).otherwise(0) + F.when(F.col("_again") <= decided, 1).otherwise(0)
    return folded.select(*keys, outcome.alias("outcome"), decided.alias("decided_at"), n_empty.alias("n_empty"), code.alias("error_code"))


def download_verdict(ticks: DataFrame) -> DataFrame:
    """F6 + A9 per (run, view, tick) over the new files seen in that tick.

    exactly one new csv with size > 0 -> ok (warning if an escaped file
    appeared too); more than one new csv -> DOWNLOAD_TIMEOUT; else an escaped
    file -> DOWNLOAD_ESCAPED; else 'waiting'."""
    g = ticks.groupBy("run_id", "view", "tick").agg(
        F.count_if(F.col("inside") & is_csv(F.col("path"))).alias("n_csv"),
        F.count_if(F.col("inside") & is_csv(F.col("path")) & (F.col("length") > 0)).alias("n_csv_ready"),
        F.count_if(~F.col("inside")).alias("n_escaped"),
    )
    verdict = (
        F.when((F.col("n_csv") == 1) & (F.col("n_csv_ready") == 1), F.lit("ok"))
        .when(F.col("n_csv") > 1, F.lit("too_many"))
        .when(F.col("n_escaped") > 0, F.lit("escaped"))
        .otherwise(F.lit("waiting"))
    )
    return (
        g.withColumn("verdict", verdict)
        .withColumn("warning", (F.col("verdict") == "ok") & (F.col("n_escaped") > 0))
        .withColumn("error_code", F.when(F.col("verdict") == "too_many", F.lit(DOWNLOAD_TIMEOUT))
                    .when(F.col("verdict") == "escaped", F.lit(DOWNLOAD_ESCAPED)))
    )


def download_outcomes(downloads: DataFrame, sightings: DataFrame) -> DataFrame:
    """F6 + A9 + J5 over recorded sightings: what each download of a (run, view) came to.

    ``sightings(run_id, view, tick, path, length, inside)`` are the files that were
    there at each look, tick 0 being the look before the download began;
    ``downloads(run_id, view)`` all that were begun.  Only files that weren't there
    at tick 0 count, told by normalised path.  The first tick with a verdict decides
    (see ``download_verdict``); none up to the last look is a timeout.

    verdict: ``ok`` (with ``path``, and ``warning`` where a file landed elsewhere at
    that very tick), ``too_many``, ``escaped`` or ``timeout``; ``decided_at`` is the tick.
    """
    keys = ["run_id", "view"]
    seen = sightings.withColumn("norm_path", normalise_path(F.col("path")))
    before = seen.filter("tick = 0").select(*keys, "norm_path")
    new = seen.filter("tick > 0").join(before, [*keys, "norm_path"], "left_anti").dropDuplicates([*keys, "tick", "norm_path"])
    ready = new.filter(F.col("inside") & accepted(F.col("path"), F.col("length"))).groupBy(*keys, "tick").agg(F.max("path").alias("path"))
    ticks = download_verdict(new).filter("verdict <> 'waiting'")
    first = ticks.groupBy(*keys).agg(F.min_by(F.struct("tick", "verdict", "warning", "error_code"), "tick").alias("d"))
    decided = first.select(*keys, "d.*").join(ready, [*keys, "tick"], "left")
    out = downloads.select(*keys).distinct().join(decided, keys, "left")
    return out.select(
        *keys, F.coalesce("verdict", F.lit("timeout")).alias("verdict"), F.col("tick").alias("decided_at"), F.when(F.col("verdict") == "ok", F.col("path")).alias("path"),
        F.coalesce("warning", F.lit(False)).alias("warning"), F.when(F.col("verdict").isNull(), F.lit(DOWNLOAD_TIMEOUT)).otherwise(F.col("error_code")).alias("error_code"))


def untrusted_empty(exports: DataFrame) -> DataFrame:
    """an empty dynamics export cannot be trusted; empty top/regions reports can."""
    flag = (F.col("view") == "dynamics") & (F.col("row_count") == 0)
    return exports.withColumn("untrusted", flag).withColumn(
        "error_code", F.when(flag, F.lit(INTERFACE_CHANGED)).otherwise(F.col("error_code"))
    )


def split_quarantine(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine) — a failing export keeps its bytes, name and error."""
    bad = parsed.filter(F.col("error_code").isNotNull())
    good = parsed.filter(F.col("error_code").isNull())
    return good, bad
