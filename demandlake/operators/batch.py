"""Batch outcomes from recorded logs.

``requests(batch_id, phrase_ord, run_id)`` is what was asked for, ``attempts(run_id,
view, fail_code, fail_message)`` what was tried (fail_code null: it was stored), and
``stored(run_id, view)`` what the run's manifest held before.  What was never tried
has no row in the log: each run is expanded to its four views.
Everything keys on the run, so a batch that holds a third of all phrases spreads
over as many tasks as any other rows; batches meet in partial sums only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandlake.constants import AUTH_REQUIRED, ERROR_TYPES, NOT_ATTEMPTED_PREFIX, NOT_COLLECTED, VIEWS
from demandlake.functions.hof import let


def error_type_name(code: Column) -> Column:
    expr = F.lit(None).cast("string")
    for c, name in ERROR_TYPES.items():
        expr = F.when(code == c, F.lit(name)).otherwise(expr)
    return expr


def error_text(code: Column, message: Column) -> Column:
    """P13: '<Type>: <message>'."""
    return F.concat_ws(": ", error_type_name(code), message)


def _run_views(requests: DataFrame, attempts: DataFrame, stored: DataFrame, messages: bool) -> DataFrame:
    """(batch_id, phrase_ord, run_id, views): the four views of each requested run with their outcome.

    The three logs meet in one grouping by run, which keeps three values for each
    of the four views; ``messages`` False leaves the texts of errors out of it.
    """
    none = F.lit(None)
    text = none.cast("string")
    asked = requests.select("run_id", F.struct("batch_id", "phrase_ord").alias("r"), text.alias("view"), none.cast("boolean").alias("done"), none.cast("boolean").alias("held"),
                            F.struct(text.alias("code"), text.alias("message")).alias("err"))
    message = F.col("fail_message") if messages else text
    tried = attempts.select("run_id", none.cast(asked.schema["r"].dataType).alias("r"), "view", F.col("fail_code").isNull().alias("done"), none.cast("boolean").alias("held"),
                            F.struct(F.col("fail_code").alias("code"), message.alias("message")).alias("err"))
    before = stored.select("run_id", none.cast(asked.schema["r"].dataType).alias("r"), "view", none.cast("boolean").alias("done"), F.lit(True).alias("held"),
                           F.struct(text.alias("code"), text.alias("message")).alias("err"))
    of = lambda v, value: F.when(F.col("view") == v, value)
    per = asked.unionByName(tried).unionByName(before).groupBy("run_id").agg(
        F.max("r").alias("r"), F.count("done").alias("n_tried"),
        *[F.struct(F.max(of(v, F.col("done"))).alias("done"), F.max(of(v, F.col("held"))).alias("held"),
                   F.min(F.when((F.col("view") == v) & ~F.col("done"), F.col("err"))).alias("err")).alias(v) for v in VIEWS],
    ).filter(F.col("r").isNotNull())
    states = F.array(*[F.struct(F.lit(i).alias("view_ord"), F.lit(v).alias("view"), F.col(v).alias("s")) for i, v in enumerate(VIEWS)])
    broke = F.array_min(F.transform(states, lambda x: F.when(~x["s"]["done"], F.struct(x["view_ord"], x["view"], x["s"]["err"]["code"]))))

    def judged(x):
        s = x["s"]
        outcome = (
            F.when(s["done"], F.lit("stored"))
            .when(~s["done"] & (s["err"]["code"] == AUTH_REQUIRED), F.lit("auth_failed"))
            .when(~s["done"], F.lit("failed"))
            .when(s["held"], F.lit("kept"))
            .when(F.col("broke.code") == AUTH_REQUIRED, F.lit("missing"))
            .when(F.col("broke.view_ord") < x["view_ord"], F.lit("not_attempted"))
            .when(F.col("n_tried") == 0, F.lit("skipped"))
            .otherwise(F.lit("missing"))
        )

        def told(o):
            reason = (
                F.when(o == "not_attempted", F.concat(F.lit(NOT_ATTEMPTED_PREFIX), F.col("broke.view")))
                .when(o == "failed", error_text(s["err"]["code"], s["err"]["message"]))
            )
            return F.struct(x["view_ord"].alias("view_ord"), x["view"].alias("view"), o.alias("outcome"), reason.alias("view_error"), F.when(~s["done"], s["err"]["code"]).alias("fail_code"))

        return let(outcome, told)

    wide = per.select("r.*", "run_id", "n_tried", broke.alias("broke"), states.alias("states"))
    return wide.select("batch_id", "phrase_ord", "run_id", F.transform("states", judged).alias("views"))


def view_outcomes(requests: DataFrame, attempts: DataFrame, stored: DataFrame) -> DataFrame:
    """One row for each requested run and view.

    outcome: ``stored`` (now), ``kept`` (from before), ``failed``, ``auth_failed``,
    ``not_attempted`` (an earlier view of the run failed), ``skipped`` (the run
    was never begun) or ``missing``.  A view tried twice counts by its success, or
    its first error.  ``view_error`` is the reason of failed and not attempted ones.
    """
    return _run_views(requests, attempts, stored, True).select("batch_id", "phrase_ord", "run_id", F.inline("views"))


def run_outcomes(requests: DataFrame, attempts: DataFrame, stored: DataFrame) -> DataFrame:
    """A7 from the logs: ``phrase_outcome`` of ``view_outcomes``, judged inside each run's
    row, so that the logs are shuffled once and no error text is."""
    of = lambda *names: F.exists("views", lambda v: v["outcome"].isin(*names))
    failed = F.array_min(F.transform(F.filter("views", lambda v: v["outcome"] == "failed"), lambda v: F.struct(v["view_ord"], v["fail_code"])))
    facts = _run_views(requests, attempts, stored, False).select(
        "batch_id", "phrase_ord", "run_id", of(*_STORED).alias("any_stored"), of("skipped").alias("skipped"), of("auth_failed").alias("auth_failed"),
        failed["fail_code"].alias("fail_code"), F.size(F.filter("views", lambda v: ~v["outcome"].isin(*_STORED))).cast("long").alias("n_incomplete"))
    return _told_outcome(facts)


_STORED = ("stored", "kept")


def _run_facts() -> list[Column]:
    """Aggregates over the views of a run that its outcome follows from."""
    o = F.col("outcome")
    return [
        F.bool_or(o.isin(*_STORED)).alias("any_stored"),
        F.bool_or(o == "skipped").alias("skipped"),
        F.bool_or(o == "auth_failed").alias("auth_failed"),
        F.min_by("fail_code", F.when(o == "failed", F.col("view_ord"))).alias("fail_code"),
        F.count_if(~o.isin(*_STORED)).alias("n_incomplete"),
    ]


def _run_outcome() -> Column:
    return (
        F.when(F.col("auth_failed"), F.lit("failure"))
        .when(F.col("skipped"), F.lit("skipped"))
        .when(F.col("any_stored") | F.col("fail_code").isNull(), F.lit("result"))
        .otherwise(F.lit("failure"))
    )


def phrase_outcome(views: DataFrame) -> DataFrame:
    """One row per run: 'result' if anything is stored, now or from before,
    'failure' with its error if not (or if its login was lost), 'skipped' if it
    was never begun.  A begun run that holds nothing and failed nowhere is a result."""
    return _told_outcome(views.groupBy("batch_id", "phrase_ord", "run_id").agg(*_run_facts()))


def _told_outcome(facts: DataFrame) -> DataFrame:
    code = F.when(F.col("auth_failed"), F.lit(AUTH_REQUIRED)).when(F.col("outcome") == "failure", F.col("fail_code"))
    return (
        facts.withColumn("outcome", _run_outcome())
        .withColumn("error_code", code)
        .withColumn("partial", (F.col("outcome") == "result") & (F.col("n_incomplete") > 0))
        .select("batch_id", "phrase_ord", "run_id", "outcome", "error_code", "partial", "n_incomplete")
    )


def batch_summary(outcomes: DataFrame) -> DataFrame:
    """Total, collected, failed, partial, skipped and the exit code per batch."""
    return (
        outcomes.groupBy("batch_id").agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if(F.col("outcome") == "result").alias("collected"),
            F.count_if(F.col("outcome") == "failure").alias("failed"),
            F.count_if(F.col("partial")).alias("partial"),
        )
        .withColumn("skipped", F.col("total") - F.col("collected") - F.col("failed"))
        .withColumn("exit_code", F.when(F.col("failed") > 0, F.lit(1)).otherwise(F.lit(0)))
    )


def incomplete_report(views: DataFrame, warnings: DataFrame | None = None) -> DataFrame:
    """J6 + U3 + O3: (batch_id, phrase_ord, run_id, line_ord, view, path, reason) of
    every view that a result lacks, with its reason or the default text, and of
    every warning (``warnings(run_id, path)``: files that landed elsewhere).

    ``line_ord`` is the line's place inside its run: views by name, then warnings
    by path.  Order by batch_id, phrase_ord, line_ord to print.  One grouping by
    run gives its outcome and its views' lines, four at most; warnings are numbered
    as rows, so a run may have any number of stray files.
    """
    line = F.struct(F.col("view").alias("view"), F.coalesce("view_error", F.lit(NOT_COLLECTED)).alias("reason"))
    per = views.groupBy("run_id").agg(F.max(F.struct("batch_id", "phrase_ord")).alias("r"), *_run_facts(),
                                      F.array_sort(F.collect_list(F.when(~F.col("outcome").isin(*_STORED), line))).alias("lines"))
    results = per.filter(_run_outcome() == "result").select("r.*", "run_id", "lines")
    none = F.lit(None).cast("string")
    told = results.select("batch_id", "phrase_ord", "run_id", F.posexplode("lines").alias("line_ord", "x"))
    told = told.select("batch_id", "phrase_ord", "run_id", "line_ord", "x.view", none.alias("path"), "x.reason")
    if warnings is None:
        return told
    place = F.size("lines") + F.row_number().over(Window.partitionBy("run_id").orderBy("path")) - 1
    stray = warnings.select("run_id", "path").join(results, "run_id").select(
        "batch_id", "phrase_ord", "run_id", place.alias("line_ord"), none.alias("view"), "path", F.lit("a file landed outside the run's folders").alias("reason"))
    return told.unionByName(stray)
