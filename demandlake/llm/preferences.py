"""Operator 7: preference formatting of chosen and rejected conversations.

The longest common prefix of turns is rendered once as the prompt; what follows on
either side is a completion with the character spans to train on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlake.functions.hof import let

#: A turn is rendered as OPEN role CLOSE text END.
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
TRAINED_ROLE = "assistant"


def _render(t: Column) -> Column:
    return F.concat(F.lit(OPEN), t.role, F.lit(CLOSE), t.text, F.lit(END))


def _text(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _render), "")


def _mask(turns: Column) -> Column:
    """Spans (start, end) of the trained turns' texts with their END, in characters of the completion."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        end = acc.at + F.char_length(_render(t))
        span = F.struct((acc.at + F.lit(len(OPEN + CLOSE)) + F.char_length(t.role)).alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(t.role == TRAINED_ROLE, F.concat(acc.spans, F.array(span))).otherwise(acc.spans).alias("spans"))

    return F.aggregate(turns, start, step, lambda acc: acc.spans)


def preference_pairs(turns: DataFrame) -> DataFrame:
    """One row for each pair, from ``turns`` (pair_id, chosen boolean, turn, role, text).

    Returns pair_id, n_chosen, n_rejected, n_common (turns), prompt, chosen,
    rejected (rendered completions), chosen_mask and rejected_mask (arrays of
    start, end).  Turns go by ``turn``, equal numbers by role and text; two turns
    are common if role and text are equal.  Null roles and texts count as empty,
    a null turn number comes first.  A side without turns has an empty
    completion; equal sides have two.  Repeated rows are repeated turns.  Rows
    without pair_id or side belong to no pair and don't appear.  Empty table: no
    rows.  A pair's turns meet in one row, as they do in the example it becomes.
    """
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    sided = turns.where(F.col("pair_id").isNotNull() & F.col("chosen").isNotNull()).select("pair_id", F.col("chosen").alias("side"), turn.alias("t"))
    both = sided.groupBy("pair_id").agg(*[F.sort_array(F.collect_list(F.when(F.col("side") == s, F.col("t")))).alias(n) for s, n in ((True, "c"), (False, "r"))])

    def common(sides: Column) -> Column:
        c, r = F.get(sides, 0), F.get(sides, 1)
        same = F.zip_with(F.slice(c, F.lit(1), F.least(F.size(c), F.size(r))), F.slice(r, F.lit(1), F.least(F.size(c), F.size(r))), lambda x, y: (x.role == y.role) & (x.text == y.text))
        return let(same, lambda s: F.when(F.array_contains(s, F.lit(False)), F.array_position(s, F.lit(False)) - 1).otherwise(F.size(s)))

    both = both.withColumn("n_common", let(F.array("c", "r"), common).cast("int"))
    rest = {s: F.slice(s, F.col("n_common") + 1, F.greatest(F.size(s) - F.col("n_common"), F.lit(0))) for s in ("c", "r")}
    return both.select(
        "pair_id", F.size("c").alias("n_chosen"), F.size("r").alias("n_rejected"), "n_common",
        _text(F.slice("c", F.lit(1), F.col("n_common"))).alias("prompt"),
        _text(rest["c"]).alias("chosen"), _text(rest["r"]).alias("rejected"),
        _mask(rest["c"]).alias("chosen_mask"), _mask(rest["r"]).alias("rejected_mask"),
    )


def mask_text(mask: Column) -> Column:
    """A mask as text: 'start:end' of each span, joined by commas."""
    return F.array_join(F.transform(mask, lambda s: F.concat(s.start.cast("string"), F.lit(":"), s.end.cast("string"))), ",")
