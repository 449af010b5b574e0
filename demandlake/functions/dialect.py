"""Delimiter election (S4) as expressions over an export's text.

Rule, per export:
* fewer than two lines -> header rule: tab if the header has more tabs than
  semicolons, else ';'.
* otherwise sniff the first 4096 characters restricted to ';' ',' tab:
  1. quote rule: a quoted field next to a candidate elects the most frequent
     such candidate (and fixes the quote character);
  2. consistency rule: over the non-empty LF lines, in chunks of 10, a
     candidate's per-line count has a mode m and score (n_mode - n_other)/n;
     the first chunk where some candidate has m > 0 and score at a threshold
     level (1.0 down to 0.91) elects, ties broken ',' then tab then ';';
  3. nothing elected -> header rule.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from demandlake.constants import (
    PREFERRED_DELIMITERS,
    SNIFF_CHUNK_LINES,
    SNIFF_DELIMITERS,
    SNIFF_SAMPLE_CHARS,
    sniff_consistency_levels,
)
from demandlake.functions.hof import let

LEVELS = sniff_consistency_levels()

# Quote-adjacency patterns, tried in order; the first with any match decides.
# (pattern, delim group, quote group, space group); group 0 = no such group.
_Q = r"""["']"""
_NOT_WORD = r"""[^\w\n"']"""
QUOTE_PATTERNS = (
    (rf"(?smdU)({_NOT_WORD})( ?)({_Q}).*?\3\1", 1, 3, 2),
    (rf"(?smdU)(?:^|\n)({_Q}).*?\1({_NOT_WORD})( ?)", 2, 1, 3),
    (rf"(?smdU)({_NOT_WORD})( ?)({_Q}).*?\3(?:$|\n)", 1, 3, 2),
    (rf"(?smdU)(?:^|\n)({_Q}).*?\1(?:$|\n)", 0, 1, 0),
)


def count_char(s: Column, ch: str) -> Column:
    return F.length(s) - F.length(F.replace(s, F.lit(ch), F.lit("")))


def header_rule(header_line: Column) -> Column:
    return F.when(count_char(header_line, "\t") > count_char(header_line, ";"), F.lit("\t")).otherwise(F.lit(";"))


def _first_max(items: Column, candidates: tuple[str, ...]) -> Column:
    """Most frequent candidate in ``items``; ties -> earliest first occurrence."""

    def pick(its):
        stats = F.transform(
            F.array(*[F.lit(c) for c in candidates]),
            lambda c: F.struct(
                F.size(F.filter(its, lambda x: x == c)).alias("n"),
                (-F.array_position(its, c)).alias("neg_first"),
                c.alias("c"),
            ),
        )
        best = F.array_max(stats)
        return F.when(best["n"] > 0, best["c"])

    return let(items, pick)


def quote_guess(sample: Column) -> Column:
    """STRUCT<delim, quote, skipinitialspace> from quoted fields in the sample
    (delim/quote null if none).  skipinitialspace: the elected delimiter's
    match count equals the number of matches with a space after it."""
    out = F.struct(F.lit(None).cast("string").alias("delim"), F.lit(None).cast("string").alias("quote"),
                   F.lit(False).alias("skipinitialspace"))
    empty = F.array().cast("array<string>")
    for pattern, d_group, q_group, s_group in reversed(QUOTE_PATTERNS):
        quotes = F.regexp_extract_all(sample, F.lit(pattern), F.lit(q_group))
        delims = F.regexp_extract_all(sample, F.lit(pattern), F.lit(d_group)) if d_group else empty
        spaces = F.regexp_extract_all(sample, F.lit(pattern), F.lit(s_group)) if s_group else empty
        out = _pattern_step(quotes, delims, spaces, out)
    return F.when(sample.rlike(_Q), out)


def _pattern_step(quotes: Column, delims: Column, spaces: Column, fallback: Column) -> Column:
    def body(qs):
        def with_delim(ds, d):
            n_d = F.size(F.filter(ds, lambda x: x == d))
            n_sp = F.size(F.filter(spaces, lambda x: x != ""))
            return F.struct(d.alias("delim"), _first_max(qs, ('"', "'")).alias("quote"),
                            F.coalesce(n_d == n_sp, F.lit(False)).alias("skipinitialspace"))

        found = let(delims, lambda ds: let(_first_max(ds, SNIFF_DELIMITERS), lambda d: with_delim(ds, d)))
        return F.when(F.size(qs) > 0, found).otherwise(fallback)

    return let(quotes, body)


def _chunk_level(counts: Column, t: Column) -> Column:
    """Threshold level reached by one candidate over the first t lines (null = none)."""
    levels = F.array(*[F.lit(x) for x in LEVELS])

    def with_arr(arr):
        def with_distinct(distinct):
            freqs = F.transform(distinct, lambda v: F.size(F.filter(arr, lambda x: x == v)))

            def with_freqs(fr):
                top = F.array_max(fr)
                single = F.size(distinct) == 1
                mode_value = F.when(single, F.get(distinct, 0)).otherwise(
                    F.get(distinct, F.array_position(fr, top).cast("int") - 1)
                )
                adjusted = F.when(single, t).otherwise(top * 2 - t)

                def finish(adj):
                    ratio = adj.cast("double") / t.cast("double")
                    level = F.size(F.filter(levels, lambda x: x > ratio))
                    return F.when((mode_value > 0) & (adj > 0) & (level < len(LEVELS)), level)

                return let(adjusted, finish)

            return let(freqs, with_freqs)

        return let(F.array_distinct(arr), with_distinct)

    return let(F.slice(counts, 1, t), with_arr)


def consistency_guess(sample: Column) -> Column:
    """Delimiter elected by the chunked consistency rule, or null."""

    def with_data(data):
        n = F.size(data)
        counts = F.struct(*[F.transform(data, _counter(c)).alias(_name(c)) for c in SNIFF_DELIMITERS])

        def with_counts(cnt):
            chunks = F.sequence(F.lit(1), F.greatest(F.lit(1), F.ceil(n / SNIFF_CHUNK_LINES).cast("int")))

            def step(acc, i):
                t = F.least(i * SNIFF_CHUNK_LINES, n)
                lv = F.struct(*[_chunk_level(cnt[_name(c)], t).alias(_name(c)) for c in SNIFF_DELIMITERS])

                def decide(levels):
                    best = F.least(*[levels[_name(c)] for c in SNIFF_DELIMITERS])
                    pick = F.lit(None).cast("string")
                    for c in reversed(PREFERRED_DELIMITERS):
                        pick = F.when(levels[_name(c)] == best, F.lit(c)).otherwise(pick)
                    return F.struct(best.isNotNull().alias("done"), pick.alias("delim"))

                return F.when(acc["done"], acc).otherwise(let(lv, decide))

            init = F.struct(F.lit(False).alias("done"), F.lit(None).cast("string").alias("delim"))
            return F.aggregate(chunks, init, step, lambda acc: acc["delim"])

        return F.when(n > 0, let(counts, with_counts))

    return let(F.filter(F.split(sample, "\n", -1), lambda l: l != ""), with_data)


def _name(c: str) -> str:
    return {";": "semi", ",": "comma", "\t": "tab"}[c]


def _counter(c: str):
    return lambda l: count_char(l, c)


def sample_of(text: Column) -> Column:
    return F.substring(text, 1, SNIFF_SAMPLE_CHARS)


def doublequote_seen(sample: Column, quote: Column) -> Column:
    """Whether the sample shows a doubled quote between delimiters (the
    sniffer's doubled-quote test), using the quote rule's delimiter ('' when
    it found none) and quote character."""
    d = F.coalesce(quote["delim"], F.lit(""))
    q = F.coalesce(quote["quote"], F.lit('"'))
    cls = F.concat(F.lit("[^"), d, F.lit("\\n]*"))
    pattern = F.concat(F.lit("(?mdU)(("), d, F.lit(")|^)\\W*"), q, cls, q, cls, q, F.lit("\\W*(("), d, F.lit(")|$)"))
    return F.regexp(sample, pattern)


def consistency_skipinitialspace(sample: Column, delim: Column) -> Column:
    """The consistency rule's flag: on the first non-empty line, every
    delimiter is followed by a space (also true when it has none)."""
    first = F.coalesce(F.get(F.filter(F.split(sample, "\n", -1), lambda l: l != ""), 0), F.lit(""))
    n = F.length(first) - F.length(F.replace(first, delim, F.lit("")))
    with_space = F.concat(delim, F.lit(" "))
    n_sp = (F.length(first) - F.length(F.replace(first, with_space, F.lit("")))) / F.lit(2)
    return n.cast("double") == n_sp


def combine_dialect(n_lines: Column, header_line: Column, quote: Column, consistency: Column,
                    dq_seen: Column | None = None, sample: Column | None = None) -> Column:
    """STRUCT<delimiter, quotechar, method, doublequote> from the rules' outcomes.

    A sniffed dialect keeps doubled quotes only if the quote rule matched and
    the sample shows a doubled quote; the fallback dialect always does."""
    few = n_lines < 2
    q_delim = quote["delim"]
    delim = (
        F.when(few, header_rule(header_line))
        .when(q_delim.isNotNull(), q_delim)
        .when(consistency.isNotNull(), consistency)
        .otherwise(header_rule(header_line))
    )
    method = (
        F.when(few, F.lit("header"))
        .when(q_delim.isNotNull(), F.lit("quotes"))
        .when(consistency.isNotNull(), F.lit("consistency"))
        .otherwise(F.lit("header"))
    )
    sniffed = ~few & (q_delim.isNotNull() | consistency.isNotNull())
    qchar = F.when(sniffed, F.coalesce(quote["quote"], F.lit('"'))).otherwise(F.lit('"'))
    seen = F.lit(True) if dq_seen is None else dq_seen
    dq = F.when(sniffed, quote["quote"].isNotNull() & F.coalesce(seen, F.lit(False))).otherwise(F.lit(True))
    if sample is None:
        sis = F.lit(False)
    else:
        sis = (F.when(~sniffed, F.lit(False)).when(q_delim.isNotNull(), quote["skipinitialspace"])
               .otherwise(consistency_skipinitialspace(sample, consistency)))
    return F.struct(delim.alias("delimiter"), qchar.alias("quotechar"), method.alias("method"),
                    dq.alias("doublequote"), sis.alias("skipinitialspace"))
