"""Records and fields (S5, S6, F1, P14) as expressions over an export's lines.

Lines are split before CSV parsing, so a quoted field that spans a line
break continues on the next line with the break dropped (``a;"b`` + ``c"``
gives ``bc``).  Fields honour quotes only at the start of a field, doubled
quotes inside, and keep any text after the closing quote.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from demandlake.functions.hof import let
from demandlake.functions.text import strip


def _pat(*parts) -> Column:
    """A regex assembled from literal pieces and the row's dialect characters.

    The delimiters (';', ',', tab) and quote characters are not special in
    Java regex, so they are spliced in as they are; Spark compiles a
    non-literal pattern once and reuses it while it does not change."""
    return F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])


def _inner(q: Column, dq: Column) -> Column:
    """Body of a quoted part: doubled quotes allowed only with doublequote.

    Possessive throughout: what follows a body never needs a character back, and a
    possessive loop runs without recursion and without trying again, so a cell of
    any length takes linear time and no stack."""
    plain = F.concat(F.lit("[^"), q, F.lit("]*+"))
    return F.when(dq, F.concat(plain, F.lit("(?:"), q, q, plain, F.lit(")*+"))).otherwise(plain)


def _close(q: Column, dq: Column) -> Column:
    """A closing quote; with doubled quotes on, never the first of a pair."""
    return F.when(dq, F.concat(q, F.lit("(?!"), q, F.lit(")"))).otherwise(q)


def _sp(sis: Column) -> Column:
    """Spaces skipped after a delimiter when the dialect says so."""
    return F.when(sis, F.lit(" *")).otherwise(F.lit(""))


def _marks(d: Column, q: Column, dq: Column, sis: Column) -> Column:
    """What the lines of one dialect are looked through for, put together once for all of them."""
    return F.struct(
        _pat("(?s)", d, _sp(sis), q, _inner(q, dq), _close(q, dq)).alias("part"), F.concat(d, F.lit("\u0000")).alias("blank"),
        F.concat(d, q).alias("start"), _pat(d, " *", q).alias("spaced"), F.concat(q, q).alias("pair"))


def _is_open(record: Column, d: Column, sis: Column, marks: Column) -> Column:
    """True when the record ends inside an unterminated quoted field.

    Closed quoted parts are blanked out (a NUL stand-in keeps a literal tail
    from looking like a new field start); what remains opens a quote only if
    a field still starts with one."""
    closed = F.regexp_replace(F.concat(d, record), marks["part"], marks["blank"])
    return let(closed, lambda c: F.when(sis, F.regexp(c, marks["spaced"])).otherwise(F.contains(c, marks["start"])))


def line_effect(line: Column, d: Column, q: Column, dq: Column, sis: Column, marks: Column | None = None) -> Column:
    """What a line does to the state 'inside quotes' (0 or 1): it sets it ('0', '1'),
    keeps it ('k') or swaps it ('s').  A line that begins inside reads as if it
    started with the quote.  Effects compose associatively.

    Quotes that come in pairs only, none at the start of a field, are text outside
    and doubled quotes inside: such a line keeps the state, and needs no pattern."""
    if marks is None:
        return let(_marks(d, q, dq, sis), lambda m: line_effect(line, d, q, dq, sis, m))
    ends = F.struct(_is_open(line, d, sis, marks).alias("fresh"), _is_open(F.concat(q, line), d, sis, marks).alias("inside"))
    effect = let(ends, lambda e: F.when(e["fresh"] & e["inside"], "1").when(e["fresh"], "s").when(e["inside"], "k").otherwise("0"))
    paired = dq & ~sis & ~F.startswith(line, q) & ~F.contains(line, marks["start"]) & ~F.contains(F.replace(line, marks["pair"], F.lit("")), q)
    return F.when(~F.contains(line, q) | paired, "k").otherwise(effect)


def _join_records(lines: Column, d: Column, q: Column, dq: Column, sis: Column) -> Column:
    """Records of lines that may break inside quotes, in time linear in the lines.

    The effects of the lines (see ``line_effect``), one character each, give the
    states at all ends in one pass, and each run of lines is joined once.
    """
    effect = let(_marks(d, q, dq, sis), lambda m: F.transform(lines, lambda x: line_effect(x, d, q, dq, sis, m)))

    def runs(after):
        starts = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: (i == 0) | (F.get(after, i - 1) == "0"))
        part = lambda ss: F.transform(ss, lambda s, k: F.array_join(F.slice(lines, s + 1, F.coalesce(F.get(ss, k + 1), F.size(lines)) - s), ""))
        return let(starts, part)

    # The lines after a set state keep it up to a swap, then its opposite up to the next: no state is carried line by line.
    def states(segment):
        swapped = F.split(F.substring(segment, F.lit(2), F.length(segment)), "s", -1)
        first = F.substring(segment, 1, 1)
        return F.array_join(F.transform(swapped, lambda kept, i: F.repeat(F.when((i % 2 == 0) == (first == "0"), "0").otherwise("1"), F.length(kept) + 1)), "")

    segments = F.regexp_extract_all(F.concat(F.lit("0"), F.array_join(effect, "")), F.lit("[01][ks]*+"), F.lit(0))
    # One character a line: its state at the end (after the one that stands for the start).
    after = F.array_join(F.transform(segments, states), "")
    return let(F.split(F.substring(after, F.lit(2), F.length(after)), ""), runs)


def _field_patterns(d: Column, q: Column, dq: Column, sis: Column) -> Column:
    """The patterns of a field after its delimiter and of its quoted part, put together once for all records."""
    return F.struct(
        _pat("(?s)", d, _sp(sis), "(", q, _inner(q, dq), "(?:", _close(q, dq), "|\\z)[^", d, "]*|[^", d, "]*)").alias("field"),
        _pat("(?s)^", q, "(", _inner(q, dq), ")(?:", q, "(.*))?\\z").alias("quoted"))


def _unquote(field: Column, q: Column, dq: Column, pattern: Column) -> Column:
    parts = F.regexp_extract_all(field, pattern, F.lit(1))
    tails = F.regexp_extract_all(field, pattern, F.lit(2))
    inner = F.when(dq, F.replace(F.get(parts, 0), F.concat(q, q), q)).otherwise(F.get(parts, 0))
    return F.when(F.startswith(field, q), F.concat(inner, F.coalesce(F.get(tails, 0), F.lit("")))).otherwise(field)


def _split_plain(record: Column, d: Column) -> Column:
    return (F.when(d == ";", F.split(record, ";", -1)).when(d == ",", F.split(record, ",", -1))
            .otherwise(F.split(record, "\t", -1)))


def record_fields(record: Column, d: Column, q: Column, dq: Column, sis: Column, patterns: Column | None = None) -> Column:
    if patterns is None:
        return let(_field_patterns(d, q, dq, sis), lambda p: record_fields(record, d, q, dq, sis, p))
    quoted = F.transform(F.regexp_extract_all(F.concat(d, record), patterns["field"], F.lit(1)), lambda f: _unquote(f, q, dq, patterns["quoted"]))
    return (
        F.when(record == "", F.array().cast("array<string>"))
        .when(~F.contains(record, q), _split_plain(record, d))
        .otherwise(quoted)
    )


def parse_fields(lines: Column, delimiter: Column, quotechar: Column, doublequote: Column | None = None,
                 skipinitialspace: Column | None = None) -> Column:
    """ARRAY<ARRAY<STRING>>: raw fields of every record (header first)."""
    dq = F.lit(True) if doublequote is None else doublequote
    sis = F.lit(False) if skipinitialspace is None else skipinitialspace

    def body(ls):
        records = F.when(F.exists(ls, lambda l: F.contains(l, quotechar)),
                         _join_records(ls, delimiter, quotechar, dq, sis)).otherwise(ls)
        return let(_field_patterns(delimiter, quotechar, dq, sis),
                   lambda p: F.transform(records, lambda r: record_fields(r, delimiter, quotechar, dq, sis, p)))

    return let(lines, body)


def header_error(raw_header: Column, headers: Column) -> Column:
    """First failing header rule as a reason key (null when valid).
    ``headers`` is ``raw_header`` with every name stripped."""
    return (
        F.when(raw_header.isNull() | (F.size(raw_header) == 0), F.lit("no_header"))
        .when(F.exists(headers, lambda h: h == ""), F.lit("empty_header"))
        .when(F.exists(headers, lambda h: h.rlike(r"[;\t]")), F.lit("unparsed_delimiter"))
        .when(F.size(F.array_distinct(headers)) < F.size(headers), F.lit("duplicate_header"))
    )


def normalise_record(fields: Column, width: Column) -> Column:
    """S6 + P14: one record's trimmed cells, as many as the header has; short ones are filled with ''."""
    cols = F.sequence(F.lit(0), F.greatest(width - 1, F.lit(0)))
    return F.transform(cols, lambda i: F.coalesce(strip(F.get(fields, i)), F.lit("")))


def is_filled(cells: Column) -> Column:
    """some cell isn't blank."""
    return F.exists(cells, lambda c: c != "")


def normalise_rows(records: Column, width: Column) -> Column:
    """S6 + P14 + F1: data records mapped to the header width, trimmed,
    short rows filled with '', surplus fields dropped, blank rows removed."""
    data = F.filter(F.slice(records, 2, F.greatest(F.size(records) - 1, F.lit(1))), lambda f: F.size(f) > 0)
    data = F.when(F.size(records) > 1, data).otherwise(F.array().cast("array<array<string>>"))
    return F.filter(F.transform(data, lambda f: normalise_record(f, width)), is_filled)
