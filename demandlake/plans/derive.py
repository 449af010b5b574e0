"""Derive export-shaped inputs from the given tables, as Spark jobs.

Every derived export is bounded by construction (a block of consecutive
keys, or one series window), so no group grows with a hot key.  The rules
here are mirrored in the DuckDB oracle SQL; keep both in step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandlake.constants import MONTHS_NOMINATIVE
from demandlake.functions.dates import week_monday
from demandlake.functions.text import CP1251_LATIN, CP1251_REAL, encode_text
from demandlake.operators.manifest import dataset_file
from demandlake.session import dealt, spread
from demandlake.sources.small_files import mounted, write_lines

NBSP, NNBSP, THIN, FIGURE = "\u00a0", "\u202f", "\u2009", "\u2007"

# --- fixed values: transliteration used to make cp1251-encodable texts -------
LATIN = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
CYRILLIC = "абцдефгхийклмнопярстувшхызАБЦДЕФГХИЙКЛМНОПЯРСТУВШХЫЗ"

SUPPLIER_BLOCK = 16
SUPPLIER_SNIFF_ROWS = 9      # irregular rows only after the first sniff chunk
PART_BLOCK = 50
ORDER_BLOCK = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given (read-only) table, listed anew each time."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def grouped_thousands(n: Column, sep: Column | str) -> Column:
    """Integer with a thousands separator ('5 228 679')."""
    sep_c = F.lit(sep) if isinstance(sep, str) else sep
    return F.replace(F.format_number(n, 0), F.lit(","), sep_c)


def _sep_choice(i: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in (" ", NBSP, NNBSP, THIN, FIGURE)]), (F.pmod(i, F.lit(5)) + 1).cast("int"))


# ----------------------------------------------------------------- numbers
def localized_amounts(orders: DataFrame) -> DataFrame:
    """orders -> (o_orderkey, text): o_totalprice as localized text, with a
    variant per ``o_orderkey % 10`` (empty, n/a, percent, dotted, integer,
    negative, exponent-like, padded, narrow/figure separators) and
    int64-overflow / float64-inexact integers."""
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    ip = F.expr("cast(round(o_totalprice * 100) as bigint) div 100")
    frac2 = F.lpad((cents % 100).cast("string"), 2, "0")
    v = F.col("o_orderkey") % 10
    amount = lambda sep: F.concat(grouped_thousands(ip, sep), F.lit(","), frac2)
    text = (
        F.when(v == 0, F.lit(""))
        .when(v == 1, F.lit("н/д"))
        .when(v == 2, F.concat(amount(NBSP), F.lit("%")))
        .when(v == 3, F.concat(ip.cast("string"), F.lit("."), frac2))
        .when(v == 4, grouped_thousands(ip, NBSP))
        .when(v == 5, F.concat(F.lit("-"), grouped_thousands(ip, " ")))
        .when(v == 6, F.concat(ip.cast("string"), F.lit("000000000000000")))
        .when(v == 7, F.concat(F.lit("  "), amount(THIN), F.lit(NBSP)))
        .when(v == 8, amount(NNBSP))
        .otherwise(amount(FIGURE))
    )
    return orders.select("o_orderkey", text.alias("text"))


# ------------------------------------------------------------ column typing (A1)
def part_exports(part: DataFrame) -> DataFrame:
    """part -> one ';' export per block of 50 consecutive keys.

    Columns: Артикул (int), Название (text), Размер (int with blanks, 'н/д'
    every 97th key), Цена (comma decimals, integral prices unpadded),
    Скидка (percent text), Примечание (always blank)."""
    cents = F.round(F.col("p_retailprice") * 100).cast("bigint")
    price = F.when(cents % 100 == 0, (F.expr("cast(round(p_retailprice * 100) as bigint) div 100")).cast("string")).otherwise(
        F.concat(F.expr("cast(round(p_retailprice * 100) as bigint) div 100").cast("string"), F.lit(","),
                 F.lpad((cents % 100).cast("string"), 2, "0"))
    )
    size = (
        F.when(F.col("p_partkey") % 97 == 0, F.lit("н/д"))
        .when(F.col("p_partkey") % 9 == 0, F.lit(""))
        .otherwise(F.col("p_size").cast("string"))
    )
    discount = F.concat(F.col("p_size").cast("string"), F.lit(",5%"))
    line = F.concat_ws(";", F.col("p_partkey").cast("string"), F.col("p_name"), size, price, discount, F.lit(""))
    block = F.expr(f"p_partkey div {PART_BLOCK}")
    rows = part.select(block.alias("block"), F.col("p_partkey").alias("k"), line.alias("line"))
    grouped = rows.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("k", "line"))).alias("lines"))
    header = "Артикул;Название;Размер;Цена;Скидка;Примечание"
    text = F.concat(F.lit(header + "\n"), F.array_join(F.transform("lines", lambda s: s["line"]), "\n"), F.lit("\n"))
    return grouped.select(
        F.concat(F.lit("part-"), F.col("block").cast("string")).alias("export_id"),
        F.concat(F.lit("part-"), F.col("block").cast("string"), F.lit(".csv")).alias("file_name"),
        encode_text(text, "utf-8-sig").alias("content"),
    )


# --------------------------------------------------------------- CSV dialects
def supplier_exports(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """supplier -> one export per block of 16 consecutive keys.

    Delimiter by ``block % 3`` (';', tab, ','); every fifth block has a bad
    header (duplicate, blank, or a ';' inside a tab header).  Names with
    ``key % 4 = 1`` are quoted with the delimiter and doubled quotes inside;
    ',' files quote the balance.  After the first 9 rows (outside the sniff
    chunk) rows may be short (key % 5 = 0), long (key % 7 = 0) or followed by
    a delimiter-only line and an empty line (key % 3 = 0)."""
    s = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey, "left")
    key = F.col("s_suppkey")
    block = F.expr(f"s_suppkey div {SUPPLIER_BLOCK}")
    pos = key - block * SUPPLIER_BLOCK
    hdr_kind = F.when(block % 5 == 4, F.expr("(s_suppkey div 16 div 5) % 3"))
    d = (F.when(hdr_kind == 2, F.lit("\t"))
         .when(block % 3 == 0, F.lit(";")).when(block % 3 == 1, F.lit("\t")).otherwise(F.lit(",")))
    cents = F.round(F.col("s_acctbal") * 100).cast("bigint")
    bal = F.concat(
        F.when(cents < 0, F.lit("-")).otherwise(F.lit("")),
        F.expr("abs(cast(round(s_acctbal * 100) as bigint)) div 100").cast("string"),
        F.lit(","),
        F.lpad(F.abs(cents % 100).cast("string"), 2, "0"),
    )
    bal_r = F.when(d == ",", F.concat(F.lit('"'), bal, F.lit('"'))).otherwise(bal)
    quoted = key % 4 == 1
    name_r = F.when(quoted, F.concat(F.lit('"'), F.col("s_name"), d, F.lit('""A"""'))).otherwise(F.col("s_name"))
    nat = F.coalesce(F.col("n_name"), F.lit(""))
    late = pos >= SUPPLIER_SNIFF_ROWS
    short = late & (key % 5 == 0)
    long_ = late & (key % 7 == 0) & ~short
    blank = late & (key % 3 == 0)
    row = (
        F.when(short, F.concat_ws("", name_r, d, bal_r))
        .when(long_, F.concat_ws("", name_r, d, bal_r, d, nat, d, d, F.lit("extra")))
        .otherwise(F.concat_ws("", name_r, d, bal_r, d, nat, d))
    )
    row = F.when(blank, F.concat(row, F.lit("\n"), d, d, d, F.lit("\n"))).otherwise(row)
    rows = s.select(block.alias("block"), key.alias("k"), d.alias("d"), hdr_kind.alias("hdr_kind"), row.alias("line"))
    grouped = rows.groupBy("block").agg(
        F.first("d").alias("d"),
        F.first("hdr_kind", ignorenulls=True).alias("hdr_kind"),
        F.array_sort(F.collect_list(F.struct("k", "line"))).alias("lines"),
    )
    names = (
        F.when(F.col("hdr_kind") == 0, F.array(*[F.lit(x) for x in ("Поставщик", "Баланс", "Поставщик", "Примечание")]))
        .when(F.col("hdr_kind") == 1, F.array(*[F.lit(x) for x in ("Поставщик", "Баланс", " ", "Примечание")]))
        .when(F.col("hdr_kind") == 2, F.array(*[F.lit(x) for x in ("Поставщик", "Баланс", "Страна;код", "Примечание")]))
        .otherwise(F.array(*[F.lit(x) for x in ("Поставщик", "Баланс", "Страна", "Примечание")]))
    )
    d = F.col("d")
    header = F.concat(F.get(names, 0), d, F.get(names, 1), d, F.get(names, 2), d, F.get(names, 3))
    text = F.concat(header, F.lit("\n"), F.array_join(F.transform("lines", lambda x: x["line"]), "\n"), F.lit("\n"))
    return grouped.select(
        F.concat(F.lit("supplier-"), F.col("block").cast("string")).alias("export_id"),
        F.concat(F.lit("supplier-"), F.col("block").cast("string"), F.lit(".csv")).alias("file_name"),
        encode_text(text, "utf-8").alias("content"),
    )


# ----------------------------------------------------------- decode / split
def cyrillized(text: Column) -> Column:
    """Documents made cp1251-encodable: non-ASCII -> '№', Latin -> Cyrillic."""
    return F.translate(F.regexp_replace(text, r"[^\x00-\x7f]", "№"), LATIN, CYRILLIC)


def document_exports(documents: DataFrame) -> DataFrame:
    """documents -> export bytes: encoding by ``(doc_id div 3) % 3`` (utf-8,
    utf-8 with BOM, cp1251), line ends by ``doc_id % 3`` (LF, CR, CRLF)."""
    t = cyrillized(F.col("text"))
    enc = F.element_at(F.array(F.lit("utf-8"), F.lit("utf-8-sig"), F.lit("cp1251")), (F.expr("(doc_id div 3) % 3") + 1).cast("int"))
    eol = F.element_at(F.array(F.lit("\n"), F.lit("\r"), F.lit("\r\n")), (F.pmod(F.col("doc_id"), F.lit(3)) + 1).cast("int"))
    body = F.replace(t, F.lit("\n"), eol)
    return spread(documents).select(
        "doc_id",
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".csv")).alias("file_name"),
        encode_text(body, enc).alias("content"),
    )


# ---------------------------------------------------------------- series
def daily_volumes(events: DataFrame) -> DataFrame:
    """(event_type, user_id, day, vol): the base that every series is rolled up from."""
    return events.groupBy("event_type", "user_id", F.to_date("ts").alias("day")).agg(
        F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("vol"))


def all_series_exports(events: DataFrame) -> DataFrame:
    """Daily (by type and by user), weekly and monthly exports of one base table.

    Each base row is expanded to the four series it belongs to (a fixed
    fan-out of already aggregated rows), so events are scanned and shuffled once.
    """
    day = F.col("day")
    user = F.concat(F.col("event_type"), F.lit("/"), F.col("user_id").cast("string"))
    kinds = [("daily", "event_type", day), ("daily", user, day), ("weekly", "event_type", week_monday(day)), ("monthly", "event_type", F.trunc(day, "MM"))]
    fan = F.array(*[F.struct(F.lit(g).alias("g"), (F.col(k) if isinstance(k, str) else k).alias("series_key"), p.alias("p"), F.lit(i).alias("kind")) for i, (g, k, p) in enumerate(kinds)])
    rows = daily_volumes(events).select("vol", F.inline(fan))
    return _render_series(rows.groupBy("kind", "g", "series_key", "p").agg(F.sum("vol").alias("volume")))


def series_exports(events: DataFrame, granularity: str, by_user: bool = False) -> DataFrame:
    """events -> dynamics exports, one per (series key, window).

    daily: one export per key and calendar month; weekly and monthly: per key
    and year.  Row = period start, volume (sum of value in cents, localized
    thousands), share of all events in that period (5 decimals, comma).
    The requested window starts ``k`` days into the window, with
    k = length(event_type) % 3 (by type) or user_id % 3 (by user).
    """
    day = F.col("day")
    start = {"daily": day, "weekly": week_monday(day), "monthly": F.trunc(day, "MM")}[granularity]
    key = F.concat(F.col("event_type"), F.lit("/"), F.col("user_id").cast("string")) if by_user else F.col("event_type")
    rows = daily_volumes(events).select(F.lit(0).alias("kind"), F.lit(granularity).alias("g"), key.alias("series_key"), start.alias("p"), "vol")
    return _render_series(rows.groupBy("kind", "g", "series_key", "p").agg(F.sum("vol").alias("volume")))


def _render_series(per: DataFrame) -> DataFrame:
    """(kind, g, series_key, p, volume) -> export bytes; ``kind`` tells apart sets with totals of their own."""
    # Referencing every column keeps both branches' plans identical, so the
    # exchange below them is reused.
    totals = per.groupBy("kind", "g", "p").agg(F.sum("volume").alias("total"), F.count("series_key").alias("n_series"))
    per = per.join(totals.drop("n_series"), ["kind", "g", "p"])
    g = F.col("g")
    by_user = F.contains("series_key", F.lit("/"))
    share_micro = F.when(F.col("total") > 0, F.expr("(volume * 200000 + total) div (2 * total)")).otherwise(F.lit(0))
    share_txt = F.concat(
        F.floor(share_micro / F.lit(100000)).cast("bigint").cast("string"),
        F.lit(","),
        F.lpad((share_micro % 100000).cast("string"), 5, "0"),
    )
    months = F.array(*[F.lit(m) for m in MONTHS_NOMINATIVE])
    daily = g == "daily"
    label = F.when(g == "monthly", F.concat_ws(" ", F.element_at(months, F.month("p")), F.year("p").cast("string"))).otherwise(F.date_format("p", "dd.MM.yyyy"))
    win_start = F.when(daily, F.trunc("p", "MM")).otherwise(F.trunc("p", "YEAR"))
    win_end = F.when(daily, F.last_day("p")).otherwise(F.date_add(F.add_months(F.trunc("p", "YEAR"), 12), -1))
    win_label = F.when(daily, F.date_format("p", "yyyy-MM")).otherwise(F.date_format("p", "yyyy"))
    series_key = F.col("series_key")
    export_id = F.concat_ws("|", g, series_key, win_label)
    crc = F.crc32(F.encode(export_id, "UTF-8"))
    sep = F.when(F.pmod(crc, F.lit(3)) == 1, F.lit(NBSP)).otherwise(_sep_choice(F.datediff("p", F.lit("1970-01-01").cast("date"))))
    line = F.concat_ws(";", label, grouped_thousands(F.col("volume"), sep), share_txt, F.lit(""))
    rows = per.select(
        export_id.alias("export_id"), "g", series_key.alias("series_key"),
        win_start.alias("win_start"), win_end.alias("win_end"), "p", line.alias("line"),
    )
    grouped = rows.groupBy("export_id", "g", "series_key", "win_start", "win_end").agg(
        F.array_sort(F.collect_list(F.struct("p", "line"))).alias("lines")
    )
    k = F.when(by_user, F.pmod(F.get(F.split("series_key", "/"), 1).try_cast("bigint"), F.lit(3))).otherwise(F.pmod(F.length("series_key"), F.lit(3)))
    first = F.when(g == "daily", "Дата").when(g == "weekly", "Неделя с").otherwise("Период")
    caption = F.concat(
        F.lit("Динамика запроса «"), F.col("series_key"), F.lit("», "),
        F.date_format("win_start", "dd.MM.yyyy"), F.lit(" – "), F.date_format("win_end", "dd.MM.yyyy"),
        F.lit(", Все регионы, Все устройства"),
    )
    header = F.concat(first, F.lit(";Число запросов;Доля от всех запросов, %;"), caption)
    crc2 = F.crc32(F.encode(F.col("export_id"), "UTF-8"))
    enc = F.element_at(F.array(F.lit("utf-8-sig"), F.lit("cp1251"), F.lit("utf-8")), (F.pmod(crc2, F.lit(3)) + 1).cast("int"))
    eol = F.element_at(F.array(F.lit("\r"), F.lit("\n"), F.lit("\r\n")), (F.pmod(F.expr("crc32(encode(export_id, 'UTF-8')) div 3"), F.lit(3)) + 1).cast("int"))
    text = F.concat(F.array_join(F.concat(F.array(header), F.transform("lines", lambda x: x["line"])), "\n"), F.lit("\n"))
    text = F.replace(text, F.lit("\n"), eol)
    return grouped.select(
        "export_id",
        "series_key",
        F.col("g").alias("granularity"),
        F.date_add("win_start", k.cast("int")).alias("date_from"),
        F.col("win_end").alias("date_to"),
        F.concat(F.replace(F.col("export_id"), F.lit("|"), F.lit("_")), F.lit(".csv")).alias("file_name"),
        encode_text(text, enc).alias("content"),
    )


# ------------------------------------------------------------------ requests
TODAY = "2026-08-21"


def order_requests(orders: DataFrame) -> DataFrame:
    """orders -> period requests: dates shifted into 2020-2026 (every 13th
    key shifted less, so before 2018), granularity by key % 3, length
    key % 120 - 10 days, date_to null every 17th key, both null every 19th."""
    d0 = F.to_date("o_orderdate")
    k = F.col("o_orderkey")
    start = F.when(k % 13 == 0, F.date_add(d0, 8000)).otherwise(F.date_add(d0, 9131))
    end = F.date_add(start, (k % 120 - 10).cast("int"))
    g = F.element_at(F.array(F.lit("monthly"), F.lit("weekly"), F.lit("daily")), (k % 3 + 1).cast("int"))
    return orders.select(
        "o_orderkey", "o_custkey", "o_orderpriority",
        g.alias("granularity"),
        F.when(k % 19 == 0, F.lit(None).cast("date")).otherwise(start).alias("date_from"),
        F.when((k % 19 == 0) | (k % 17 == 0), F.lit(None).cast("date")).otherwise(end).alias("date_to"),
    )


# ------------------------------------------------------------------ manifests
def customer_runs(customer: DataFrame, nation: DataFrame | None = None) -> DataFrame:
    """One run for each customer; its region only where ``nation`` is given."""
    c = customer if nation is None else customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
    region = [] if nation is None else [F.coalesce(F.col("n_name"), F.lit("")).alias("region")]
    g = F.element_at(F.array(*[F.lit(x) for x in ("monthly", "weekly", "daily")]),
                     (F.col("c_custkey") % 3 + 1).cast("int"))
    period = F.when(g != "monthly", F.struct(F.lit("2026-06-01").alias("from"), F.lit("2026-07-31").alias("to")))
    return c.select(
        F.concat(F.lit("run-"), F.col("c_custkey").cast("string")).alias("run_id"),
        "c_custkey",
        F.col("c_name").alias("phrase"),
        *region,
        g.alias("granularity"),
        period.alias("requested_period"),
    )


def export_log(runs: DataFrame) -> DataFrame:
    """Every manifest write: (c_custkey + view_ord) % 3 writes per (run, view)."""
    from demandlake.constants import VIEWS

    views = F.array(*[F.lit(v) for v in VIEWS])
    rv = runs.select("*", F.posexplode(views).alias("view_ord", "view"))
    n = (F.col("c_custkey") + F.col("view_ord")) % 3
    w = rv.withColumn("n_writes_planned", n).filter(F.col("n_writes_planned") > 0).select(
        "*", F.explode(F.sequence(F.lit(1), F.col("n_writes_planned").cast("int"))).alias("seq")
    )
    return w.select(
        "run_id", "c_custkey", "view", "view_ord", F.col("seq").cast("bigint").alias("seq"),
        F.timestamp_seconds(F.lit(1787270400) + F.col("c_custkey") * 60 + F.col("view_ord") * 10 + F.col("seq")).alias("ts"),
        (((F.col("c_custkey") * 7 + F.col("view_ord") * 3 + F.col("seq")) % 5) * 10).cast("bigint").alias("row_count"),
        dataset_file(F.col("view"), F.col("granularity")).alias("file"),
        F.concat(F.lit("https://reports.example/?run="), F.col("c_custkey").cast("string"), F.lit("&v="),
                 F.col("view_ord").cast("string"), F.lit("&s="), F.col("seq").cast("string")).alias("source_url"),
        ((F.col("c_custkey") + F.col("view_ord")) % 7 != 0).alias("file_present"),
    )


# ------------------------------------------------------------------ batches
def batch_logs(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """conversations -> (requests, attempts, stored, warnings), as a collector leaves them.

    A conversation is a batch, a turn a run.  A batch whose conversation has a
    turn of a length divisible by 17 lost its login at the first such turn: that
    run has one attempt, later ones none.  Of the other runs, those of a length
    divisible by 11 broke at view length % 4.  Runs of batches 0, 5, 10, ... are
    resumed: they held the views with (length + view) % 3 = 0 before, and only
    the rest is tried.  Runs of a length divisible by 7 have a stray file.
    """
    from demandlake.constants import VIEWS

    n = F.coalesce(F.length("text"), F.lit(0))
    run = F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))
    runs = conversations.select(F.col("conv_id").alias("batch_id"), F.col("turn").alias("phrase_ord"), run.alias("run_id"), n.alias("len"))
    lost = runs.filter(F.col("len") % 17 == 0).groupBy("batch_id").agg(F.min("phrase_ord").alias("lost"))
    wide = runs.join(lost, "batch_id", "left").select("*", F.posexplode(F.array(*[F.lit(v) for v in VIEWS])).alias("view_ord", "view"))
    held = (F.col("batch_id") % 5 == 0) & ((F.col("len") + F.col("view_ord")) % 3 == 0)
    broke = F.when(F.col("len") % 11 == 0, (F.col("len") % 4).cast("int"))
    at_login = F.col("phrase_ord") == F.col("lost")
    begun = F.col("lost").isNull() | (F.col("phrase_ord") <= F.col("lost"))
    fails = F.col("view_ord") == broke
    tried = wide.filter(begun & F.when(at_login, F.col("view_ord") == 0).otherwise(~held & (broke.isNull() | (F.col("view_ord") <= broke))))
    attempts = tried.select(
        "run_id", "view",
        F.when(F.coalesce(at_login, F.lit(False)), F.lit("AUTH_REQUIRED")).when(fails, F.lit("DOWNLOAD_TIMEOUT")).alias("fail_code"),
        F.when(F.coalesce(at_login, F.lit(False)), F.lit("the login was lost")).when(fails, F.lit("no file arrived in time")).alias("fail_message"),
    )
    warnings = runs.filter(F.col("len") % 7 == 0).select("run_id", F.concat(F.lit("/home/user/Downloads/"), F.col("run_id"), F.lit(".csv")).alias("path"))
    return runs.select("batch_id", "phrase_ord", "run_id"), attempts, wide.filter(held).select("run_id", "view"), warnings


# ------------------------------------------------------------------ stored and quarantined exports
DAMAGE = ("ok", "gap", "bad_date", "before_window", "after_window", "empty", "undecodable", "overflow", "duplicate_header",
          "empty_header", "unparsed_delimiter", "no_header")


def damaged_exports(rows: DataFrame, key: str) -> DataFrame:
    """One daily dynamics export of three days for each row, damaged by ``key % 12`` in the ways of ``DAMAGE``."""
    k = F.col(key)
    kind = F.get(F.array(*[F.lit(x) for x in DAMAGE]), (k % 12).cast("int"))
    day = F.date_add(F.lit("2026-06-01").cast("date"), (k % 20).cast("int"))
    show = lambda d: F.date_format(d, "dd.MM.yyyy")
    second = F.when(kind == "bad_date", F.date_format(F.date_add(day, 1), "yyyy-MM-dd")).otherwise(show(F.date_add(day, 1)))
    third = show(F.date_add(day, F.when(kind == "gap", 3).otherwise(2)))
    count = F.when(kind == "overflow", F.lit("99999999999999999999")).otherwise(k.cast("string"))
    tail = F.lit(";0,5\n")
    header = (
        F.when(kind == "duplicate_header", F.lit("Дата\tДата\tДоля")).when(kind == "empty_header", F.lit("Дата\t \tДоля"))
        .when(kind == "unparsed_delimiter", F.lit("Дата\tЧисло;запросов\tДоля")).otherwise(F.lit("Дата;Число запросов;Доля"))
    )
    days = F.concat(show(day), F.lit(";"), count, tail, second, F.lit(";7"), tail, third, F.lit(";8"), tail)
    text = (
        F.when(kind == "no_header", F.lit("\n")).when(kind.isin("empty", "undecodable"), F.concat(header, F.lit("\n")))
        .when(F.contains(header, F.lit("\t")), F.concat(header, F.lit("\n"), F.replace(days, F.lit(";"), F.lit("\t")))).otherwise(F.concat(header, F.lit("\n"), days))
    )
    content = F.concat(F.encode(text, "UTF-8"), F.when(kind == "undecodable", F.unhex(F.lit("98"))).otherwise(F.unhex(F.lit(""))))
    return dealt(rows).select(
        F.concat(F.lit("run-"), k.cast("string")).alias("run_id"), F.lit("dynamics").alias("view"), F.lit("daily").alias("granularity"),
        F.when(kind == "before_window", F.date_add(day, 1)).otherwise(day).alias("date_from"),
        F.date_add(day, F.when(kind == "after_window", 1).otherwise(10)).alias("date_to"),
        F.concat(F.lit("run-"), k.cast("string"), F.lit(".csv")).alias("file_name"),
        content.alias("content"),
    )


def landed_lines(exports: DataFrame) -> DataFrame:
    """Exports (run_id, view, content) as rows (run_id, view, ord, line), to be written as files.

    A line's bytes stay as they are, whatever their encoding and also where they have
    none (each stands as the character of its number); line ends become LF."""
    text = F.regexp_replace(F.decode("content", "ISO-8859-1"), r"\r\n?|\n\z", "\n")
    return exports.select("run_id", "view", F.posexplode(F.split(F.regexp_replace(text, r"\n\z", ""), "\n", -1)).alias("ord", "line"))


def land(lines: DataFrame, root: str) -> None:
    """Writes one file ``<root>/run_id=/view=/*.csv`` for each run and view, its lines (see ``landed_lines``) in order."""
    ordered = dealt(lines, "run_id", "view").sortWithinPartitions("run_id", "view", "ord")
    if folder := mounted(lines.sparkSession, root):
        write_lines(ordered.select("run_id", "view", "line"), folder, ["run_id", "view"], "csv", "append", "ISO-8859-1", blank_lines=False)
        return
    # The lines are the format already: no quoting, a separator that cannot occur, a byte for each character.
    (ordered.select("run_id", "view", "line").write.mode("append").partitionBy("run_id", "view")
     .option("encoding", "ISO-8859-1").option("sep", "\u0001").option("quote", "").option("emptyValue", "").option("ignoreLeadingWhiteSpace", "false")
     .option("ignoreTrailingWhiteSpace", "false").csv(root))


# ------------------------------------------------------------------ landing
LANDING_ROOTS = ("/data/out/.downloads-a", "/data/out/runs/r1")


def page_files(pages: DataFrame) -> DataFrame:
    k = F.col("page_id")
    root = F.element_at(F.array(F.lit("/data/out/.downloads-a"), F.lit("/data/out/runs/r1"), F.lit("/home/user/Downloads")),
                        (k % 3 + 1).cast("int"))
    ext = F.element_at(F.array(F.lit(".csv"), F.lit(".CSV"), F.lit(".html"), F.lit(".csv.crdownload")), (k % 4 + 1).cast("int"))
    name = F.concat(F.lit("page-"), k.cast("string"), ext)
    path = F.when(k % 10 == 7, F.concat(F.lit("/data/out/.downloads-a/../../../home/user/"), name)).otherwise(
        F.concat(root, F.lit("/"), name))
    return pages.select(
        "page_id", path.alias("path"),
        F.when(k % 9 == 0, F.lit(0)).otherwise(F.length("html")).cast("bigint").alias("length"),
    )


# ------------------------------------------------------------------ long cells and long files
LONG_HEADER = "Номер;Примечание;Сумма;Дата"


def order_records(orders: DataFrame, long_cell: int) -> DataFrame:
    """orders -> (o_orderkey, o_orderpriority, record): a CSV record of four fields each.

    The second field is quoted and holds a delimiter, doubled quotes and, by key, a
    line break; where ``key % 500`` is 0 it goes on for ``long_cell`` repetitions, at
    even keys without a line break.  Every 11th record ends after its second field,
    every 13th is blank.
    """
    k = F.col("o_orderkey")
    filler = F.when(k % 500 == 0, F.repeat(F.when(k % 1000 == 0, 'чай ""зелёный"";').otherwise('чай ""чёрный"";\n'), long_cell)).otherwise(F.lit(""))
    note = F.concat(F.lit('"заказ; ""'), k.cast("string"), F.lit('""'), F.when(k % 3 == 0, "\n").otherwise(" "), F.col("o_orderpriority"), filler, F.lit('"'))
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    amount = F.concat(F.expr("cast(round(o_totalprice * 100) as bigint) div 100").cast("string"), F.lit(","), F.lpad((cents % 100).cast("string"), 2, "0"))
    full = F.concat_ws(";", k.cast("string"), note, amount, F.date_format("o_orderdate", "dd.MM.yyyy"))
    record = F.when(k % 13 == 0, F.lit(";;;")).when(k % 11 == 0, F.concat_ws(";", k.cast("string"), note)).otherwise(full)
    return orders.select("o_orderkey", "o_orderpriority", record.alias("record"))


def order_file_lines(orders: DataFrame, long_cell: int) -> DataFrame:
    """One cp1251 export for each order priority, records in key order, as rows for ``land``; lines of records with one key don't mix."""
    place = lambda head, key, at: F.struct(F.lit(head).alias("head"), key.alias("key"), at.alias("at"))
    records = order_records(orders, long_cell).select("o_orderpriority", place(1, F.col("o_orderkey"), F.monotonically_increasing_id()).alias("ord"), "record")
    none = F.lit(0).cast("long")
    heads = records.select("o_orderpriority").distinct().select("o_orderpriority", place(0, none, none).alias("ord"), F.lit(LONG_HEADER).alias("record"))
    lines = heads.unionByName(records).select("o_orderpriority", "ord", F.posexplode(F.split("record", "\n", -1)).alias("sub", "line"))
    cp1251 = F.translate("line", CP1251_REAL, CP1251_LATIN)
    return lines.select(F.lit("orders").alias("run_id"), F.col("o_orderpriority").alias("view"), F.struct("ord", "sub").alias("ord"), cp1251.alias("line"))


# ------------------------------------------------------------------ downloads
LAST_TICK = 3


def download_sightings(events: DataFrame) -> DataFrame:
    """events -> (run_id, view, tick, path, length, inside): a user's events of one day are the
    files that appear one by one during a download, the first before it, up to the last look.

    An error's file lands elsewhere, a view's has no .csv name yet, and every 4th is
    empty at its first look.
    """
    kind, n = F.col("event_type"), F.col("n")
    order = Window.partitionBy("user_id", "day").orderBy("ts", "event_id")
    files = events.withColumn("day", F.date_format("ts", "yyyy-MM-dd")).withColumn("n", F.row_number().over(order) - 1).filter(n <= LAST_TICK)
    root = F.when(kind == "error", F.lit("/home/user/Downloads/")).otherwise(F.lit("/data/out/./.downloads-a/"))
    path = F.concat(root, F.col("event_id").cast("string"), F.when(kind == "view", ".crdownload").when(F.col("event_id") % 2 == 0, ".csv").otherwise(".CSV"))
    seen = files.select("event_id", F.concat_ws("/", F.col("user_id").cast("string"), "day").alias("run_id"), F.lit("dynamics").alias("view"), "n", path.alias("path"),
                        F.explode(F.sequence(n, F.lit(LAST_TICK))).alias("tick"))
    length = F.when((F.col("event_id") % 4 == 0) & (F.col("tick") == n), 0).otherwise(100).cast("long")
    return seen.select("run_id", "view", "tick", "path", length.alias("length"), (~F.startswith("path", F.lit("/home/"))).alias("inside"))
