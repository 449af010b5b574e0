"""DuckDB oracle SQL for the registered queries.

Each statement recomputes the expected result straight from the given
tables with the same derivation rules as ``demandlake.plans.derive``; the
operator semantics are re-expressed independently in SQL.
"""

from __future__ import annotations

from demandlake import messages
from demandlake.constants import MONTHS_GENITIVE, MONTHS_NOMINATIVE, NOT_ATTEMPTED_PREFIX, NOT_COLLECTED
from demandlake.messages import sql_case

ORACLE: dict[str, str] = {}

ORACLE["parse_localized_number"] = r"""
WITH c AS (
  SELECT o_orderkey, o_orderkey % 10 AS v,
         CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
         CAST(round(o_totalprice * 100) AS BIGINT) // 100 AS ip
  FROM orders)
SELECT o_orderkey,
  CASE WHEN v = 0 THEN 'empty'
       WHEN v IN (1, 2, 3) THEN 'text'
       WHEN v IN (4, 5) THEN 'int'
       WHEN v = 6 THEN CASE WHEN CAST(ip AS HUGEINT) * 1000000000000000 > 9223372036854775807 THEN 'int_overflow'
                            WHEN CAST(ip AS HUGEINT) * 1000000000000000 > 9007199254740992 THEN 'int_wide'
                            ELSE 'int' END
       ELSE 'frac' END AS kind,
  CASE WHEN v = 4 THEN ip WHEN v = 5 THEN -ip
       WHEN v = 6 THEN TRY_CAST(CAST(ip AS HUGEINT) * 1000000000000000 AS BIGINT) END AS as_long,
  CASE WHEN v IN (7, 8, 9) THEN CAST(cents AS DOUBLE) / CAST(100 AS DOUBLE) END AS as_double
FROM c
"""

_PART_CELLS = r"""
WITH p AS (
  SELECT p_partkey // 50 AS block, p_partkey, p_name, p_size,
         CAST(round(p_retailprice * 100) AS BIGINT) AS cents,
         CAST(row_number() OVER (PARTITION BY p_partkey // 50 ORDER BY p_partkey) - 1 AS INTEGER) AS row_ord
  FROM part),
prof AS (
  SELECT block,
         bool_or(p_partkey % 97 = 0) AS size_na,
         bool_or(p_partkey % 97 <> 0 AND p_partkey % 9 <> 0) AS size_num,
         bool_or(cents % 100 <> 0) AS price_frac
  FROM p GROUP BY block),
dt AS (
  SELECT block, 0 AS col_ord, 'Артикул' AS header, 'int64' AS dtype FROM prof
  UNION ALL SELECT block, 1, 'Название', 'string' FROM prof
  UNION ALL SELECT block, 2, 'Размер', CASE WHEN size_na THEN 'string' WHEN size_num THEN 'int64' ELSE 'string' END FROM prof
  UNION ALL SELECT block, 3, 'Цена', CASE WHEN price_frac THEN 'float64' ELSE 'int64' END FROM prof
  UNION ALL SELECT block, 4, 'Скидка', 'string' FROM prof
  UNION ALL SELECT block, 5, 'Примечание', 'string' FROM prof),
cells AS (
  SELECT block, row_ord, 0 AS col_ord, CAST(p_partkey AS VARCHAR) AS text, p_partkey AS v_long, NULL::DOUBLE AS v_double FROM p
  UNION ALL SELECT block, row_ord, 1, coalesce(p_name, ''), NULL, NULL FROM p
  UNION ALL SELECT block, row_ord, 2,
         CASE WHEN p_partkey % 97 = 0 THEN 'н/д' WHEN p_partkey % 9 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) END,
         CASE WHEN p_partkey % 97 = 0 OR p_partkey % 9 = 0 THEN NULL ELSE CAST(p_size AS BIGINT) END, NULL FROM p
  UNION ALL SELECT block, row_ord, 3,
         CASE WHEN cents % 100 = 0 THEN CAST(cents // 100 AS VARCHAR)
              ELSE CAST(cents // 100 AS VARCHAR) || ',' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') END,
         cents // 100, CAST(cents AS DOUBLE) / CAST(100 AS DOUBLE) FROM p
  UNION ALL SELECT block, row_ord, 4, CAST(p_size AS VARCHAR) || ',5%', NULL, NULL FROM p
  UNION ALL SELECT block, row_ord, 5, '', NULL, NULL FROM p)
"""

ORACLE["infer_column_types"] = _PART_CELLS + r"""
SELECT 'part-' || CAST(block AS VARCHAR) AS export_id, CAST(col_ord AS INTEGER) AS col_ord, header, dtype FROM dt
"""

ORACLE["typed_cells"] = _PART_CELLS + r"""
SELECT 'part-' || CAST(c.block AS VARCHAR) AS export_id, c.row_ord, CAST(c.col_ord AS INTEGER) AS col_ord,
       d.header, c.text, d.dtype,
       CASE WHEN d.dtype = 'int64' THEN c.v_long END AS as_long,
       CASE WHEN d.dtype = 'float64' THEN coalesce(c.v_double, CAST(c.v_long AS DOUBLE)) END AS as_double
FROM cells c JOIN dt d ON c.block = d.block AND c.col_ord = d.col_ord
"""

ORACLE["merge_column_profiles"] = _PART_CELLS + r"""
, k AS (
  SELECT c.col_ord, d.header, c.block,
    CASE WHEN c.col_ord IN (1, 4) THEN 'text'
         WHEN c.col_ord = 5 THEN 'empty'
         WHEN c.col_ord = 2 AND c.text = 'н/д' THEN 'text'
         WHEN c.col_ord = 2 AND c.text = '' THEN 'empty'
         WHEN c.col_ord = 3 AND position(',' IN c.text) > 0 THEN 'frac'
         ELSE 'int' END AS kind
  FROM cells c JOIN dt d ON c.block = d.block AND c.col_ord = d.col_ord),
m AS (
  SELECT col_ord, header, count(DISTINCT block) AS n_exports,
         count(*) FILTER (WHERE kind = 'text') AS n_text, count(*) FILTER (WHERE kind = 'frac') AS n_frac,
         count(*) FILTER (WHERE kind = 'int') AS n_int
  FROM k GROUP BY col_ord, header)
SELECT CAST(col_ord AS INTEGER) AS col_ord, header,
  CASE WHEN n_text > 0 THEN 'string' WHEN n_frac + n_int = 0 THEN 'string' WHEN n_frac > 0 THEN 'float64' ELSE 'int64' END
    AS dtype, n_exports, n_text, n_frac, n_int
FROM m
"""

_DOCS = r"""
WITH d AS (
  SELECT doc_id,
    translate(regexp_replace(text, '[^\x00-\x7f]', '№', 'g'),
      'abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'абцдефгхийклмнопярстувшхызАБЦДЕФГХИЙКЛМНОПЯРСТУВШХЫЗ') AS t,
    CASE (doc_id // 3) % 3 WHEN 0 THEN 'utf-8' WHEN 1 THEN 'utf-8-sig' ELSE 'cp1251' END AS encoding
  FROM documents),
s AS (
  SELECT doc_id, t, encoding,
         CASE WHEN t = '' THEN []
              WHEN suffix(t, chr(10)) THEN string_split(t[1:length(t) - 1], chr(10))
              ELSE string_split(t, chr(10)) END AS lines
  FROM d)
"""

ORACLE["decode_exports"] = _DOCS + r"""
SELECT doc_id, encoding, CAST(length(t) AS BIGINT) AS n_chars, CAST(len(lines) AS INTEGER) AS n_lines, md5(t) AS text_md5
FROM s
"""

ORACLE["split_records"] = _DOCS + r"""
SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_ord, lines[i] AS line
FROM (SELECT doc_id, lines, generate_subscripts(lines, 1) AS i FROM s)
"""

_SUPPLIERS = r"""
WITH s AS (
  SELECT s_suppkey, s_suppkey // 16 AS block, s_suppkey - (s_suppkey // 16) * 16 AS pos, s_name,
         coalesce(n.n_name, '') AS nat,
         CAST(round(s_acctbal * 100) AS BIGINT) AS cents,
         CASE WHEN (s_suppkey // 16) % 5 = 4 THEN ((s_suppkey // 16) // 5) % 3 END AS hdr_kind
  FROM supplier LEFT JOIN nation n ON s_nationkey = n.n_nationkey),
s2 AS (
  SELECT *,
    CASE WHEN hdr_kind = 2 THEN chr(9) WHEN block % 3 = 0 THEN ';' WHEN block % 3 = 1 THEN chr(9) ELSE ',' END AS d,
    CASE WHEN cents < 0 THEN '-' ELSE '' END || CAST(abs(cents) // 100 AS VARCHAR) || ','
      || lpad(CAST(abs(cents) % 100 AS VARCHAR), 2, '0') AS bal,
    pos >= 9 AND s_suppkey % 5 = 0 AS short
  FROM s),
ex AS (
  SELECT block, any_value(d) AS d, max(hdr_kind) AS hdr_kind, count(*) AS n_rows FROM s2 GROUP BY block)
"""

ORACLE["elect_delimiter"] = _SUPPLIERS + r"""
SELECT 'supplier-' || CAST(block AS VARCHAR) AS export_id,
       CASE d WHEN ';' THEN 'semicolon' WHEN ',' THEN 'comma' ELSE 'tab' END AS delimiter
FROM ex
"""

ORACLE["validate_headers"] = _SUPPLIERS + r"""
SELECT 'supplier-' || CAST(block AS VARCHAR) AS export_id,
       CASE hdr_kind WHEN 0 THEN 'duplicate_header' WHEN 1 THEN 'empty_header' WHEN 2 THEN 'unparsed_delimiter' ELSE 'ok' END
         AS header_status,
       CASE WHEN hdr_kind IS NULL THEN 4 END AS n_headers
FROM ex
"""

ORACLE["export_row_count"] = _SUPPLIERS + r"""
SELECT 'supplier-' || CAST(block AS VARCHAR) AS export_id,
       CASE WHEN hdr_kind IS NULL THEN n_rows END AS row_count
FROM ex
"""

ORACLE["parse_records"] = _SUPPLIERS + r"""
, r AS (
  SELECT block, CAST(row_number() OVER (PARTITION BY block ORDER BY s_suppkey) - 1 AS INTEGER) AS row_ord,
         CASE WHEN s_suppkey % 4 = 1 THEN s_name || d || '"A"' ELSE s_name END AS c0,
         bal AS c1, CASE WHEN short THEN '' ELSE nat END AS c2, '' AS c3
  FROM s2 WHERE hdr_kind IS NULL)
SELECT 'supplier-' || CAST(block AS VARCHAR) AS export_id, row_ord, col_ord, text
FROM (
  SELECT block, row_ord, 0 AS col_ord, c0 AS text FROM r
  UNION ALL SELECT block, row_ord, 1, c1 FROM r
  UNION ALL SELECT block, row_ord, 2, c2 FROM r
  UNION ALL SELECT block, row_ord, 3, c3 FROM r)
"""


def _series_sql(granularity: str, by_user: bool) -> str:
    start = {"daily": "CAST(ts AS DATE)",
             "weekly": "CAST(date_trunc('week', CAST(ts AS DATE)) AS DATE)",
             "monthly": "CAST(date_trunc('month', CAST(ts AS DATE)) AS DATE)"}[granularity]
    key = "event_type || '/' || CAST(user_id AS VARCHAR)" if by_user else "event_type"
    win = "strftime(p, '%Y-%m')" if granularity == "daily" else "strftime(p, '%Y')"
    win_start = "CAST(date_trunc('month', p) AS DATE)" if granularity == "daily" else "CAST(date_trunc('year', p) AS DATE)"
    win_end = ("CAST(last_day(p) AS DATE)" if granularity == "daily"
               else "CAST(date_trunc('year', p) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE)")
    k = "user_id % 3" if by_user else "length(event_type) % 3"
    label = ("CASE month(p) " + " ".join(
        f"WHEN {i + 1} THEN '{m}'" for i, m in enumerate(
            MONTHS_NOMINATIVE)) + " END || ' ' || CAST(year(p) AS VARCHAR)"
             if granularity == "monthly" else "strftime(p, '%d.%m.%Y')")
    step = {"daily": 1, "weekly": 7, "monthly": 0}[granularity]
    first = {"daily": "Дата", "weekly": "Неделя с", "monthly": "Период"}[granularity]
    return f"""
    SELECT '{granularity}|' || {key} || '|' || {win} AS export_id, '{granularity}' AS granularity,
           p, {label} AS label, volume, share_micro,
           {win_start} + CAST({k} AS INTEGER) AS date_from, {win_end} AS date_to, {step} AS step, '{first}' AS field
    FROM (
      SELECT event_type, {'user_id,' if by_user else ''} p, sum(vol) AS volume, any_value(total) AS total,
             CASE WHEN any_value(total) > 0
                  THEN (sum(vol) * 200000 + any_value(total)) // (2 * any_value(total)) ELSE 0 END AS share_micro
      FROM (SELECT e.*, t.total FROM
              (SELECT event_type, user_id, {start} AS p, CAST(round(value * 100) AS BIGINT) AS vol FROM events) e
              JOIN (SELECT {start} AS p, sum(CAST(round(value * 100) AS BIGINT)) AS total FROM events GROUP BY 1) t
              ON e.p = t.p)
      GROUP BY event_type, {'user_id,' if by_user else ''} p)
    """


_SERIES_ALL = (
    "WITH rows AS (" + " UNION ALL ".join(
        _series_sql(g, u) for g, u in (("daily", False), ("daily", True), ("weekly", False), ("monthly", False))
    ) + r"""),
o AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY export_id ORDER BY p) - 1 AS INTEGER) AS row_ord,
         lag(p) OVER (PARTITION BY export_id ORDER BY p) AS prev_p,
         count(*) OVER (PARTITION BY export_id) AS n
  FROM rows),
g AS (
  SELECT export_id, min(row_ord) FILTER (WHERE granularity <> 'monthly' AND row_ord > 0
                                          AND date_diff('day', prev_p, p) <> step) AS gap_ord
  FROM o GROUP BY export_id),
e AS (
  SELECT o.export_id, any_value(o.granularity) AS granularity, any_value(o.date_from) AS date_from,
         any_value(o.date_to) AS date_to, any_value(o.field) AS field,
         min(o.p) AS first_p, max(o.p) AS last_p, count(*) AS n,
         arg_min(o.label, o.row_ord) AS first_label, arg_max(o.label, o.row_ord) AS last_label,
         any_value(g.gap_ord) AS gap_ord
  FROM o JOIN g ON o.export_id = g.export_id GROUP BY o.export_id),
v AS (
  SELECT e.*,
    CASE WHEN granularity = 'monthly' THEN 'skipped'
         WHEN gap_ord IS NOT NULL THEN 'gap'
         WHEN first_p < CASE WHEN granularity = 'weekly' THEN CAST(date_trunc('week', date_from) AS DATE) ELSE date_from END
           THEN 'before_window'
         WHEN last_p > date_to THEN 'after_window'
         ELSE 'ok' END AS verdict
  FROM e)
""")

ORACLE["typed_daily_series"] = _SERIES_ALL + r"""
SELECT o.export_id, o.row_ord, o.label AS period, o.volume AS n,
       CAST(o.share_micro AS DOUBLE) / CAST(100000 AS DOUBLE) AS share, v.verdict
FROM o JOIN v ON o.export_id = v.export_id
WHERE o.granularity = 'daily' AND o.export_id NOT LIKE '%/%'
"""

ORACLE["series_contiguity"] = _SERIES_ALL + r"""
SELECT v.export_id, v.verdict <> 'gap' AS contiguous,
       CASE WHEN v.verdict = 'gap' THEN strftime(a.prev_p, '%d.%m.%Y') END AS gap_from,
       CASE WHEN v.verdict = 'gap' THEN strftime(a.p, '%d.%m.%Y') END AS gap_to
FROM v LEFT JOIN o a ON a.export_id = v.export_id AND a.row_ord = v.gap_ord
"""

ORACLE["series_containment"] = _SERIES_ALL + r"""
SELECT export_id, verdict, strftime(date_from, '%Y-%m-%d') AS date_from, strftime(date_to, '%Y-%m-%d') AS date_to,
       CASE WHEN granularity <> 'monthly' THEN strftime(first_p, '%Y-%m-%d') END AS series_first,
       CASE WHEN granularity <> 'monthly' THEN strftime(last_p, '%Y-%m-%d') END AS series_last
FROM v
"""

ORACLE["actual_period"] = _SERIES_ALL + r"""
SELECT export_id, field, first_label AS period_from, last_label AS period_to, n AS row_count
FROM v
"""


# ------------------------------------------------------------------ requests
_REQ = r"""
WITH r AS (
  SELECT o_orderkey, o_custkey, o_orderpriority,
    CASE o_orderkey % 3 WHEN 0 THEN 'monthly' WHEN 1 THEN 'weekly' ELSE 'daily' END AS granularity,
    CASE WHEN o_orderkey % 19 = 0 THEN NULL
         WHEN o_orderkey % 13 = 0 THEN CAST(o_orderdate AS DATE) + 8000 ELSE CAST(o_orderdate AS DATE) + 9131 END AS date_from,
    CASE WHEN o_orderkey % 19 = 0 OR o_orderkey % 17 = 0 THEN NULL
         ELSE (CASE WHEN o_orderkey % 13 = 0 THEN CAST(o_orderdate AS DATE) + 8000 ELSE CAST(o_orderdate AS DATE) + 9131 END)
              + CAST(o_orderkey % 120 - 10 AS INTEGER) END AS date_to
  FROM orders)
"""


def _period_reason(g: str, df: str, dt: str) -> str:
    return f"""CASE WHEN ({df} IS NULL) <> ({dt} IS NULL) THEN 'together'
      WHEN {df} IS NULL THEN NULL
      WHEN {df} < DATE '2018-01-01' OR {dt} < DATE '2018-01-01' THEN 'too_early'
      WHEN {dt} < {df} THEN 'reversed'
      WHEN {g} = 'daily' AND {dt} > DATE '2026-08-21' THEN 'daily_future'
      WHEN {g} = 'daily' AND date_diff('day', {df}, {dt}) >= 60 THEN 'daily_span'
      WHEN {g} = 'daily' AND date_diff('day', {df}, DATE '2026-08-21') > 60 THEN 'daily_age'
      WHEN {g} = 'weekly' AND date_diff('day', {df}, {dt}) < 20 THEN 'weekly_span'
      WHEN {g} NOT IN ('daily', 'weekly')
           AND {dt} < CAST(last_day(date_trunc('month', {df}) + INTERVAL 2 MONTH) AS DATE) THEN 'monthly_span'
    END"""


_PERIOD_MSG = sql_case("reason", messages.PERIOD | messages.BATCH)

ORACLE["validate_period"] = _REQ + f"""
, v AS (SELECT *, {_period_reason('granularity', 'date_from', 'date_to')} AS reason FROM r)
SELECT o_orderkey, granularity, strftime(date_from, '%Y-%m-%d') AS date_from, strftime(date_to, '%Y-%m-%d') AS date_to,
       reason, {_PERIOD_MSG} AS message
FROM v
"""

ORACLE["parse_iso_date"] = _REQ + r"""
, t AS (
  SELECT o_orderkey, date_from, o_orderkey % 4 AS k,
    CASE o_orderkey % 4
      WHEN 0 THEN strftime(date_from, '%Y-%m-%d')
      WHEN 1 THEN CAST(year(date_from) AS VARCHAR) || '-' || CAST(month(date_from) AS VARCHAR) || '-' || CAST(day(date_from) AS VARCHAR)
      WHEN 2 THEN strftime(date_from, '%Y-%m') || '-31'
      ELSE strftime(date_from, '%d.%m.%Y') END AS text
  FROM r),
p AS (
  SELECT o_orderkey, text,
    CASE WHEN k IN (0, 1) THEN strftime(date_from, '%Y-%m-%d')
         WHEN k = 2 AND day(last_day(date_from)) = 31 THEN strftime(date_from, '%Y-%m') || '-31' END AS parsed
  FROM t)
SELECT o_orderkey, text, parsed,
       CASE WHEN text IS NOT NULL AND parsed IS NULL THEN 'not a calendar day of the form YYYY-MM-DD: ' || text END
         AS error_message
FROM p
"""

ORACLE["requested_period"] = _REQ + r"""
SELECT o_orderkey,
  CASE WHEN date_from IS NOT NULL AND date_to IS NOT NULL THEN strftime(date_from, '%Y-%m-%d') END AS req_from,
  CASE WHEN date_from IS NOT NULL AND date_to IS NOT NULL THEN strftime(date_to, '%Y-%m-%d') END AS req_to,
  strftime(CAST(last_day(date_trunc('month', date_from) + INTERVAL 2 MONTH) AS DATE), '%Y-%m-%d') AS min_monthly_end
FROM r
"""

ORACLE["validate_batch"] = _REQ + f"""
, b AS (
  SELECT o_custkey AS batch_id, count(*) AS n_phrases,
    bool_or(o_orderkey % 23 = 0) AS any_blank,
    arg_min(struct_pack(g := granularity, df := date_from, dt := date_to), o_orderkey) AS first_req,
    o_custkey % 29 = 0 AS blank_region, o_custkey % 31 = 0 AS resume
  FROM r GROUP BY o_custkey),
b2 AS (SELECT *, first_req.g AS g, first_req.df AS df, first_req.dt AS dt FROM b),
p AS (SELECT *, {_period_reason('g', 'df', 'dt')} AS period_reason FROM b2),
q AS (
  SELECT *, CASE WHEN period_reason IS NOT NULL THEN period_reason
                 WHEN n_phrases = 0 THEN 'no_phrases'
                 WHEN blank_region THEN 'blank_region'
                 WHEN any_blank THEN 'blank_phrase'
                 WHEN resume AND n_phrases <> 1 THEN 'resume_needs_one' END AS reason
  FROM p)
SELECT batch_id, n_phrases, reason,
  CASE WHEN period_reason IS NOT NULL THEN 'INVALID_PERIOD' WHEN reason IS NOT NULL THEN 'INVALID_REQUEST' END AS error_code,
  {_PERIOD_MSG} AS error_message
FROM q
"""

# ------------------------------------------------------------------ naming
_SLUG = r"""coalesce(nullif(substring(lower(regexp_replace(regexp_replace(text, '[^0-9A-Za-zА-Яа-я]+', '-', 'g'),
                  '^-+|-+$', '', 'g')), 1, 64), ''), 'query')"""

ORACLE["slugify"] = f"SELECT doc_id, {_SLUG} AS slug FROM documents"

ORACLE["run_key"] = f"""
WITH b AS (SELECT doc_id, '20260821T100000Z-' || {_SLUG} AS base FROM documents),
n AS (SELECT doc_id, base, row_number() OVER (PARTITION BY base ORDER BY doc_id) AS n FROM b)
SELECT doc_id, CASE WHEN n = 1 THEN base ELSE base || '-' || CAST(n AS VARCHAR) END AS run_key FROM n
"""

_GEN, _NOM = MONTHS_GENITIVE, MONTHS_NOMINATIVE


def _month(names, d):
    return f"(CASE month({d}) " + " ".join(f"WHEN {i + 1} THEN '{m}'" for i, m in enumerate(names)) + " END)"


def _day_gen(d):
    return f"CAST(day({d}) AS VARCHAR) || ' ' || {_month(_GEN, d)}"


_MON = "CAST(date_trunc('week', date_from) AS DATE)"

ORACLE["period_label"] = _REQ + f"""
SELECT o_orderkey, granularity,
  CASE granularity
    WHEN 'monthly' THEN {_month(_NOM, 'date_from')} || ' ' || CAST(year(date_from) AS VARCHAR)
    WHEN 'daily' THEN {_day_gen('date_from')}
    ELSE {_day_gen(_MON)} || ' ' || CAST(year({_MON}) AS VARCHAR) END AS label
FROM r
"""

_SUN = f"({_MON} + 6)"

ORACLE["label_granularity"] = _REQ + f"""
SELECT o_orderkey,
  CASE o_orderkey % 4
    WHEN 0 THEN {_day_gen('date_from')}
    WHEN 1 THEN {_day_gen(_MON)} || ' ' || CAST(year({_MON}) AS VARCHAR) || ' – ' || {_day_gen(_SUN)} || ' '
                || CAST(year({_SUN}) AS VARCHAR)
    WHEN 2 THEN {_month(_NOM, 'date_from')} || ' ' || CAST(year(date_from) AS VARCHAR)
    ELSE strftime(date_from, '%d.%m.%Y') END AS label,
  CASE WHEN date_from IS NULL THEN NULL WHEN o_orderkey % 4 = 0 THEN 'daily' WHEN o_orderkey % 4 = 1 THEN 'weekly' WHEN o_orderkey % 4 = 2 THEN 'monthly' END AS granularity
FROM r
"""

_VIEWS_CASE = "CASE {x} WHEN 0 THEN 'top_popular' WHEN 1 THEN 'top_related' WHEN 2 THEN 'dynamics' ELSE 'regions' END"


def _file(view, g):
    return (f"CASE WHEN {view} = 'dynamics' AND {g} = 'monthly' THEN 'dynamics.parquet' "
            f"WHEN {view} = 'dynamics' THEN 'dynamics_' || {g} || '.parquet' ELSE {view} || '.parquet' END")


ORACLE["dataset_name"] = _REQ + f"""
, v AS (SELECT o_orderkey, {_VIEWS_CASE.format(x='o_orderkey % 4')} AS view, granularity FROM r)
SELECT o_orderkey, view, granularity, {_file('view', 'granularity')} AS file,
       CASE WHEN o_orderkey % 2 = 0 THEN view || '.csv' END AS raw_file
FROM v
"""

# ------------------------------------------------------------------ manifests
_LOG = f"""
WITH runs AS (
  SELECT 'run-' || CAST(c_custkey AS VARCHAR) AS run_id, c_custkey, c_name AS phrase, coalesce(n.n_name, '') AS region,
         CASE c_custkey % 3 WHEN 0 THEN 'monthly' WHEN 1 THEN 'weekly' ELSE 'daily' END AS granularity
  FROM customer LEFT JOIN nation n ON c_nationkey = n.n_nationkey),
rv AS (
  SELECT runs.*, v.view_ord, {_VIEWS_CASE.format(x='v.view_ord')} AS view
  FROM runs, (VALUES (0), (1), (2), (3)) v(view_ord)),
log AS (
  SELECT run_id, c_custkey, view, view_ord, CAST(s.seq AS BIGINT) AS seq,
         1787270400 + c_custkey * 60 + view_ord * 10 + s.seq AS ts,
         CAST(((c_custkey * 7 + view_ord * 3 + s.seq) % 5) * 10 AS BIGINT) AS row_count,
         {_file('view', 'granularity')} AS file,
         'https://reports.example/?run=' || CAST(c_custkey AS VARCHAR) || '&v=' || CAST(view_ord AS VARCHAR)
           || '&s=' || CAST(s.seq AS VARCHAR) AS source_url,
         (c_custkey + view_ord) % 7 <> 0 AS file_present
  FROM rv, generate_series(1, (c_custkey + view_ord) % 3) s(seq)
  WHERE (c_custkey + view_ord) % 3 > 0),
merged AS (
  SELECT run_id, view, any_value(view_ord) AS view_ord, max(seq) AS seq, arg_max(row_count, seq) AS row_count,
         arg_max(file, seq) AS file, count(*) AS n_writes, arg_max(file_present, seq) AS file_present
  FROM log GROUP BY run_id, view)
"""

ORACLE["merge_exports"] = _LOG + """
SELECT run_id, view, CAST(view_ord AS INTEGER) AS view_ord, seq, row_count, file, n_writes FROM merged
"""

ORACLE["missing_views"] = _LOG + """
SELECT rv.run_id, rv.view, CAST(rv.view_ord AS INTEGER) AS view_ord
FROM rv LEFT JOIN merged m ON rv.run_id = m.run_id AND rv.view = m.view WHERE m.run_id IS NULL
"""

ORACLE["pending_views"] = _LOG + """
SELECT rv.run_id, rv.view, CAST(rv.view_ord AS INTEGER) AS view_ord
FROM rv LEFT JOIN merged m ON rv.run_id = m.run_id AND rv.view = m.view
WHERE m.run_id IS NULL OR NOT m.file_present
"""

ORACLE["prune_stale"] = _LOG + """
, c AS (SELECT run_id, count(*) AS n_before, count(*) FILTER (WHERE file_present) AS n_after FROM merged GROUP BY run_id)
SELECT runs.run_id, coalesce(c.n_before, 0) AS n_before, coalesce(c.n_after, 0) AS n_after,
       coalesce(c.n_after, 0) < coalesce(c.n_before, 0) AS bumped
FROM runs LEFT JOIN c ON runs.run_id = c.run_id
"""

ORACLE["run_status"] = _LOG + """
, s AS (
  SELECT rv.run_id,
    string_agg(CASE WHEN m.run_id IS NULL THEN rv.view END, ',' ORDER BY rv.view_ord) AS missing,
    string_agg(CASE WHEN m.row_count = 0 THEN rv.view END, ',' ORDER BY rv.view_ord) AS empty,
    count(*) FILTER (WHERE m.run_id IS NULL) AS n_missing,
    count(*) FILTER (WHERE m.row_count = 0) AS n_empty
  FROM rv LEFT JOIN merged m ON rv.run_id = m.run_id AND rv.view = m.view GROUP BY rv.run_id)
SELECT run_id, CAST(n_missing AS INTEGER) AS n_missing, CAST(n_empty AS INTEGER) AS n_empty,
       CASE WHEN n_missing > 0 OR n_empty > 0 THEN 'incomplete' ELSE 'complete' END AS status,
       coalesce(missing, '') AS missing, coalesce(empty, '') AS empty
FROM s
"""

ORACLE["duplicate_views"] = _LOG + """
, c AS (SELECT run_id, view, count(*) AS n FROM log GROUP BY run_id, view)
SELECT run_id, bool_or(n > 1) AS duplicate,
       coalesce(string_agg(CASE WHEN n > 1 THEN view END, ',' ORDER BY CASE WHEN n > 1 THEN view END), '') AS dup_views
FROM c GROUP BY run_id
"""

ORACLE["manifest_timestamps"] = _LOG + """
, w AS (SELECT run_id, max(ts) AS ts, arg_max(source_url, ts) AS source_url FROM log GROUP BY run_id)
SELECT runs.run_id, 1787270400 + c_custkey * 60 AS created_at, coalesce(w.ts, 1787270400 + c_custkey * 60) AS updated_at,
       coalesce(w.source_url, 'https://reports.example/?run=' || CAST(c_custkey AS VARCHAR)) AS source_url
FROM runs LEFT JOIN w ON runs.run_id = w.run_id
"""

ORACLE["resume_match"] = _LOG + """
, req AS (
  SELECT CASE WHEN c_custkey % 13 = 6 THEN 'run-' || CAST(c_custkey + 1000000 AS VARCHAR) ELSE run_id END AS run_id,
         CASE WHEN c_custkey % 5 = 2 THEN 'x' ELSE '' END AS phrase_suffix,
         c_custkey % 7 = 3 AS other_region, c_custkey % 11 = 4 AS other_g
  FROM runs)
SELECT req.run_id,
  CASE WHEN runs.run_id IS NULL THEN 'missing_manifest'
       WHEN phrase_suffix <> '' OR other_region THEN 'phrase_region_mismatch'
       WHEN other_g THEN 'period_mismatch' ELSE 'ok' END AS match
FROM req LEFT JOIN runs ON req.run_id = runs.run_id
"""

# ------------------------------------------------------------------ batches
_ATT = f"""
WITH runs AS (
  SELECT conv_id AS batch_id, turn AS phrase_ord, CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS run_id,
         coalesce(length(text), 0) AS len
  FROM conversations),
l AS (SELECT batch_id, min(phrase_ord) AS lost FROM runs WHERE len % 17 = 0 GROUP BY batch_id),
w AS (
  SELECT runs.*, l.lost, v.view_ord, {_VIEWS_CASE.format(x='v.view_ord')} AS view,
    batch_id % 5 = 0 AND (len + v.view_ord) % 3 = 0 AS held,
    CASE WHEN len % 11 = 0 THEN len % 4 END AS broke
  FROM runs LEFT JOIN l USING (batch_id), (VALUES (0), (1), (2), (3)) v(view_ord)),
cut AS (
  SELECT *,
    CASE WHEN phrase_ord > lost THEN CASE WHEN held THEN 'kept' ELSE 'skipped' END
         WHEN phrase_ord = lost THEN CASE WHEN view_ord = 0 THEN 'auth_failed' WHEN held THEN 'kept' ELSE 'missing' END
         WHEN held THEN 'kept'
         WHEN broke IS NULL OR view_ord < broke THEN 'stored'
         WHEN view_ord = broke THEN 'failed'
         -- a run whose breaking view it already held never tried that view
         WHEN batch_id % 5 = 0 AND (len + broke) % 3 = 0 THEN
           CASE WHEN broke = 0 OR NOT EXISTS (SELECT 1 FROM (VALUES (0), (1), (2), (3)) u(o)
                                              WHERE u.o < broke AND (len + u.o) % 3 <> 0) THEN 'skipped' ELSE 'missing' END
         ELSE 'not_attempted' END AS outcome
  FROM w),
cut2 AS (
  SELECT *,
    CASE WHEN outcome = 'failed' THEN 'DownloadTimeoutError: no file arrived in time'
         WHEN outcome = 'not_attempted' THEN '{NOT_ATTEMPTED_PREFIX}' || {_VIEWS_CASE.format(x='broke')} END AS view_error
  FROM cut),
po AS (
  SELECT run_id, any_value(batch_id) AS batch_id, any_value(phrase_ord) AS phrase_ord,
    CASE WHEN bool_or(outcome = 'auth_failed') THEN 'failure'
         WHEN bool_or(outcome = 'skipped') THEN 'skipped'
         WHEN bool_or(outcome IN ('stored', 'kept')) OR NOT bool_or(outcome = 'failed') THEN 'result' ELSE 'failure' END AS outcome,
    bool_or(outcome = 'auth_failed') AS auth,
    count(*) FILTER (WHERE outcome NOT IN ('stored', 'kept')) AS n_incomplete
  FROM cut2 GROUP BY run_id),
po2 AS (
  SELECT *, outcome = 'result' AND n_incomplete > 0 AS partial,
    CASE WHEN auth THEN 'AUTH_REQUIRED' WHEN outcome = 'failure' THEN 'DOWNLOAD_TIMEOUT' END AS error_code
  FROM po)
"""

ORACLE["auth_abort_cut"] = _ATT + """
SELECT batch_id, phrase_ord, CASE WHEN auth THEN 'auth_failed' WHEN outcome = 'skipped' THEN 'skipped' ELSE 'attempted' END AS phrase_state
FROM po2
"""

ORACLE["first_failure_cut"] = _ATT + "SELECT run_id, view, outcome, view_error FROM cut2"

ORACLE["phrase_outcome"] = _ATT + "SELECT run_id, outcome, error_code, partial FROM po2"

ORACLE["batch_summary"] = _ATT + """
SELECT batch_id, count(*) AS total, count(*) FILTER (WHERE outcome = 'result') AS collected,
       count(*) FILTER (WHERE outcome = 'failure') AS failed, count(*) FILTER (WHERE partial) AS partial,
       count(*) - count(*) FILTER (WHERE outcome = 'result') - count(*) FILTER (WHERE outcome = 'failure') AS skipped,
       CASE WHEN count(*) FILTER (WHERE outcome = 'failure') > 0 THEN 1 ELSE 0 END AS exit_code
FROM po2 GROUP BY batch_id
"""

ORACLE["incomplete_report"] = _ATT + f"""
, lines AS (
  SELECT run_id, 0 AS kind, view AS key, coalesce(view_error, '{NOT_COLLECTED}') AS reason FROM cut2 WHERE outcome NOT IN ('stored', 'kept')
  UNION ALL
  SELECT run_id, 1, '/home/user/Downloads/' || run_id || '.csv', 'a file landed outside the run''s folders' FROM runs WHERE len % 7 = 0)
SELECT run_id, CAST(row_number() OVER (PARTITION BY run_id ORDER BY kind, key) - 1 AS INTEGER) AS line_ord,
       CASE WHEN kind = 0 THEN key END AS view, CASE WHEN kind = 1 THEN key END AS path, reason
FROM lines JOIN po2 USING (run_id) WHERE outcome = 'result'
"""

_PHRASES = _DOCS + r"""
, l AS (SELECT doc_id, lines[i] AS phrase, i FROM (SELECT doc_id, lines, generate_subscripts(lines, 1) AS i FROM s WHERE doc_id % 50 <> 7)),
-- a stray 0x98 makes a file undecodable whatever its encoding was
kept AS (
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INTEGER) AS phrase_ord, phrase
  FROM l WHERE NOT regexp_full_match(phrase, '[\s\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{85}\x1c-\x1f]*'))
"""

ORACLE["phrase_list"] = _PHRASES + """
SELECT doc_id, phrase_ord, phrase, NULL AS error_code FROM kept
UNION ALL SELECT doc_id, NULL, NULL, 'INVALID_REQUEST' FROM documents WHERE doc_id % 50 = 7
"""

ORACLE["phrase_union"] = _PHRASES + """
SELECT doc_id // 8 AS batch_id, 0 AS source_ord, doc_id AS o1, CAST(0 AS BIGINT) AS o2, source AS phrase FROM documents
UNION ALL SELECT doc_id // 8, 1, doc_id, CAST(phrase_ord AS BIGINT), phrase FROM kept
"""

# ------------------------------------------------------------------ landing
_FILES = r"""
WITH f AS (
  SELECT page_id,
    CASE WHEN page_id % 10 = 7 THEN '/data/out/.downloads-a/../../../home/user/'
         ELSE (CASE page_id % 3 WHEN 0 THEN '/data/out/.downloads-a' WHEN 1 THEN '/data/out/runs/r1'
               ELSE '/home/user/Downloads' END) || '/' END
      || 'page-' || CAST(page_id AS VARCHAR)
      || CASE page_id % 4 WHEN 0 THEN '.csv' WHEN 1 THEN '.CSV' WHEN 2 THEN '.html' ELSE '.csv.crdownload' END AS path,
    CASE WHEN page_id % 10 = 7 THEN '/home/user/'
         ELSE (CASE page_id % 3 WHEN 0 THEN '/data/out/.downloads-a' WHEN 1 THEN '/data/out/runs/r1'
               ELSE '/home/user/Downloads' END) || '/' END
      || 'page-' || CAST(page_id AS VARCHAR)
      || CASE page_id % 4 WHEN 0 THEN '.csv' WHEN 1 THEN '.CSV' WHEN 2 THEN '.html' ELSE '.csv.crdownload' END AS norm_path,
    CAST(CASE WHEN page_id % 9 = 0 THEN 0 ELSE length(html) END AS BIGINT) AS length
  FROM pages),
g AS (
  SELECT *, lower(path) LIKE '%.csv' AS is_csv,
    starts_with(norm_path, '/data/out/.downloads-a/') OR starts_with(norm_path, '/data/out/runs/r1/') AS contained
  FROM f)
"""

ORACLE["landing_scan"] = _FILES + "SELECT page_id, path, is_csv, is_csv AND length > 0 AS accepted FROM g"

ORACLE["path_containment"] = _FILES + "SELECT page_id, norm_path, contained FROM g"

ORACLE["new_files"] = _FILES + """
SELECT page_id, norm_path FROM g
WHERE norm_path NOT IN (SELECT norm_path FROM g WHERE page_id % 5 = 0)
"""

ORACLE["download_verdict"] = _FILES + """
, t AS (
  SELECT page_id // 3 AS tick_id,
    count(*) FILTER (WHERE contained AND is_csv) AS n_csv,
    count(*) FILTER (WHERE contained AND is_csv AND length > 0) AS n_ready,
    count(*) FILTER (WHERE NOT contained) AS n_escaped
  FROM g GROUP BY 1),
v AS (
  SELECT *, CASE WHEN n_csv = 1 AND n_ready = 1 THEN 'ok' WHEN n_csv > 1 THEN 'too_many'
                 WHEN n_escaped > 0 THEN 'escaped' ELSE 'waiting' END AS verdict FROM t)
SELECT tick_id, n_csv, n_escaped, verdict, verdict = 'ok' AND n_escaped > 0 AS warning FROM v
"""

ORACLE["untrusted_empty"] = f"""
WITH p AS (
  SELECT page_id, {_VIEWS_CASE.format(x='page_id % 4')} AS view,
    CAST(CASE WHEN length(html) % 4 = 0 THEN 0 ELSE length(html) // 100 END AS BIGINT) AS row_count
  FROM pages)
SELECT page_id, view, row_count, view = 'dynamics' AND row_count = 0 AS untrusted FROM p
"""

ORACLE["quarantine"] = _SUPPLIERS + r"""
, b AS (
  SELECT block, any_value(hdr_kind) AS hdr_kind FROM s2 WHERE hdr_kind IS NOT NULL GROUP BY block)
SELECT 'supplier-' || CAST(block AS VARCHAR) AS export_id, 'supplier-' || CAST(block AS VARCHAR) || '.csv' AS file_name,
       'CSV_FORMAT' AS error_code,
       'supplier-' || CAST(block AS VARCHAR) || '.csv ' ||
         CASE hdr_kind WHEN 0 THEN 'has the same header twice' WHEN 1 THEN 'has a blank header'
              ELSE 'has a delimiter left inside a header' END AS error_message
FROM b
"""


ORACLE["typed_parquet_roundtrip"] = _SERIES_ALL + r"""
SELECT o.export_id, o.row_ord, o.label AS period, o.volume AS n,
       CAST(o.share_micro AS DOUBLE) / CAST(100000 AS DOUBLE) AS share
FROM o JOIN v ON o.export_id = v.export_id WHERE v.verdict IN ('ok', 'skipped')
"""

_DAMAGED = r"""
WITH c AS (
  SELECT c_custkey AS k, c_custkey % 12 AS kind, 'run-' || CAST(c_custkey AS VARCHAR) AS run_id,
         DATE '2026-06-01' + CAST(c_custkey % 20 AS INTEGER) AS day
  FROM customer),
t AS (
  SELECT *,
    CASE kind WHEN 8 THEN 'Дата' || chr(9) || 'Дата' || chr(9) || 'Доля' WHEN 9 THEN 'Дата' || chr(9) || ' ' || chr(9) || 'Доля'
              WHEN 10 THEN 'Дата' || chr(9) || 'Число;запросов' || chr(9) || 'Доля' ELSE 'Дата;Число запросов;Доля' END AS header,
    strftime(day, '%d.%m.%Y') || ';' || CASE WHEN kind = 7 THEN '99999999999999999999' ELSE CAST(k AS VARCHAR) END || ';0,5' || chr(10)
      || CASE WHEN kind = 2 THEN strftime(day + 1, '%Y-%m-%d') ELSE strftime(day + 1, '%d.%m.%Y') END || ';7;0,5' || chr(10)
      || strftime(day + CASE WHEN kind = 1 THEN 3 ELSE 2 END, '%d.%m.%Y') || ';8;0,5' || chr(10) AS rows
  FROM c),
x AS (
  SELECT *, encode(CASE WHEN kind = 11 THEN chr(10) WHEN kind IN (5, 6) THEN header || chr(10)
                        WHEN kind IN (8, 9, 10) THEN header || chr(10) || replace(rows, ';', chr(9)) ELSE header || chr(10) || rows END)
            || CASE WHEN kind = 6 THEN '\x98'::BLOB ELSE ''::BLOB END AS content,
    CASE kind WHEN 1 THEN 'gap' WHEN 2 THEN 'bad_date' WHEN 3 THEN 'before_window' WHEN 4 THEN 'after_window' WHEN 5 THEN 'empty'
              WHEN 6 THEN 'undecodable' WHEN 7 THEN 'overflow' WHEN 8 THEN 'duplicate_header' WHEN 9 THEN 'empty_header'
              WHEN 10 THEN 'unparsed_delimiter' WHEN 11 THEN 'no_header' END AS reason,
    CASE WHEN kind = 0 THEN NULL WHEN kind <= 5 THEN 'INTERFACE_CHANGED' WHEN kind = 7 THEN 'OVERFLOW' ELSE 'CSV_FORMAT' END AS error_code
  FROM t)
"""

ORACLE["stored_exports"] = _DAMAGED + r"""
SELECT run_id, CAST(i AS INTEGER) AS row_ord, strftime(day + CAST(i AS INTEGER), '%d.%m.%Y') AS period,
       CASE i WHEN 0 THEN k WHEN 1 THEN 7 ELSE 8 END AS n, CAST(0.5 AS DOUBLE) AS share
FROM x, (VALUES (0), (1), (2)) r(i) WHERE kind = 0
"""

ORACLE["quarantine_store"] = _DAMAGED + r"""
SELECT run_id, run_id || '.csv' AS file_name, error_code, reason, md5(content) AS content_md5, true AS has_message
FROM x WHERE kind <> 0
"""

ORACLE["raw_retention"] = _PART_CELLS + r"""
, lines AS (
  SELECT block, row_ord, string_agg(text, ';' ORDER BY col_ord) AS line FROM cells GROUP BY block, row_ord),
f AS (
  SELECT block, md5(chr(65279) || 'Артикул;Название;Размер;Цена;Скидка;Примечание' || chr(10) || string_agg(line, chr(10) ORDER BY row_ord) || chr(10)) AS m
  FROM lines GROUP BY block)
SELECT 'part-' || CAST(block AS VARCHAR) AS export_id, CASE WHEN block % 2 = 0 THEN 'regions.csv' END AS raw_file,
       CASE WHEN block % 2 = 0 THEN m END AS content_md5
FROM f
"""

ORACLE["file_scan"] = _SUPPLIERS + r"""
SELECT 'supplier-' || CAST(block AS VARCHAR) AS export_id, true AS accepted, true AS is_csv,
       CASE WHEN hdr_kind IS NULL THEN n_rows END AS row_count,
       CASE hdr_kind WHEN 0 THEN 'duplicate_header' WHEN 1 THEN 'empty_header' WHEN 2 THEN 'unparsed_delimiter' ELSE 'ok' END AS header_status
FROM ex
"""

ORACLE["manifest_roundtrip"] = _LOG + """
, e AS (
  SELECT run_id, string_agg(view || '/' || file || '/' || CASE WHEN seq = 2 THEN view || '.csv' ELSE '-' END || '/' || CAST(row_count AS VARCHAR)
                            || '/Запрос,Число запросов/string,int64', ' ' ORDER BY view_ord) AS exports,
         max(ts) AS updated_at, bool_or(view = 'dynamics') AS dynamics
  FROM (SELECT m.*, l.ts FROM merged m JOIN log l ON m.run_id = l.run_id AND m.view = l.view AND m.seq = l.seq) GROUP BY run_id),
s AS (
  SELECT rv.run_id,
    string_agg(CASE WHEN m.run_id IS NULL THEN rv.view END, ',' ORDER BY rv.view_ord) AS missing,
    string_agg(CASE WHEN m.row_count = 0 THEN rv.view END, ',' ORDER BY rv.view_ord) AS empty
  FROM rv LEFT JOIN merged m ON rv.run_id = m.run_id AND rv.view = m.view GROUP BY rv.run_id)
SELECT runs.run_id, phrase, region, 1787270400 + c_custkey * 60 AS created_at, e.updated_at,
       'https://reports.example/?run=' || CAST(c_custkey AS VARCHAR) AS source_url, coalesce(e.exports, '') AS exports, granularity,
       CASE WHEN granularity <> 'monthly' THEN '2026-06-01' END AS req_from, CASE WHEN granularity <> 'monthly' THEN '2026-07-31' END AS req_to,
       CASE WHEN e.dynamics THEN 'Дата' END AS act_field, CASE WHEN e.dynamics THEN '30.06.2026' END AS act_to, NULL AS error_code,
       coalesce(s.missing, '') AS missing, coalesce(s.empty, '') AS empty,
       CASE WHEN s.missing IS NOT NULL OR s.empty IS NOT NULL THEN 'incomplete' ELSE 'complete' END AS status
FROM runs JOIN s USING (run_id) LEFT JOIN e ON runs.run_id = e.run_id
"""

ORACLE["manifest_errors"] = """
SELECT c_custkey AS key, CASE WHEN k IN (1, 2, 3, 4, 5, 6, 8) THEN 'RESUME_MISMATCH' END AS error_code,
       CASE WHEN k = 7 THEN 'daily' WHEN k IN (0, 9) THEN 'monthly' END AS granularity,
       CASE WHEN k IN (0, 7, 9) THEN c_name END AS phrase, CASE WHEN k IN (0, 7, 9) THEN 1 END AS n_exports
FROM (SELECT *, c_custkey % 10 AS k FROM customer)
"""

ORACLE["stream_ingest_equals_batch"] = _SERIES_ALL + r"""
SELECT o.export_id, o.row_ord, o.label AS period, o.volume AS n,
       CAST(o.share_micro AS DOUBLE) / CAST(100000 AS DOUBLE) AS share, v.verdict
FROM o JOIN v ON o.export_id = v.export_id
WHERE o.granularity = 'daily' AND o.export_id NOT LIKE '%/%' AND v.verdict = 'ok'
"""

ORACLE["stream_all_exports"] = _SERIES_ALL + r"""
SELECT v.export_id, any_value(v.granularity) AS granularity, any_value(v.verdict) AS verdict, any_value(v.n) AS row_count,
       CASE WHEN any_value(v.verdict) IN ('ok', 'skipped') THEN count(o.label) END AS n_stored,
       CASE WHEN any_value(v.verdict) IN ('ok', 'skipped') THEN CAST(sum(o.volume) AS BIGINT) END AS volume
FROM v JOIN o ON o.export_id = v.export_id GROUP BY v.export_id
"""

_DAMAGED_SUPPLIERS = _DAMAGED.replace("c_custkey", "s_suppkey").replace("FROM customer", "FROM supplier")

ORACLE["stream_manifest"] = _DAMAGED_SUPPLIERS + r"""
SELECT run_id, CASE WHEN kind = 0 THEN 1 ELSE 0 END AS n_exports,
       CASE WHEN kind IN (0, 7) THEN 'ok' WHEN kind = 11 THEN NULL WHEN kind <= 5 THEN reason ELSE 'not_parsed' END AS verdict,
       CASE WHEN kind <> 11 THEN error_code END AS error_code,
       CASE WHEN kind = 0 THEN 'top_popular,top_related,regions' ELSE 'top_popular,top_related,dynamics,regions' END AS missing,
       'incomplete' AS status, true AS updated
FROM x
"""

ORACLE["late_tail"] = _DAMAGED_SUPPLIERS + r"""
SELECT run_id, CAST(CASE WHEN kind = 0 THEN 3 ELSE 1 END AS BIGINT) AS n_rows,
       strftime(CASE WHEN kind = 0 THEN day + 2 ELSE day END, '%d.%m.%Y') AS last, CAST(3 AS BIGINT) AS n_writes
FROM x WHERE kind IN (0, 1, 4)
"""

# ------------------------------------------------------------------ long cells and long files
def _orders_sql(repeats: int) -> str:
    """Records of orders as cells: a line break inside quotes is dropped, doubled quotes are single."""
    return f"""
WITH r AS (
  SELECT o_orderkey AS k, o_orderpriority AS priority, k % 13 = 0 AS blank, k % 11 = 0 AS short,
         'заказ; "' || k || '"' || CASE WHEN k % 3 = 0 THEN '' ELSE ' ' END || o_orderpriority
           || CASE WHEN k % 500 <> 0 THEN '' WHEN k % 1000 = 0 THEN repeat('чай "зелёный";', {repeats}) ELSE repeat('чай "чёрный";', {repeats}) END AS note,
         CAST(round(o_totalprice * 100) AS BIGINT) AS cents, strftime(o_orderdate, '%d.%m.%Y') AS full_day
  FROM orders),
c AS (
  SELECT k, priority, blank, CAST(k AS VARCHAR) AS number, note,
         CASE WHEN short THEN '' ELSE CAST(cents // 100 AS VARCHAR) || ',' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') END AS amount,
         CASE WHEN short THEN '' ELSE full_day END AS day
  FROM r)
"""


ORACLE["long_cells"] = _orders_sql(20_000) + """
, x AS (
  SELECT k, 0 AS part, '1' AS number, 'x' AS note, '3' AS day FROM c WHERE k % 500 = 0
  UNION ALL SELECT k, 1, number, note, day FROM c WHERE k % 500 = 0 AND NOT blank
  UNION ALL SELECT k, 2, '1', 'x', '3' FROM c WHERE k % 500 = 0)
SELECT CAST(k AS VARCHAR) AS file_name, ';' AS delimiter, CAST(row_number() OVER (PARTITION BY k ORDER BY part) - 1 AS INTEGER) AS row_ord,
       number, CAST(length(note) AS INTEGER) AS n_chars, md5(note) AS note_md5, day
FROM x
"""

ORACLE["long_file_ranges"] = _orders_sql(1_000) + """
SELECT priority, row_number() OVER (PARTITION BY priority ORDER BY k) - 1 AS row_ord, number, md5(note) AS note_md5, amount, day FROM c WHERE NOT blank
"""

ORACLE["long_file_profiles"] = _orders_sql(1_000) + """
SELECT priority, 'cp1251' AS encoding, ';' AS delimiter, 'Номер|Примечание|Сумма|Дата' AS headers, count(*) FILTER (NOT blank) AS row_count,
       CAST(NULL AS VARCHAR) AS error_code, 'int64,string,float64,string' AS types
FROM c GROUP BY priority
"""

ORACLE["series_checks_long"] = _DAMAGED + """
SELECT run_id, CASE WHEN kind IN (0, 7) THEN 'ok' WHEN kind <= 5 THEN reason ELSE 'not_parsed' END AS verdict,
       CASE WHEN kind BETWEEN 1 AND 5 THEN 'INTERFACE_CHANGED' END AS check_code,
       CASE WHEN kind IN (0, 1, 3, 4, 7) THEN strftime(day, '%Y-%m-%d') END AS series_first
FROM x
"""

# ------------------------------------------------------------------ attempts, run keys, snapshots, stored state
ORACLE["attempt_outcomes"] = """
WITH a AS (
  SELECT CAST(user_id AS VARCHAR) || '/' || strftime(ts, '%Y-%m') AS run_id, CASE WHEN user_id % 4 = 0 THEN 'regions' ELSE 'dynamics' END AS view, ts, event_id,
         CASE WHEN event_id % 7 = 3 THEN 'error' WHEN user_id % 4 = 0 OR event_type = 'purchase' THEN 'rows' ELSE 'empty' END AS kind
  FROM events),
e AS (
  SELECT *, count(*) FILTER (kind = 'empty') OVER (PARTITION BY run_id, view ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n_empty FROM a),
d AS (
  SELECT *, row_number() OVER (PARTITION BY run_id, view ORDER BY ts, event_id) AS n FROM e WHERE kind <> 'empty' OR n_empty = 2),
k AS (SELECT DISTINCT run_id, view FROM a)
SELECT k.run_id, k.view, CASE WHEN d.kind IS NULL THEN 'pending' WHEN d.kind = 'rows' THEN 'stored' ELSE 'failed' END AS outcome, d.event_id AS decided_at,
       CAST(coalesce(d.n_empty, 1) AS INTEGER) AS n_empty, CASE d.kind WHEN 'empty' THEN 'INTERFACE_CHANGED' WHEN 'error' THEN 'DOWNLOAD_TIMEOUT' END AS error_code
FROM k LEFT JOIN d ON k.run_id = d.run_id AND k.view = d.view AND d.n = 1
"""

ORACLE["run_key_gaps"] = """
WITH r AS (SELECT event_id AS ord, CASE WHEN event_type IN ('click', 'view') THEN 'груз' ELSE event_type END AS base FROM events),
k AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY ord) AS k FROM r),
t AS (SELECT o_orderkey AS n FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey >= 2),
f AS (
  SELECT i.n, row_number() OVER (ORDER BY i.n) AS k
  FROM (SELECT unnest(range(1, (SELECT count(*) FROM r) + (SELECT count(*) FROM t) + 1)) AS n) i ANTI JOIN t ON i.n = t.n)
SELECT ord, '20260821T100000Z-' || base || CASE WHEN number = 1 THEN '' ELSE '-' || CAST(number AS VARCHAR) END AS run_key, CAST(number AS INTEGER) AS collision_n
FROM (SELECT k.ord, k.base, CASE WHEN base = 'груз' THEN f.n ELSE k.k END AS number FROM k LEFT JOIN f ON k.k = f.k)
"""

ORACLE["landing_changes"] = """
WITH s AS (SELECT s_suppkey AS k, 'run-' || CAST(s_suppkey AS VARCHAR) AS run_id FROM supplier),
w AS (
  SELECT run_id, CASE WHEN k % 5 <> 0 THEN 4 * (length(run_id) + 3) END AS first, CASE WHEN k % 7 <> 0 THEN CASE WHEN k % 3 = 0 THEN 3 ELSE 4 END * (length(run_id) + 3) END AS second
  FROM s)
SELECT 1 AS snapshot, run_id, 'added' AS change, CAST(NULL AS BIGINT) AS length_before, CAST(first AS BIGINT) AS length FROM w WHERE first IS NOT NULL
UNION ALL
SELECT 2, run_id, CASE WHEN first IS NULL THEN 'added' WHEN second IS NULL THEN 'gone' ELSE 'changed' END, CAST(first AS BIGINT), CAST(second AS BIGINT)
FROM w WHERE first IS DISTINCT FROM second
"""

ORACLE["stream_too_large"] = """
SELECT 'run-' || CAST(s_suppkey AS VARCHAR) AS run_id, CASE WHEN big THEN NULL ELSE CAST(3 AS BIGINT) END AS row_count, CASE WHEN big THEN 'not_parsed' ELSE 'ok' END AS verdict,
       CASE WHEN big THEN 'CSV_FORMAT' END AS error_code, NOT big AS trusted, CASE WHEN big THEN 'too_large' END AS reason, CASE WHEN big THEN true END AS unread
FROM (SELECT s_suppkey, s_suppkey % 9 = 0 AS big FROM supplier)
"""

ORACLE["stored_manifests"] = _DAMAGED_SUPPLIERS + """
, n AS (
  SELECT w.wave, x.*, CASE WHEN w.wave = 2 AND kind = 0 THEN 3 WHEN w.wave >= 1 AND kind IN (0, 4) THEN 2 END AS n_rows
  FROM x, (VALUES (0), (1), (2)) w(wave))
SELECT wave, run_id, run_id AS phrase, coalesce('dynamics/dynamics_daily.parquet/' || CAST(n_rows AS VARCHAR), '') AS exports,
       strftime(day + n_rows - 1, '%d.%m.%Y') AS period_to, strftime(CASE WHEN kind = 3 THEN day + 1 ELSE day END, '%Y-%m-%d') AS requested_from,
       true AS updated, CAST(NULL AS VARCHAR) AS error_code
FROM n
"""

ORACLE["resume_state"] = """
WITH v AS (
  SELECT s_suppkey AS k, i AS view_ord, view
  FROM supplier, (VALUES (0, 'top_popular'), (1, 'top_related'), (2, 'dynamics'), (3, 'regions')) x(i, view)),
s AS (
  SELECT *, CASE WHEN view <> 'dynamics' OR k % 12 <> 0 THEN 'missing' WHEN k % 36 <> 0 THEN CASE WHEN k % 24 = 0 THEN 'stale' ELSE 'done' END
                 WHEN k % 24 = 0 THEN 'lost' ELSE 'unrecorded' END AS state
  FROM v)
SELECT 'run-' || CAST(k AS VARCHAR) AS run_id, CAST(view_ord AS INTEGER) AS view_ord, view, state, state <> 'done' AS pending FROM s
"""

ORACLE["download_outcomes"] = """
WITH f AS (
  SELECT *, CAST(user_id AS VARCHAR) || '/' || strftime(ts, '%Y-%m-%d') AS run_id,
         row_number() OVER (PARTITION BY user_id, strftime(ts, '%Y-%m-%d') ORDER BY ts, event_id) - 1 AS n FROM events),
s AS (SELECT run_id, event_id, event_type, n, unnest(range(n, 4)) AS tick FROM f WHERE n <= 3),
t AS (
  SELECT run_id, tick, count(*) FILTER (event_type NOT IN ('error', 'view')) AS csv, count(*) FILTER (event_type = 'error') AS escaped,
         count(*) FILTER (event_type NOT IN ('error', 'view') AND NOT (event_id % 4 = 0 AND tick = n)) AS ready,
         max(event_id) FILTER (event_type NOT IN ('error', 'view')) AS e
  FROM s WHERE n > 0 GROUP BY run_id, tick),
v AS (
  SELECT *, CASE WHEN csv = 1 AND ready = 1 THEN 'ok' WHEN csv > 1 THEN 'too_many' WHEN escaped > 0 THEN 'escaped' END AS verdict FROM t),
d AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY tick) AS k FROM v WHERE verdict IS NOT NULL)
SELECT r.run_id, coalesce(d.verdict, 'timeout') AS verdict, CAST(d.tick AS INTEGER) AS decided_at,
       CASE WHEN d.verdict = 'ok' THEN CAST(d.e AS VARCHAR) || CASE WHEN d.e % 2 = 0 THEN '.csv' ELSE '.CSV' END END AS file,
       coalesce(d.verdict = 'ok' AND d.escaped > 0, false) AS warning,
       CASE coalesce(d.verdict, 'timeout') WHEN 'ok' THEN NULL WHEN 'escaped' THEN 'DOWNLOAD_ESCAPED' ELSE 'DOWNLOAD_TIMEOUT' END AS error_code
FROM (SELECT DISTINCT run_id FROM f) r LEFT JOIN d ON r.run_id = d.run_id AND d.k = 1
"""
