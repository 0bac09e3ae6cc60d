"""Queries of sheet structure, over sheets that are made of the parts of a brand and type."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import sheets as S

from .inputs import given, plain
from .registry import query
from .shared import folder

CELLS = """WITH p AS (SELECT p_brand AS file, p_type AS sheet, CAST(row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) AS INT) AS n, CAST(count(*) OVER (PARTITION BY p_brand, p_type) AS INT) AS m, p_partkey, p_name, p_size, CAST(p_retailprice AS DECIMAL(18,2)) AS price FROM {part}),
c AS (SELECT DISTINCT file, sheet, 1 AS row, 1 AS col, CASE WHEN sheet = 'SMALL' THEN 'Title of the sheet' ELSE 'Parts by code' END AS value, 's' AS ctype FROM p
 UNION ALL SELECT DISTINCT file, sheet, 3, 1, 'Part', 's' FROM p WHERE m > 2 UNION ALL SELECT DISTINCT file, sheet, 3, 2, 'Name', 's' FROM p WHERE m > 2 UNION ALL SELECT DISTINCT file, sheet, 3, 3, 'Size', 's' FROM p WHERE m > 2
 UNION ALL SELECT DISTINCT file, sheet, 3, 4, 'Cost', 's' FROM p WHERE m > 2 UNION ALL SELECT DISTINCT file, sheet, 3, 5, 'Cost', 's' FROM p WHERE m > 2
 UNION ALL SELECT DISTINCT file, sheet, 4, 4, '2023/24', 's' FROM p WHERE m > 2 UNION ALL SELECT DISTINCT file, sheet, 4, 5, '2023/24', 's' FROM p WHERE m > 2
 UNION ALL SELECT file, sheet, n + 4, 1, concat('P', p_partkey % 900), 's' FROM p UNION ALL SELECT file, sheet, n + 4, 2, p_name, 's' FROM p
 UNION ALL SELECT file, sheet, n + 4, 3, CASE WHEN p_size % 10 = 0 THEN '*' ELSE concat(p_size, '') END, CASE WHEN p_size % 10 = 0 THEN 's' ELSE 'n' END FROM p
 UNION ALL SELECT file, sheet, n + 4, 4, concat(price, ''), 'n' FROM p UNION ALL SELECT file, sheet, n + 4, 5, concat(p_size * 3, ''), 'n' FROM p WHERE n > 1
 UNION ALL SELECT file, sheet, n + 4, 7, concat(p_size + 1, ''), 'n' FROM p WHERE n % 2 = 0
 UNION ALL SELECT DISTINCT file, sheet, m + 6, 1, 'Note: figures are provisional', 's' FROM p)
SELECT file, sheet, row, col, value, ctype FROM c"""
SQL = plain(CELLS)


def stored(df, name):
    """`df` as a stored table: sheets are read many times.

    Spark takes a table's size on disk for its size in memory. Repeated texts would shrink to a hundredth there and be broadcast, so they're written as they are.
    """
    path = folder(df.sparkSession, name)
    df.write.option("compression", "none").option("parquet.enable.dictionary", "false").parquet(path)
    return df.sparkSession.read.parquet(path)


def cells(spark, d):
    return stored(S.classified(given(spark, d, CELLS)), "cells")


MARKS = ", ".join(f"'{m}'" for m in S.SHEET_MARKERS)
UNIT = S.clean.UNIT
CLASS = f"""CASE WHEN lower(trim(value)) IN ({MARKS}) THEN 'suppressed' WHEN regexp_matches(lower(trim(value)), '{UNIT}') THEN 'unit' WHEN regexp_matches(trim(value), '^((19|20)\\d{{2}}|\\d{{4}}[-/]\\d{{2,4}})$') THEN 'year'
WHEN regexp_matches(trim(value), '(?i)^[QH][1-4]$') THEN 'period' WHEN try_cast(regexp_replace(trim(value), '[,£$%]', '', 'g') AS DOUBLE) IS NOT NULL THEN 'number' ELSE 'text' END"""
ROWS = f"""SELECT *, (year >= 2 AND number = 0) OR period >= 2 OR unit >= 2 OR (number = 0 AND texts >= 2) AS is_header, number >= 2 AS is_data FROM (
SELECT file, sheet, row, count(*) AS filled, {', '.join(f"count(*) FILTER (k = '{k}') AS {n}" for k, n in (('unit', 'unit'), ('year', 'year'), ('period', 'period'), ('number', 'number'), ('text', 'texts')))}, coalesce(max(value) FILTER (col = 1), '') AS a FROM (SELECT *, {CLASS} AS k FROM ({SQL}) WHERE row <= 29) GROUP BY ALL)
WHERE filled >= 2 AND NOT regexp_matches(lower(a), '^(table|this|note)')"""
HEADERS = f"""SELECT f.file, f.sheet, first_header, coalesce((SELECT min(r.row) FROM ({ROWS}) r WHERE r.file = f.file AND r.sheet = f.sheet AND r.is_data AND NOT r.is_header AND r.row > f.first_header) - 1, first_header) AS last_header FROM (SELECT file, sheet, min(row) AS first_header FROM ({ROWS}) WHERE is_header GROUP BY ALL) f"""
STARTS = f"""SELECT h.file, h.sheet, first_header, last_header, coalesce(min(r.row) FILTER (number >= 2 OR (filled >= 3 AND number >= 1)), any_value(last_header) + 1) AS data_start FROM ({HEADERS}) h LEFT JOIN (SELECT file, sheet, row, count(*) AS filled, count(*) FILTER ({CLASS} = 'number') AS number FROM ({SQL}) GROUP BY ALL) r
ON r.file = h.file AND r.sheet = h.sheet AND r.row > last_header AND r.row <= last_header + 5 GROUP BY h.file, h.sheet, first_header, last_header"""
ENDS = f"""WITH s AS MATERIALIZED ({STARTS}), r AS (SELECT c.file, c.sheet, s.data_start, c.row, bool_or(regexp_matches(lower(trim(value)), '{S.STOP}')) AS stops FROM ({SQL}) c JOIN s ON c.file = s.file AND c.sheet = s.sheet WHERE c.row >= s.data_start AND c.col <= 5 GROUP BY ALL),
g AS (SELECT *, row - lag(row) OVER (PARTITION BY file, sheet ORDER BY row) AS gap FROM r), b AS (SELECT file, sheet, min(row) FILTER (stops OR gap >= 6) AS breaks FROM g GROUP BY ALL), e AS (SELECT r.file, r.sheet, max(r.row) AS data_end FROM r JOIN b ON r.file = b.file AND r.sheet = b.sheet WHERE breaks IS NULL OR r.row < breaks GROUP BY ALL)
SELECT s.*, coalesce(e.data_end, s.data_start - 1) AS data_end FROM s LEFT JOIN e ON s.file = e.file AND s.sheet = e.sheet"""
NAMES = f"""WITH s AS MATERIALIZED ({STARTS}), n AS (SELECT c.*, s.first_header, s.last_header, s.data_start FROM ({SQL}) c JOIN s ON c.file = s.file AND c.sheet = s.sheet WHERE c.col <= 500 AND c.row >= s.first_header),
h AS (SELECT file, sheet, col, list(trim(value) ORDER BY row) AS t FROM n WHERE row <= last_header GROUP BY ALL), f AS (SELECT DISTINCT file, sheet, col FROM n WHERE row >= data_start AND row < data_start + 5),
b AS (SELECT coalesce(h.file, f.file) AS file, coalesce(h.sheet, f.sheet) AS sheet, coalesce(h.col, f.col) AS col, list_filter(coalesce(t, []), lambda v, i: i = 1 OR v <> t[i - 1]) AS t FROM h FULL JOIN f ON h.file = f.file AND h.sheet = f.sheet AND h.col = f.col),
w AS (SELECT *, trim(regexp_replace(lower(CASE WHEN len(t) > 0 THEN array_to_string(t, '_') ELSE 'column_' || chr(64 + col) END), '[^a-z0-9]+', '_', 'g'), '_') AS w FROM b),
q AS (SELECT *, CASE WHEN w IN ({', '.join(f"'{x}'" for x in S.names.RESERVED_IN_SHEETS)}) THEN w || '_val' ELSE w END AS q, row_number() OVER (PARTITION BY file, sheet, w ORDER BY col) - 1 AS k FROM w)
SELECT file, sheet, col, array_to_string(t, '|') AS headers, CASE WHEN k > 0 THEN q || '_' || k ELSE q END AS name FROM q"""


@query(f"""WITH c AS MATERIALIZED ({SQL}), m AS (SELECT DISTINCT file, sheet FROM c WHERE sheet = 'ECONOMY'), x AS (SELECT m.file, m.sheet, coalesce(any_value(c.value), '') AS anchor FROM m LEFT JOIN c ON c.file = m.file AND c.sheet = m.sheet AND c.row = 3 AND c.col = 4 GROUP BY ALL),
s AS (SELECT file, sheet, anchor, 3 AS row, unnest([4, 5, 6]) AS col FROM x)
SELECT coalesce(c.file, s.file) AS file, coalesce(c.sheet, s.sheet) AS sheet, coalesce(c.row, s.row) AS row, coalesce(c.col, s.col) AS col, CASE WHEN s.file IS NOT NULL THEN s.anchor ELSE trim(c.value) END AS value, s.file IS NOT NULL AS is_merged
FROM c FULL JOIN s ON c.file = s.file AND c.sheet = s.sheet AND c.row = s.row AND c.col = s.col""")
def c01_merged_cells(spark, d):
    all_cells = cells(spark, d)
    merges = all_cells.where("sheet = 'ECONOMY'").select("file", "sheet").distinct().selectExpr("file", "sheet", "3 first_row", "3 last_row", "4 first_col", "6 last_col")
    return S.resolved(all_cells, merges).drop("ctype")


KINDS = f"""WITH c AS ({SQL}), z AS (SELECT file, sheet, max(row) AS max_row, max(col) AS max_col, max(lower(value)) FILTER (row = 1 AND col = 1) AS a1 FROM c GROUP BY ALL), r AS (SELECT file, sheet, row, count(*) AS n FROM c WHERE row <= 29 AND col <= 19 GROUP BY ALL), k AS (SELECT file, sheet, count(*) FILTER (n >= 3) AS multi, count(*) FILTER (n = 1) AS single FROM r GROUP BY ALL)
SELECT z.file, z.sheet, CASE WHEN max_row < 2 OR max_col < 2 THEN 'EMPTY' WHEN multi >= 3 THEN 'TABULAR' WHEN regexp_matches(a1, '{S.ABOUT}') AND multi < 2 THEN 'METADATA' WHEN single > 2 * multi AND multi < 3 THEN 'METADATA' WHEN multi >= 2 THEN 'TABULAR' ELSE 'METADATA' END AS kind, max_row, max_col FROM z JOIN k ON z.file = k.file AND z.sheet = k.sheet"""


@query(f"SELECT file, sheet, kind FROM ({KINDS})")
def c02_sheet_kinds(spark, d):
    return S.sheet_kinds(cells(spark, d)).select("file", "sheet", "kind")


@query(HEADERS)
def c03_header_rows(spark, d):
    return S.header_rows(cells(spark, d))


@query(STARTS)
def c04_data_starts(spark, d):
    c = cells(spark, d)
    return S.data_starts(c, S.header_rows(c))


def extents(spark, d):
    c = cells(spark, d)
    starts = stored(S.data_starts(c, S.header_rows(c)), "starts")
    return c, starts, stored(S.data_ends(c, starts), "extents")


@query(ENDS)
def c05_data_ends(spark, d):
    return extents(spark, d)[2]


@query(NAMES)
def c06_column_names(spark, d):
    c, starts, _ = extents(spark, d)
    return S.column_names(c, starts)


@query(f"""WITH e AS MATERIALIZED ({ENDS}), n AS MATERIALIZED ({NAMES}), v AS (SELECT c.*, row_number() OVER (PARTITION BY c.file, c.sheet, c.col ORDER BY c.row) AS k FROM ({SQL}) c JOIN e ON c.file = e.file AND c.sheet = e.sheet WHERE c.row BETWEEN e.data_start AND e.data_end),
s AS (SELECT file, sheet, col, avg(CASE WHEN {CLASS.replace("'suppressed'", "'text'")} = 'number' THEN 0 ELSE 1 END) AS texts FROM v WHERE k <= 10 GROUP BY ALL),
j AS (SELECT n.*, CASE WHEN regexp_matches(lower(headers), '{S.NO_ID}') THEN false WHEN regexp_matches(lower(headers), '{S.ID}') THEN true ELSE coalesce(texts > 0.7, false) END AS is_id FROM n LEFT JOIN s ON n.file = s.file AND n.sheet = s.sheet AND n.col = s.col)
SELECT file, sheet, col, name, is_id OR (NOT bool_or(is_id) OVER (PARTITION BY file, sheet) AND col = min(col) OVER (PARTITION BY file, sheet)) AS is_id FROM j""")
def c07_id_columns(spark, d):
    c, starts, ends = extents(spark, d)
    return S.id_columns(c, ends, S.column_names(c, starts))


NUMBER = "CASE WHEN NOT regexp_matches(value, ' - | to ') THEN try_cast(regexp_replace(value, '[,£$%]', '', 'g') AS DOUBLE) END"


@query(f"""WITH e AS MATERIALIZED ({ENDS}), n AS MATERIALIZED ({NAMES}), v AS (SELECT c.*, lower(trim(value)) IN ({MARKS}) AS marked, {NUMBER} AS number FROM ({SQL}) c JOIN e ON c.file = e.file AND c.sheet = e.sheet WHERE c.row BETWEEN e.data_start AND e.data_end),
o AS (SELECT *, number = floor(number) AS whole, NOT marked AND row_number() OVER (PARTITION BY file, sheet, col, marked ORDER BY row) <= 25 AS sample, row_number() OVER (PARTITION BY file, sheet, col ORDER BY row) AS k FROM v),
g AS (SELECT file, sheet, col, bool_or(ctype IN ('n', 'd')) AS has_n, bool_or(ctype = 's') AS has_s, coalesce(bool_or(ctype = 'n' AND NOT whole), false) AS has_fraction, bool_or(marked AND k <= 100) AS has_mark, count(*) FILTER (sample) AS sampled, count(number) FILTER (sample) AS numeric,
 count(*) FILTER (sample AND whole) AS wholes, max(number) FILTER (sample) AS most, max(length(value)) FILTER (sample) AS longest FROM o GROUP BY ALL)
SELECT n.file, n.sheet, n.col, n.name, CASE WHEN has_n AND has_s THEN 'VARCHAR(255)' WHEN has_n AND has_fraction THEN 'DOUBLE PRECISION' WHEN has_mark OR regexp_matches(name, 'date|month|year|quarter|period|name|description|category|group|trust|type') THEN 'VARCHAR(255)' WHEN regexp_matches(name, 'code|org|ics|nhse') THEN 'VARCHAR(20)'
 WHEN wholes > 0.7 * sampled AND wholes = numeric THEN CASE WHEN most > 2147483647 THEN 'BIGINT' ELSE 'INTEGER' END WHEN numeric > 0.7 * sampled AND regexp_matches(name, 'percent|rate') THEN 'NUMERIC(10,4)' WHEN numeric > 0.7 * sampled AND regexp_matches(name, '000|cost|budget') THEN 'NUMERIC(18,2)'
 WHEN numeric > 0.7 * sampled THEN 'DOUBLE PRECISION' WHEN coalesce(longest, 0) <= 100 THEN 'VARCHAR(255)' ELSE 'TEXT' END AS stored_type FROM n LEFT JOIN g ON n.file = g.file AND n.sheet = g.sheet AND n.col = g.col""")
def c08_c09_column_types(spark, d):
    c, starts, ends = extents(spark, d)
    return S.column_types(c, ends, S.column_names(c, starts))


FIRST = f"""WITH e AS MATERIALIZED ({ENDS}), v AS (SELECT c.*, row_number() OVER (PARTITION BY c.file, c.sheet ORDER BY c.row) AS k FROM ({SQL}) c JOIN e ON c.file = e.file AND c.sheet = e.sheet WHERE c.row BETWEEN e.data_start AND e.data_end AND c.col = 1),
s AS (SELECT file, sheet, avg(CASE WHEN regexp_matches(trim(value), '^[A-Z0-9]{{2,5}}$') THEN 1 ELSE 0 END) AS org FROM v WHERE k <= 10 GROUP BY ALL)
SELECT e.file, e.sheet, CASE WHEN org IS NULL THEN 'UNKNOWN' WHEN org > 0.5 THEN 'ORG_CODE' ELSE 'CATEGORY' END AS first_column FROM e LEFT JOIN s ON e.file = s.file AND e.sheet = s.sheet"""


@query(FIRST)
def c10_first_column(spark, d):
    c, _, ends = extents(spark, d)
    return S.first_column_kinds(c, ends)


ORIENTED = f"""WITH s AS MATERIALIZED ({STARTS}) SELECT s.file, s.sheet, CASE WHEN count(DISTINCT c.col) >= 3 THEN 'HORIZONTAL' ELSE 'VERTICAL' END AS orientation FROM s LEFT JOIN ({SQL}) c ON c.file = s.file AND c.sheet = s.sheet AND c.row BETWEEN first_header AND last_header AND c.col BETWEEN 3 AND 14 AND regexp_matches(c.value, '^\\d{{4}}[-/]\\d{{2,4}}$') GROUP BY s.file, s.sheet"""


@query(ORIENTED)
def c11_orientation(spark, d):
    c, starts, _ = extents(spark, d)
    return S.orientations(c, starts)


EXTRACTED = f"""WITH e AS MATERIALIZED ({ENDS}), n AS MATERIALIZED ({NAMES}), v AS (SELECT c.* FROM ({SQL}) c JOIN e ON c.file = e.file AND c.sheet = e.sheet WHERE c.row BETWEEN e.data_start AND LIMIT_ROW)
SELECT v.file, v.sheet, v.row, n.name, CASE WHEN lower(trim(v.value)) NOT IN ({MARKS}) THEN v.value END AS value FROM v JOIN n ON v.file = n.file AND v.sheet = n.sheet AND v.col = n.col WHERE EXISTS (SELECT 1 FROM v x WHERE x.file = v.file AND x.sheet = v.sheet AND x.row = v.row AND x.col <= 5)"""


@query(EXTRACTED.replace("LIMIT_ROW", "e.data_end"))
def c12_extracted_rows(spark, d):
    c, starts, ends = extents(spark, d)
    return S.extracted(c, ends, S.column_names(c, starts))


@query(EXTRACTED.replace("LIMIT_ROW", "least(e.data_end, e.data_start + 2)"))
def c13_preview(spark, d):
    c, starts, ends = extents(spark, d)
    return S.preview(c, ends, S.column_names(c, starts))


@query(f"""WITH e AS MATERIALIZED ({ENDS}), z AS MATERIALIZED ({KINDS}), f AS MATERIALIZED ({FIRST}), o AS MATERIALIZED ({ORIENTED}), n AS (SELECT file, sheet, count(*) AS n_columns FROM ({NAMES}) GROUP BY ALL)
SELECT z.file, z.sheet, CASE WHEN kind = 'TABULAR' AND first_header IS NULL THEN 'UNRECOGNISED' ELSE kind END AS kind, max_row, max_col, first_header, last_header, data_start, data_end, first_column, orientation, n_columns, kind = 'TABULAR' AND first_header IS NOT NULL AS is_valid, CAST(data_end - data_start + 1 AS INT) AS n_rows
FROM z LEFT JOIN e ON z.file = e.file AND z.sheet = e.sheet LEFT JOIN f ON z.file = f.file AND z.sheet = f.sheet LEFT JOIN o ON z.file = o.file AND z.sheet = o.sheet LEFT JOIN n ON z.file = n.file AND z.sheet = n.sheet""")
def c15_structures(spark, d):
    return S.structures(cells(spark, d)).withColumn("n_rows", F.col("n_rows").cast("int"))
