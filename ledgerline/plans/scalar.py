"""Queries of the scalar functions: names, periods, values."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions import clean, names, periods

from .inputs import CODES, FILES, HEADERS, PERIOD_TEXTS, PERIODS, VALUES, given, plain, settled
from .registry import query

QUOTED = ", ".join(f"'{w}'" for w in names.RESERVED)
QUOTED_SHEETS = ", ".join(f"'{w}'" for w in names.RESERVED_IN_SHEETS)
SHORT, LONG = names.SHORT, names.LONG
MARKED = ", ".join(f"'{m}'" for m in clean.MARKERS)
WORD = "trim(regexp_replace(regexp_replace(lower(h), '[£$€%]', '', 'g'), '[^a-z0-9]+', '_', 'g'), '_')"


def named_sql(reserved: str) -> str:
    return f"CASE WHEN w = '' THEN 'col_unnamed' ELSE substr(CASE WHEN w IN ({reserved}) THEN w || '_val' WHEN regexp_matches(w, '^[0-9]') THEN 'col_' || w ELSE w END, 1, 63) END"


@query(f"SELECT h, {named_sql(QUOTED)} AS name FROM (SELECT h, {WORD} AS w FROM ({plain(HEADERS)}))")
def d01_schema_name(spark, d):
    return given(spark, d, HEADERS).select("h", names.schema_name(F.col("h")).alias("name"))


@query(f"SELECT h, {named_sql(QUOTED_SHEETS)} AS name FROM (SELECT h, {WORD} AS w FROM ({plain(HEADERS)}))")
def d02_sheet_name(spark, d):
    return given(spark, d, HEADERS).select("h", names.sheet_name(F.col("h")).alias("name"))


@query(f"""WITH n AS (SELECT h, {named_sql(QUOTED)} AS name FROM (SELECT h, {WORD} AS w FROM ({plain(HEADERS)}))),
r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY h) AS ordinal, first_value(h) OVER (PARTITION BY name ORDER BY h) AS first_header FROM n)
SELECT h, name, CASE WHEN ordinal > 1 THEN name || '_' || ordinal ELSE name END AS column_name, first_header FROM r""")
def d03_column_mapping(spark, d):
    named = given(spark, d, HEADERS).select("h", names.schema_name(F.col("h")).alias("name"))
    return names.numbered(named, "name", "h", []).select("h", "name", "column_name", "first_header")


@query(f"""SELECT h, regexp_full_match(h, '[a-z_][a-z0-9_]*') AND length(h) <= 63 AS valid,
regexp_matches(h, '^col(umn)?_[0-9a-z]{{1,2}}$') OR length(h) < 3 OR regexp_matches(h, '^[0-9]+$') AS generic FROM ({plain(HEADERS)} UNION ALL SELECT 'col_1' AS h UNION ALL SELECT '12')""")
def d04_validate_name(spark, d):
    rows = given(spark, d, HEADERS + " UNION ALL SELECT 'col_1' AS h UNION ALL SELECT '12'")
    return rows.select("h", names.valid_name(F.col("h")).alias("valid"), names.generic_name(F.col("h")).alias("generic"))


@query(f"SELECT h, CASE WHEN w <> '' THEN substr(w, 1, 60) END AS name FROM (SELECT h, {WORD} AS w FROM ({plain(HEADERS)}))")
def d05_strict_name(spark, d):
    return given(spark, d, HEADERS).select("h", names.strict_name(F.col("h")).alias("name"))


@query(f"SELECT h, trim(regexp_replace(lower(h), '[^a-z0-9]+', '_', 'g'), '_') AS name FROM ({plain(HEADERS)})")
def d06_matching_name(spark, d):
    return given(spark, d, HEADERS).select("h", names.matching_name(F.col("h")).alias("name"))


@query(f"""WITH p AS (SELECT h, regexp_replace(trim(h), '\\s*-\\s*$', '') AS q FROM ({plain(HEADERS)})), s AS (SELECT h, q, string_split(q, ' ') AS w FROM p)
SELECT h, CASE WHEN len(w) >= 3 AND len(list_distinct(w)) * 2 < len(w) THEN array_to_string(list_filter(w, lambda x, i: list_position(w, x) = i), ' ') ELSE q END AS name FROM s""")
def d07_deduplicated_words(spark, d):
    return given(spark, d, HEADERS).select("h", names.deduplicated_words(F.col("h")).alias("name"))


UNDATED = f"""(SELECT code, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(code, '(?i)_({SHORT})\\d{{2,4}}', '', 'g'), '_?\\d{{4}}[-_]\\d{{2}}', '', 'g'), '_?20\\d{{2}}', '', 'g'), '(?i)_({LONG})', '', 'g'), '(?i)_({SHORT})', '', 'g'), '(?i)_?q[1-4]', '', 'g') AS s FROM ({plain(CODES)}))"""
CANONICAL = f"SELECT code, trim(regexp_replace(array_to_string(list_filter(string_split(s, '_'), lambda x, i: i = 1 OR NOT (regexp_full_match(x, '\\d{{2}}') OR regexp_full_match(x, '0?[1-9]') OR regexp_full_match(x, '1[0-2]'))), '_'), '_+', '_', 'g'), '_') AS canonical FROM {UNDATED}"


@query(f"SELECT code, canonical, CASE WHEN canonical = code THEN 'tbl_' || code ELSE 'tbl_' || canonical END AS table_name FROM ({CANONICAL})")
def d08_canonical_code(spark, d):
    code = F.col("code")
    return given(spark, d, CODES).select("code", names.undated_code(code).alias("canonical"), names.canonical_table(code, F.concat(F.lit("tbl_"), code)).alias("table_name"))


SHORTENED = """trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
 trim(regexp_replace(regexp_replace(lower(replace(regexp_replace({0}, '(.)\\.[^.]*$', '\\1'), '%20', '_')), '[^a-z0-9_]', '_', 'g'), '_+', '_', 'g'), '_'),
 '_({1})_\\d{{2,4}}', '', 'g'), '_({2})_\\d{{2,4}}', '', 'g'), '_\\d{{4}}(_|$)', '_', 'g'), '_({1})(_|$)', '_', 'g'), '_+', '_', 'g'), '_')"""


def shortened_sql(name: str) -> str:
    body = SHORTENED.format(name, SHORT, LONG)
    return f"""CASE WHEN length(k) > 40 THEN rtrim(substr(k, 1, 40), '_') ELSE k END FROM (SELECT *, CASE WHEN len(g) > 3 THEN array_to_string(list_slice(g, -3, -1), '_') ELSE b END AS k
FROM (SELECT *, list_filter(string_split(b, '_'), lambda x: length(x) > 2) AS g FROM (SELECT url, {body} AS b FROM ({plain(FILES)}))))"""


@query(f"SELECT url, {shortened_sql("regexp_extract(url, '([^/]*)$', 1)")}".replace("FROM (SELECT *, CASE", "AS code FROM (SELECT *, CASE", 1))
def d09_short_code(spark, d):
    return given(spark, d, FILES).select("url", names.short_code(F.col("url")).alias("code"))


STABLE = [("regexp_replace(rtrim(url, '/'), '^.*/', '')", None)]


def stable_sql() -> str:
    e = "replace(regexp_extract(rtrim(url, '/'), '([^/]*)$', 1), '%20', ' ')"
    steps = [(r"(?i)\bOnline\s+Consultation\b", "OC"), (rf"(?i)\b({SHORT})\d{{2,4}}\b", "PERIOD"), (rf"(?i)\b({LONG})\s*\d{{2,4}}\b", "PERIOD"), (rf"(?i)\b({LONG})\b", "MONTH"), (rf"(?i)\b({SHORT})\b", "MONTH"), (r"\b20\d{2}\b", "YEAR"), (r"[-_\s]MONTH[-_\s]?YEAR", "-PERIOD"), (r"MONTH[-_\s]?YEAR", "PERIOD"), (r"-\d{5,6}\.", "-FILEID."), (r"(?i)-(revised|corrected|updated|final)\.", "-FILEID."), (r"-[A-Za-z0-9]{5,7}\.", "-FILEID."), (r"\s+", " "), ("-+", "-")]
    for pattern, by in steps:
        e = f"regexp_replace({e}, '{pattern}', '{by}', 'g')"
    return f"trim({e})"


@query(f"SELECT url, {stable_sql()} AS pattern FROM ({plain(FILES)})")
def d10_stable_url(spark, d):
    return given(spark, d, FILES).select("url", names.stable_url(F.col("url")).alias("pattern"))


DATE_HEADER = rf"^(({SHORT})[-_\s]?\d{{2,4}}|({LONG})[-_\s]?\d{{4}}|(janaury|febuary|feburary)[-_\s]?\d{{4}}|\d{{4}}[-_](0?[1-9]|1[0-2])|q[1-4][-_\s]?\d{{2,4}}|\d{{2,4}}[-/]\d{{2,4}})"


@query(f"SELECT h, regexp_matches(trim(lower(h)), '{DATE_HEADER}') AS is_date FROM ({plain(HEADERS)})")
def d11_date_header(spark, d):
    return given(spark, d, HEADERS).select("h", names.is_date_header(F.col("h")).alias("is_date"))


DOMAINS = [("widget|bolt", "Hardware"), ("src1", "Sources"), ("historic", "Archive")]


@query(f"""SELECT code, CASE WHEN regexp_matches(lower(code), 'widget|bolt') THEN 'Hardware' WHEN regexp_matches(lower(code), 'src1') THEN 'Sources' WHEN regexp_matches(lower(code), 'historic') THEN 'Archive' ELSE 'Other' END AS domain,
array_to_string(list_slice(list_filter(string_split(code, '_'), lambda w: length(w) > 2 AND w NOT IN ('the', 'and', 'for', 'data', 'summary')), 1, 5), ',') AS tags FROM ({plain(CODES)})""")
def d12_domain_and_tags(spark, d):
    code = F.col("code")
    return given(spark, d, CODES).select("code", names.domain(code, DOMAINS).alias("domain"), F.array_join(names.tags(code), ",").alias("tags"))


@query(f"SELECT v, CASE WHEN lower(trim(v)) NOT IN ({MARKED}) THEN v END AS kept FROM ({plain(VALUES).replace('STRING', 'VARCHAR')})")
def d13_suppress(spark, d):
    return clean.suppress(given(spark, d, VALUES).withColumn("kept", F.col("v")).withColumnRenamed("v", "_v")).withColumnRenamed("_v", "v")


@query("SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS l_quantity, l_discount FROM lineitem")
def d14_whole_numbers(spark, d):
    return clean.whole_numbers(given(spark, d, "SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM {lineitem}"))


PRESENT = f"CASE WHEN upper(trim(v)) NOT IN ('', 'N/A', 'NA', 'NULL', 'NONE', '-') AND lower(trim(v)) NOT IN ({MARKED}) THEN trim(v) END"
DAY = """COALESCE(CASE WHEN length(p) = 10 THEN try_strptime(p, '%Y-%m-%d') END, CASE WHEN length(p) = 10 THEN try_strptime(p, '%d/%m/%Y') END, CASE WHEN length(p) = 10 THEN try_strptime(p, '%m/%d/%Y') END,
CASE WHEN length(p) = 8 AND regexp_full_match(p, '[0-9]{8}') THEN try_strptime(p, '%Y%m%d') END, CASE WHEN regexp_full_match(p, '(?i)[a-z]{3}[0-9]{4}') THEN try_strptime('01' || p, '%d%b%Y') END)"""
SQL_VALUES = plain(VALUES).replace("STRING", "VARCHAR")


@query(f"SELECT v, CAST({DAY} AS DATE) AS day FROM (SELECT v, {PRESENT} AS p FROM ({SQL_VALUES}))")
def d15_d19_to_date(spark, d):
    return given(spark, d, VALUES).select("v", clean.to_date(F.col("v")).alias("day"))


@query(f"SELECT v, upper(trim(v)) IN ('', 'N/A', 'NA', 'NULL', 'NONE', '-') AS absent, CASE WHEN upper(trim(v)) NOT IN ('', 'N/A', 'NA', 'NULL', 'NONE', '-') THEN trim(v) END AS text_value FROM ({SQL_VALUES})")
def d16_text_value(spark, d):
    return given(spark, d, VALUES).select("v", clean.is_absent(F.col("v")).alias("absent"), clean.to_text(F.col("v")).alias("text_value"))


@query(f"SELECT v, CAST(trunc(try_cast(replace({PRESENT}, ',', '') AS DOUBLE)) AS BIGINT) AS whole FROM ({SQL_VALUES})")
def d17_to_integer(spark, d):
    return given(spark, d, VALUES).select("v", clean.to_integer(F.col("v")).alias("whole"))


@query(f"SELECT v, try_cast(regexp_replace({PRESENT}, '[,%]', '', 'g') AS DOUBLE) AS number FROM ({SQL_VALUES})")
def d18_to_float(spark, d):
    return given(spark, d, VALUES).select("v", clean.to_float(F.col("v")).alias("number"))


@query(f"SELECT v, CASE WHEN lower(trim(v)) IN ('yes', 'y', 'true', 't', '1') THEN true WHEN lower(trim(v)) IN ('no', 'n', 'false', 'f', '0') THEN false END AS flag, CAST(trunc(try_cast(replace({PRESENT}, ',', '') AS DOUBLE)) AS BIGINT) AS as_integer FROM ({SQL_VALUES})")
def d20_to_boolean(spark, d):
    return given(spark, d, VALUES).select("v", clean.to_boolean(F.col("v")).alias("flag"), clean.to_type(F.col("v"), "INTEGER").alias("as_integer"))


@query("""SELECT * FROM (VALUES ('p_partkey', 'BIGINT'), ('p_size', 'INTEGER'), ('p_retailprice', 'NUMERIC(18,6)')) t(column_name, stored_type)
UNION ALL SELECT c, CASE WHEN n <= 50 THEN 'VARCHAR(50)' WHEN n <= 255 THEN 'VARCHAR(255)' ELSE 'TEXT' END FROM (SELECT 'p_name' AS c, max(length(p_name)) AS n FROM part UNION ALL SELECT 'p_brand', max(length(p_brand)) FROM part UNION ALL SELECT 'p_type', max(length(p_type)) FROM part)""")
def d21_stored_types(spark, d):
    return clean.stored_types(given(spark, d, "SELECT * FROM {part}"))


@query(f"""SELECT v, regexp_matches(lower(trim(v)), '{clean.UNIT}') AS is_unit, NOT regexp_matches(lower(trim(v)), '{clean.UNIT}') AND NOT regexp_matches(trim(v), '^((19|20)\\d{{2}}|\\d{{4}}[-/]\\d{{2,4}})$')
AND try_cast(regexp_replace(trim(v), '[,£$%]', '', 'g') AS DOUBLE) IS NOT NULL AS is_number FROM ({SQL_VALUES})""")
def d22_unit_and_number(spark, d):
    return given(spark, d, VALUES).select("v", clean.is_unit(F.col("v")).alias("is_unit"), clean.is_number(F.col("v")).alias("is_number"))


@query(f"SELECT code, regexp_replace(regexp_replace(code, '_(enriched|canonical|draft|manifest)$', ''), '_(({SHORT})\\d{{2}}|\\d{{4}}-\\d{{2}})$', '') AS publication FROM (SELECT code || '_jan25_enriched.yaml' AS path, code || '_jan25_enriched' AS code FROM ({plain(CODES)}))")
def d23_manifest_publication(spark, d):
    rows = given(spark, d, CODES).select(F.concat("code", F.lit("_jan25_enriched")).alias("code"))
    return rows.select("code", names.manifest_publication(F.concat(F.lit("manifests/"), "code", F.lit(".yaml"))).alias("publication"))


@query(f"SELECT h, regexp_matches(lower(h), '{names.NOISE}') AS noise, CASE WHEN regexp_matches(lower(h), 'reference|lookup|mapping') THEN 1 WHEN regexp_matches(lower(h), '{names.NOISE}') THEN 2 WHEN regexp_matches(lower(h), 'summary|total|overview|national') THEN 3 ELSE 4 END AS category FROM ({plain(HEADERS)} UNION ALL SELECT 'Notes' AS h UNION ALL SELECT 'Code lookup')")
def d25_c14_source_category(spark, d):
    rows = given(spark, d, HEADERS + " UNION ALL SELECT 'Notes' AS h UNION ALL SELECT 'Code lookup'")
    return rows.select("h", names.is_noise(F.col("h")).alias("noise"), names.source_category(F.col("h")).alias("category"))


def month_cases(pattern: str, names_: list[str]) -> str:
    out = ""
    for k, name in enumerate(names_, 1):
        p = pattern.replace("NAME", name)
        y = f"try_cast(regexp_extract(t, '{p}', 1) AS INT)"
        out += f" WHEN regexp_matches(t, '{p}') THEN (CASE WHEN {y} < 100 THEN {y} + 2000 ELSE {y} END) * 100 + {k}\n"
    return out


ISO = "'(\\d{4})-(\\d{2})([^0-9]|$)'"
SPAN = "'(\\d{4})[-_](\\d{2})([^0-9]|$)'"
QUARTER = "'q\\s*(\\d)\\s*[-_\\s]*(?:fy\\s*)?(\\d{4})[-_](\\d{2})'"
PARSED = f"""SELECT raw, t, CASE WHEN regexp_matches(t, {QUARTER}) THEN -1
{month_cases('NAME[-_\\s]*(\\d{4})', names.MONTHS_LONG)}{month_cases('\\bNAME[-_\\s]*(\\d{2,4})\\b', names.MONTHS_SHORT)}
 WHEN try_cast(regexp_extract(t, {ISO}, 2) AS INT) BETWEEN 1 AND 12 THEN try_cast(regexp_extract(t, {ISO}, 1) AS INT) * 100 + try_cast(regexp_extract(t, {ISO}, 2) AS INT)
 WHEN try_cast(regexp_extract(t, {SPAN}, 2) AS INT) = (try_cast(regexp_extract(t, {SPAN}, 1) AS INT) + 1) % 100 THEN -2 ELSE 0 END AS m FROM (SELECT t AS raw, trim(lower(t)) AS t FROM ({plain(PERIOD_TEXTS)}))"""


@query(f"""SELECT raw AS t, CASE WHEN m = 0 THEN NULL WHEN m > 0 THEN format('{{:04d}}-{{:02d}}', m // 100, m % 100)
WHEN m = -1 THEN 'FY' || substr(regexp_extract(t, {QUARTER}, 2), 3) || '-Q' || regexp_extract(t, {QUARTER}, 1) ELSE 'FY' || regexp_extract(t, {SPAN}, 1) || '-' || regexp_extract(t, {SPAN}, 2) END AS code,
CAST(CASE WHEN m >= 0 THEN m WHEN m = -1 THEN CASE WHEN regexp_extract(t, {QUARTER}, 1) = '4' THEN (CAST(regexp_extract(t, {QUARTER}, 2) AS INT) + 1) * 100 + 3 ELSE CAST(regexp_extract(t, {QUARTER}, 2) AS INT) * 100 + CAST(regexp_extract(t, {QUARTER}, 1) AS INT) * 3 + 3 END
ELSE (CAST(regexp_extract(t, {SPAN}, 1) AS INT) + 1) * 100 + 3 END AS INT) AS sort_key FROM ({PARSED})""")
def p01_parse_period(spark, d):
    rows = given(spark, d, PERIOD_TEXTS).withColumn("p", periods.period_of(F.col("t")))
    return rows.select("t", "p.code", "p.sort_key")


START = """CASE WHEN regexp_full_match(code, '\\d{4}-(0[1-9]|1[0-2])') THEN make_date(CAST(substr(code, 1, 4) AS INT), CAST(substr(code, 6, 2) AS INT), 1)
WHEN regexp_full_match(code, 'FY\\d{2}-Q[1-4]') THEN CAST(make_date(CASE WHEN CAST(substr(code, 3, 2) AS INT) < 50 THEN 2000 ELSE 1900 END + CAST(substr(code, 3, 2) AS INT), 1, 1) + to_months(CAST(3 * CAST(substr(code, 7, 1) AS INT) AS INT)) AS DATE)
WHEN regexp_full_match(code, 'FY\\d{4}-\\d{2}') THEN make_date(CAST(substr(code, 3, 4) AS INT), 4, 1) END"""
SPANNED = f"SELECT code, s, CAST(s + to_months(CASE WHEN code LIKE '%-Q%' THEN 3 WHEN code LIKE 'FY%' THEN 12 ELSE 1 END) - INTERVAL 1 DAY AS DATE) AS e FROM (SELECT code, {START} AS s FROM ({plain(PERIODS)}))"


@query(f"SELECT code, s AS starts, e AS ends FROM ({SPANNED})")
def p02_period_dates(spark, d):
    return given(spark, d, PERIODS).select("code", periods.period_start(F.col("code")).alias("starts"), periods.period_end(F.col("code")).alias("ends"))


@query(f"""SELECT code, CASE WHEN regexp_full_match(code, '\\d{{4}}-\\d{{2}}') AND s IS NOT NULL THEN strftime(s, '%b %Y') WHEN regexp_full_match(code, 'FY\\d{{2}}-Q\\d') THEN 'Q' || substr(code, 7) || ' FY' || substr(code, 3, 2)
WHEN regexp_full_match(code, 'FY\\d{{4}}-\\d{{2}}') THEN 'FY ' || substr(code, 3) ELSE code END AS shown FROM ({SPANNED})""")
def p03_period_display(spark, d):
    return given(spark, d, PERIODS).select("code", periods.period_display(F.col("code")).alias("shown"))


@query(f"SELECT code, 'FY' || y || '-' || format('{{:02d}}', (y + 1) % 100) AS fiscal_year, y || '-04' AS april, code LIKE '%-04' AS opens FROM (SELECT code, year(s) - CASE WHEN month(s) < 4 THEN 1 ELSE 0 END AS y FROM ({SPANNED}))")
def p04_fiscal_year(spark, d):
    code = F.col("code")
    return given(spark, d, PERIODS).select("code", periods.fiscal_year(code).alias("fiscal_year"), periods.fiscal_april(code).alias("april"), periods.opens_fiscal_year(code).alias("opens"))


def file_period_sql() -> str:
    months = ""
    for k, m in enumerate(names.MONTHS_SHORT, 1):
        months += f" WHEN contains(f, '{m}') AND regexp_matches(f, '20\\d{{2}}') THEN regexp_extract(f, '20\\d{{2}}') || '-{k:02d}' WHEN regexp_matches(f, '{m}[_-]?(\\d{{2}})([^0-9]|$)') THEN '20' || regexp_extract(f, '{m}[_-]?(\\d{{2}})([^0-9]|$)', 1) || '-{k:02d}'\n"
    return f"""CASE WHEN regexp_matches(f, 'q([1-4])[_-]?(\\d{{2}})(\\d{{2}})') THEN '20' || regexp_extract(f, 'q([1-4])[_-]?(\\d{{2}})(\\d{{2}})', 2) || '-Q' || regexp_extract(f, 'q([1-4])[_-]?(\\d{{2}})(\\d{{2}})', 1)
{months} WHEN regexp_matches(f, '(20\\d{{2}})[_-](\\d{{1,2}})') THEN regexp_extract(f, '(20\\d{{2}})[_-](\\d{{1,2}})', 1) || '-' || lpad(regexp_extract(f, '(20\\d{{2}})[_-](\\d{{1,2}})', 2), 2, '0')
 WHEN regexp_matches(f, 'w(?:eek)?[_-]?(\\d{{1,2}})[_-]?(20\\d{{2}})') THEN regexp_extract(f, 'w(?:eek)?[_-]?(\\d{{1,2}})[_-]?(20\\d{{2}})', 2) || '-W' || lpad(regexp_extract(f, 'w(?:eek)?[_-]?(\\d{{1,2}})[_-]?(20\\d{{2}})', 1), 2, '0')
 WHEN regexp_matches(f, '20\\d{{2}}') AND NOT regexp_matches(f, 'q[1-4]|{SHORT}') THEN regexp_extract(f, '20\\d{{2}}') END"""


@query(f"SELECT t, {file_period_sql()} AS period FROM (SELECT t, lower(regexp_extract(regexp_replace(t, '[?#].*$', ''), '([^/]*)$', 1)) AS f FROM ({plain(PERIOD_TEXTS)}))")
def p05_file_period(spark, d):
    return given(spark, d, PERIOD_TEXTS).select("t", periods.file_period(F.col("t")).alias("period"))


@query(f"SELECT code, regexp_full_match(code, '\\d{{4}}-(0[1-9]|1[0-2])|FY\\d{{2}}-Q[1-4]|FY\\d{{4}}-\\d{{2}}|\\d{{4}}') AS valid FROM ({plain(PERIODS)})")
def p06_valid_period(spark, d):
    return given(spark, d, PERIODS).select("code", periods.is_period(F.col("code")).alias("valid"))


def header_date_sql() -> str:
    def century(y: str) -> str:
        return f"(CASE WHEN {y} < 100 THEN {y} + 2000 ELSE {y} END)"

    def n(p: str, g: int) -> str:
        return f"try_cast(regexp_extract(t, '{p}', {g}) AS INT)"

    month = f"CASE WHEN regexp_matches(t, '^({SHORT})') THEN (position(substr(t, 1, 3) IN 'janfebmaraprmayjunjulaugsepoctnovdec') + 2) // 3 END"
    y, iy, im, q, qy = century(n("(\\d{2,4})", 1)), n("^(\\d{4})[-_](\\d{1,2})", 1), n("^(\\d{4})[-_](\\d{1,2})", 2), n("^q([1-4])[-_\\s]?(\\d{2,4})", 1), century(n("^q([1-4])[-_\\s]?(\\d{2,4})", 2))
    sp = "^(\\d{4}|\\d{2})[-/](\\d{4}|\\d{2})$"
    s, e = century(n(sp, 1)), century(n(sp, 2))
    f = "format('{:04d}-{:02d}-01', "
    return f"CASE WHEN {month} IS NOT NULL AND {y} IS NOT NULL THEN {f}{y}, {month}) WHEN {im} BETWEEN 1 AND 12 THEN {f}{iy}, {im}) WHEN {q} IS NOT NULL THEN {f}{qy}, {q} * 3 - 2) WHEN {e} % 100 = ({s} + 1) % 100 THEN {f}{s}, 4) END"


@query(f"SELECT h, {header_date_sql()} AS day FROM (SELECT h, trim(lower(h)) AS t FROM ({plain(HEADERS)}))")
def p07_header_date(spark, d):
    return given(spark, d, HEADERS).select("h", periods.header_date(F.col("h")).alias("day"))


@query("SELECT c_custkey, strftime(m, '%Y-%m') AS period FROM (SELECT c_custkey, unnest(generate_series(make_date(1998, CAST(1 + c_custkey % 12 AS INT), 1), DATE '1999-06-15', INTERVAL 1 MONTH)) AS m FROM customer) WHERE month(m) IN (2, 5, 8, 11)")
def p08_schedule(spark, d):
    rows = given(spark, d, "SELECT c_custkey, make_date(1998, CAST(1 + c_custkey % 12 AS INT), 1) AS starts FROM {customer}")
    months = rows.select("c_custkey", F.explode(periods.monthly(F.col("starts"), F.lit("1999-06-15").cast("date"))).alias("m"))
    return months.where(F.month("m").isin(2, 5, 8, 11)).select("c_custkey", F.date_format("m", "yyyy-MM").alias("period"))


@query(f"""SELECT code, 'https://x.example.org/' || lower(strftime(s, '%B')) || '-' || year(s) || '/' || day(last_day(s)) || '-' || strftime(s + INTERVAL 2 MONTH, '%Y%m') || '.csv' AS url FROM ({SPANNED}) WHERE s IS NOT NULL""")
def p09_filled_url(spark, d):
    rows = settled(given(spark, d, PERIODS)).where(periods.period_start(F.col("code")).isNotNull())
    template = F.lit("{landing_page}/{month_name}-{year}/{day}-{pub_year}{pub_month}.csv")
    return rows.select("code", periods.filled_url(template, F.col("code"), F.lit("https://x.example.org/"), 2).alias("url"))


@query(f"""SELECT code, array_to_string([strftime(s, '%b%y'), lower(strftime(s, '%b%y')), strftime(s, '%b%Y'), lower(strftime(s, '%b%Y')), lower(strftime(s, '%B-%Y')), lower(strftime(s, '%B_%Y')), strftime(s, '%B %Y'), strftime(s, '%b %Y'), strftime(s, '%b-%Y'), lower(strftime(s, '%b-%Y')), strftime(s, '%Y%m'), strftime(s, '%Y-%m'), strftime(s, '%Y_%m'), strftime(s, '%m-%Y')], '|') AS spellings,
e + INTERVAL 42 DAY <= DATE '2000-01-01' AS past FROM ({SPANNED}) WHERE regexp_full_match(code, '\\d{{4}}-(0[1-9]|1[0-2])')""")
def p10_month_spellings(spark, d):
    code = F.col("code")
    rows = settled(given(spark, d, PERIODS)).where(code.rlike(r"^\d{4}-(0[1-9]|1[0-2])$"))
    return rows.select("code", F.array_join(periods.month_spellings(code), "|").alias("spellings"), periods.is_past(code, F.lit("2000-01-01").cast("date")).alias("past"))


@query("""SELECT c_mktsegment AS source, min(p) AS earliest, max(p) AS latest, CASE WHEN count(DISTINCT p) >= 3 AND count(DISTINCT substr(p, 6)) <= 4 THEN 'quarterly' ELSE 'monthly' END AS frequency
FROM (SELECT c_mktsegment, strftime(o_orderdate, '%Y-%m') AS p FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment <> 'BUILDING' OR month(o_orderdate) % 3 = 0) GROUP BY 1""")
def p11_frequency(spark, d):
    rows = given(spark, d, "SELECT c_mktsegment AS source, o_orderdate FROM {orders} JOIN {customer} ON o_custkey = c_custkey WHERE c_mktsegment <> 'BUILDING' OR month(o_orderdate) % 3 = 0")
    rows = rows.select("source", F.date_format("o_orderdate", "yyyy-MM").alias("p"))
    quarterly = (F.count_distinct("p") >= 3) & (F.count_distinct(F.substring("p", 6, 2)) <= 4)
    return rows.groupBy("source").agg(F.min("p").alias("earliest"), F.max("p").alias("latest"), F.when(quarterly, "quarterly").otherwise("monthly").alias("frequency"))
