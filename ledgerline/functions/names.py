"""Column, source and file names: expressions that give every header one deterministic name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Fixed values.
RESERVED = "month year group order table index key value date time user name type level desc asc limit offset case when then else end and or not null true false select from where join on as in is between like having by all any some".split()
RESERVED_IN_SHEETS = "month year group order table index key value date time user name type level".split()
MONTHS_LONG = "january february march april may june july august september october november december".split()
MONTHS_SHORT = [m[:3] for m in MONTHS_LONG]
LONG, SHORT = "|".join(MONTHS_LONG), "|".join(MONTHS_SHORT)
NOISE = "dictionary|definitions|notes|title_sheet|contents|metadata|title and contents|annex"
NAME_LENGTH = 63


def _word(c: Column) -> Column:
    lowered = F.regexp_replace(F.lower(c), "[£$€%]", "")
    return F.regexp_replace(F.regexp_replace(lowered, "[^a-z0-9]+", "_"), "^_+|_+$", "")


def schema_name(header: Column, reserved: list[str] = RESERVED, length: int = NAME_LENGTH) -> Column:
    """A header as a column name; blank headers are col_unnamed, reserved words end in _val."""
    word = _word(F.coalesce(header, F.lit("")))
    kept = F.when(word.isin(reserved), F.concat(word, F.lit("_val"))).when(word.rlike("^[0-9]"), F.concat(F.lit("col_"), word)).otherwise(word)
    return F.when(word == "", "col_unnamed").otherwise(F.substring(kept, 1, length))


def sheet_name(header: Column) -> Column:
    """As `schema_name`, with the shorter list of reserved words that sheets use."""
    return schema_name(header, RESERVED_IN_SHEETS)


def strict_name(header: Column) -> Column:
    """At most 60 characters; null for blank headers."""
    word = _word(header)
    return F.when(word != "", F.substring(word, 1, 60))


def matching_name(name: Column) -> Column:
    """The form in which names of two periods are compared."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), "[^a-z0-9_]", "_"), "_+", "_"), "^_|_$", "")


def numbered(df: DataFrame, name: str, position: str, by: list[str]) -> DataFrame:
    """`df` with `column_name`: a name's second holder within `by` gets _2, the third _3; and `first_header`, the first `position` of each name."""
    order = Window.partitionBy(*by, name).orderBy(position)
    number, first = F.row_number().over(order), F.first(position).over(order)
    return df.withColumns({"ordinal": number, "first_header": first}).withColumn("column_name", F.when(F.col("ordinal") > 1, F.concat(name, F.lit("_"), F.col("ordinal").cast("string"))).otherwise(F.col(name)))


def valid_name(name: Column) -> Column:
    return F.coalesce(name.rlike("^[a-z_][a-z0-9_]*$") & (F.length(name) <= NAME_LENGTH), F.lit(False))


def generic_name(name: Column) -> Column:
    """Names that say nothing: numbered or lettered columns, under three characters, digits only."""
    return name.rlike("^col(umn)?_[0-9a-z]{1,2}$") | (F.length(name) < 3) | name.rlike("^[0-9]+$")


# The dates of a code, in the order in which they must be taken out, and what stands in their place.
CODE_DATES = (
    (rf"(?i)_(?:{SHORT})\d{{2,4}}", ""),
    (r"_?\d{4}[-_]\d{2}", ""),
    (r"_?20\d{2}", ""),
    (rf"(?i)_(?:{LONG})", ""),
    (rf"(?i)_(?:{SHORT})", ""),
    (r"(?i)_?q[1-4]", ""),
    (r"_\d{2}(?=_|$)", ""),
    (r"_0?[1-9](?=_|$)", ""),
    (r"_1[0-2](?=_|$)", ""),
    ("_+", "_"),
    ("^_+|_+$", ""),
)


def undated_code(code: Column) -> Column:
    """A source code without its dates: month-year, ISO month, year, month names, quarter, then lone numbers."""
    for pattern, by in CODE_DATES:
        code = F.regexp_replace(code, pattern, by)
    return code


def canonical_table(code: Column, table: Column) -> Column:
    """The table of a canonical code: its prefix is kept, and a code without dates keeps its table."""
    plain = undated_code(code)
    return F.when(plain == code, table).when(F.startswith(table, F.lit("tbl_")), F.concat(F.lit("tbl_"), plain)).otherwise(plain)


def file_stem(path: Column) -> Column:
    name = F.regexp_extract(path, "([^/]*)$", 1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def short_code(path: Column) -> Column:
    """A file's name as a short code without dates: at most three segments over two characters, and 40 characters."""
    name = F.regexp_replace(F.lower(F.regexp_replace(file_stem(path), "%20", "_")), "[^a-z0-9_]", "_")
    for pattern, by in (("_+", "_"), ("^_|_$", ""), (rf"_({SHORT})_\d{{2,4}}", ""), (rf"_({LONG})_\d{{2,4}}", ""), (r"_\d{4}(?:_|$)", "_"), (rf"_({SHORT})(?:_|$)", "_"), ("_+", "_"), ("^_|_$", "")):
        name = F.regexp_replace(name, pattern, by)
    parts = F.filter(F.split(name, "_"), lambda p: F.length(p) > 2)
    name = F.when(F.size(parts) > 3, F.array_join(F.slice(parts, -3, 3), "_")).otherwise(name)
    return F.when(F.length(name) > 40, F.regexp_replace(F.substring(name, 1, 40), "_+$", "")).otherwise(name)


def base_pattern(path: Column) -> Column:
    """What the files of one source have in common: the short code after dates have gone."""
    return short_code(F.regexp_replace(F.regexp_replace(F.lower(path), rf"_({SHORT})_\d{{2,4}}", ""), r"_\d{4}", ""))


# What of a file's name changes with its period, in the order in which it must be taken out, and what stands in its place.
URL_PARTS = (
    (r"(?i)\bOnline\s+Consultation\b", "OC"),
    (rf"(?i)\b(?:{SHORT}|(?:{LONG})\s*)\d{{2,4}}\b", "PERIOD"),
    (rf"(?i)\b(?:{LONG}|{SHORT})\b", "MONTH"),
    (r"\b20\d{2}\b", "YEAR"),
    (r"[-_\s]MONTH[-_\s]?YEAR", "-PERIOD"),
    (r"MONTH[-_\s]?YEAR", "PERIOD"),
    (r"-(?:\d{5,6}|(?i:revised|corrected|updated|final)|[A-Za-z0-9]{5,7})(?=\.)", "-FILEID"),
    (r"\s+", " "),
    ("^ | $", ""),
    ("-+", "-"),
)


def stable_url(url: Column) -> Column:
    """A URL's file name with dates and identifiers replaced, alike for all periods of a file."""
    name = F.url_decode(F.regexp_extract(F.regexp_replace(url, "/+$", ""), "([^/]*)$", 1))
    for pattern, by in URL_PARTS:
        name = F.regexp_replace(name, pattern, by)
    return name


def is_date_header(header: Column) -> Column:
    """Whether a header names a month, quarter or year span."""
    patterns = [rf"({SHORT})[-_\s]?\d{{2,4}}", rf"({LONG})[-_\s]?\d{{4}}", r"(janaury|febuary|feburary)[-_\s]?\d{4}", r"\d{4}[-_](0?[1-9]|1[0-2])", r"q[1-4][-_\s]?\d{2,4}", r"\d{2,4}[-/]\d{2,4}"]
    return F.coalesce(F.trim(F.lower(header)).rlike("^(" + "|".join(patterns) + ")"), F.lit(False))


def deduplicated_words(name: Column) -> Column:
    """Drops a trailing ' - '; of three words or more with under half distinct, each counts once."""
    plain = F.regexp_replace(F.trim(name), r"\s*-\s*$", "")
    words = F.split(plain, " ")
    distinct = F.array_distinct(words)
    return F.when((F.size(words) >= 3) & (F.size(distinct) * 2 < F.size(words)), F.array_join(distinct, " ")).otherwise(plain)


def is_noise(name: Column) -> Column:
    """Whether a sheet, code or name is documentation, not data."""
    return F.lower(name).rlike(NOISE)


def tags(code: Column, skip: tuple[str, ...] = ("the", "and", "for", "data", "summary")) -> Column:
    """At most five words of a code that are over two characters and not to be skipped."""
    return F.slice(F.filter(F.split(code, "_"), lambda w: (F.length(w) > 2) & ~w.isin(*skip)), 1, 5)


def domain(code: Column, rules: list[tuple[str, str]], default: str = "Other") -> Column:
    """The first domain whose pattern a code matches."""
    found = F.lit(default)
    for pattern, name in reversed(rules):
        found = F.when(F.lower(code).rlike(pattern), name).otherwise(found)
    return found


def source_category(name: Column) -> Column:
    """Sort key of a source: reference, metadata, summary, then breakdown."""
    lowered = F.lower(name)
    return F.when(lowered.rlike("reference|lookup|mapping"), 1).when(lowered.rlike(NOISE), 2).when(lowered.rlike("summary|total|overview|national"), 3).otherwise(4)


def manifest_publication(path: Column) -> Column:
    """The publication of a manifest's path: its stem without suffixes and period."""
    return F.regexp_replace(F.regexp_replace(file_stem(path), "_(enriched|canonical|draft|manifest)$", ""), rf"_(({SHORT})\d{{2}}|\d{{4}}-\d{{2}})$", "")
