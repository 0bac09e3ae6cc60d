"""Values: suppression markers, casts of messy text, and the types of columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
MARKERS = [":", "..", ".", "-", "*", "c", "z", "x", "[c]", "[z]", "[x]", "n/a", "na", "low dq", "unknown"]
ABSENT = ["", "N/A", "NA", "NULL", "NONE", "-"]
UNIT = r"^([£$€]\d+|%|percent(age)?|rate|number|count|total|fte|wte|000s?)$"
DATE_FORMATS = ["yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy", "yyyyMMdd"]


def is_suppressed(value: Column, markers: list[str] = MARKERS) -> Column:
    return F.coalesce(F.lower(F.trim(value)).isin(markers), F.lit(False))


def unsuppressed(value: Column, markers: list[str] = MARKERS) -> Column:
    return F.when(~is_suppressed(value, markers), value)


def suppress(df: DataFrame, markers: list[str] = MARKERS) -> DataFrame:
    """`df` with markers in text columns as nulls; provenance columns, whose names begin with _, stay."""
    return df.select(*[unsuppressed(F.col(f"`{n}`"), markers).alias(n) if kind == "string" and not n.startswith("_") else F.col(f"`{n}`") for n, kind in df.dtypes])


def whole_numbers(df: DataFrame) -> DataFrame:
    """`df` with the floating columns whose values are all whole as longs; one pass finds them."""
    floats = [n for n, kind in df.dtypes if kind in ("double", "float")]
    if not floats:
        return df
    whole = df.agg(*[F.bool_and(F.col(n) % 1 == 0).alias(n) for n in floats]).first().asDict()
    return df.withColumns({n: F.col(n).cast("long") for n in floats if whole[n]}) if any(whole.values()) else df


def is_absent(value: Column) -> Column:
    return value.isNull() | F.upper(F.trim(value)).isin(ABSENT)


def _present(value: Column) -> Column:
    return F.when(~is_absent(value) & ~is_suppressed(value), F.trim(value))


def to_text(value: Column) -> Column:
    return F.when(~is_absent(value), F.trim(value))


def to_float(value: Column) -> Column:
    """The number, commas and per-cent signs dropped; null for what is no number."""
    number = F.regexp_replace(_present(value), "[,%]", "").try_cast("double")
    return F.when(~F.isnan(number), number)


def to_integer(value: Column) -> Column:
    """The number cut to a whole one; null for what is no number."""
    number = F.regexp_replace(_present(value), ",", "").try_cast("double")
    return F.when(~F.isnan(number), number.try_cast("long"))


def to_date(value: Column) -> Column:
    """A day in one of the usual notations; a month and year is its first day."""
    text = _present(value)
    month = F.regexp_replace(F.initcap(F.lower(text)), r"^(\w{3})\w*?(\d{4})$", "$1$2")
    return F.coalesce(*[F.when(F.length(text) == len(f), F.try_to_date(text, f)) for f in DATE_FORMATS], F.when(month.rlike(r"^[A-Z][a-z]{2}\d{4}$"), F.try_to_date(month, "MMMyyyy")))


def to_boolean(value: Column) -> Column:
    text = F.lower(F.trim(value))
    return F.when(text.isin("yes", "y", "true", "t", "1"), True).when(text.isin("no", "n", "false", "f", "0"), False)


def to_type(value: Column, type_name: str) -> Column:
    """A text as the column type named; unknown types are text."""
    name = type_name.upper()
    if name.startswith(("INTEGER", "BIGINT", "SMALLINT")):
        return to_integer(value)
    if name.startswith(("NUMERIC", "DECIMAL", "DOUBLE", "REAL", "FLOAT")):
        return to_float(value)
    if name.startswith("DATE"):
        return to_date(value)
    return to_boolean(value) if name.startswith("BOOL") else to_text(value)


def is_unit(value: Column) -> Column:
    return F.coalesce(F.lower(F.trim(value)).rlike(UNIT), F.lit(False))


def is_year(value: Column) -> Column:
    """A calendar year, or a fiscal year with or without a footnote mark."""
    return F.coalesce(F.trim(value).rlike(r"^((19|20)\d{2}|\d{4}[-/]\d{2,4}[²³¹]*)$"), F.lit(False))


def is_number(value: Column) -> Column:
    """Numbers that are no years and no units."""
    return ~is_year(value) & ~is_unit(value) & F.regexp_replace(F.trim(value), "[,£$%]", "").try_cast("double").isNotNull()


def stored_type(kind: str, longest: Column) -> Column:
    """The table type of a column: by its Spark type, text by its greatest length."""
    fixed = {"int": "INTEGER", "bigint": "BIGINT", "smallint": "INTEGER", "double": "NUMERIC(18,6)", "float": "NUMERIC(18,6)", "boolean": "BOOLEAN", "date": "DATE", "timestamp": "DATE", "timestamp_ntz": "DATE"}
    if kind in fixed:
        return F.lit(fixed[kind])
    return F.when(longest <= 50, "VARCHAR(50)").when(longest <= 255, "VARCHAR(255)").otherwise("TEXT")


def stored_types(df: DataFrame) -> DataFrame:
    """(column_name, stored_type) of every column, by one aggregate over the table."""
    lengths = df.agg(*[F.max(F.length(F.col(n).cast("string"))).alias(n) for n in df.columns])
    rows = F.array(*[F.struct(F.lit(n).alias("column_name"), stored_type(kind, F.col(n)).alias("stored_type")) for n, kind in df.dtypes])
    return lengths.select(F.explode(rows).alias("r")).select("r.*")
