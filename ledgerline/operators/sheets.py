"""Structure of sheets, for all sheets at once: `cells` has file, sheet, row, col, value and ctype of every filled cell.

Headers, extents, names and types come from grouped cells; nothing walks a sheet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.functions import clean, names
from ledgerline.sources.tables import kept

SHEET = ["file", "sheet"]
# Fixed values.
STOP = "^(note|source|copyright|©|please|this worksheet|this table)"
ABOUT = "contents|title|notes|definition|about|introduction"
NO_ID = "confidence|interval|ci|variance|var|actual|plan|budget|fte|cost|attend|wait"
ID = "code|name|region|ics|nhse|org|group|month|year|quarter|period|area|breakdown|trust|category|description|centre|staff|type"
#: Length over which a text that begins with a star is a footnote.
LONG_NOTE = 50
SHEET_MARKERS = clean.MARKERS[:13]


#: Rows of a sheet that share a bin.
BIN = 512
#: Rows of a merged range, and columns of its first row, that are opened though the sheet holds nothing in them.
BLANK = 64


def spread(cells: DataFrame, merges: DataFrame) -> DataFrame:
    """(file, sheet, row, col, anchor_row, anchor_col) of what merged ranges cover up to the sheet's last row and column in use (the first row
    up to BLANK columns at least): the first BLANK rows, and of later ones those that hold a cell. So a range costs rows in proportion to what
    the sheet holds. Ranges meet the sheet's rows by the bins they touch.
    """
    used = cells.groupBy(*SHEET, "row").agg(F.max("col").alias("far"))
    box = used.groupBy(*SHEET).agg(F.max("row").alias("max_row"), F.max("far").alias("max_col"))
    until, near = F.greatest("first_row", F.least("last_row", "max_row")), F.least("until", F.col("first_row") + (BLANK - 1))
    ranges = merges.join(box, SHEET, "left").withColumn("until", until).withColumn("near", near)
    binned = ranges.where("until > near").withColumn("bin", F.explode(F.sequence(F.floor(F.col("near") / BIN), F.floor(F.col("until") / BIN))))
    rows = used.select(*SHEET, "row", F.floor(F.col("row") / BIN).alias("bin"))
    later = binned.join(rows, [*SHEET, "bin"]).where("row > near and row <= until").drop("bin")
    opened = ranges.withColumn("row", F.explode(F.sequence("first_row", "near"))).unionByName(later)
    wide = F.when(F.col("row") == F.col("first_row"), F.greatest("max_col", F.col("first_col") + (BLANK - 1))).otherwise(F.col("max_col"))
    opened = opened.withColumn("to_col", F.least("last_col", wide)).where("to_col >= first_col")
    return opened.select(*SHEET, "row", F.explode(F.sequence("first_col", "to_col")).alias("col"), F.col("first_row").alias("anchor_row"), F.col("first_col").alias("anchor_col"))


def resolved(cells: DataFrame, merges: DataFrame) -> DataFrame:
    """Every cell, those of merged ranges with the anchor's text; merges have file, sheet, first_row, last_row, first_col, last_col."""
    anchor = cells.select(*SHEET, F.col("row").alias("anchor_row"), F.col("col").alias("anchor_col"), F.col("value").alias("anchor_value"), F.col("ctype").alias("anchor_type"))
    covered = spread(cells, merges).join(anchor, [*SHEET, "anchor_row", "anchor_col"], "left").select(*SHEET, "row", "col", "anchor_value", "anchor_type", F.lit(True).alias("is_merged"))
    out = cells.join(covered, [*SHEET, "row", "col"], "full")
    text = F.trim(F.regexp_replace(F.coalesce(F.when(F.col("is_merged"), F.col("anchor_value")).otherwise(F.col("value")), F.lit("")), r"[\r\n]+", " "))
    return out.select(*SHEET, "row", "col", text.alias("value"), F.coalesce(F.when(F.col("is_merged"), F.col("anchor_type")).otherwise(F.col("ctype")), F.lit("s")).alias("ctype"), F.coalesce("is_merged", F.lit(False)).alias("is_merged"))


def sheet_kinds(cells: DataFrame, rows: int = 29, cols: int = 19) -> DataFrame:
    """EMPTY, TABULAR or METADATA for every sheet."""
    size = cells.groupBy(*SHEET).agg(F.max("row").alias("max_row"), F.max("col").alias("max_col"), F.max(F.when((F.col("row") == 1) & (F.col("col") == 1), F.lower("value"))).alias("a1"))
    per_row = cells.where((F.col("row") <= rows) & (F.col("col") <= cols)).groupBy(*SHEET, "row").agg(F.count("*").alias("n"))
    shape = per_row.groupBy(*SHEET).agg(F.count(F.when(F.col("n") >= 3, 1)).alias("multi"), F.count(F.when(F.col("n") == 1, 1)).alias("single"))
    multi, single = F.coalesce("multi", F.lit(0)), F.coalesce("single", F.lit(0))
    kind = (
        F.when((F.col("max_row") < 2) | (F.col("max_col") < 2), "EMPTY")
        .when(multi >= 3, "TABULAR")
        .when(F.coalesce(F.col("a1").rlike(ABOUT), F.lit(False)) & (multi < 2), "METADATA")
        .when((single > 2 * multi) & (multi < 3), "METADATA")
        .when(multi >= 2, "TABULAR")
        .otherwise("METADATA")
    )
    return size.join(shape, SHEET, "left").select(*SHEET, kind.alias("kind"), "max_row", "max_col")


def cell_class(value: Column) -> Column:
    text = F.trim(value)
    return F.when(F.lower(text).isin(SHEET_MARKERS), "suppressed").when(clean.is_unit(text), "unit").when(clean.is_year(text), "year").when(text.rlike("(?i)^[QH][1-4]$"), "period").when(clean.is_number(text), "number").otherwise("text")


def classified(cells: DataFrame) -> DataFrame:
    """`cells` with the class of each, so that a stored table is classified once."""
    return cells.withColumn("class", cell_class(F.col("value")))


def class_of(cells: DataFrame) -> Column:
    """The class that `classified` stored, else worked out here."""
    return F.col("class") if "class" in cells.columns else cell_class(F.col("value"))


def row_classes(cells: DataFrame, rows: int = 29) -> DataFrame:
    """Counts of cell classes, and the verdicts header and data, for the first rows of every sheet."""
    top = cells.where(F.col("row") <= rows)
    kind = class_of(cells)
    near = F.col("col") <= 19
    counts = {k: F.count(F.when(near & (kind == k), 1)).alias(k) for k in ("unit", "year", "period", "number", "text")}
    a, b = (F.coalesce(F.max(F.when(F.col("col") == k, F.col("value"))), F.lit("")) for k in (1, 2))
    out = top.groupBy(*SHEET, "row").agg(F.count(F.when(F.col("col") <= 49, 1)).alias("filled"), *counts.values(), a.alias("a"), b.alias("b"))
    told = F.lower("a").rlike("^(table|this|note)") | (F.trim("b").rlike(":$") & (F.length(F.trim("b")) < 25) & (F.trim("a") == ""))
    out = out.where((F.col("filled") >= 2) & ~told)
    header = ((F.col("year") >= 2) & (F.col("number") == 0)) | (F.col("period") >= 2) | (F.col("unit") >= 2) | ((F.col("number") == 0) & (F.col("text") >= 2))
    return out.withColumns({"is_header": header, "is_data": F.col("number") >= 2})


def header_rows(cells: DataFrame) -> DataFrame:
    """first_header and last_header of every sheet that has one."""
    rows = row_classes(cells).select(*SHEET, "row", "is_header", "is_data")
    first = rows.where("is_header").groupBy(*SHEET).agg(F.min("row").alias("first_header"))
    data = rows.join(first, SHEET).where("is_data and not is_header and row > first_header").groupBy(*SHEET).agg(F.min("row").alias("first_data"))
    return first.join(data, SHEET, "left").select(*SHEET, "first_header", F.coalesce(F.col("first_data") - 1, F.col("first_header")).alias("last_header"))


def data_starts(cells: DataFrame, headers: DataFrame) -> DataFrame:
    """The first of five rows after the headers with two numbers, or three cells and a number; else the row after them."""
    rows = cells.join(headers, SHEET).where("row > last_header and row <= last_header + 5").groupBy(*SHEET, "row").agg(F.count("*").alias("filled"), F.count(F.when(class_of(cells) == "number", 1)).alias("number"))
    start = rows.where("number >= 2 or (filled >= 3 and number >= 1)").groupBy(*SHEET).agg(F.min("row").alias("start"))
    return headers.join(start, SHEET, "left").select(*SHEET, "first_header", "last_header", F.coalesce("start", F.col("last_header") + 1).alias("data_start"))


def data_ends(cells: DataFrame, starts: DataFrame) -> DataFrame:
    """The last row before a stop word in the first five columns, or before five blank rows."""
    near = cells.join(starts, SHEET).where("row >= data_start and col <= 5")
    rows = near.groupBy(*SHEET, "data_start", "row").agg(F.bool_or(F.lower(F.trim("value")).rlike(STOP)).alias("stops"))
    gap = F.col("row") - F.lag("row").over(Window.partitionBy(*SHEET).orderBy("row"))
    broken = rows.withColumn("gap", gap).groupBy(*SHEET).agg(F.min(F.when(F.col("stops") | (F.col("gap") >= 6), F.col("row"))).alias("breaks"))
    above = rows.join(broken, SHEET).where("breaks is null or row < breaks")
    end = above.groupBy(*SHEET).agg(F.max("row").alias("data_end"))
    return starts.join(end, SHEET, "left").withColumn("data_end", F.coalesce("data_end", F.col("data_start") - 1))


def column_letter(col: Column) -> Column:
    one = F.char(F.lit(65) + (col - 1) % 26)
    two = F.char(F.lit(65) + (F.floor((col - 27) / 26) % 26))
    three = F.char(F.lit(65) + F.floor((col - 703) / 676))
    return F.when(col <= 26, one).when(col <= 702, F.concat(two, one)).otherwise(F.concat(three, F.char(F.lit(65) + F.floor((col - 703) / 26) % 26), one))


def column_names(cells: DataFrame, starts: DataFrame) -> DataFrame:
    """file, sheet, col, headers and name of every column but spacers, up to column 500."""
    near = cells.join(starts, SHEET).where("col <= 500 and row >= first_header")
    heads = near.where("row <= last_header").groupBy(*SHEET, "col").agg(F.array_sort(F.collect_list(F.struct("row", F.trim("value").alias("v")))).alias("h"))
    first = near.where("row >= data_start and row < data_start + 5").groupBy(*SHEET, "col").agg(F.count("*").alias("filled"))
    both = heads.join(first, [*SHEET, "col"], "full")
    texts = F.transform(F.coalesce("h", F.array().cast("array<struct<row:int,v:string>>")), lambda x: x["v"])
    distinct = F.filter(texts, lambda v, i: (i == 0) | (v != F.get(F.col("texts"), i - 1)))
    named = both.withColumn("texts", texts).withColumn("headers", distinct)
    plain = names.sheet_name(F.when(F.size("headers") > 0, F.array_join("headers", "_")).otherwise(F.concat(F.lit("column_"), column_letter(F.col("col")))))
    named = named.withColumn("plain", plain)
    ordinal = F.row_number().over(Window.partitionBy(*SHEET, "plain").orderBy("col")) - 1
    suffix = F.concat(F.lit("_"), ordinal.cast("string"))
    name = F.when(ordinal > 0, F.concat(F.expr("substring(plain, 1, 63 - length(concat('_', cast(ordinal as string))))"), suffix)).otherwise(F.col("plain"))
    return named.withColumn("ordinal", ordinal).select(*SHEET, "col", F.array_join("headers", "|").alias("headers"), name.alias("name"))


def data_cells(cells: DataFrame, extents: DataFrame) -> DataFrame:
    return cells.join(extents.select(*SHEET, "data_start", "data_end"), SHEET).where("row between data_start and data_end")


def id_columns(cells: DataFrame, extents: DataFrame, columns: DataFrame) -> DataFrame:
    """Columns that identify rows: by their header, else by values that are mostly no numbers; else the first column."""
    values = data_cells(cells, extents).withColumn("k", F.row_number().over(Window.partitionBy(*SHEET, "col").orderBy("row"))).where("k <= 10")
    share = values.groupBy(*SHEET, "col").agg(F.avg(F.when(clean.is_number(F.col("value")), 0).otherwise(1)).alias("texts"))
    header = F.lower("headers")
    judged = columns.join(share, [*SHEET, "col"], "left").withColumn("is_id", F.when(header.rlike(NO_ID), False).when(header.rlike(ID), True).otherwise(F.coalesce(F.col("texts") > 0.7, F.lit(False))))
    per_sheet = judged.groupBy(*SHEET).agg(F.bool_or("is_id").alias("any_id"), F.min("col").alias("first_col"))
    return judged.join(per_sheet, SHEET).select(*SHEET, "col", "name", (F.col("is_id") | (~F.col("any_id") & (F.col("col") == F.col("first_col")))).alias("is_id"))


def column_types(cells: DataFrame, extents: DataFrame, columns: DataFrame) -> DataFrame:
    """The stored type of every column: from all cell tags, else from the first clean values."""
    values = data_cells(cells, extents).withColumn("marked", F.lower(F.trim("value")).isin(SHEET_MARKERS))
    number = F.regexp_replace("value", "[,£$%]", "").try_cast("double")
    ranged = F.col("value").rlike(" - | to ")
    clean_order = F.row_number().over(Window.partitionBy(*SHEET, "col", "marked").orderBy("row"))
    all_order = F.row_number().over(Window.partitionBy(*SHEET, "col").orderBy("row"))
    values = values.withColumns({"number": F.when(~ranged, number), "k": clean_order, "n": all_order})
    sample = ~F.col("marked") & (F.col("k") <= 25)
    whole = F.col("number") == F.floor("number")
    found = values.groupBy(*SHEET, "col").agg(
        F.bool_or(F.col("ctype").isin("n", "d")).alias("has_n"),
        F.bool_or((F.col("ctype") == "s")).alias("has_s"),
        F.bool_or((F.col("ctype") == "n") & ~whole).alias("has_fraction"),
        F.bool_or(F.col("marked") & (F.col("n") <= 100)).alias("has_mark"),
        F.count(F.when(sample, 1)).alias("sampled"),
        F.count(F.when(sample & F.col("number").isNotNull(), 1)).alias("numeric"),
        F.count(F.when(sample & whole, 1)).alias("whole"),
        F.max(F.when(sample, F.col("number"))).alias("most"),
        F.max(F.when(sample, F.length("value"))).alias("longest"),
    )
    name = F.col("name")
    low = F.col("numeric") > 0.7 * F.col("sampled")
    kind = (
        F.when(F.col("has_n") & F.col("has_s"), "VARCHAR(255)")
        .when(F.col("has_n") & F.col("has_fraction"), "DOUBLE PRECISION")
        .when(F.col("has_mark") | name.rlike("date|month|year|quarter|period|name|description|category|group|trust|type"), "VARCHAR(255)")
        .when(name.rlike("code|org|ics|nhse"), "VARCHAR(20)")
        .when((F.col("whole") > 0.7 * F.col("sampled")) & (F.col("whole") == F.col("numeric")), F.when(F.col("most") > 2147483647, "BIGINT").otherwise("INTEGER"))
        .when(low & name.rlike("percent|rate"), "NUMERIC(10,4)")
        .when(low & name.rlike("000|cost|budget"), "NUMERIC(18,2)")
        .when(low, "DOUBLE PRECISION")
        .when(F.coalesce("longest", F.lit(0)) <= 100, "VARCHAR(255)")
        .otherwise("TEXT")
    )
    return columns.join(found, [*SHEET, "col"], "left").select(*SHEET, "col", "name", F.coalesce(kind, F.lit("VARCHAR(255)")).alias("stored_type"))


def first_column_kinds(cells: DataFrame, extents: DataFrame) -> DataFrame:
    """What more than half of the first ten values of column A are."""
    first = data_cells(cells, extents).where("col = 1").withColumn("k", F.row_number().over(Window.partitionBy(*SHEET).orderBy("row"))).where("k <= 10")
    value = F.trim("value")
    kinds = {"FISCAL_YEAR": r"^\d{4}[-/]\d{2,4}$", "MONTH_YEAR": r"(?i)^(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\s*\d{4}$", "CALENDAR_YEAR": r"^(19|20)\d{2}$", "ORG_CODE": "^[A-Z0-9]{2,5}$"}
    shares = first.groupBy(*SHEET).agg(*[F.avg(value.rlike(p).cast("int")).alias(k) for k, p in kinds.items()])
    kind = F.lit("CATEGORY")
    for k in reversed(kinds):
        kind = F.when(F.col(k) > 0.5, k).otherwise(kind)
    return extents.select(*SHEET).join(shares, SHEET, "left").select(*SHEET, F.when(F.col("ORG_CODE").isNull(), "UNKNOWN").otherwise(kind).alias("first_column"))


def orientations(cells: DataFrame, starts: DataFrame) -> DataFrame:
    """HORIZONTAL where three of the columns 3 to 14 have a date as header, else VERTICAL."""
    dated = cells.join(starts, SHEET).where("row between first_header and last_header and col between 3 and 14").where(F.trim("value").rlike(r"(?i)^((Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\s*\d{4}|\d{4}[-/]\d{2,4}|FY\s*\d{4}.*)$"))
    n = dated.groupBy(*SHEET).agg(F.count_distinct("col").alias("n"))
    return starts.select(*SHEET).join(n, SHEET, "left").select(*SHEET, F.when(F.col("n") >= 3, "HORIZONTAL").otherwise("VERTICAL").alias("orientation"))


def before_footers(inside: DataFrame, columns: int = 5) -> DataFrame:
    """Data cells of the rows above a sheet's footer: a stop word, or a long text that begins with a star, in the first columns."""
    text = F.lower(F.trim("value"))
    is_footer = (F.col("col") <= columns) & (text.rlike(STOP) | (F.startswith(text, F.lit("*")) & (F.length(text) > LONG_NOTE)))
    footers = inside.where(is_footer).groupBy(*SHEET).agg(F.min("row").alias("footer"))
    return inside.join(footers, SHEET, "left").where("footer is null or row < footer").drop("footer")


def extracted(cells: DataFrame, extents: DataFrame, columns: DataFrame) -> DataFrame:
    """file, sheet, row, name, value of the data rows above the footer with content in the first five columns; marked values are null."""
    inside = before_footers(data_cells(cells, extents))
    filled = inside.where("col <= 5").select(*SHEET, "row").distinct()
    out = inside.join(filled, [*SHEET, "row"], "left_semi").join(columns.select(*SHEET, "col", "name"), [*SHEET, "col"])
    return out.select(*SHEET, "row", "name", clean.unsuppressed(F.col("value"), SHEET_MARKERS).alias("value"))


def preview(cells: DataFrame, extents: DataFrame, columns: DataFrame, rows: int = 3) -> DataFrame:
    return extracted(cells, extents.withColumn("data_end", F.least("data_end", F.col("data_start") + rows - 1)), columns)


def structures(cells: DataFrame) -> DataFrame:
    """One row for each sheet: kind, extents, first column, orientation and number of columns; sheets without headers are UNRECOGNISED."""
    starts = kept(data_starts(cells, header_rows(cells)))
    extents = kept(data_ends(cells, starts))
    columns = column_names(cells, starts).groupBy(*SHEET).agg(F.count("*").alias("n_columns"))
    out = sheet_kinds(cells).join(extents, SHEET, "left").join(first_column_kinds(cells, extents), SHEET, "left").join(orientations(cells, starts), SHEET, "left").join(columns, SHEET, "left")
    valid = (F.col("kind") == "TABULAR") & F.col("first_header").isNotNull()
    return out.withColumns({"is_valid": valid, "kind": F.when((F.col("kind") == "TABULAR") & ~valid, "UNRECOGNISED").otherwise(F.col("kind")), "n_rows": F.col("data_end") - F.col("data_start") + 1})
