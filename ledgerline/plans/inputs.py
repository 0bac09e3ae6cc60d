"""Inputs that queries derive from the tables: header rows, source codes, file ledgers and the like.

Each is one SELECT that Spark and the checking engine both run; table names stand in braces.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources.tables import table


#: Every line with its order and part, as inputs write it.
SOLD = "{orders} JOIN {lineitem} ON l_orderkey = o_orderkey JOIN {part} ON p_partkey = l_partkey"


def sold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p_name, p_type, o_orderdate), once each, of SOLD, by the first day of the order's month: of dates its readers use year and month alone.

    Lines are in no join's memory: orders and parts are, of as many parts of their keys as a shuffle has. So a task holds few of them, and repeats go early.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.trunc("o_orderdate", "month").alias("o_orderdate"))
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dated = lines.repartition(n, "l_orderkey").join(orders.repartition(n, "o_orderkey").hint("shuffle_hash"), F.col("l_orderkey") == F.col("o_orderkey"))
    named = dated.select("l_partkey", "o_orderdate").repartition(n, "l_partkey").join(parts.repartition(n, "p_partkey").hint("shuffle_hash"), F.col("l_partkey") == F.col("p_partkey"))
    return named.select("p_name", "p_type", "o_orderdate").distinct()


def given(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    frames = {"sold": sold(spark, sf_dir)} if SOLD in sql else {}
    sql = sql.replace(SOLD, "{sold}")
    return spark.sql(sql, **frames, **{t: table(spark, sf_dir, t) for t in set(re.findall(r"{(\w+)}", sql)) - {"sold"}})


def settled(values: DataFrame) -> DataFrame:
    """`values` of one distinct column such that conditions on them are tested once a value: Spark moves them before the repeats
    go where they are on what is grouped by, but not where they are on an aggregate.
    """
    (name,) = values.columns
    return values.groupBy(name).agg(F.max(name).alias("_value")).select(F.col("_value").alias(name))


def plain(sql: str) -> str:
    return re.sub(r"{(\w+)}", r"\1", sql)


def total(c: str | Column) -> Column:
    """An exact sum of money, as a double."""
    return F.sum((F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")).cast("double")


def total_sql(c: str) -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(18,2))) AS DOUBLE)"


MONTH = "substr('JanFebMarAprMayJunJulAugSepOctNovDec', month(o_orderdate) * 3 - 2, 3)"

HEADERS = f"""SELECT DISTINCT h FROM (
 SELECT p_name || ' ' || p_type AS h FROM {{part}}
 UNION ALL SELECT '£ ' || p_brand || ' (%)' FROM {{part}}
 UNION ALL SELECT concat(p_size, ' Total') FROM {{part}}
 UNION ALL SELECT o_orderpriority FROM {{orders}}
 UNION ALL SELECT replace(replace(event_type, 'view', 'Order'), 'click', ' Year_') FROM {{events}}
 UNION ALL SELECT c_mktsegment || ' - ' || c_mktsegment || ' ' || c_mktsegment || ' -' FROM {{customer}}
 UNION ALL SELECT concat({MONTH}, '-', year(o_orderdate) % 100) FROM {{orders}}
 UNION ALL SELECT concat({MONTH}, ' ', year(o_orderdate)) FROM {{orders}}
 UNION ALL SELECT concat('Q', quarter(o_orderdate), '_', year(o_orderdate)) FROM {{orders}}
 UNION ALL SELECT concat(year(o_orderdate), '-', month(o_orderdate)) FROM {{orders}}
 UNION ALL SELECT concat(year(o_orderdate) % 100, '/', (year(o_orderdate) + 1) % 100) FROM {{orders}}
 UNION ALL SELECT text FROM {{benchmark}}) u"""

CODES = f"""SELECT DISTINCT code FROM (
 SELECT concat(lower(p_type), '_', lower({MONTH}), year(o_orderdate) % 100 + 10, '_data') AS code FROM {{orders}} JOIN {{lineitem}} ON l_orderkey = o_orderkey JOIN {{part}} ON p_partkey = l_partkey
 UNION ALL SELECT concat(replace(p_name, ' ', '_'), '_', year(o_orderdate) + 20, '_', substr(concat('0', month(o_orderdate)), -2, 2)) FROM {{orders}} JOIN {{lineitem}} ON l_orderkey = o_orderkey JOIN {{part}} ON p_partkey = l_partkey
 UNION ALL SELECT concat(source, '_q', doc_id % 4 + 1, '_', lang, '_', doc_id % 28 + 1) FROM {{documents}}
 UNION ALL SELECT concat(lower(c_mktsegment), '_historic_', c_nationkey) FROM {{customer}}) u"""

PERIOD_TEXTS = f"""SELECT DISTINCT t FROM (
 SELECT concat('Data for ', {MONTH}, '-', year(o_orderdate) % 100 + 20) AS t FROM {{orders}}
 UNION ALL SELECT concat('https://files.example.org/', year(o_orderdate), '/Report_', {MONTH}, year(o_orderdate), '.xlsx') FROM {{orders}}
 UNION ALL SELECT concat('q', quarter(o_orderdate), ' ', year(o_orderdate), '-', substr(concat('0', (year(o_orderdate) + 1) % 100), -2, 2), ' summary') FROM {{orders}}
 UNION ALL SELECT concat('FY', year(o_orderdate) + 15, '-', substr(concat('0', (year(o_orderdate) + 16) % 100), -2, 2)) FROM {{orders}}
 UNION ALL SELECT concat(year(o_orderdate), '-', substr(concat('0', month(o_orderdate)), -2, 2)) FROM {{orders}}
 UNION ALL SELECT concat('week', day(o_orderdate), '-', year(o_orderdate) + 10, '.csv') FROM {{orders}}
 UNION ALL SELECT concat('final-', CASE month(o_orderdate) WHEN 5 THEN 'may' WHEN 10 THEN 'october' WHEN 11 THEN 'november' ELSE 'the' END, '-', year(o_orderdate)) FROM {{orders}}
 UNION ALL SELECT url FROM {{pages}}) u"""

PERIODS = """SELECT DISTINCT code FROM (
 SELECT concat(year(o_orderdate), '-', substr(concat('0', month(o_orderdate)), -2, 2)) AS code FROM {orders}
 UNION ALL SELECT concat('FY', substr(concat('0', year(o_orderdate) % 100), -2, 2), '-Q', quarter(o_orderdate)) FROM {orders}
 UNION ALL SELECT concat('FY', year(o_orderdate), '-', substr(concat('0', (year(o_orderdate) + 1) % 100), -2, 2)) FROM {orders}
 UNION ALL SELECT concat(year(o_orderdate), '-', day(o_orderdate) + 10) FROM {orders}
 UNION ALL SELECT o_orderpriority FROM {orders}) u"""

FILES = f"""SELECT DISTINCT url FROM (
 SELECT concat('https://files.example.org/', year(o_orderdate), '/Online%20Consultation-', {MONTH}, year(o_orderdate) % 100 + 10, '-XLSX-', 10000 + o_orderkey % 9, '.xlsx') AS url FROM {{orders}}
 UNION ALL SELECT concat('https://files.example.org/', replace(p_name, ' ', '-'), '_', lower({MONTH}), '_', year(o_orderdate), '-revised.csv') FROM {{orders}} JOIN {{lineitem}} ON l_orderkey = o_orderkey JOIN {{part}} ON p_partkey = l_partkey
 UNION ALL SELECT concat('https://files.example.org/summary of ', p_type, ' ', year(o_orderdate) + 20, '.zip') FROM {{orders}} JOIN {{lineitem}} ON l_orderkey = o_orderkey JOIN {{part}} ON p_partkey = l_partkey
 UNION ALL SELECT url FROM {{pages}}) u"""

VALUES = """SELECT DISTINCT v FROM (
 SELECT CAST(l_extendedprice AS STRING) AS v FROM {lineitem}
 UNION ALL SELECT concat(CAST(l_orderkey AS STRING), ',', substr(concat('00', CAST(l_partkey % 1000 AS STRING)), -3, 3)) FROM {lineitem}
 UNION ALL SELECT concat(CAST(CAST(l_quantity AS INT) AS STRING), '%') FROM {lineitem}
 UNION ALL SELECT CASE l_linenumber WHEN 1 THEN '*' WHEN 2 THEN ' [c] ' WHEN 3 THEN 'N/A' WHEN 4 THEN 'Low DQ' WHEN 5 THEN '' WHEN 6 THEN 'yes' ELSE 'No' END FROM {lineitem}
 UNION ALL SELECT substr(CAST(l_shipdate AS STRING), 1, 10) FROM {lineitem}
 UNION ALL SELECT concat(substr(CAST(l_shipdate AS STRING), 9, 2), '/', substr(CAST(l_shipdate AS STRING), 6, 2), '/', substr(CAST(l_shipdate AS STRING), 1, 4)) FROM {lineitem}
 UNION ALL SELECT replace(substr(CAST(l_shipdate AS STRING), 1, 10), '-', '') FROM {lineitem}
 UNION ALL SELECT concat(upper(substr('JanFebMarAprMayJunJulAugSepOctNovDec', month(l_shipdate) * 3 - 2, 3)), year(l_shipdate)) FROM {lineitem}
 UNION ALL SELECT concat('£', l_linenumber, '000') FROM {lineitem}
 UNION ALL SELECT concat(year(l_shipdate), '/', (year(l_shipdate) + 1) % 100) FROM {lineitem}) u"""
