"""Retail tables (sales, items, stores, oil, holidays, promos) derived from the given Parquet tables.

Each view exists twice: as a DataFrame for the engine and as a SQL common table expression for the check.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that a task sums up, and the rows of a table up to which Spark's own dealing is left as it is.
_TASK_ROWS, _SMALL_ROWS = 250_000, 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _item(brand: str = "p_brand"):
    return F.substr(F.col(brand), F.lit(7)).cast("int")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (date, store, item): the item is the brand number of the part.

    Hardly any two line items are of one row, so a task's sums take as much memory as its rows: of a large table they are dealt
    to tasks of about ``_TASK_ROWS`` before they are summed up.
    """
    lineitem, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    promo = F.when(F.max("l_tax") == 0, F.lit(None)).otherwise(F.max("l_discount") >= 0.05)
    keys = ["date", "store_nbr", "item_nbr"]
    lines = lineitem.join(part, lineitem.l_partkey == part.p_partkey).select(
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_suppkey").alias("store_nbr"),
        _item().alias("item_nbr"),
        "l_quantity",
        "l_tax",
        "l_discount",
    )
    # Parquet files know their number of rows.
    n_rows = lineitem.count()
    if n_rows > _SMALL_ROWS:
        unit = int(spark.conf.get("spark.sql.shuffle.partitions"))
        lines = lines.repartition(unit * math.ceil(n_rows / (_TASK_ROWS * unit)), *keys)
    return lines.groupBy(*keys).agg(F.sum("l_quantity").alias("unit_sales"), promo.alias("onpromotion"))


SALES = """sales AS (
  SELECT CAST(l_shipdate AS DATE) AS date, l_suppkey AS store_nbr, CAST(substr(p_brand, 7) AS INTEGER) AS item_nbr,
         SUM(l_quantity) AS unit_sales,
         CASE WHEN MAX(l_tax) = 0 THEN NULL ELSE MAX(l_discount) >= 0.05 END AS onpromotion
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3)"""


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several rows per item on purpose; ``p_partkey`` gives their order."""
    return table(spark, sf_dir, "part").select(
        _item().alias("item_nbr"), F.col("p_type").alias("family"), F.col("p_size").alias("class"), "p_partkey"
    )


ITEMS = """items AS (
  SELECT CAST(substr(p_brand, 7) AS INTEGER) AS item_nbr, p_type AS family, p_size AS class, p_partkey FROM part)"""


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier, nation, region = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    return (
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(F.col("s_suppkey").alias("store_nbr"), F.col("n_name").alias("city"), F.col("r_name").alias("state"))
    )


STORES = """stores AS (
  SELECT s_suppkey AS store_nbr, n_name AS city, r_name AS state
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def oil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A daily price with holes: weekdays only, NULL on every fifth day of the month and on the first days.

    The square root keeps interpolated values off decimal ties, where two engines may round apart.
    """
    price = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderdate").cast("date").alias("date"))
        .agg(F.sqrt(F.max("o_totalprice")).alias("price"))
        .where(F.weekday("date") < 5)
    )
    first = price.agg(F.min("date")).scalar()
    hole = (F.datediff("date", first) < 3) | (F.dayofmonth("date") % 5 == 0)
    return price.select("date", F.when(~hole, F.col("price")).alias("dcoilwtico"))


OIL = """oil_days AS (
  SELECT CAST(o_orderdate AS DATE) AS date, sqrt(MAX(o_totalprice)) AS price FROM orders
  WHERE isodow(CAST(o_orderdate AS DATE)) < 6 GROUP BY 1),
oil AS (
  SELECT date, CASE WHEN date_diff('day', (SELECT MIN(date) FROM oil_days), date) < 3
                      OR extract(day FROM date) % 5 = 0 THEN NULL ELSE price END AS dcoilwtico
  FROM oil_days)"""


def holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One holiday row per order: its type, scope and description follow from the order, customer and region."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    joined = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
    )
    priority, status, segment = F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("c_mktsegment")
    kind = (
        F.when(priority == "1-URGENT", "Holiday")
        .when(priority == "2-HIGH", "Additional")
        .when((priority == "3-MEDIUM") & (status == "P"), "Half Day")
        .when(priority == "3-MEDIUM", "Transfer")
        .when((priority == "4-NOT SPECIFIED") & (status == "P"), "Work Day")
        .when(priority == "4-NOT SPECIFIED", "Bridge")
        .otherwise("Event")
    )
    scope = F.when(segment == "BUILDING", "Local").when(segment == "MACHINERY", "Regional").otherwise("National")
    prefix = (
        F.when(kind == "Transfer", "Traslado ")
        .when(kind == "Bridge", "PUENTE  ")
        .when(kind == "Work Day", "Recupero puente ")
        .otherwise("")
    )
    day = F.dayofmonth(F.col("o_orderdate"))
    suffix = (
        F.when(day <= 10, "")
        .when(day <= 20, F.concat(F.lit("+"), (day - 10).cast("string")))
        .otherwise(F.concat(F.lit("-"), (day - 20).cast("string")))
    )
    label = F.concat(F.lit("Día de  "), F.replace(F.lower(segment), F.lit("i"), F.lit("í")), F.lit(" "), F.col("r_name"))
    return joined.select(
        F.col("o_orderkey").alias("holiday_id"),
        F.col("o_orderdate").cast("date").alias("date"),
        kind.alias("type"),
        scope.alias("locale"),
        F.when(scope == "Local", F.col("n_name")).when(scope == "Regional", F.col("r_name")).otherwise("All").alias(
            "locale_name"
        ),
        F.when(F.col("o_totalprice") >= 5000, F.concat(F.lit(" "), prefix, label, suffix)).alias("description"),
        (status == "F").alias("transferred"),
    )


HOLIDAYS = """holiday_base AS (
  SELECT o_orderkey AS holiday_id, CAST(o_orderdate AS DATE) AS date, o_orderstatus, o_totalprice, c_mktsegment,
         n_name, r_name,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'Holiday'
              WHEN o_orderpriority = '2-HIGH' THEN 'Additional'
              WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P' THEN 'Half Day'
              WHEN o_orderpriority = '3-MEDIUM' THEN 'Transfer'
              WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN 'Work Day'
              WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Bridge'
              ELSE 'Event' END AS type,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'Local' WHEN 'MACHINERY' THEN 'Regional' ELSE 'National' END AS locale
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey),
holidays AS (
  SELECT holiday_id, date, type, locale,
         CASE locale WHEN 'Local' THEN n_name WHEN 'Regional' THEN r_name ELSE 'All' END AS locale_name,
         CASE WHEN o_totalprice >= 5000 THEN
           ' ' || CASE type WHEN 'Transfer' THEN 'Traslado ' WHEN 'Bridge' THEN 'PUENTE  '
                            WHEN 'Work Day' THEN 'Recupero puente ' ELSE '' END
           || 'Día de  ' || replace(lower(c_mktsegment), 'i', 'í') || ' ' || r_name
           || CASE WHEN extract(day FROM date) <= 10 THEN ''
                   WHEN extract(day FROM date) <= 20 THEN '+' || CAST(extract(day FROM date) - 10 AS VARCHAR)
                   ELSE '-' || CAST(extract(day FROM date) - 20 AS VARCHAR) END
         END AS description,
         o_orderstatus = 'F' AS transferred
  FROM holiday_base)"""


def promos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Promotion rows on the full key, several per key; order and line number give their order."""
    lineitem, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    return lineitem.join(part, lineitem.l_partkey == part.p_partkey).select(
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_suppkey").alias("store_nbr"),
        _item().alias("item_nbr"),
        (F.col("l_discount") >= 0.05).alias("onpromotion"),
        F.col("l_quantity").alias("unit_sales"),
        F.col("l_extendedprice").alias("list_price"),
        "l_orderkey",
        "l_linenumber",
    )


PROMOS = """promos AS (
  SELECT CAST(l_shipdate AS DATE) AS date, l_suppkey AS store_nbr, CAST(substr(p_brand, 7) AS INTEGER) AS item_nbr,
         l_discount >= 0.05 AS onpromotion, l_quantity AS unit_sales, l_extendedprice AS list_price,
         l_orderkey, l_linenumber
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def text_promos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a promotion state written as words."""
    flag, tax = F.col("l_returnflag"), F.col("l_tax")
    word = (
        F.when(tax == 0, F.when(flag == "A", "").when(flag == "N", F.lit(None)).otherwise("unknown"))
        .when(F.col("l_discount") >= 0.05, F.when(flag == "A", " True").when(flag == "N", "YES").otherwise("true"))
        .otherwise(F.when(flag == "A", "False ").when(flag == "N", "no").otherwise("FALSE"))
    )
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_tax", word.alias("promo_text"))


TEXT_PROMOS = """text_promos AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_tax,
         CASE WHEN l_tax = 0 THEN CASE l_returnflag WHEN 'A' THEN '' WHEN 'N' THEN NULL ELSE 'unknown' END
              WHEN l_discount >= 0.05 THEN CASE l_returnflag WHEN 'A' THEN ' True' WHEN 'N' THEN 'YES' ELSE 'true' END
              ELSE CASE l_returnflag WHEN 'A' THEN 'False ' WHEN 'N' THEN 'no' ELSE 'FALSE' END END AS promo_text
  FROM lineitem)"""


def store_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sparse daily price per item: many series of one shape, with NULL on every third day of the month."""
    lineitem, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    return (
        lineitem.join(part, lineitem.l_partkey == part.p_partkey)
        .groupBy(_item().alias("item_nbr"), F.col("l_shipdate").cast("date").alias("date"))
        .agg(F.sqrt(F.max("l_extendedprice")).alias("price"))
        .withColumn("price", F.when(F.dayofmonth("date") % 3 != 0, F.col("price")))
    )


STORE_PRICES = """store_prices AS (
  SELECT CAST(substr(p_brand, 7) AS INTEGER) AS item_nbr, CAST(l_shipdate AS DATE) AS date,
         CASE WHEN extract(day FROM CAST(l_shipdate AS DATE)) % 3 <> 0 THEN sqrt(MAX(l_extendedprice)) END AS price
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"""
