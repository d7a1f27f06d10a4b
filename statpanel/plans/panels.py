"""Panels derived from the star-schema tables, in the shape of enriched observations.

Nation panels are small whatever the scale of the tables; the customer and supplier panels grow with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statpanel.functions import round_whole

NATIONAL = "ALL NATIONS"
ALL_TYPES = "All types total"
TYPE_PREFIX = "Revenue by type: "
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
NOTE = 'rev "A", prelim'


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _position(values: list[str], column: str, offset: int = 0) -> Column:
    """1-based place of a value in a list, as text."""
    place = F.array_position(F.array(*[F.lit(v) for v in values]), F.col(column))
    return (place + offset).cast("string")


def _cents(amount: Column) -> Column:
    return round_whole(amount * 100).cast("bigint")


def _year(date: str) -> Column:
    return F.year(date).cast("string")


def _fips(key: str, width: int) -> Column:
    return F.lpad(F.col(key).cast("string"), width, "0")


def observations(
    df: DataFrame, table: str, endpoint: Column, topic: Column, unit: str, mult: int = 0
) -> DataFrame:
    """Enriched observations from rows with geofips, geoname, timeperiod and datavalue."""
    return df.select(
        F.concat_ws("-", F.lit(table), endpoint).alias("code"),
        "geofips",
        "geoname",
        "timeperiod",
        F.lit(unit).alias("cl_unit"),
        F.lit(mult).cast("bigint").alias("unit_mult"),
        "datavalue",
        F.when(F.col("geofips").endswith("3"), F.lit(NOTE)).alias("noteref"),
        F.lit(table).alias("table"),
        endpoint.alias("endpoint"),
        topic.alias("topic"),
    )


def _measures() -> list[Column]:
    cents = _cents(F.col("o_totalprice"))
    finished = F.when(F.col("o_orderstatus") == "F", cents).otherwise(F.lit(0).cast("bigint"))
    return [F.count(F.lit(1)).alias("orders"), F.sum(cents).alias("total"), F.sum(finished).alias("finished")]


def orders_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per customer, day and priority: what a query writes once to build several panels over orders from it."""
    day = F.to_date("o_orderdate").alias("day")
    rows = read(spark, sf_dir, "orders").groupBy("o_custkey", day, "o_orderpriority").agg(*_measures())
    return rows.withColumn("timeperiod", _year("day"))


def _orders_by_customer(spark: SparkSession, sf_dir: str, *extra: str, base: DataFrame | None = None) -> DataFrame:
    """Orders per customer, year and `extra`: their number, their value, the value of finished ones.

    Aggregated before any join, so a customer with a large share of all orders is a few rows from here on. With `base`, a
    written `orders_by_day`, the orders are not read again.
    """
    if base is not None:
        sums = [F.sum(c).alias(c) for c in ("orders", "total", "finished")]
        return base.groupBy("o_custkey", "timeperiod", *extra).agg(*sums)
    by = ["o_custkey", _year("o_orderdate").alias("timeperiod"), *extra]
    return read(spark, sf_dir, "orders").groupBy(*by).agg(*_measures())


def _orders_by_nation(spark: SparkSession, sf_dir: str, *extra: str, base: DataFrame | None = None) -> DataFrame:
    customer = read(spark, sf_dir, "customer")
    nation = read(spark, sf_dir, "nation")
    return (
        _orders_by_customer(spark, sf_dir, *extra, base=base)
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumns({"geofips": _fips("n_nationkey", 5), "geoname": F.col("n_name")})
    )


def segments(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    """Nation, year, market segment -> order value in cents."""
    rows = (
        _orders_by_nation(spark, sf_dir, base=base)
        .groupBy("geofips", "geoname", "timeperiod", "c_mktsegment")
        .agg(F.sum("total").alias("datavalue"))
    )
    topic = F.concat(F.lit("Order value: "), "c_mktsegment")
    return observations(rows, "SEG1", _position(SEGMENTS, "c_mktsegment"), topic, "cents")


def with_national(panel: DataFrame, mark: str = "") -> DataFrame:
    """The panel and its total over all entities, named `ALL NATIONS` + mark."""
    total = panel.groupBy("code", "timeperiod", "cl_unit", "unit_mult", "table", "endpoint", "topic").agg(
        F.sum("datavalue").alias("datavalue")
    )
    total = total.withColumns(
        {
            "geofips": F.lit("99999"),
            "geoname": F.lit(NATIONAL + mark),
            "noteref": F.lit(None).cast("string"),
        }
    )
    return panel.unionByName(total)


def with_regions(panel: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nation panel and rows per region."""
    regions = (
        read(spark, sf_dir, "nation")
        .join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("n_name").alias("geoname"),
            F.concat(F.lit("R"), _fips("r_regionkey", 4)).alias("_fips"),
            F.col("r_name").alias("_name"),
        )
    )
    kept = ["code", "timeperiod", "cl_unit", "unit_mult", "table", "endpoint", "topic"]
    rows = (
        panel.join(regions, "geoname")
        .groupBy(*kept, "_fips", "_name")
        .agg(F.sum("datavalue").alias("datavalue"))
        .withColumnsRenamed({"_fips": "geofips", "_name": "geoname"})
        .withColumn("noteref", F.lit(None).cast("string"))
    )
    return panel.unionByName(rows)


def with_gaps(panel: DataFrame) -> DataFrame:
    """The panel without one year in seven per entity."""
    return panel.filter(F.col("timeperiod").cast("int") % 7 != F.col("geofips").cast("int") % 7)


def priorities(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    """Nation, year, order priority -> number of orders."""
    rows = (
        _orders_by_nation(spark, sf_dir, "o_orderpriority", base=base)
        .groupBy("geofips", "geoname", "timeperiod", "o_orderpriority")
        .agg(F.sum("orders").alias("datavalue"))
    )
    return observations(
        rows, "PRI1", _position(PRIORITIES, "o_orderpriority"), F.col("o_orderpriority"), "orders"
    )


def activity(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    """Nation, year -> `Total orders` and `Active customers`."""
    rows = (
        _orders_by_nation(spark, sf_dir, base=base)
        .groupBy("geofips", "geoname", "timeperiod")
        .agg(F.sum("orders").alias("Total orders"), F.count(F.lit(1)).alias("Active customers"))
    )
    return _activity(rows, "ACT1")


def _activity(rows: DataFrame, table: str) -> DataFrame:
    topics = ["Total orders", "Active customers"]
    long = rows.unpivot(["geofips", "geoname", "timeperiod"], topics, "_topic", "datavalue")
    return observations(long, table, _position(topics, "_topic"), F.col("_topic"), "count")


def incomes(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Nation, year -> order value per customer: of finished orders, and of all orders."""
    rows = (
        _orders_by_nation(spark, sf_dir, base=base)
        .groupBy("geofips", "geoname", "timeperiod")
        .agg(
            F.sum("finished").alias("finished"),
            F.sum("total").alias("total"),
            F.count(F.lit(1)).alias("per"),
        )
    )
    return _incomes(rows, "INC")


def _incomes(rows: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    def one(n: str, column: str, topic: str) -> DataFrame:
        values = rows.withColumn("datavalue", F.col(column) / F.col("per"))
        return observations(values, table + n, F.lit("1"), F.lit(topic), "cents per customer")

    return (
        one("1", "finished", "Per customer disposable order value"),
        one("2", "total", "Per customer personal order value"),
    )


def _revenue_by_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue in cents per supplier, year and part type, before the supplier is joined."""
    part = read(spark, sf_dir, "part")
    revenue = _cents(F.col("l_extendedprice") * (1 - F.col("l_discount")))
    rows = (
        read(spark, sf_dir, "lineitem")
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_suppkey", _year("l_shipdate").alias("timeperiod"), "p_type")
        .agg(F.sum(revenue).alias("datavalue"))
    )
    return rows.join(read(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))


def _part_types(rows: DataFrame, table: str) -> DataFrame:
    """Per entity, year and part type the revenue, and the same over all types."""
    entity = ["geofips", "geoname", "timeperiod"]
    both = rows.withColumn("_type", F.explode(F.array("p_type", F.lit(ALL_TYPES))))
    totals = both.groupBy(*entity, "_type").agg(F.sum("datavalue").alias("datavalue"))
    is_total = F.col("_type") == ALL_TYPES
    endpoint = F.when(is_total, F.lit("1")).otherwise(_position(TYPES, "_type", 10))
    topic = F.when(is_total, F.col("_type")).otherwise(
        F.concat(F.lit(TYPE_PREFIX), "_type", F.lit(" ("), endpoint, F.lit(")"))
    )
    return observations(totals, table, endpoint, topic, "cents")


def part_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation of the supplier, year, part type -> revenue in cents."""
    nation = read(spark, sf_dir, "nation")
    rows = (
        _revenue_by_supplier(spark, sf_dir)
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .withColumns({"geofips": _fips("n_nationkey", 5), "geoname": F.col("n_name")})
    )
    return _part_types(rows, "TYP1")


def supplier_part_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier, year, part type -> revenue in cents."""
    rows = _revenue_by_supplier(spark, sf_dir).withColumns(
        {"geofips": _fips("s_suppkey", 9), "geoname": F.col("s_name")}
    )
    return _part_types(rows, "TYP2")


def _named_customers(rows: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names joined to rows that are already aggregated by customer."""
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return rows.join(customer, F.col("o_custkey") == F.col("c_custkey")).withColumns(
        {"geofips": _fips("c_custkey", 9), "geoname": F.col("c_name")}
    )


def customer_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer, year, order priority -> order value in cents."""
    rows = _orders_by_customer(spark, sf_dir, "o_orderpriority").withColumn("datavalue", F.col("total"))
    topic = F.concat(F.lit("Order value: "), "o_orderpriority")
    return observations(
        _named_customers(rows, spark, sf_dir),
        "CUS1",
        _position(PRIORITIES, "o_orderpriority"),
        topic,
        "cents",
    )


def customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer, year, order priority -> number of orders; most groups have tied tops."""
    rows = _orders_by_customer(spark, sf_dir, "o_orderpriority").withColumn("datavalue", F.col("orders"))
    return observations(
        _named_customers(rows, spark, sf_dir),
        "CUS2",
        _position(PRIORITIES, "o_orderpriority"),
        F.col("o_orderpriority"),
        "orders",
    )


def customer_activity(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    """Customer, year -> `Total orders`, and `Active customers` for the days with an order."""
    if base is None:
        base = orders_by_day(spark, sf_dir)
    rows = base.groupBy("o_custkey", "timeperiod").agg(
        F.sum("orders").alias("Total orders"), F.count_distinct("day").alias("Active customers")
    )
    return _activity(_named_customers(rows, spark, sf_dir), "ACT2")


def customer_incomes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customer, year -> value per order: of finished orders, and of all orders."""
    rows = _orders_by_customer(spark, sf_dir).withColumn("per", F.col("orders"))
    return _incomes(_named_customers(rows, spark, sf_dir), "CIN")


def raw_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(Key, Desc)` of the part types, one row per part: nearly all rows repeat.

    Parts of size 1 carry a key with a bracket.
    """
    code = _position(TYPES, "p_type", 10)
    marked = F.when(F.col("p_size") == 1, F.concat(code, F.lit("(s)"))).otherwise(code)
    return read(spark, sf_dir, "part").select(
        marked.alias("Key"),
        F.concat(F.lit(f"[TYP1] {TYPE_PREFIX}"), "p_type", F.lit(" ("), code, F.lit(")")).alias("Desc"),
    )
