"""Adapters from the TPC-H-style test tables to the two retail tables.

shopping line  = one ``lineitem`` row, enriched from ``orders``, ``customer``
and ``part``; behaviour row = one ``customer`` with order and line facts.

Joins are left joins from the fact side onto unique dimension keys, so a
dimension whose columns are not requested is not joined at all: a report on
categories never touches ``customer``. Join strategy is left to Catalyst/AQE
(broadcast only when the size estimate is under the broadcast threshold,
sort-merge otherwise); the one explicit broadcast is the nation table, whose
25 rows do not grow with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.money import as_money
from ..schemas import BEHAVIOUR, SHOPPING

# Declared schemas of the input tables: a Parquet read without one runs a
# footer-reading job per table before planning even starts.
TABLE_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Where the adapter plants what the test tables lack. Order
#: numbers divisible by these have an impossible and a non-date; line 2 of every
#: 53rd order has no invoice number, line 1 of every 79th no quantity, every 71st
#: part no price, and every 50th customer no satisfaction level.
BAD_DATE, NO_DATE, NO_INVOICE, NO_QUANTITY, NO_PRICE, NO_LEVEL = 97, 89, 53, 79, 71, 50


def _age(custkey: Column) -> Column:
    # Stand-in attribute: the test customers carry no age; 15..74 covers every band.
    return (F.lit(15) + custkey % 60).cast("int")


# Dimensions each shopping column needs besides lineitem.
_NEEDS = {
    "invoice_no": (), "quantity": (),
    "customer_id": ("orders",), "age": ("orders",), "payment_method": ("orders",),
    "invoice_date": ("orders",), "gender": ("orders", "customer"),
    "category": ("part",), "price": ("part",),
}


def shopping_from_tables(spark: SparkSession, sf_dir: str, columns=None) -> DataFrame:
    """Shopping lines (``schemas.SHOPPING``) from lineitem/orders/customer/part."""
    columns = list(columns or SHOPPING.fieldNames())
    need = {d for c in columns for d in _NEEDS[c]}
    df = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_linenumber")
    if "part" in need:
        part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_retailprice")
        df = df.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    if "orders" in need:
        # Customer attributes are attached at order granularity (a quarter of
        # the line count), so the line-sized side is shuffled once per join
        # key (part, order) and never by customer.
        orders = table(spark, sf_dir, "orders").select(
            "o_orderkey", "o_custkey", "o_orderpriority",
            # the date text is made once per order, not once per line
            F.when(F.col("o_orderkey") % BAD_DATE == 0, "31/02/2020")
            .when(F.col("o_orderkey") % NO_DATE == 0, "n/a")
            .otherwise(F.date_format("o_orderdate", "d/M/yyyy")).alias("o_orderdate_text"))
        if "customer" in need:
            customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
            orders = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        df = df.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    exprs = {
        "invoice_no": F.when((F.col("l_orderkey") % NO_INVOICE == 0) & (F.col("l_linenumber") == 2), None)
        .otherwise(F.col("l_orderkey").cast("string")),
        "customer_id": F.col("o_custkey").cast("string") if "orders" in need else None,
        "gender": F.col("c_mktsegment") if "customer" in need else None,
        "age": _age(F.col("o_custkey")) if "orders" in need else None,
        "category": F.col("p_type") if "part" in need else None,
        "quantity": F.when((F.col("l_orderkey") % NO_QUANTITY == 0) & (F.col("l_linenumber") == 1), None)
        .otherwise(F.col("l_quantity").cast("int")),
        "price": F.when(F.col("p_partkey") % NO_PRICE == 0, None).otherwise(F.col("p_retailprice"))
        if "part" in need else None,
        "payment_method": F.col("o_orderpriority") if "orders" in need else None,
        "invoice_date": F.col("o_orderdate_text") if "orders" in need else None,
    }
    types = {f.name: f.dataType for f in SHOPPING.fields}
    return df.select(*[exprs[c].cast(types[c]).alias(c) for c in columns])


def behaviour_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One behaviour row per customer (``schemas.BEHAVIOUR``).

    Lines are pre-aggregated per order before the orders join and per customer
    before the customer join, so each shuffle carries at most one row per key
    per map task.
    """
    lines = (table(spark, sf_dir, "lineitem")
             .groupBy("l_orderkey")
             .agg(F.sum(as_money("l_extendedprice")).alias("spend"),
                  F.sum("l_quantity").alias("items"),
                  F.count("*").alias("n_lines"),
                  F.count_if(F.col("l_returnflag") == "R").alias("n_returned"),
                  F.count_if(F.col("l_discount") >= 0.05).alias("n_discounted")))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    last_order_overall = orders.agg(F.max("o_orderdate")).scalar()
    per_customer = (orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
                    .groupBy("o_custkey")
                    .agg(F.max("o_orderdate").alias("last_order"),
                         F.sum("spend").alias("spend"),
                         F.sum("items").alias("items"),
                         F.sum("n_lines").alias("n_lines"),
                         F.sum("n_returned").alias("n_returned"),
                         F.sum("n_discounted").alias("n_discounted")))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    # nation has 25 rows at every scale factor: a proven bound, so it is
    # broadcast explicitly (a shuffle on 25 key values would put all customers
    # in at most 25 tasks)
    nation = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    df = (customer
          .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
          .join(per_customer, F.col("c_custkey") == F.col("o_custkey"), "left"))
    n, bad = F.col("n_lines"), F.col("n_returned")
    satisfaction = (F.when(n.isNull() | (n == 0) | (F.col("c_custkey") % NO_LEVEL == 0), None)
                    .when(bad * 10 >= n * 4, "Unsatisfied")
                    .when(bad * 10 >= n * 3, "Neutral")
                    .otherwise("Satisfied"))
    rating = F.lit(1.0) + F.lit(4.0) * ((n - bad).cast("double") / n.cast("double"))
    exprs = {
        "customer_id": F.col("c_custkey"),
        "gender": F.when(F.col("c_custkey") % 2 == 0, "Female").otherwise("Male"),
        "age": _age(F.col("c_custkey")),
        "city": F.col("n_name"),
        "membership_type": F.col("c_mktsegment"),
        "total_spend": F.col("spend"),
        "items_purchased": F.col("items"),
        "average_rating": rating,
        "discount_applied": F.col("n_discounted") * 2 >= n,
        "days_since_last_purchase": F.datediff(last_order_overall, F.col("last_order")),
        "satisfaction_level": satisfaction,
    }
    return df.select(*[exprs[f.name].cast(f.dataType).alias(f.name) for f in BEHAVIOUR.fields])
