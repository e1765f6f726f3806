"""Transaction view over the order tables used by tests, checks and bench.

Anomalies are injected by modular arithmetic on the keys, so any SQL engine
derives the same rows. The view is defined in FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlint.sources.schema import LINE_COLUMNS, typed_lines
from ledgerlint.sources.tables import dealt, spread

YEAR_SPLIT = "1998-01-01 00:00:00"
FIRST_YEARS, LAST_YEARS = "1995-1997", "1998-2001"
DATE_MIN, DATE_MAX = "1995-01-01 00:00:00", "2001-08-01 00:00:00"

# The columns in use; given so that no job has to infer them.
_TABLES = {
    "lineitem": "l_orderkey long, l_partkey long, l_linenumber int, "
    "l_quantity double, l_extendedprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz",
    "customer": "c_custkey long, c_nationkey int",
    "part": "p_partkey long, p_name string",
}

# Country by nation key; key 7 has none, all others are UK.
_COUNTRIES = {
    1: "EIRE", 2: "Germany", 3: "France", 4: "Netherlands", 5: "Switzerland",
    6: "Australia", 7: None,
}


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture view, exact duplicates included, in one pass over lineitem."""

    def table(name: str) -> DataFrame:
        return spark.read.schema(_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")

    # Orders meet their customers first: lines, several an order, are not shuffled for that.
    placed = table("orders").join(table("customer"), F.col("o_custkey") == F.col("c_custkey"))
    joined = (
        dealt(spread(table("lineitem"), "l_orderkey", "l_linenumber"), "l_orderkey")
        .join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table("part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    ok, pk, ln = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    quantity = F.col("l_quantity").cast("long")
    credit = ok % 20 == 0
    negative = credit | (ok % 50 == 7) | ((ok % 40 == 11) & (ln == 3))
    slot = (ok + ln) % 97

    country = F.lit("United Kingdom")
    for key, name in _COUNTRIES.items():
        country = F.when(F.col("c_nationkey") == key, F.lit(name).cast("string")).otherwise(
            country
        )
    # Orders divisible by 83 appear twice.
    copies = F.when(ok % 83 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return joined.select(
        F.when(credit, F.concat(F.lit("C"), ok.cast("string")))
        .otherwise(ok.cast("string"))
        .alias("invoice"),
        F.concat(F.lit("P"), (pk % 500).cast("string")).alias("stockcode"),
        F.when(slot == 0, F.concat(F.lit("Test sample "), F.col("p_name")))
        .when(slot == 1, F.lit("manual"))
        .when(slot == 2, F.lit("ADJUST bad debt"))
        .when(slot == 3, F.lit(None).cast("string"))
        .otherwise(F.col("p_name"))
        .alias("description"),
        F.when((ok + pk) % 501 == 0, F.lit(1000).cast("long"))
        .when(negative, -quantity)
        .otherwise(quantity)
        .alias("quantity"),
        F.col("o_orderdate").alias("invoicedate"),
        F.when((ok + 2 * pk) % 211 == 0, F.lit(0.0))
        .otherwise(F.col("l_extendedprice") / F.lit(10.0))
        .alias("price"),
        F.when(F.col("o_custkey") % 4 != 3, F.col("o_custkey").cast("string")).alias(
            "customer_id"
        ),
        country.alias("country"),
        F.when(
            F.col("o_orderdate") < F.lit(YEAR_SPLIT).cast("timestamp_ntz"),
            F.lit(FIRST_YEARS),
        )
        .otherwise(F.lit(LAST_YEARS))
        .alias("source_year"),
        F.explode(copies).alias("copy"),
    ).select(*LINE_COLUMNS)


def transactions_with_traps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view with null, NaN, infinite and negative prices and null quantities, as read.

    Reading turns NaN into null.
    """
    code = F.expr("cast(substr(stockcode, 2) AS long)")
    slot = (code * 7 + F.abs("quantity")) % 101
    price = F.when(slot == 0, F.lit(None)).when(slot == 1, float("nan")).when(slot == 2, float("inf"))
    price = price.when(slot == 3, -F.col("price")).when(slot == 4, float("-inf")).otherwise(F.col("price"))
    quantity = F.when((code + F.abs("quantity")) % 103 != 0, F.col("quantity"))
    view = transactions(spark, sf_dir)
    return typed_lines(view.withColumns({"price": price.cast("double"), "quantity": quantity}))
