"""Order tables of the test data seen as retail transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def raw_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """One raw line per line item, with the dirt a real export has.

    Line items and orders both grow with the business, so that join is always a
    shuffle (sort-merge, hot orders split by AQE). For the other tables sizes decide.
    """

    def t(name: str, *cols: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet").select(*cols)

    col = F.col
    buyers = (
        t("customer", "c_custkey", "c_nationkey")
        .join(t("nation", "n_nationkey", "n_name"), col("c_nationkey") == col("n_nationkey"))
        .select("c_custkey", F.when(col("c_custkey") % 500 == 0, "").otherwise(col("n_name")).alias("country"))
    )
    orders = t("orders", "o_orderkey", "o_custkey", "o_orderdate").join(buyers, col("o_custkey") == col("c_custkey"))
    lines = t("lineitem", "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag")
    cancelled = col("o_orderkey") % 50 == 0
    no_date = (col("l_linenumber") == 6) & (col("l_orderkey") % 100 == 1)
    sent_back = (col("l_returnflag") == "R") & (col("l_linenumber") == 7)
    return (
        lines.join(orders.hint("merge"), col("l_orderkey") == col("o_orderkey"))
        .join(t("part", "p_partkey", "p_name", "p_retailprice"), col("l_partkey") == col("p_partkey"))
        .select(
            F.concat(F.when(cancelled, "C").otherwise(""), col("o_orderkey").cast("string")).alias("invoice_no"),
            col("p_partkey").cast("string").alias("stock_code"),
            F.when(col("p_partkey") % 100 == 0, "  ").otherwise(col("p_name")).alias("description"),
            F.when((col("l_linenumber") == 7) & (col("l_orderkey") % 100 == 3), 0)
            .when(cancelled | sent_back, -col("l_quantity"))
            .otherwise(col("l_quantity"))
            .cast("int")
            .alias("quantity"),
            F.when(no_date, None).otherwise(col("o_orderdate").cast("timestamp_ntz")).alias("invoice_date"),
            F.when(col("p_partkey") % 250 == 7, 0).otherwise(col("p_retailprice")).cast("decimal(10,2)").alias("unit_price"),
            F.when(col("o_orderkey") % 4 == 1, "").otherwise(col("o_custkey").cast("string")).alias("customer_id"),
            "country",
        )
    )
