"""Joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.tables import rounded, table
from clickweir.ml.train import label_rows
from clickweir.operators.joins import hot_keys, merge_join, salted_join, star_join


def star(spark: SparkSession, d: str) -> DataFrame:
    customer = table(spark, d, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey")
    )
    region = table(spark, d, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    joined = star_join(
        table(spark, d, "orders").select("o_custkey", "o_totalprice"),
        [
            (customer, ["o_custkey"]),
            (table(spark, d, "nation"), ["n_nationkey"]),
            (region, ["n_regionkey"]),
        ],
    )
    return rounded(
        joined.groupBy("r_name", "n_name").agg(
            F.count("*").alias("orders"), F.sum("o_totalprice").alias("total")
        ),
        2,
    )


def large_merge(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority"
    )
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_extendedprice", "l_discount")
    joined = merge_join(lines, orders, ["l_orderkey"])
    revenue = F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue")
    return rounded(
        joined.groupBy("o_orderpriority").agg(F.count("*").alias("lines"), revenue), 2
    )


def salted(spark: SparkSession, d: str) -> DataFrame:
    """Every third line goes to one supplier: the only hot key."""
    hot = (F.col("l_orderkey") + F.col("l_linenumber")) % 3 == 0
    lines = table(spark, d, "lineitem").select(
        F.when(hot, F.lit(1)).otherwise(F.col("l_suppkey")).alias("l_suppkey"),
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
    )
    suppliers = table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_nationkey"
    )
    joined = salted_join(
        lines,
        suppliers,
        ["l_suppkey"],
        salts=8,
        share=0.25,
        spread_by=["l_orderkey", "l_linenumber"],
    )
    hot_count = hot_keys(lines, ["l_suppkey"], 0.25).agg(F.count("*")).scalar()
    return rounded(
        joined.groupBy("s_name", "s_nationkey").agg(
            F.count("*").alias("lines"),
            F.sum("l_quantity").alias("quantity"),
            F.max(hot_count).alias("hot_keys"),
        ),
        2,
    )


def hot(spark: SparkSession, d: str) -> DataFrame:
    return hot_keys(table(spark, d, "orders"), ["o_custkey"], 0.0008)


def label_join(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "labels").withColumnRenamed("quality", "label")
    docs = table(spark, d, "documents").select("doc_id", "lang", "n_chars")
    return label_rows(docs, labels, "doc_id")


CHECKS = {
    "star_broadcast_join": (
        star,
        """select r_name, n_name, count(*) as orders, round(sum(o_totalprice), 2) as total
           from orders join customer on o_custkey = c_custkey
           join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
           group by all""",
    ),
    "large_merge_join": (
        large_merge,
        """select o_orderpriority, count(*) as lines,
             round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue
           from lineitem join orders on l_orderkey = o_orderkey group by all""",
    ),
    "salted_skew_join": (
        salted,
        """select s_name, s_nationkey, count(*) as lines, round(sum(l_quantity), 2) as quantity,
             1 as hot_keys
           from (select *, case when (l_orderkey + l_linenumber) % 3 = 0 then 1 else l_suppkey end
                   as supplier from lineitem)
           join supplier on supplier = s_suppkey group by all""",
    ),
    "hot_keys": (
        hot,
        """select o_custkey, count(*) as key_rows from orders group by o_custkey
           having count(*) > 0.0008 * (select count(*) from orders)""",
    ),
    "label_join": (
        label_join,
        """select doc_id, lang, n_chars, quality as label, toxic
           from documents join labels using (doc_id)""",
    ),
}
