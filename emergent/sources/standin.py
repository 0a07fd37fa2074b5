"""Role mapping of the TPC-H-style test tables onto the contrast-mining data model.

entity = part, features = brand / type / size / name words, label = nation of the
ordering customer, association = one lineitem (status = ``l_returnflag``; N is the
positive class, R the negative one), entity bridge = suppliers that shipped the part,
label bridge = suppliers located in the nation.  Every frame is lazy; Catalyst
prunes the parquet columns and pushes the status filter into the lineitem scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emergent.functions.items import MESH_PREFIX

# Fixed values of the stand-in mapping.
POSITIVE_STATUS = ("N",)
NEGATIVE_STATUS = ("R",)
LABEL_PREFIX = "LABEL_"
FEATURE_PREFIXES = ("BRAND_", "TYPE_", "SIZE_", "WORD_")


# Columns each role reads (types as stored).  Reading with an explicit schema
# skips the footer-inference job and prunes every other column at the scan.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_returnflag string",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
    "supplier": "s_suppkey bigint, s_nationkey int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = SCHEMAS.get(name)
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt to as many tasks as their bytes ask for: a file of one row group is read by one task alone."""
    return df.hint("rebalance")


def associations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per lineitem: (order_key, line_number, entity_id, label_id, label_name, status).

    Orders get their nation first, so that the lineitems, the many rows, are shuffled once only.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    placed = (orders.join(customer.join(nation, F.col("c_nationkey") == nation.n_nationkey),
                          F.col("o_custkey") == customer.c_custkey)
              .select("o_orderkey", "c_nationkey", "n_name"))
    return (
        li.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("l_orderkey").alias("order_key"),
            F.col("l_linenumber").alias("line_number"),
            F.col("l_partkey").alias("entity_id"),
            F.col("c_nationkey").alias("label_id"),
            F.col("n_name").alias("label_name"),
            F.col("l_returnflag").alias("status"),
        )
    )


def split_key(order_key: str = "order_key", line_number: str = "line_number",
              entity: str = "entity_id") -> F.Column:
    """Text key hashed by the hold-out split: ``order-line-part``."""
    return F.concat_ws("-", F.col(order_key).cast("string"), F.col(line_number).cast("string"),
                       F.col(entity).cast("string"))


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity_id, entity_name, features) with features sorted and distinct."""
    part = spread(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size"))
    words = F.filter(F.split(F.col("p_name"), " "), lambda w: w != F.lit(""))
    tokens = F.concat(
        F.array(
            F.concat(F.lit("BRAND_"), F.col("p_brand")),
            F.concat(F.lit("TYPE_"), F.col("p_type")),
            F.concat(F.lit("SIZE_"), F.col("p_size").cast("string")),
        ),
        F.transform(words, lambda w: F.concat(F.lit("WORD_"), w)),
    )
    return part.select(
        F.col("p_partkey").alias("entity_id"),
        F.col("p_name").alias("entity_name"),
        F.array_sort(F.array_distinct(F.filter(tokens, lambda t: t.isNotNull()))).alias("features"),
    )


def entity_bridge_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long form (entity_id, bridge_item): distinct suppliers that shipped the part."""
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey")
    return li.select(F.col("l_partkey").alias("entity_id"),
                     F.col("l_suppkey").cast("string").alias("bridge_item")).distinct()


def label_bridge_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows shaped like the label-bridge TSV: (bridge_item, label_name, label_key)."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.col("s_suppkey").cast("string").alias("bridge_item"),
        F.col("n_name").alias("label_name"),
        F.concat(F.lit(MESH_PREFIX), F.col("n_nationkey").cast("string")).alias("label_key"),
    )
