"""Link graphs read off the given tables, each with the SQL that defines it.

All have ``src string, dst string`` and are built from whole tables. Their size grows linearly
with the tables: no row is paired with more than one partner.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank.operators.graph import dedup_edges
from linkrank.sources.link_dump import _bytes

BYTES_PER_PARTITION = 8 * 1024 * 1024  # of the stored lines: some 400,000 of them


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def part_next_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Every ordered part links to the first part on the order's next line."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    first = lines.groupBy("l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber")).agg(
        F.min("l_partkey").alias("next")
    )
    return lines.join(first, ["l_orderkey", "l_linenumber"]).select(
        F.col("l_partkey").cast("string").alias("src"), F.col("next").cast("string").alias("dst")
    )


def page_link_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Every page links to the targets of its ``href`` attributes."""
    return table(spark, folder, "pages").select(
        F.col("url").alias("src"),
        F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("dst"),
    )


def customer_supplier_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Every customer links to the suppliers of the lines they ordered.

    The lines are dealt out by their stored size, so a task that joins and then deduplicates them holds few
    of them however many there are.
    """
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey"
    )
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_suppkey")
    wanted = -(-_bytes(spark, lines.inputFiles()) // BYTES_PER_PARTITION)
    if wanted > spark.sparkContext.defaultParallelism:
        lines = lines.repartition(wanted, "l_orderkey")
    return lines.join(orders, "l_orderkey").select(
        F.concat(F.lit("c"), F.col("o_custkey")).alias("src"),
        F.concat(F.lit("s"), F.col("l_suppkey")).alias("dst"),
    )


ROWS = {
    "part_next": part_next_rows,
    "page_link": page_link_rows,
    "cust_supp": customer_supplier_rows,
}

ROWS_SQL = {
    "part_next": """
        SELECT CAST(a.l_partkey AS VARCHAR) AS src, CAST(b.next AS VARCHAR) AS dst
        FROM lineitem a JOIN (
            SELECT l_orderkey, l_linenumber, MIN(l_partkey) AS next
            FROM lineitem GROUP BY l_orderkey, l_linenumber
        ) b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1""",
    "page_link": """
        SELECT url AS src, UNNEST(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS dst
        FROM pages""",
    "cust_supp": """
        SELECT 'c' || o_custkey AS src, 's' || l_suppkey AS dst
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey""",
}


def edges(spark: SparkSession, folder: str, graph: str) -> DataFrame:
    return dedup_edges(ROWS[graph](spark, folder))


def edges_sql(graph: str) -> str:
    """The CTE ``e`` of the graph's distinct edges."""
    return f"e AS MATERIALIZED (SELECT DISTINCT src, dst FROM ({ROWS_SQL[graph]}))"
