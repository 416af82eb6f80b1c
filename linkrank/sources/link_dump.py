"""Link tables dumped as SQL ``INSERT`` statements, plain or gzipped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank.plans import Scratch, heaviest, salted_join

PACKED = (".gz", ".zst", ".xz", ".lz4", ".snappy", ".deflate")  # each file is read by one task
PACKED_BYTES_PER_PARTITION = 32 * 1024 * 1024  # several times as many when unpacked
WORTH_A_CORE = 1024 * 1024  # packed bytes for which another core is worth a shuffle

# The dump's format.
INSERT_PREFIX = "INSERT INTO `pagelinks` VALUES"
# (from_id,namespace,'title',from_namespace); the title may hold backslash escapes. The
# possessive quantifiers (*+) never backtrack, so a line of any length needs no stack.
TUPLE = r"(?s)\((\d+),(\d+),'([^'\\]*+(?:\\.[^'\\]*+)*+)',(\d+)\)"


def parse_link_dump(spark: SparkSession, path: str) -> DataFrame:
    """``source_id, target_title`` of the links from and to the main namespace (0).

    Every tuple on a line that starts with the INSERT prefix is a link; duplicates are kept.
    In titles ``\\'`` becomes ``'`` and then ``\\\\`` becomes ``\\``.
    """
    lines = spark.read.text(path).where(F.startswith("value", F.lit(INSERT_PREFIX)))
    packed = [name for name in lines.inputFiles() if name.lower().endswith(PACKED)]
    if packed:
        # spread the lines before taking them apart, if there are few files for their bytes
        size, cores = _bytes(spark, packed), spark.sparkContext.defaultParallelism
        wanted = max(min(cores, size // WORTH_A_CORE), -(-size // PACKED_BYTES_PER_PARTITION))
        if len(packed) < wanted:
            lines = lines.repartition(wanted, F.xxhash64("value"))
    links = lines.select(
        F.explode(F.regexp_extract_all("value", F.lit(TUPLE), F.lit(0))).alias("link")
    )
    # before the first ,' stand the ids, after the last ', the other namespace
    return (
        links.selectExpr(
            "link",
            """substring_index(link, ",'", 1) AS head""",
            """substring_index(link, "',", -1) AS tail""",
        )
        .where(
            "CAST(substring_index(head, ',', -1) AS BIGINT) = 0"
            " AND CAST(rtrim(')', tail) AS BIGINT) = 0"
        )
        .selectExpr(
            "CAST(substring(substring_index(head, ',', 1), 2) AS BIGINT) AS source_id",
            "substring(link, length(head) + 3, length(link) - length(head) - length(tail) - 4)"
            " AS title",
        )
        .select(
            "source_id",
            F.replace(
                F.replace("title", F.lit("\\'"), F.lit("'")), F.lit("\\\\"), F.lit("\\")
            ).alias("target_title"),
        )
    )


def _bytes(spark: SparkSession, names: list[str]) -> int:
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    paths = [spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name)) for name in names]
    return sum(path.getFileSystem(hadoop).getFileStatus(path).getLen() for path in paths)


def resolve_page_ids(links: DataFrame, pages: DataFrame) -> DataFrame:
    """``src, dst`` by title: ``links`` from a dump with their source ids looked up in
    ``pages`` (``id, title``, one row per id). Links from unknown pages drop out.

    The links are written first: counting the heavy pages and the join read that table, and the
    dump is taken apart once."""
    links = Scratch(links.sparkSession).write(links, "links")
    users = links.groupBy("source_id").agg(F.count(F.lit(1)).alias("n"))
    most = users.agg(F.max("n")).first()[0] or 0  # without a heavy page the links are not salted
    titles = pages.select(F.col("id").alias("source_id"), F.col("title").alias("src"))
    return salted_join(
        links, titles, "source_id", heaviest(users, "source_id", "n", at_most=most)
    ).select("src", F.col("target_title").alias("dst"))
