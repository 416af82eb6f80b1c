"""One registered query per operator, over its whole table, and SQL where it can express one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank.llm import (
    ann,
    langid,
    licenses,
    merkle,
    mixing,
    packing,
    quality_classifier,
    quality_rules,
    secrets,
    simhash,
    substrings,
    trie,
    warc,
)
from linkrank.llm.common import ascii_lower, held_out, table
from linkrank.plans import Scratch

QUERY_STEP = 50  # vectors whose id it divides are the queries
NEAREST = 5
FAMILY = 100  # conversations that begin like the first of them


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Documents packed into sequences of 1024 tokens; the digest stands for the token ids."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    digest = {"ids_crc32": F.crc32("ids")}
    return packing.pack(docs, tokenizer_path(), carry=digest)


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Pages written to seekable bundles and read back."""
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return warc.archived(pages).select(
        F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        "refers_to",
    )


def op3_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Places of license phrases in every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = licenses.license_scan(docs).withColumn("base", F.filter("licenses", lambda m: m["base"]))

    def joined(places):
        return F.array_join(F.array_sort(F.array_distinct(F.col(places)["label"])), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(F.col("base.start")).cast("long").alias("first_word"),
        F.array_max(F.col("base.start")).cast("long").alias("last_word"),
        joined("base").alias("base_labels"),
        joined("licenses").alias("labels"),
        F.coalesce(F.array_max(F.col("licenses.coverage")), F.lit(0.0)).alias("score"),
    )


def op4_langid(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from three quarters of them."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs)
    return langid.predict(
        docs.select("doc_id", held_out("doc_id").alias("held_out"), "text"), model
    )


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Documents repeated so that sources count with the root of their size."""
    return mixing.replicated(table(spark, folder, "documents"))


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    groups = simhash.simhash_groups(table(spark, folder, "documents").select("doc_id", "text"))
    hex_digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return groups.select("doc_id", hex_digits.alias("fingerprint"), "component_id")


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger of all documents under the latest policy."""
    lines = quality_rules.ledger(table(spark, folder, "documents").select("doc_id", "text"))
    return quality_rules.apply_policy(lines).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality_rules.passes("base")).alias("base_failed"), "kept", "failed",
    )


def op8_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Quality scores of all documents, learned from three quarters of the labelled ones."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    scored = quality_classifier.scored_documents(docs, labels)
    good = (F.col("score") >= quality_classifier.KEEP_FROM).cast("int")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         good.alias("predicted"))


def op9_nearest(spark: SparkSession, folder: str) -> DataFrame:
    """The 5 nearest vectors of every 50th one."""
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    asked = vectors.where(F.col("vec_id") % QUERY_STEP == 0)
    asked = asked.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("x"))
    return ann.search(ann.build_graph(vectors), asked, NEAREST).withColumnRenamed("id", "vec_id")


def op10_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = secrets.secret_spans(docs)
    kinds = F.array(*(F.lit(kind) for kind in secrets.KINDS))

    def text_of(spans):
        return F.array_join(
            F.transform(
                spans,
                lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"]),
            ),
            ",",
        )

    def count(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("secrets", lambda s: s["kind"] < 3)
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(text_of(base), 256).alias("base_sha256"),
        text_of("secrets").alias("spans"),
    )


def rebuilt(spark: SparkSession, folder: str) -> DataFrame:
    """``conv, turns`` of all conversations, the first 0 to 5 turns of each taken from another one."""
    lists = trie.turn_lists(table(spark, folder, "conversations"))
    lists = Scratch(spark).write(lists, "turns")
    heads = lists.where(F.col("conv") % FAMILY == 0).select(
        F.col("conv").alias("head"), F.slice("turns", 1, 5).alias("begin")
    )
    own = lists.withColumns(
        {
            "head": F.col("conv") - F.col("conv") % FAMILY,
            "h": (F.crc32(F.col("conv").cast("string")) % 6).cast("int"),
        }
    )
    return own.join(heads, "head", "left").selectExpr(
        "conv",
        "concat(IF(begin IS NULL, slice(turns, 1, 0), slice(begin, 1, h)),"
        " slice(turns, h + 1, size(turns))) AS turns",
    )


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """All beginnings that the rebuilt conversations share."""
    return trie.prefix_nodes(rebuilt(spark, folder))


def op12_substrings(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the words that earlier ones have in runs of 13 or more."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return substrings.without_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256")
    )


def op13_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest of all documents, checked on texts of which a fifth have lost their capitals."""
    docs = table(spark, folder, "documents").select(*merkle.COLUMNS)
    touched = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    text = F.when(touched, ascii_lower(F.col("text"))).otherwise(F.col("text"))
    return merkle.manifest(docs, suspect={"text": text})


LLM_QUERIES = {
    query.__name__: query
    for query in (
        op1_packing, op2_warc, op3_licenses, op4_langid, op5_mixing, op6_simhash,
        op7_quality_rules, op8_quality_classifier, op9_nearest, op10_secrets, op11_prefix_trie,
        op12_substrings, op13_manifest,
    )
}
