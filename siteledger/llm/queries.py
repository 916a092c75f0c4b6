"""One named query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chat_format, embedding_dedup, exact_dedup, language_id, merkle_manifest, minhash_dedup, packing, \
    ranked_search, secret_scan, sentencepiece_nbest, substring_dedup, toxicity, url_filters
from .common import table

# The rules of the url query, and the sites whose pages make up its list.
URL_RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"),
             ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
LISTED_SITES = ("ads-track", "spam-farm", "casino-win", "adult-x", "cheap-pills", "free-bets")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(toxicity.training_rows(docs), toxicity.training_rows(labels))
    return toxicity.score(docs, model).select(
        "doc_id", (language_id.folds(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "spans")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = language_id.folds(F.col("doc_id"), 3) == 1
    model = language_id.fit(docs.where(~held_out))
    return language_id.identify(docs, model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_dedup.link(table(spark, sf_dir, "embeddings"))
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.render(table(spark, sf_dir, "conversations"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash_dedup.classes(table(spark, sf_dir, "documents"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.find_copies(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size",
                        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                        F.lower(F.hex("digest")).alias("text_sha256"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated passages as word ranges, with the document and range that stay."""
    docs = table(spark, sf_dir, "documents")
    named = substring_dedup.names(docs)
    found = substring_dedup.repeats(docs, named=named)
    names = docs.select("doc_id", named[0].alias("th")).distinct()
    return found.join(names, "th").join(names.select(F.col("doc_id").alias("other_id"), F.col("th").alias("other_th")), "other_th") \
        .select("doc_id", "start", "end", "other_id", "other_start", "other_end")


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list holds the pages found on sites known for spam, spelled otherwise, and as many others as there are pages.

    So most entries are of no page, and a page may only pass the filter by its canonical form.
    """
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    host, path = url_filters.parts(F.col("url"))
    bad = F.lit(False)
    for site in LISTED_SITES:
        bad = bad | F.concat(F.lit("."), host).contains(f".{site}.")
    front = F.when(host.rlike(r"^(www|m)\."), F.upper(host)).otherwise(F.concat(F.lit("www."), F.upper(host)))
    listed = pages.where(bad).select(F.concat(F.lit("HTTP://"), front, path, F.lit("?from=list")).alias("url")) \
        .unionAll(pages.select(F.concat(F.lit("https://elsewhere-"), host, path).alias("url")))
    return url_filters.judge(pages, URL_RULES, listed).select(
        "page_id", "host", "path", "rule", "verdict", "listed")


def op10_sentencepiece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each segmentation with hashes of its ids and of the text that they decode to."""
    encoded = sentencepiece_nbest.encode(table(spark, sf_dir, "documents"))
    return sentencepiece_nbest.decode(encoded).select(
        "doc_id", "rank", "score", F.size("ids").alias("n_ids"), F.xxhash64("ids").alias("ids_hash"),
        F.md5(F.col("text").cast("binary")).alias("text_md5"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents; one in seven claims a character more than it was registered with."""
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    claimed = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, merkle_manifest.leaf_digest(
        F.col("doc_id"), F.col("source"), F.col("lang"), more, F.col("text")))
    return merkle_manifest.verify(table(spark, sf_dir, "documents"), claimed=claimed)


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(secret_scan.listed(F.col("base")), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = ranked_search.build(table(spark, sf_dir, "documents"))
    return ranked_search.search(index, table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q for q in (
        op1_toxicity, op2_language_id, op3_embedding_dedup, op4_chat_format, op5_packing,
        op6_minhash_dedup, op7_exact_dedup, op8_substring_dedup, op9_url_filters,
        op10_sentencepiece_nbest, op11_merkle_manifest, op12_secret_scan, op13_ranked_search)}
