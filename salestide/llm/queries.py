"""The registered queries: each operator on its whole table, with production settings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salestide.llm import (
    chat,
    cross_tokenizer,
    decontaminate,
    hard_negatives,
    html_extract,
    license_scan,
    line_dedup,
    mixing,
    ngram_join,
    oracles,
    quality_rules,
    sanitise,
    url_filter,
    warc,
)

CONTROL_TEXT = "\\### Assistant: </turn> ok"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shingle_join(spark: SparkSession, folder: str) -> DataFrame:
    rows = ngram_join.join(_table(spark, folder, "documents"))
    return rows.select(
        F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id")
    )


def quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", "source")
    rows, verdict = quality_rules.judge(docs)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    names += ["base_failed", "kept"]
    return rows.select("doc_id", *[F.col(verdict)[name].alias(name) for name in names])


def chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    extra = [(-7, turn, role, CONTROL_TEXT) for turn, role in enumerate(("user", "assistant"))]
    more = spark.createDataFrame(extra, "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format_conversations(rows.unionByName(more)))


def benchmark_leaks(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = (_table(spark, folder, name) for name in ("documents", "benchmark"))
    rows = decontaminate.contaminated(docs, items)
    names = ["n_windows", "coverage", "verbatim", "agreeing"]
    return rows.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), *names)


def fuzzy_lines(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    rows = line_dedup.removed_lines(docs)
    return rows.select(F.col("id").alias("doc_id"), "n_lines", "n_removed", "removed")


def licenses(spark: SparkSession, folder: str) -> DataFrame:
    rows = license_scan.scan(_table(spark, folder, "documents"))
    return rows.withColumnRenamed("id", "doc_id")


def personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = sanitise.find(_table(spark, folder, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        F.col("id").alias("doc_id"),
        *[count(kind) for kind in sanitise.KINDS],
        F.sha2(sanitise.written("base"), 256).alias("base_sha256"),
        sanitise.written("all").alias("spans"),
    )


def page_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extract_pages(_table(spark, folder, "pages"))


def warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = warc.derivatives(warc.responses(_table(spark, folder, "pages")))
    length = F.octet_length("record").cast("long").alias("record_length")
    return rows.select(*[c for c in rows.columns if c != "record"], length)


def mixture(spark: SparkSession, folder: str) -> DataFrame:
    rows = mixing.mix(_table(spark, folder, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "embeddings")
    moved = F.when(F.expr("vec_id % 7 = 0"), F.expr("(label + 1) % 10")).otherwise(F.col("label"))
    whole = F.when(hard_negatives.usable(F.col("embedding")), hard_negatives.whole_numbers(F.col("embedding")))
    rows = rows.select("vec_id", moved.alias("label"), whole.alias("embedding"))
    return hard_negatives.mine(rows, F.expr("vec_id % 50 = 0"), "vec_id", "label", "embedding")


def token_links(spark: SparkSession, folder: str) -> DataFrame:
    rows = cross_tokenizer.align(_table(spark, folder, "documents"))
    return rows.withColumnRenamed("id", "doc_id")


URL_RULES = (
    url_filter.Rule("net", "/", "block"),
    url_filter.Rule("example.net", "/en/", "allow"),
    url_filter.Rule("example.com", "/de/", "block"),
    url_filter.Rule("org", "/fr/", "allow"),
)


def url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    rows = url_filter.judge(_table(spark, folder, "pages"), URL_RULES)
    return rows.withColumnRenamed("id", "page_id")


QUERIES = {
    "op1_shingle_join": shingle_join,
    "op2_host_quality": quality,
    "op3_license_scan": licenses,
    "op4_personal_data": personal_data,
    "op5_page_text": page_text,
    "op6_chat_format": chat_format,
    "op7_benchmark_leaks": benchmark_leaks,
    "op8_fuzzy_lines": fuzzy_lines,
    "op9_pivotal_mix": mixture,
    "op10_warc_derivatives": warc_derivatives,
    "op11_cover_tree_negatives": negatives,
    "op12_pair_bitmaps": token_links,
    "op13_redirect_classes": url_verdicts,
}

SQL: dict[str, str] = {
    "op1_shingle_join": oracles.SHINGLE_JOIN,
    "op2_host_quality": oracles.QUALITY,
    "op6_chat_format": oracles.CHAT,
    "op11_cover_tree_negatives": oracles.NEGATIVES,
    "op13_redirect_classes": oracles.URL_VERDICTS,
}
