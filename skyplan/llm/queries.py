"""The thin queries opN_<name>, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import archive

    return archive(read(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as the files of a tree: /<source>/<lang>/<id mod 8>/<id>, but
    that every 50th is the source's licence file or that of a language."""
    from .license_scan import scan_licenses

    key, of_lang = F.col("doc_id"), F.concat(F.lit("/"), F.coalesce("source", F.lit("-")), F.lit("/"), F.coalesce("lang", F.lit("-")))
    own = F.concat(of_lang, F.lit("/"), F.coalesce((key % 8).cast("string"), F.lit("-")), F.lit("/"), F.coalesce(key.cast("string"), F.lit("-")))
    path = F.when(key % 100 == 0, F.concat(F.lit("/"), F.coalesce("source", F.lit("-")), F.lit("/LICENSE"))).when(key % 100 == 50, F.concat(of_lang, F.lit("/COPYING"))).otherwise(own)
    found = scan_licenses(read(spark, sf_dir, "documents").select("doc_id", path.alias("path"), "text"))
    return found.select("row.doc_id", "path", F.col("own.licence").alias("own_licence"), F.round("own.score", 6).alias("score"), F.col("own.unit").alias("unit"), "licence", "origin")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import with_quality

    return with_quality(read(spark, sf_dir, "documents").select("doc_id", "text")).select("row.doc_id", "q.*")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring_dedup import with_cuts

    rows = with_cuts(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("row.doc_id", "cut.n_bytes", "cut.n_removed", "cut.n_spans", "cut.kept_sha256")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import with_token_counts

    rows = with_token_counts(read(spark, sf_dir, "documents").select("doc_id", "text"))
    by_section = F.col("count.by_section")
    return rows.select(
        "row.doc_id", "count.n_tokens", F.size(by_section).cast("long").alias("n_sections"), "count.n_crossing",
        F.transform(by_section, lambda x: x.cast("long")).alias("section_tokens"),
    )


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mixture

    found = mixture(read(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_id import fit, held_out, predict

    docs = read(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out()))
    rows = predict(docs.select("doc_id", "text"), model)
    return rows.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), F.col("answer.lang").alias("lang_pred"), "answer.score")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import scan_items

    hits = scan_items(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return hits.select(
        "row.doc_id", "hit.n_words", "hit.n_hit", F.size("hit.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit.items", ","), 256).alias("items_sha256"), (F.col("hit.n_hit") > 0).alias("contaminated"),
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import with_removed

    rows = with_removed(read(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return rows.select("row.doc_id", "n_lines", "n_removed", F.sha2("clean", 256).alias("kept_sha256"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_components

    found = near_components(read(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .prefix_trie import conversation_trie

    nodes = conversation_trie(read(spark, sf_dir, "conversations"))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .resampling import scored

    rows = scored(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return rows.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import LAW, shard

    rows = shard(read(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_warc, op2_license_scan, op3_quality_rules, op4_substring_dedup, op5_token_counts, op6_mixing, op7_language_id, op8_decontaminate,
        op9_line_dedup, op10_simhash, op11_prefix_trie, op12_resampling, op13_sharding, pipeline,
    )
}
