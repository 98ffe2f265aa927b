"""One query per operator, with its DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.session import ship_package

from . import (decontaminate, html, language, licenses, manifest, packing, phrases, quality,
               secrets, sharding, simhash, substring, suffix)
from .common import materialize, table
from .oracles import ORACLE as _MORE


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lines = materialize(licenses.marked(docs), "license-lines")
    return licenses.scan(docs, licenses.train(docs, lines=lines), lines=lines)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", *[secrets.count_kind("base_spans", k).alias(f"n_{k}")
                    for k in ("assign", "access", "hex")],
        F.sha2(secrets.joined("base_spans"), 256).alias("base_sha256"),
        secrets.joined("spans").alias("spans"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"),
                                    table(spark, sf_dir, "benchmark"))


def tokenizer_path() -> str:
    """The public tokenizer file, at the same place on the driver and the executors."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages")).withColumn(
        "n_chars", F.length("text").cast("long"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.repeated_passages(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = quality.with_metrics(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))
    scored = quality.materialize(docs.drop("text"), "metrics")
    cutoffs = quality.calibrate(scored, table(spark, sf_dir, "labels"))
    return quality.with_verdict(scored, cutoffs).select(
        "doc_id", "m.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines",
        "m.n_repeat_words", "base_failed", "kept")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        "component_id")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    return sharding.shard_table(docs, "doc_id").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), "grown_shard")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.dedup_substrings(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), "n_removed",
        F.when(F.col("kept").isNull(), F.col("words_sha"))
         .otherwise(F.sha2(F.col("kept"), 256)).alias("kept_sha256"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    away = language.held_out(F.col("doc_id"))
    profiles = language.learn(docs.where(~away))
    return language.predict(docs.select("doc_id", away.alias("held_out"), "text"), profiles
                            ).drop("text")


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    rows = manifest.manifest(table(spark, sf_dir, "documents"), tampered)
    folded = manifest.fold(F.coalesce("changed", "leaf"), F.col("witness"))
    return rows.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(manifest.siblings(F.col("witness")), 256).alias("proof_sha256"),
        folded.alias("folded_root"), (folded == F.col("root")).alias("verified"))


def _shipped(query: Callable[[SparkSession, str], DataFrame]
             ) -> Callable[[SparkSession, str], DataFrame]:
    """``query`` with this package sent to the executors first."""
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _shipped(f) for f in (
        op1_license_scan, op2_secret_scan, op3_decontaminate, op4_best_fit_packing,
        op5_html_extraction, op6_suffix_dedup, op7_quality_rules, op8_simhash, op9_sharding,
        op10_substring_dedup, op11_language_id, op12_phrase_collocations, op13_merkle_manifest)}

ORACLE: dict[str, str] = _MORE | {"op10_substring_dedup": r"""
    with d as (
        select doc_id, list_filter(
            regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') as w
        from documents),
    g as (
        select doc_id, i, array_to_string(w[i:i + 49], ' ') as k
        from d, lateral (select unnest(range(1, len(w) - 48)) as i)),
    f as (select k, min(doc_id) as least from g group by k),
    c as (
        select distinct doc_id, i + j as at
        from g join f using (k), (select unnest(range(50)) as j) where least < doc_id),
    n as (select doc_id, count(*) as n_removed from c group by doc_id),
    x as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as at from d),
    s as (
        select x.doc_id, string_agg(word, ' ' order by x.at) as kept
        from x left join c on c.doc_id = x.doc_id and c.at = x.at
        where c.at is null group by x.doc_id)
    select d.doc_id, len(w) as n_words, coalesce(n_removed, 0) as n_removed,
           sha256(coalesce(kept, '')) as kept_sha256
    from d left join n on n.doc_id = d.doc_id left join s on s.doc_id = d.doc_id"""}
