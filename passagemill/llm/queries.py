"""Registered queries of the operators of this package, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chunkdedup, decontaminate, exactdedup, langid, lattice, lexical, merkle, mixing, quality, sharding, simhash, tokens, toxicity
from .common import ascii_lower, documents, id_remainder, scratch_path


def _public(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")
    found = decontaminate.decontaminate(documents(spark, sf, "doc_id", "text"), benchmark, keep=["doc_id"])
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), "contaminated")


def op2_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf, "doc_id", "text")
    model = toxicity.train(docs, spark.read.parquet(f"{sf}/labels.parquet"), id_remainder("id", 5) != 0)
    found = toxicity.toxicity(docs, model, keep=["doc_id"])
    return found.select("doc_id", (id_remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted", "neighbours")


def op3_sharding(spark: SparkSession, sf: str) -> DataFrame:
    rows = sharding.shard(documents(spark, sf))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary")).cast("long")
    none = F.lit(None).cast("int").alias("grown_shard")
    return rows.select("doc_id", size.alias("size"), crc.alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", none)


def op4_quality(spark: SparkSession, sf: str) -> DataFrame:
    found = quality.quality(documents(spark, sf, "doc_id", "text", "lang", "source"), keep=["doc_id"])
    return found.select("doc_id", *quality.FEATURES, "base_failed", "kept", "reasons")


def op5_lm_score(spark: SparkSession, sf: str) -> DataFrame:
    held_out = id_remainder("doc_id", 5) == 1
    found = lattice.lattice_scores(documents(spark, sf, "doc_id", "text"), _public("piece_bpe_32k.model"), ~held_out, keep=["doc_id"])
    return found.withColumn("held_out", held_out)


def op6_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(documents(spark, sf, "doc_id", "text", "source"), keep=["doc_id"]).drop("copies")


def op7_token_ids(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "corpus")
    tokens.write_corpus(documents(spark, sf, "doc_id", "text"), path, _public("word_bpe_49k.json"))
    rows = tokens.read_corpus(spark, path)
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").cast("long").alias("ids_crc32"))


def op8_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return chunkdedup.whole_passages(documents(spark, sf, "doc_id", "text"))


def op9_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf, "doc_id", "text", "lang")
    held_out = id_remainder("doc_id", 4) == 2
    model = langid.train(langid.sample(docs, "text", "lang", "doc_id", ~held_out))
    return langid.identify(docs, model, keep=["doc_id"]).withColumn("held_out", held_out)


def op10_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf, "doc_id", "text"))


def op11_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf, "doc_id", "source", "lang", "n_chars", "text")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    lowered = merkle.leaf(*[F.col(c) if c != "text" else ascii_lower(F.col(c)) for c in fields])
    docs = docs.withColumn("tampered", F.when(id_remainder("doc_id", 5) == 0, lowered))
    proofs = merkle.prove(merkle.manifest(docs, fields, keep=["doc_id", "tampered"]))
    folded = proofs.withColumn("folded_root", merkle.fold(F.coalesce("tampered", "leaf"), F.col("steps")))
    proof = F.sha2(merkle.siblings(F.col("steps")).cast("binary"), 256)
    return folded.select(
        "doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


def op12_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf, "doc_id", "text")
    docs = docs.withColumn("text_sha256", F.sha2(exactdedup.normal("text").cast("binary"), 256))
    return exactdedup.exact_duplicates(docs, keep=["doc_id", "text_sha256"])


def op13_lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    return lexical.search(documents(spark, sf, "doc_id", "text"), spark.read.parquet(f"{sf}/benchmark.parquet"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_toxicity,
        op3_sharding,
        op4_quality,
        op5_lm_score,
        op6_mixing,
        op7_token_ids,
        op8_substring_dedup,
        op9_language_id,
        op10_simhash,
        op11_merkle_manifest,
        op12_exact_dedup,
        op13_lexical_search,
    )
}
