"""One query for each corpus operator, over whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiered.llm import (
    archives, decontaminate, embeddings, jaccard, language, merkle, packing, personal,
    prefix_trie, quality, sharding, shared, token_files, tokens, toxicity,
)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(
        shared.table(spark, sf_dir, "documents").select("doc_id", "text"),
        shared.table(spark, sf_dir, "benchmark"),
    )
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256",
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.link_vectors(shared.table(spark, sf_dir, "embeddings"), 0.98)


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_documents(shared.table(spark, sf_dir, "documents"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents")
    held_out = shared.fold(F.col("doc_id"), 3) == 1
    model = language.fit(docs.where(~held_out))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return language.identify(rows, model).drop("text")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents")
    manifest = token_files.write_token_files(
        docs, shared.new_folder(spark, "tokens"), tokens.default_vocabulary()
    )
    return token_files.read_token_files(manifest)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, 2048, tokens.default_vocabulary())


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = personal.sanitise(docs)

    def joined(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def of(*kinds: str) -> Column:
        return F.filter("pii_spans", lambda s: s["kind"].isin(*kinds))

    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in personal.KINDS],
        F.sha2(joined(of(*personal.KINDS)).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("pii_spans")).alias("spans"),
    )


def op8_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = shared.table(spark, sf_dir, "pages")
    manifest = archives.write_archives(pages, shared.new_folder(spark, "warc"))
    return archives.read_archives(manifest)


def op9_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_by_bytes(shared.table(spark, sf_dir, "documents"), 16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents")
    held_out = shared.fold(F.col("doc_id"), 4) == 2
    labels = shared.table(spark, sf_dir, "labels").where(~held_out)
    model = quality.fit(docs, labels)
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return quality.score(rows, model).drop("text")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = shared.table(spark, sf_dir, "conversations")
    kept = shared.fold(F.col("conv_id"), 4)
    return prefix_trie.trie(prefix_trie.rebuilt(turns, 20, kept, 3))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents")
    # A null id has no decimal form, so its row is left alone.
    hit = F.col("doc_id").isNotNull() & (shared.fold(F.col("doc_id"), 7) == 0)
    more = F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    proofs = merkle.manifest(docs, {"n_chars": more})
    return proofs.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root",
        F.sha2(F.array_join("siblings", "").cast("binary"), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents")
    held_out = shared.fold(F.col("doc_id"), 5) == 0
    labels = shared.table(spark, sf_dir, "labels").where(~held_out)
    model = toxicity.fit(docs, labels)
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return toxicity.score(rows, model).drop("text", "language")


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_embedding_links": op2_embedding_links,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_language": op4_language,
    "op5_token_files": op5_token_files,
    "op6_packing": op6_packing,
    "op7_personal_data": op7_personal_data,
    "op8_archives": op8_archives,
    "op9_byte_shards": op9_byte_shards,
    "op10_quality": op10_quality,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_toxicity": op13_toxicity,
}
