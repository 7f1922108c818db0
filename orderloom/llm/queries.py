"""The registered queries: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import centroids, embeddings, exact_dedup, jaccard_join, lexical, licenses, line_dedup, packing, quality, secrets, sentencepieces, toxicity, warc
from orderloom.llm.tables import fold, read_table


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 5) == 0
    model = quality.fit_quality(docs, read_table(spark, sf_dir, "labels"), ~held_out)
    return quality.with_quality(docs, model).select(
        "doc_id", held_out.alias("held_out"), F.col("quality_score").alias("score"), F.col("quality_predicted").alias("predicted")
    )


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read_table(spark, sf_dir, "documents"), keep="max")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.repeated_lines(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", F.size("removed").alias("n_removed"), F.concat_ws(",", F.col("removed").cast("array<string>")).alias("removed_lines"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = secrets.find_secrets(read_table(spark, sf_dir, "documents"))

    def of(kind: str):
        return F.filter("spans", lambda s: s["kind"] == secrets.KINDS.index(kind))

    base = F.filter("spans", lambda s: s["kind"] < secrets.KINDS.index("random"))
    return spans.select(
        "doc_id",
        *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(secrets.written(base).cast("binary"), 256).alias("base_sha256"),
        secrets.written(F.col("spans")).alias("spans"),
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 4) == 2
    machine = toxicity.fit_toxicity(docs, read_table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.toxicity_scores(docs, machine).select(
        "doc_id", held_out.alias("held_out"), F.col("toxic_score").alias("score"), F.col("toxic_predicted").alias("predicted")
    )


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(read_table(spark, sf_dir, "embeddings"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.find_licences(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.size("licences").cast("long").alias("n_licences"),
        F.concat_ws(",", F.transform("licences", lambda x: F.concat_ws(":", x["family"], x["line"].cast("string")))).alias("licences"),
        F.round(F.array_max(F.transform("licences", lambda x: x["probability"])), 6).alias("best_probability"),
    )


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_documents(read_table(spark, sf_dir, "documents"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = sentencepieces.encode_documents(read_table(spark, sf_dir, "documents"), _vocabulary("piece_bpe_32k.model"))
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return warc.page_digests(warc.write_archive(pages), pages.schema["page_id"].dataType.simpleString())


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_line_dedup": op3_line_dedup,
    "op4_secret_scan": op4_secret_scan,
    "op5_toxicity": op5_toxicity,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_license_scan": op7_license_scan,
    "op8_packing": op8_packing,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_warc": op11_warc,
    "op12_lexical_search": op12_lexical_search,
    "op13_centroid_clustering": op13_centroid_clustering,
}
