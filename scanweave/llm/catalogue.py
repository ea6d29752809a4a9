"""Registered queries of this subpackage and their SQL twins."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from scanweave.llm import bpe_tree, decontaminate, filter_audit, license_scan, line_crf, packing, quality_rules, secret_scan, simhash_dedup, spelling, suffix_dedup, surrogates, token_counts
from scanweave.llm.tables import read_table


# Stands in for a key that a deployment keeps secret and passes itself.
SURROGATE_KEY = "scanweave-registered-query"


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(read_table(spark, sf_dir, "documents")).drop("host", "frequent")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents")).drop("kept")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    best = F.get("licenses", F.lit(0))
    return found.select(
        "row.doc_id",
        F.size("licenses").cast("long").alias("n_licenses"),
        best["license"].alias("license"),
        F.round(best["score"], 6).alias("score"),
    )


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digest(secret_scan.find_secrets(read_table(spark, sf_dir, "documents")))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = line_crf.fit(docs, read_table(spark, sf_dir, "labels"))
    return line_crf.score_quality(docs, model).select(
        "row.doc_id", line_crf.held_out(F.col("row.doc_id")).alias("held_out"), "score", "predicted"
    )


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    return decontaminate.contaminated(docs.select("doc_id", "text"), benchmark).select(
        "row.doc_id",
        (F.size("leaks") > 0).alias("contaminated"),
        F.size("leaks").cast("long").alias("n_items"),
        F.array_join(F.col("leaks")["item_id"].cast("array<string>"), ",").alias("items"),
        F.round(F.array_max(F.col("leaks")["similarity"]), 6).alias("best_similarity"),
    )


def pack_documents(docs: DataFrame) -> DataFrame:
    return packing.pack(docs, _tokenizer("byte_bpe_50k.json"))


def op8_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))


def without_personal_data(docs: DataFrame) -> DataFrame:
    """The documents, in their own columns, with replaced entities."""
    return surrogates.replace_personal_data(docs, SURROGATE_KEY).select("row.*")


def op10_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = surrogates.replace_personal_data(read_table(spark, sf_dir, "documents"), SURROGATE_KEY)
    kinds = [
        F.size(F.filter("mentions", _of(kind))).cast("long").alias(f"n_{kind}") for kind in surrogates.TYPES
    ]
    return done.select("row.doc_id", "row.text", *kinds)


def _of(kind: str):
    return lambda mention: mention["kind"] == kind


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return filter_audit.audit(filter_audit.failures(docs, labels))


def op12_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _tokenizer("byte_bpe_multi_50k.tiktoken")
    encoded = bpe_tree.encode(read_table(spark, sf_dir, "documents"), path)
    return bpe_tree.decode(encoded, path, keep=("doc_id", "ids")).select(
        "doc_id",
        F.floor(F.length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("body", 256).alias("decoded_sha256"),
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(read_table(spark, sf_dir, "documents")))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_rules": op1_quality_rules,
        "op2_suffix_dedup": op2_suffix_dedup,
        "op3_license_scan": op3_license_scan,
        "op4_secret_scan": op4_secret_scan,
        "op5_simhash_dedup": op5_simhash_dedup,
        "op6_quality_classifier": op6_quality_classifier,
        "op7_decontamination": op7_decontamination,
        "op8_mixture_packing": op8_mixture_packing,
        "op9_token_counts": op9_token_counts,
        "op10_surrogates": op10_surrogates,
        "op11_filter_audit": op11_filter_audit,
        "op12_bpe_tree": op12_bpe_tree,
        "op13_spelling_variants": op13_spelling_variants,
    }


def all_oracles() -> dict[str, str]:
    return {
        "op1_quality_rules": quality_rules.ORACLE,
        "op2_suffix_dedup": suffix_dedup.ORACLE,
        "op3_license_scan": license_scan.ORACLE,
        "op4_secret_scan": secret_scan.ORACLE,
        "op7_decontamination": decontaminate.ORACLE,
        "op11_filter_audit": filter_audit.ORACLE,
    }
