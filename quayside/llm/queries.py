"""The queries opN_<name> over the given tables, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import (
    ann,
    chat_format,
    decontaminate,
    filter_audit,
    importance,
    piece_codec,
    secret_scan,
    simhash,
    suffix_dedup,
    token_counts,
    token_files,
    toxicity,
    warc,
)
from quayside.llm.oracle import ORACLES  # noqa: F401
from quayside.llm.store import fresh_path, prepare, written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(_table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: int):
        return F.expr(f"cast(size(filter(secret_spans.base, s -> s.kind = {kind})) as bigint)")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secret_scan.spans_text("secret_spans.base"), 256).alias("base_sha256"),
        secret_scan.spans_text("secret_spans.all").alias("spans"),
    )


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tokenizer("piece_bpe_32k.model")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    back = piece_codec.decode(piece_codec.encode(docs, model), model)
    return back.select(
        "doc_id",
        F.size("piece_ids").cast("bigint").alias("n_pieces"),
        F.sha2(F.array_join(F.col("piece_ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.replace(F.coalesce("text", F.lit("")), F.lit(piece_codec.SPACE), F.lit(" "))).alias("round_trip"),
    )


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], chats.schema)
    return chat_format.read_back(written(chat_format.format_chats(chats.union(extra)), "formatted"))


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest(vectors, vectors.filter("vec_id % 50 = 0"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, tokenizer("byte_bpe_50k.json"), fresh_path(spark, "token-cache"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    path = fresh_path(spark, "token-files")
    token_files.write_token_files(docs, tokenizer("word_bpe_49k.json"), 2, path)
    return token_files.read_token_files(spark, path)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, _table(spark, sf_dir, "labels"), teach=~toxicity.held_out())
    return toxicity.with_score(docs, model).select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return filter_audit.audit(docs, _table(spark, sf_dir, "labels"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    chunks = warc.read_archives(warc.write_archives(pages, fresh_path(spark, "warc")), contents=False)
    return chunks.filter("last").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return importance.resample(docs, _table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_simhash": op3_simhash,
    "op4_chat_format": op4_chat_format,
    "op5_decontaminate": op5_decontaminate,
    "op6_ann": op6_ann,
    "op7_token_counts": op7_token_counts,
    "op8_token_files": op8_token_files,
    "op9_toxicity": op9_toxicity,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_filter_audit": op11_filter_audit,
    "op12_warc": op12_warc,
    "op13_importance_resampling": op13_importance_resampling,
}
