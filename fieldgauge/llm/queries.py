"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldgauge.llm import alignment, decontaminate, lines, mixing, preference, ranking, secret_scan, simhash, statements, substrings
from fieldgauge.llm import syncmers, tokens, warc, whitening

SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(build: Callable[[SparkSession, str], DataFrame], sql: str | None = None):
    SPARK[build.__name__] = build
    if sql:
        SQL[build.__name__] = sql
    return build


def stated(sql: str):
    """A query whose result ``sql`` states too."""
    return lambda build: query(build, sql)


def vocabulary(path: str | None = None) -> list[tuple[str, float]]:
    """Unigram vocabulary from the sentencepiece file at ``path``."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    return tokens.zipf_unigram(tokens.load_pieces(path))


def tokenizer_files(byte_level: str | None = None, pieces: str | None = None) -> tuple[str, bytes]:
    """The byte-level and the piece vocabulary at the given paths, or the public ones."""
    import public_tokenizers

    return alignment.load(byte_level or public_tokenizers.path("byte_bpe_50k.json"),
                          pieces or public_tokenizers.path("piece_bpe_32k.model"))


@query
def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.token_counts(table(spark, folder, "documents"), vocabulary())


@stated(statements.PREFERENCES)
def op3_preferences(spark: SparkSession, folder: str) -> DataFrame:
    turns, pairs = preference.borrowed_answers(table(spark, folder, "conversations"))
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias(c)
    return preference.format_preferences(turns, pairs).select(
        F.col("pair_id").alias("conv_id"), "n_prompt_turns", "prompt", "chosen", spans("chosen_mask"), "rejected",
        spans("rejected_mask"),
    )


@query
def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return ranking.score(docs, ranking.fit(docs, labels))


@stated(statements.SUBSTRINGS)
def op4_substrings(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.dedup_substrings(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op5_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.digest(secret_scan.secrets(table(spark, folder, "documents")))


@query
def op6_syncmers(spark: SparkSession, folder: str) -> DataFrame:
    return syncmers.fingerprint_pairs(table(spark, folder, "documents"))


@stated(statements.LINES)
def op7_line_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = lines.dedup_lines(table(spark, folder, "documents"))
    return found.select("doc_id", "n_lines", "n_deleted", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@stated(statements.CONTAMINATION)
def op8_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs, bench = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return decontaminate.digest(decontaminate.contamination(docs, bench))


@query
def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


@stated(statements.MIX)
def op10_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query
def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.by_component(whitening.whiten(table(spark, folder, "embeddings")))


@stated(statements.ARCHIVE)
def op12_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive(table(spark, folder, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "sound"
    )


@query
def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    found = alignment.align(table(spark, folder, "documents"), *tokenizer_files())
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                        digest.alias("groups_sha256"))
