"""Thin queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    imatch, jaccard_join, mixing, packing, quality_classifier, quality_rules, quotations, ranked_search, runs, secrets,
    sharding, toxicity, warc,
)
from .common import crc_mod, table, written

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _held_out(n: int, rest: int):
    return F.coalesce(crc_mod(F.col("doc_id"), n) == rest, F.lit(False))


def _predicted(score: str):
    return (F.col(score) >= 0.7).cast("int").alias("predicted")


@query
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality_classifier.classify(docs, table(spark, sf_dir, "labels"), ~_held_out(4, 2))
    return scored.select("doc_id", _held_out(4, 2).alias("held_out"), "score", _predicted("score"))


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance", "judged_by"]
    return quality_rules.judge(docs).select("doc_id", *columns)


@query
def op2_curriculum_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix(written(mixing.sized(docs).drop("text")))
    columns = ["doc_id", "size", "source_size", "target", "taken", "position"]
    return mixed.select(*columns).orderBy(F.asc_nulls_last("position"), "doc_id")


ORACLE_SQL["op2_curriculum_mixing"] = mixing.MIX_SQL


def byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op3_differencing_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), byte_bpe())


@query
def op6_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op8_partenum_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.group(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op4_noisy_or_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.detect(docs, table(spark, sf_dir, "labels"), ~_held_out(3, 1))
    return scored.select(
        "doc_id", _held_out(3, 1).alias("held_out"), "score", _predicted("score"), F.size("offending").alias("n_offending")
    )


@query
def op7_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.round_trip(spark, table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL["op7_warc_round_trip"] = warc.WARC_SQL


@query
def op5_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = imatch.fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))
    near = lambda other: imatch.likeness(F.col("fingerprint"), F.col(other))
    return df.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.concat_ws(".", "fingerprint").alias("fingerprint"),
        F.concat_ws(".", "edited").alias("edited_fingerprint"),
        near("edited").alias("near_edited"),
        near("next").alias("near_next"),
    )


@query
def op9_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotations.conversations(quotations.quoting(table(spark, sf_dir, "conversations")))


ORACLE_SQL["op9_quotation_linking"] = quotations.QUOTING_SQL


def looped(words: list[bytes], key: int | None) -> list[bytes]:
    """One document in ten, by its key, with its words from some place on replaced by repetitions of a few of them."""
    h = zlib.crc32(str(key).encode())
    if key is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


@query
def op13_lyndon_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    df = runs.detect_runs(docs, edit=looped)
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    rank = lambda r: F.struct(-r["length"], r["start"], r["period"])
    longest = F.array_min(F.transform("runs", rank))
    length, start, period = -longest["col1"], longest["start"], longest["period"]
    return df.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform("runs", lambda r: F.concat(line(r), F.lit("\n")))), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_zstd_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda x: x["kind"] != secrets.NOVEL)
    listed = lambda found: F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    of_kind = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    return df.select(
        "doc_id",
        *[of_kind(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed("spans").alias("spans"),
        of_kind(secrets.NOVEL).alias("n_novel"),
    )


@query
def op11_wand_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ranked_search.search(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


ORACLE_SQL["op11_wand_search"] = ranked_search.SEARCH_SQL
