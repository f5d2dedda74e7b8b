"""The registered queries of the operators: whole tables in, contract columns out."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaymill.llm import (
    bm25,
    chat,
    decontaminate,
    langid,
    mixing,
    pages,
    periodic,
    secrets,
    sentencepiece_codec,
    simhash,
    toxicity,
    warc,
    whitening,
)
from assaymill.llm.common import residue, table

#: The public tokenizer file that language identification and encoding use.
PIECE_MODEL = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = residue("doc_id", 4) == 2
    model = langid.fit(docs.where(~held_out), PIECE_MODEL)
    found = langid.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(table(spark, sf_dir, "conversations"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = residue("doc_id", 5) == 0
    labels = table(spark, sf_dir, "labels").where(~held_out)
    grammar = toxicity.fit(docs, labels)
    scored = toxicity.with_evidence(docs.select("doc_id", held_out.alias("held_out"), "text"), grammar)
    return scored.select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = sentencepiece_codec.encode(docs, PIECE_MODEL)
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.array_join("token_ids", ","), 256).alias("ids_sha256"),
        "parity",
        "round_trip",
    )


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op10_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bm25.top_k(table(spark, sf_dir, "documents"), F.col("doc_id") % 20 == 0)


def op11_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(table(spark, sf_dir, "embeddings"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_chat": op2_chat,
    "op3_toxicity": op3_toxicity,
    "op4_warc": op4_warc,
    "op5_simhash": op5_simhash,
    "op6_main_text": op6_main_text,
    "op7_decontaminate": op7_decontaminate,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_secrets": op9_secrets,
    "op10_search": op10_search,
    "op11_mix": op11_mix,
    "op12_whitening": op12_whitening,
    "op13_runs": op13_runs,
}
