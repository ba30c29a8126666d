"""One query per operator: it applies the operator to its whole table and derives the result
columns that the contract names."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.llm import bytebpe, licences, packing, pii, piecebpe, prefixtrie, quality, runs, simhash, tokenfile, toolcalls, topk, winnow
from claimlake.llm.common import table

BYTE_BPE, WORD_BPE, WORD_BPE_SIZE = "byte_bpe_50k.json", "word_bpe_49k.json", 49408
PIECE_BPE, BYTE_RANKS = "piece_bpe_32k.model", "byte_bpe_50k.tiktoken"


def op1_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = licences.scan(docs, licences.fit(docs))
    confirmed = F.transform(F.filter("findings", lambda f: f["confirmed"]), lambda f: f["family"])
    shown = F.transform("findings", lambda f: F.concat_ws(":", f["paragraph"].cast("string"), f["family"], F.format_number(f["probability"], 2), F.format_number(f["similarity"], 2), f["confirmed"].cast("string")))
    return found.select(
        "doc_id",
        "n_paragraphs",
        F.size("findings").cast("long").alias("n_findings"),
        F.array_join(F.array_sort(F.array_distinct(confirmed)), ",").alias("families"),
        F.array_join(shown, ",").alias("findings"),
    )


def op2_toolcalls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = toolcalls.derive(table(spark, sf_dir, "conversations"))
    return toolcalls.link(calls, results, toolcalls.SCHEMAS)


def op3_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.compare_edited(table(spark, sf_dir, "documents"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    coded = piecebpe.encode_documents(docs, public_tokenizers.path(PIECE_BPE), digests_only=True)
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.spans(docs, pii.fit(docs))
    return found.withColumn("base_sha256", F.sha2("base", 256)).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_rows(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), end_id=0)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = tokenfile.write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), WORD_BPE_SIZE, end_id=2)
    return tokenfile.document_starts(files).select("doc_id", "start", "n_tokens", "ids_crc32")


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_bytebpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    coded = bytebpe.encode_documents(docs, public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN, digests_only=True)
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(table(spark, sf_dir, "documents"), folded=True, digests_only=True)
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, conversations = prefixtrie.rebuilt(table(spark, sf_dir, "conversations"))
    return prefixtrie.trie(turns, conversations).drop("key1", "key2")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licences": op1_licences,
    "op2_toolcalls": op2_toolcalls,
    "op3_winnowing": op3_winnowing,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_simhash": op5_simhash,
    "op6_pii": op6_pii,
    "op7_packing": op7_packing,
    "op8_token_files": op8_token_files,
    "op9_topk": op9_topk,
    "op10_quality": op10_quality,
    "op11_bytebpe": op11_bytebpe,
    "op12_runs": op12_runs,
    "op13_prefix_trie": op13_prefix_trie,
}
