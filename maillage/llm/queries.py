"""The dealt operators as registered queries over the given tables, and SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maillage.llm import alignment, bpe, chat, language, licenses, packing, simhash, sketches, substrings, topk, toxicity, warc, whitening


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.packed(packing.pieces(documents, public_tokenizers.path("word_bpe_49k.json")))


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without passages that already stand earlier."""
    found = substrings.thinned(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a model that never saw the held-out quarter."""
    documents = table(spark, sf_dir, "documents")
    model = toxicity.train(documents, table(spark, sf_dir, "labels"))
    found = toxicity.scored(documents.select("doc_id", "text", "lang"), model)
    return found.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), toxicity.flagged(found, model).alias("flagged"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and how alike they are."""
    return sketches.fingerprinted(table(spark, sf_dir, "documents"), cut=sketches.content_digests)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of all documents."""
    found = simhash.grouped(simhash.fingerprints(table(spark, sf_dir, "documents")))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def quoting(messages: DataFrame) -> DataFrame:
    """The messages as mail: each one quotes the message of the turn before it, every second
    one wrapped anew; one line is said at the end of, and so quoted from, a third of all."""
    chance = lambda n: F.pmod(F.xxhash64("conv_id", "turn"), F.lit(n))
    thanks = F.when(chance(3) == 0, F.lit("\nThanks in advance.")).otherwise("")
    said = messages.select("conv_id", "turn", "role", F.concat(F.coalesce("text", F.lit("")), thanks).alias("said"))
    before = said.groupBy("conv_id", (F.col("turn") + 1).alias("turn")).agg(F.min("said").alias("before"))
    wrapped = F.regexp_replace(F.regexp_replace("before", r"\s+", " "), r"(.{30,50}?) ", "$1\n")
    quote = F.regexp_replace(F.when(chance(2) == 0, wrapped).otherwise(F.col("before")), r"(?m)^", "> ")
    text = F.when(F.col("before").isNull(), F.col("said")).otherwise(F.concat(quote, F.lit("\n"), "said"))
    return said.join(before, ["conv_id", "turn"], "left").select("conv_id", "turn", "role", text.alias("text"))


def op6_quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages, each quoting the one before it, without their quotes again: with what
    they answer and their place in reply order."""
    return chat.conversations(quoting(table(spark, sf_dir, "conversations")))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence families of all documents, with the confirmed paragraphs."""
    documents = table(spark, sf_dir, "documents")
    found = licenses.scanned(documents, licenses.train(documents))
    families = F.array_join(F.array_sort(F.array_distinct(F.transform("found", lambda f: f["family"]))), ",")
    return found.select("doc_id", "n_paragraphs", families.alias("families"), F.size("found").alias("n_licenses"), F.transform("found", lambda f: f["paragraph"]).alias("paragraphs"))


def op8_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded again."""
    documents = table(spark, sf_dir, "documents")
    return bpe.digests(documents, public_tokenizers.path("byte_bpe_50k.json"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records, looked up by their addresses in the capture index
    and read back from the ranges it gives."""
    pages = table(spark, sf_dir, "pages")
    blocks, directory = warc.indexed(warc.written(pages))
    found = warc.records(warc.looked_up(blocks, directory, pages.select("url")))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest codes of every vector whose id is divisible by 20, among all."""
    found = topk.codes(table(spark, sf_dir, "embeddings"))
    return topk.nearest(found, found.where("vec_id % 20 = 0"), 10)


def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in two tokenizers, their tokens aligned."""
    documents = table(spark, sf_dir, "documents")
    return alignment.alignments(documents, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All usable vectors, whitened by the covariance of the different ones."""
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, by a model that never saw the held-out quarter."""
    documents = table(spark, sf_dir, "documents")
    model = language.train(documents.where(~toxicity.held_out()))
    found = language.predicted(documents.select("doc_id", "text"), model)
    return found.select("doc_id", toxicity.held_out().alias("held_out"), "lang_pred", "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pack": op1_pack,
    "op2_substrings": op2_substrings,
    "op3_toxicity": op3_toxicity,
    "op4_fingerprints": op4_fingerprints,
    "op5_simhash": op5_simhash,
    "op6_quotations": op6_quotations,
    "op7_licenses": op7_licenses,
    "op8_encode": op8_encode,
    "op9_warc": op9_warc,
    "op10_nearest": op10_nearest,
    "op11_align": op11_align,
    "op12_whiten": op12_whiten,
    "op13_language": op13_language,
}

ORACLES: dict[str, str] = {
    "op2_substrings": """
        WITH d AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
        ), p AS (
            SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i, len(ws) AS n, ws FROM d
        ), k AS (
            SELECT doc_id, w, i, CASE WHEN i + 19 <= n THEN list_aggregate(ws[i:i + 19], 'string_agg', ' ') END AS k FROM p
        ), g AS (
            SELECT doc_id, w, i, k IS NOT NULL AND row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1 AS goes FROM k
        ), c AS (
            SELECT doc_id, w, i, max(goes) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS covered FROM g
        ), r AS (
            SELECT doc_id, count(*) FILTER (covered) AS n_removed, string_agg(w, ' ' ORDER BY i) FILTER (NOT covered) AS kept FROM c GROUP BY doc_id
        )
        SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN r USING (doc_id)
    """,
    "op9_warc": """
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages
        ), f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
        SELECT page_id, n::BIGINT AS payload_bytes, p.d AS payload_digest,
               CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
        FROM p LEFT JOIN f ON p.d = f.d
    """,
    "op10_nearest": """
        WITH v AS (
            SELECT DISTINCT vec_id, [x > 0 FOR x IN embedding] AS bits
            FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        ), d AS (
            SELECT q.vec_id AS query_id, o.vec_id,
                   list_sum([(z[1] <> z[2])::INTEGER FOR z IN list_zip(q.bits, o.bits)])::INTEGER AS distance
            FROM v q, v o WHERE q.vec_id % 20 = 0 AND o.vec_id <> q.vec_id
        )
        SELECT query_id, rank, vec_id, distance
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id)::INTEGER AS rank FROM d)
        WHERE rank <= 10
    """,
}
