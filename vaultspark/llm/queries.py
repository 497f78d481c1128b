"""Registered queries of this subpackage: thin digests of the operators' results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultspark.llm import (chat_hmm, decontaminate, html_blocks, ngram_trie, oracle, packing, pair_bitmaps, piece_agenda,
                            quality_mil, quality_rules, sharding, simhash, turn_trie, warc)
from vaultspark.llm.common import crc_mod, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {"op6_warc": oracle.WARC, "op11_turn_trie": oracle.TURN_TRIE}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """4-word shingles, links at 4 or fewer of 64 bits, all documents."""
    out = simhash.near_duplicates(spark, table(spark, sf_dir, "documents"), words=4, max_bits=4)
    return out.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and the log-likelihood ratio of every document; trusted are those labelled quality 1."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trusted = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    out = quality_rules.judge(spark, docs, trusted)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "score", "kept")


# Labels may be learned from documents whose crc32(doc_id as text) modulo 4 is not 2 (fixed by the contract).
def held_out(n: int, fold: int = 2):
    return crc_mod("doc_id", n) == fold


@query
def op5_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every whole text; label 1 is predicted at 0.7 or more."""
    docs = table(spark, sf_dir, "documents")
    model = quality_mil.fit(spark, docs, table(spark, sf_dir, "labels"), learn=~held_out(4))
    out = quality_mil.score(docs, model)
    return out.select("doc_id", held_out(4).alias("held_out"), "score",
                      (F.col("score") >= quality_mil.THRESHOLD).cast("int").alias("predicted"))


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(document, benchmark item) pairs: items that a document holds, exchanged numbers and names included."""
    return decontaminate.contaminated(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 tokens; a piece's ids are left out of the digest."""
    return packing.pack(spark, table(spark, sf_dir, "documents"), window=1024, vocabulary="byte_bpe_50k", keep_ids=False)


@query
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """16 shards of near equal bytes; documents with equal texts stay together."""
    out = sharding.shard_documents(spark, table(spark, sf_dir, "documents"), shards=16)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


@query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived and read back; equal payloads of 1000 bytes or more are written once."""
    out = warc.archive(spark, table(spark, sf_dir, "pages"), revisit_from=1000)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op7_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every whole text by a model of three words, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = ngram_trie.learn(spark, docs, learn_from=~held_out(7), order=3)
    out = ngram_trie.score(docs, model)
    return out.select("doc_id", held_out(7).alias("held_out"), "n_tokens", "n_known",
                      F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


@query
def op8_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_blocks.extract(spark, table(spark, sf_dir, "pages"))


def raw_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in transcripts (conv_id, seq, text): the conversations' turns written down with the
    speaker markers of five tools; in every tenth turn the marker is missing after a blank line."""
    style = F.pmod(F.xxhash64("conv_id"), F.lit(5))
    role = F.col("role")
    plain = F.concat(F.initcap(role), F.lit(": "))
    human = F.when(role == "user", "Human: ").when(role == "assistant", "AI: ").otherwise("System: ")
    letter = F.when(role == "user", "Q: ").when(role == "assistant", "A: ").otherwise("Instructions: ")
    heading = F.concat(F.lit("### "), F.initcap(role), F.lit("\n"))
    bracket = F.concat(F.lit("["), role, F.lit("] "))
    mark = (F.when(style == 0, plain).when(style == 1, human).when(style == 2, letter).when(style == 3, heading).otherwise(bracket))
    bare = (F.pmod(F.xxhash64("conv_id", "turn"), F.lit(10)) == 0) & (F.col("turn") > 0)
    text = F.concat(F.when(bare | role.isNull(), F.lit("\n")).otherwise(mark), F.coalesce("text", F.lit("")))
    return table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("seq"), text.alias("text"))


@query
def op1_chat_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns, roles and canonical form of every transcript."""
    return chat_hmm.parse_transcripts(spark, raw_transcripts(spark, sf_dir))


@query
def op13_piece_agenda(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text with the end id, and the text decoded from them."""
    out = piece_agenda.encode(table(spark, sf_dir, "documents"), model="piece_bpe_32k.model")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.concat_ws(" ", F.transform("ids", lambda i: i.cast("string"))), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"), "agrees")


@query
def op12_pair_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between the tokens of two vocabularies in every document, scored by the corpus-wide counts of their pairs."""
    out = pair_bitmaps.align(spark, table(spark, sf_dir, "documents"), a="byte_bpe_50k", b="piece_bpe_32k.model", keep_groups=False)
    return out.documents.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Every conversation c of :func:`turn_trie.sequences` with its first h turns taken from c - c % 20, if that is
    there; h is crc32 of c's decimal digits modulo 4 (fixed by the contract)."""
    heads = conversations.where(F.col("conv_id") % 20 == 0).select(F.col("conv_id").alias("_base"), F.slice("turns", 1, 3).alias("_head"))
    h = crc_mod("conv_id", 4).cast("int")
    own = F.col("turns")
    none = F.slice(own, 1, 0)
    turns = F.concat(F.coalesce(F.slice("_head", F.lit(1), h), none), F.slice(own, h + 1, F.greatest(F.size(own), F.lit(1))))
    joined = conversations.join(heads, F.col("conv_id") - F.col("conv_id") % 20 == F.col("_base"), "left")
    return joined.select("conv_id", turns.alias("turns"))


@query
def op11_turn_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct beginning of the rebuilt conversations, with its members, its subtree and what sharing it saves."""
    return turn_trie.trie(spark, rebuilt(turn_trie.sequences(table(spark, sf_dir, "conversations"))))
