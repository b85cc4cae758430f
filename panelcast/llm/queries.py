"""The operators of this subpackage over the whole input tables, one query each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelcast.llm import collocations, decontaminate, line_dedup, warc
from panelcast.llm.collocations import mine_collocations
from panelcast.llm.decontaminate import find_windows
from panelcast.llm.jaccard import link_documents
from panelcast.llm.langid import identify, train
from panelcast.llm.order_minhash import fingerprints
from panelcast.llm.packing import pack, token_pieces
from panelcast.llm.quality import score_documents
from panelcast.llm.records import token_starts, write_index, write_records
from panelcast.llm.shared import table
from panelcast.llm.urls import judge
from panelcast.llm.vector_packing import Limits, pack_examples
from panelcast.llm.warc import read_archives, write_archives
from panelcast.llm.whitening import whiten
from panelcast.session import new_path

URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that spread over sites."""
    return line_dedup.remove_spread_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token pieces, placed in sequences of 2048."""
    return pack(token_pieces(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json")))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back, a row per record."""
    archives = new_path(spark, "archives")
    write_archives(table(spark, sf_dir, "pages"), archives)
    return read_archives(spark, archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-id records written in doc_id order and read back, a row per document."""
    files, index = new_path(spark, "records"), new_path(spark, "records-index")
    write_records(table(spark, sf_dir, "documents"), files, tokenizer_path("word_bpe_49k.json"))
    return token_starts(write_index(spark, files, index)).select("doc_id", "start", "n_tokens", "ids_crc32", "file", "byte_offset", "byte_length")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chance of every document to be good, and whether it is kept."""
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict on every page's URL."""
    return judge(table(spark, sf_dir, "pages"), URL_RULES)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document."""
    return link_documents(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0)
    return identify(docs, train(docs.where("NOT held_out")), keep=["doc_id", "held_out"])


def op9_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text."""
    return fingerprints(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside any window of a benchmark item."""
    found = find_windows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hits = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    listed = F.array_join(F.array_sort(F.col("item_ids").cast("array<string>")), ",")
    return found.select(
        "doc_id", "n_words", hits.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"), F.sha2(listed, 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated")
    )


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding's coordinates on the first 16 whitened components."""
    return whiten(table(spark, sf_dir, "embeddings"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2000 best phrases of 2 to 5 words."""
    return mine_collocations(table(spark, sf_dir, "documents"))


def op13_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens in sequences of at most 2048 tokens, 64 segments and 2048 loss-bearing tokens."""
    return pack_examples(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), Limits(2048, 64, 2048))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_warc": op3_warc,
    "op4_binary_records": op4_binary_records,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_url_filter": op6_url_filter,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_language_id": op8_language_id,
    "op9_order_minhash": op9_order_minhash,
    "op10_decontamination": op10_decontamination,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_collocations": op12_collocations,
    "op13_vector_packing": op13_vector_packing,
}
ORACLES: dict[str, str] = {
    "op1_line_dedup": line_dedup.oracle(),
    "op3_warc": warc.oracle(),
    "op10_decontamination": decontaminate.oracle(),
    "op12_collocations": collocations.oracle(),
}
