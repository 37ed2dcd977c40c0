"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starpipe.llm import oracles, url_filter
from starpipe.llm.common import read_table
from starpipe.workspace import new_path

#: Payload bytes of a record in the registered archives: the longer given pages take several.
ARCHIVE_CHUNK = 16 << 10
#: Both texts of conversation -1.
SAID = "</s>[INST] ok [/INST]"
#: The secret of the registered queries; a real run passes its own.
SECRET = "registered-query"


def tokenizer_files() -> tuple[str, str]:
    """The byte-level vocabulary in its two forms, where the public files are installed."""
    from public_tokenizers import path

    return path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starpipe.llm.quality import judge

    judged = judge(read_table(spark, sf_dir, "documents"), carry=["doc_id"])
    fixed = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    more = [c for c in judged.schema["__quality"].dataType.names if c not in fixed]
    return judged.select("doc_id", *[f"__quality.{c}" for c in (*fixed, *more)])


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge_urls(read_table(spark, sf_dir, "pages"), carry=["page_id"])
    fixed = ["page_id", "host", "path", "rule", "verdict"]
    return judged.select(*fixed, *[c for c in judged.columns if c not in fixed])


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starpipe.llm.chat import Template, conversations, replies_of_turns

    given = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.sql(
        f"SELECT -1L AS conv_id, turn, role, '{SAID}' AS text "
        "FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"
    )
    template = Template()
    messages = replies_of_turns(given.unionByName(own), "conv_id", "turn", ["role", "text"])
    written = conversations(messages, template=template)
    read = written.select(
        F.col("tree").alias("conv_id"),
        template.parse(F.col("formatted")).alias("turns"),
        template.learnt_text(F.col("formatted"), F.col("loss_spans")).alias("learnt"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op4_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starpipe.llm.setjoin import similar_sets

    return similar_sets(read_table(spark, sf_dir, "documents"))


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starpipe.llm.html_text import main_texts

    return main_texts(read_table(spark, sf_dir, "pages"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starpipe.llm.warc import payloads, read_chunks, write_archives

    path = new_path(spark, "archives")
    token = write_archives(read_table(spark, sf_dir, "pages"), path, chunk=ARCHIVE_CHUNK)
    return payloads(read_chunks(spark, path, token, blocks=False))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starpipe.llm.packing import pack

    return pack(read_table(spark, sf_dir, "documents"), *tokenizer_files())


def op8_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starpipe.llm.vectors import near_vectors

    return near_vectors(read_table(spark, sf_dir, "embeddings"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starpipe.llm.pii import pseudonymise

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymise(docs, SECRET, count="n_pseudonyms")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starpipe.llm.mixing import TARGETS, domain_of_labels, mix

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = domain_of_labels(read_table(spark, sf_dir, "labels"))
    mixed = mix(docs, labels, carry=["doc_id"])
    shares = [F.col("__mix.posterior")[d].alias(f"p_{name}") for d, name in enumerate(TARGETS)]
    return mixed.select("doc_id", "__mix.tokens", *shares, "__mix.rate", "__mix.copies")


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starpipe.llm.digest_index import keep_last

    docs = read_table(spark, sf_dir, "documents")
    return keep_last(docs, new_path(spark, "digest-index"), carry=["doc_id"]).select(
        "given.doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starpipe.llm.fim import fill_in_middle, restore

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return restore(fill_in_middle(docs, carry=["doc_id"])).select(
        "given.doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"),
    )


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starpipe.llm.phrases import collocations

    return collocations(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_url_filters": op2_url_filters,
    "op3_chat": op3_chat,
    "op4_set_join": op4_set_join,
    "op5_html": op5_html,
    "op6_warc": op6_warc,
    "op7_packing": op7_packing,
    "op8_vectors": op8_vectors,
    "op9_pii": op9_pii,
    "op10_mixing": op10_mixing,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_phrases": op13_phrases,
}

ORACLES: dict[str, str] = {
    "op2_url_filters": oracles.url_filters(),
    "op3_chat": oracles.chat(SAID),
    "op4_set_join": oracles.set_join(),
    "op8_vectors": oracles.vectors(),
    "op11_exact_dedup": oracles.duplicates(),
    "op12_fill_in_middle": oracles.fill_in_middle(),
    "op13_phrases": oracles.phrases(),
}
