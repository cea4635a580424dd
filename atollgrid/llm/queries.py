"""Queries over the training-data operators, and their SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from .common import table
from .decontamination import decontaminate
from .html_text import extract
from .language import documents_language, pages_language
from .oracles import ORACLE
from .pieces import encode_and_sample
from .quality import host_rules
from .simhash import near_duplicates
from .suffix_dedup import without_repeats
from .token_counts import token_counts
from .toxicity import toxicity
from .url_filters import url_verdicts


def op1_toxicity(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_url_filters(spark, sf_dir):
    return url_verdicts(table(spark, sf_dir, "pages"))


def op3_quality_rules(spark, sf_dir):
    return host_rules(table(spark, sf_dir, "documents")).withColumn("host_rate", F.round("host_rate", 9))


def op4_suffix_dedup(spark, sf_dir):
    return without_repeats(table(spark, sf_dir, "documents")).drop("_rid")


def op5_simhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op6_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"), "doc_id", "text", public_tokenizers.path("word_bpe_49k.json"))


def op7_html_text(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages"))


def op8_language(spark, sf_dir):
    return documents_language(table(spark, sf_dir, "documents"))


def language_of_pages(spark, sf_dir):
    return pages_language(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op9_pieces(spark, sf_dir):
    return encode_and_sample(table(spark, sf_dir, "documents"), "doc_id", "text", public_tokenizers.path("piece_bpe_32k.model"), ids=True)


def op10_decontamination(spark, sf_dir):
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("_rid")
    return found.withColumn("near", F.array_join("near", ","))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_url_filters": op2_url_filters,
    "op3_quality_rules": op3_quality_rules,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_simhash": op5_simhash,
    "op6_token_counts": op6_token_counts,
    "op7_html_text": op7_html_text,
    "op8_language": op8_language,
    "op9_pieces": op9_pieces,
    "op10_decontamination": op10_decontamination,
    "language_of_pages": language_of_pages,
}

__all__ = ["ORACLE", "QUERIES"]
