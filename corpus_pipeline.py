"""The training-data pipeline over documents: five stages, each written as Parquet and read again as the next one's input.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. A stage gives
rows a key (common.keyed), by which its decisions reach them, so that repeated rows are told apart. Nulls: a row with a null text, an empty one or one without a letter is in no language and
goes in the first stage; a null id is carried like any other value. An empty table gives an empty result of the same
columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atollgrid.llm.common import keyed, maybe_broadcast, small_batches, some_rows, table, written
from atollgrid.llm.decontamination import decontaminate
from atollgrid.llm.language import documents_language
from atollgrid.llm.pieces import encode_and_sample
from atollgrid.llm.simhash import similar_documents
from atollgrid.llm.suffix_dedup import LENGTH, PASSAGES, Unit, byte_spans, repeated_spans, without

#: SQL can't express sampling from a lattice, nor XXH64 fingerprints; the stages are tested against brute force.
ORACLE_SQL = None
#: Units that the last stage's workers remember, and bytes of texts that they work on together: less than the operator's own
#: defaults, as executors have the heap of the stages before.
MEMO_UNITS, BATCH_BYTES = 60_000, 1 << 18
#: What repeats: passages of over 50 words, and strings of 400 bytes, that another row has too.
REPEATS = (Unit(length=LENGTH, across=True), PASSAGES)


def _key(docs: DataFrame) -> str:
    """A name that no column of docs begins with."""
    name = "row_key"
    while any(c.lower().startswith(name) for c in docs.columns):
        name += "_"
    return name


def _without(docs: DataFrame, rows: DataFrame, key: str, name: str) -> DataFrame:
    """The rows of docs whose keys aren't in rows (key), with the columns of docs but for its own key `name`. What goes is
    less than what stays."""
    rows = written(rows.select(F.col(f"`{key}`").alias(f"{name}_r")), "gone")
    return docs.join(maybe_broadcast(rows), F.col(name) == F.col(f"{name}_r"), "left_anti").drop(name)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is identified; the rest go."""
    small_batches(spark)
    key = _key(docs)
    d = keyed(docs, *docs.columns, key=key)
    return _without(d, documents_language(d, key).filter("not kept"), key, key)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts whose five-word shingles have a Jaccard similarity of 0.8 or more: the smallest id's."""
    small_batches(spark)
    key = _key(docs)
    d = keyed(docs, *docs.columns, key=key)
    return _without(d, similar_documents(d, key=key).filter("not keeper"), "_rid", key)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what another row has too: passages of over 50 words, and bytes under strings of 400. What a cut leaves
    of a character goes too, and so do rows of which nothing but white space is left. n_chars follows the text."""
    small_batches(spark)
    key = _key(docs)
    d = keyed(docs, *docs.columns, key=key)
    row, new_text = f"{key}_r", f"{key}_text"
    spans = repeated_spans(d, "text", REPEATS, key=key).withColumnRenamed(key, row)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in some_rows(batches, 1):
            out = []
            for text, runs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                out.append("".join(x.decode("utf-8", "ignore") for x in without(text, byte_spans(text, runs, REPEATS))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], [row, new_text])

    text = d.select(key, F.col("text").cast("binary").alias("t"))
    changed = text.join(maybe_broadcast(spans), F.col(key) == F.col(row)).select(row, "t", "runs")
    changed = written(changed.mapInArrow(cut, f"{row} bigint, {new_text} string"), "cut")
    j = d.join(maybe_broadcast(changed), F.col(key) == F.col(row), "left")
    j = j.filter(F.col(row).isNull() | F.col(new_text).rlike(r"\S"))
    new = {"text": F.col(new_text)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(new_text).cast(docs.schema["n_chars"].dataType)
    own = lambda c: F.col(f"`{c}`")
    return j.select(*[(F.when(F.col(row).isNotNull(), new[c]).otherwise(own(c)) if c in new else own(c)).alias(c) for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a window of a benchmark item."""
    key = _key(docs)
    d = keyed(docs, *docs.columns, key=key)
    found = decontaminate(d, table(spark, sf_dir, "benchmark"), key=key)
    return _without(d, found.filter("contaminated"), "_rid", key)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each text's encoding, and segmentations sampled without replacement."""
    small_batches(spark)
    return encode_and_sample(docs, "doc_id", "text", public_tokenizers.path("piece_bpe_32k.model"), ids=True, memo=MEMO_UNITS, batch=BATCH_BYTES)


STAGES = [
    ("language ID", language),
    ("SimHash near-dedup", near_duplicate),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding and decoding", pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
