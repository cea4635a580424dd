"""Every operator and stage on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import corpus_pipeline
import public_tokenizers
import pytest
from atollgrid.llm.decontamination import decontaminate
from atollgrid.llm.html_text import extract
from atollgrid.llm.language import documents_language
from atollgrid.llm.pieces import encode_and_sample
from atollgrid.llm.quality import host_rules
from atollgrid.llm.simhash import near_duplicates
from atollgrid.llm.suffix_dedup import without_repeats
from atollgrid.llm.token_counts import token_counts
from atollgrid.llm.toxicity import toxicity
from atollgrid.llm.url_filters import url_verdicts

LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
ROWS = [
    (1, "the same words of a text that is there twice " * 12, "en", "a", 1, "z", 1, "z"),
    (1, "the same words of a text that is there twice " * 12, "en", "a", 1, "z", 1, "z"),  # a repeated row
    (2, "", "en", "a", None, None, None, None),
    (3, None, None, None, None, None, None, None),
    (None, "a row without an id, idiot", "de", None, 3, "z", 2, "z"),
    (4, LONG, "en", "b", 4, "z", 3, "z"),
    (5, "\t \n\x0b\x00\x1f ", "fr", "b", 5, "z", 4, "z"),
    (6, "ﬁ Ａé☃ 日本 <|endoftext|> ▁▁ \u0301x", "fr", "b", 6, "z", 5, "z"),
    (7, "short", "en", "c", 7, "z", 6, "z"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _id string, _rid bigint, host string"
PAGES = "page_id bigint, url string, html string, _id string, host string, rule string, text string"


def stored(spark, tmp_path, name, rows, schema):
    path = str(tmp_path / f"{name}.parquet")
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("edges")
    out = {}
    for kind, rows in (("full", ROWS), ("empty", [])):
        items = [(1, "words of a text that is there"), (2, None), (None, "short"), (3, "")] if rows else []
        labels = [(1, 0, 0), (None, 1, 1), (7, None, 1), (2, 1, None), (99, 0, 1)] if rows else []
        pages = [(1, "http://a.example.com/en/1", "<p>x" * 3, "q", "q", "q", "q"), (2, None, None, None, None, None, None), (None, "no scheme", "<<<>><!--", "q", "q", "q", "q"), (3, "x://", "", "q", "q", "q", "q"), (3, "x://", "", "q", "q", "q", "q"), (4, "http://b.example.net/fr/", "<a href='http://A.example.com/x'>y</a>" * 2000, "q", "q", "q", "q")] if rows else []
        folder = d / kind
        folder.mkdir()
        out[kind] = str(folder), {
            "documents": stored(spark, folder, "documents", rows, SCHEMA),
            "benchmark": stored(spark, folder, "benchmark", items, "item_id bigint, text string"),
            "labels": stored(spark, folder, "labels", labels, "doc_id bigint, quality int, toxic int"),
            "pages": stored(spark, folder, "pages", pages, PAGES),
        }
    return out


OPERATORS = {
    "toxicity": lambda t: toxicity(t["documents"], t["labels"]),
    "urls": lambda t: url_verdicts(t["pages"], rounds=3),
    "quality": lambda t: host_rules(t["documents"]),
    "suffix": lambda t: without_repeats(t["documents"]),
    "simhash": lambda t: near_duplicates(t["documents"]),
    "tokens": lambda t: token_counts(t["documents"], "doc_id", "text", public_tokenizers.path("word_bpe_49k.json")),
    "html": lambda t: extract(t["pages"]),
    "language": lambda t: documents_language(t["documents"]),
    "pieces": lambda t: encode_and_sample(t["documents"], "doc_id", "text", public_tokenizers.path("piece_bpe_32k.model")),
    "decontamination": lambda t: decontaminate(t["documents"], t["benchmark"]),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_operator(tables, name):
    for kind in ("full", "empty"):
        t = tables[kind][1]
        rows = OPERATORS[name](t).collect()
        key = "page_id" if name in ("urls", "html") else "doc_id"
        of = t["pages"] if key == "page_id" else t["documents"]
        assert sorted((r[key] for r in rows), key=str) == sorted((r[key] for r in of.collect()), key=str)
        by = {r[key]: r.asDict() for r in rows}
        if kind == "empty":
            continue
        if name == "toxicity":
            assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
            assert by[None]["held_out"] is False and by[3]["score"] == by[2]["score"]
        elif name == "urls":
            assert by[1]["rule"] == "example.com/en/" and by[2]["host"] == "" and by[None]["path"] == "" and by[4]["rule"] == "net/fr/"
            assert all(r["verdict"] in ("allow", "block") for r in rows)
        elif name == "quality":
            assert by[3]["n_words"] == by[2]["n_words"] == 0 and by[3]["base_failed"] and not by[3]["kept"] and by[4]["n_words"] == 30_000
        elif name == "suffix":
            assert by[1]["n_removed"] == by[1]["n_bytes"] and by[3]["n_bytes"] == 0 and by[4]["n_removed"] == 0
        elif name == "simhash":
            assert by[3]["fingerprint"] == "0" * 16 and by[3]["component_id"] == by[2]["component_id"] == 2 and by[7]["component_id"] == 7
            assert sum(r["keeper"] for r in rows if r["doc_id"] == 1) == 1
        elif name == "tokens":
            assert by[3]["n_tokens"] == by[2]["n_tokens"] == 0 and by[4]["over_limit"]
        elif name == "html":
            assert by[2]["text"] == "" and by[2]["n_chars"] == 0 and by[1]["text"] == "x x x"
        elif name == "language":
            assert all(by[i]["language"] is None and by[i]["posterior"] == 0 and not by[i]["kept"] for i in (2, 3, 5)) and by[1]["language"] == "en"
        elif name == "pieces":
            assert by[3]["n_pieces"] == 0 and len(by[3]["samples"]) == 1 and not by[6]["round_trip"] and by[4]["round_trip"]
        elif name == "decontamination":
            assert by[1]["contaminated"] and by[7]["n_hit"] == 1 and by[7]["n_items"] == 0 and by[3]["n_words"] == 0


def test_pipeline(spark, tables):
    for kind in ("full", "empty"):
        folder, t = tables[kind]
        docs = t["documents"]
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, folder)
            if i < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
            path = f"{folder}/stage{i}.parquet"
            out.write.mode("overwrite").parquet(path)
            docs = spark.read.parquet(path)
            if i == 0:
                assert {r["doc_id"] for r in docs.collect()}.isdisjoint({2, 3, 5})  # texts without a letter are in no language
        ids = [r["doc_id"] for r in docs.collect()]
        assert len(ids) == len(set(ids)) and (kind == "empty") == (not ids)
