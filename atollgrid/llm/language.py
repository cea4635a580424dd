"""Language identification by Bayesian fusion of text, declared language, address and host evidence."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import maybe_broadcast, some_rows, written
from .url_filters import host_of

#: Labelled rows of each language that the text model is fitted on at most: those of the smallest hashes of their ids.
TRAIN_ROWS = 2000
#: Parts that a label's rows are ranked in before their best are ranked together.
RANK_PARTS = 64
#: Hash buckets of byte trigrams, and pseudo-counts of each.
BUCKETS, SMOOTH = 1 << 16, 0.05
#: Trigrams that a text's evidence counts for at most: they aren't independent.
EVIDENCE = 60.0
#: Chance that a declaration, or an address, is right where it names a known language.
DECLARED_TRUST, ADDRESS_TRUST = 0.9, 0.75
#: Pages that a domain's, and the whole corpus's, shares count for in a host's prior.
HOST_SMOOTH = 20.0
#: Chance per trigram under no language at all (well under that of buckets drawn evenly, so that a key or an address in a
#: short text does not make it one of none), and that a row is in none.
NOISE, NOISE_PRIOR = math.log(1.0 / BUCKETS) - 1.5, 0.02
MIN_POSTERIOR = 0.5
#: Country suffixes that say a language, where the language's own code is another.
SUFFIXES = {"at": "de", "mx": "es", "ar": "es", "co": "es", "cl": "es", "pe": "es", "uk": "en", "us": "en", "au": "en", "nz": "en", "ie": "en", "br": "pt", "jp": "ja", "cn": "zh", "kr": "ko", "cz": "cs", "dk": "da", "se": "sv", "gr": "el", "ua": "uk"}


def trigram_codes(text: bytes) -> np.ndarray:
    """Buckets of the byte trigrams of a text in lower case, runs of what is no letter being one space."""
    x = np.frombuffer(b" " + _NO_LETTER.sub(b" ", text.lower()) + b" ", np.uint8).astype(np.uint32)
    return ((x[:-2] * 0x9E3779B1 + x[1:-1] * 0x85EBCA6B + x[2:] * 0xC2B2AE35) >> np.uint32(8)) & np.uint32(BUCKETS - 1) if len(x) > 2 else np.empty(0, np.uint32)


_NO_LETTER = re.compile(rb"[\x00-\x60\x7b-\x7f]+")


def text_model(train: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, log chances [bucket, language]) from rows (text, lang): every label that has rows gets a model. The
    counts are summed in Spark; what reaches the driver is at most BUCKETS counts a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in some_rows(batches, 0):
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = total.setdefault(lang, np.zeros(BUCKETS, np.int64))
                codes = trigram_codes(text or b"")
                own += np.bincount(codes, minlength=BUCKETS)
        for lang, own in total.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(own[at])], ["lang", "b", "n"])

    rows = train.select(F.col("text").cast("binary"), "lang").mapInArrow(count, "lang string, b int, n bigint").groupBy("lang", "b").agg(F.sum("n").alias("n"))
    got = rows.toPandas()
    languages = sorted(got["lang"].unique().tolist())
    table = np.full((BUCKETS, max(1, len(languages))), SMOOTH)
    table[got["b"].to_numpy(), [languages.index(x) for x in got["lang"]]] += got["n"].to_numpy(float)
    return languages, np.log(table / table.sum(axis=0)).astype(np.float32)


def text_evidence(text: bytes, model: np.ndarray) -> np.ndarray | None:
    """Log likelihoods of each language, then of none; of at most EVIDENCE trigrams' weight, over the whole text. None for
    a text without a letter."""
    codes = trigram_codes(text)
    if not len(codes) or len(codes) == 1 and not _NO_LETTER.sub(b"", text.lower()):
        return None
    total = np.zeros(model.shape[1])
    for at in range(0, len(codes), 1 << 18):
        total += model[codes[at : at + (1 << 18)]].sum(axis=0, dtype=np.float64)
    return np.append(total, NOISE * len(codes)) * min(1.0, EVIDENCE / len(codes))


def declared_language(html: Column) -> Column:
    """The lang of an html element, its main part in lower case, else null."""
    found = F.lower(F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})", 1))
    return F.when(found != "", found)


def address_language(url: Column, languages: list[str]) -> Column:
    """The language that an address says: its path's first part, first host label or country suffix; else null."""
    host = F.lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#:]*)", 1))
    part = F.lower(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*/([A-Za-z]{2,3})(?:[-_][A-Za-z]+)?(?:[/?#]|$)", 1))
    label, suffix = F.regexp_extract(host, r"^([a-z]{2,3})\.", 1), F.regexp_extract(host, r"\.([a-z]{2})$", 1)
    said = F.create_map(*[F.lit(x) for kv in ({c: c for c in languages} | {k: v for k, v in SUFFIXES.items() if v in languages}).items() for x in kv]) if languages else None
    known = lambda c: F.when(c.isin(languages), c)
    return F.coalesce(known(part), known(label), said[suffix]) if languages else F.lit(None).cast("string")


def training_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, rows: int = TRAIN_ROWS) -> DataFrame:
    """(text, lang) of at most `rows` rows of each label: those of the smallest hashes of their ids. Rows are ranked in
    RANK_PARTS parts of a label first, so that no task gathers a label whatever its share of the rows."""
    ids = docs.select(F.col(f"`{id_col}`").alias("id"), F.lower(F.col(f"`{lang_col}`")).alias("l")).filter("id is not null and l is not null and l <> ''").distinct()
    ids = ids.withColumn("h", F.xxhash64(F.col("id").cast("string")))
    order = [F.col("h"), F.col("id")]
    few = ids.withColumn("r", F.row_number().over(Window.partitionBy("l", F.pmod("h", F.lit(RANK_PARTS))).orderBy(*order))).filter(F.col("r") <= rows)
    pick = written(few.withColumn("r", F.row_number().over(Window.partitionBy("l").orderBy(*order))).filter(F.col("r") <= rows).select("id", "l"), "picked")
    d = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.lower(F.col(f"`{lang_col}`")).alias("lang"))
    return d.join(maybe_broadcast(pick), (d["id"] == pick["id"]) & (d["lang"] == pick["l"]), "left_semi").select("text", "lang")


def _shares(votes: Column, prior: Column, n: int) -> Column:
    """Shares of languages 0..n-1 by votes (a map of counts), smoothed towards prior (an array)."""
    of = lambda i: F.coalesce(F.try_element_at(votes, i), F.lit(0).cast("bigint"))
    total = F.aggregate(F.map_values(votes), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: (of(i) + HOST_SMOOTH * F.get(prior, i)) / (total + HOST_SMOOTH))


def host_priors(rows: DataFrame, n: int) -> tuple[DataFrame, list[float]]:
    """((host, prior), shares of all rows) from rows (host, guess: a language's number or null). A host's prior is its
    rows' shares of languages, smoothed towards its domain's, which are smoothed towards all rows'. One grouped
    aggregation counts rows; the rest is over counts of hosts."""
    counts = written(rows.filter("guess is not null").groupBy("host", "guess").agg(F.count(F.lit(1)).alias("n")), "votes")
    all_ = {r["guess"]: r["n"] for r in counts.groupBy("guess").agg(F.sum("n").alias("n")).collect()}  # at most n rows
    whole = sum(all_.values())
    share = [(all_.get(i, 0) + 1.0) / (whole + n) for i in range(n)]
    domain = F.coalesce(F.nullif(F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1), F.lit("")), F.col("host"))
    known = counts.filter("host is not null").withColumn("domain", domain)
    as_map = lambda c: F.map_from_entries(F.collect_list(F.struct("guess", c)))
    domains = known.groupBy("domain", "guess").agg(F.sum("n").alias("n")).groupBy("domain").agg(as_map("n").alias("d"))
    hosts = known.groupBy("host", "domain").agg(as_map("n").alias("v")).join(domains, "domain")
    hosts = hosts.withColumn("of_domain", _shares(F.col("d"), F.array(*map(F.lit, share)), n))
    return written(hosts.select("host", _shares(F.col("v"), F.col("of_domain"), n).alias("prior")), "priors"), share


def identify(docs: DataFrame, id_col: str, text_col: str, model: tuple[list[str], np.ndarray], declared: Column | None = None, url: Column | None = None, host: Column | None = None, wanted: list[str] | None = None, min_posterior: float = MIN_POSTERIOR, key: str | None = None) -> DataFrame:
    """One row per row of docs: id, language (null for none), posterior, kept; with `key`, a column of docs, also that.

    Evidence is multiplied: the text's likelihood in each language (whole text, tempered) and in none; what is declared
    and what the address says, each right with a fixed chance; and the host's prior. That is its rows' shares of languages
    by text alone, counted by one grouped aggregation and smoothed towards its domain's, which are smoothed towards all
    rows'. Missing evidence of any other kind (null host, unknown codes) says nothing; a text without a letter, a null
    and an empty one among them, is in no language with a posterior of 0, whatever is declared. kept is false where no
    language comes out, the best one's posterior is under min_posterior, or it isn't wanted (null: all are). Repeated
    rows are each judged. Texts pass through Python once and are never shuffled; what is written has no texts.
    """
    languages, table = model
    n = len(languages)
    none = F.lit(None).cast("string")
    rest = [] if key is None else [key]
    k = F.struct(F.col(f"`{id_col}`").alias("_id"), F.lower(none if declared is None else declared).alias("declared"), (address_language(url, languages) if url is not None else none).alias("address"), (none if host is None else host).alias("host"), *[F.col(f"`{c}`").alias(c) for c in rest])

    def likelihoods(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in some_rows(batches, 1):
            found = [text_evidence(t or b"", table) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([None if x is None else x.tolist() for x in found], pa.list_(pa.float64()))], ["k", "ll"])

    d = docs.select(k.alias("k"), F.col(f"`{text_col}`").cast("binary").alias("t"))
    d = written(d.mapInArrow(likelihoods, f"k {d.schema['k'].dataType.simpleString()}, ll array<double>").select("k.*", "ll"), "likelihoods")
    if not n:
        return d.select(F.col("_id").alias(id_col), *rest, none.alias("language"), F.lit(0.0).alias("posterior"), F.lit(False).alias("kept"))
    own, top = F.slice("ll", 1, n), F.array_max(F.slice("ll", 1, n))
    alone = F.size(F.filter(own, lambda x: x == top)) == 1  # a tie is no vote
    guess = F.when(alone & (top > F.element_at("ll", n + 1)), F.array_position(own, top).cast("int") - 1)
    prior, share = host_priors(d.select("host", guess.alias("guess")), n)

    names = F.array(*map(F.lit, languages))

    def says(column: str, trust: float) -> Column:
        at = F.array_position(names, F.col(column))  # 0: no known language; null: nothing said
        right, wrong = F.lit(math.log(trust)), F.lit(math.log((1 - trust) / max(1, n - 1)))
        return F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.when(F.coalesce(at, F.lit(0)) == 0, 0.0).when(at == i, right).otherwise(wrong))

    j = d.join(maybe_broadcast(prior.withColumnRenamed("host", "_host")), F.col("host") == F.col("_host"), "left")
    j = j.withColumn("prior", F.coalesce("prior", F.array(*map(F.lit, share)))).withColumn("said", says("declared", DECLARED_TRUST)).withColumn("suggested", says("address", ADDRESS_TRUST))
    logs = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.get("ll", i) + F.log(F.get("prior", i) * (1 - NOISE_PRIOR)) + F.get("said", i) + F.get("suggested", i))
    j = j.withColumn("lp", F.when(F.col("ll").isNotNull(), F.concat(logs, F.array(F.element_at("ll", n + 1) + math.log(NOISE_PRIOR) - math.log(n)))))
    j = j.withColumn("best", F.array_max("lp")).withColumn("posterior", F.coalesce(1 / F.aggregate("lp", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("best"))), F.lit(0.0)))
    j = j.withColumn("language", F.get(F.concat(names, F.array(none)), F.array_position("lp", F.col("best")).cast("int") - 1))
    kept = F.col("language").isNotNull() & (F.col("posterior") >= min_posterior)
    if wanted is not None:
        kept = kept & F.col("language").isin(list(wanted))
    return j.select(F.col("_id").alias(id_col), *rest, "language", "posterior", F.coalesce(kept, F.lit(False)).alias("kept"))


def documents_language(docs: DataFrame, key: str | None = None) -> DataFrame:
    """identify() over a table of documents, by text and host (source). They have no markup and no address, and lang, the
    label of the fitted sample, is no evidence."""
    model = text_model(training_sample(docs, "doc_id", "text", "lang"))
    return identify(docs, "doc_id", "text", model, host=F.col("source"), key=key)


def pages_language(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """identify() over a table of pages: page_id, language, posterior, kept. The text model is fitted on a sample of
    documents; the text is the html's without markup, lang of its html element is what it declares."""
    model = text_model(training_sample(docs, "doc_id", "text", "lang"))
    html = F.coalesce("html", F.lit(""))
    text = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", " "), r"(?s)<!--.*?-->|<[^>]*>|&[#a-zA-Z0-9]+;", " ")
    host = F.nullif(host_of(F.col("url")), F.lit(""))
    d = pages.select("page_id", "url", "html", text.alias("_text"))
    return identify(d, "page_id", "_text", model, declared=declared_language(F.col("html")), url=F.col("url"), host=host)
