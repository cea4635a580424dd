"""Benchmark decontamination by a distributed positional inverted index. Built-ins only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ascii_lower, free, maybe_broadcast, written

#: What separates words: ASCII but digits and letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW_WORDS = 10
#: Words that the second term of a proximity match may be off its place.
SLOP = 2


def words_of(text: Column) -> Column:
    """A text's words, A-Z lower-cased; null has none."""
    return F.transform(F.filter(F.split(F.coalesce(text, F.lit("")), SEPARATORS), lambda w: w != ""), ascii_lower)


def test_windows(items: DataFrame, id_col: str, text_col: str, size: int = WINDOW_WORDS) -> DataFrame:
    """(item, phrase, len): each run of `size` item words, or all words of a shorter item; phrases are space-joined."""
    w = items.select(F.col(f"`{id_col}`").alias("item"), words_of(F.col(f"`{text_col}`")).alias("w")).filter("size(w) > 0")
    w = w.withColumn("len", F.least(F.size("w"), F.lit(size)))
    return w.select("item", "len", F.explode(F.expr("transform(sequence(1, size(w) - len + 1), i -> concat_ws(' ', slice(w, i, len)))")).alias("phrase")).distinct()


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(_rid, pos, term) of each word of docs (_rid, w) that is in terms (term)."""
    return docs.select("_rid", F.posexplode("w").alias("pos", "term")).join(maybe_broadcast(terms), "term")


def rarest_terms(docs: DataFrame, phrases: DataFrame) -> DataFrame:
    """(phrase, len, term1, off1, term2, off2): a phrase's two rarest terms, counted over all docs, and where they stand
    in it; term2 is null for a phrase of one word. Ties: the lesser term, then the first. Phrases with a word that no
    document has are left out."""
    terms = written(phrases.select("phrase", "len", F.posexplode(F.split("phrase", " ")).alias("off", "term")), "terms")
    vocabulary = written(terms.select("term").distinct(), "vocabulary")
    freq = written(postings(docs, vocabulary).groupBy("term").agg(F.count(F.lit(1)).alias("freq")), "freq")
    rank = Window.partitionBy("phrase").orderBy(F.col("freq").asc_nulls_first(), "term", "off")
    ranked = terms.join(maybe_broadcast(freq), "term", "left").withColumn("r", F.row_number().over(rank)).filter("r <= 2")
    pair = ranked.groupBy("phrase", "len").agg(
        F.count("freq").alias("k"), F.count(F.lit(1)).alias("n"),
        *[F.max(F.when(F.col("r") == i, F.col(c))).alias(f"{c}{i}") for i in (1, 2) for c in ("term", "off")],
    ).filter("k = n")
    return written(pair.drop("k", "n"), "pairs")


def matches(docs: DataFrame, phrases: DataFrame, slop: int = SLOP) -> DataFrame:
    """(_rid, phrase, len, start, slip) of candidates: where a phrase's two rarest terms stand `slip` words off their
    distance. Those at a slip of 0 are still to be compared in full.

    docs: _rid, w; phrases: phrase, len. The index holds postings of these rarest terms only; lists are intersected by
    an equi-join on the row and the offset-adjusted position, once for all phrases that have the same two terms at the
    same distance (as an item's neighbouring windows have), so a common term meets only the rows of a rare one.
    """
    pair = rarest_terms(docs, phrases)
    anchors = written(pair.select(F.explode(F.array("term1", "term2")).alias("term")).filter("term is not null").distinct(), "anchors")
    index = written(postings(docs, anchors), "postings")
    gap = F.col("off2") - F.col("off1")
    single = pair.filter("term2 is null").select("phrase", "len", F.col("term1").alias("term"))
    single = index.join(maybe_broadcast(written(single, "single")), "term").select("_rid", "phrase", "len", F.col("pos").alias("start"), F.lit(0).alias("slip"))
    wanted = written(pair.filter("term2 is not null").select("term1", "term2", gap.alias("gap")).distinct(), "wanted")
    first = index.withColumnsRenamed({"term": "term1", "pos": "pos1"}).join(maybe_broadcast(wanted), "term1")
    first = first.withColumn("slip", F.explode(F.sequence(F.lit(-slop), F.lit(slop)))).withColumn("pos", F.col("pos1") + F.col("gap") + F.col("slip"))
    second = index.withColumnRenamed("term", "term2")
    both = first.filter("pos <> pos1").join(second, ["_rid", "pos", "term2"]).select("_rid", "term1", "term2", "gap", "pos1", "slip")
    both = both.join(maybe_broadcast(written(pair.withColumn("gap", gap), "windows")), ["term1", "term2", "gap"])
    return single.unionByName(both.select("_rid", "phrase", "len", (F.col("pos1") - F.col("off1")).alias("start"), "slip"))


def found_phrases(words: DataFrame, candidates: DataFrame) -> DataFrame:
    """(_rid, phrase, len, starts, near): a row's phrases with the word numbers at which each occurs, and those (of its
    first word) at which it is only near. words: _rid, w."""
    c = candidates.groupBy("_rid", "phrase", "len").agg(F.collect_set(F.when((F.col("slip") == 0) & (F.col("start") >= 0), F.col("start"))).alias("starts"), F.collect_set("start").alias("near"))
    # a row's candidates: no more than its own words times the phrases that share them
    c = written(c.groupBy(F.col("_rid").alias("_r")).agg(F.collect_list(F.struct("phrase", "len", "starts", "near")).alias("c")), "candidates")
    j = words.join(maybe_broadcast(c, rows=50_000), F.col("_rid") == F.col("_r"))
    j = j.select("_rid", F.explode(F.expr("transform(c, x -> struct(x.phrase as phrase, x.len as len, x.near as near, filter(x.starts, s -> concat_ws(' ', slice(w, s + 1, x.len)) = x.phrase) as starts))")).alias("x"))
    j = j.select("_rid", "x.phrase", "x.len", F.array_sort("x.starts").alias("starts"), F.array_sort(F.array_except("x.near", "x.starts")).alias("near"))
    return written(j, "found")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = WINDOW_WORDS, slop: int = SLOP, key: str | None = None) -> DataFrame:
    """One row per row of docs: id, n_words, n_hit, n_items, items_sha256, contaminated, n_near, near, _rid.

    A document word inside any exact occurrence of a test window is hit; n_items counts items with such windows.
    n_near counts windows found only near, their two rarest terms at most `slop` words off their distance, and near has
    the first 0-based word at which each would begin, in order. Nulls have no words; an item without words has no
    window; rows with the same id or text are each judged; a null item id is no item, though its windows hit. No window
    at all: nothing is hit. Texts are split into words once and written as such; other columns are left out. key: a
    stored column of docs that tells rows apart, else one is written.
    """
    rid = F.monotonically_increasing_id() if key is None else F.col(f"`{key}`")
    d = docs.select(rid.alias("_rid"), F.col(f"`{id_col}`").alias("_id"), words_of(F.col(f"`{text_col}`")).alias("w"))
    d = written(d.withColumn("n_words", F.size("w").cast("long")), "words")
    windows = written(test_windows(items, item_id, item_text, size), "test")
    found = found_phrases(d.select("_rid", "w"), matches(d.select("_rid", "w"), windows.select("phrase", "len").distinct(), slop))

    hit = F.array_distinct(F.flatten(F.collect_list(F.expr("flatten(transform(starts, s -> sequence(s, s + len - 1)))"))))
    none = F.size("starts") == 0
    nears = F.collect_list(F.when(none, F.col("near")[0]))
    per_row = found.groupBy("_rid").agg(F.size(hit).cast("long").alias("n_hit"), F.count(F.when(none, 1)).alias("n_near"), F.array_sort(nears).alias("near"))
    of = found.filter(~none).select("_rid", "phrase").join(maybe_broadcast(windows.select("phrase", "item")), "phrase")
    of = of.filter("item is not null").select("_rid", F.col("item").cast("string").alias("item")).distinct().groupBy("_rid")
    of = of.agg(F.array_join(F.array_sort(F.collect_list("item")), ",").alias("items"), F.count(F.lit(1)).alias("n_items"))
    judged = written(per_row.join(of, "_rid", "left").withColumnRenamed("_rid", "_r"), "judged")
    counted = written(d.drop("w"), "counted")
    free(d, found)  # the result reads no words
    out = counted.join(maybe_broadcast(judged), F.col("_rid") == F.col("_r"), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return out.select(
        F.col("_id").alias(id_col), "n_words", zero("n_hit").alias("n_hit"), zero("n_items").alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"), (zero("n_hit") > 0).alias("contaminated"),
        zero("n_near").alias("n_near"), F.coalesce("near", F.array().cast("array<int>")).alias("near"), "_rid",
    )
