"""Toxicity: a learnt lexicon trie read through Levenshtein automata, scored by context windows."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, ascii_lower, some_rows, written

#: Labelled rows that are learnt from at most: those of the smallest hashes of their ids.
TRAIN_ROWS = 20_000
#: An entry's least share of toxic training rows, and of toxic rows among those that have it.
MIN_SHARE, MIN_PRECISION = 0.01, 0.8
#: And its least evidence in nats: rows that have it, times the divergence of their toxic share from all rows'.
MIN_GAIN = 14.0
STEM_LETTERS = (3, 4, 5, 6, 7, 8)
#: Words either side of a hit that make its context.
CONTEXT_WORDS = 8
WORD = re.compile(r"[^\W\d_]+")
QUOTES = "\"“”„«»‹›"
MEMO_WORDS = 400_000


def errors_allowed(letters: int) -> int:
    """Edits under which an entry of so many letters is still found."""
    return 0 if letters < 5 else 1 if letters < 9 else 2


@dataclass
class Node:
    children: dict[str, Node] = field(default_factory=dict)
    word: int = -1  # errors allowed of the entry that ends here, else -1
    stem: int = -1
    below: int = -1  # the most errors allowed at or below


class Lexicon:
    """The trie of words, stems (`stem*`) and words to find as they are (`word=`), intersected with the Levenshtein automaton of what is read.

    A state is the set of (trie node, errors so far) that a word's letters can have led to; states and their transitions
    are determined when first met and kept, so a word costs one look-up a letter, up to the letter that leaves no node.
    Words of `clean` are near an entry by chance: they are no misspellings. (And
    a learnt entry with such a neighbour is found only as it is: its surroundings are crowded.)
    """

    def __init__(self, entries: list[str], clean: frozenset[str] = frozenset()):
        self.root, self.clean = Node(), clean
        for entry in entries:
            stem, text = entry.endswith("*"), entry.rstrip("*=")
            # a stem's free end already lets much through
            allowed = 0 if entry[-1] in "*=" else errors_allowed(len(text))
            node = self.root
            for c in text:
                node.below = max(node.below, allowed)
                node = node.children.setdefault(c, Node())
            node.below = max(node.below, allowed)
            if stem:
                node.stem = max(node.stem, allowed)
            else:
                node.word = max(node.word, allowed)
        self.reset()

    def reset(self) -> None:
        self.start = self._state({(id(self.root), 0): self.root})
        self.memo: dict[str, int] = dict.fromkeys(self.clean, 9)

    def _state(self, nodes: dict) -> dict:
        """Closes nodes over letters of the lexicon that the word leaves out; notes what the state accepts."""
        todo = list(nodes.items())
        while todo:
            (_, e), node = todo.pop()
            for child in node.children.values():
                if e < child.below and (id(child), e + 1) not in nodes:
                    nodes[id(child), e + 1] = child
                    todo.append(((id(child), e + 1), child))
        word = min((e for (_, e), n in nodes.items() if e <= n.word), default=9)
        stem = min((e for (_, e), n in nodes.items() if e <= n.stem), default=9)
        return {"nodes": nodes, "word": word, "stem": stem}

    def _next(self, state: dict, c: str) -> dict | None:
        nodes: dict = {}
        for (_, e), node in state["nodes"].items():
            for letter, child in node.children.items():
                cost = e + (letter != c)
                if cost <= child.below:
                    nodes[id(child), cost] = child
            if e < node.below:
                nodes[id(node), e + 1] = node
        state[c] = found = self._state(nodes) if nodes else None
        return found

    def distance(self, word: str) -> int:
        """Edits from the nearest entry that is near enough, else 9."""
        got = self.memo.get(word)
        if got is not None:
            return got
        state, best = self.start, 9
        for c in word:
            state = state[c] if c in state else self._next(state, c)
            if state is None:
                break
            if state["stem"] < best:
                best = state["stem"]
        if state is not None and state["word"] < best:
            best = state["word"]
        if len(self.memo) >= MEMO_WORDS:
            self.reset()
        self.memo[word] = best
        return best


FEATURES = ("bias", "context", "strongest", "exact", "fuzzy", "density")
#: What a feature weighs before any label is seen; learning pulls from here.
PRIOR = np.array([-2.0, 1.0, 2.0, 0.5, 0.2, 0.5])


def features(text: str, lexicon: Lexicon) -> tuple[list[float], int, int, int]:
    """(features, hits, quoted hits, misspelt hits) of a whole text.

    A hit weighs 1, 0.6 or 0.4 by its edits; 0.3 of it inside quotation marks that open and close within its line and
    CONTEXT_WORDS of it; half as much again for each further hit, to four, among the words around it.
    """
    low = text.lower()
    words = WORD.findall(low)
    distance = lexicon.distance
    if not any(distance(w) < 9 for w in set(words)):
        return [1.0, 0.0, 0.0, 0.0, 0.0, 0.0], 0, 0, 0
    spans = [(m.start(), m.end(), distance(m[0])) for m in WORD.finditer(low)]
    hits = [i for i, s in enumerate(spans) if s[2] < 9]
    at = np.array(hits)
    total, strongest, quoted, fuzzy = 0.0, 0.0, 0, 0
    around = np.searchsorted(at, at + CONTEXT_WORDS, "right") - np.searchsorted(at, at - CONTEXT_WORDS, "left") - 1
    for n, i in enumerate(hits):
        start, end, d = spans[i]
        before = low[spans[max(0, i - CONTEXT_WORDS)][0] : start].rpartition("\n")[2]
        after = low[end : spans[min(len(spans) - 1, i + CONTEXT_WORDS)][1] + 2].partition("\n")[0]
        inside = sum(map(before.count, QUOTES)) % 2 == 1 and any(q in after for q in QUOTES)
        weight = (1.0, 0.6, 0.4)[d] * (0.3 if inside else 1.0) * (1 + 0.5 * min(4, int(around[n])))
        total, strongest, quoted, fuzzy = total + weight, max(strongest, weight), quoted + inside, fuzzy + (d > 0)
    exact = len(hits) - fuzzy
    return [1.0, math.log1p(total), min(strongest, 2.0), math.log1p(exact), math.log1p(fuzzy), math.log1p(100 * total / len(words))], len(hits), quoted, fuzzy


def fit(x: np.ndarray, y: np.ndarray, pull: float = 0.5, steps: int = 100) -> np.ndarray:
    """Logistic weights by damped Newton steps, drawn towards PRIOR; PRIOR itself without rows."""
    w = PRIOR.copy()

    def loss(v: np.ndarray) -> float:
        z = x @ v
        return float(np.logaddexp(0, z).sum() - z @ y + pull / 2 * ((v - PRIOR) ** 2).sum())

    now = loss(w)
    for _ in range(steps if len(y) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + pull * np.eye(len(w)), x.T @ (p - y) + pull * (w - PRIOR))
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > now:  # a whole step can overshoot where classes hardly overlap
            size /= 2
        w = w - size * step
        now = loss(w)
        if np.abs(size * step).max() < 1e-8:
            break
    return w


def held_out(id_: Column) -> Column:
    """crc32 of the id as text is divisible by 5; false for a null id, which is never learnt from."""
    return F.coalesce(F.crc32(id_.cast("string")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int = TRAIN_ROWS) -> DataFrame:
    """(text, toxic) of at most `rows` labelled rows that aren't held out, copies taken once: of rows of one label whose
    words are the same in lower case, the smallest id's stays."""
    pick = labels.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{label_col}`").cast("int").alias("toxic")).filter("_id is not null and toxic is not null")
    pick = pick.filter(~held_out(F.col("_id"))).orderBy(F.xxhash64(F.col("_id").cast("string")), "toxic").limit(rows)
    pick = written(pick, "picked")
    d = docs.select(F.col(f"`{id_col}`").alias("_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    d = d.join(F.broadcast(pick), "_id")  # at most `rows` ids
    words = F.sha2(F.trim(F.regexp_replace(ascii_lower(F.col("text")), SPACE, " ")), 256)
    d = d.groupBy(words.alias("words"), "toxic").agg(F.min(F.struct("_id", "text")).alias("first"))
    return d.select("first.text", "toxic")


def learn_lexicon(train: DataFrame) -> list[str]:
    """Words, and stems `stem*`, that toxic rows have and others hardly do; none where all rows have one label. Each is in
    MIN_SHARE of the toxic rows, so they are at most 1 / MIN_SHARE times as many as such a row has terms on average,
    whatever the size of the corpus: train is bounded."""
    words = F.filter(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+")), lambda w: F.length(w) >= 4)

    def stems_of(n: int) -> Column:  # a function each: a second parameter of a lambda would be the index
        return F.transform(F.filter("w", lambda w: F.length(w) > n), lambda w: F.concat(F.substring(w, 1, n), F.lit("*")))

    stems = [stems_of(n) for n in STEM_LETTERS]
    each = train.select("toxic", words.alias("w")).select("toxic", F.explode(F.array_distinct(F.concat("w", *stems))).alias("term"))
    of = train.agg(F.sum((F.col("toxic") == 1).cast("long")).alias("a"), F.count(F.lit(1)).alias("n")).first()
    if not of["a"] or of["a"] == of["n"]:
        return []
    base = of["a"] / of["n"]
    count = each.groupBy("term").agg(F.sum((F.col("toxic") == 1).cast("long")).alias("a"), F.count(F.lit(1)).alias("n"))
    p = F.least(F.col("a") / F.col("n"), F.lit(1 - 1e-9))
    gain = F.col("n") * (p * F.log(p / base) + (1 - p) * F.log((1 - p) / (1 - base)))
    count = count.filter((F.col("a") >= MIN_SHARE * of["a"]) & (F.col("a") >= MIN_PRECISION * F.col("n")) & (gain >= MIN_GAIN))
    found = {r["term"]: r["a"] for r in count.select("term", "a").collect()}
    stem_of = lambda w: [w[:n] + "*" for n in STEM_LETTERS if len(w.rstrip("*")) > n]
    # a stem that is nearly always one word is that word
    single = {s for w, a in found.items() if w[-1] != "*" for s in stem_of(w) if a >= 0.8 * found.get(s, math.inf)}
    return sorted(t for t in found if t not in single and not any(s in found and s not in single for s in stem_of(t)))


def clean_words(train: DataFrame, entries: list[str]) -> frozenset[str]:
    """Words near an entry, but not it, that rows of train labelled clean use: all of them, from bounded rows."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(entries)
        for batch in some_rows(batches, 0):
            found = [w for t in batch.column(0).to_pylist() for w in set(WORD.findall(t.lower())) if 0 < lexicon.distance(w) < 9]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["w"])

    found = train.filter("toxic = 0").select("text").mapInArrow(near, "w string").distinct()
    return frozenset(r["w"] for r in found.collect())


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows: int = TRAIN_ROWS) -> DataFrame:
    """One row per row of docs: id, held_out, score, predicted, n_hits, n_quoted, n_misspelt.

    The lexicon and six weights are learnt from at most `rows` labelled rows that aren't held out; each whole text is
    then scored by them alone. Null texts are empty and score as texts without a hit; rows without labels are scored
    like others; without labels of both kinds the lexicon is empty, and all texts get the prior weights' score of one
    without a hit. Other columns are left out.
    """
    train = written(training_rows(docs, labels, id_col, text_col, label_col, rows), "train")
    entries = learn_lexicon(train)
    clean = clean_words(train, entries)
    entries = [e + "=" if e[-1] != "*" and any(map(lambda w, x=Lexicon([e]): x.distance(w) < 9, clean)) else e for e in entries]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(entries, clean)
        for batch in some_rows(batches, 1):
            found = [features(t or "", lexicon) for t in batch.column(1).to_pylist()]
            f = pa.array([x[0] for x in found], pa.list_(pa.float64()))
            n = [pa.array([x[i] for x in found], pa.int32()) for i in (1, 2, 3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), f, *n], ["k", "f", "n_hits", "n_quoted", "n_misspelt"])

    kind = "f array<double>, n_hits int, n_quoted int, n_misspelt int"
    rows_ = train.select("toxic", "text").mapInArrow(measure, f"k int, {kind}").select("k", "f").collect()  # at most `rows` short rows
    weights = fit(np.array([r["f"] for r in rows_]).reshape(-1, len(FEATURES)), np.array([float(r["k"] == 1) for r in rows_]))
    d = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_t"))
    out = d.mapInArrow(measure, f"k {d.schema['_id'].dataType.simpleString()}, {kind}")
    z = sum((F.col("f")[i] * float(w) for i, w in enumerate(weights)), F.lit(0.0))
    out = out.withColumn("score", 1 / (1 + F.exp(-z)))
    return out.select(
        F.col("k").alias(id_col), held_out(F.col("k")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_hits", "n_quoted", "n_misspelt"
    )
