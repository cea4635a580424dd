"""Exact substring deduplication by suffix order: long strings of bytes, or of words, that start in more than one place.

Shards are made so that equal strings meet. Each window of so many symbols is owned by the smallest hash of a shorter string
inside it (an anchor), so equal windows are owned by equal anchors at the same place. The windows that follow each other
under one anchor are a piece. Anchors that occur once own no repeated window. Of the others, each different piece goes
once, with its count, to the shard of its anchor's hash. There what pieces share under longer anchors too is sorted, by
external induced sorting, which finds the windows that other pieces have too; the verdict returns to all places of the piece. The pieces of a crowded anchor are parted again, by
anchors of longer strings, until no anchor is crowded: at last an anchor is a whole window, of which there is one kind.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free, keyed, maybe_broadcast, release, some_rows, written
from .induced_sort import END, FIRST_BYTE, SEPARATOR, Scratch, sorted_suffixes

LENGTH, GRAM = 400, 128
#: A passage of over 50 words, and the words of its anchors.
PASSAGE_WORDS, GRAM_WORDS = 51, 16
#: Symbols that anchors are sought in at a time; longer texts in overlapping parts.
PART = 1 << 16
#: Bytes of pieces that are sorted at a time; one anchor's pieces are never parted.
SHARD = 4 << 20
#: Different pieces that one anchor may gather; those of others are parted again, by anchors of longer strings.
HOT = 256
#: Bytes of memory for a sort's arrays and queues; beyond, they go to scratch files.
MEMORY = 96 << 20


@dataclass(frozen=True)
class Unit:
    """What windows are counted in (bytes, or words between white space), a window's symbols and an anchor's, and whether
    a window is only repeated where another row has it (else: anywhere else, the same row included)."""

    words: bool = False
    length: int = LENGTH
    gram: int = GRAM
    across: bool = False

    @property
    def size(self) -> int:
        """Bytes a symbol."""
        return 8 if self.words else 1

    def symbols(self, texts: list[bytes]) -> list[np.ndarray]:
        """Each text's bytes, or its words' hashes."""
        if not self.words:
            return [np.frombuffer(t, np.uint8) for t in texts]
        whole = b" ".join(texts)
        places = word_places(whole)
        ends = np.cumsum([len(t) + 1 for t in texts])
        return np.split(word_hashes(whole, places), np.searchsorted(places[:, 0], ends[:-1]))

    def finer(self, gram: int) -> int:
        """The next longer anchor; the last is a whole window."""
        return self.length - (self.length - gram) // 2


BYTES, PASSAGES = Unit(), Unit(True, PASSAGE_WORDS, GRAM_WORDS, True)


def word_places(text: bytes) -> np.ndarray:
    """[start, end) of a text's words."""
    inside = np.zeros(len(text) + 2, np.bool_)
    inside[1:-1] = _LETTER[np.frombuffer(text, np.uint8)]
    return np.flatnonzero(inside[1:] != inside[:-1]).reshape(-1, 2)


def word_hashes(text: bytes, places: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each of a text's words, which stand at places: a polynomial in an odd number over random values of its bytes, mixed. Sums over parts of
    a text give all its words' at once; a word longer than a part is summed part by part."""
    start, end = places[:, 0], places[:, 1]
    h, x, i = np.zeros(len(start), np.uint64), np.frombuffer(text, np.uint8), 0
    while i < len(start):
        first = int(start[i])
        k = int(np.searchsorted(end, first + WORDS_PART, "right"))
        if k > i:
            total = np.zeros(int(end[k - 1]) - first + 1, np.uint64)
            np.cumsum(_VALUE[x[first : int(end[k - 1])]] * _POWER[: len(total) - 1], out=total[1:])
            h[i:k] = (total[end[i:k] - first] - total[start[i:k] - first]) * _INVERSE[start[i:k] - first]
            i = k
            continue
        for a in range(first, int(end[i]), WORDS_PART):
            part = _VALUE[x[a : min(int(end[i]), a + WORDS_PART)]]
            h[i : i + 1] += (part * _POWER[: len(part)]).sum(dtype=np.uint64, keepdims=True) * np.uint64(pow(_BASE, a - first, 1 << 64))
        i += 1
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = base
    return np.multiply.accumulate(out)


WORDS_PART, _BASE = 1 << 16, 0x9E3779B97F4A7C15
_LETTER = np.array([not (b == 32 or 9 <= b <= 13) for b in range(256)])
_VALUE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWER, _INVERSE = _powers(_BASE, WORDS_PART), _powers(pow(_BASE, -1, 1 << 64), WORDS_PART)


def gram_hashes(x: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each string of `size` symbols, by doubling; the last step may overlap."""
    h = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    width, odd = 1, 0xC2B2AE3D27D4EB4F
    while width < size:
        step = min(width, size - width)
        h = (h[:-step] * np.uint64(odd)) + h[step:]
        h ^= h >> np.uint64(29)
        odd = odd * 0x9E3779B97F4A7C15 % (1 << 64) | 1
        width += step
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def leftmost_minima(h: np.ndarray, width: int) -> np.ndarray:
    """For each run of `width` values the place of its least, by 44 leading bits; the leftmost of equals."""
    n = len(h) - width + 1
    key = (h & ~np.uint64((1 << 20) - 1)) | np.arange(len(h), dtype=np.uint64)
    rows = np.pad(key, (0, -len(key) % width), constant_values=~np.uint64(0)).reshape(-1, width)
    head = np.minimum.accumulate(rows, axis=1).ravel()
    tail = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(tail[:n], head[width - 1 : width - 1 + n]) & np.uint64((1 << 20) - 1)).astype(np.int64)


def pieces(texts: Iterator[np.ndarray] | list[np.ndarray], length: int = LENGTH, gram: int = GRAM, part: int = PART) -> Iterator[tuple[np.ndarray, ...]]:
    """(text number, first window, windows, anchor hash, piece hash) arrays of the pieces of texts, given as arrays of
    symbols; texts of under `length` symbols have none."""
    import xxhash

    h64 = xxhash.xxh3_64_intdigest
    todo: list[tuple[int, int, np.ndarray]] = []
    size = 0

    def flush() -> tuple[np.ndarray, ...]:
        data = np.concatenate([x for *_, x in todo])
        ends = np.cumsum([len(x) for *_, x in todo])
        starts = ends - [len(x) for *_, x in todo]
        h = gram_hashes(data, gram)
        own = leftmost_minima(h, length - gram + 1)
        # windows that begin in one text and end in another are none
        fits, edge = np.ones(len(own), np.bool_), np.ones(len(own) + 1, np.bool_)
        np.not_equal(own[1:], own[:-1], out=edge[1:-1])
        for end in ends[:-1].tolist():
            fits[max(0, end - length + 1) : end] = False
            edge[min(end, len(own))] = edge[max(0, min(end - length + 1, len(own)))] = True
        s = np.flatnonzero(edge)
        count, s = np.diff(s), s[:-1]
        whole = fits[s]
        count, s = count[whole], s[whole]
        k = np.searchsorted(ends, s, "right")
        raw, w = memoryview(data.tobytes()), data.itemsize
        hashes = [h64(raw[a:b]) for a, b in zip((w * s).tolist(), (w * (s + count + length - 1)).tolist(), strict=True)]
        number, offset = np.array([x for x, *_ in todo])[k], np.array([x for _, x, _ in todo])[k]
        return number, s - starts[k] + offset, count, h[own[s]].view(np.int64), np.array(hashes, np.uint64).view(np.int64)

    for i, text in enumerate(texts):
        for start in range(0, max(0, len(text) - length + 1), part):
            x = text[start : start + part + length - 1]
            if size + len(x) > part + length and todo:
                yield flush()
                todo, size = [], 0
            todo.append((i, start, x))
            size += len(x)
    if todo:
        yield flush()


def _find(units: tuple[Unit, ...]):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in some_rows(batches, 1):
            rid, texts = batch.column(0).to_numpy(), [x or b"" for x in batch.column(1).to_pylist()]
            for u, unit in enumerate(units):
                # texts of fewer bytes than a window's symbols and what is between them have no window
                symbols = unit.symbols([t if len(t) >= unit.length * (1 + unit.words) - unit.words else b"" for t in texts])
                for number, start, count, anchor, piece in pieces(symbols, unit.length, unit.gram):
                    cols = (np.full(len(number), u, np.int32), rid[number], start, count.astype(np.int32), anchor, piece)
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], ["unit", "_rid", "start", "n", "anchor", "piece"])

    return find


def _codes(texts: list[np.ndarray]) -> tuple[list[np.ndarray], int]:
    """Symbols as numbers of few values, and how many of these make a symbol. Bytes are themselves; a hash is its rank among
    all, as two digits of different ranges, so that no string that starts at a second digit equals one at a first."""
    if not texts or texts[0].itemsize == 1:
        return texts, 1
    rank = np.unique(np.concatenate(texts), return_inverse=True)[1]
    base = int(np.sqrt(rank.max(initial=0))) + 1
    digits = np.stack([rank // base, base + rank % base], axis=1).astype(np.int32)
    return [x.ravel() for x in np.split(digits, np.cumsum([len(x) for x in texts])[:-1])], 2


def repeated_windows(texts: list[np.ndarray], length: int = LENGTH, memory: int = MEMORY, rows: tuple[np.ndarray, np.ndarray] | None = None) -> list[np.ndarray]:
    """For each text, an array of symbols, True at window starts whose `length` symbols start elsewhere in these texts too.
    With rows, the least and the largest row that has each text: only where the rows that have a window are more than one."""
    coded, per = _codes(texts)
    width = length * per
    sizes = np.array([len(x) + 1 for x in coded], np.int64)
    n = int(sizes.sum()) + 1
    scratch = Scratch(memory)
    top = max((int(x.max(initial=0)) for x in coded), default=0) + FIRST_BYTE
    t = scratch.array(n, np.uint8 if top < 256 else np.uint16 if top < 65536 else np.uint32)
    ends = np.cumsum(sizes)
    for x, end in zip(coded, ends.tolist(), strict=True):
        t[end - 1 - len(x) : end - 1] = x
        t[end - 1 - len(x) : end - 1] += FIRST_BYTE
        t[end - 1] = SEPARATOR
    t[n - 1] = END
    hit = scratch.array(n, np.bool_)
    if rows is None:
        last = -1
        for common, at in sorted_suffixes(t, width, memory // 2, scratch):
            far = np.flatnonzero(common >= width)
            hit[at[far]] = True
            hit[at[far[far > 0] - 1]] = True
            if len(far) and far[0] == 0:
                hit[last] = True
            last = int(at[-1])
    else:
        _across(t, width, memory, scratch, ends, rows, hit)
    # a common prefix that reaches a separator is none: windows end within their text
    return [np.array(hit[end - 1 - len(x) : max(end - 1 - len(x), end - width) : per]) for x, end in zip(coded, ends.tolist(), strict=True)]


def _across(t: np.ndarray, width: int, memory: int, scratch: Scratch, ends: np.ndarray, rows: tuple[np.ndarray, np.ndarray], hit: np.ndarray) -> None:
    """Sets hit where suffixes of one group, alike in `width` symbols, stand in texts of more than one row."""
    group, low, high = scratch.array(len(t), np.int32), [], []
    lo, hi = (np.append(x, x[-1:]) for x in rows)  # the end symbol belongs to no text
    groups = 0
    for common, at in sorted_suffixes(t, width, memory // 2, scratch):
        new = common < width
        first = np.flatnonzero(new)
        item = np.searchsorted(ends, at, "right")
        group[at] = groups - 1 + np.cumsum(new)
        if not new[0]:  # the group before goes on
            a, b = item[: first[0] if len(first) else len(item)], groups - 1
            low[-1][-1], high[-1][-1] = min(low[-1][-1], lo[a].min()), max(high[-1][-1], hi[a].max())
        if len(first):
            low.append(np.minimum.reduceat(lo[item], first))
            high.append(np.maximum.reduceat(hi[item], first))
        groups += len(first)
    if groups:
        several = np.concatenate(low) < np.concatenate(high)
        for a in range(0, len(t), 1 << 20):
            hit[a : a + (1 << 20)] = several[group[a : a + (1 << 20)]]


def repeated_in_pieces(texts: list[np.ndarray], unit: Unit, anchor: np.ndarray, copies: np.ndarray, low: np.ndarray, high: np.ndarray, memory: int = MEMORY) -> list[np.ndarray]:
    """For each piece, all different, True at its windows that are repeated, in other pieces or by its copies (of rows low
    to high). Equal windows have equal longer anchors too: what pieces have under one that no other has is not sorted, and
    of equal parts, which are repeated by their count alone, one is sorted, where other parts have their anchor too."""
    masks = [np.zeros(max(0, len(x) - unit.length + 1), np.bool_) for x in texts]
    found = list(pieces(texts, unit.length, unit.finer(unit.finer(unit.gram))))
    if not found:
        return masks
    number, start, count, fine, own = (np.concatenate(x) for x in zip(*found, strict=True))
    shard = _within(anchor[number], fine)
    order = np.lexsort((own, shard))
    number, start, count, shard, own = (x[order] for x in (number, start, count, shard, own))
    first = np.flatnonzero(np.append(True, (shard[1:] != shard[:-1]) | (own[1:] != own[:-1])))
    kind = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(shard))))
    low, high = np.minimum.reduceat(low[number], first), np.maximum.reduceat(high[number], first)
    sure = low < high if unit.across else np.add.reduceat(copies[number], first) > 1
    of = np.append(True, shard[first][1:] != shard[first][:-1])
    lead, of = np.flatnonzero(of), np.cumsum(of) - 1
    several = (np.diff(np.append(lead, len(first))) > 1) & (~np.bool_(unit.across) | (np.minimum.reduceat(low, lead) < np.maximum.reduceat(high, lead)))
    some = np.flatnonzero(several[of])
    # parts that follow each other in a piece, of the same rows, are one text to sort
    some = some[np.lexsort((start[first[some]], number[first[some]]))]
    i, a, n = (x[first[some]] for x in (number, start, count))
    new = np.append(True, (i[1:] != i[:-1]) | (a[1:] != a[:-1] + n[:-1]))[: len(some)]
    if unit.across:
        new[1:] |= (low[some][1:] != low[some][:-1]) | (high[some][1:] != high[some][:-1])
    hits: list = [None] * len(first)
    if len(some):
        head = np.flatnonzero(new)
        size = np.add.reduceat(n, head)
        parts = [texts[x][y : y + z + unit.length - 1] for x, y, z in zip(i[head].tolist(), a[head].tolist(), size.tolist(), strict=True)]
        hit = np.concatenate(repeated_windows(parts, unit.length, memory, (low[some[head]], high[some[head]]) if unit.across else None))
        for k, x in zip(some.tolist(), np.split(hit, np.cumsum(n)[:-1]), strict=True):
            hits[k] = x
    for k in np.flatnonzero(sure).tolist():
        hits[k] = True
    for i, a, n, k in zip(number.tolist(), start.tolist(), count.tolist(), kind.tolist(), strict=True):
        if hits[k] is not None:
            masks[i][a : a + n] = hits[k]
    return masks


def _within(anchor: np.ndarray, fine: np.ndarray) -> np.ndarray:
    """The hash of a longer anchor within one."""
    return (anchor.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ fine.view(np.uint64)).view(np.int64)


def _runs(mask: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return [{"a": a, "b": b} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)]


_PIECE = "unit int, anchor bigint, piece bigint, copies bigint, low bigint, high bigint, crowded boolean, bytes binary"
_VERDICT = "unit int, anchor bigint, piece bigint, runs array<struct<a: int, b: int>>"


def _sort(units: tuple[Unit, ...], shard: int, memory: int):
    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))

    def verdicts(rows: list) -> pa.RecordBatch:
        unit = units[rows[0][0]]
        texts = [np.frombuffer(r[7], np.uint64 if unit.words else np.uint8) for r in rows]
        anchor, copies, low, high = (np.array([r[i] for r in rows], np.int64) for i in (1, 3, 4, 5))
        runs = [_runs(m) for m in repeated_in_pieces(texts, unit, anchor, copies, low, high, memory)]
        cols = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.int64()))]
        return pa.RecordBatch.from_arrays([*cols, pa.array(runs, kind)], ["unit", "anchor", "piece", "runs"])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if rows and (row[0] != rows[-1][0] or size >= shard and row[1] != rows[-1][1]):
                    yield verdicts(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[7])
        if rows:
            yield verdicts(rows)
        release()

    return sort


def _cut(units: tuple[Unit, ...]):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces' symbols, from texts and their lists of pieces."""
        kinds, names = (pa.int32(), *[pa.int64()] * 5, pa.bool_(), pa.binary()), ["unit", "anchor", "piece", "copies", "low", "high", "crowded"]
        for batch in some_rows(batches, 0, 1 << 20):
            out: list = []
            for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = {u: units[u].symbols([text])[0].tobytes() for u in {w["unit"] for w in wanted}}
                for w in wanted:
                    size = units[w["unit"]].size
                    out.append((*(w[c] for c in names), raw[w["unit"]][size * w["start"] : size * (w["start"] + w["size"])]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], [*names, "bytes"])

    return cut


def _finer(units: tuple[Unit, ...], grams: list[int]):
    def finer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces of crowded anchors as smaller ones under longer anchors, each with the piece that it is in and where."""
        names = ["unit", "shard", "own", "copies", "low", "high", "anchor", "piece", "at", "n"]
        for batch in batches:
            own_unit, anchor, piece, copies, low, high = (batch.column(i).to_numpy() for i in range(6))
            for u in np.unique(own_unit).tolist():
                unit, rows = units[u], np.flatnonzero(own_unit == u)
                texts = (np.frombuffer(batch.column(7)[i].as_py(), np.uint64 if unit.words else np.uint8) for i in rows.tolist())
                for number, start, count, fine, own in pieces(texts, unit.length, grams[u]):
                    k = rows[number]
                    cols = (own_unit[k], _within(anchor[k], fine), own, copies[k], low[k], high[k], anchor[k], piece[k], start.astype(np.int32), count.astype(np.int32))
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], names)

    return finer


def _shared(kinds: DataFrame, units: tuple[Unit, ...], hot: int) -> DataFrame:
    """(unit, anchor, crowded, alone) of the anchors of kinds (unit, anchor, copies, low, high) that may own a repeated
    window; alone: there is one kind, and so each of its windows is repeated."""
    of = kinds.groupBy("unit", "anchor").agg(F.sum("copies").alias("c"), F.min("low").alias("l"), F.max("high").alias("h"), F.count(F.lit(1)).alias("k"))
    across = F.array(*[F.lit(u.across) for u in units])[F.col("unit")]
    return of.filter((F.col("c") > 1) & (~across | (F.col("l") < F.col("h")))).select("unit", "anchor", (F.col("k") > hot).alias("crowded"), (F.col("k") == 1).alias("alone"))


def _sure(one: DataFrame) -> DataFrame:
    """Verdicts on kinds that are alone under their anchors (n: windows)."""
    return one.filter("alone").select("unit", "anchor", "piece", F.array(F.struct(F.lit(0).alias("a"), F.col("n").alias("b"))).alias("runs"))


def _verdicts(cut: DataFrame, any_hot: bool, units: tuple[Unit, ...], sort, hot: int, grams: list[int]) -> DataFrame:
    """Verdicts on pieces (_PIECE). Equal windows have equal longer anchors too, so parts of the pieces of a crowded
    anchor meet by both; equal parts are counted before they are sorted, and a verdict returns to all of them."""
    sorted_ = lambda d: d.repartition("unit", "anchor").sortWithinPartitions("unit", "anchor").mapInArrow(sort, _VERDICT).filter("size(runs) > 0")
    if not any_hot:
        return sorted_(cut)
    found, crowded = sorted_(cut.filter("not crowded")), cut.filter("crowded")
    grams = [u.finer(g) for u, g in zip(units, grams, strict=True)]
    parts = written(crowded.mapInArrow(_finer(units, grams), "unit int, shard bigint, own bigint, copies bigint, low bigint, high bigint, anchor bigint, piece bigint, at int, n int"), "parts")
    first = F.min(F.struct("anchor", "piece", "at")).alias("first")
    kinds = parts.groupBy("unit", "shard", "own").agg(F.sum("copies").alias("copies"), F.min("low").alias("low"), F.max("high").alias("high"), first, F.min("n").alias("n"))
    kinds = written(kinds.withColumnsRenamed({"shard": "anchor", "own": "piece"}), "kinds")
    of = crowded.select(F.col("unit").alias("u"), F.col("anchor").alias("a"), F.col("piece").alias("p"), "bytes")
    shared = written(kinds.join(_shared(kinds, units, hot), ["unit", "anchor"]), "shared")
    one = shared.filter("not alone").join(of, (F.col("unit") == F.col("u")) & (F.col("first.anchor") == F.col("a")) & (F.col("first.piece") == F.col("p")))
    size, length = (F.array(*[F.lit(x) for x in xs])[F.col("unit")] for xs in ([u.size for u in units], [u.length for u in units]))
    part = F.substring("bytes", size * F.col("first.at") + 1, size * (F.col("n") + length - 1))
    finer = written(one.select("unit", "anchor", "piece", "copies", "low", "high", "crowded", part.alias("bytes")), "finer")
    fine = _verdicts(finer, not finer.filter("crowded").isEmpty(), units, sort, hot, grams).unionByName(_sure(shared))
    fine = written(fine, "fine").withColumnsRenamed({"anchor": "shard", "piece": "own"})
    back = parts.select("unit", "shard", "own", "anchor", "piece", "at").join(fine, ["unit", "shard", "own"])
    free(kinds, finer, shared)
    return found.unionByName(back.select("unit", "anchor", "piece", F.expr("transform(runs, r -> struct(r.a + at as a, r.b + at as b))").alias("runs")))


def repeated_spans(docs: DataFrame, text_col: str, units: tuple[Unit, ...] = (BYTES,), key: str = "_rid", shard: int = SHARD, memory: int = MEMORY, hot: int = HOT) -> DataFrame:
    """(key, runs): of the rows of docs (key and text_col) with repeated windows, runs [a, b) of their starts, one list a
    unit. docs is read twice, so its keys must be stored with it (see common.keyed)."""
    text = docs.select(F.col(f"`{key}`").alias("_rid"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    least = min(u.length * (1 + u.words) - u.words for u in units)
    places = text.filter(F.octet_length("text") >= least).mapInArrow(_find(units), "unit int, _rid bigint, start bigint, n int, anchor bigint, piece bigint")
    places = written(places, "places")
    # copies of a piece are counted before they are dealt out, so no count of them loads a task; any place of the least row does
    kinds = places.groupBy("unit", "anchor", "piece").agg(
        F.count(F.lit(1)).alias("copies"), F.min("_rid").alias("low"), F.max("_rid").alias("high"), F.min_by("start", "_rid").alias("start"), F.min("n").alias("n")
    )
    kinds = written(kinds, "pieces")
    length = F.array(*[F.lit(u.length) for u in units])[F.col("unit")]
    one = kinds.join(_shared(kinds, units, hot), ["unit", "anchor"])
    one = one.select("unit", "anchor", "piece", "copies", "low", "high", "crowded", "alone", F.col("low").alias("_rid"), "start", "n", (F.col("n") + length - 1).alias("size"))
    one = written(one, "one")
    # a text's own pieces: never more than its symbols
    wanted = one.filter("not alone").groupBy("_rid").agg(F.collect_list(F.struct("unit", "anchor", "piece", "copies", "low", "high", "crowded", "start", "size")).alias("wanted"))
    cut = text.join(wanted, "_rid").select("text", "wanted").mapInArrow(_cut(units), _PIECE)
    any_hot, read = not one.filter("crowded").isEmpty(), [kinds, one]
    if any_hot:
        cut = written(cut, "cut")  # read twice
        read.append(cut)
    found = _verdicts(cut, any_hot, units, _sort(units, shard, memory), hot, [u.gram for u in units]).unionByName(_sure(one))
    found = written(found, "verdicts")
    free(*read)
    spans = places.join(found, ["unit", "anchor", "piece"]).select("unit", "_rid", F.expr("transform(runs, r -> struct(start + r.a as a, start + r.b as b))").alias("runs"))
    of_unit = [F.flatten(F.collect_list(F.when(F.col("unit") == i, F.col("runs")))) for i in range(len(units))]
    spans = written(spans.groupBy("_rid").agg(F.array(*of_unit).alias("runs")), "spans")
    free(places, found)
    return spans.withColumnRenamed("_rid", key)


def cover(runs: list[dict], length: int) -> np.ndarray:
    """The maximal spans [start, end) under windows that start in runs."""
    x = np.array(sorted((r["a"], r["b"] + length - 1) for r in runs), np.int64).reshape(-1, 2)
    if not len(x):
        return x
    reach = np.maximum.accumulate(x[:, 1])
    first = np.flatnonzero(np.append(True, x[1:, 0] > reach[:-1]))
    return np.stack([x[first, 0], reach[np.append(first[1:], len(x)) - 1]], axis=1)


def byte_spans(text: bytes, runs: list[list[dict]], units: tuple[Unit, ...]) -> np.ndarray:
    """The maximal byte spans of a text under repeated windows of any unit: of words, from the first one to the last."""
    found = []
    for unit, own in zip(units, runs, strict=True):
        spans = cover(own or [], unit.length)
        if unit.words and len(spans):
            places = word_places(text)
            spans = np.stack([places[spans[:, 0], 0], places[spans[:, 1] - 1, 1]], axis=1)
        found += [{"a": a, "b": b} for a, b in spans.tolist()]
    return cover(found, 1)


def without(text: bytes, spans: np.ndarray) -> list[bytes]:
    """What is left of a text, in order."""
    kept, at = [], 0
    for a, b in spans.tolist():
        kept.append(text[at:a])
        at = b
    return [*kept, text[at:]]


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, passage: int = PASSAGE_WORDS, keep_text: bool = False, **params) -> DataFrame:
    """One row per row of docs: id, n_bytes, n_removed, n_spans, kept_sha256, n_passage_words, _rid; with keep_text also
    kept (binary).

    Every byte under a string of `length` bytes that starts anywhere else in docs, the same row included, is removed;
    strings are judged on the input. n_passage_words counts the words under runs of `passage` words that another row has
    too: such a passage can have fewer bytes than `length`, and then nothing of it is removed. A null text is empty.
    Repeated rows are copies of each other. A text shorter than `length` keeps all. Other columns are left out.
    """
    units = (Unit(False, length, min(GRAM, (length + 1) // 2)), Unit(True, passage, min(GRAM_WORDS, (passage + 1) // 2), True))
    d = docs.select(F.col(f"`{id_col}`").alias("_id"), F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b"")).alias("_t"))
    d = keyed(d, "_id", "_t")
    spans = repeated_spans(d, "_t", units, **params).withColumnRenamed("_rid", "_r")
    j = d.join(maybe_broadcast(spans), F.col("_rid") == F.col("_r"), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.binary())
        for batch in some_rows(batches, 1):
            rows = []
            for text, runs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                own, words = runs or ([], [])
                spans = byte_spans(text, [own], units[:1])
                kept = b"".join(without(text, spans))
                under = cover(words or [], passage)
                rows.append((len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), int((under[:, 1] - under[:, 0]).sum()), kept if keep_text else None))
            cols = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 6, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], ["k", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passage_words", "kept"])

    j = j.select(F.struct("_id", "_rid").alias("k"), "_t", "runs")
    out = j.mapInArrow(cut, f"k {j.schema['k'].dataType.simpleString()}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, n_passage_words bigint, kept binary")
    return out.select(F.col("k._id").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passage_words", F.col("k._rid").alias("_rid"), *["kept"] * keep_text)
