"""SimHash near duplicates: bit-sliced comparison of fingerprints that agree in bands, and connected components."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free, keyed, maybe_broadcast, some_rows, written
from .graph import components

SEED, SHINGLE, RADIUS = 42, 3, 2
#: Distinct fingerprints that one key may gather; the key's bits are extended beyond.
BUCKET = 4096
#: Rows of one comparison, at least, where keys are small.
BLOCK = 512
QUERIES_AT_ONCE, CELLS = 256, 1 << 20
#: Similar texts: words a shingle, the least Jaccard similarity, and the bits in which their fingerprints are let differ.
#: At a similarity of 0.8 fingerprints differ in 10 bits on average.
WORDS, SIMILAR, WIDE = 5, 0.8, 16
#: Keys of a fingerprint and bits of a key; keys, and further bits, that each hot key is replaced by.
KEYS, KEY_BITS, SUB_KEYS, SUB_BITS = 96, 12, 4, 6
#: Partners of a text that the first round compares in full; each round takes so many times more of those left.
PARTNERS, MORE = 2, 8
#: Minima of a sketch, four bits each, and how many are to agree before shingles are compared: of pairs of the least
#: similarity about 1 in 50,000 agree in fewer, of pairs that share nothing 1 in 2,000 in as many.
MINIMA, AGREE = 16, 6
SHINGLES_AT_ONCE = 1 << 16
#: Places a shingle in a crowd's bitmaps, at least; bits of a bitmap, at least and at most; bytes of bitmaps held against each
#: other at a time.
SPREAD, FEWEST_BITS, MOST_BITS, BITMAP_BYTES = 16, 64, 1 << 15, 4 << 20


def fingerprint(text: bytes | None, size: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit SimHash of UTF-8 bytes: A-Z lower-cased, words between white space, space-joined shingles with repeats;
    fewer words are one shingle, none give 0. A bit is 1 if it is set in over half the shingles' XXH64."""
    return fingerprint_of(shingles(text, size, seed))


def shingles(text: bytes | None, size: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of a text's shingles, in order and with repeats, as fingerprint() has them."""
    import xxhash

    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined, h = b" ".join(words), xxhash.xxh64_intdigest
    n = len(words) - size + 1
    if n <= 1:
        return np.array([h(joined, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts, ends = np.concatenate([[0], ends[: n - 1]]).tolist(), (ends[size - 1 :] - 1).tolist()
    return np.array([h(joined[s:e], seed) for s, e in zip(starts, ends, strict=True)], np.uint64)


def fingerprint_of(found: np.ndarray) -> int:
    n = len(found)
    if n <= 1:
        return int(found[0]) if n else 0
    hashes = found.view(np.uint8).reshape(-1, 8)
    total = np.zeros(64, np.int64)
    for at in range(0, n, SHINGLES_AT_ONCE):
        total += np.unpackbits(hashes[at : at + SHINGLES_AT_ONCE], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view(np.uint64)[0])


def planes_of(values: np.ndarray) -> np.ndarray:
    """The bit planes that differ among values: row p, bit i is that plane's bit of value i; padded to whole words."""
    bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    count = bits.sum(axis=1, dtype=np.int64)
    bits = bits[(count > 0) & (count < len(values))]
    packed = np.packbits(np.pad(bits, ((0, 0), (0, -len(values) % 64))), axis=1, bitorder="little")
    return np.ascontiguousarray(packed).view(np.uint64)


def near_rows(planes: np.ndarray, at: np.ndarray, n: int, radius: int) -> np.ndarray:
    """For the values numbered `at`: a bit row each, set where a value is within radius.

    Distances of all values are counted together, a plane at a time, in carry-save counters that start so that they
    overflow just beyond the radius. Queries whose every value has overflowed are abandoned.
    """
    words = planes.shape[1]
    valid = np.packbits(np.arange(words * 64) < n, bitorder="little").view(np.uint64)
    out = np.zeros((len(at), words), np.uint64)
    live = np.arange(len(at))
    width = (radius + 1).bit_length()
    begin = (1 << width) - (radius + 1)
    counter = [np.full((len(at), words), ~np.uint64(0) if begin >> k & 1 else np.uint64(0)) for k in range(width)]
    over = np.broadcast_to(~valid, (len(at), words)).copy()
    word, bit = at // 64, (at % 64).astype(np.uint64)
    for p, plane in enumerate(planes):
        own = np.uint64(0) - ((plane[word[live]] >> bit[live]) & np.uint64(1))
        carry = plane[None, :] ^ own[:, None]
        for k in range(width):
            carry, counter[k] = counter[k] & carry, counter[k] ^ carry
        over |= carry
        if p % 8 == 7:
            some = (over != ~np.uint64(0)).any(axis=1)
            some &= np.bitwise_count(~over).sum(axis=1) > 1  # a value is always near itself
            if not some.all():
                live, over, counter = live[some], over[some], [c[some] for c in counter]
            if not len(live):
                return out
    out[live] = ~over
    return out


def links(values: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Index pairs that join all values within radius of each other, directly or over others: at most len - 1."""
    n = len(values)
    planes = planes_of(values)
    if n < 2 or not len(planes):
        return [(0, i) for i in range(1, n)]
    parent, member, found = list(range(n)), {}, []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    def bits(i: int) -> np.ndarray:
        if i not in member:
            member[i] = np.zeros(planes.shape[1], np.uint64)
            member[i][i // 64] = np.uint64(1) << np.uint64(i % 64)
        return member[i]

    for start in range(0, n, QUERIES_AT_ONCE):
        at = np.arange(start, min(n, start + QUERIES_AT_ONCE))
        near = near_rows(planes, at, n, radius)
        for row in np.flatnonzero(np.bitwise_count(near).sum(axis=1) > 1).tolist():
            i = int(at[row])
            while True:
                own = bits(root(i))
                rest = near[row] & ~own
                where = np.flatnonzero(rest)
                if not len(where):
                    break
                w = int(where[0])
                j = w * 64 + (int(rest[w]) & -int(rest[w])).bit_length() - 1
                other = root(j)
                own |= bits(other)
                del member[other]
                parent[other] = root(i)
                found.append((i, j))
    return found


def band_keys(width: int, radius: int) -> list[list[tuple[int, int]]]:
    """Choices of bands of a `width`-bit value, of radius + 2 bands of which every near pair agrees in two at least: (first bit, bits) lists."""
    m = radius + 2
    edges = [width * i // m for i in range(m + 1)]
    return [[(edges[i], edges[i + 1] - edges[i]) for i in c] for c in combinations(range(m), m - radius)]


def _packed(column: str, bands: list[tuple[int, int]]):
    out, at = F.lit(0).cast("long"), 0
    for first, bits in bands:
        out = out.bitwiseOR(F.shiftleft(F.shiftrightunsigned(F.col(column), first).bitwiseAND(F.lit((1 << bits) - 1)), at))
        at += bits
    return out


def _rest(bands: list[tuple[int, int]], width: int = 64) -> list[int]:
    used = {b for first, n in bands for b in range(first, first + n)}
    return [b for b in range(width) if b not in used]


def _sub_keys(column: str, bands: list[tuple[int, int]], radius: int):
    """Keys over the bits that `bands` leave out, again by bands of them."""
    rest = _rest(bands)
    for choice in band_keys(len(rest), radius):
        out = F.lit(0).cast("long")
        at = 0
        for first, bits in choice:
            for b in rest[first : first + bits]:
                out = out.bitwiseOR(F.shiftleft(F.shiftrightunsigned(F.col(column), b).bitwiseAND(F.lit(1)), at))
                at += 1
        yield out


def _compare(radius: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by key; each key's values are compared at one place, small keys many together."""
        keys, values = np.empty((0, 2), np.int64), np.empty(0, np.uint64)
        for batch in batches:
            k = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)], axis=1)
            keys, values = np.concatenate([keys, k]), np.concatenate([values, batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)])
            first = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            whole = int(first[-1]) if len(first) else 0  # the last key may go on
            if whole:
                yield from _linked(values[:whole], np.concatenate([[0], first]), radius)
                keys, values = keys[whole:], values[whole:]
        if len(values):
            first = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            yield from _linked(values, np.concatenate([[0], first, [len(values)]]), radius)

    return compare


def _linked(values: np.ndarray, edges: np.ndarray, radius: int) -> Iterator[pa.RecordBatch]:
    sizes = np.diff(edges)
    shared = np.repeat(sizes > 1, sizes)
    values, sizes = values[shared], sizes[sizes > 1]
    ends, start, a, b = np.cumsum(sizes), 0, [], []
    for i, end in enumerate(ends.tolist()):
        if end - start >= BLOCK or i == len(ends) - 1:
            block = np.unique(values[start:end])
            for x, y in links(block, radius):
                a.append(block[x])
                b.append(block[y])
            start = end
    if a:
        yield pa.RecordBatch.from_arrays([pa.array(np.array(x, np.uint64).view(np.int64)) for x in (a, b)], ["a", "b"])


def near_links(values: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """(a, b) links that join all values (column fp, distinct longs) within radius bits, directly or over others.

    Two values within radius agree in two of radius + 2 bands at least: each choice of two bands is a key, and a key's
    values are compared bit-sliced where they meet. A key of more than `bucket` values is replaced by keys that also hold
    bands of its other bits, by the same rule, so that no near pair is lost and no task gathers more than the values
    that the bits left over can tell apart.
    """
    choices = band_keys(64, radius)
    each = values.select("fp", F.explode(F.array(*[F.struct(F.lit(i).cast("long").alias("c"), _packed("fp", x).alias("k")) for i, x in enumerate(choices)])).alias("x"))
    each = each.select(F.col("x.c").alias("c"), F.col("x.k").alias("k"), "fp")
    hot = written(each.groupBy("c", "k").count().filter(F.col("count") > bucket).select("c", "k"), "hot")
    run = lambda d: d.repartition("k", "c").sortWithinPartitions("k", "c").select("k", "c", "fp").mapInArrow(_compare(radius), "a bigint, b bigint")
    if hot.isEmpty():
        return run(each)
    subs = F.lit(None)
    for i, x in enumerate(choices):
        subs = F.when(F.col("c") == i, F.array(*[F.struct(F.lit(j).cast("long").alias("sc"), s.alias("sk")) for j, s in enumerate(_sub_keys("fp", x, radius))])).otherwise(subs)
    fine = each.join(maybe_broadcast(hot), ["c", "k"]).select("c", "k", "fp", F.explode(subs).alias("s"))
    # (c, k) and (sc, sk) as two longs: c and sc are under 256, k has 32 bits, sk 16
    fine = fine.select((F.col("k") * 256 + F.col("c")).alias("k"), (F.col("s.sk") * 256 + F.col("s.sc")).alias("c"), "fp")
    return run(each.join(maybe_broadcast(hot), ["c", "k"], "left_anti")).unionByName(run(fine))


def fingerprints(docs: DataFrame, text_col: str, size: int = SHINGLE) -> DataFrame:
    """docs without text_col, with fp: the fingerprint as a signed long. Null texts are empty ones."""
    rest = [c for c in docs.columns if c != text_col]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in some_rows(batches, 1):
            fp = np.array([fingerprint(t, size) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], ["k", "fp"])

    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("k"), F.col(f"`{text_col}`").cast("binary").alias("t"))
    kind = d.schema["k"].dataType.simpleString()
    return d.mapInArrow(work, f"k {kind}, fp bigint").select(*[F.col(f"k.`{c}`").alias(c) for c in rest], "fp")


def _rows(docs: DataFrame, id_col: str, text_col: str, key: str | None) -> DataFrame:
    """_id, _rid and the text of docs: by the stored column `key`, else by a key that is written here."""
    if key is None:
        return keyed(docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_t")), "_id", "_t")
    return docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_t"), F.col(f"`{key}`").alias("_rid"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row per row of docs: id, fingerprint (16 hex digits), component_id, keeper.

    component_id is the smallest id reachable over links of at most `radius` differing bits, itself included; null ids
    count for nothing, and a component of none but null ids has null. keeper marks one row of each component: the
    smallest id's, among repeated rows the first. Null texts are empty; texts without words have fingerprint zero and
    link like any other. Other columns of docs are left out.
    """
    # texts are read once, so the key is made as the fingerprints are written
    d = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_t"), F.monotonically_increasing_id().alias("_rid"))
    d = written(fingerprints(d, "_t"), "fingerprints")
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("_id"), "_rid"))
    values = written(d.groupBy("fp").agg(first.alias("first")), "values")
    root = components(near_links(values.select("fp"), radius))
    whole = values.join(root, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))
    whole = written(whole.select("fp", "root", "first"), "roots")
    best = whole.groupBy("root").agg(F.min("first").alias("best"))
    named = written(whole.join(best, "root").select(F.col("fp").alias("_fp"), F.col("best._id").alias("component_id"), F.col("best._rid").alias("_best")), "named")
    out = d.join(maybe_broadcast(named), F.col("fp") == F.col("_fp"))
    return out.select(F.col("_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", (F.col("_rid") == F.col("_best")).alias("keeper"), "_rid")


def agreements(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Minima in which packed sketches agree."""
    d = x ^ y
    d |= d >> np.uint64(1)
    d |= d >> np.uint64(2)
    return MINIMA - np.bitwise_count(d & np.uint64(0x1111111111111111)).astype(np.int64)


def bitmap(found: np.ndarray) -> bytes:
    """A set's bitmap: a bit for each place that a shingle has, which is its lowest bits."""
    size = FEWEST_BITS
    while size < min(MOST_BITS, SPREAD * len(found)):
        size *= 2
    out = np.zeros(size, np.uint8)
    out[(found & np.uint64(size - 1)).astype(np.int64)] = 1
    return np.packbits(out, bitorder="little").tobytes()


class Bitmaps:
    """Of rows: how many shingles each has, and its bitmap. Two rows' bitmaps bound from above how many shingles they share:
    by the places set in both, and the shingles of one of them that share a place with another of its own. Bitmaps of
    unlike sizes are held against each other folded to the smaller one."""

    def __init__(self, n: np.ndarray, maps: list[bytes]):
        self.n, self.words = n, np.array([len(x) // 8 for x in maps])
        self.maps, self.folded = maps, {}

    def of_size(self, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows' places among the bitmaps of so many words or twice as many, these bitmaps, and shingles beyond places."""
        if words not in self.folded:
            own = np.flatnonzero((self.words == words) | (self.words == 2 * words))
            place = np.full(len(self.n), -1)
            place[own] = np.arange(len(own))
            maps = np.zeros((len(own), words), np.uint64)
            for i, r in enumerate(own.tolist()):
                maps[i] = np.bitwise_or.reduce(np.frombuffer(self.maps[r], np.uint64).reshape(-1, words), axis=0)
            self.folded[words] = place, maps, self.n[own] - np.bitwise_count(maps).sum(axis=1, dtype=np.int64)
        return self.folded[words]

    def may_be_similar(self, i: np.ndarray, j: np.ndarray, least: float) -> np.ndarray:
        """Whether rows i and j can have a Jaccard similarity of `least`: True wherever they have."""
        out = np.minimum(self.n[i], self.n[j]) >= least * np.maximum(self.n[i], self.n[j])
        words = np.minimum(self.words[i], self.words[j])
        unlike = np.maximum(self.words[i], self.words[j]) > 2 * words  # none, where at least half of the larger set is shared
        for size in np.unique(words[out & ~unlike]).tolist():
            place, maps, beyond = self.of_size(size)
            pairs, step = np.flatnonzero(out & ~unlike & (words == size)), max(1, BITMAP_BYTES // (8 * size))
            for at in range(0, len(pairs), step):
                own = pairs[at : at + step]
                x, y = place[i[own]], place[j[own]]
                both = np.bitwise_count(maps[x] & maps[y]).sum(axis=1, dtype=np.int64) + np.minimum(beyond[x], beyond[y])
                out[own] = both >= least * (self.n[i[own]] + self.n[j[own]] - both)
        return out


def near_pairs(fp: np.ndarray, sketch: np.ndarray, root: np.ndarray, asks: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (j, i), j < i, of each asking row i and the rows within radius, of agreeing sketches and of another root."""
    at = np.flatnonzero(asks)
    step = max(1, min(QUERIES_AT_ONCE, CELLS // len(fp)))
    for start in range(0, len(at), step):
        own = at[start : start + step]
        upto = int(own[-1])
        near = np.bitwise_count(fp[own, None] ^ fp[None, :upto]) <= radius
        near &= root[own, None] != root[None, :upto]
        i, j = np.nonzero(near)
        i = own[i]
        good = (j < i) & (agreements(sketch[i], sketch[j]) >= AGREE)
        yield j[good], i[good]


def partners(fp: np.ndarray, node: np.ndarray, sketch: np.ndarray, root: np.ndarray, asks: np.ndarray, radius: int, most: int, least: float = 0.0, maps: Bitmaps | None = None, keys: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(smaller, larger) nodes, of rows sorted by node: the first `most` of each asking row's near_pairs(), of those that
    bitmaps, where there are any, let be similar. keys: all rows of these keys are here, and the rest is elsewhere; pairs
    whose first shared key is none of them are left out."""
    a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for j, i in near_pairs(fp, sketch, root, asks, radius):
        if maps is not None:
            good = maps.may_be_similar(i, j, least)
            j, i = j[good], i[good]
        if keys is not None:
            own = first_keys(fp[i], fp[j])
            good = (own < 0) | np.isin(own, keys)
            j, i = j[good], i[good]
        first = np.flatnonzero(np.append(True, i[1:] != i[:-1])) if len(i) else i
        rank = np.arange(len(i)) - np.repeat(first, np.diff(np.append(first, len(i))))
        a.append(node[j[rank < most]])
        b.append(node[i[rank < most]])
    return np.concatenate(a), np.concatenate(b)


def _by_key(work):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by key, their first column; work gets the batches of whole keys, small ones together."""
        kept: list[pa.RecordBatch] = []
        rows, last = 0, None
        for batch in batches:
            k = batch.column(0).to_numpy()
            while len(k):
                # up to the end of a key beyond BLOCK rows
                cut = len(k)
                if rows + len(k) >= BLOCK:
                    ends = np.append(0 if last is not None and last != k[0] else -1, np.flatnonzero(k[1:] != k[:-1]) + 1)
                    ends = ends[(ends >= 0) & (rows + ends >= BLOCK)]
                    if len(ends):
                        cut = int(ends[0])
                        kept.append(batch.slice(0, cut))
                        yield from work([x for x in kept if len(x)])
                        kept, rows, last, batch, k = [], 0, None, batch.slice(cut), k[cut:]
                        continue
                kept.append(batch)
                rows, last, k = rows + len(k), k[-1], k[:0]
        yield from work([x for x in kept if len(x)])

    return run


def _propose(radius: int, most: int, least: float = 0.0, once: bool = False):
    def propose(kept: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows: key, fp, node, sketch, and beyond the first round root, asks, n and bitmap. Keys are compared together, so a
        pair may share none. once: no key is hot, and a pair comes from the first that it shares."""
        if not kept:
            return
        fp, node, sketch, *more = (np.concatenate([x.column(i).to_numpy(zero_copy_only=False) for x in kept]) for i in range(1, kept[0].num_columns))
        node, at = np.unique(node, return_index=True)
        root, asks, *more = (x[at] for x in more) if more else (node, np.ones(len(node), bool))
        maps = Bitmaps(more[0], more[1].tolist()) if more and asks.any() else None
        keys = np.unique(np.concatenate([x.column(0).to_numpy() for x in kept])) if once else None
        a, b = partners(fp[at].view(np.uint64), node, sketch[at].view(np.uint64), root, asks, radius, most, least, maps, keys)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["na", "nb"])

    return _by_key(propose)


def _others(radius: int):
    def others(kept: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows: key, fp, node, sketch, root, asks. The nodes that don't ask but are before an asking one, as partners are."""
        if not kept:
            return
        fp, node, sketch, root, asks = (np.concatenate([x.column(i).to_numpy(zero_copy_only=False) for x in kept]) for i in range(1, 6))
        node, at = np.unique(node, return_index=True)
        root, asks = root[at], asks[at]
        if not asks.any():
            return
        found = [j[~asks[j]] for j, _ in near_pairs(fp[at].view(np.uint64), sketch[at].view(np.uint64), root, asks, radius)]
        found = np.unique(np.concatenate(found))
        if len(found):
            yield pa.RecordBatch.from_arrays([pa.array(node[found])], ["node"])

    return _by_key(others)


def _bits(values: np.ndarray, places) -> np.ndarray:
    out = np.zeros(len(values), np.int64)
    for at, p in enumerate(places):
        out |= ((values >> np.uint64(p)) & np.uint64(1)).astype(np.int64) << at
    return out


@cache
def _key_places() -> tuple[list[np.ndarray], list[list[np.ndarray]]]:
    """The places of each key's bits, and of each of its sub-keys' further bits: fixed random choices."""
    rng = np.random.default_rng(SEED)
    orders = [rng.permutation(64) for _ in range(KEYS)]
    subs = [[o[KEY_BITS + i * SUB_BITS : KEY_BITS + (i + 1) * SUB_BITS] for i in range(SUB_KEYS)] for o in orders]
    return [o[:KEY_BITS] for o in orders], subs


def first_keys(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The first key that fingerprints share, -1 where they share none."""
    out, differ, left = np.full(len(x), -1), x ^ y, np.arange(len(x))
    for c, p in enumerate(_key_places()[0]):
        if not len(left):
            break
        same = differ[left] & np.bitwise_or.reduce(np.uint64(1) << p.astype(np.uint64)) == 0
        own = left[same]
        out[own], left = _bits(x[own], p) | c << KEY_BITS, left[~same]
    return out


def _wide_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    places, _ = _key_places()
    for batch in batches:
        fp = batch.column(0).to_numpy().view(np.uint64)
        for c, p in enumerate(places):
            yield pa.RecordBatch.from_arrays([pa.array(_bits(fp, p) | c << KEY_BITS), *batch.columns], ["k", *batch.schema.names])


def _wide_sub_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    _, subs = _key_places()
    for batch in batches:
        k = batch.column(0).to_numpy()
        for c in np.unique(k >> KEY_BITS).tolist():
            own = batch.filter(pa.array(k >> KEY_BITS == c))
            key, fp = own.column(0).to_numpy(), own.column(1).to_numpy().view(np.uint64)
            for i, p in enumerate(subs[c]):
                fine = ((key * SUB_KEYS + i) << SUB_BITS) | _bits(fp, p)
                yield pa.RecordBatch.from_arrays([pa.array(fine), *own.columns[1:]], batch.schema.names)


def hot_keys(values: DataFrame, bucket: int) -> DataFrame:
    """The keys (k) of wide_partners() that more than `bucket` values share."""
    each = values.select("fp").mapInArrow(_wide_keys, "k bigint, fp bigint")
    return written(each.groupBy("k").count().filter(F.col("count") > bucket).select("k"), "hot")


def _where_keys_meet(values: DataFrame, hot: DataFrame, work, kind: str) -> DataFrame:
    """work of the values by their keys, of columns `kind`. A hot key is replaced by SUB_KEYS keys of SUB_BITS further bits."""
    keyed_kind = "k bigint, " + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in values.schema)
    run = lambda d: d.repartition("k").sortWithinPartitions("k").mapInArrow(work, kind)
    each = values.mapInArrow(_wide_keys, keyed_kind)
    if hot.isEmpty():
        return run(each)
    fine = each.join(maybe_broadcast(hot), "k").select("k", *values.columns).mapInArrow(_wide_sub_keys, keyed_kind)
    return run(each.join(maybe_broadcast(hot), "k", "left_anti").select("k", *values.columns)).unionByName(run(fine))


def wide_partners(values: DataFrame, hot: DataFrame, most: int, radius: int = WIDE, least: float = SIMILAR) -> DataFrame:
    """(nb, p, more): of each node of values that has any, the `most` smallest of its smaller partners, and whether there
    are more. Partners' fingerprints are within radius and share a key (KEYS choices of KEY_BITS bits), their sketches
    agree.

    values: fp, node, sketch, and beyond the first round root, asks, n and bitmap: roots of partners differ, their bitmaps
    don't rule out a similarity of `least`, and only nodes that ask get any. A pair 10 bits apart shares no key with a
    chance of under 1 in 10,000, one 14 apart of 1 in 40.
    """
    pairs = _where_keys_meet(values, hot, _propose(radius, most + 1, least, "asks" in values.columns and hot.isEmpty()), "na bigint, nb bigint")
    found = pairs.distinct().groupBy("nb").agg(F.sort_array(F.collect_list("na")).alias("p"))
    return found.select("nb", F.slice("p", 1, most).alias("p"), (F.size("p") > most).alias("more"))


def crowd_of(rows: DataFrame, nodes: DataFrame, values: DataFrame, hot: DataFrame, size: int, radius: int = WIDE) -> DataFrame:
    """fp, node, sketch, n, bitmap of the nodes of values (fp, node, sketch, root, asks) that ask and of those that are partners
    of such; rows: _rid and _t, nodes: node and first."""
    other = _where_keys_meet(values, hot, _others(radius), "node bigint")
    names = written(values.filter("asks").select("node").unionByName(other).distinct().withColumnRenamed("node", "n2"), "crowd")
    own = nodes.join(maybe_broadcast(names), F.col("node") == F.col("n2")).select("node", "fp", "sketch", F.col("first._rid").alias("_r"))
    own = written(own, "own")
    texts = rows.join(maybe_broadcast(own), F.col("_rid") == F.col("_r")).select(F.struct("fp", "node", "sketch").alias("k"), F.col("_t").cast("binary").alias("t"))
    out = texts.mapInArrow(_bitmaps(size), f"k {texts.schema['k'].dataType.simpleString()}, n bigint, bitmap binary")
    out = written(out.select("k.*", "n", "bitmap"), "bitmaps")
    free(names, own)
    return out


def _measures(size: int):
    odd = np.random.default_rng(SEED).integers(0, 2**63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def measures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in some_rows(batches, 1):
            fp, node, sketch = [], [], []
            for text in batch.column(1).to_pylist():
                found = shingles(text, size)
                own = np.unique(found)
                least = [int((own * m).min()) & 15 for m in odd] if len(own) else []
                fp.append(fingerprint_of(found))
                node.append(xxhash.xxh3_64_intdigest(own.tobytes()))
                sketch.append(sum(x << 4 * i for i, x in enumerate(least)))
            longs = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (fp, node, sketch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *longs], ["k", "fp", "node", "sketch"])

    return measures


def _sets(size: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in some_rows(batches, 1):
            found = [np.unique(shingles(t, size)).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["node", "s"])

    return sets


def _bitmaps(size: int):
    def bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in some_rows(batches, 1):
            sets = [np.unique(shingles(t, size)) for t in batch.column(1).to_pylist()]
            columns = [pa.array([len(x) for x in sets], pa.int64()), pa.array([bitmap(x) for x in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["k", "n", "bitmap"])

    return bitmaps


def _alike(least: float):
    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= least * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return alike


def _similar(rows: DataFrame, nodes: DataFrame, pairs: DataFrame, size: int, least: float) -> DataFrame:
    """Those of pairs (na, nb) whose shingles are similar, compared in full; rows: _rid and _t, nodes: node and first."""
    wanted = pairs.select(F.explode(F.array("na", "nb")).alias("node")).distinct().join(nodes, "node").select("node", F.col("first._rid").alias("_r"))
    wanted = written(wanted, "wanted")
    texts = rows.join(maybe_broadcast(wanted), F.col("_rid") == F.col("_r")).select("node", F.col("_t").cast("binary").alias("t"))
    sets = written(texts.mapInArrow(_sets(size), "node bigint, s binary"), "shingles")
    full = pairs.join(sets.withColumnsRenamed({"node": "na", "s": "sa"}), "na").join(sets.withColumnsRenamed({"node": "nb", "s": "sb"}), "nb")
    alike = written(full.select("na", "nb", "sa", "sb").mapInArrow(_alike(least), "na bigint, nb bigint"), "alike")
    free(wanted, sets)
    return alike


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WORDS, least: float = SIMILAR, bucket: int = BUCKET, key: str | None = None) -> DataFrame:
    """One row per row of docs: id, component_id, keeper, _rid, as near_duplicates() has them, where a link is a Jaccard
    similarity of at least `least` between two texts' sets of `size`-word shingles.

    Fingerprints propose the pairs (wide_partners), sketches drop nearly all that chance brought together, and the shingles
    of the rest are compared in full. A text in a crowd gets a few partners at first; while some text has more, roots are
    found and more of those with other roots are compared, until each proposed pair is of one root, ruled out or compared.
    From the second round on, bitmaps of the crowds' shingles rule out pairs that share too few, where the keys meet; they
    never rule out a similar pair. So a crowd takes about as many comparisons as it has links to be found, and none that
    could link is left out. Texts of equal sets are one node. key: a
    stored column of docs that tells rows apart, else one is written.
    """
    rows = _rows(docs, id_col, text_col, key)
    d = rows.select(F.struct("_id", "_rid").alias("k"), F.col("_t").cast("binary").alias("t"))
    d = d.mapInArrow(_measures(size), f"k {d.schema['k'].dataType.simpleString()}, fp bigint, node bigint, sketch bigint")
    d = written(d.select("k._id", "k._rid", "fp", "node", "sketch"), "measures")
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("_id"), "_rid"))
    nodes = written(d.groupBy("node").agg(first.alias("first"), F.min("fp").alias("fp"), F.min("sketch").alias("sketch")), "nodes")
    values, most, alike, compared, crowd = nodes.select("fp", "node", "sketch"), PARTNERS, None, None, None
    hot = hot_keys(values, bucket)
    while True:
        found = written(wide_partners(values, hot, most, least=least), "partners")
        pairs = found.select(F.explode("p").alias("na"), "nb")
        if compared is not None:
            pairs = pairs.join(compared, ["na", "nb"], "left_anti")
        pairs = written(pairs, "pairs")
        new = _similar(rows, nodes, pairs, size, least)
        alike, compared = (new, pairs) if alike is None else (alike.unionByName(new), compared.unionByName(pairs))
        root = components(alike, "na", "nb").withColumnRenamed("node", "n1")
        asks = found.filter("more").select(F.col("nb").alias("n2"), F.lit(True).alias("asks"))
        if asks.isEmpty():
            break

        def rooted(d: DataFrame, *more: str, root: DataFrame = root, asks: DataFrame = asks) -> DataFrame:
            d = d.join(maybe_broadcast(root), F.col("node") == F.col("n1"), "left").join(asks, F.col("node") == F.col("n2"), "left")
            return written(d.select("fp", "node", "sketch", F.coalesce("root", "node").alias("root"), F.coalesce("asks", F.lit(False)).alias("asks"), *more), "values")

        if crowd is None:
            crowd = crowd_of(rows, nodes, rooted(values), hot, size)
            hot = hot_keys(crowd, bucket)
        else:
            most *= MORE
        values = rooted(crowd, "n", "bitmap")
    free(compared)
    whole = written(nodes.join(root, F.col("node") == F.col("n1"), "left").select("node", F.coalesce("root", "node").alias("root"), "first"), "roots")
    best = whole.groupBy("root").agg(F.min("first").alias("best"))
    named = written(whole.join(best, "root").select(F.col("node").alias("_n"), F.col("best._id").alias("component_id"), F.col("best._rid").alias("_best")), "named")
    free(nodes, alike, whole)
    out = d.join(maybe_broadcast(named), F.col("node") == F.col("_n"))
    return out.select(F.col("_id").alias(id_col), "component_id", (F.col("_rid") == F.col("_best")).alias("keeper"), "_rid")
