"""External induced sorting: suffixes in order with their common-prefix values, over disk-backed queues.

The scheme is that of external suffix and LCP construction by inducing (Bingmann, Fischer and Osipov, 2013): suffixes that
are smaller than their successor but follow a larger one (S*) are sorted by the names of the substrings between them,
recursively while these are too many for memory; all others are induced from them, first the L, then the S suffixes, by a
priority queue whose key is the first symbol. Each entry carries the suffix and its common prefix with the entry before.
As a symbol's entries are pushed in their final order, and how many there will be is known, its part of the queue is a
stretch of an array that is filled from one end and read once. Every array that grows with the text is in memory within a
budget and mapped from an unlinked scratch file beyond it; what is worked on at a time is a part of bounded size.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np

#: Symbols: the end, a separator, then bytes.
END, SEPARATOR, FIRST_BYTE = 0, 1, 2
#: Bytes of work arrays for an entry: of a part that is pushed, of a name, of a suffix that is sorted in memory.
PER_ENTRY, PER_NAME, PER_SUFFIX = 256, 128, 96
#: Ranges that names too many for memory are parted into at a time.
RANGES = 64


class Scratch:
    """Files for one task's spill, in the folders that Spark gives its workers for just that; each is unlinked when
    opened, so that a killed worker leaves nothing behind. Nothing here is read by another task."""

    def __init__(self, memory: int):
        self.left = memory
        self.spilled = 0

    def file(self):
        folders = [d for d in os.environ.get("SPARK_LOCAL_DIRS", "").split(",") if d and os.path.isdir(d)]
        return tempfile.TemporaryFile(dir=folders[os.getpid() % len(folders)] if folders else None)

    def array(self, n: int, dtype) -> np.ndarray:
        """Zeros: in memory within the budget, else mapped from a file."""
        size = n * np.dtype(dtype).itemsize
        if size <= self.left or not n:
            self.left -= size
            return np.zeros(n, dtype)
        with self.file() as f:
            f.truncate(size)
            self.spilled += size
            return np.memmap(f, dtype, "r+", shape=(n,))


def parts(n: int, most: int) -> Iterator[tuple[int, int]]:
    for a in range(0, n, most):
        yield a, min(n, a + most)


def t_kind(n: int):
    return np.int32 if n < 1 << 31 else np.int64


def smaller_types(t: np.ndarray, scratch: Scratch, most: int) -> np.ndarray:
    """True where a suffix is smaller than its successor (S); t ends with the one END."""
    n = len(t)
    out = scratch.array(n, np.bool_)
    out[n - 1] = True
    for a, b in reversed(list(parts(n - 1, most))):
        x = np.asarray(t[a : b + 1])
        differs, at = x[:-1] != x[1:], np.arange(b - a)
        # a run takes the type of its end, which may be in the part after this
        end = np.minimum.accumulate(np.where(differs, at, b - a)[::-1])[::-1]
        up = np.append(x[:-1] < x[1:], out[b])
        out[a:b] = up[end]
    return out


def seed_places(small: np.ndarray, scratch: Scratch, most: int) -> np.ndarray:
    """The S* positions in order of the text; the end is one."""
    n = len(small)
    found = lambda a, b: np.flatnonzero(small[a + 1 : b + 1] & ~small[a:b]) + a + 1
    out = scratch.array(max(1, sum(len(found(a, b)) for a, b in parts(n - 1, most))), t_kind(n))
    k = 0
    for a, b in parts(n - 1, most):
        x = found(a, b)
        out[k : k + len(x)] = x
        k += len(x)
    if not k:
        out[0] = n - 1
    return out


def run_lengths(t: np.ndarray, at: np.ndarray, cap: int) -> np.ndarray:
    """How often the symbol at each position stands there in a row, up to cap."""
    out, live = np.ones(len(at), np.int64), np.arange(len(at))
    for k in range(1, cap):
        live = live[(at[live] + k < len(t))]
        live = live[t[at[live] + k] == t[at[live]]]
        if not len(live):
            break
        out[live] += 1
    return out


def _range_min(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Least x[lo..hi], both included."""
    width = hi - lo + 1
    level = np.frexp(width)[1] - 1
    out = np.empty(len(lo), x.dtype)
    table = x
    for k in range(int(level.max(initial=-1)) + 1):
        if k:
            half = 1 << (k - 1)
            table = np.minimum(table[:-half], table[half:])
        own = np.flatnonzero(level == k)
        if len(own):
            out[own] = np.minimum(table[lo[own]], table[hi[own] - (1 << k) + 1])
    return out


class _Substrings:
    """The substrings from each S* position to the next, both included, and their dense ranks. Only `depth` symbols of one
    are looked at: suffixes need no order beyond."""

    def __init__(self, t: np.ndarray, start: np.ndarray, depth: int, memory: int, scratch: Scratch, most: int):
        self.t, self.start, self.depth, self.memory, self.scratch, self.most = t, start, depth, memory, scratch, most
        top = max((int(t[a:b].max()) for a, b in parts(len(t), most)), default=0)
        # where one ends and an equal one goes on, the first has there an S suffix and the other an L: the end is larger
        self.bits = (top + 2).bit_length()
        self.ended, self.per = (1 << self.bits) - 1, 62 // self.bits
        self.names, self.count = scratch.array(len(start), t_kind(len(start))), 0

    def lengths(self, ids: np.ndarray) -> np.ndarray:
        after = np.asarray(self.start[np.minimum(ids + 1, len(self.start) - 1)], np.int64)
        return np.minimum(after - self.start[ids] + 1, self.depth)

    def keys(self, ids: np.ndarray, length: np.ndarray, done: int) -> np.ndarray:
        """The symbols from `done` on, as many as go into a number that sorts like them."""
        key, first = np.zeros(len(ids), np.int64), np.asarray(self.start[ids], np.int64) + done
        for k in range(self.per):
            at = np.minimum(first + k, len(self.t) - 1)
            key = (key << self.bits) | np.where(done + k < length, self.t[at].astype(np.int64), self.ended)
        return key

    def small(self, ids: np.ndarray, done: int) -> None:
        """Names substrings that are alike up to `done`, in memory."""
        length, rank, live = self.lengths(ids), np.zeros(len(ids), np.int64), np.arange(len(ids))
        while len(live):
            # substrings that are alike so far stand together; the longer ones among them are told apart next
            key = self.keys(ids[live], length[live], done)
            order = np.lexsort((key, rank[live]))
            r, k = rank[live][order], key[order]
            new = np.ones(len(order), bool)
            new[1:] = (r[1:] != r[:-1]) | (k[1:] != k[:-1])
            # a rank is the place of the first of those alike, so ranks split without moving others'
            first = np.flatnonzero(np.append(True, r[1:] != r[:-1]))
            inside = np.arange(len(r)) - np.repeat(first, np.diff(np.append(first, len(r))))
            rank[live[order]] = r + inside[np.flatnonzero(new)][np.cumsum(new) - 1]
            done += self.per
            live = live[length[live] >= done]
        ranks, dense = np.unique(rank, return_inverse=True)
        self.names[ids] = self.count + dense
        self.count += len(ranks)

    def name(self, ids: np.ndarray, done: int = 0) -> None:
        """Names substrings that are alike up to `done`: in memory, or parted by ranges of their next symbols, in order."""
        if len(ids) * PER_NAME <= self.memory or len(ids) <= 1024:
            self.small(np.asarray(ids, np.int64), done)
            return
        keys = lambda x: self.keys(x, self.lengths(x), done)
        step = max(1, len(ids) // (RANGES * 32))
        sample = np.sort(keys(np.asarray(ids[::step], np.int64)))
        cuts = np.unique(sample[len(sample) // (2 * RANGES) :: max(1, len(sample) // RANGES)])
        # a key that is a cut itself has a range of its own, so one key of most substrings parts from the rest
        place = lambda k: 2 * np.searchsorted(cuts, k, "left") + np.isin(k, cuts)
        size = np.zeros(2 * len(cuts) + 1, np.int64)
        for a, b in parts(len(ids), self.most):
            size += np.bincount(place(keys(np.asarray(ids[a:b], np.int64))), minlength=len(size))
        head, left = np.cumsum(size) - size, self.scratch.left
        dealt = self.scratch.array(len(ids), ids.dtype)
        at = head.copy()
        for a, b in parts(len(ids), self.most):
            x = np.asarray(ids[a:b], np.int64)
            to = place(keys(x))
            order = np.argsort(to, kind="stable")
            to = to[order]
            first = np.flatnonzero(np.append(True, to[1:] != to[:-1])) if len(to) else to
            count = np.diff(np.append(first, len(to)))
            dealt[np.repeat(at[to[first]], count) + np.arange(len(to)) - np.repeat(first, count)] = x[order]
            at[to[first]] += count
        for i, (h, n) in enumerate(zip(head.tolist(), size.tolist(), strict=True)):
            own = dealt[h : h + n]
            if n and i % 2 == 0:
                self.name(own, done)
            elif n and int(self.lengths(np.asarray(own[:1], np.int64))[0]) >= done + self.per:
                self.name(own, done + self.per)
            elif n:  # one key that has its end in it: one substring
                for a, b in parts(n, self.most):
                    self.names[own[a:b]] = self.count
                self.count += 1
        del dealt
        self.scratch.left = left


def sort_reduced(r: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of r by `depth` symbols at least, in memory: doubling over those still alike."""
    n = len(r)
    rank = np.unique(r, return_inverse=True)
    counts = np.bincount(rank[1], minlength=len(rank[0]))
    rank = (np.cumsum(counts) - counts)[rank[1]]  # the place of the first of those alike
    order = np.argsort(rank, kind="stable")
    h = 1
    same = rank[order]
    alike = np.zeros(n, bool)
    alike[1:] |= same[1:] == same[:-1]
    alike[:-1] |= same[1:] == same[:-1]
    while h < depth and alike.any():
        place = np.flatnonzero(alike)
        at = order[place]
        after = np.where(at + h < n, rank[np.minimum(at + h, n - 1)] + 1, 0)
        o = np.lexsort((after, rank[at]))
        at, after, own = at[o], after[o], rank[at][o]
        order[place] = at
        new = np.ones(len(at), bool)
        new[1:] = (own[1:] != own[:-1]) | (after[1:] != after[:-1])
        rank[at] = place[np.flatnonzero(new)][np.cumsum(new) - 1]
        keep = ~new
        keep[:-1] |= ~new[1:]
        alike[:] = False
        alike[place[keep]] = True
        h *= 2
    return order


def _common(t: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Common prefix of the suffixes at a and b, up to cap."""
    size, n = t.dtype.itemsize, len(t)
    step = 8 // size  # symbols that one look at memory compares
    look = np.ndarray((max(0, n - step + 1),), "<u8", t, strides=(size,))
    out, live, x, y = np.full(len(a), cap, np.int64), np.arange(len(a)), np.array(a, np.int64), np.array(b, np.int64)
    last = np.maximum(x, y)
    for k in range(0, cap, step):
        if len(live) and int(last.max()) > n - step - k:
            far = last > n - step - k
            for i in np.flatnonzero(far).tolist():  # within a look of the text's end
                p, q = int(x[i]) + k, int(y[i]) + k
                while max(p, q) < n and t[p] == t[q]:
                    p, q = p + 1, q + 1
                out[live[i]] = p - int(x[i])
            live, x, y, last = live[~far], x[~far], y[~far], last[~far]
        if not len(live):
            break
        other = look[x + k] ^ look[y + k]
        end = np.flatnonzero(other)
        if len(end):
            low = other[end]
            low &= ~low + np.uint64(1)
            out[live[end]] = k + np.bitwise_count(low - np.uint64(1)).astype(np.int64) // (8 * size)
            same = np.flatnonzero(other == 0)
            live, x, y, last = live[same], x[same], y[same], last[same]
    return np.minimum(out, cap)


def _seeds(t: np.ndarray, start: np.ndarray, cap: int, depth: int, memory: int, scratch: Scratch, most: int) -> tuple[np.ndarray, np.ndarray | None]:
    """The S* positions in the order of their suffixes, and each one's common prefix with the one before."""
    m, kind = len(start), t_kind(len(t))
    out, left = scratch.array(m, kind), scratch.left
    ids = scratch.array(m, t_kind(m))
    for a, b in parts(m, most):
        ids[a:b] = np.arange(a, b)
    sub = _Substrings(t, start, depth, memory, scratch, most)
    sub.name(ids)
    names, order = sub.names, ids
    if sub.count == m:
        for a, b in parts(m, most):
            order[names[a:b]] = np.arange(a, b)
    elif PER_SUFFIX * m <= memory:
        order = sort_reduced(np.asarray(names), depth)
    else:
        # too many for memory: the same scheme over the names; the end must be the one smallest symbol
        r = scratch.array(m + 1, t_kind(m + 2))
        for a, b in parts(m, most):
            r[a:b] = names[a:b] + 1
        del ids, sub, names
        order = suffix_order(r, 0, depth, memory, scratch, most)[0][1:]
    for a, b in parts(m, most):
        out[a:b] = start[order[a:b]]
    del order
    scratch.left = left
    if not cap:
        return out, None
    near = scratch.array(m, np.int16)
    for a, b in parts(m, most):
        a = max(1, a)
        near[a:b] = _common(t, out[a - 1 : b - 1], out[a:b], cap)
    return out, near


def _tally(symbols: Iterator[np.ndarray], k: int, scratch: Scratch) -> np.ndarray:
    out = scratch.array(k, np.int64)
    for x in symbols:
        of, n = np.unique(x, return_counts=True)
        out[of] += n
    return out


def _starts(counts: tuple[np.ndarray, ...], scratch: Scratch, most: int) -> np.ndarray:
    """Where each symbol's stretch begins, of the sums of counts."""
    out, before = scratch.array(len(counts[0]), np.int64), 0
    for a, b in parts(len(out), most):
        n = sum(c[a:b] for c in counts)
        out[a:b] = before + np.cumsum(n) - n
        before += int(n.sum())
    return out


class _Pusher:
    """What scanned suffixes induce, with common prefixes: one more than the least between the two that induce."""

    def __init__(self, t: np.ndarray, small: np.ndarray, cap: int, symbols: int):
        self.t, self.small, self.cap = t, small, cap
        self.least = np.zeros(symbols if cap else 0, np.int16)

    def __call__(self, at: np.ndarray, common: np.ndarray | None, small: bool) -> tuple[np.ndarray, ...]:
        """(symbols, suffixes, common prefixes, first of each symbol, how many): of one symbol in a row, in order."""
        some = np.flatnonzero(at > 0)
        before = at[some].astype(np.int64) - 1
        fits = self.small[before] == small
        some, before = some[fits], before[fits]
        to = self.t[before].astype(np.int64)
        order = np.argsort(to, kind="stable")
        some, before, to = some[order], before[order], to[order]
        first = np.flatnonzero(np.append(True, to[1:] != to[:-1])) if len(to) else to
        ends = np.append(first[1:], len(to)) if len(to) else to
        carried = None
        if self.cap:
            carried = np.zeros(len(to), np.int16)
            if len(to):
                lo = np.append(0, some[:-1] + 1)
                lo[first] = 0
                carried = _range_min(common, lo, some)
                carried[first] = np.minimum(carried[first], self.least[to[first]])
                carried = np.minimum(carried + 1, self.cap).astype(np.int16)
            np.minimum(self.least, common.min(), out=self.least)
            if len(to):
                tail = np.append(np.minimum.accumulate(common[::-1])[::-1], np.int16(self.cap))
                self.least[to[first]] = tail[some[ends - 1] + 1]
        return to, before, carried, first, ends - first


def suffix_order(t: np.ndarray, cap: int, depth: int, memory: int, scratch: Scratch, most: int) -> tuple[np.ndarray, np.ndarray | None]:
    """All suffixes in order, and each one's common prefix with the next, up to cap (None where cap is 0)."""
    n, kind = len(t), t_kind(len(t))
    small = smaller_types(t, scratch, most)
    start = seed_places(small, scratch, most)
    seeds, near = _seeds(t, start, cap, depth, memory, scratch, most)
    m, k = len(seeds), max(int(t[a:b].max()) for a, b in parts(n, most)) + 1
    large_n = _tally((t[a:b][~small[a:b]] for a, b in parts(n, most)), k, scratch)
    small_n = _tally((t[a:b][small[a:b]] for a, b in parts(n, most)), k, scratch)
    seed_n = _tally((t[seeds[a:b]] for a, b in parts(m, most)), k, scratch)

    # L suffixes: each symbol's stretch has its L suffixes, then its seeds, which are there from the first
    begin, first_seed = _starts((large_n, seed_n), scratch, most), _starts((seed_n,), scratch, most)
    size = int(begin[-1] + large_n[-1] + seed_n[-1])
    up, near_up = scratch.array(size, kind), scratch.array(size if cap else 0, np.int16)
    up[:] = -1
    for a, b in parts(m, most):
        c = t[seeds[a:b]]
        nth = np.arange(a, b) - first_seed[c]
        slot = begin[c] + large_n[c] + nth
        up[slot] = seeds[a:b]
        if cap:
            near_up[slot] = np.where(nth > 0, near[a:b], 0)
    del seeds, near, start
    head = scratch.array(k, np.int64)
    for a, b in parts(k, most):
        head[a:b] = begin[a:b]
    push, i, wide = _Pusher(t, small, cap, k), 0, 256
    while i < size:
        at = np.asarray(up[i : i + wide])
        gap = np.flatnonzero(at < 0)  # entries that are there are final
        at = at[: int(gap[0])] if len(gap) else at
        wide = min(most, 2 * wide) if not len(gap) else max(256, 2 * len(at))
        common = None
        if cap:
            common, c = near_up[i : i + len(at)].copy(), t[at]
            meet = np.flatnonzero((np.arange(i, i + len(at)) == begin[c] + large_n[c]) & (large_n[c] > 0))  # the first seed after L suffixes
            if len(meet):
                common[meet] = np.minimum(run_lengths(t, up[i + meet - 1].astype(np.int64), cap), run_lengths(t, at[meet].astype(np.int64), cap))
        to, before, carried, first, count = push(at, common, False)
        if len(to):
            slot = np.repeat(head[to[first]] - first, count) + np.arange(len(to))
            up[slot] = before
            if cap:
                near_up[slot] = np.where(slot == begin[to], 0, carried)
            head[to[first]] += count
        i += len(at)

    # S suffixes, from the largest: each symbol's stretch ends with them, and L suffixes come before
    whole = _starts((large_n, small_n), scratch, most)
    down, near_down = scratch.array(n, kind), scratch.array(n if cap else 0, np.int16)
    down[:] = -1
    for a, b in parts(size, most):
        at = up[a:b]
        c = t[at]
        nth = np.arange(a, b) - begin[c]
        own = nth < large_n[c]
        slot = (whole[c] + nth)[own]
        down[slot] = at[own]
        if cap:
            later = nth[own] > 0
            near_down[slot[later] - 1] = near_up[a:b][own][later]
    del up, near_up
    down[0] = n - 1
    for a, b in parts(k, most):
        head[a:b] = whole[a:b] + large_n[a:b] + small_n[a:b] - 1
    push, i, wide = _Pusher(t, small, cap, k), n, 256
    while i > 0:
        a = max(0, i - wide)
        at = np.asarray(down[a:i])
        gap = np.flatnonzero(at < 0)
        at = at[int(gap[-1]) + 1 :] if len(gap) else at
        wide = min(most, 2 * wide) if not len(gap) else max(256, 2 * len(at))
        a, common = i - len(at), None
        if cap:
            common, c = near_down[a:i].copy(), t[at]
            meet = np.flatnonzero((np.arange(a, i) == whole[c] + large_n[c] - 1) & (small_n[c] > 0))  # the last L before S suffixes
            if len(meet):
                common[meet] = np.minimum(run_lengths(t, at[meet].astype(np.int64), cap), run_lengths(t, down[a + meet + 1].astype(np.int64), cap))
                near_down[a + meet] = common[meet]
            common = common[::-1]
        to, before, carried, first, count = push(at[::-1], common, True)
        if len(to):
            slot = np.repeat(head[to[first]] + first, count) - np.arange(len(to))
            down[slot] = before
            if cap:
                near_down[slot] = np.where(slot == whole[to] + large_n[to] + small_n[to] - 1, 0, carried)
            head[to[first]] -= count
        i = a
    return down, near_down if cap else None


def sorted_suffixes(t: np.ndarray, cap: int, memory: int, scratch: Scratch | None = None, most: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Yields (common prefixes, suffixes) in the order of suffixes, as arrays; t ends with the one END.

    A common prefix is the one with the suffix before, up to `cap`. Suffixes are ordered by `cap` symbols at least; those
    alike beyond that may stand in any order. memory: bytes of arrays and work; beyond, arrays are in scratch files.
    """
    scratch = scratch or Scratch(memory)
    most = most or max(1024, min(1 << 20, memory // PER_ENTRY))
    order, near = suffix_order(t, cap, cap + 1, memory, scratch, most)
    for a, b in parts(len(t), most):
        yield np.append(near[a - 1] if a else np.int16(0), near[a : b - 1]), np.asarray(order[a:b])
