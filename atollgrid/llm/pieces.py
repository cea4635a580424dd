"""SentencePiece encoding, decoding, and sampling of segmentations without replacement by perturbed A-star search.

A text is cut into units, runs of the space mark with what follows them: no piece of the vocabulary reaches over a unit's
end (checked when the model is read), so encodings and lattices of units can be made once a batch and joined.

Sampling: a segmentation's chance is proportional to exp((sum of piece scores - cost * pieces) / temperature). Gumbel
top-k is found by search over sets of segmentations. The best of all is a plain sample; what is left is parted by the
first unit in which a segmentation differs from it, each part's best perturbed value is drawn from a Gumbel cut off at its
parent's, and the part with the best is opened next. Random numbers are hashes of the row's key, the sample and the place.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import math
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, some_rows
from .token_counts import _on_this_machine

MARK = "▁"
SAMPLES, COST, TEMPERATURE = 2, 1.0, 1.0
MEMO_UNITS, OFTEN = 320_000, 2
#: Bytes of texts that are sampled from together.
BATCH_BYTES = 1 << 20
#: Units whose lattices are built at a time.
ADD_UNITS = 4_096
#: Units that the library encodes as one text.
JOINED = 64
NONE = -math.inf
#: More than the logs of two exponential variables drawn from uniform() can differ by (they are from -37 to 4).
SPREAD = 42.0
#: From this chance on, what is left of a unit is summed up instead of taken from 1.
SURE = 1 - 1e-6


def mixed(*parts) -> np.ndarray:
    """Uniform 64-bit hashes of integers, by position."""
    h = np.uint64(0x243F6A8885A308D3)
    with np.errstate(over="ignore"):
        for x in parts:
            h = (h ^ np.asarray(x).astype(np.uint64)) * np.uint64(0xFF51AFD7ED558CCD)
            h = (h ^ (h >> np.uint64(32))) * np.uint64(0xC4CEB9FE1A85EC53)
            h = h ^ (h >> np.uint64(29))
    return h


def uniform(*parts) -> np.ndarray:
    """In (0, 1)."""
    return _unit(mixed(*parts))


def _unit(h: np.ndarray) -> np.ndarray:
    return (np.right_shift(h, np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


GOLDEN, STEP = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
LOW = (1 << 64) - 1


def stream(base: np.ndarray, step: int) -> np.ndarray:
    """The step-th uniform of the streams of base hashes."""
    h = (base ^ (base >> np.uint64(32))) + np.uint64(GOLDEN * (step + 1) & LOW)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(STEP)
    return _unit(h ^ (h >> np.uint64(32)))


def stream1(base: int, step: int) -> float:
    """stream() of one base."""
    h = ((base ^ (base >> 32)) + GOLDEN * (step + 1)) & LOW
    h = ((h ^ (h >> 32)) * STEP) & LOW
    return (((h ^ (h >> 32)) >> 11) + 0.5) / (1 << 53)


class Model:
    """A model's encoder, its decoder, and its vocabulary as a trie that many places of a text are looked up in at once."""

    def __init__(self, path: str):
        import sentencepiece

        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.lib.get_piece_size()
        self.text: list[bytes] = []
        self.bytes_id = [0] * 256
        words: list[tuple[str, int]] = []
        for i in range(size):
            piece = self.lib.id_to_piece(i)
            if self.lib.is_byte(i):
                self.bytes_id[int(piece[3:5], 16)] = i
                self.text.append(bytes([int(piece[3:5], 16)]))
            elif self.lib.is_control(i) or self.lib.is_unknown(i) or self.lib.is_unused(i):
                self.text.append(b"")
            else:
                if not re.fullmatch(f"{MARK}*[^{MARK}]*", piece):
                    raise ValueError(f"a piece reaches over a unit's end: {piece}")
                self.text.append(piece.encode())
                words.append((piece, i))
        self.mark = self.lib.piece_to_id(MARK)
        self.leads = np.array([x.startswith(MARK.encode()) for x in self.text])
        self.bytes_of = pa.array(self.text, pa.large_binary())
        # a BPE model's scores are its merges' ranks, negated: a rank's log chance is taken from Zipf's law
        score = np.array([self.lib.get_score(i) for i in range(size)])
        self.score = -np.log1p(-score) if (score <= 0).all() and (score == np.floor(score)).all() else score
        self._trie(words)

    def _trie(self, words: list[tuple[str, int]]) -> None:
        chars = sorted({ord(c) for w, _ in words for c in w})
        self.number = np.zeros(0x110000, np.int64)  # of a character; 0: in no piece
        self.number[chars] = np.arange(1, len(chars) + 1)
        self.many = len(chars) + 1
        number = self.number[np.frombuffer("".join(w for w, _ in words).encode("utf-32-le"), np.uint32)]
        size = np.fromiter((len(w) for w, _ in words), np.int64, len(words))
        start, node, nodes, depth = np.cumsum(size) - size, np.zeros(len(words), np.int64), 1, 0
        live, found, own = np.arange(len(words)), [], np.zeros(len(words), np.int64)
        while len(live):  # a depth of the trie at a time
            key, of = np.unique(node * self.many + number[start[live] + depth], return_inverse=True)
            found.append(key)
            node, nodes, depth = nodes + of, nodes + len(key), depth + 1
            more = size[live] > depth
            own[live[~more]] = node[~more]
            live, node = live[more], node[more]
        self.piece = np.full(nodes, -1)
        self.piece[own] = [i for _, i in words]
        children = np.concatenate(found)  # their nodes count up from 1
        self.root = np.full(self.many, -1)
        self.root[found[0]] = 1 + np.arange(len(found[0]))
        bits = max(4, (2 * len(children)).bit_length())
        self.shift, self.size = np.uint64(64 - bits), 1 << bits
        self.keys, self.values = np.full(self.size, -1, np.int64), np.zeros(self.size, np.int64)
        keys, values = children, 1 + np.arange(len(children))
        slot = self._slot(keys)
        while len(keys):  # each round, one of the keys that want a free slot gets it
            free = self.keys[slot] < 0
            self.keys[slot[free]], self.values[slot[free]] = keys[free], values[free]
            out = self.keys[slot] != keys
            keys, values, slot = keys[out], values[out], (slot[out] + 1) % self.size
        # keys and values were set by the same last writer only where one key wrote; set values again by key
        self.values[self._find(children)] = 1 + np.arange(len(children))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Slots of keys, -1 where there is none."""
        slot = self._slot(keys)
        there = self.keys.take(slot)
        out = np.where(there == keys, slot, -1)
        live = np.flatnonzero((there != keys) & (there >= 0))
        slot[live] = (slot[live] + 1) % self.size
        while len(live):
            at = slot[live]
            there = self.keys[at]
            hit = there == keys[live]
            out[live[hit]] = at[hit]
            live = live[~hit & (there >= 0)]
            slot[live] = (slot[live] + 1) % self.size
        return out

    @staticmethod
    def units(text: str) -> list[str]:
        """A text's units without their first mark, in order; joined by spaces they are the text."""
        if not text:
            return []
        found = text.replace(MARK, " ").split(" ")
        if "" not in found:
            return found
        out, spaces = [], ""  # empty strings between spaces: each is a mark more before the next unit
        for x in found:
            if x:
                out.append(spaces + x)
                spaces = ""
            else:
                spaces += " "
        return [*out, spaces[:-1]] if spaces else out

    def units_of(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The units of texts without nulls on end, and how many each has."""
        found = pc.split_pattern(pc.replace_substring(texts, MARK, " "), " ")
        flat, size = found.flatten(), pc.list_value_length(found).to_numpy()
        if pc.any(pc.equal(pc.binary_length(flat), 0)).as_py():  # texts without units, and spaces on end
            lists = [self.units(t) for t in texts.to_pylist()]
            flat, size = pa.array(chain.from_iterable(lists), pa.string()), np.fromiter(map(len, lists), np.int64, len(lists))
        return flat, size

    def encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The library's ids of units on end, and how many each has."""
        joined = [" ".join(units[i : i + JOINED]) for i in range(0, len(units), JOINED)]
        if not any("  " in x or x.strip(" ") != x or not x for x in joined):  # each unit has one mark, its first
            ids = np.fromiter(chain.from_iterable(self.lib.encode(joined, num_threads=1)), np.int32)
            return ids, np.diff(np.append(np.flatnonzero(self.leads[ids]), len(ids)))
        ids = [x or [self.mark] for x in self.lib.encode(units, num_threads=1)]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.int32, int(size.sum())), size

    def encode(self, text: str) -> list[int]:
        return self.encode_units(self.units(text))[0].tolist()

    def decode(self, ids) -> str:
        """The text of ids: the space mark is a space, the first one is the encoder's own and goes; broken bytes are
        replaced."""
        return self.decode_all(np.asarray(ids, np.int32), np.array([0, len(ids)]))[0]

    def decode_all(self, ids: np.ndarray, bound: np.ndarray) -> list[str]:
        """decode() of each stretch of ids between two bounds."""
        out = [str(x, "utf-8", "replace").replace(MARK, " ") for x in self._bytes(ids, bound)]
        return [x[1:] if x.startswith(" ") else x for x in out]

    def decode_to(self, ids: np.ndarray, bound: np.ndarray, texts: list[str]) -> list[bool]:
        """Whether decode_all() gives these texts; one with a space mark, which decodes to a space, never comes out."""
        want = [None if MARK in t else (MARK + t.replace(" ", MARK)).encode() if t else b"" for t in texts]
        return [bytes(x) == w for x, w in zip(self._bytes(ids, bound), want, strict=True)]

    def _bytes(self, ids: np.ndarray, bound: np.ndarray) -> Iterator[memoryview]:
        taken = self.bytes_of.take(pa.array(ids, pa.int32()))
        at = np.frombuffer(taken.buffers()[1], np.int64)[: len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
        data, cut = memoryview(taken.buffers()[2] or b""), at[bound].tolist()
        return (data[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True))

    def lattice(self, units: list[str], cost: float, temperature: float) -> Lattice:
        out = Lattice(self, cost, temperature)
        out.add(units)
        return out


class Lattice:
    """Of many units at once. Places are their characters; an edge is a piece from one place to another, or the byte
    pieces of a character that is no piece."""

    PARTS = {"first": np.int32, "end": np.int32, "lead": np.int32, "to": np.int32, "piece": np.int32, "count": np.int8, "logp": np.float32, "upto": np.float32}
    #: Of each unit: its main path's log chance, chance, pieces and signature, where its ids begin in `main_ids`, and, where
    #: the main path is nearly certain and that was asked for, the log chance of all others (else 1).
    MAIN = {"main_logp": np.float64, "main_chance": np.float32, "main_pieces": np.int32, "main_sign": np.uint64, "main_at": np.int64, "sure": np.float64}

    def __init__(self, model: Model, cost: float, temperature: float):
        self.model, self.cost, self.temperature = model, cost, temperature
        self.weight = (model.score - cost) / temperature
        self.room: dict[str, np.ndarray] = {}  # arrays with room at their ends, so that few additions copy what is there
        for name, kind in {**self.PARTS, **self.MAIN, "main_ids": np.int32}.items():
            self._append(name, np.zeros(int(name == "lead"), kind), 0)

    def _append(self, name: str, x: np.ndarray, used: int) -> None:
        room, size = self.room.get(name), used + len(x)
        if room is None or len(room) < size:
            self.room[name] = np.empty(size + size // 4, x.dtype)
            if used:
                self.room[name][:used] = room[:used]
        self.room[name][used:size] = x
        setattr(self, name, self.room[name][:size])

    def add(self, units: list[str]) -> None:
        """Appends units, as Model.units() gives them; the work arrays are those of ADD_UNITS."""
        places, edges = len(self.lead) - 1, int(self.lead[-1])
        for i in range(0, len(units), ADD_UNITS):
            part = self._built(units[i : i + ADD_UNITS])
            for name, x in part.items():
                self._append(name, x + x.dtype.type(places if name in ("first", "end", "to") else edges if name == "lead" else 0), len(getattr(self, name)))
            places, edges = places + len(part["lead"]), edges + len(part["to"])
            self._add_main()

    def _add_main(self) -> None:
        """Finds the main paths, by each place's likeliest edge, of units that have none yet."""
        old = len(self.sure)
        at, end = self.first[old:], self.end[old:]
        chance, live, taken = np.ones(len(at), np.float32), np.arange(len(at)), []
        while len(live):
            edge = self.lead.take(at)
            chance[live] *= np.minimum(self.upto.take(edge), np.float32(1))
            taken.append((live, edge))
            at = self.to.take(edge)
            more = np.flatnonzero(at < end)
            live, at, end = live[more], at[more], end[more]
        logp, pieces, sign, edges = self._summed(len(chance), taken)
        new = {"main_logp": logp, "main_chance": chance, "main_pieces": pieces, "main_sign": sign, "main_at": len(self.main_ids) + np.cumsum(pieces) - pieces, "sure": np.ones(len(chance))}
        for name, kind in self.MAIN.items():
            self._append(name, new[name].astype(kind), old)
        self._append("main_ids", self.ids_of(edges).astype(np.int32), len(self.main_ids))

    def keep(self, units: np.ndarray) -> None:
        """Leaves these units alone, numbered anew in their order."""
        pieces = self.main_pieces[units].astype(np.int64)
        at = np.cumsum(pieces) - pieces
        main = {name: getattr(self, name)[units] for name in self.MAIN} | {"main_at": at}
        main["main_ids"] = self.main_ids[np.repeat(self.main_at[units] - at, pieces) + np.arange(int(pieces.sum()))]
        for name, x in main.items():
            self._append(name, x, 0)
        begin, size = self.first[units].astype(np.int64), (self.end[units] - self.first[units]).astype(np.int64)
        first = np.cumsum(size) - size
        places = np.repeat(begin - first, size) + np.arange(int(size.sum()))
        degree = np.diff(self.lead)[places]
        lead = np.append(0, np.cumsum(degree))
        edges = np.repeat(self.lead[places] - lead[:-1], degree) + np.arange(int(lead[-1]))
        to = self.to[edges] - np.repeat(np.repeat(begin - first, size), degree)
        new = {"first": first, "end": first + size, "lead": lead, "to": to, **{name: getattr(self, name)[edges] for name in ("piece", "count", "logp", "upto")}}
        for name, kind in self.PARTS.items():
            self._append(name, new[name].astype(kind), 0)

    def _built(self, units: list[str]) -> dict[str, np.ndarray]:
        model, cost, temperature = self.model, self.cost, self.temperature
        text = MARK + MARK.join(units).replace(" ", MARK)
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        size = np.fromiter(map(len, units), np.int64, len(units)) + 1
        end = np.cumsum(size)
        last = np.repeat(end, size)
        number, n = model.number[code], len(code)
        found: list[tuple[np.ndarray, int, np.ndarray]] = []
        node = model.root.take(number)
        at, depth = np.flatnonzero(node >= 0), 1
        node = node[at]
        while len(at):
            piece = model.piece.take(node)
            ends = np.flatnonzero(piece >= 0)
            found.append((at[ends], depth, piece[ends]))
            inside = np.flatnonzero(at + depth < last.take(at))
            at, node = at[inside], node[inside]
            slot = model._find(node * model.many + number.take(at + depth))
            inside = np.flatnonzero(slot >= 0)
            at, node = at[inside], model.values.take(slot[inside])
            depth += 1
        single = np.zeros(n, bool)
        single[found[0][0] if found else []] = True
        odd = np.flatnonzero(~single)  # characters that are no piece: their bytes
        found.insert(0, (odd, 1, -1 - code[odd]))
        degree = sum((np.bincount(x, minlength=n) for x, *_ in found), np.zeros(n, np.int64))
        lead = np.append(0, np.cumsum(degree))
        edges = int(lead[-1])
        begin, to_, of_piece = np.repeat(np.arange(n), degree), np.empty(edges, np.int64), np.empty(edges, np.int64)
        slot = lead[:-1].copy()
        for at, length, piece in found:
            to_[slot[at]], of_piece[slot[at]] = at + length, piece
            slot[at] += 1
        count = np.ones(edges, np.int8)
        byte = np.flatnonzero(of_piece < 0)
        char = -1 - of_piece[byte]
        count[byte] = 1 + (char >= 0x80) + (char >= 0x800) + (char >= 0x10000)
        weight = self.weight.take(of_piece, mode="clip")
        weight[byte] = -cost * count[byte] / temperature
        # from units' ends: the log mass of what can follow each place, all places as far from their end at a time
        left = last - np.arange(n)
        order = np.argsort(np.minimum(left, 65535).astype(np.uint16), kind="stable")
        if n and int(left.max()) > 65535:
            order = np.argsort(left, kind="stable")
        size = degree[order]
        of = np.repeat(lead[order] - (np.cumsum(size) - size), size) + np.arange(edges)
        w, to, whole = weight[of], to_[of], (to_ >= last[begin])[of]
        mass, beside, less = np.zeros(n + 1), np.empty(n), np.empty(edges)
        starts = np.cumsum(size) - size
        cuts = np.flatnonzero(np.append(True, np.diff(left[order]) != 0)) if n else np.empty(0, np.int64)
        for a, b in zip(cuts.tolist(), np.append(cuts[1:], n).tolist(), strict=False):
            x, y = int(starts[a]), int(starts[b]) if b < n else edges
            logs, first = np.where(whole[x:y], 0.0, mass[to[x:y]]) + w[x:y], starts[a:b] - x
            top = np.maximum.reduceat(logs, first)
            less[x:y] = logs - np.repeat(top, size[a:b])
            beside[a:b] = np.log(np.add.reduceat(np.exp(less[x:y]), first))
            mass[order[a:b]] = top + beside[a:b]
        logp = np.empty(edges)
        logp[of] = less - np.repeat(beside, size)
        # a place's likeliest edge goes first
        likely = of[less == 0]
        place = begin[likely]
        away = np.append(True, place[1:] != place[:-1])[: len(likely)] & (likely != lead[place])
        x, y = lead[place[away]], likely[away]
        for part in (to_, of_piece, count, logp):
            part[x], part[y] = part[y], part[x]
        chance = np.exp(logp)
        total = np.cumsum(chance)
        upto = total - np.append(0.0, total)[lead[begin]]
        upto[lead[1:] - 1] = 2.0  # the last edge takes what rounding leaves
        new = {"first": end - np.diff(np.append(0, end)), "end": end, "lead": lead[1:], "to": to_, "piece": of_piece, "count": count, "logp": logp, "upto": upto}
        return {name: new[name].astype(kind) for name, kind in self.PARTS.items()}

    def sample(self, unit: np.ndarray, key: np.ndarray, place: np.ndarray, draw: int):
        """One segmentation of each unit: (log chance, pieces, signature). Row keys and places seed it."""
        return self.walk(unit, key, place, draw)[:3]

    def walk(self, unit: np.ndarray, key: np.ndarray, place: np.ndarray, draw: int):
        """sample(), and the ids of all units on end.

        A first number says how far a unit goes along its main path, which mostly is all of it: the chance to be on it after
        some edges is the product of theirs. Where it is left, another edge is drawn, and all that follows."""
        base = mixed(key, place, draw)
        first = _unit(base).astype(np.float32)  # as precise as the chances that it is held against
        off = np.flatnonzero(first >= self.main_chance.take(unit))
        logp, pieces, sign = self.main_logp.take(unit), self.main_pieces.take(unit).astype(np.int64), self.main_sign.take(unit)
        start = self.main_at.take(unit)
        own, base, first = unit[off], base[off], first[off]
        at, end, live, step, taken = self.first[own], self.end[own], np.arange(len(off)), 0, []
        main, chance = np.ones(len(off), bool), np.ones(len(off), np.float32)
        while len(live):
            u = stream(base, step).astype(np.float32)
            edge = self.lead.take(at)
            upto = self.upto.take(edge)
            on = np.flatnonzero(main)
            if len(on):
                then = chance[on] * np.minimum(upto[on], np.float32(1))
                stay = first[on] < then
                chance[on] = then
                left = on[~stay]
                main[left] = False
                u[left] = upto[left] + u[left] * (1 - upto[left])  # any edge but the first
                u[on[stay]] = -1
                edge[left] += 1
                upto[left] = self.upto.take(edge[left])
            look = np.flatnonzero(u > upto)
            v, e = u[look], edge[look]
            while len(look):
                e += 1
                more = np.flatnonzero(v > self.upto.take(e))
                if len(more) < len(look):
                    edge[look] = e
                    look, v, e = look[more], v[more], e[more]
            taken.append((live, edge))
            at, step = self.to.take(edge), step + 1
            more = np.flatnonzero(at < end)
            if len(more) < len(live):
                live, at, end, base, first, main, chance = (x[more] for x in (live, at, end, base, first, main, chance))
        logp[off], pieces[off], sign[off], edges = self._summed(len(off), taken)
        start[off] = len(self.main_ids) + np.cumsum(pieces[off]) - pieces[off]
        start -= np.cumsum(pieces) - pieces
        pool = np.append(self.main_ids, self.ids_of(edges).astype(np.int32))
        return logp, pieces, sign, pool.take(np.repeat(start, pieces) + np.arange(int(pieces.sum())))

    def _summed(self, n: int, taken: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, ...]:
        """(log chance, pieces, signature) of n paths, given as which of them have an edge at each step, and these; and all
        paths' edges on end."""
        if not n:
            return np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int32)
        steps = np.zeros(n, np.int64)
        for step, (live, _) in enumerate(taken):
            steps[live] = step + 1
        upto = np.cumsum(steps)
        first = upto - steps  # every path has an edge
        edges = np.empty(int(upto[-1]), np.int32)
        for step, (live, edge) in enumerate(taken):
            edges[first[live] + step] = edge
        power = np.full(len(taken), STEP, np.uint64)
        power[0] = 1
        later = np.repeat(upto, steps) - np.arange(1, len(edges) + 1)
        sign = self.piece.take(edges).astype(np.uint64) * np.multiply.accumulate(power).take(later)
        logp, count = self.logp.take(edges), self.count.take(edges)
        return np.add.reduceat(logp, first, dtype=np.float64), np.add.reduceat(count, first, dtype=np.int64), np.add.reduceat(sign, first), edges

    def ids_of(self, edges: np.ndarray) -> np.ndarray:
        """The ids of edges on end."""
        piece = self.piece[edges]
        if not len(edges) or piece.min() >= 0:
            return piece
        count = self.count[edges].astype(np.int64)
        out, start = np.repeat(piece, count), np.cumsum(count) - count
        for p in np.unique(piece[piece < 0]).tolist():
            at = start[piece == p]
            for i, b in enumerate(chr(-1 - p).encode("utf-8", "surrogatepass")):
                out[at + i] = self.model.bytes_id[b]
        return out

    def signature(self, path: list[int]) -> int:
        h = 0
        for e in path:
            h = (h * STEP + int(self.piece[e])) & LOW
        return h

    def path(self, unit: int, base: int) -> list[int]:
        """The edges of what sample() drew from a base hash."""
        at, end, out, upto = int(self.first[unit]), int(self.end[unit]), [], self.upto
        first, one = np.float32(_unit(np.uint64(base))), np.float32(1)
        main, chance = True, one
        while at < end:
            u, edge = np.float32(stream1(base, len(out))), int(self.lead[at])
            if main:
                chance *= min(upto[edge], one)
                main = first < chance
                if not main:
                    u = upto[edge] + u * (one - upto[edge])
                    edge += 1
            while not main and u > upto[edge]:
                edge += 1
            out.append(edge)
            at = int(self.to[edge])
        return out

    def left_masses(self, unit: int, taken: list[list[int]]) -> tuple[list[dict[int, int]], list[float]]:
        """The tree of taken paths, as each node's edges to others, and the log chance, from each node on, of all paths but
        those taken. Sums of what is left, never differences, so that any part of it is kept however small."""
        tree: list[dict[int, int]] = [{}]
        at = [int(self.first[unit])]
        for path in taken:
            node = 0
            for e in path:
                if e not in tree[node]:
                    tree[node][e] = len(tree)
                    tree.append({})
                    at.append(int(self.to[e]))
                node = tree[node][e]
        left, end = [NONE] * len(tree), int(self.end[unit])
        for node in range(len(tree) - 1, -1, -1):  # a node's own nodes come after it
            if at[node] < end:
                edges = range(int(self.lead[at[node]]), int(self.lead[at[node] + 1]))
                left[node] = _log_sum([float(self.logp[e]) + (left[tree[node][e]] if e in tree[node] else 0.0) for e in edges])
        return tree, left

    def rest(self, unit: int, taken: list[list[int]]) -> float:
        """Log chance of a unit's paths that aren't taken."""
        return self.left_masses(unit, taken)[1][0]

    def other(self, unit: int, base: int, taken: list[list[int]]) -> list[int]:
        """A path that isn't one of `taken`, by its chance among all others."""
        tree, left = self.left_masses(unit, taken)
        at, end, out, node = int(self.first[unit]), int(self.end[unit]), [], 0
        while at < end:
            edges = range(int(self.lead[at]), int(self.lead[at + 1]))
            own = tree[node] if node >= 0 else {}
            logs = [float(self.logp[e]) + (left[own[e]] if e in own else 0.0) for e in edges]
            top = max(logs)
            chance = [math.exp(x - top) for x in logs]
            u, pick = stream1(base, len(out)) * sum(chance), max((c, -i) for i, c in enumerate(chance))[1]
            pick = edges[-pick]
            for e, c in zip(edges, chance, strict=True):
                if c and u <= c:
                    pick = e
                    break
                u -= c
            node = own.get(pick, -1)
            out.append(pick)
            at = int(self.to[pick])
        return out

    def mass(self, path: list[int]) -> float:
        return math.exp(sum(map(float, self.logp[path])))

    def ids(self, model: Model, path: list[int]) -> list[int]:
        out: list[int] = []
        for e in path:
            p = int(self.piece[e])
            out.extend([p] if p >= 0 else [model.bytes_id[b] for b in chr(-1 - p).encode("utf-8", "surrogatepass")])
        return out


def _log_sum(logs: list[float]) -> float:
    top = max(logs, default=NONE)
    return top if top == NONE else top + math.log(sum(math.exp(x - top) for x in logs))


def _best_parts(part: np.ndarray, bound: np.ndarray, want: int, draws) -> list[tuple[int, float]]:
    """Of each row's parts, log chances, the `want` with the least perturbed value (the log of an exponential variable over
    the chance), as (place, value). Only parts that can be among these are drawn for: of a row's `want` largest, none is
    beaten by a part smaller by more than draws differ."""
    some = np.flatnonzero(np.diff(bound))
    if not len(some):
        return []
    lead, size = bound[some], np.diff(bound)[some]
    left = part
    for n in range(want):
        top = np.maximum.reduceat(left, lead)
        if n < want - 1:
            left = left.copy() if left is part else left
            hit = np.flatnonzero(left == np.repeat(top, size))
            owner = np.searchsorted(lead, hit, "right")
            left[hit[np.append(True, owner[1:] != owner[:-1])]] = NONE
    at = np.flatnonzero((part >= np.repeat(top - SPREAD, size)) & (part > NONE))
    if not len(at):
        return []
    with np.errstate(divide="ignore"):
        value = np.log(-np.log(draws(at))) - part[at]
    owner = np.searchsorted(lead, at, "right")
    order = np.lexsort((value, owner))
    first = np.flatnonzero(np.append(True, np.diff(owner) != 0))
    nth = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    order = order[nth < want]
    return list(zip(at[order].tolist(), value[order].tolist(), strict=True))


def sample_rows(lattice: Lattice, unit: np.ndarray, row: np.ndarray, keys: np.ndarray, k: int) -> list[list[dict]]:
    """Per row up to k different segmentations, best perturbed value first: dicts of log_prob, perturbed, inclusion,
    pieces, signature, ids, and `edges` (unit place -> path) of units that aren't plain draws, with `draw` per unit.

    unit: the units of all rows on end; row: the row of each. inclusion is the chance that a segmentation is among the k
    given the next best perturbed value (1 where there is none). A row with fewer segmentations gives them all, however
    small their chances.
    """
    rows = len(keys)
    bound = np.searchsorted(row, np.arange(rows + 1))
    place, key = np.arange(len(unit)) - bound[row], keys[row]
    some = np.flatnonzero(np.diff(bound))
    lead = bound[some]
    out: list[list[dict]] = [[] for _ in range(rows)]
    heaps: list[list] = [[] for _ in range(rows)]
    gumbel = -np.log(-np.log(uniform(keys, 0, 1 << 20, 0)))
    bases = {i: mixed(key, place, i) for i in range(k)}
    *leaf, drawn_ids = lattice.walk(unit, key, place, 0)
    leaf = [x.copy() for x in leaf] + [np.zeros(len(unit), np.int64)]  # log chance, pieces, signature, draw
    walks = [(drawn_ids, np.append(0, np.cumsum(leaf[1])))]  # each draw's ids, and where units' begin

    def ids(a: int, draws: np.ndarray, own: dict[int, list[int]]) -> np.ndarray:
        found, cuts = [], [0, *(np.flatnonzero(draws[1:] != draws[:-1]) + 1).tolist(), len(draws)]
        for x, y in zip(cuts[:-1], cuts[1:], strict=True):
            d = int(draws[x])
            if d < 0:
                found += [lattice.ids(lattice.model, own[j]) for j in range(x, y)]
            else:
                found.append(walks[d][0][walks[d][1][a + x] : walks[d][1][a + y]])
        return np.concatenate(found).astype(np.int32)

    leaves = [leaf]
    value = gumbel.copy()
    begin = np.zeros(rows, np.int64)  # the unit from which a row's newest leaf may be parted
    taken: list[list[list[int]]] = [[] for _ in range(rows)]  # that unit's paths that are gone already
    edges: list[dict[int, list[int]]] = [{} for _ in range(rows)]
    alive = np.zeros(rows, bool)
    alive[some] = True
    for r in range(rows):
        if not alive[r]:  # the empty text has one segmentation, the empty one
            out[r].append({"log_prob": 0.0, "perturbed": float(gumbel[r]), "inclusion": 1.0, "pieces": 0, "signature": 0, "ids": np.empty(0, np.int32), "edges": {}, "draws": None})
    for draw in range(1, k + 1):
        logp, pieces, sign, drawn = leaf
        total = np.add.reduceat(logp, lead) if len(lead) else np.zeros(0)
        npieces = np.add.reduceat(pieces, lead) if len(lead) else np.zeros(0, np.int64)
        signs = np.bitwise_xor.reduceat(mixed(place, sign), lead) if len(lead) else np.zeros(0, np.uint64)
        for i, r in enumerate(some.tolist()):
            if alive[r]:
                a, b = int(bound[r]), int(bound[r + 1])
                out[r].append({"log_prob": float(total[i]), "perturbed": float(value[r]), "pieces": int(npieces[i]), "signature": int(signs[i]), "ids": ids(a, drawn[a:b], edges[r]), "edges": dict(edges[r]), "draws": drawn[a:b]})
        # part what is left of each newest leaf's set
        before = np.cumsum(logp) - logp
        before = before - before[bound[row]]
        with np.errstate(divide="ignore", invalid="ignore"):
            p = np.exp(logp)
            part = before + np.where(p < SURE, np.log1p(-np.minimum(p, 1.0)), NONE)
        part[place < begin[row]] = NONE
        certain = np.flatnonzero((p >= SURE) & (place >= begin[row]))  # a difference would lose what is left
        own = unit[certain]
        for j in certain[lattice.sure[own] > 0].tolist():
            u = int(unit[j])
            if lattice.sure[u] > 0:
                lattice.sure[u] = lattice.rest(u, [edges[int(row[j])].get(int(place[j])) or lattice.path(u, int(bases[int(drawn[j])][j]))])
        part[certain] = before[certain] + lattice.sure[own]
        for r in some.tolist():
            if alive[r] and taken[r]:
                j = int(bound[r] + begin[r])
                now = edges[r].get(int(begin[r])) or lattice.path(int(unit[j]), int(bases[int(drawn[j])][j]))
                part[j] = before[j] + lattice.rest(int(unit[j]), [*taken[r], now])
        part[~alive[row]] = NONE
        want = k - draw + 1  # of the new parts only so many can still be opened, one more for the inclusion scores
        for j, best in _best_parts(part, bound, want, lambda at: uniform(key[at], place[at], 2 << 20, draw)):
            r = int(row[j])
            perturbed = -float(np.logaddexp(-value[r], best))
            if perturbed > NONE:
                heapq.heappush(heaps[r], (-perturbed, draw - 1, int(place[j]), taken[r] if int(place[j]) == int(begin[r]) else [], edges[r]))
        if draw == k:
            break
        # open each row's best part
        new = [x.copy() for x in leaf]
        opened = []
        for r in some.tolist():
            alive[r] = bool(heaps[r])
            if not heaps[r]:
                continue
            g, parent, j, gone, own = heapq.heappop(heaps[r])
            a, b = int(bound[r]), int(bound[r + 1])
            for x, y in zip(new, leaves[parent], strict=True):
                x[a : a + j] = y[a : a + j]
            old = own.get(j) or lattice.path(int(unit[a + j]), int(bases[int(leaves[parent][3][a + j])][a + j]))
            path = lattice.other(int(unit[a + j]), int(bases[draw][a + j]), [*gone, old])
            new[0][a + j], new[1][a + j], new[2][a + j], new[3][a + j] = sum(map(float, lattice.logp[path])), int(lattice.count[path].sum()), lattice.signature(path), -1
            edges[r] = {q: x for q, x in own.items() if q < j} | {j: path}
            value[r], begin[r], taken[r] = -g, j, [*gone, old]
            opened.append(np.arange(a + j + 1, b))
        if not opened:
            break
        at = np.concatenate(opened)
        *fresh, drawn_ids = lattice.walk(unit[at], key[at], place[at], draw)
        size = np.zeros(len(unit), np.int64)
        size[at] = fresh[1]
        walks.append((drawn_ids, np.append(0, np.cumsum(size))))
        for x, y in zip(new, fresh, strict=False):
            x[at] = y
        new[3][at] = draw
        leaf = new
        leaves.append(leaf)
    for r in range(rows):
        kappa = -heaps[r][0][0] if heaps[r] and len(out[r]) == k else None
        for x in out[r]:
            x["inclusion"] = 1.0 if kappa is None else -math.expm1(-math.exp(min(700.0, x["log_prob"] - kappa)))
    return out


def sampled_ids(model: Model, lattice: Lattice, units: np.ndarray, key: int, sample: dict) -> list[int]:
    """The ids of a sample of sample_rows; units: the row's."""
    out: list[int] = []
    for j, u in enumerate(units.tolist()):
        out.extend(lattice.ids(model, sample["edges"].get(j) or lattice.path(u, int(mixed(key, j, int(sample["draws"][j]))))))
    return out


class Known:
    """A worker's units: their encodings and their lattices, kept from batch to batch up to `most` of them."""

    def __init__(self, model: Model, cost: float, temperature: float, most: int = MEMO_UNITS):
        self.model, self.most = model, most
        self.number = pa.array([], pa.string())  # a unit's number is its place here
        self.ids, self.upto, self.uses = np.zeros(0, np.int32), np.zeros(1, np.int64), np.zeros(0, np.int64)
        self.lattice = Lattice(model, cost, temperature)

    def clear(self) -> None:
        """Forgets all units but those used most; earlier uses count half."""
        often = np.argsort(-self.uses, kind="stable")[: self.most // 2]
        often = np.sort(often[self.uses[often] >= OFTEN])
        self.number = self.number.take(pa.array(often))
        self.ids, self.upto = self.encoded(often)
        self.uses = self.uses[often] // 2
        self.lattice.keep(often)

    def encoded(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of units on end, and where each unit's begin."""
        size = self.upto[units + 1] - self.upto[units]
        upto = np.append(0, np.cumsum(size))
        return self.ids[np.repeat(self.upto[units] - upto[:-1], size) + np.arange(int(upto[-1]))], upto

    def numbers(self, units: list[str] | pa.Array) -> np.ndarray:
        if len(self.number) > self.most:
            self.clear()
        units = units if isinstance(units, pa.Array) else pa.array(units, pa.string())
        found = pc.index_in(units, value_set=self.number)
        out = pc.fill_null(found, -1).to_numpy().astype(np.int64)
        if found.null_count:
            coded = units.filter(pc.is_null(found)).dictionary_encode()
            out[out < 0] = len(self.number) + coded.indices.to_numpy()
            self.number = pa.concat_arrays([self.number, coded.dictionary])
            new = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
            ids, size = self.model.encode_units(new)
            self.ids, self.upto = np.append(self.ids, ids), np.append(self.upto, self.upto[-1] + np.cumsum(size))
            self.lattice.add(new)
            self.uses = np.pad(self.uses, (0, len(new)))
        self.uses += np.bincount(out, minlength=len(self.uses))
        return out


SAMPLE_TYPE = "rank: int, log_prob: double, perturbed: double, inclusion: double, n_pieces: bigint, signature: bigint, ids_sha256: string, round_trip: boolean"


def encode_and_sample(docs: DataFrame, id_col: str, text_col: str, path: str, k: int = SAMPLES, cost: float = COST, temperature: float = TEMPERATURE, ids: bool = False, memo: int = MEMO_UNITS, batch: int = BATCH_BYTES) -> DataFrame:
    """One row per row of docs: id, n_bytes, n_pieces, ids_sha256 (of little-endian 32-bit ids), round_trip, samples; with
    ids also ids, the encoding, the text that it decodes to, and each sample's own ids.

    The encoding is the library's, whole text, without begin or end pieces. round_trip: the decoded text is the text (a
    space mark in a text is a space to the encoder, so such texts don't). samples: up to k different segmentations, as
    sample_rows has them, each with the sha256 of its ids and whether these decode to the text again, seeded by the row's id: rows of the same id and text get the same ones, and a null id has a
    seed of its own. A null text is empty: no pieces, and one segmentation. Narrow: no shuffle. Other columns are left out.
    memo and batch bound a worker's memory, not the result: units that are remembered, bytes of texts worked on together.
    """
    name = path.rsplit("/", 1)[-1]

    def rows_of(known: Known, key: list, text: list[str]) -> Iterator[tuple]:
        units, size = known.model.units_of(pa.array(text, pa.string()))
        unit = known.numbers(units)
        seeds = np.array([int.from_bytes(hashlib.blake2b(repr(x).encode(), digest_size=8).digest(), "little") for x in key], np.uint64)
        samples = sample_rows(known.lattice, unit, np.repeat(np.arange(len(text)), size), seeds, k)
        own, upto = known.encoded(unit)
        bound = upto[np.append(0, np.cumsum(size))]
        decoded, cut = known.model.decode_all(own, bound), bound.tolist()
        drawn = [s["ids"] for x in samples for s in x]  # every row has a sample
        again = iter(known.model.decode_to(np.concatenate(drawn), np.append(0, np.cumsum(list(map(len, drawn)))), [t for t, x in zip(text, samples, strict=True) for _ in x]))
        for i, t in enumerate(text):
            e, found = own[cut[i] : cut[i + 1]], []
            for n, s in enumerate(samples[i]):
                found.append((n + 1, s["log_prob"], s["perturbed"], s["inclusion"], s["pieces"], s["signature"] - (1 << 63), hashlib.sha256(s["ids"].astype("<i4").tobytes()).hexdigest(), next(again), s["ids"]))
            yield len(t.encode()), len(e), hashlib.sha256(e.astype("<i4").tobytes()).hexdigest(), decoded[i] == t, found, *((e, decoded[i]) if ids else (None, None))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.collect()
        gc.disable()  # many objects, no cycles
        known = Known(Model(_on_this_machine(path, name)), cost, temperature, memo)
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.bool_(), None, pa.list_(pa.int32()), pa.string())
        parts = [("rank", pa.int32()), *[(c, pa.float64()) for c in ("log_prob", "perturbed", "inclusion")], ("n_pieces", pa.int64()), ("signature", pa.int64()), ("ids_sha256", pa.string()), ("round_trip", pa.bool_())]

        def lists(sizes: list[int], values: pa.Array) -> pa.ListArray:
            return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), values)

        def nested(rows: tuple) -> pa.ListArray:
            flat = [s for r in rows for s in r]  # every row has a sample
            own = {name: pa.array([s[i] for s in flat], t) for i, (name, t) in enumerate(parts)}
            if ids:
                own["ids"] = lists([len(s[-1]) for s in flat], pa.array(np.concatenate([s[-1] for s in flat]), pa.int32()))
            return lists([len(r) for r in rows], pa.StructArray.from_arrays(list(own.values()), list(own)))

        for part in some_rows(batches, 1, batch):
            key, text = part.column(0).to_pylist(), [t or "" for t in part.column(1).to_pylist()]
            found = list(rows_of(known, key, text))
            cols = [nested(c) if t is None else pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), *cols], ["k", "n_bytes", "n_pieces", "ids_sha256", "round_trip", "samples", "ids", "decoded"])
        del known
        release()

    d = docs.select(F.col(f"`{id_col}`").alias("k"), F.col(f"`{text_col}`").alias("t"))
    out = d.mapInArrow(work, f"k {d.schema['k'].dataType.simpleString()}, n_bytes bigint, n_pieces bigint, ids_sha256 string, round_trip boolean, samples array<struct<{SAMPLE_TYPE}{', ids: array<int>' * ids}>>, ids array<int>, decoded string")
    return out.select(F.col("k").alias(id_col), "n_bytes", "n_pieces", "ids_sha256", "round_trip", "samples", *["ids", "decoded"] * ids)
