"""Token counts of a public BPE tokenizer; huge texts in overlapping chunks that are spliced where both agree."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import some_rows

#: Texts of more characters are encoded in chunks.
CHUNK_CHARS = 16_384
#: Characters that neighbouring chunks share at first; doubled until a common boundary is found.
OVERLAP_CHARS = 256
#: Words whose token counts a worker remembers.
MEMO_WORDS = 400_000


#: The parts of a tokenizer file that WordEncoder repeats for plain texts.
KNOWN_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
KNOWN_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class LibraryEncoder:
    """Counts of any tokenizer file, by the library alone. Texts aren't cut: nothing is known of where its tokens end."""

    chunks = False

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()

    def count(self, text: str) -> int:
        return len(self.lib.encode(text, add_special_tokens=False))


def encoder(path: str) -> WordEncoder | LibraryEncoder:
    """The quick encoder where the file's normalizer and split are those that it repeats, else the library's."""
    import json

    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    split = file.get("pre_tokenizer") or {}
    first = (split.get("pretokenizers") or [{}])[0]
    known = file.get("normalizer") == KNOWN_NORMALIZER and first.get("type") == "Split" and first.get("pattern") == {"Regex": KNOWN_SPLIT}
    known = known and (first.get("behavior"), first.get("invert")) == ("Removed", True) and [x.get("type") for x in split["pretokenizers"][1:]] == ["ByteLevel"]
    known = known and not split["pretokenizers"][1].get("add_prefix_space", True) and (file.get("model") or {}).get("type") == "BPE" and not file["model"].get("dropout")
    return WordEncoder(path) if known else LibraryEncoder(path)


class WordEncoder:
    """Counts of tokens by pretoken, equal to the library's, with offsets; for files that encoder() has looked at.

    The library's BPE never merges across pretokens, so a pretoken's count can be remembered; the library itself counts
    each new one. Its normalizer (NFC, white space, lower case) and its split are repeated here only for texts of the
    characters in SAFE, where they are plain: all others go to the library whole, special strings included.
    """

    chunks = True
    #: ASCII without the control characters that regex engines treat differently, Latin-1 letters and a few
    #: punctuation marks; NFC leaves them alone and lower() maps each to one character.
    SAFE = re.compile(r"[\t\n\x0b\x0c\r\x20-\x7e\xa1\xa9\xab\xae\xbb\xbf\xc0-\xd6\xd8-\xf6\xf8-\xff–—‘’“”…]*")
    #: Fixed value: the tokenizer file's own split pattern, written for these characters.
    SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\t\n\x0b\x0c\r a-z0-9ß-öø-ÿ]+")

    def __init__(self, path: str, memo_words: int = MEMO_WORDS):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        self.special = [x.content for x in self.lib.get_added_tokens_decoder().values()]
        self.memo: dict[str, int] = {}
        self.memo_words = memo_words

    def plain(self, text: str) -> bool:
        return bool(self.SAFE.fullmatch(text)) and not any(x in text for x in self.special)

    def _lengths(self, words: list[str]) -> list[int]:
        memo = self.memo
        got = list(map(memo.get, words))
        if None in got:
            if len(memo) > self.memo_words:
                memo.clear()
            new = list({w for w in words if w not in memo})
            memo.update(zip(new, (len(e) for e in self.lib.encode_batch_fast(new, add_special_tokens=False)), strict=True))
            got = list(map(memo.__getitem__, words))
        return got

    def count(self, text: str) -> int:
        if self.plain(text):
            return sum(self._lengths(self.SPLIT.findall(text.lower())))
        return len(self.lib.encode(text, add_special_tokens=False))

    def offsets(self, text: str) -> list[tuple[int, int, int]]:
        """(start, end, tokens) of each pretoken, or of each token where the library encodes."""
        if self.plain(text):
            found = [(m.start(), m.end(), m[0]) for m in self.SPLIT.finditer(text.lower())]
            return [(s, e, n) for (s, e, _), n in zip(found, self._lengths([w for *_, w in found]), strict=True)]
        return [(s, e, 1) for s, e in self.lib.encode(text, add_special_tokens=False).offsets]


def _stable(text: str, at: int, special: list[str]) -> bool:
    """Whether no token, normalization or special string can reach across position at: a white space ends just before
    it, a plain character follows, and no special string has it inside."""
    if not (text[at - 1].isspace() and text[at].isalnum() and unicodedata.combining(text[at]) == 0):
        return False
    return not any(x in text[max(0, at - len(x) + 1) : at + len(x) - 1] for x in special)


def spliced_count(enc: WordEncoder | LibraryEncoder, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> int:
    """Tokens of text from chunks that overlap.

    Each chunk is encoded with offsets. In the overlap of two neighbours, the splice is the first position that is
    stable (see _stable), starts a token in both, and from which both give the same tokens up to the earlier chunk's
    last stable position; without one, the overlap is doubled and the earlier chunk encoded further, up to all of text.
    """
    if len(text) <= chunk or not enc.chunks:
        return enc.count(text)
    total, start, width = 0, 0, overlap
    while True:
        end = start + chunk + width - overlap
        if end >= len(text):
            return total + enc.count(text[start:])
        after = max(start + 1, end - width)
        left = [(s + start, e + start, n) for s, e, n in enc.offsets(text[start:end]) if e + start > after]
        right = [(s + after, e + after, n) for s, e, n in enc.offsets(text[after:end])]
        splice = _common_boundary(text, left, right, after, end, enc.special)
        if splice is None:
            width *= 2
            continue
        total += enc.count(text[start:splice])
        start, width = splice, overlap


def _common_boundary(text, left, right, after, end, special) -> int | None:
    """First agreed stable boundary after `after`: both encodings start a token there and agree from it on, but for
    what touches `end`."""
    a, b = {x[0]: i for i, x in enumerate(left)}, {x[0]: i for i, x in enumerate(right)}
    for at in sorted(a.keys() & b.keys()):
        if at > after and _stable(text, at, special):
            x, y = ([t for t in side[i:] if t[1] < end] for side, i in ((left, a[at]), (right, b[at])))
            if x and x == y:
                return at
    return None


def token_counts(docs: DataFrame, id_col: str, text_col: str, path: str, limit: int = 2048, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """One row per row of docs: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    As the library counts with the file at `path`, whichever it is (huge texts in chunks where the file's split is one that
    WordEncoder knows, else whole), without added special tokens, truncation or padding; special strings inside texts
    are what the library's default makes of them. A null text is an empty one: 0 bytes, 0 tokens. Narrow: no shuffle;
    a lost executor's tasks run again. Other columns of docs are left out.
    """
    name = path.rsplit("/", 1)[-1]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        enc = encoder(_on_this_machine(path, name))
        for batch in some_rows(batches, 1):
            n = [spliced_count(enc, t, chunk, overlap) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], ["_id", "_n"])

    d = docs.select(F.col(f"`{id_col}`").alias("_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_t"))
    kind = d.schema["_id"].dataType.simpleString()
    # the bytes need no second pass: the worker gets (id, bytes) as one column
    d = d.select(F.struct("_id", F.octet_length("_t").cast("long").alias("b")).alias("_id"), "_t")
    got = d.mapInArrow(count, f"_id struct<_id: {kind}, b: bigint>, _n bigint")
    return got.select(
        F.col("_id._id").alias(id_col), F.col("_id.b").alias("n_bytes"), F.col("_n").alias("n_tokens"), (F.col("_n") > limit).alias("over_limit")
    )


def _on_this_machine(path: str, name: str) -> str:
    """path, or where this machine's package has the file of that name."""
    import os

    if os.path.exists(path):
        return path
    import public_tokenizers

    return public_tokenizers.path(name)
