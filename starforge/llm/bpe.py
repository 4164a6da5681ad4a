"""BPE encoding and decoding of whole texts with a public word-end vocabulary.

A short word is encoded on a contiguous array: its part boundaries and the rank of each pair of
neighbouring parts.  The smallest rank is looked up by a scan, the boundary between its parts is
deleted, and the ranks next to it are refreshed.  Many short words go through these steps side by
side, as the rows of one array.  A scan per merge is quadratic, so longer words keep their ranks
in a heap; the result is the same.

Letters, digits and cases follow the Unicode tables of this Python, with what the tokenizer's own
library knows beyond them stated below.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starforge.llm.common import prepare

col = F.col

NONE = 1 << 62
BITS = 20
MASK = (1 << BITS) - 1
# Symbols up to which a word counts as short.
SHORT = 32
# Bytes of words and ids that a worker remembers, and characters of texts that it looks at together.
REMEMBERED, TOGETHER = 32 << 20, 1 << 20

# Letters, digits and capitals (with their small letters) that were added to Unicode
# after the tables of Python 3.13 and that the library knows; a pair is a range.
NEW_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
    (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
    (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
NEW_DIGITS = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
]
NEW_LOWER = {
    0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB,
    0xA7DC: 0x19B,
    **{c: c + 0x20 for c in range(0x10D50, 0x10D66)},
    **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)},
}

# Marks that the library's composition does not know as such, as they are newer than its
# tables, and one that it composes with nothing (the last pair).
NEW_MARKS = [
    (0x7FD, 0x7FD), (0x898, 0x89F), (0x8CA, 0x8D3), (0x9FE, 0x9FE), (0xC3C, 0xC3C), (0xD3B, 0xD3C), (0xEBA, 0xEBA),
    (0x1715, 0x1715), (0x1ABF, 0x1ACE), (0x1DF6, 0x1DFA), (0xA82C, 0xA82C), (0x10D24, 0x10D27), (0x10EAB, 0x10EAC),
    (0x10EFD, 0x10EFF), (0x10F46, 0x10F50), (0x10F82, 0x10F85), (0x11070, 0x11070), (0x1133B, 0x1133B),
    (0x1145E, 0x1145E), (0x11839, 0x1183A), (0x1193D, 0x1193E), (0x11943, 0x11943), (0x119E0, 0x119E0),
    (0x11A34, 0x11A34), (0x11A47, 0x11A47), (0x11A99, 0x11A99), (0x11D42, 0x11D42), (0x11D44, 0x11D45),
    (0x11D97, 0x11D97), (0x11F41, 0x11F42), (0x16FF0, 0x16FF1), (0x1E08F, 0x1E08F), (0x1E130, 0x1E136),
    (0x1E2AE, 0x1E2AE), (0x1E2EC, 0x1E2EF), (0x1E4EC, 0x1E4EF), (0x11930, 0x11930),
]
_APART = re.compile(f"([{''.join(f'{chr(a)}-{chr(b)}' for a, b in NEW_MARKS)}])")


def composed(text: str) -> str:
    """The text in NFC, as the library has it: marks it does not know stay where they are."""
    return "".join([unicodedata.normalize("NFC", part) for part in _APART.split(text)])


class _StandIns(dict):
    """For each code point one that patterns take for the same: a letter, a digit or another sign.

    Unassigned code points are signs, whatever newer tables of patterns say.
    """

    def __missing__(self, code: int) -> str:
        self[code] = out = "\xa7" if unicodedata.category(chr(code)) == "Cn" else chr(code)
        return out


STAND_INS = _StandIns()
for _ranges, _sign in ((NEW_LETTERS, "z"), (NEW_DIGITS, "1")):
    STAND_INS.update({c: _sign for first, last in _ranges for c in range(first, last + 1)})

# What str.split() cuts at although the vocabulary's \s does not.
_NOT_SPACE = re.compile("[\x1c-\x1f]")
_SPACE = regex.compile(r"\p{White_Space}+")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class WordBpe:
    """An encoder and decoder made from the text of a tokenizer file (BPE with word ends)."""

    def __init__(self, definition: str):
        parsed = json.loads(definition)
        model = parsed["model"]
        vocab: dict[str, int] = model["vocab"]
        end = model["end_of_word_suffix"] or ""
        if model["type"] != "BPE" or len(vocab) > MASK:
            raise ValueError("not a BPE vocabulary that fits")
        self.special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        self.pairs: dict[int, int] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.pairs[vocab[a] << BITS | vocab[b]] = rank << BITS | vocab[a + b]
        self.pair_keys = np.array(sorted(self.pairs), dtype=np.int64)
        self.pair_ranks = np.array([self.pairs[k] for k in self.pair_keys.tolist()], dtype=np.int64)
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters])
        self.last = np.array([vocab[c + end] for c in letters])
        split = next(p for p in parsed["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        marks = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.marks = re.compile(f"({'|'.join(marks)})") if marks else None
        self.known: dict[str, bytes] = {}
        self.pieces_known: dict[str, bytes] = {}
        self.held = self.pieces_held = 0

    # -- merges

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank and merged id of pairs of ids, ``NONE`` where the pair does not merge."""
        key = left.astype(np.int64) << BITS | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == key) & (right >= 0), self.pair_ranks[at], NONE)

    def _short(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of short words, a row of one array each.

        ``parts`` holds what lies between two neighbouring boundaries, ``ranks`` the rank of each
        pair of neighbours.  In every step each row that still merges deletes one boundary, so
        both arrays get one column narrower.
        """
        length = np.array([len(p) for p in pieces])
        row = np.arange(len(pieces))
        parts = np.full((len(pieces), length.max()), -1, dtype=np.int64)
        parts[np.arange(parts.shape[1]) < length[:, None]] = self.inner[np.frombuffer(b"".join(pieces), np.uint8)]
        parts[row, length - 1] = self.last[np.array([p[-1] for p in pieces])]
        ranks = self._rank(parts[:, :-1], parts[:, 1:])
        out: list[bytes] = [b""] * len(pieces)
        while len(row):
            if ranks.shape[1]:
                at = ranks.argmin(axis=1)
                best = ranks[np.arange(len(row)), at]
                done = best == NONE
            else:
                done = np.ones(len(row), dtype=bool)
            for r, ids, n in zip(row[done].tolist(), parts[done].astype(np.int32), length[done].tolist()):
                out[r] = ids[:n].tobytes()
            if done.all():
                break
            open_ = ~done
            row, length, at, best = row[open_], length[open_] - 1, at[open_], best[open_]
            every = np.arange(len(row))
            parts, ranks = parts[open_], ranks[open_]
            parts[every, at] = best & MASK
            # the boundary goes, and with it the part and the rank to its right
            columns = np.arange(parts.shape[1] - 1)
            parts = np.take_along_axis(parts, columns + (columns > at[:, None]), axis=1)
            columns = columns[:-1]
            ranks = np.take_along_axis(ranks, columns + (columns >= at[:, None]), axis=1)
            left = at > 0
            ranks[every[left], at[left] - 1] = self._rank(parts[every[left], at[left] - 1], parts[every[left], at[left]])
            right = at < ranks.shape[1]
            ranks[every[right], at[right]] = self._rank(parts[every[right], at[right]], parts[every[right], at[right] + 1])
        return out

    def _heap(self, parts: list[int]) -> list[int]:
        rank, n = self.pairs.get, len(parts)
        after = [*range(1, n), -1]
        before = [*range(-1, n - 1)]
        ranks = [rank(a << BITS | b, NONE) for a, b in zip(parts, parts[1:])] + [NONE]
        heap = [(r, i) for i, r in enumerate(ranks) if r != NONE]
        heapq.heapify(heap)
        while heap:
            best, i = heapq.heappop(heap)
            if ranks[i] != best:
                continue
            j = after[i]
            parts[i], ranks[j] = best & MASK, NONE
            parts[j] = -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
            for left, right in ((before[i], i), (i, k)):
                if left >= 0:
                    ranks[left] = rank(parts[left] << BITS | parts[right], NONE) if right >= 0 else NONE
                    if ranks[left] != NONE:
                        heapq.heappush(heap, (ranks[left], left))
        return [p for p in parts if p >= 0]

    # -- texts

    def _pieces(self, plain: str) -> list[str]:
        """Runs of letters, single digits, runs of other signs and the listed endings."""
        if plain.isalpha():
            return [plain]
        if plain[:-1].isalpha() and plain[-1] in ".,;:!?":
            return [plain[:-1], plain[-1]]
        alike = plain if plain.isascii() else plain.translate(STAND_INS)
        return [plain[m.start() : m.end()] for m in self.pattern.finditer(alike)]

    def _learn_pieces(self, pieces: set[str]) -> None:
        """Encode pieces that are not known yet, short ones together."""
        short: list[str] = []
        for p in pieces:
            data = p.encode("utf-8", "replace")
            if len(data) <= SHORT:
                short.append(p)
                continue
            symbols = self.inner[np.frombuffer(data, np.uint8)].tolist()
            symbols[-1] = int(self.last[data[-1]])
            self.pieces_known[p] = np.array(self._heap(symbols), dtype=np.int32).tobytes()
        short.sort(key=len)
        for s in range(0, len(short), 4096):
            some = short[s : s + 4096]
            self.pieces_known.update(zip(some, self._short([p.encode("utf-8", "replace") for p in some])))

    def _learn(self, words: set[str]) -> None:
        """Find the ids of whole words: their pieces' ids, and those of special tokens."""
        cut: dict[str, list] = {}
        for w in words:
            found: list = []
            for n, section in enumerate(self.marks.split(w) if self.marks and "<" in w else [w]):
                if n % 2:
                    found.append(np.int32(self.special[section]).tobytes())
                elif section:
                    if not section.isascii():
                        # letter by letter, so a sigma at a word's end is like any other
                        section = composed(section).replace("Σ", "σ")
                    small = section.lower()
                    found += self._pieces(small if small.isascii() else small.translate(NEW_LOWER))
            cut[w] = found
        pieces = {p for found in cut.values() for p in found if isinstance(p, str)}
        if self.pieces_held > REMEMBERED:
            self.pieces_known.clear()
            self.pieces_held = 0
        fresh = pieces.difference(self.pieces_known)
        self._learn_pieces(fresh)
        self.pieces_held += sum(self._bytes(p, self.pieces_known[p]) for p in fresh)
        ids = self.pieces_known
        for w, found in cut.items():
            self.known[w] = b"".join([ids[p] if isinstance(p, str) else p for p in found])
            self.held += self._bytes(w, self.known[w])

    @staticmethod
    def _bytes(word: str, ids: bytes) -> int:
        """What an entry takes, about; a hundred bytes besides its text and ids."""
        return 100 + 2 * len(word) + len(ids)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of whole texts, four bytes each."""
        out, some, size = [], [], 0
        for text in texts:
            some.append(text)
            size += len(text or "")
            if size >= TOGETHER:
                out += self._encode(some)
                some, size = [], 0
        return out + self._encode(some)

    def _encode(self, texts: list[str | None]) -> list[bytes]:
        words = [(_SPACE.split(t) if _NOT_SPACE.search(t) else t.split()) if t else [] for t in texts]
        missing = set().union(*words).difference(self.known)
        if self.held > REMEMBERED:
            self.known.clear()
            self.held = 0
            missing = set().union(*words)
        self._learn(missing)
        ids = self.known.__getitem__
        return [b"".join(map(ids, w)) for w in words]


def token_names(definition: str) -> dict[int, str]:
    """Tokens by id, which is all that decoding needs."""
    parsed = json.loads(definition)
    names = {i: t for t, i in parsed["model"]["vocab"].items()}
    return names | {t["id"]: t["content"] for t in parsed["added_tokens"]}


def decode(ids: list[int], names: dict[int, str]) -> str:
    """Tokens joined by a space, as the file names no decoder; unknown ids are left out."""
    try:
        return " ".join([names[i] for i in ids])
    except KeyError:
        return " ".join([names[i] for i in ids if i in names])


def definition(path: str) -> str:
    """The text of a tokenizer file, read by the driver; a few MB that do not grow with the data."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encoder(spark: SparkSession, path: str):
    """A function from a text column to the column of its ids; null and empty texts have none."""
    prepare(spark)
    shared = spark.sparkContext.broadcast(definition(path))

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = WordBpe(shared.value)
        for texts in batches:
            found = bpe.encode(texts.to_pylist())
            ends = np.cumsum([0, *map(len, found)]) // 4
            flat = np.frombuffer(b"".join(found), dtype=np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))

    return encode


def decoder(spark: SparkSession, path: str):
    """A function from a column of ids to the column of decoded texts; null decodes to an empty text."""
    prepare(spark)
    shared = spark.sparkContext.broadcast(definition(path))

    @F.arrow_udf("string")
    def text_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = token_names(shared.value)
        for lists in batches:
            flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            yield pa.array([decode(flat[a:b].tolist(), names) for a, b in zip(ends, ends[1:])], pa.string())

    return text_of


def encoded(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of every whole text.

    Null and empty texts have no ids; every row keeps its other columns, repeated rows too, and
    an empty table stays empty.  Texts of any length are encoded whole, and a word of any length takes
    time that grows with its length, but for a logarithm.  A column named ``ids`` is replaced.  There
    is no shuffle.
    """
    return docs.withColumn(ids, encoder(docs.sparkSession, path)(col(text)))


def decoded(rows: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``rows`` with the text that their ids decode to.

    Null and empty lists of ids decode to an empty text, unknown ids to nothing; lists of any length
    are decoded whole.  Repeated rows get equal texts, and an empty table stays empty.
    """
    return rows.withColumn(text, decoder(rows.sparkSession, path)(col(ids)))


def ids_text(ids: Column) -> Column:
    """Decimal ids joined by one space."""
    return F.concat_ws(" ", ids.cast("array<string>"))
