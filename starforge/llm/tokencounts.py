"""Token counts under a unigram vocabulary, with scores shared along a trie.

The best split of a string has, at each position, the best score of the prefix up to it plus the
pieces that end there.  A prefix's score does not depend on what follows, so distinct pre-tokens
are laid out as a trie and each of its nodes is scored once; a pre-token's count is kept at its
last node.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starforge.llm.common import prepare

col = F.col

# Fixed value: what a piece at the beginning of a word starts with.
WORD_START = "▁"
# Pre-tokens whose counts a worker remembers.
REMEMBERED = 400_000
_WORDS = re.compile("[^\x20\x09-\x0d]+").findall


def unigram_scores(path: str) -> tuple[dict[str, float], float]:
    """Log-probabilities of the pieces of a public vocabulary file, and that of a byte.

    The file lists pieces by frequency but has no probabilities, so Zipf's law stands in:
    proportional to 1 / (rank + 2.7).  A few MB, read by the driver.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    normal = np.log(np.sum(1 / (np.arange(n) + 2.7)))
    pieces: dict[str, float] = {}
    rank = 0
    for i in range(n):
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i):
            continue
        pieces[model.id_to_piece(i)] = float(-np.log(rank + 2.7) - normal)
        rank += 1
    return pieces, float(-np.log(n + 2.7) - normal)


class Counter:
    """Counts tokens of pre-tokens; each distinct prefix in a batch is scored once."""

    def __init__(self, pieces: dict[str, float], by_byte: float):
        self.pieces, self.by_byte = pieces, by_byte
        lengths: dict[str, set[int]] = {}
        for p in pieces:
            lengths.setdefault(p[-1], set()).add(len(p))
        # lengths of the pieces that end in a character
        self.lengths = {c: sorted(n) for c, n in lengths.items()}
        self.known: dict[str, int] = {}

    def learn(self, words: list[str]) -> None:
        """Walk the trie of the sorted words depth first; ``best`` and ``count`` hold the current path."""
        score, lengths, by_byte = self.pieces.get, self.lengths, self.by_byte
        best, count, path = [0.0], [0], ""
        for word in sorted(words):
            text = WORD_START + word
            shared = 0
            for a, b in zip(path, text):
                if a != b:
                    break
                shared += 1
            del best[shared + 1 :], count[shared + 1 :]
            for end in range(shared + 1, len(text) + 1):
                last = text[end - 1]
                top, number = None, 0
                for n in lengths.get(last, ()):
                    if n > end:
                        break
                    s = score(text[end - n : end])
                    if s is not None:
                        s += best[end - n]
                        c = count[end - n] + 1
                        # of equal scores the one with fewer tokens
                        if top is None or s > top or (s == top and c < number):
                            top, number = s, c
                if score(last) is None:  # spelled in bytes
                    data = last.encode("utf-8", "replace")
                    s, c = best[end - 1] + by_byte * len(data), count[end - 1] + len(data)
                    if top is None or s > top:
                        top, number = s, c
                best.append(top)
                count.append(number)
            path = text
            self.known[word] = count[-1]

    def counts(self, texts: list[str | None]) -> list[tuple[int, int]]:
        """Pre-tokens and tokens of whole texts."""
        words = [_WORDS(t) if t else [] for t in texts]
        missing = set().union(*words).difference(self.known)
        if len(self.known) + len(missing) > REMEMBERED:
            self.known.clear()
            missing = set().union(*words)
        self.learn(list(missing))
        known = self.known.__getitem__
        return [(len(w), sum(map(known, w))) for w in words]


def counter(spark: SparkSession, path: str):
    """A function from a text column to a struct of its pre-tokens and tokens."""
    prepare(spark)
    shared = spark.sparkContext.broadcast(unigram_scores(path))

    @F.arrow_udf("struct<n_pretokens: bigint, n_tokens: bigint>")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = Counter(*shared.value)
        for texts in batches:
            found = counter.counts(texts.to_pylist())
            sides = [pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)]
            yield pa.StructArray.from_arrays(sides, names=["n_pretokens", "n_tokens"])

    return count


def with_counts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_pretokens`` and ``n_tokens`` of every whole text; nothing is shuffled.

    Null and empty texts have none of either; rows are kept with their other columns, repeated
    ones too; columns of these two names are replaced; an empty table stays empty.  Texts of any
    length are counted whole, a batch's distinct pre-tokens at a time.
    """
    kept = F.struct(*[c for c in docs.columns if c not in ("n_pretokens", "n_tokens")])
    found = docs.select(kept.alias("kept"), counter(docs.sparkSession, path)(col(text)).alias("counts"))
    return found.select("kept.*", "counts.*")
