"""Cleaning, redaction and chunking of free text."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import groupby, pairwise

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from starforge.functions.batches import text_parts
from starforge.functions.columns import SPACE, WORD, collapse_spaces, strip_spaces
from starforge.functions.markup import strip_html

# --------------------------------------------------------------------------- redaction

_START = f"(?<!{WORD})"
# a digit that starts a word; the digit comes first as that is quickest to rule out
_FIRST_DIGIT = rf"\p{{Nd}}(?<!{WORD}\p{{Nd}})"
_EDGE = f"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"

# What is redacted, in this order, and what it is replaced by.
REDACTIONS = [
    (rf"{_FIRST_DIGIT}[ -]*?(?:\p{{Nd}}[ -]*?){{12,15}}{_EDGE}", "[REDACTED_CARD]"),
    (
        rf"{_FIRST_DIGIT}\p{{Nd}}{{2}}(?:[-.]|{SPACE})\p{{Nd}}{{3}}(?:[-.]|{SPACE})\p{{Nd}}{{4}}(?!{WORD})",
        "[REDACTED_PHONE]",
    ),
    (r"[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_-]+\.[\p{L}\p{N}_.-]+", "[REDACTED_EMAIL]"),
]


def redact(c: Column) -> Column:
    """Replace card numbers, then phone numbers, then e-mail addresses."""
    for pattern, placeholder in REDACTIONS:
        replaced = F.regexp_replace(c, pattern, placeholder)
        # most texts hold no address, which a search for one character shows
        c = F.when(F.contains(c, F.lit("@")), replaced).otherwise(c) if "@" in pattern else replaced
    return c


def had_pii(original: Column, redacted: Column) -> Column:
    return original != redacted


# --------------------------------------------------------------------------- cleaning

# Sign-offs, and phrases that mail programs add.
SIGN_OFFS = ["best regards", "kind regards", "warm regards", "many thanks", "thanks", "cheers", "sincerely"]
BOILERPLATE = ["sent from my iphone", "sent from my android", "sent from yahoo mail.*", "get outlook for ios"]
ABBREVIATIONS = [("pls", "please"), ("Pls", "Please")]


def _before(c: Column, pattern: str) -> Column:
    """Text before the first match, empty if there is none."""
    parts = F.split(c, pattern, 2)
    return F.when(F.size(parts) > 1, F.get(parts, 0)).otherwise("")


def strip_signature(c: Column, min_pos: int = 15) -> Column:
    """Cut at the first sign-off phrase or ``--``, unless it starts within ``min_pos`` characters."""
    phrase = _before(c, rf"(?iu){_START}(?:{'|'.join(SIGN_OFFS)}){SPACE}*,")
    delimiter = _before(c, rf"{SPACE}--{SPACE}")
    cut_phrase, cut_delimiter = F.length(phrase) > min_pos, F.length(delimiter) > min_pos
    nearer = cut_phrase & (~cut_delimiter | (F.length(phrase) <= F.length(delimiter)))
    return (
        F.when(nearer, strip_spaces(phrase)).when(cut_delimiter, strip_spaces(delimiter)).otherwise(c)
    )


def tidy(c: Column) -> Column:
    """One space for any run of white space, none at the ends."""
    return F.trim(collapse_spaces(c))


def clean_text(c: Column) -> Column:
    """Plain text without markup, signature, boilerplate and surplus white space, in that order."""
    c = strip_signature(tidy(strip_html(c)))
    freed = c
    for phrase in BOILERPLATE:
        freed = F.regexp_replace(freed, f"(?iu){phrase}", "")
    # one search spares most texts the four replacements
    c = F.when(c.rlike(f"(?iu){'|'.join(BOILERPLATE)}"), freed).otherwise(c)
    for short, long in ABBREVIATIONS:
        c = F.replace(c, F.lit(short), F.lit(long))
    return tidy(c)


def combine(subject: Column, body: Column) -> Column:
    return F.when(F.length(subject) > 0, F.concat(subject, F.lit(". "), body)).otherwise(body)


# --------------------------------------------------------------------------- chunking

MAX_CHARS = 400
OVERLAP_CHARS = 60
_SENTENCE_END = re.compile(r"(?<=[.!?])\s+")


def _pack(units: Iterable[str], limit: int) -> Iterator[str]:
    """Join neighbouring units by spaces, as many as fit; a unit is never cut."""
    held = ""
    for unit in units:
        joined = f"{held} {unit}" if held else unit
        if held and len(joined) > limit:
            yield held
            joined = unit
        held = joined
    if held:
        yield held


def _segments(text: str, limit: int) -> Iterator[str]:
    """Runs of sentences that fit are packed; a sentence too long is packed by words, on its own."""
    for too_long, run in groupby(_SENTENCE_END.split(text), key=lambda s: len(s) > limit):
        if too_long:
            for sentence in run:
                yield from _pack(sentence.split(), limit)
        else:
            yield from _pack(run, limit)


def chunk_text(text: str, limit: int = MAX_CHARS, overlap: int = OVERLAP_CHARS) -> list[str]:
    """Chunks of up to ``limit`` characters, each preceded by the end of the one before it."""
    text = text.strip()
    if len(text) <= limit:
        return [text] if text else []
    segments = list(_segments(text, limit))
    return segments[:1] + [f"{a[max(len(a) - overlap, 0):]} {b}".strip() for a, b in pairwise(segments)]


def chunks(c: Column, limit: int = MAX_CHARS, overlap: int = OVERLAP_CHARS) -> Column:
    """Array of the chunks of a text; the whole text is covered."""

    @F.arrow_udf("array<string>")
    def split(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in text_parts(batches):
            yield pa.array([None if t is None else chunk_text(t, limit, overlap) for t in texts], pa.list_(pa.string()))

    return split(c)
