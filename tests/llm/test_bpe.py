import json
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from starforge.llm import bpe
from tokenizers import Tokenizer

from corpus_texts import docs_of, sentence  # noqa: F401

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return bpe.WordBpe(bpe.definition(PATH))


def ids(own, text):
    return np.frombuffer(own.encode([text])[0], dtype=np.int32).tolist()


TEXTS = [
    "Hello  World's 123 don't café ﬁ İ K \n\t",
    "<|startoftext|>hi<|endoftext|>x <|EndOfText|> <",
    "ΑΣ ΣΑΣ straße 日本語テスト 🙂 a_b ½²",
    "a" * 500 + " " + "xyz" * 300 + "é" * 90,
    "\x1c\x85a\x85b\x1f​ c　d",
    "é ́x 가",
    "don't WE'LL 12ab! ?!.. x.y",
    "",
    "   ",
]


@pytest.mark.parametrize("text", TEXTS)
def test_same_as_the_library(library, own, text):
    want = library.encode(text, add_special_tokens=False).ids
    assert ids(own, text) == want
    assert bpe.decode(want, bpe.token_names(bpe.definition(PATH))) == library.decode(want, skip_special_tokens=False)


def test_random_characters(library, own):
    rng = random.Random(2)
    plain = [*range(1, 0x250), *range(0x370, 0x400), 0x4E00, 0x1F600, 0x300, 0x301, 0xAC00]
    for _ in range(300):
        text = "".join(chr(rng.choice(plain)) for _ in range(40))
        assert ids(own, text) == library.encode(text, add_special_tokens=False).ids


def test_every_code_point(library, own):
    """Alone, between letters and before a digit, also where Unicode has grown since this Python."""
    codes = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x33500 or c % 61 == 0 or 0xE0000 <= c < 0xE0200)]
    for start in range(0, len(codes), 2000):
        text = " ".join(f"{chr(c)} a{chr(c)}b {chr(c)}1" for c in codes[start : start + 2000])
        want = library.encode(text, add_special_tokens=False).ids
        if ids(own, text) != want:
            wrong = [hex(c) for c in codes[start : start + 2000] if ids(own, f"a{chr(c)}b") != library.encode(f"a{chr(c)}b", add_special_tokens=False).ids]
            raise AssertionError(wrong[:20])


def test_random_texts_of_all_of_unicode(library, own):
    rng = random.Random(5)
    news = [c for first, last in (*bpe.NEW_LETTERS, *bpe.NEW_DIGITS, *bpe.NEW_MARKS, (0x11935, 0x11938)) for c in range(first, last + 1)] + list(bpe.NEW_LOWER)
    for _ in range(2000):
        pool = [rng.randrange(1, 0xD800), rng.randrange(0xE000, 0x33500), rng.choice(news), rng.choice(news), 0x20, 0x27, 0x73, 0x301, 0x327]
        text = "".join(chr(rng.choice(pool)) for _ in range(30))
        assert ids(own, text) == library.encode(text, add_special_tokens=False).ids, text


def test_a_very_long_word_and_small_caches(library, own, monkeypatch):
    rng = random.Random(6)
    text = "".join(rng.choices("abcdeé", k=200_000)) + " tail"
    assert ids(own, text) == library.encode(text, add_special_tokens=False).ids
    monkeypatch.setattr(bpe, "REMEMBERED", 300)
    monkeypatch.setattr(bpe, "TOGETHER", 50)
    small = bpe.WordBpe(bpe.definition(PATH))
    texts = [sentence(k, 12) for k in range(60)] + [None, ""]
    got = [np.frombuffer(b, dtype=np.int32).tolist() for b in small.encode(texts)]
    assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert small.held < 5000 and small.pieces_held < 5000


def test_rows_and_heap_agree(own):
    rng = random.Random(3)
    words = ["".join(rng.choices("etaoinshr", k=rng.randint(1, 32))).encode() for _ in range(400)]
    for word, short in zip(words, own._short(words)):
        symbols = own.inner[np.frombuffer(word, np.uint8)].tolist()
        symbols[-1] = int(own.last[word[-1]])
        assert np.frombuffer(short, dtype=np.int32).tolist() == own._heap(symbols)


def test_full_memory_is_cleared(own, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    text = sentence(1, 60)
    assert ids(own, text) == library.encode(text, add_special_tokens=False).ids


def test_table(docs_of, library):
    pairs = [(1, "One text"), (1, "One text"), (2, None), (3, ""), (None, "x y"), (4, sentence(5, 20_000))]
    docs = docs_of(pairs).withColumn("ids", F.lit("taken"))
    rows = bpe.decoded(bpe.encoded(docs, PATH), PATH).collect()
    want = [library.encode(t or "", add_special_tokens=False).ids for _, t in pairs]
    assert sorted(map(str, [r["ids"] for r in rows])) == sorted(map(str, want))
    assert sorted(r["decoded"] for r in rows) == sorted(library.decode(w, skip_special_tokens=False) for w in want)
    assert {r["_r1"] for r in rows} == {1}
    assert bpe.encoded(docs_of([]), PATH).count() == 0


def test_definition_is_checked():
    with pytest.raises(ValueError):
        bpe.WordBpe(json.dumps({"added_tokens": [], "model": {"type": "WordPiece", "vocab": {}, "end_of_word_suffix": None}}))
