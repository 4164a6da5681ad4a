import public_tokenizers
import pytest
from corpus_texts import docs_of, sentence  # noqa: F401
from starforge.llm import tokencounts

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return tokencounts.unigram_scores(PATH)


def brute(word, pieces, by_byte):
    """Best split by trying all pieces at every position."""
    text = "▁" + word
    best = [(0.0, 0)] + [None] * len(text)
    for end in range(1, len(text) + 1):
        options = []
        for start in range(end):
            piece = text[start:end]
            if piece in pieces:
                options.append((best[start][0] + pieces[piece], -best[start][1] - 1))
        if text[end - 1] not in pieces:
            n = len(text[end - 1].encode())
            options.append((best[end - 1][0] + n * by_byte, -best[end - 1][1] - n))
        score, n = max(options)
        best[end] = (score, -n)
    return best[-1][1]


def test_shared_prefixes_against_brute_force(vocabulary):
    words = ["the", "then", "there", "thereof", "thé", "日本語", "🙂🙂", "a" * 50, "x", "", "Zürich", "don't", "12345"]
    words += sentence(4, 200).split()
    counter = tokencounts.Counter(*vocabulary)
    counter.learn(words)
    assert counter.known == {w: brute(w, *vocabulary) for w in words}


def test_table(docs_of, vocabulary):
    pairs = [(1, "the  then\nthere "), (1, "the  then\nthere "), (2, None), (3, ""), (None, "日本"), (4, sentence(1, 20_000))]
    docs = docs_of(pairs).withColumnRenamed("fp", "n_tokens")
    rows = tokencounts.with_counts(docs, PATH).collect()
    want = [(i, len((t or "").split()), sum(brute(w, *vocabulary) for w in (t or "").split())) for i, t in pairs]
    assert sorted([(r["doc_id"], r["n_pretokens"], r["n_tokens"]) for r in rows], key=str) == sorted(want, key=str)
    assert tokencounts.with_counts(docs_of([]), PATH).count() == 0


def test_full_memory_is_cleared(vocabulary, monkeypatch):
    monkeypatch.setattr(tokencounts, "REMEMBERED", 3)
    counter = tokencounts.Counter(*vocabulary)
    for seed in range(3):
        text = sentence(seed, 9)
        assert counter.counts([text]) == [(9, sum(brute(w, *vocabulary) for w in text.split()))]
