import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from starforge.functions import prose
from starforge.functions.markup import html_text, strip_html
from starforge.operators import text

col = F.col


def run(spark, value, fn):
    return spark.createDataFrame([(value,)], "x string").select(fn(col("x"))).first()[0]


def squeezed(s):
    return re.sub(r"\s+", " ", s).strip()


@pytest.mark.parametrize(
    "markup, expected",
    [
        ("<p>Hi<style>x{}</style> <blockquote>old</blockquote>there</p>", "Hi there"),
        ("<p>a<p>b", "a b"),  # open elements nest
        ("a<br>b<br/>c</br>d", "a b c d"),
        ("<div>a<blockquote>b<p>c</div>d", "a d"),  # an unclosed quote ends with its parent
        ("<blockquote>a<blockquote>b</blockquote>c</blockquote>d", "d"),
        ("a</b>c", "a c"),  # an end tag that closes nothing still parts the text
        ("x &lt;b&gt; &#39;y&#x27; &nope; <i>", "x <b> 'y' &nope"),
        ("a<!-- hidden -->b", "a b"),
        ("<!DOCTYPE html><title>t</title>", "t"),
        ("<template>a</template><ruby>b<rt>c</rt></ruby>", "b"),
        ("<script>if (a < b) { x() }</script>z", "z"),
        ("<p>caf&eacute; &#150; &#8364;</p>", "café – €"),
    ],
)
def test_markup(markup, expected):
    assert squeezed(html_text(markup)) == expected


def test_blank_nodes_shrink():
    assert html_text("<p>a</p>     <p>b</p>") == "a   b"
    assert html_text("<p>a</p>  \n  <p>b</p>") == "a \n b"
    assert html_text("<pre>   </pre>") == "   "


def test_untouched_without_both_brackets(spark):
    assert run(spark, "a &amp; b", strip_html) == "a &amp; b"
    assert run(spark, "1 < 2 &amp;", strip_html) == "1 < 2 &amp;"
    assert run(spark, None, strip_html) is None
    assert run(spark, "<p>a&nbsp;b</p>", prose.clean_text) == "a b"


def test_signatures(spark):
    cut = prose.strip_signature
    assert run(spark, "The export keeps failing. Best regards, Jo", cut) == "The export keeps failing."
    assert run(spark, "Hi there thanks, Jo", cut) == "Hi there thanks, Jo"
    assert run(spark, "It is broken again and again -- Jo thanks, x", cut) == "It is broken again and again"
    # only the first match of each shape counts
    assert run(spark, "Hi, thanks, but it is broken. Cheers, Jo", cut) == "Hi, thanks, but it is broken. Cheers, Jo"
    assert run(spark, "Nothing here to be cut, nothanks, at all", cut) == "Nothing here to be cut, nothanks, at all"


def test_cleaning(spark):
    assert run(spark, "Pls fix it Sent from my iPhone", prose.clean_text) == "Please fix it"
    assert run(spark, "<p>Sent <strong>from</strong> my iPhone, pls</p>", prose.clean_text) == ", please"
    assert run(spark, "ok sent from Yahoo Mail on the go", prose.clean_text) == "ok"


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("My card 4111 1111 1111 1111 ok", "My card [REDACTED_CARD] ok"),
        ("call 555-123-4567 or 555.123.4567!", "call [REDACTED_PHONE] or [REDACTED_PHONE]!"),
        ("jamie.rivera@personalmail.com", "[REDACTED_EMAIL]"),
        ('<a href="mailto:é.x+1@münchen.de">x</a>', '<a href="mailto:[REDACTED_EMAIL]">x</a>'),
        ("é4111111111111111", "é4111111111111111"),  # no word boundary before the number
        ("id 12345678901234567890", "id 12345678901234567890"),
    ],
)
def test_redaction(spark, raw, clean):
    assert run(spark, raw, prose.redact) == clean


# The redaction patterns in Python's own regex dialect.
PYTHON = [r"\b(?:\d[ -]*?){13,16}\b", r"\b\d{3}[-.\s]\d{3}[-.\s]\d{4}\b", r"[\w.+-]+@[\w-]+\.[\w.-]+"]


def test_redaction_agrees_with_python_on_random_text(spark):
    rnd = random.Random(3)
    alphabet = "1234567890" * 4 + " -." * 4 + "aé_@ ٥"
    data = [("".join(rnd.choice(alphabet) for _ in range(60)),) for _ in range(1500)]
    df = spark.createDataFrame(data, "x string")
    for value, got in df.select("x", prose.redact(col("x"))).collect():
        want = value
        for pattern, (_, placeholder) in zip(PYTHON, prose.REDACTIONS):
            want = re.sub(pattern, placeholder, want)
        assert got == want, repr(value)


def test_chunk_limits():
    word = "x" * 401
    assert prose.chunk_text("a" * 400) == ["a" * 400]
    assert prose.chunk_text(word) == [word]
    a, b = "a" * 299 + ".", "b" * 299 + "."
    first, second = prose.chunk_text(f"{a} {b}")
    assert first == a and second == f"{a[-60:]} {b}" and len(second) == 361
    assert prose.chunk_text("  ") == []


def test_chunks_cover_the_whole_text(tables):
    """Without overlap, the chunks in order are the words of the text."""
    docs = tables.documents.select("doc_id", "text")
    plain = text.chunk_column(docs, "doc_id", "text", overlap=0)
    pieces = plain.select(
        "doc_id", F.split_part("chunk_id", F.lit("-"), F.lit(2)).cast("int").alias("n"), "text"
    ).collect()
    words = {}
    for doc, n, piece in sorted(pieces, key=lambda r: (r[0], r[1])):
        words.setdefault(doc, []).extend(piece.split())
        assert len(piece) <= 400 or " " not in piece
    for doc, value in docs.collect():
        assert words.get(doc, []) == value.split()


def by_hand(value, limit=40, overlap=10):
    """Chunks built one sentence at a time."""
    value = value.strip()
    if len(value) <= limit:
        return [value] if value else []
    out, cur = [], []

    def size(parts):
        return sum(map(len, parts)) + len(parts) - 1

    def flush():
        nonlocal cur
        if cur:
            out.append(" ".join(cur))
        cur = []

    for sentence in re.split(r"(?<=[.!?])\s+", value):
        long = len(sentence) > limit
        if long:
            flush()
        for unit in sentence.split() if long else [sentence]:
            if cur and size([*cur, unit]) > limit:
                flush()
            cur.append(unit)
        if long:
            flush()
    flush()
    return [out[0]] + [f"{p[-overlap:]} {c}".strip() for p, c in zip(out, out[1:])]


def test_chunks_agree_with_a_plain_loop():
    rnd = random.Random(1)
    for _ in range(3000):
        words = ["".join(rnd.choice("abc") for _ in range(rnd.choice([1, 3, 8, 45]))) + rnd.choice(["", "", ".", "!"])
                 for _ in range(rnd.randrange(30))]
        value = " ".join(words)
        assert prose.chunk_text(value, 40, 10) == by_hand(value), value


def tickets(spark):
    data = [
        (1, "t1", "s", "", "c", "r"),
        (2, "", "s", "a long enough body", "c", "r"),
        (3, "t3", "s", "<p>asdkjh   </p>", "c", "r"),
        (4, "t4", "Card", "My card 4111 1111 1111 1111 was charged", "c", "mail a@b.org"),
        (5, "t4", "s", "a second copy of the id", "c", None),
        (6, "t3", "s", "its first copy was rejected", "c", None),
        (7, "t7", "s", "nothing personal here", " ", None),
    ]
    return spark.createDataFrame(
        data, "load_id int, ticket_id string, subject string, body string, category string, response string"
    )


def test_validation(spark):
    valid, rejected = text.validate(tickets(spark))
    assert rows(rejected, "load_id", "reason") == [
        (1, "missing_required_field:body"), (2, "missing_required_field:ticket_id"),
        (3, "body_too_short_or_garbled"), (5, "duplicate_ticket_id"), (7, "missing_required_field:category"),
    ]
    assert rows(valid, "load_id", "body", "response", "had_pii") == [
        (4, "My card [REDACTED_CARD] was charged", "mail [REDACTED_EMAIL]", True),
        (6, "its first copy was rejected", "", False),
    ]
    record = rejected.where("load_id = 5").first()["record"]
    assert record == '{"ticket_id":"t4","subject":"s","body":"a second copy of the id","category":"c","response":null}'
    chunked = text.ticket_chunks(valid)
    assert rows(chunked, "chunk_id", "text") == [
        ("t3-0", "s. its first copy was rejected"), ("t4-0", "Card. My card [REDACTED_CARD] was charged"),
    ]
    assert text.multi_chunk(chunked, "ticket_id").count() == 0
