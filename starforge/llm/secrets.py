"""Secret scans: known patterns, and strings that a battery of randomness tests takes for random.

A string that could be a key is read in the encoding its characters suggest.  Three statistics
are compared with what structured text (words, names, paths) at the edge of looking random would
give: the chi-squared statistic of uniform use of the alphabet, the runs of character classes,
and the serial correlation of the symbols.  Their standard scores are combined, and among all
strings of similar length of the whole table a bound on the share of false discoveries decides.
Built-in functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import let, prefix_sums, ranks, stored

col = F.col

# The kinds in the order in which spans of one start are listed.
KINDS = ["assign", "access", "hex", "random"]

# The base patterns, and what a match must have to count.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]+"
ACCESS_LENGTH = 20
HEX_LENGTH = 24
# A run is as long as it can be, so asking for the length at once gives the same matches.
HEX = rf"[0-9a-f]{{{HEX_LENGTH},}}"

# Strings the battery looks at.
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
# Chance that two letters of words are equal, in the languages at hand; a text's alphabet is used unevenly.
COINCIDENCE = 0.065
# Correlation of neighbouring symbols from which a string counts as structured.
CORRELATION = 0.5
# Accepted share of false discoveries.
FALSE_SHARE = 0.01
# Scores are counted in steps of this width.
STEP = 0.05

_SPAN = "struct<start:int,kind:int,stop:int>"


def _matches(text: Column, pattern: str, keep=None, group: int = 0) -> Column:
    """(start, stop, value) of the leftmost non-overlapping matches, in code points.

    The pieces between matches give the places.
    """

    def places(found: Column) -> Column:
        pieces, hits, values = found["pieces"], found["hits"], found["values"]
        both = F.transform(
            hits, lambda h, i: F.struct(F.char_length(pieces[i]).alias("gap"), F.char_length(h).alias("size"))
        )

        def placed(b: Column) -> Column:
            def with_ends(before: Column) -> Column:
                def at(x: Column, i: Column) -> Column:
                    start = (before[i] + x["gap"]).cast("int")
                    return F.struct(start.alias("start"), (start + x["size"]).alias("stop"), values[i].alias("value"))

                return F.transform(b, at)

            return let(prefix_sums(F.transform(b, lambda x: x["gap"] + x["size"])), with_ends)

        out = let(both, placed)
        return out if keep is None else F.filter(out, keep)

    found = F.struct(
        F.split(text, pattern, -1).alias("pieces"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("values"),
    )
    empty = F.array().cast("array<struct<start:int,stop:int,value:string>>")
    return F.when(text.rlike(pattern), let(found, places)).otherwise(empty)


def _spans(matches: Column, kind: int) -> Column:
    return F.transform(matches, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["stop"].alias("stop")))


def base_spans(text: Column) -> Column:
    """Spans of the known patterns, ordered by start and kind."""
    assign = _matches(text, ASSIGN, lambda m: F.char_length(m["value"]) >= ASSIGN_VALUE, 2)
    access = _matches(text, ACCESS, lambda m: m["stop"] - m["start"] >= ACCESS_LENGTH)
    found = [_spans(m, k) for k, m in enumerate((assign, access, _matches(text, HEX)))]
    return F.array_sort(F.concat(*found)).cast(f"array<{_SPAN}>")


# --------------------------------------------------------------------------- the battery

# Encodings, narrowest first, with what their strings consist of, the size of
# their alphabet, and the chance that neighbouring symbols of a random string differ in class.
ENCODINGS = [
    ("decimal", "^[0-9]+$", 10, 0.5),
    ("hex", "^([0-9a-f]+|[0-9A-F]+)$", 16, 1 - (10 / 16) ** 2 - (6 / 16) ** 2),
    ("base32", "^[A-Z2-7]+$", 32, 1 - (26 / 32) ** 2 - (6 / 32) ** 2),
    ("base36", "^([0-9a-z]+|[0-9A-Z]+)$", 36, 1 - (26 / 36) ** 2 - (10 / 36) ** 2),
    ("base62", "^[0-9A-Za-z]+$", 62, 1 - 2 * (26 / 62) ** 2 - (10 / 62) ** 2),
    ("base64", "", 64, 1 - 2 * (26 / 64) ** 2 - (10 / 64) ** 2 - (2 / 64) ** 2),
]


def _encoding(token: Column, value) -> Column:
    out = F.lit(value(ENCODINGS[-1]))
    for e in reversed(ENCODINGS[:-1]):
        out = F.when(token.rlike(e[1]), F.lit(value(e))).otherwise(out)
    return out


def _class(code: Column, decimal: Column) -> Column:
    """Digit, capital, small letter or sign; for decimal strings the lower or upper half."""
    kind = F.when(code < 58, F.when(code < 48, 3).otherwise(0)).when((code >= 65) & (code <= 90), 1)
    kind = kind.when((code >= 97) & (code <= 122), 2).otherwise(3)
    return F.when(decimal, F.when(code >= 53, 1).otherwise(0)).otherwise(kind)


def battery(token: Column) -> Column:
    """Combined standard score of a string: high if all three tests find it more random than text can be."""
    bare = F.rtrim(token, F.lit("="))

    def scores(x: Column) -> Column:
        codes, size, change = x["codes"], x["size"], x["change"]
        n = F.size(codes).cast("double")
        # uniform use of the alphabet, against the unevenness of words
        squares = F.aggregate(
            F.array_distinct(codes),
            F.lit(0.0),
            lambda s, c: s + F.pow(F.size(F.filter(codes, lambda d: d == c)).cast("double"), F.lit(2.0)),
        )
        chi = squares * size / n - n
        df, uneven = size - 1, n * F.greatest(size * COINCIDENCE - 1, F.lit(0.5))
        scale, free = (df + 2 * uneven) / (df + uneven), F.pow(df + uneven, F.lit(2.0)) / (df + 2 * uneven)
        root = F.pow(F.greatest(chi, F.lit(0.0)) / (scale * free), F.lit(1 / 3))
        z_chi = (1 - 2 / (9 * free) - root) / F.sqrt(2 / (9 * free))
        # runs: changes of class, against half as many as a random string has
        classes = F.transform(codes, lambda c: _class(c, size == 10))
        changes = F.aggregate(
            F.transform(classes, lambda c, i: F.when((i > 0) & (c != classes[F.greatest(i - 1, F.lit(0))]), 1).otherwise(0)),
            F.lit(0),
            lambda s, c: s + c,
        )
        half = change / 2
        z_runs = (changes - (n - 1) * half) / F.sqrt((n - 1) * half * (1 - half))
        # serial correlation of neighbouring symbols
        mean = F.aggregate(codes, F.lit(0.0), lambda s, c: s + c) / n
        spread = F.aggregate(codes, F.lit(0.0), lambda s, c: s + (c - mean) * (c - mean))
        along = F.aggregate(
            F.transform(
                codes,
                lambda c, i: F.when(i > 0, (c - mean) * (codes[F.greatest(i - 1, F.lit(0))] - mean)).otherwise(F.lit(0.0)),
            ),
            F.lit(0.0),
            lambda s, c: s + c,
        )
        r = F.when(spread > 0, F.abs(along / spread)).otherwise(F.lit(1.0))
        z_serial = (CORRELATION - r) * F.sqrt(n - 1)
        return (z_chi + z_runs + z_serial) / math.sqrt(3)

    symbols = F.filter(F.split(bare, ""), lambda c: c != "")
    start = F.struct(
        F.transform(symbols, lambda c: F.ascii(c)).alias("codes"),
        _encoding(bare, lambda e: float(e[2])).alias("size"),
        _encoding(bare, lambda e: float(e[3])).alias("change"),
    )
    return let(start, scores)


def upper_tail(z: Column) -> Column:
    """Chance of a standard normal value above ``z``, by a closed bound that is tight for large ``z``."""
    positive = F.abs(z)
    tail = math.sqrt(2 / math.pi) * F.exp(-positive * positive / 2) / (positive + F.sqrt(positive * positive + 8 / math.pi))
    return F.when(z >= 0, tail).otherwise(1 - tail)


def candidates(text: Column, base: Column) -> Column:
    """Strings for the battery outside the base spans: start, stop, length class and score in steps."""

    def free_of(found: Column) -> Column:
        # spans that overlap a match: those that start before its end, less those that end before its start
        started = ranks(F.transform(base, lambda b: b["start"]), F.transform(found, lambda m: m["stop"]), inclusive=False)
        ended = ranks(F.transform(base, lambda b: b["stop"]), F.transform(found, lambda m: m["start"]), inclusive=True)
        pairs = F.arrays_zip(started.alias("started"), ended.alias("ended"))
        return let(pairs, lambda p: F.filter(found, lambda m, i: p[i]["started"] == p[i]["ended"]))

    found = _matches(text, CANDIDATE)
    return F.transform(
        let(found, lambda m: F.when((F.size(base) > 0) & (F.size(m) > 0), free_of(m)).otherwise(m)),
        lambda m: F.struct(
            m["start"].alias("start"),
            m["stop"].alias("stop"),
            F.floor(F.log2(F.char_length(m["value"]))).cast("int").alias("long"),
            F.floor(battery(m["value"]) / STEP).cast("int").alias("score"),
        ),
    )


def thresholds(found: DataFrame, false_share: float) -> DataFrame:
    """(long, score): the lowest score that counts for each length class (Benjamini and Hochberg).

    Candidates of the whole table are counted by length class and score, so what is sorted is a
    table of scores, not of strings.
    """
    counts = found.select(F.explode("cands").alias("c")).groupBy("c.long", "c.score").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.groupBy("long").agg(F.collect_list(F.struct("score", "n")).alias("steps"), F.sum("n").alias("total"))
    step = counts.select("long", "total", "steps", F.explode("steps").alias("s"))
    above = F.aggregate(
        F.filter("steps", lambda x: x["score"] >= col("s.score")), F.lit(0).cast("bigint"), lambda a, x: a + x["n"]
    )
    passes = upper_tail(col("s.score") * STEP) * col("total") <= false_share * above
    return step.where(passes & (col("s.score") > 0)).groupBy("long").agg(F.min("s.score").alias("score"))


def scan(
    docs: DataFrame, text: str = "text", keep: list[str] | None = None, false_share: float = FALSE_SHARE
) -> DataFrame:
    """The columns ``keep`` (all but the text) with ``base`` and ``spans`` (start, kind, stop) per row.

    Columns of these two names are replaced.

    Spans count in code points, stops are exclusive, kinds are numbers in :data:`KINDS`.  Null and
    empty texts have no spans; repeated rows get equal ones; an empty table gives an empty result.  A
    text of any length is read whole, and takes time linear in its matches but for a sort of them.
    The text is read once: spans and scored candidates are stored, then the bound is taken from
    the counts of all candidates, at most a few thousand.
    """
    kept = [c for c in docs.columns if c != text] if keep is None else keep
    kept = [c for c in kept if c not in ("base", "spans")]
    plain = docs.select(F.struct(*kept).alias("kept"), F.coalesce(text, F.lit("")).alias("text"))
    found = plain.withColumn("base", base_spans(col("text")))
    found = found.select("kept", "base", candidates(col("text"), col("base")).alias("cands"))
    found = stored(found, "candidates")
    # one row per length class, of which there are about thirty
    bounds = {r["long"]: r["score"] for r in thresholds(found, false_share).collect()}
    accepted = F.lit(False)
    random = F.array().cast(f"array<{_SPAN}>")
    if bounds:
        least = F.create_map(*[F.lit(x) for pair in bounds.items() for x in pair])
        accepted = F.filter("cands", lambda c: F.coalesce(c["score"] >= least[c["long"]], F.lit(False)))
        random = _spans(accepted, KINDS.index("random")).cast(f"array<{_SPAN}>")
    return found.select("kept.*", "base", F.array_sort(F.concat("base", random)).alias("spans"))


def as_text(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["stop"].cast("string"))), ","
    )


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


# Code points of a text that are put together at a time.
PIECE = 4096


def merged(spans: Column) -> Column:
    """(start, stop) of overlapping spans together, in order; spans that only touch stay apart."""
    events = F.sort_array(
        F.concat(
            F.transform(spans, lambda s: F.struct(s["start"].alias("at"), F.lit(1).alias("opens"))),
            F.transform(spans, lambda s: F.struct(s["stop"].alias("at"), F.lit(0).alias("opens"))),
        )
    )

    def cover(e: Column) -> Column:
        depth = prefix_sums(F.transform(e, lambda x: 2 * x["opens"] - 1))
        both = F.zip_with(e, depth, lambda x, d: F.struct(x["at"].alias("at"), x["opens"].alias("opens"), d.alias("depth")))

        def ends(x: Column) -> Column:
            starts = F.filter(x, lambda y: (y["opens"] == 1) & (y["depth"] == 0))
            stops = F.filter(x, lambda y: (y["opens"] == 0) & (y["depth"] == 1))
            return F.zip_with(starts, stops, lambda a, b: F.struct(a["at"].alias("start"), b["at"].alias("stop")))

        return let(both, ends)

    return let(events, cover)


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with every span, overlapping ones together, replaced by ``mark``.

    The text is cut into pieces of :data:`PIECE` code points, and each is put together from what lies
    between its own spans, so a long text with many spans takes time linear in both.
    """

    def one(piece: Column, first: Column, own: Column) -> Column:
        """A piece that starts at ``first``; a span has its mark where it starts."""

        def step(done: Column, s: Column) -> Column:
            start, stop = s["start"] - first, s["stop"] - first
            gap = F.substring(piece, done["at"] + 1, F.greatest(start - done["at"], F.lit(0)))
            out = F.concat(done["out"], gap, F.when(start >= 0, F.lit(mark)).otherwise(""))
            return F.struct(F.greatest(done["at"], stop).alias("at"), out.alias("out"))

        begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
        return F.aggregate(own, begin, step, lambda done: F.concat(done["out"], F.substring(piece, done["at"] + 1, PIECE)))

    def joined(x: Column) -> Column:
        pieces, spans = x["pieces"], x["spans"]
        edges = F.transform(pieces, lambda p, j: j * PIECE)

        def put(r: Column) -> Column:
            def piece(p: Column, j: Column) -> Column:
                return one(p, j * PIECE, F.slice(spans, r[j]["ended"].cast("int") + 1, (r[j]["started"] - r[j]["ended"]).cast("int")))

            return F.array_join(F.transform(pieces, piece), "")

        ended = ranks(F.transform(spans, lambda s: s["stop"]), edges, inclusive=True)
        started = ranks(F.transform(spans, lambda s: s["start"]), F.transform(edges, lambda e: e + PIECE), inclusive=False)
        return let(F.arrays_zip(ended.alias("ended"), started.alias("started")), put)

    whole = F.struct(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)).alias("pieces"), merged(spans).alias("spans"))
    return F.when(F.size(spans) > 0, let(whole, joined)).otherwise(text)
