"""A quality classifier: a factorisation machine over hashed words, structure and metadata.

Score of a document with features x: ``w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j``.  The
pairwise part is computed in linear time as half of ``sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2)``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import prepare

col = F.col


@dataclass(frozen=True)
class Settings:
    """``most_rows`` bounds the labelled sample that is fitted on; scoring has no bound."""

    buckets: int = 1 << 14
    factors: int = 8
    most_rows: int = 12_000
    epochs: int = 12
    batch: int = 256
    rate: float = 0.02
    decay: float = 1e-4
    seed: int = 5


_CLASS = np.full(256, 9)
_CLASS[list(b" \t\x0b\x0c\r")] = 0
_CLASS[list(b"\n")] = 1
_CLASS[ord("a") : ord("z") + 1] = 2
_CLASS[ord("A") : ord("Z") + 1] = 3
_CLASS[ord("0") : ord("9") + 1] = 4
_CLASS[list(b".,;:")] = 5
_CLASS[list(b"!?")] = 6
_CLASS[list(b"|/\\<>{}[]=_~^")] = 7
_CLASS[list(b"%$&*#@+")] = 8
# 9: other ASCII, 10: beyond ASCII
_CLASS[128:] = 10
CLASSES = 11
STRUCTURE = CLASSES + 8


def features(text: str | None, n_chars: float | None, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values of a whole text.

    First the hashed words, by the root of their share; then shares of character classes, word
    and line shape and repetition; last the length as metadata.  Empty texts have only those.
    """
    data = (text or "").encode("utf-8", "replace")
    words = data.lower().split()
    n, size = len(words), max(1, len(data))
    hashed = np.fromiter(map(zlib.crc32, words), dtype=np.int64, count=n) % buckets
    found, counts = np.unique(hashed, return_counts=True)
    values = np.sqrt(counts / max(1, n))
    shares = np.bincount(_CLASS[np.frombuffer(data, np.uint8)], minlength=CLASSES) / size
    letters = shares[2] + shares[3]
    lines = data.count(b"\n") + 1
    more = (
        shares[3] / letters if letters else 0.0,
        sum(map(eq, words, words[1:])) / max(1, n - 1),
        len(set(words)) / max(1, n),
        min(2.0, size / max(1, n) / 8),
        min(2.0, n / lines / 40),
        np.log1p(n) / 12,
        float(counts.max()) / n if n else 0.0,
        np.log1p(max(0.0, len(text or "") if n_chars is None else n_chars)) / 14,
    )
    numbers = np.concatenate([found, buckets + np.arange(STRUCTURE)])
    return numbers.astype(np.int32), np.concatenate([values, shares, more]).astype(np.float32)


class Machine:
    """Weights of a factorisation machine; a few hundred KB, whatever the data."""

    def __init__(self, bias: float, w: np.ndarray, v: np.ndarray):
        self.bias, self.w, self.v = bias, w, v

    def margin(self, numbers: np.ndarray, values: np.ndarray, starts: np.ndarray) -> tuple:
        """Margins of several documents, laid end to end, and the factor sums."""
        scaled = self.v[numbers] * values[:, None]
        sums = np.add.reduceat(scaled, starts)
        pairs = 0.5 * (sums**2 - np.add.reduceat(scaled**2, starts)).sum(axis=1)
        return self.bias + np.add.reduceat(self.w[numbers] * values, starts) + pairs, sums

    def score(self, numbers: np.ndarray, values: np.ndarray) -> float:
        return float(_sigmoid(self.margin(numbers, values, np.array([0]))[0][0]))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, s: Settings) -> Machine:
    """Logistic loss, minimised by Adam over small batches in a seeded order."""
    share = labels.mean() if len(labels) else 1.0
    width = s.buckets + STRUCTURE
    rng = np.random.default_rng(s.seed)
    bias = float(np.log(np.clip(share, 1e-6, 1 - 1e-6) / (1 - np.clip(share, 1e-6, 1 - 1e-6))))
    machine = Machine(bias, np.zeros(width), np.zeros((width, s.factors)))
    if share in (0.0, 1.0):
        return machine  # nothing to tell apart
    machine.v = rng.normal(0, 0.02, (width, s.factors))
    moments = [[np.zeros(p.shape) for p in (machine.w, machine.v)] for _ in range(2)]
    t = 0
    for _ in range(s.epochs):
        order = rng.permutation(len(rows))
        for b in range(0, len(order), s.batch):
            some = order[b : b + s.batch]
            lengths = np.array([len(rows[r][0]) for r in some])
            numbers = np.concatenate([rows[r][0] for r in some])
            values = np.concatenate([rows[r][1] for r in some]).astype(np.float64)
            margin, sums = machine.margin(numbers, values, np.concatenate([[0], np.cumsum(lengths)[:-1]]))
            slope = np.repeat((_sigmoid(margin) - labels[some]) / len(some), lengths)
            sums = np.repeat(sums, lengths, axis=0)
            weight = slope * values
            steep = weight[:, None] * (sums - machine.v[numbers] * values[:, None])
            grads = [
                np.bincount(numbers, weight, width) + s.decay * machine.w,
                np.stack([np.bincount(numbers, steep[:, f], width) for f in range(s.factors)], axis=1)
                + s.decay * machine.v,
            ]
            machine.bias -= s.rate * slope[np.concatenate([[0], np.cumsum(lengths)[:-1]])].sum()
            t += 1
            for p, g, m, q in zip((machine.w, machine.v), grads, *moments):
                m += 0.1 * (g - m)
                q += 0.001 * (g * g - q)
                p -= s.rate * (m / (1 - 0.9**t)) / (np.sqrt(q / (1 - 0.999**t)) + 1e-8)
    machine.w, machine.v = machine.w.astype(np.float32), machine.v.astype(np.float32)
    return machine


def held_out(id_: str = "doc_id") -> Column:
    """Whether a document is kept from learning: crc32 of its id as text leaves 2 on division by 4."""
    return F.coalesce(F.crc32(col(id_).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_: str = "doc_id",
    text: str = "text",
    n_chars: str = "n_chars",
    label: str = "quality",
    settings: Settings = Settings(),
) -> Machine:
    """Fit on the ``most_rows`` labelled documents outside the held-out part with the lowest id hashes.

    The label of an id that is labelled twice is the lower one.  Rows without an id or a label
    are left out.  With no rows of one class every score is the share of label 1, or 1 without
    any labelled row.
    """
    prepare(docs.sparkSession)
    known = labels.where(col(id_).isNotNull() & col(label).isNotNull() & ~held_out(id_))
    known = known.groupBy(id_).agg(F.min(label).cast("double").alias("_y"))
    # bounded by most_rows, so it may be broadcast, and its features may come to the driver
    sample = known.orderBy(F.xxhash64(id_), id_).limit(settings.most_rows)
    buckets = settings.buckets
    schema = pa.schema([("y", pa.float64()), ("numbers", pa.list_(pa.int32())), ("x", pa.list_(pa.float32()))])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y, texts, sizes = (c.to_pylist() for c in batch.columns)
            found = [features(t, n, buckets) for t, n in zip(texts, sizes)]
            columns = [pa.array(y, pa.float64()), pa.array([f[0] for f in found], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([f[1] for f in found], pa.list_(pa.float32()))], schema=schema)

    rows = docs.select(id_, text, n_chars).join(F.broadcast(sample), id_)
    rows = rows.select("_y", text, col(n_chars).cast("double").alias("_n"))
    rows = rows.limit(settings.most_rows).mapInArrow(extract, "y double, numbers array<int>, x array<float>").toArrow()
    lists = [rows.column(c).combine_chunks() for c in ("numbers", "x")]
    ends = lists[0].offsets.to_numpy()
    flat = [x.values.to_numpy(zero_copy_only=False) for x in lists]
    found = [(flat[0][a:b], flat[1][a:b]) for a, b in zip(ends, ends[1:])]
    # the order of collected rows is not fixed
    order = sorted(range(len(found)), key=lambda r: (found[r][0].tobytes(), found[r][1].tobytes()))
    y = rows.column("y").to_numpy()
    return fit([found[r] for r in order], y[order] if len(order) else y, settings)


def scored(
    docs: DataFrame, machine: Machine, text: str = "text", n_chars: str = "n_chars", name: str = "score", buckets: int = 1 << 14
) -> DataFrame:
    """``docs`` with the chance of label 1 for every whole text, null and empty ones too.

    Repeated rows get equal scores, a null length counts as the text's own, and other columns
    are kept; the column ``name`` is replaced.  A text of any length is read whole, in time linear in
    it.  An empty table stays empty.  There is no shuffle.
    """
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    @F.arrow_udf("double")
    def score(texts: pa.Array, sizes: pa.Array) -> pa.Array:
        m = shared.value
        return pa.array([m.score(*features(t.as_py(), n, buckets)) for t, n in zip(texts, sizes.to_pylist())], pa.float64())

    return docs.withColumn(name, score(col(text), col(n_chars).cast("double")))
