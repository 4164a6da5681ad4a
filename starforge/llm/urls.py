"""URL filter: the longest rule whose host and path a url falls under.

A rule names a host, with all its subdomains, and the start of a path.  Its key is the host with
its labels reversed, a separator, and the path, so the keys it covers form an interval that
starts at it.  Keys and rules are sorted together over all tasks and swept once; a stack holds
the rules whose interval is open, nested in each other, and its top is the longest match.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starforge.llm.common import prepare, stored

col = F.col

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Below every character of a host or path that a sort could confuse with it.
_END_OF_HOST = "\x00"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)
    return F.translate(host, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without a host part."""
    return F.regexp_extract(F.regexp_replace(_after_scheme(url), "^[^/?#]*", ""), "^[^?#]*", 0)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))


def _reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, "\\.")), ".")


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Longest rule per key; rows come sorted by part and key, rules before equal keys."""
    part, open_ = None, []
    for batch in batches:
        keys, rules = [], []
        for p, key, rule in zip(*(c.to_pylist() for c in batch.columns)):
            if p != part:
                part, open_ = p, []
            while open_ and not key.startswith(open_[-1][0]):
                open_.pop()
            if rule is not None:
                open_.append((key, rule))
            elif open_:
                keys.append(key)
                rules.append(open_[-1][1])
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(rules, pa.string())], ["key", "found"])


def longest_prefixes(keys: DataFrame, rules: DataFrame) -> DataFrame:
    """(key, found): the longest ``prefix`` of ``rules`` that each distinct ``key`` starts with, if any.

    The range partitions are stored with their number.  Rules opened in earlier partitions are
    prefixes of a partition's first key, so they are joined on those few and added to it.
    """
    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    none = F.lit(None).cast("string")
    rules = rules.select(col("prefix").alias("key")).distinct()
    events = keys.select("key", none.alias("rule")).unionByName(rules.select("key", col("key").alias("rule")))
    placed = stored(events.repartitionByRange(n, "key").withColumn("part", F.spark_partition_id()), "sorted-keys")
    first = placed.groupBy("part").agg(F.min("key").alias("first"))
    starts = first.select(
        "part", F.explode(F.transform(F.sequence(F.lit(0), F.char_length("first")), lambda i: F.left(col("first"), i))).alias("key")
    )
    starts = starts.join(first.select("part", "first"), "part").where(col("key") != col("first")).drop("first")
    carried = starts.join(rules, "key").select("part", "key", col("key").alias("rule"))
    events = placed.unionByName(carried).select("part", "key", "rule").repartition("part")
    events = events.sortWithinPartitions("part", "key", col("rule").asc_nulls_last())
    return events.mapInArrow(_sweep, "key string, found string")


def judged(pages: DataFrame, rules: DataFrame, url: str = "url", otherwise: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict of every url.

    ``rules`` has host, path and verdict.  The rule with the longest host and path together
    wins, the longer host among equals, and block where a rule is listed with both verdicts; a
    rule without a host fits every host.  Where none fits, ``rule`` is null and the verdict is
    ``otherwise``.  A null url, or one without ``://``, has an empty host and path.  Rows are
    kept with their other columns, repeated ones too; columns named host, path, rule or verdict
    are replaced; an empty table stays empty.

    Urls are reduced to the parts that rules can tell apart before they are swept, so a host
    with very many pages is swept once.
    """
    prepare(pages.sparkSession)
    cleaned = F.struct(
        F.coalesce(col("host"), F.lit("")).alias("host"), F.coalesce(col("path"), F.lit("")).alias("path"), "verdict"
    )
    own = rules.select(cleaned.alias("r")).select("r.*")
    own = own.withColumn("prefix", F.concat(_reversed_host(col("host")), F.lit(_END_OF_HOST), col("path")))
    own = own.groupBy("prefix", "host", "path").agg(F.max("verdict").alias("verdict"))  # block is the larger word
    labels = F.when(col("host") == "", 0).otherwise(F.size(F.split("host", "\\.")))
    deepest, longest = own.agg(F.max(labels), F.max(F.char_length("path"))).first()
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    rows = pages.select(F.struct(*kept).alias("page"), host_of(col(url)).alias("host"), path_of(col(url)).alias("path"))
    rows = rows.withColumn("_start", F.left(col("path"), F.lit(longest or 0)))
    # the last labels are all that rules can ask for
    tail = F.array_join(F.slice(F.reverse(F.split("host", "\\.")), 1, max(1, deepest or 0)), ".")
    rows = rows.withColumn("_tail", tail)
    seen = rows.select("_tail", "_start").distinct()
    parts = F.split("_tail", "\\.")
    hosts = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "."))
    keyed = seen.withColumn("_host", F.explode(F.array_distinct(hosts)))
    keyed = keyed.withColumn("key", F.concat("_host", F.lit(_END_OF_HOST), "_start"))
    found = longest_prefixes(keyed.select("key").distinct(), own)
    found = found.join(own, col("found") == col("prefix")).select(
        "key", (F.char_length("host") + F.char_length("path")).alias("size"), F.char_length("host").alias("depth"), "host", "path", "verdict"
    )
    best = keyed.join(found, "key").groupBy("_tail", "_start").agg(F.max(F.struct("size", "depth", "host", "path", "verdict")).alias("b"))
    best = best.select("_tail", "_start", F.concat("b.host", "b.path").alias("rule"), col("b.verdict").alias("verdict"))
    out = rows.join(best, ["_tail", "_start"], "left")
    return out.select("page.*", "host", "path", "rule", F.coalesce("verdict", F.lit(otherwise)).alias("verdict"))
