"""Results of checks over a table that grows by partitions, from what is stored of each partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starforge.operators import quality
from starforge.operators.quality import KeyCheck, Rule
from starforge.sources.tables import Staging

col = F.col


class CheckState:
    """Counts of the rows that break a rule, and of the values of keys and references, per partition.

    A partition is read once, when it is added; adding it again replaces what was stored of it.
    Results come from adding up the counts, so neither old partitions nor parents whose keys are
    kept in a state of their own are read again.
    """

    def __init__(self, spark: SparkSession, path: str, rules: Sequence[Rule] = (), keys: Sequence[KeyCheck] = ()):
        self.rules, self.keys = list(rules), list(keys)
        long, text = T.LongType(), T.StringType()
        broken = T.StructType([T.StructField("check", text), T.StructField("n_bad", long), T.StructField("n_rows", long)])
        counted = T.StructType([T.StructField("check", text), T.StructField("value", text), T.StructField("n", long)])
        self.broken, self.counted = Staging(spark, f"{path}/rules", broken), Staging(spark, f"{path}/keys", counted)

    def add(self, rows: DataFrame, part: str) -> None:
        """Count a partition: one pass for the rules, one for keys and references."""
        if self.rules:
            counts = [(F.count(F.lit(1)) if r.at_least is not None else r.failures()).cast("bigint").alias(f"_{i}") for i, r in enumerate(self.rules)]
            found = rows.agg(F.count(F.lit(1)).alias("n_rows"), *counts)
            each = F.array(*[F.struct(F.lit(r.name).alias("check"), col(f"_{i}").alias("n_bad"), "n_rows") for i, r in enumerate(self.rules)])
            self.broken.replace_batch(found.select(F.inline(each)), part)
        if self.keys:
            names = F.array(*[F.lit(c.name) for c in self.keys])
            counted = quality.counted_keys(rows, self.keys).select(names[col("i")].alias("check"), "value", "n")
            self.counted.replace_batch(counted, part)

    def drop(self, part: str) -> None:
        """Forget a partition."""
        self.broken.drop_batch(part)
        self.counted.drop_batch(part)

    def values(self, check: str) -> DataFrame:
        """(value): the values that a key check has met, as a parent of references."""
        return self.counted.read().where(col("check") == check).select("value").distinct()

    def results(self) -> DataFrame:
        """(check, passed, n_bad), as the checks of the whole table give."""
        parts = []
        if self.rules:
            totals = self.broken.read().groupBy("check").agg(F.sum("n_bad").alias("bad"), F.sum("n_rows").alias("n_rows"))
            known = self.broken.spark.createDataFrame([(r.name, r.at_least) for r in self.rules], "check string, least long")
            found = known.join(totals, "check", "left")
            short = F.greatest(col("least") - F.coalesce("n_rows", F.lit(0)), F.lit(0))
            bad = F.when(col("least").isNotNull(), short).otherwise(F.coalesce("bad", F.lit(0)))
            parts.append(found.select("check", (bad == 0).alias("passed"), bad.alias("n_bad")))
        if self.keys:
            number = F.create_map(*[x for i, c in enumerate(self.keys) for x in (F.lit(c.name), F.lit(i))])
            used = self.counted.read().groupBy(number[col("check")].alias("i"), "value").agg(F.sum("n").alias("n"))
            parts.append(quality.judged_keys(used.where(col("i").isNotNull()), self.keys))
        return quality.union_all(parts)
