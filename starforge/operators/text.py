"""Validating tickets and turning them into chunks of clean text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starforge.functions.columns import strip_spaces
from starforge.functions.markup import has_markup, strip_html
from starforge.functions.prose import MAX_CHARS, OVERLAP_CHARS, chunks, clean_text, combine, had_pii, redact
from starforge.operators.quality import with_reason
from starforge.session import cut_lineage

col = F.col

# The fields a ticket needs, and the shortest body.
REQUIRED = ("ticket_id", "body", "category")
MIN_BODY = 8


def is_blank(c: Column) -> Column:
    return c.isNull() | (strip_spaces(c) == "")


def missing_field(fields: Sequence[str] = REQUIRED) -> list[tuple[str, Column]]:
    """Rules that report the first field without content."""
    return [(f"missing_required_field:{f}", is_blank(col(f))) for f in fields]


def too_short(c: Column, n: int = MIN_BODY) -> Column:
    """Fewer than ``n`` characters remain without markup and outer white space."""
    return F.length(strip_spaces(strip_html(c))) < n


def with_duplicates(checked: DataFrame, key: str, row_id: str, name: str = "reason") -> DataFrame:
    """Mark every row after the first that has no other reason and the same key.

    The first rows are found by a reduction and matched by their unique id, so many copies
    of one key do not meet in one task.
    """
    first = checked.where(col(name).isNull()).groupBy(key).agg(F.min(row_id).alias(row_id))
    marked = checked.join(first.select(row_id, F.lit(True).alias("_first")), row_id, "left")
    reason = F.when(col(name).isNull() & col("_first").isNull(), "duplicate_ticket_id").otherwise(col(name))
    return marked.withColumn(name, reason).drop("_first")


def rejection_reasons(tickets: DataFrame, key: str = "ticket_id", row_id: str = "load_id") -> DataFrame:
    """(row id, reason); the checks run in order and the first that fails counts."""
    rules = [*missing_field(), ("body_too_short_or_garbled", too_short(col("body")))]
    checked = with_reason(tickets, rules).select(row_id, key, "reason")
    # the checks parse markup; their outcome is stored, so that they run once
    return with_duplicates(cut_lineage(checked), key, row_id).select(row_id, "reason")


def validate(tickets: DataFrame, redacted: Sequence[str] = ("body", "response")) -> tuple[DataFrame, DataFrame]:
    """Valid tickets with personal data redacted, and rejected ones as (reason, record)."""
    judged = tickets.join(rejection_reasons(tickets), "load_id")
    valid = judged.where(col("reason").isNull()).drop("reason")
    clean = {f"_c_{c}": redact(F.coalesce(col(c), F.lit(""))) for c in redacted}
    valid = valid.withColumns(clean)
    changed = F.lit(False)
    for c in redacted:
        changed = changed | had_pii(F.coalesce(col(c), F.lit("")), col(f"_c_{c}"))
    valid = valid.withColumn("had_pii", changed)
    for c in redacted:
        valid = valid.withColumn(c, col(f"_c_{c}")).drop(f"_c_{c}")
    record = F.to_json(F.struct(*[c for c in tickets.columns if c != "load_id"]), {"ignoreNullFields": "false"})
    rejected = judged.where(col("reason").isNotNull()).select("load_id", "reason", record.alias("record"))
    return valid, rejected


def ticket_chunks(valid: DataFrame, limit: int = MAX_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """Chunks of subject and body, numbered from 0 within the ticket; the rest goes with each."""

    def cleaned(name: str) -> Column:
        return clean_text(F.coalesce(col(name), F.lit("")))

    prepared = valid.select(
        "ticket_id",
        *[c for c in ("category", "created_at") if c in valid.columns],
        has_markup(F.coalesce(col("body"), F.lit(""))).alias("had_html"),
        combine(cleaned("subject"), cleaned("body")).alias("text"),
        cleaned("response").alias("response"),
    )
    return chunk_column(prepared, "ticket_id", "text", limit, overlap)


def chunk_column(df: DataFrame, key: str, text: str, limit: int = MAX_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """One row per chunk of ``text``, with ``chunk_id`` = key and position."""
    rest = [c for c in df.columns if c != text]
    exploded = df.select(*rest, F.posexplode(chunks(col(text), limit, overlap)).alias("_pos", text))
    return exploded.select(F.concat_ws("-", col(key), col("_pos")).alias("chunk_id"), *rest, text)


def multi_chunk(chunked: DataFrame, key: str) -> DataFrame:
    """Records that were split, with their number of chunks."""
    return chunked.groupBy(key).agg(F.count(F.lit(1)).alias("n_chunks")).where(col("n_chunks") > 1)
