"""Text queries: validation, redaction, cleaning and chunking."""

from pyspark.sql import functions as F

from starforge.functions import prose
from starforge.functions.markup import has_markup, strip_html
from starforge.operators import text
from starforge.plans.registry import query

col = F.col

_REASON = """CASE WHEN ticket_id IS NULL OR trim(ticket_id) = '' THEN 'missing_required_field:ticket_id'
    WHEN body IS NULL OR regexp_replace(body, '[\\s\\v\\p{Z}]', '', 'g') = '' THEN 'missing_required_field:body'
    WHEN category IS NULL OR trim(category) = '' THEN 'missing_required_field:category' END"""


@query("txt_1", f"SELECT load_id, {_REASON} AS reason FROM tickets")
def txt_1(t):
    return text.with_reason(t.tickets, text.missing_field()).select("load_id", "reason")


_WS = "[\\s\\v\\p{Z}]"


def _strip(sql: str) -> str:
    return f"regexp_replace({sql}, '^{_WS}+|{_WS}+$', '', 'g')"


def _chunks(source: str, key: str) -> str:
    """Check side of chunking: CTEs that fold the sentences of ``source.text`` into ``chunked``."""
    return f"""
    stripped AS (SELECT {key}, {_strip('text')} AS t FROM {source}),
    sentences AS (SELECT {key}, t,
        string_split(regexp_replace(t, '([.!?]){_WS}+', '\\1' || chr(1), 'g'), chr(1)) AS s FROM stripped),
    units AS (SELECT {key}, t, flatten(list_transform(s, lambda x, i:
        CASE WHEN length(x) <= 400 THEN [{{'done': CAST([] AS VARCHAR[]), 'cur': x, 'run': CAST(0 AS BIGINT)}}]
             ELSE list_transform(string_split_regex(x, '{_WS}+'),
                                 lambda w: {{'done': CAST([] AS VARCHAR[]), 'cur': w, 'run': CAST(i AS BIGINT)}}) END)) AS u
        FROM sentences),
    folded AS (SELECT {key}, t, list_reduce(u, lambda a, x:
        CASE WHEN a.run = x.run AND length(a.cur) + 1 + length(x.cur) <= 400
             THEN {{'done': a.done, 'cur': a.cur || ' ' || x.cur, 'run': a.run}}
             ELSE {{'done': list_append(a.done, a.cur), 'cur': x.cur, 'run': x.run}} END) AS f FROM units),
    packed AS (SELECT {key}, t, list_append(f.done, f.cur) AS p FROM folded),
    lapped AS (SELECT {key}, CASE WHEN length(t) = 0 THEN [] WHEN length(t) <= 400 THEN [t]
        ELSE list_transform(p, lambda x, i: CASE WHEN i = 1 THEN x
                            ELSE {_strip("right(p[i - 1], 60) || ' ' || x")} END) END AS c FROM packed),
    chunked AS (SELECT {key}, unnest(c) AS text, generate_subscripts(c, 1) - 1 AS n FROM lapped)"""


_PAGE_TEXT = r"""regexp_replace(html, '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>', ' ', 'g')"""
_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]


def _decoded(sql: str) -> str:
    for entity, char in _ENTITIES:
        sql = f"regexp_replace({sql}, '{entity}?', '{char}', 'g')"
    return f"trim(regexp_replace({sql}, '[\\s\\v\\p{{Z}}]+', ' ', 'g'))"


@query("txt_2", f"SELECT page_id, length({_decoded(_PAGE_TEXT)}) < 1500 AS short FROM pages")
def txt_2(t):
    tidy = prose.tidy(strip_html(col("html")))
    return t.pages.select("page_id", text.too_short(tidy, 1500).alias("short"))


_JUDGED = f"""SELECT load_id, CASE WHEN reason IS NOT NULL THEN reason
               WHEN load_id <> min(load_id) OVER (PARTITION BY ticket_id, reason) THEN 'duplicate_ticket_id' END AS reason
        FROM (SELECT load_id, ticket_id, coalesce({_REASON}, CASE WHEN length(trim(body)) < 8
              THEN 'body_too_short_or_garbled' END) AS reason FROM tickets)"""


@query("txt_3", _JUDGED)
def txt_3(t):
    return text.rejection_reasons(t.tickets)


_REDACTED = r"""regexp_replace(regexp_replace(regexp_replace(text,
    '\b(?:\d[ -]*?){13,16}\b', '[REDACTED_CARD]', 'g'),
    '\b\d{3}[-.\s]\d{3}[-.\s]\d{4}\b', '[REDACTED_PHONE]', 'g'),
    '[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_-]+\.[\p{L}\p{N}_.-]+', '[REDACTED_EMAIL]', 'g')"""


@query("txt_4", f"SELECT doc_id, {_REDACTED} AS clean, text <> {_REDACTED} AS had_pii FROM documents")
def txt_4(t):
    clean = t.documents.select("doc_id", "text", prose.redact(col("text")).alias("clean"))
    return clean.select("doc_id", "clean", prose.had_pii(col("text"), col("clean")).alias("had_pii"))


@query("txt_5", f"SELECT page_id, {_decoded(_PAGE_TEXT)} AS text FROM pages")
def txt_5(t):
    return t.pages.select("page_id", prose.tidy(strip_html(col("html"))).alias("text"))


_SIGNED = "regexp_replace(text, '[\\s\\v\\p{Z}]+', ' ', 'g') || ' KIND Regards , ' || source"
_PHRASE = (
    "regexp_extract(s, '(?is)^(.*?)\\b(?:best regards|kind regards|warm regards|many thanks|thanks|cheers|sincerely)\\s*,', 1)"
)


@query(
    "txt_6",
    f"""SELECT doc_id, CASE WHEN length(p) > 15 AND (length(d) <= 15 OR length(p) <= length(d)) THEN trim(p)
               WHEN length(d) > 15 THEN trim(d) ELSE s END AS text
        FROM (SELECT doc_id, s, {_PHRASE} AS p, regexp_extract(s, '(?s)^(.*?)\\s--\\s', 1) AS d
              FROM (SELECT doc_id, {_SIGNED} AS s FROM documents))""",
)
def txt_6(t):
    signed = F.concat(prose.collapse_spaces(col("text")), F.lit(" KIND Regards , "), col("source"))
    return t.documents.select("doc_id", prose.strip_signature(signed).alias("text"))


_MAILED = "trim(regexp_replace('Pls read: ' || text || ' Sent FROM my   iPhone', '[\\s\\v\\p{Z}]+', ' ', 'g'))"
_CLEAN = (
    f"trim(regexp_replace(replace(replace(regexp_replace(regexp_replace({_MAILED}, 'sent from my iphone', '', 'gi'),"
    " 'sent from my android|sent from yahoo mail.*|get outlook for ios', '', 'gi'),"
    " 'pls', 'please'), 'Pls', 'Please'), '[\\s\\v\\p{Z}]+', ' ', 'g'))"
)


@query("txt_7", f"SELECT doc_id, {_CLEAN} AS text FROM documents")
def txt_7(t):
    mailed = F.concat(F.lit("Pls read: "), col("text"), F.lit(" Sent FROM my   iPhone"))
    return t.documents.select("doc_id", prose.clean_text(mailed).alias("text"))


@query(
    "txt_8",
    """SELECT load_id, CASE WHEN length(subject) > 0 THEN subject || '. ' || coalesce(body, '') ELSE coalesce(body, '')
              END AS text FROM tickets""",
)
def txt_8(t):
    return t.tickets.select(
        "load_id", prose.combine(col("subject"), F.coalesce(col("body"), F.lit(""))).alias("text")
    )


@query("txt_9", f"WITH {_chunks('documents', 'doc_id')} SELECT doc_id || '-' || n AS chunk_id, doc_id, text FROM chunked")
def txt_9(t):
    return text.chunk_column(t.documents.select("doc_id", "text"), "doc_id", "text")


@query(
    "txt_10",
    """SELECT 'document' AS kind, contains(text, '<') AND contains(text, '>') AS had_html, count(*) AS n FROM documents
       GROUP BY ALL UNION ALL
       SELECT 'page', contains(html, '<') AND contains(html, '>'), count(*) FROM pages GROUP BY ALL""",
)
def txt_10(t):
    both = t.documents.select(F.lit("document").alias("kind"), "text").union(
        t.pages.select(F.lit("page"), col("html"))
    )
    return both.groupBy("kind", has_markup(col("text")).alias("had_html")).agg(F.count(F.lit(1)).alias("n"))


_TICKET_CHUNKS = f"""judged AS ({_JUDGED}),
    valid AS (SELECT ticket_id, subject, {_REDACTED.replace('(text,', '(body,')} AS body
              FROM tickets JOIN judged USING (load_id) WHERE reason IS NULL),
    tidied AS (SELECT ticket_id, subject, {_strip(f"regexp_replace(body, '{_WS}+', ' ', 'g')")} AS s FROM valid),
    signed AS (SELECT *, {_PHRASE} AS p, regexp_extract(s, '(?s)^(.*?)\\s--\\s', 1) AS d FROM tidied),
    unsigned AS (SELECT ticket_id, subject,
        CASE WHEN length(p) > 15 AND (length(d) <= 15 OR length(p) <= length(d)) THEN trim(p)
             WHEN length(d) > 15 THEN trim(d) ELSE s END AS s FROM signed),
    plain AS (SELECT ticket_id, subject, trim(regexp_replace(replace(replace(regexp_replace(s,
        'sent from my iphone|sent from my android|sent from yahoo mail.*|get outlook for ios', '', 'gi'),
        'pls', 'please'), 'Pls', 'Please'), ' +', ' ', 'g')) AS body FROM unsigned),
    whole AS (SELECT ticket_id, CASE WHEN subject = '' THEN body ELSE subject || '. ' || body END AS text FROM plain),
    {_chunks('whole', 'ticket_id')}"""


@query(
    "txt_11",
    f"WITH {_TICKET_CHUNKS} SELECT ticket_id, count(*) AS n_chunks FROM chunked GROUP BY ticket_id HAVING count(*) > 1",
)
def txt_11(t):
    valid, _ = text.validate(t.tickets)
    return text.multi_chunk(text.ticket_chunks(valid), "ticket_id")
