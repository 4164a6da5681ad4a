"""Embedding and similarity-search queries."""

from pyspark.sql import functions as F

from starforge.operators import search, text
from starforge.operators import vectors as v
from starforge.plans.registry import query
from starforge.session import scratch_path

col = F.col


def centroids(index):
    """One query vector per label: the mean of its vectors."""
    dim = index.select(F.size("embedding")).first()[0]
    means = index.groupBy(col("label").cast("bigint").alias("query_id")).agg(
        *[F.avg(col("embedding")[i].cast("double")).alias(f"m{i}") for i in range(dim)]
    )
    return means.select("query_id", F.array(*[f"m{i}" for i in range(dim)]).alias("embedding"))


_HITS = """e AS (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM vectors),
    m AS (SELECT label, i, avg(x) AS x FROM e GROUP BY label, i),
    q AS (SELECT CAST(label AS BIGINT) AS query_id, list(x ORDER BY i) AS qv FROM m GROUP BY label),
    scored AS (SELECT query_id, vec_id, label, list_cosine_similarity(embedding, qv) AS score FROM vectors CROSS JOIN q {where}),
    hits AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
                            FROM scored) WHERE rank <= {k})"""
_SHOW = "SELECT query_id, vec_id, round(score, 6) AS score, rank FROM hits"


def _shown(hits):
    return hits.withColumn("score", F.round("score", 6))


@query("vec_1")
def vec_1(t):
    chunked = text.chunk_column(t.documents.select("doc_id", "lang", "text"), "doc_id", "text")
    embedded = v.embed(chunked, "text")
    empty = embedded.limit(0)
    index = v.update_index(empty.drop("text"), embedded.drop("text"))
    norm = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return index.select("chunk_id", "doc_id", F.size("embedding").alias("dim"), F.round(norm, 4).alias("norm"))


@query(
    "vec_1_changes",
    """SELECT CAST(doc_id AS VARCHAR) AS chunk_id, CASE WHEN doc_id % 11 = 3 THEN 'gone' ELSE 'changed' END AS kind
       FROM documents WHERE doc_id % 11 = 3 OR doc_id % 7 = 0""",
)
def vec_1_changes(t):
    """Which chunks an edit of some documents, and the loss of others, changes in the index."""
    docs = t.documents.select(col("doc_id").cast("string").alias("chunk_id"), col("doc_id").alias("ticket_id"), "text")
    edited = F.when(col("ticket_id") % 7 == 0, F.concat(F.coalesce("text", F.lit("")), F.lit(" edited"))).otherwise(col("text"))
    now = docs.where(col("ticket_id") % 11 != 3).withColumn("text", edited)
    changed, gone = v.index_changes(v.build_index(docs), now, docs.select("ticket_id"))
    kinds = changed.select("chunk_id", F.lit("changed").alias("kind"))
    return kinds.unionByName(gone.select("chunk_id", F.lit("gone").alias("kind")))


@query("vec_2", f"WITH {_HITS.format(where='', k=5)} {_SHOW}")
def vec_2(t):
    return _shown(search.top_k_cosine(t.vectors, centroids(t.vectors), 5))


@query("vec_3", f"WITH {_HITS.format(where='WHERE label = 3', k=5)} {_SHOW}")
def vec_3(t):
    return _shown(search.top_k_cosine(t.vectors, centroids(t.vectors), 5, where=col("label") == 3))


def _celled(t):
    return search.CellIndex.build(t.vectors, scratch_path(t.vectors.sparkSession, "cells"))


@query("vec_4")
def vec_4(t):
    return _shown(_celled(t).top_k(centroids(t.vectors), 5))


@query(
    "vec_4_recall",
    f"""WITH {_HITS.format(where='', k=5)}
        SELECT count(*) AS true_hits, round(sum(score), 4) AS true_score, count(*) >= 0.9 * count(*) AS enough,
               count(DISTINCT query_id) AS queries_below_a_third FROM hits""",
)
def vec_4_recall(t):
    """The approximate search finds nine of ten of the true hits among less than a third of the vectors."""
    index, queries = _celled(t), centroids(t.vectors)
    probes = index.probes(queries, 5, 0.28)
    found = index.search(probes, 5).select("query_id", "vec_id", F.lit(1).alias("hit"))
    exact = search.top_k_cosine(t.vectors, queries, 5).join(found, ["query_id", "vec_id"], "left")
    hits = exact.agg(
        F.count(F.lit(1)).alias("true_hits"),
        F.round(F.sum("score"), 4).alias("true_score"),
        (F.count("hit") >= 0.9 * F.count(F.lit(1))).alias("enough"),
    )
    few = index.compared(probes).agg(F.count_if(col("share") < 0.3).alias("queries_below_a_third"))
    return hits.select("*", few.scalar().alias("queries_below_a_third"))


def _hits(t):
    """Hits with the text of the document of the same number."""
    found = search.top_k_cosine(t.vectors, centroids(t.vectors), 5)
    docs = t.documents.select(
        col("doc_id").alias("vec_id"),
        col("doc_id").alias("ticket_id"),
        col("source").alias("category"),
        "text",
        F.when(col("doc_id") % 4 != 1, F.concat("lang", F.lit(" answer"))).alias("response"),
    )
    return found.join(docs, "vec_id")


_DOC_HITS = f"""{_HITS.format(where='', k=5)},
    found AS (SELECT query_id, rank, score, doc_id AS ticket_id, source AS category, text,
                     CASE WHEN doc_id % 4 <> 1 THEN lang || ' answer' END AS response
              FROM hits JOIN documents ON doc_id = vec_id)"""


@query(
    "vec_5",
    f"""WITH {_DOC_HITS}, built AS (SELECT query_id, string_agg('[Ticket #' || CAST(ticket_id AS VARCHAR) || ' | category='
            || category || ']' || chr(10) || 'Q: ' || text || coalesce(chr(10) || 'Resolution: ' || response, ''),
            chr(10) || chr(10) ORDER BY rank) AS context FROM found GROUP BY query_id)
        SELECT query_id, coalesce(context, 'No related tickets were found.') AS context FROM q LEFT JOIN built USING (query_id)""",
)
def vec_5(t):
    return v.build_context(centroids(t.vectors), _hits(t))


@query(
    "vec_6",
    f"""WITH {_DOC_HITS} SELECT query_id, rank, ticket_id, category, round(score, 4) AS score,
        substr(text, 1, 300) AS text, substr(coalesce(response, ''), 1, 300) AS response FROM found""",
)
def vec_6(t):
    return v.sources(_hits(t))
