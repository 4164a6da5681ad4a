"""The registered queries of this subpackage, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

col = F.col

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECK_SQL: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def register(fn):
        QUERIES[key] = fn
        if sql is not None:
            CHECK_SQL[key] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op5_simhash")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starforge.llm import simhash

    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, most_bits=3)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op3_bpe")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starforge.llm import bpe

    path = tokenizer_path()
    ids = bpe.encoded(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return bpe.decoded(ids.select("doc_id", "ids"), path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(bpe.ids_text(col("ids")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op8_fingerprints")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starforge.llm import fingerprints as fp

    rows = fp.compared_with_edits(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fp.as_text(col("sketch")).alias("fingerprint"),
        fp.as_text(col("edited_sketch")).alias("edited_fingerprint"),
        fp.resemblance(col("sketch"), col("edited_sketch")).alias("near_edited"),
        fp.resemblance(col("sketch"), col("next_sketch")).alias("near_next"),
        fp.containment(col("sketch"), col("edited_sketch")).alias("contained_in_edited"),
    )


@query("op9_embeddings")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starforge.llm import embeddings

    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.93)


# A document is of good quality from this score on.
GOOD = 0.7


@query("op7_quality")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starforge.llm import quality

    docs = table(spark, sf_dir, "documents")
    machine = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs.select("doc_id", "text", "n_chars"), machine).select(
        "doc_id", quality.held_out().alias("held_out"), "score", (col("score") >= GOOD).cast("int").alias("predicted")
    )


@query("op10_secrets")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starforge.llm import secrets

    found = secrets.scan(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select(
        "doc_id",
        *[secrets.count_of(col("base"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secrets.as_text(col("base")), 256).alias("base_sha256"),
        secrets.as_text(col("spans")).alias("spans"),
    )


# Host, path and verdict of the rules.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

URLS_SQL = """
    WITH cut AS (
        SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
        FROM pages
    ), parts AS (
        SELECT page_id,
               translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
        FROM cut
    ), found AS (
        SELECT page_id, host, path,
               CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
                    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
                    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
                    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
        FROM parts
    )
    SELECT page_id, host, path, rule,
           CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
    FROM found"""


@query("op4_urls", URLS_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starforge.llm import urls

    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judged(table(spark, sf_dir, "pages").select("page_id", "url"), rules)[
        ["page_id", "host", "path", "rule", "verdict"]
    ]


def domain_of(source):
    """The tables have no domain, so sources are dealt to three."""
    return F.concat(F.lit("d"), (F.crc32(F.coalesce(source, F.lit("")).cast("binary")) % 3).cast("string"))


def production_mix():
    from starforge.llm.mixing import Mix

    weights = [{"d0": 0.4, "d1": 0.35, "d2": 0.25}, {"en": 0.55, "de": 0.18, "fr": 0.17, "es": 0.1}, {}]
    return Mix(["domain", "lang", "source"], weights, share=0.6, epochs=4)


@query("op2_mixing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starforge.llm import mixing

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    docs = docs.withColumn("domain", domain_of(col("source")))
    return mixing.mixed(docs, production_mix(), keep=["doc_id", "domain", "lang", "source"])


@query("op6_token_counts")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from starforge.llm import tokencounts

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("piece_bpe_32k.model")
    return tokencounts.with_counts(docs, path).select("doc_id", "n_pretokens", "n_tokens")


@query("op1_substrings")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starforge.llm import substrings

    kept = substrings.without_repeats(table(spark, sf_dir, "documents"), window=13)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starforge.llm import whitening

    return whitening.whitened(table(spark, sf_dir, "embeddings"), scale=256, most=4)[0]


def _clusters_sql(k: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, seed: int = 3) -> str:
    """The rounds one after the other; components and centroids have a row each."""

    def assigned(c: str) -> str:
        return f"""SELECT vec_id, arg_min(cluster, d * {k} + cluster) AS cluster, min(d) AS distance FROM (
            SELECT v.vec_id, c.cluster, sum((v.x - c.x) * (v.x - c.x)) AS d
            FROM parts v JOIN {c} c USING (i) GROUP BY v.vec_id, c.cluster) GROUP BY vec_id"""

    steps = [
        f"""good AS (SELECT vec_id, list_transform(embedding, lambda e: CAST(floor({scale} * CAST(e AS DOUBLE)) AS BIGINT)) AS x
            FROM embeddings WHERE len(embedding) = {dim}
              AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0)""",
        "parts AS MATERIALIZED (SELECT vec_id, unnest(x) AS x, generate_subscripts(x, 1) AS i FROM good)",
        f"""c0 AS MATERIALIZED (SELECT cluster, unnest(x) AS x, generate_subscripts(x, 1) AS i FROM (
            SELECT x, row_number() OVER (ORDER BY sha256('{seed}:' || CAST(vec_id AS VARCHAR))) - 1 AS cluster
            FROM good QUALIFY cluster < {k}))""",
    ]
    for r in range(rounds):
        steps.append(f"a{r} AS MATERIALIZED ({assigned(f'c{r}')})")
        steps.append(f"""c{r + 1} AS MATERIALIZED (
            SELECT o.cluster, o.i, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, o.x) AS x FROM c{r} o LEFT JOIN (
                SELECT a.cluster, p.i, sum(p.x) AS s, count(*) AS n FROM a{r} a JOIN parts p USING (vec_id) GROUP BY a.cluster, p.i
            ) m ON m.cluster = o.cluster AND m.i = o.i)""")
    steps.append(f"last AS MATERIALIZED ({assigned(f'c{rounds}')})")
    steps.append(f"""named AS (SELECT cluster, sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256
        FROM c{rounds} GROUP BY cluster)""")
    return f"""WITH {", ".join(steps)}
    SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
           CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
           CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
    FROM last JOIN named USING (cluster)"""


@query("op12_centroids", _clusters_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starforge.llm import centroids

    assigned, found = centroids.clustered(table(spark, sf_dir, "embeddings"), dim=64)
    return centroids.with_inertia(assigned, found)[
        ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    ]


EXACT_SQL = """
    WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents),
    w AS (SELECT doc_id, x, max(doc_id) OVER (PARTITION BY x) AS keep_id, count(*) OVER (PARTITION BY x) AS group_size FROM t)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(x) AS text_sha256 FROM w"""


@query("op13_exact", EXACT_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starforge.llm import exact

    return exact.duplicates(table(spark, sf_dir, "documents"), keep="largest")
