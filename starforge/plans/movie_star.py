"""Queries over nested movie records."""

import datetime as dt

from pyspark.sql import functions as F

from starforge.operators import movies
from starforge.plans.registry import query

col = F.col

_FIRST = "string_split(nullif({}, 'N/A'), ', ')[1]"
_NAMED = [("director", "director"), ("country", "country"), ("language", "language"), ("certificate", "rated")]
_DIMS_SQL = " UNION ALL ".join(
    f"SELECT '{kind}' AS kind, name, row_number() OVER (ORDER BY name) AS key"
    f" FROM (SELECT DISTINCT {_FIRST.format(field)} AS name FROM movies) WHERE name IS NOT NULL"
    for kind, field in _NAMED
)
_GENRES = "SELECT DISTINCT imdb_id, g AS genre_name FROM movies, unnest(string_split(nullif(genre, 'N/A'), ', ')) AS u(g)"


@query(
    "dim_10",
    """WITH days AS (SELECT unnest(generate_series(TIMESTAMP '1900-01-01', TIMESTAMP '2026-12-31', INTERVAL 1 DAY)) AS d)
       SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, year(d) AS year,
              CAST(year(d) // 10 * 10 AS BIGINT) AS decade, month(d) AS month, strftime(d, '%B') AS month_name,
              count(imdb_id) AS released FROM days LEFT JOIN movies ON movies.released = d GROUP BY d""",
)
def dim_10(t):
    m = movies.build(t.movies, dt.date(2026, 12, 31))
    used = m.fact_movie.groupBy(col("release_date_key").alias("date_key")).agg(F.count(F.lit(1)).alias("released"))
    joined = m.dim_release_date.drop("full_date").join(used, "date_key", "left")
    return joined.withColumn("released", F.coalesce("released", F.lit(0)))


@query("dim_11", _DIMS_SQL)
def dim_11(t):
    m = movies.build(t.movies)
    parts = [
        df.select(F.lit(kind).alias("kind"), col(name).alias("name"), col(key).alias("key"))
        for kind, df, key, name in [
            ("director", m.dim_director, "director_key", "name"),
            ("country", m.dim_country, "country_key", "country_name"),
            ("language", m.dim_language, "language_key", "language_name"),
            ("certificate", m.dim_certificate, "certificate_key", "code"),
        ]
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query(
    "dim_12",
    f"""SELECT 'movie' AS kind, imdb_id AS natural_key, title AS label, row_number() OVER (ORDER BY imdb_id) AS key
        FROM movies
        UNION ALL
        SELECT 'genre', genre_name, genre_name, row_number() OVER (ORDER BY genre_name)
        FROM (SELECT DISTINCT genre_name FROM ({_GENRES}))""",
)
def dim_12(t):
    m = movies.build(t.movies)
    movie = m.dim_movie.select(
        F.lit("movie").alias("kind"), col("imdb_id").alias("natural_key"), col("title").alias("label"),
        col("movie_key").alias("key"),
    )
    genre = m.dim_genre.select(
        F.lit("genre").alias("kind"), col("genre_name").alias("natural_key"), col("genre_name").alias("label"),
        col("genre_key").alias("key"),
    )
    return movie.unionByName(genre)


@query(
    "fct_5",
    f"""WITH keys AS ({_DIMS_SQL})
        SELECT row_number() OVER (ORDER BY imdb_id) AS movie_key, d.key AS director_key, c.key AS country_key,
               l.key AS language_key, r.key AS certificate_key,
               CAST(strftime(released, '%Y%m%d') AS BIGINT) AS release_date_key,
               CAST(replace(nullif(runtime, 'N/A'), ' min', '') AS BIGINT) AS runtime_minutes,
               CAST(nullif(imdb_rating, 'N/A') AS DOUBLE) AS imdb_rating,
               CAST(replace(imdb_votes, ',', '') AS BIGINT) AS imdb_votes,
               (SELECT p_size FROM part WHERE 'tt' || lpad(CAST(p_partkey AS VARCHAR), 7, '0') = imdb_id) AS metascore,
               CAST(replace(rotten, '%', '') AS BIGINT) AS rotten_tomatoes_pct,
               CAST(replace(replace(nullif(box_office, 'N/A'), ',', ''), '$', '') AS DOUBLE) AS box_office_usd
        FROM movies
        LEFT JOIN keys d ON d.kind = 'director' AND d.name = {_FIRST.format('director')}
        LEFT JOIN keys c ON c.kind = 'country' AND c.name = {_FIRST.format('country')}
        LEFT JOIN keys l ON l.kind = 'language' AND l.name = {_FIRST.format('language')}
        LEFT JOIN keys r ON r.kind = 'certificate' AND r.name = nullif(rated, 'N/A')""",
    doubles="director_key country_key certificate_key release_date_key runtime_minutes metascore rotten_tomatoes_pct",
)
def fct_5(t):
    return movies.build(t.movies).fact_movie


@query(
    "fct_5_bridge",
    f"""WITH g AS ({_GENRES}),
             m AS (SELECT imdb_id, row_number() OVER (ORDER BY imdb_id) AS movie_key FROM movies),
             d AS (SELECT genre_name, row_number() OVER (ORDER BY genre_name) AS genre_key
                   FROM (SELECT DISTINCT genre_name FROM g))
        SELECT movie_key, genre_key FROM g JOIN m USING (imdb_id) JOIN d USING (genre_name)""",
)
def fct_5_bridge(t):
    return movies.build(t.movies).bridge_movie_genre


@query(
    "agg_16",
    """SELECT CAST(year(released) // 10 * 10 AS BIGINT) AS decade, count(*) AS movie_count,
              round(CAST(sum(CAST(nullif(imdb_rating, 'N/A') AS DECIMAL(3,1))) AS DOUBLE)
                    / count(nullif(imdb_rating, 'N/A')), 2) AS avg_imdb_rating
       FROM movies WHERE released IS NOT NULL GROUP BY 1""",
)
def agg_16(t):
    m = movies.build(t.movies)
    return movies.rating_by_decade(m.fact_movie, m.dim_release_date)


@query(
    "agg_17",
    f"""SELECT director_name, count(*) AS movies_loaded, round(sum(usd) / count(usd), 2) AS avg_box_office_usd
        FROM (SELECT {_FIRST.format('director')} AS director_name,
                     CAST(replace(replace(nullif(box_office, 'N/A'), ',', ''), '$', '') AS DOUBLE) AS usd FROM movies)
        WHERE director_name IS NOT NULL GROUP BY director_name HAVING count(*) >= 2""",
)
def agg_17(t):
    m = movies.build(t.movies)
    return movies.directors_by_box_office(m.fact_movie, m.dim_director)
