"""Star schema over nested movie records: dimensions, genre bridge and fact."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starforge.functions import columns as c
from starforge.operators.relational import mean
from starforge.operators.star import assign_keys, calendar, dim_release_date
from starforge.operators.windows import dense_key, top_n_per
from starforge.session import cut_lineage, side_by_side

col = F.col

# The text fields of a movie record.
MOVIE_FIELDS = [
    "imdbID", "Title", "Year", "Rated", "Released", "Runtime", "Genre", "Director", "Actors", "Country", "Language", "Plot",
    "Poster", "imdbRating", "imdbVotes", "Metascore", "BoxOffice",
]

MOVIE_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in MOVIE_FIELDS]
    + [
        T.StructField(
            "Ratings",
            T.ArrayType(T.StructType([T.StructField("Source", T.StringType()), T.StructField("Value", T.StringType())])),
        )
    ]
)


@dataclass
class MovieStar:
    dim_movie: DataFrame
    dim_director: DataFrame
    dim_country: DataFrame
    dim_language: DataFrame
    dim_certificate: DataFrame
    dim_genre: DataFrame
    dim_release_date: DataFrame
    bridge_movie_genre: DataFrame
    fact_movie: DataFrame


def one_per_movie(raw: DataFrame) -> DataFrame:
    """Repeats of a movie are reduced to the smallest record, so that a rerun picks the same one."""
    rest = [name for name in raw.columns if name != "imdbID"]
    return raw.groupBy("imdbID").agg(F.min(F.struct(*rest)).alias("_m")).select("imdbID", "_m.*")


def keyed(rows: DataFrame, natural: str, key: str, known: DataFrame | None) -> DataFrame:
    """``rows`` with surrogate keys; what a stored dimension ``known`` has keeps its key."""
    return dense_key(rows, [natural], key) if known is None else assign_keys(known, rows, [natural], key)


def dim_movie(records: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One descriptive row per movie id; ``records`` has one record per movie."""
    rows = records.select(
        col("imdbID").alias("imdb_id"),
        c.known(col("Title")).alias("title"),
        c.known(col("Rated")).alias("rated"),
        c.known(col("Plot")).alias("plot"),
        c.known(col("Poster")).alias("poster_url"),
    )
    return keyed(rows, "imdb_id", "movie_key", known)


def first_names(raw: DataFrame, field: str, name: str) -> DataFrame:
    """Distinct names from a field that may list several; only the first counts."""
    first = c.first_listed(c.known(col(field)))
    return raw.select(first.alias(name)).where(col(name).isNotNull()).distinct()


def dim_named(records: DataFrame, field: str, key: str, name: str, known: DataFrame | None = None) -> DataFrame:
    return keyed(first_names(records, field, name), name, key, known)


def genres_of(raw: DataFrame) -> DataFrame:
    """One row per movie and genre."""
    listed = F.split(c.known(col("Genre")), ", ")
    return raw.select(col("imdbID").alias("imdb_id"), F.explode(listed).alias("genre_name")).distinct()


def dim_genre(records: DataFrame, known: DataFrame | None = None) -> DataFrame:
    return keyed(genres_of(records).select("genre_name").distinct(), "genre_name", "genre_key", known)


def bridge_movie_genre(raw: DataFrame, movie: DataFrame, genre: DataFrame) -> DataFrame:
    return (
        genres_of(raw)
        .join(movie.select("imdb_id", "movie_key"), "imdb_id")
        .join(genre, "genre_name")
        .select("movie_key", "genre_key")
    )


def fact_movie(records: DataFrame, dims: dict[str, tuple[DataFrame, str, str]], movie: DataFrame) -> DataFrame:
    """One row per movie: keys of all dimensions and the parsed measures."""
    rotten = c.pick(col("Ratings"), "Source", "Rotten Tomatoes")["Value"]
    df = records.select(
        "imdbID",
        *dims,
        c.minutes_text(col("Runtime")).alias("runtime_minutes"),
        c.plain_number(col("imdbRating"), "decimal(3,1)").alias("imdb_rating"),
        c.comma_number(col("imdbVotes")).alias("imdb_votes"),
        c.plain_number(col("Metascore"), "int").alias("metascore"),
        c.percent_text(rotten).alias("rotten_tomatoes_pct"),
        c.dollars(col("BoxOffice")).alias("box_office_usd"),
        c.date_key(F.to_date(c.known(col("Released")), "dd MMM yyyy")).alias("release_date_key"),
    )
    df = df.join(movie.select(col("imdb_id").alias("imdbID"), "movie_key"), "imdbID")
    for field, (dim, key, name) in dims.items():
        side = dim.select(col(key), col(name).alias(f"_{key}"))
        df = df.join(side, c.first_listed(c.known(col(field))) == col(f"_{key}"), "left")
    return df.select(
        "movie_key", *[key for _, key, _ in dims.values()], "release_date_key", "runtime_minutes", "imdb_rating",
        "imdb_votes", "metascore", "rotten_tomatoes_pct", "box_office_usd",
    )


# Fields that become small dimensions: field, key, name column.
NAMED = [
    ("Director", "director_key", "name"),
    ("Country", "country_key", "country_name"),
    ("Language", "language_key", "language_name"),
    ("Rated", "certificate_key", "code"),
]


def build(raw: DataFrame, calendar_end: dt.date | None = None, known: MovieStar | None = None) -> MovieStar:
    """All tables of the star; the release calendar runs from 1900 to ``calendar_end`` or today.

    Repeated movies are reduced before anything else, so all tables agree on the record.  With
    the stored star ``known``, movies and names it has keep their keys and new ones follow.
    """
    records = cut_lineage(one_per_movie(raw))
    stored = {} if known is None else {
        "Director": known.dim_director, "Country": known.dim_country, "Language": known.dim_language, "Rated": known.dim_certificate,
    }
    jobs = [
        lambda: dim_movie(records, known and known.dim_movie),
        lambda: dim_genre(records, known and known.dim_genre),
        *[lambda f=f, k=k, n=n: dim_named(records, f, k, n, stored.get(f)) for f, k, n in NAMED],
    ]
    movie, genre, *dims = side_by_side(lambda job: job(), jobs)
    named = {field: (dim, key, name) for (field, key, name), dim in zip(NAMED, dims)}
    return MovieStar(
        movie,
        *dims,
        genre,
        dim_release_date(calendar(raw.sparkSession, dt.date(1900, 1, 1), calendar_end)),
        bridge_movie_genre(records, movie, genre),
        fact_movie(records, named, movie),
    )


def best_per_genre(m: MovieStar) -> DataFrame:
    """The best rated movie of each genre; ties go to the lower id."""
    rated = (
        m.bridge_movie_genre.join(m.fact_movie.select("movie_key", "imdb_rating"), "movie_key")
        .join(m.dim_movie.select("movie_key", "imdb_id", "title"), "movie_key")
        .join(m.dim_genre, "genre_key")
        .withColumn("_unrated", col("imdb_rating").isNull())
    )
    best = top_n_per(rated, ["genre_name"], ["_unrated", "-imdb_rating", "imdb_id"], 1)
    return best.select("genre_name", "title", "imdb_rating")


def rating_by_decade(fact: DataFrame, dates: DataFrame) -> DataFrame:
    dated = fact.join(dates.select(col("date_key").alias("release_date_key"), "decade"), "release_date_key")
    return (
        dated.groupBy("decade")
        .agg(F.count(F.lit(1)).alias("movie_count"), F.round(mean("imdb_rating"), 2).alias("avg_imdb_rating"))
        .orderBy("decade")
    )


def directors_by_box_office(fact: DataFrame, directors: DataFrame, at_least: int = 2) -> DataFrame:
    per = fact.groupBy("director_key").agg(
        F.count(F.lit(1)).alias("movies_loaded"), F.round(mean("box_office_usd"), 2).alias("avg_box_office_usd")
    )
    return (
        per.where(col("movies_loaded") >= at_least)
        .join(directors, "director_key")
        .select(col("name").alias("director_name"), "movies_loaded", "avg_box_office_usd")
        .orderBy(F.desc_nulls_last("avg_box_office_usd"), "director_name")
    )
