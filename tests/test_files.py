import json

from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starforge.operators import movies
from starforge.sources import readers
from starforge.streaming.files import DailyLoad, pending_files

RIDES = T.StructType([T.StructField("ride_id", T.IntegerType()), T.StructField("driver", T.StringType())])


def day(folder, name, *lines):
    (folder / name).write_text("ride_id,driver\n" + "".join(f"{x}\n" for x in lines))


def test_daily_files_are_loaded_once(spark, tmp_path):
    data = tmp_path / "data"
    data.mkdir()
    day(data, "rides_20260812.csv", "1,A", "2,B")
    day(data, "rides_20260813.csv", "3,C", "2,again")
    day(data, "notes.csv", "99,X")

    def load():
        return DailyLoad(spark, str(data), str(tmp_path / "out"), RIDES, "ride_id")

    load().run()
    assert rows(load().rows()) == [(1, "A"), (2, "B"), (3, "C")]
    assert rows(load().ledger(), "filename", "row_count") == [("rides_20260812.csv", 2), ("rides_20260813.csv", 2)]
    load().run()
    assert load().rows().count() == 3 and load().ledger().count() == 2
    day(data, "rides_20260814.csv", "4,D", "1,again")
    day(data, "rides_20260815.csv", "5,E", "4,again")
    waiting = pending_files(spark, str(data), load().ledger())
    assert [r["filename"] for r in waiting.collect()] == ["rides_20260814.csv", "rides_20260815.csv"]
    load().run()
    assert rows(load().rows()) == [(1, "A"), (2, "B"), (3, "C"), (4, "D"), (5, "E")]
    assert pending_files(spark, str(data), load().ledger()).count() == 0


def test_bad_lines_empty_files_and_other_names(spark, tmp_path):
    data = tmp_path / "data"
    data.mkdir()
    day(data, "rides_20260812.csv", "xx,3", "2,b", "2,a", "3,c,4")
    day(data, "rides_20260813.csv")
    day(data, "rides_20260814.csv.bak", "9,Z")
    day(data, "old_rides_20260814.csv", "8,Y")
    for _ in range(2):
        load = DailyLoad(spark, str(data), str(tmp_path / "out"), RIDES, "ride_id")
        load.run()
        assert rows(load.rows()) == [(2, "a")]
        assert rows(load.rejected()) == [("rides_20260812.csv", "3,c,4"), ("rides_20260812.csv", "xx,3")]
        assert rows(load.ledger(), "filename", "row_count", "rejected_count") == [
            ("rides_20260812.csv", 2, 2), ("rides_20260813.csv", 0, 0),
        ]
        assert pending_files(spark, str(data), load.ledger()).count() == 0


def test_a_repeated_micro_batch_replaces_itself(spark, tmp_path):
    data = tmp_path / "data"
    data.mkdir()
    day(data, "rides_20260812.csv", "1,A")
    load = DailyLoad(spark, str(data), str(tmp_path / "out"), RIDES, "ride_id")
    load.run()
    schema = "ride_id int, driver string, _bad_record string, filename string"
    batch = spark.createDataFrame([(1, "A", None, "rides_20260812.csv")], schema)
    load._load(batch, 0)
    assert rows(load.rows()) == [(1, "A")] and load.ledger().count() == 1


def test_csv_empty_is_null(spark, tmp_path):
    day(tmp_path, "rides.csv", "1,", "2, B ")
    assert rows(readers.read_csv(spark, str(tmp_path / "rides.csv"), RIDES)) == [(1, None), (2, " B ")]


def test_raw_landing(spark, tmp_path):
    from pyspark.sql import functions as F

    (tmp_path / "t.csv").write_text('ticket_id,body,response\n1,"two\nlines, ""quoted""",\n,,x\n')
    got = readers.land_csv(spark, str(tmp_path / "t.csv"), ["ticket_id", "body", "response"], F.lit("now"))
    assert rows(got) == [
        ("", "", "x", "t.csv", "now"), ("1", 'two\nlines, "quoted"', None, "t.csv", "now"),
    ]


def movie(i, **fields):
    base = dict(
        imdbID=f"tt{i}", Title=f"M{i}", Rated="PG", Released="16 Jul 2010", Runtime="148 min", Genre="Action, Sci-Fi, Thriller",
        Director="A. One, B. Two", Country="USA, UK", Language="English", imdbRating="8.8", imdbVotes="2,345,678",
        BoxOffice="$28,341,469", Metascore="74", Plot="N/A", Poster="http://x",
        Ratings=[{"Source": "Internet Movie Database", "Value": "8.8/10"}, {"Source": "Rotten Tomatoes", "Value": "87%"}],
    )
    return {**base, **fields}


def test_movies(spark, tmp_path):
    docs = [
        movie(1),
        movie(2, Genre="Action", Ratings=[], BoxOffice="N/A", Runtime="N/A", imdbRating="9.1", Director="N/A", Released="N/A"),
        movie(3, Genre="Drama", imdbRating="N/A", Rated="N/A", Released="01 Jan 1999", BoxOffice="$1,000", Metascore="N/A"),
    ]
    for d in docs:
        (tmp_path / f"{d['imdbID']}.json").write_text(json.dumps(d, indent=1))
    (tmp_path / "search_batman.json").write_text('{"Search": []}')
    raw = readers.read_movies(spark, str(tmp_path))
    assert raw.count() == 3
    m = movies.build(raw)
    assert rows(m.dim_director, "name") == [("A. One",)]
    assert rows(m.dim_country, "country_name") == [("USA",)]
    assert m.bridge_movie_genre.count() == 5
    facts = rows(
        m.fact_movie, "movie_key", "runtime_minutes", "imdb_votes", "metascore", "rotten_tomatoes_pct", "release_date_key",
        "director_key", "certificate_key",
    )
    assert facts == [
        (1, 148, 2345678, 74, 87, 20100716, 1, 1),
        (2, None, 2345678, 74, None, None, None, 1),
        (3, 148, 2345678, None, 87, 19990101, 1, None),
    ]
    assert [None if x is None else int(x) for (x,) in rows(m.fact_movie, "box_office_usd")] == [1000, 28341469, None]
    assert rows(movies.best_per_genre(m), "genre_name", "title") == [
        ("Action", "M2"), ("Drama", "M3"), ("Sci-Fi", "M1"), ("Thriller", "M1"),
    ]
    assert rows(movies.rating_by_decade(m.fact_movie, m.dim_release_date), "decade", "movie_count") == [(1990, 1), (2010, 1)]
    assert [(n, k, int(x)) for n, k, x in rows(movies.directors_by_box_office(m.fact_movie, m.dim_director))] == [
        ("A. One", 2, 14171234)
    ]


def test_repeated_movies_are_reduced_first_and_keys_stay(spark):
    def records(*docs):
        return spark.createDataFrame([json.dumps(d) for d in docs], "string").select(
            F.from_json("value", movies.MOVIE_SCHEMA).alias("m")
        ).select("m.*")

    first = records(movie(1, Director="M"), movie(1, Director="Z", Genre="War", Title="Other"), movie(2, Director="N"))
    m = movies.build(first)
    assert rows(m.dim_movie, "movie_key", "title") == [(1, "M1"), (2, "M2")]
    assert "War" not in {g for (g,) in rows(m.dim_genre, "genre_name")}
    assert rows(m.dim_director, "name", "director_key") == [("M", 1), ("N", 2)]
    later = movies.build(first.unionByName(records(movie(0, Director="A"))), known=m)
    assert rows(later.dim_director, "name", "director_key") == [("A", 3), ("M", 1), ("N", 2)]
    assert rows(later.dim_movie, "imdb_id", "movie_key") == [("tt0", 3), ("tt1", 1), ("tt2", 2)]
    assert rows(later.fact_movie, "movie_key", "director_key") == [(1, 1), (2, 2), (3, 3)]
