"""What is moved between tasks: not more columns, bytes or times than the work needs."""

import re

from pyspark.sql import functions as F

from ratelab.operators import features, joins, naive_bayes, neighbours, sampling
from ratelab.operators.star import star
from ratelab.plans import rating_queries


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_star_joins_the_wide_books_last(spark):
    books = spark.createDataFrame([("a", "T", 1990), ("b", "U", 1991), ("b", "U", 1991)], "isbn string, title string, year int")
    users = spark.createDataFrame([(1, "usa", 20), (2, "non-usa", 30)], "user_id int, location string, age int")
    ratings = spark.createDataFrame(
        [(1, "a", 5, "x"), (2, "b", 6, "y"), (2, "c", 7, "z"), (None, "a", 8, "n"), (1, "a", 5, "x")],
        "user_id int, isbn string, rating int, row_key string",
    )
    rated = star(books, users, ratings)
    assert rated.columns == ["user_id", "isbn", "rating", "row_key", "title", "year", "location", "age"]
    assert sorted(map(tuple, rated.collect())) == [
        (1, "a", 5, "x", "T", 1990, "usa", 20), (1, "a", 5, "x", "T", 1990, "usa", 20), (2, "b", 6, "y", "U", 1991, "non-usa", 30),
    ]
    assert re.search(r"Join Inner, \((\w+)#", _plan(rated)).group(1) == "isbn"


def test_places_are_numbered_without_another_shuffle(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 500).alias("a"), F.when(F.col("id") > 3, F.col("id")).alias("b"))
    placed = features.numbered(rows, [F.desc("a"), F.col("b")], "place")
    assert "row_number" not in _plan(placed)
    found = sorted((r["place"], r["a"], r["b"]) for r in placed.collect())
    expected = sorted(((r["a"], r["b"]) for r in rows.collect()), key=lambda r: (-r[0], r[1] is not None, r[1] or 0))
    assert found == [(i, *r) for i, r in enumerate(expected)]


def test_resample_numbers_written_ids_of_16_bytes(spark, monkeypatch):
    seen = []

    def numbered(df, order, name):
        seen.append((df.schema["_drawn_id"].dataType.simpleString(), len(df.inputFiles()) > 0))
        return features.numbered(df, order, name)

    monkeypatch.setattr(sampling, "numbered", numbered)
    rows = spark.range(200).select(F.col("id").cast("string").alias("k"), (F.col("id") % 3).alias("c"))
    assert sampling.resample(rows, 50, 1, ["k"], label="c", bias=0.5).count() == 100
    assert seen == [("binary", True)]


def test_feature_index_makes_its_rows_once(spark, monkeypatch, tmp_path):
    path = str(tmp_path / "split")
    rows = [("r1", 20, 1990, "usa", "P", "a", "TRAIN"), ("r2", 30, None, "usa", "Q", "b", "TEST"), ("r3", 20, 1991, "usa", "P", "a", "TRAIN")]
    schema = "row_key string, age int, year int, location string, publisher string, isbn string, split string"
    spark.createDataFrame(rows, schema).write.parquet(path)
    monkeypatch.setattr(rating_queries, "_split", lambda session, sf_dir: session.read.parquet(path))
    indexed = rating_queries.feature_index(spark, "")
    assert not [f for f in indexed.inputFiles() if path in f]
    found = sorted(map(tuple, indexed.collect()))
    assert found == [("r1", 0, 0, 0, 0, 0), ("r2", 1, 2, 0, 1, 1), ("r3", 0, 1, 0, 0, 0)]


def test_neighbour_keys_take_16_bytes(spark):
    row = spark.createDataFrame([("a", "b")], "x string, y string")
    (key,) = row.select(F.inline(F.array(*neighbours._patterns(["x", "y"], 0)))).select("key").first()
    assert len(key) == 16


def test_many_rows_are_not_left_to_an_estimate(spark, monkeypatch):
    """Checkpoints keep the size that their query's files had: joins of counted tables must not go by it."""
    rows = [(f"i{i % 7}", f"p{i % 3}", 1990 + i % 5, i % 4) for i in range(60)]
    train = spark.createDataFrame(rows, "isbn string, publisher string, year int, rating int")
    of = dict(nominal=["isbn", "publisher"], numeric=["year"])
    neighbour = neighbours.fit_neighbours(train, 3, **of)
    bayes = naive_bayes.fit_naive_bayes(train, **of)
    rounds = []

    def traced(*args, **options):
        found = one_round(*args, **options)
        rounds.append(_plan(found))
        return found

    one_round = neighbours._round
    monkeypatch.setattr(neighbours, "_round", traced)

    def answers():
        voted = neighbours.predict_neighbours(neighbour, train, "p")
        scored = naive_bayes.predict_naive_bayes(bayes, train, "p")
        return [(_plan(df), sorted(map(tuple, df.collect()))) for df in (voted, scored)]

    few = [found for _, found in answers()]
    assert "strategy=broadcast" in rounds[0] and "strategy=merge" not in rounds[0]
    rounds.clear()
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(neighbours, "ASKED_KEYS", 0)
    many = answers()
    assert all("strategy=merge" in plan for plan in [*rounds, *(plan for plan, _ in many)])
    assert [found for _, found in many] == few


def test_star_does_not_broadcast_many_books(spark, monkeypatch):
    books = spark.createDataFrame([("a", "T"), ("b", "U")], "isbn string, title string")
    users = spark.createDataFrame([(1, "usa")], "user_id int, location string")
    ratings = spark.createDataFrame([(1, "a", 5), (1, "c", 6)], "user_id int, isbn string, rating int")
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 1)
    rated = star(books, users, ratings)
    assert _plan(rated).count("strategy=merge") == 1
    assert [tuple(r) for r in rated.collect()] == [(1, "a", 5, "T", "usa")]
