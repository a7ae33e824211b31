import hashlib

import pytest
from pyspark.sql import functions as F

from ratelab.functions import cleaning
from ratelab.operators import evaluate, sampling
from ratelab.operators.ensemble import average
from ratelab.operators.sampling import (
    bagged_sample,
    bootstrap,
    draw_split,
    hash_split,
    random_split,
    sampled_split,
)
from ratelab.operators.star import star
from ratelab.sources import ratings as raw
from ratelab.sources import tables


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "line string")


def rows(df):
    return [tuple(r) for r in df.collect()]


BOOK = '"{}";"T";"A";"{}";"P1";"u1"'


def test_book_lines(spark):
    good, rejects = raw.parse_books(
        lines(
            spark,
            '"0001";"A, B &amp; C";"O\'Neil";"2001";"P1";"u1"',
            BOOK.format("0002", "DK Publishing Inc"),
            '"0004";"T4"',
            '"0005";"T";"A";"1999";""',
        )
    )
    assert rows(good) == [("0001", "A B and C", "ONeil", "2001", "P1")]
    assert [r["reason"] for r in rejects.collect()] == ["year", "missing field", "missing field"]


def test_year_rules(spark):
    years = ["0", "-5", "2007", "2006", "1"]
    good, _ = raw.parse_books(lines(spark, *[BOOK.format(i, y) for i, y in enumerate(years)]))
    cleaned = cleaning.clean_books(good, "const")
    assert [r["year"] for r in cleaned.collect()] == [1994, 1994, 1994, 2006, 1]

    books = spark.createDataFrame(
        [("a", y, p) for y, p in zip(["2001", "0", "DK Publishing Inc", "2010", "1990", "2004", "2005"], "xxxxx" + "xx")],
        "isbn string, year_raw string, publisher string",
    )
    five = books.limit(5)
    assert cleaning.year_mean(five).first()[0] == 1500
    assert [r["year"] for r in cleaning.clean_books(five, "mean").collect()] == [2001, 1500, 1500, 1500, 1990]
    mean = cleaning.year_mean(books).first()[0]
    assert [r["year"] for r in cleaning.clean_books(books, "mean").collect()][5:] == [2004, mean]
    with pytest.raises(ValueError):
        cleaning.clean_books(books, "other")


def test_publisher_fill(spark):
    df = spark.createDataFrame([(None,), ("p",)], "publisher string")
    assert rows(df.select(cleaning.publisher_fill(F.col("publisher")))) == [("other",), ("p",)]


def test_rating_lines(spark):
    source = lines(
        spark,
        '"276725";"034545104X";"0"',
        '"276726";"0155061224";"5"',
        '"1";"X\'1";"7"',
        '"1";"X";"abc"',
        '"x";"X";"3"',
        '"x";"X";"0"',
        '"1";"X"',
    )
    good, rejects = raw.parse_ratings(source)
    assert good.count() + rejects.count() == source.count()
    assert rows(cleaning.drop_implicit(good)) == [(276726, "0155061224", 5), (1, "X1", 7)]
    assert [r["reason"] for r in rejects.collect()] == ["rating", "user_id", "missing field"]
    minimal, _ = raw.parse_ratings(source, isbn_rule="minimal")
    assert "X'1" in [r["isbn"] for r in minimal.collect()]
    with pytest.raises(Exception, match="bad (rating|user_id|missing field)"):
        raw.parse_ratings(source, mode="strict")[0].collect()


def test_user_lines(spark):
    source = lines(
        spark,
        '"1";"nyc, new york, usa";NULL',
        '"2";"moscow, russia";"95"',
        '"3";"x, germany";"30"',
        '"4";"NYC, USA";"0"',
        '"5";"a;b, usa";"40"',
        '"6";"x, canada"',
        '"abc";"x, usa";"20"',
    )
    good, rejects = raw.parse_users(source)
    assert rows(cleaning.clean_users(good, "const")) == [
        (1, "usa", 35),
        (2, "usa", 95),
        (3, "non-usa", 30),
        (4, "non-usa", 35),
        (5, "non-usa", 35),
        (6, "non-usa", 35),
    ]
    assert [r["reason"] for r in rejects.collect()] == ["user_id"]
    by_country = cleaning.clean_users(good, "const", match="country")
    assert [r["location"] for r in by_country.collect()] == ["usa", "non-usa", "non-usa", "usa", "non-usa", "non-usa"]


def test_age_range_rule(spark):
    users = spark.createDataFrame(
        [(1, "x", a) for a in ["5", "6", "89", "90", None, "NULL"]], "user_id bigint, location string, age_raw string"
    )
    filled = cleaning.clean_users(users, "range", fill=7)
    assert [r["age"] for r in filled.collect()] == [7, 6, 89, 7, 7, 7]
    mean = cleaning.clean_users(users, "range")
    assert [r["age"] for r in mean.collect()] == [47, 6, 89, 47, 47, 47]


def test_last_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), ("b", 1, "w")], "k string, o int, v string")
    assert sorted(rows(cleaning.last_per_key(df, ["k"], ["o"]))) == [("a", 3, "y"), ("b", 1, "w")]


def test_star(spark):
    books = spark.createDataFrame([("b1", "t1"), ("b2", "t2")], "isbn string, title string")
    users = spark.createDataFrame([(1, 30), (2, 40), (3, 50)], "user_id bigint, age int")
    ratings = spark.createDataFrame(
        [(1, "b1", 5), (2, "b1", 8), (9, "b1", 3), (1, "b3", 4), (3, "b2", 0)], "user_id bigint, isbn string, rating int"
    )
    joined = star(books, users, cleaning.drop_implicit(ratings))
    found = joined.select("isbn", "user_id", "rating", "title", "age").collect()
    assert sorted(tuple(r) for r in found) == [("b1", 1, 5, "t1", 30), ("b1", 2, 8, "t1", 40)]
    doubled = books.unionAll(books)
    assert star(doubled, users, cleaning.drop_implicit(ratings), dedup=False).count() == 4
    assert star(doubled, users, cleaning.drop_implicit(ratings)).count() == 2


def test_line_order_decides_the_last_book(spark, tmp_path):
    path = tmp_path / "books"
    path.mkdir()
    (path / "part").write_text('"1";"old";"A";"1990";"P"\n"1";"new";"A";"1991";"P"\n')
    good, _ = raw.parse_books(raw.read_lines(spark, str(path)))
    last = cleaning.last_per_key(good, ["isbn"], ["line_order"])
    assert [r["title"] for r in last.collect()] == ["new"]


def test_csv_readers(spark, tmp_path):
    (tmp_path / "b.csv").write_text(
        '"ISBN";"Book-Title";"Book-Author";"Year-Of-Publication";"Publisher";"Image-URL-S";"Image-URL-M";"Image-URL-L"\n'
        '"0001";"A; B";"C";"2001";"P";"s";"m";"l"\n'
    )
    (tmp_path / "u.csv").write_text('"User-ID";"Location";"Age"\n"1";"x; y, usa";NULL\n"2";"z";"30"\n')
    (tmp_path / "r.csv").write_text('"User-ID";"ISBN";"Book-Rating"\n"1";"0001";"5"\n')
    assert rows(raw.read_books_csv(spark, str(tmp_path / "b.csv"))) == [("0001", "A; B", "C", "2001", "P")]
    assert rows(raw.read_users_csv(spark, str(tmp_path / "u.csv"))) == [(1, "x; y, usa", None), (2, "z", "30")]
    assert rows(raw.read_ratings_csv(spark, str(tmp_path / "r.csv"))) == [(1, "0001", 5)]


def numbered(spark, n=4000):
    return spark.range(n).select(F.col("id").cast("string").alias("k"), (F.col("id") % 7).alias("v"))


def test_splits_lose_nothing(spark, tmp_path):
    df = numbered(spark)
    split = hash_split(df, ["k"])
    sizes = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    assert sum(sizes.values()) == 4000 and 300 < sizes["TEST"] < 500
    train, test = random_split(df, (0.9, 0.1), seed=3)
    assert train.count() + test.count() == 4000 and 300 < test.count() < 500
    assert train.intersect(test).count() == 0

    path = str(tmp_path / "split")
    tables.write_split(draw_split(df, 90, 5), path)
    train = tables.read_split(spark, path, tables.TRAIN)
    test = tables.read_split(spark, path, tables.TEST)
    assert train.unionAll(test).exceptAll(df).count() == 0
    assert train.count() + test.count() == 4000
    text = train._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in text
    with pytest.raises(Exception, match="already exists"):
        tables.write_split(split, path)
    tables.write_split(split, path, overwrite=True)


def test_samples_are_seeded(spark):
    df = numbered(spark)
    first, again = bootstrap(df, 0.9, 4), bootstrap(df, 0.9, 4)
    assert sorted(rows(first)) == sorted(rows(again))
    assert 3400 < first.count() < 3800
    assert first.distinct().count() < first.count()
    one, two = (bagged_sample(df, 66, i).count() for i in (1, 2))
    assert 2400 < one < 2900 and sorted(rows(bagged_sample(df, 66, 1))) != sorted(rows(bagged_sample(df, 66, 2)))
    train, test = sampled_split(df, seed=2)
    assert train.select("k").intersect(test.select("k")).count() == 0
    train, test = sampled_split(df, seed=2, leaky=True)
    assert train.select("k").intersect(test.select("k")).count() > 0


def test_average(spark):
    scores = spark.createDataFrame(
        [
            ("r1", "x", 5.0, 1, 4.0), ("r1", "x", 5.0, 2, 6.0),
            ("r2", "x", 5.0, 1, 8.0), ("r2", "x", 5.0, 2, 6.0),
            ("r3", "y", 7.0, 1, 7.0), ("r3", "y", 7.0, 2, 10.0),
        ],
        "row_key string, isbn string, actual double, model_id int, predicted double",
    )
    assert sorted(rows(average(scores))) == [("x", 5.0, 6.0), ("y", 7.0, 8.5)]
    by_row = average(scores, "row", ["row_key"]).select("predicted")
    assert sorted(rows(by_row)) == [(5.0,), (7.0,), (8.5,)]


def test_metrics(spark):
    df = spark.createDataFrame(
        [(5.0, 5.0), (10.0, 7.5), (1.0, 4.0), (8.0, 19 / 3)], "actual double, predicted double"
    )
    row = evaluate.metrics(df, "milli").first()
    assert (row["ape_milli"], row["sape_milli"], row["se_milli"]) == (3458, 858, 18027)
    assert row["mape"] == pytest.approx(86.45)
    assert row["smape"] == pytest.approx(21.45)
    assert row["rmse"] == pytest.approx(2.1229107)
    row = evaluate.metrics(df).first()
    assert row["n"] == 4
    assert row["mape"] == pytest.approx(86.458333)
    assert row["smape"] == pytest.approx(21.478406)
    assert row["rmse"] == pytest.approx(2.1229565)
    zero = spark.createDataFrame([(0.0, 0.0)], "actual double, predicted double")
    assert evaluate.metrics(zero).first()["mape"] is None
    assert evaluate.metrics(df.limit(0)).first()["n"] == 0


def test_metric_rows_and_predictions(spark, tmp_path):
    row = spark.range(1).select(F.lit(1.5).alias("rmse"))
    assert rows(tables.metric_rows(row, {"rmse": "RMSE"})) == [("RMSE", 1.5)]
    path = str(tmp_path / "p")
    df = spark.createDataFrame([("a", 1.0, 2.5)], "isbn string, actual double, predicted double")
    tables.write_table(df, path, "csv")
    assert rows(tables.read_predictions(spark, path)) == [("a", 1.0, 2.5)]
    assert tables.preview(numbered(spark)).count() == 5


def test_draws_do_not_depend_on_partitions(spark):
    df = numbered(spark)
    for keys in (["k"], None):
        two, seven = (bootstrap(df.repartition(n), 0.9, 4, keys) for n in (2, 7))
        assert sorted(rows(two)) == sorted(rows(seven))
        two, seven = (random_split(df.repartition(n), (0.9, 0.1), 4, keys)[1] for n in (2, 7))
        assert sorted(rows(two)) == sorted(rows(seven))
    again = df.unionAll(df)
    assert 6_800 < bootstrap(again, 0.9, 4).count() < 7_600


def test_exact_resample(spark):
    rows_ = [(i, "abc"[min(2, i // 40)] if i % 10 else None, "x") for i in range(100)]
    df = spark.createDataFrame(rows_, "k int, c string, _row string")

    def brute(pct, seed, bias):
        def draw(key):
            return int(hashlib.md5(f"{key}|{seed}".encode()).hexdigest()[:13], 16) / 16**13

        order = sorted(rows_, key=lambda r: (bool(bias) and r[1] is not None, r[1] or "" if bias else "", hashlib.md5(str(r[0]).encode()).hexdigest()))
        classes = [[r for r in order if r[1] == c] for c in dict.fromkeys(r[1] for r in order)]
        out = []
        for i in range(int(len(order) * pct / 100)):
            if bias and draw(f"bias|{i}") < bias:
                mine = classes[int(draw(f"class|{i}") * len(classes))]
                out.append(mine[int(draw(i) * len(mine))])
            else:
                out.append(order[int(draw(i) * len(order))])
        return sorted(out, key=repr)

    for pct, bias in ((66, 0.0), (150.9, 0.5), (100, 1.0), (0, 0.0), (0.5, 0.0)):
        for parts in (1, 5):
            got = sampling.resample(df.repartition(parts), pct, 3, ["k"], "c", bias)
            assert got.columns == df.columns
            assert sorted(rows(got), key=repr) == brute(pct, 3, bias)
    twice = df.select("c").unionAll(df.select("c"))
    one, two = (sorted(rows(sampling.resample(twice.repartition(n), 50, 3)), key=repr) for n in (2, 6))
    assert one == two and len(one) == 100
    assert sampling.resample(df.limit(0), 100, 3, ["k"], "c", 0.5).count() == 0
    assert bagged_sample(df, 66, 1, 1, ["k"], exact=True).count() == 66
    with pytest.raises(ValueError):
        sampling.resample(df, 10, bias=0.5)


def test_samples_of_any_mean(spark):
    rows = spark.range(100).withColumnRenamed("id", "k")
    n = sampling.bootstrap(rows, 1_000.5, 3, ["k"]).count()
    assert abs(n - 100_050) < 2_000
    assert sampling.bootstrap(rows, 64.0, 3, ["k"]).count() > 5_000
    assert sampling.bootstrap(rows, 0.0, 3, ["k"]).count() == 0
