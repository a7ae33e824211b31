"""Registered parsing, cleaning, join, split and metric queries and their SQL."""

from pyspark.sql import functions as F

from ratelab.functions import cleaning
from ratelab.operators import ensemble, evaluate
from ratelab.operators.features import fit_index
from ratelab.operators.joins import hot_keys, skew_join
from ratelab.operators.sampling import (
    DIGITS,
    bagged_sample,
    bootstrap,
    hash_split,
    poisson_steps,
    random_split,
    resample,
)
from ratelab.operators.star import join_books as rated_books
from ratelab.plans import proxies
from ratelab.shared import scratch_table_path
from ratelab.sources import ratings as raw
from ratelab.sources.tables import TEST, TRAIN, read_split, write_split

KEY = ["row_key"]


# --- parsing ---------------------------------------------------------------


def parse_books(spark, sf_dir):
    return raw.parse_books(proxies.book_lines(spark, sf_dir))[0]


def parse_ratings(spark, sf_dir):
    return cleaning.drop_implicit(raw.parse_ratings(proxies.rating_lines(spark, sf_dir))[0])


def parse_users(spark, sf_dir):
    return raw.parse_users(proxies.user_lines(spark, sf_dir))[0]


def rejects_count(spark, sf_dir):
    """Rejected lines by source and reason."""
    sources = {
        "books": raw.parse_books(proxies.book_lines(spark, sf_dir))[1],
        "ratings": raw.parse_ratings(proxies.rating_lines(spark, sf_dir))[1],
        "users": raw.parse_users(proxies.user_lines(spark, sf_dir))[1],
    }
    counted = None
    for name, rejects in sources.items():
        rows = rejects.groupBy(F.lit(name).alias("source"), "reason").agg(F.count(F.lit(1)).alias("lines"))
        counted = rows if counted is None else counted.unionAll(rows)
    return counted


# --- cleaning --------------------------------------------------------------


def ratings_nonzero(spark, sf_dir):
    items = proxies.table(spark, sf_dir, "lineitem")
    rated = items.select(proxies.row_key().alias("row_key"), proxies.rating_value().alias("rating"))
    return cleaning.drop_implicit(rated)


def clean_books_const(spark, sf_dir):
    return cleaning.clean_books(proxies.books(spark, sf_dir), "const")


def clean_books_mean(spark, sf_dir):
    return cleaning.clean_books(proxies.books(spark, sf_dir), "mean")


def year_mean(spark, sf_dir):
    return cleaning.year_mean(proxies.books(spark, sf_dir))


def publisher_fill(spark, sf_dir):
    books = proxies.books(spark, sf_dir)
    known = F.nullif(F.col("publisher"), F.lit("ECONOMY"))
    return books.select("isbn", cleaning.publisher_fill(known).alias("publisher"))


def clean_users_const(spark, sf_dir):
    return cleaning.clean_users(proxies.users(spark, sf_dir), "const")


def clean_users_range(spark, sf_dir):
    return cleaning.clean_users(proxies.users(spark, sf_dir), "range")


def clean_users_year(spark, sf_dir):
    """The range rule filled with the mean publication year."""
    fill = cleaning.year_mean(proxies.books(spark, sf_dir)).scalar()
    return cleaning.clean_users(proxies.users(spark, sf_dir), "range", fill)


def location_bucket(spark, sf_dir):
    users = proxies.users(spark, sf_dir)
    return users.select(
        "user_id",
        cleaning.location_bucket(F.col("location")).alias("substring"),
        cleaning.location_bucket(F.col("location"), "country").alias("country"),
    )


def books_dedup(spark, sf_dir):
    """Titles repeat across parts; the one with the highest part key stays."""
    parts = proxies.table(spark, sf_dir, "part").select("p_name", "p_partkey", "p_brand", "p_size")
    return cleaning.last_per_key(parts, ["p_name"], ["p_partkey"])


# --- joins and splits ------------------------------------------------------


def join_books_ratings(spark, sf_dir):
    ratings = cleaning.drop_implicit(proxies.ratings(spark, sf_dir))
    return rated_books(ratings, cleaning.clean_books(proxies.books(spark, sf_dir)))


def join_star(spark, sf_dir):
    return proxies.rated(spark, sf_dir)


def _split(spark, sf_dir):
    return hash_split(proxies.rated(spark, sf_dir), KEY)


def split_query(spark, sf_dir):
    return _split(spark, sf_dir).select("row_key", "split")


def read_split_train(spark, sf_dir):
    """Both sides written in one pass, one read back."""
    path = scratch_table_path(spark, "split")
    write_split(_split(spark, sf_dir), path)
    return read_split(spark, path, TRAIN)


def random_split_query(spark, sf_dir):
    train, test = random_split(proxies.rated(spark, sf_dir).select("row_key", "isbn", "rating"), key_cols=KEY)
    return train.withColumn("split", F.lit(TRAIN)).unionAll(test.withColumn("split", F.lit(TEST)))


def bootstrap_query(spark, sf_dir):
    return bootstrap(proxies.rated(spark, sf_dir), 0.9, seed=7, key_cols=KEY)


def bagged_sample_query(spark, sf_dir):
    train = _split(spark, sf_dir).filter(F.col("split") == TRAIN)
    return bagged_sample(train, 66, model_id=2, base_seed=7, key_cols=KEY)


def feature_index(spark, sf_dir):
    """Indexes made on the train side, applied to every row."""
    columns = ["age", "year", "location", "publisher", "isbn"]
    path = scratch_table_path(spark, "indexed")
    rows = _split(spark, sf_dir).select("row_key", *columns, "split")
    # Read twice: the columns in question are written, the joins before aren't repeated.
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    index = fit_index(rows.filter(F.col("split") == TRAIN).select(columns), columns)
    return index.transform(rows.drop("split")).select(
        "row_key", *[F.col(f"{c}_index").cast("bigint").alias(f"{c}_index") for c in columns]
    )


def exact_resample(spark, sf_dir):
    """Exactly 66 % of the train rows, as the bag of a model."""
    train = _split(spark, sf_dir).filter(F.col("split") == TRAIN).drop("split")
    return bagged_sample(train, 66, model_id=2, base_seed=7, key_cols=KEY, exact=True)


def biased_resample(spark, sf_dir):
    """Exactly 150 % of all rows, half of the draws by class first."""
    return resample(proxies.rated(spark, sf_dir), 150, 3, KEY, label="rating", bias=0.5)


# --- ensemble arithmetic with predictors that SQL can restate ---------------


def ensemble_scores(spark, sf_dir):
    """Three simple predictors learned on the train side score the test side."""
    split = _split(spark, sf_dir)
    train = split.filter(F.col("split") == TRAIN).select("isbn", "age", "rating")
    test = split.filter(F.col("split") == TEST).select("row_key", "isbn", "age", "rating")
    by_isbn = train.groupBy("isbn").agg(F.min("rating").alias("low"), F.max("rating").alias("high"))
    by_age = train.groupBy("isbn", "age").agg(F.round(F.avg("rating")).alias("mean"))
    hot_isbn, hot_age = hot_keys(test, ["isbn"], ["isbn", "age"])
    wide = skew_join(test, by_isbn, ["isbn"], "left", hot_isbn)
    wide = skew_join(wide, by_age, ["isbn", "age"], "left", hot_age)
    members = F.array(
        *[
            F.struct(F.lit(i).alias("model_id"), F.col(c).cast("double").alias("predicted"))
            for i, c in ((1, "low"), (2, "high"), (3, "mean"))
        ]
    )
    return wide.select(
        "row_key", "isbn", F.col("rating").cast("double").alias("actual"), F.inline(members)
    ).filter(F.col("predicted").isNotNull())


def ensemble_average(spark, sf_dir):
    return ensemble.average(ensemble_scores(spark, sf_dir))


def ensemble_average_row(spark, sf_dir):
    return ensemble.average(ensemble_scores(spark, sf_dir), "row", KEY)


def error_terms(spark, sf_dir):
    terms = evaluate.error_terms(ensemble_average(spark, sf_dir))
    return terms.withColumns({c: F.round(c, 6) for c in ("ape", "sape", "se")})


def metrics_milli(spark, sf_dir):
    row = evaluate.metrics(ensemble_average(spark, sf_dir), "milli")
    return row.withColumns({c: F.round(c, 6) for c in ("mape", "smape", "rmse")})


def metrics_exact(spark, sf_dir):
    row = evaluate.metrics(ensemble_average(spark, sf_dir), "exact")
    return row.withColumns({c: F.round(c, 6) for c in ("mape", "smape", "rmse")})


QUERIES = {
    "parse_books": parse_books,
    "parse_ratings": parse_ratings,
    "parse_users": parse_users,
    "rejects_count": rejects_count,
    "ratings_nonzero": ratings_nonzero,
    "clean_books_const": clean_books_const,
    "clean_books_mean": clean_books_mean,
    "year_mean": year_mean,
    "publisher_fill": publisher_fill,
    "clean_users_const": clean_users_const,
    "clean_users_range": clean_users_range,
    "clean_users_year": clean_users_year,
    "location_bucket": location_bucket,
    "books_dedup": books_dedup,
    "join_books_ratings": join_books_ratings,
    "join_star": join_star,
    "hash_split": split_query,
    "read_split_train": read_split_train,
    "random_split": random_split_query,
    "bootstrap": bootstrap_query,
    "bagged_sample": bagged_sample_query,
    "exact_resample": exact_resample,
    "biased_resample": biased_resample,
    "feature_index": feature_index,
    "ensemble_scores": ensemble_scores,
    "ensemble_average": ensemble_average,
    "ensemble_average_row": ensemble_average_row,
    "error_terms": error_terms,
    "metrics_milli": metrics_milli,
    "metrics_exact": metrics_exact,
}

# --- SQL --------------------------------------------------------------------

ROW_KEY_SQL = "concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey)"
RATING_SQL = "CAST(l_quantity AS INTEGER) % 11"
BOOKS_SQL = """
books AS (SELECT CAST(p_partkey AS VARCHAR) AS isbn, p_name AS title, p_brand AS author,
                 1960 + p_size AS raw_year, p_type AS publisher FROM part),
books_const AS (SELECT isbn, title, author,
                       CASE WHEN raw_year BETWEEN 1 AND 2006 THEN raw_year ELSE 1994 END AS year,
                       publisher FROM books)
"""
USERS_SQL = """
users AS (SELECT c_custkey AS user_id, lower(r_name) AS location,
                 CAST(trunc(c_acctbal / 100) AS INTEGER) AS raw_age
          FROM customer JOIN nation ON c_nationkey = n_nationkey
                        JOIN region ON n_regionkey = r_regionkey),
users_const AS (SELECT user_id,
                       CASE WHEN contains(location, 'us') OR contains(location, 'america')
                            THEN 'usa' ELSE 'non-usa' END AS location,
                       CASE WHEN raw_age > 0 THEN raw_age ELSE 35 END AS age FROM users)
"""
RATINGS_SQL = f"""
ratings AS (SELECT o_custkey AS user_id, CAST(l_partkey AS VARCHAR) AS isbn,
                   {RATING_SQL} AS rating, {ROW_KEY_SQL} AS row_key
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey
            WHERE {RATING_SQL} <> 0)
"""
RATED_SQL = f"""{BOOKS_SQL}, {USERS_SQL}, {RATINGS_SQL},
rated AS (SELECT user_id, isbn, rating, row_key, title, author, year, publisher, location, age
          FROM ratings JOIN books_const USING (isbn) JOIN users_const USING (user_id))
"""
SPLIT_SQL = f"""{RATED_SQL},
split AS (SELECT *, CASE WHEN CAST('0x' || substr(md5(row_key), 1, 8) AS BIGINT) % 100 < 90
                         THEN 'TRAIN' ELSE 'TEST' END AS split FROM rated),
train AS (SELECT * EXCLUDE (split) FROM split WHERE split = 'TRAIN'),
test AS (SELECT * EXCLUDE (split) FROM split WHERE split = 'TEST')
"""
BOOK_LINES_SQL = """
book_lines AS (SELECT CAST(p_partkey AS VARCHAR) AS isbn,
                      CASE WHEN p_size % 7 = 0 THEN p_name || ' its RandD' ELSE p_name END AS title,
                      p_brand AS author,
                      CASE WHEN p_size % 13 = 0 THEN 'missing field'
                           WHEN p_size % 11 = 0 THEN 'year' END AS reason,
                      CAST(1960 + p_size AS VARCHAR) AS year_raw, p_type AS publisher
               FROM part)
"""
RATING_LINES_SQL = f"""
rating_lines AS (SELECT CASE WHEN l_quantity > 45 THEN 'rating'
                             WHEN (l_partkey + l_linenumber) % 13 = 0 AND {RATING_SQL} <> 0
                             THEN 'user_id' END AS reason,
                        CASE WHEN (l_partkey + l_linenumber) % 13 = 0 THEN NULL
                             ELSE o_custkey END AS user_id,
                        CAST(l_partkey AS VARCHAR) AS isbn, {RATING_SQL} AS rating
                 FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""
USER_LINES_SQL = f"""{USERS_SQL},
user_lines AS (SELECT CASE WHEN user_id % 17 = 0 THEN 'user_id' END AS reason, user_id,
                      CASE WHEN user_id % 19 = 0 THEN 'a' ELSE location END AS location,
                      CASE WHEN user_id % 19 = 0 THEN location
                           WHEN user_id % 10 = 0 THEN 'NULL'
                           ELSE CAST(raw_age AS VARCHAR) END AS age_raw FROM users)
"""
YEAR_MEAN_SQL = "(SELECT CAST(trunc(avg(raw_year)) AS INTEGER) FROM books)"
SCORES_SQL = f"""{SPLIT_SQL},
low_high AS (SELECT isbn, min(rating) AS low, max(rating) AS high FROM train GROUP BY isbn),
by_age AS (SELECT isbn, age, round(avg(rating)) AS mean FROM train GROUP BY isbn, age),
scores AS (SELECT row_key, isbn, CAST(rating AS DOUBLE) AS actual, 1 AS model_id,
                  CAST(low AS DOUBLE) AS predicted FROM test JOIN low_high USING (isbn)
           UNION ALL
           SELECT row_key, isbn, CAST(rating AS DOUBLE), 2, CAST(high AS DOUBLE)
           FROM test JOIN low_high USING (isbn)
           UNION ALL
           SELECT row_key, isbn, CAST(rating AS DOUBLE), 3, CAST(mean AS DOUBLE)
           FROM test JOIN by_age USING (isbn, age)),
averaged AS (SELECT isbn, actual, avg(predicted) AS predicted FROM scores GROUP BY isbn, actual),
terms AS (SELECT *, abs((actual - predicted) / actual) AS ape,
                 abs(predicted - actual) / (abs(actual) + abs(predicted)) AS sape,
                 (actual - predicted) * (actual - predicted) AS se FROM averaged)
"""


def _index_sql(columns):
    parts = []
    for c in columns:
        parts.append(
            f"{c}_labels AS (SELECT label, row_number() OVER (ORDER BY n DESC, label) - 1 AS i FROM "
            f"(SELECT CAST({c} AS VARCHAR) AS label, count(*) AS n FROM train GROUP BY 1))"
        )
    values = ", ".join(
        f"coalesce({c}_labels.i, (SELECT count(*) FROM {c}_labels)) AS {c}_index" for c in columns
    )
    joins = " ".join(
        f"LEFT JOIN {c}_labels ON CAST(rated.{c} AS VARCHAR) = {c}_labels.label" for c in columns
    )
    return f"WITH {SPLIT_SQL}, {', '.join(parts)} SELECT row_key, {values} FROM rated {joins}"



def _draw_sql(seed):
    return f"CAST('0x' || substr(md5(row_key || '|{seed}'), 1, {DIGITS}) AS BIGINT) / {float(16**DIGITS)!r}::DOUBLE"


def copies_sql(table, fraction, seed):
    """Rows of a table as often as their draw says."""
    steps = " + ".join(f"CAST(draw >= {s!r}::DOUBLE AS INTEGER)" for s in poisson_steps(fraction))
    return f"""
        SELECT * EXCLUDE (draw, copy)
        FROM (SELECT *, unnest(range({steps})) AS copy FROM (SELECT *, {_draw_sql(seed)} AS draw FROM {table}))"""


def resample_sql(table, pct, seed, label=None, bias=0.0):
    """Exactly that percentage of a table's rows; each draw takes a place."""

    def place(purpose, upto):
        key = f"{purpose!r} || '|' || i" if purpose else "CAST(i AS VARCHAR)"
        return f"CAST(floor(({_draw_sql(seed).replace('row_key', key)}) * {upto}) AS BIGINT)"

    first = f"{label}, " if bias else ""
    biased = _draw_sql(seed).replace("row_key", "'bias' || '|' || i")
    classes = f"""classes AS (SELECT min(place) AS start, count(*) AS n, row_number() OVER (ORDER BY min(place)) - 1 AS nth
                 FROM placed GROUP BY {label}),""" if bias else ""
    by_class = f"""CASE WHEN {biased} < {bias!r}::DOUBLE
        THEN (SELECT start + {place("", "n")} FROM classes WHERE nth = {place("class", "(SELECT count(*) FROM classes)")})
        ELSE {place("", "(SELECT count(*) FROM placed)")} END""" if bias else place("", "(SELECT count(*) FROM placed)")
    return f"""placed AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY {first}md5(row_key)) - 1 AS place FROM {table}),
        {classes}
        draws AS MATERIALIZED (SELECT {by_class} AS place
                  FROM range((SELECT CAST(floor(count(*) * {pct} / 100) AS BIGINT) FROM placed)) AS r(i))
        SELECT placed.* EXCLUDE (place) FROM placed JOIN draws USING (place)"""


ORACLE = {
    "exact_resample": f"WITH {SPLIT_SQL}, {resample_sql('train', 66, 9)}",
    "biased_resample": f"WITH {RATED_SQL}, {resample_sql('rated', 150, 3, 'rating', 0.5)}",
    "random_split": f"""
        WITH {RATED_SQL}
        SELECT row_key, isbn, rating, CASE WHEN {_draw_sql(1)} < 0.9::DOUBLE THEN 'TRAIN' ELSE 'TEST' END AS split
        FROM rated""",
    "bootstrap": f"WITH {RATED_SQL} {copies_sql('rated', 0.9, 7)}",
    "bagged_sample": f"WITH {SPLIT_SQL}, marked AS (SELECT *, 'TRAIN' AS split FROM train) "
    f"{copies_sql('marked', 0.66, 9)}",
    "parse_books": f"""WITH {BOOK_LINES_SQL}
        SELECT isbn, title, author, year_raw, publisher FROM book_lines WHERE reason IS NULL""",
    "parse_ratings": f"""WITH {RATING_LINES_SQL}
        SELECT user_id, isbn, rating FROM rating_lines WHERE reason IS NULL AND rating <> 0""",
    "parse_users": f"""WITH {USER_LINES_SQL}
        SELECT user_id, location, age_raw FROM user_lines WHERE reason IS NULL""",
    "rejects_count": f"""WITH {BOOK_LINES_SQL}, {RATING_LINES_SQL}, {USER_LINES_SQL}
        SELECT 'books' AS source, reason, count(*) AS lines FROM book_lines
        WHERE reason IS NOT NULL GROUP BY reason
        UNION ALL SELECT 'ratings', reason, count(*) FROM rating_lines
        WHERE reason IS NOT NULL GROUP BY reason
        UNION ALL SELECT 'users', reason, count(*) FROM user_lines
        WHERE reason IS NOT NULL GROUP BY reason""",
    "ratings_nonzero": f"""
        SELECT {ROW_KEY_SQL} AS row_key, {RATING_SQL} AS rating FROM lineitem WHERE {RATING_SQL} <> 0""",
    "clean_books_const": f"WITH {BOOKS_SQL} SELECT * FROM books_const",
    "clean_books_mean": f"""WITH {BOOKS_SQL}
        SELECT isbn, title, author,
               CASE WHEN raw_year = 0 OR raw_year >= 2005 THEN {YEAR_MEAN_SQL} ELSE raw_year END AS year,
               coalesce(publisher, 'other') AS publisher FROM books""",
    "year_mean": f"WITH {BOOKS_SQL} SELECT {YEAR_MEAN_SQL} AS year_mean",
    "publisher_fill": """
        SELECT CAST(p_partkey AS VARCHAR) AS isbn,
               coalesce(nullif(p_type, 'ECONOMY'), 'other') AS publisher FROM part""",
    "clean_users_const": f"WITH {USERS_SQL} SELECT * FROM users_const",
    "clean_users_range": f"""WITH {USERS_SQL}
        SELECT user_id, location, CASE WHEN raw_age > 5 AND raw_age < 90 THEN raw_age
               ELSE (SELECT CAST(trunc(avg(raw_age)) AS INTEGER) FROM users
                     WHERE raw_age > 5 AND raw_age < 90) END AS age FROM users""",
    "clean_users_year": f"""WITH {BOOKS_SQL}, {USERS_SQL}
        SELECT user_id, location, CASE WHEN raw_age > 5 AND raw_age < 90 THEN raw_age
               ELSE {YEAR_MEAN_SQL} END AS age FROM users""",
    "location_bucket": f"""WITH {USERS_SQL}
        SELECT user_id,
               CASE WHEN contains(location, 'us') OR contains(location, 'america')
                    THEN 'usa' ELSE 'non-usa' END AS substring,
               CASE WHEN location IN ('usa', 'us', 'america') THEN 'usa' ELSE 'non-usa' END AS country
        FROM users""",
    "books_dedup": """
        SELECT p_name, p_partkey, p_brand, p_size FROM part
        QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey DESC) = 1""",
    "join_books_ratings": f"""WITH {BOOKS_SQL}, {RATINGS_SQL}
        SELECT isbn, user_id, rating, row_key, title, author, year, publisher
        FROM ratings JOIN books_const USING (isbn)""",
    "join_star": f"WITH {RATED_SQL} SELECT * FROM rated",
    "hash_split": f"WITH {SPLIT_SQL} SELECT row_key, split FROM split",
    "read_split_train": f"WITH {SPLIT_SQL} SELECT * FROM train",
    "feature_index": _index_sql(["age", "year", "location", "publisher", "isbn"]),
    "ensemble_scores": f"WITH {SCORES_SQL} SELECT * FROM scores",
    "ensemble_average": f"WITH {SCORES_SQL} SELECT * FROM averaged",
    "ensemble_average_row": f"""WITH {SCORES_SQL}
        SELECT row_key, isbn, actual, avg(predicted) AS predicted FROM scores
        GROUP BY row_key, isbn, actual""",
    "error_terms": f"""WITH {SCORES_SQL}
        SELECT isbn, actual, predicted, round(ape, 6) AS ape, round(sape, 6) AS sape,
               round(se, 6) AS se FROM terms""",
    "metrics_exact": f"""WITH {SCORES_SQL}
        SELECT count(*) AS n, round(100 * sum(ape) / count(*), 6) AS mape,
               round(100 * sum(sape) / count(*), 6) AS smape,
               round(sqrt(sum(se) / count(*)), 6) AS rmse FROM terms""",
    "metrics_milli": f"""WITH {SCORES_SQL},
        sums AS (SELECT count(*) AS n, CAST(sum(CAST(floor(ape * 1000) AS BIGINT)) AS BIGINT) AS ape_milli,
                        CAST(sum(CAST(floor(sape * 1000) AS BIGINT)) AS BIGINT) AS sape_milli,
                        CAST(sum(CAST(floor(se * 1000) AS BIGINT)) AS BIGINT) AS se_milli FROM terms)
        SELECT n, ape_milli, sape_milli, se_milli,
               round(100 * (ape_milli / 1000.0::DOUBLE) / n, 6) AS mape,
               round(100 * (sape_milli / 1000.0::DOUBLE) / n, 6) AS smape,
               round(sqrt(se_milli / 1000.0::DOUBLE / n), 6) AS rmse FROM sums""",
}
