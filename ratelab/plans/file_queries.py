"""Registered queries that write the test tables as text and read them back, and their SQL."""

from pyspark.sql import functions as F

from ratelab.functions.cleaning import clean_books, clean_users, drop_implicit
from ratelab.operators import evaluate
from ratelab.operators.star import star
from ratelab.plans import proxies
from ratelab.plans.rating_queries import BOOKS_SQL, RATINGS_SQL, USERS_SQL, ensemble_average
from ratelab.plans.rating_queries import ORACLE as RATING_ORACLE
from ratelab.schemas import BOOKS_CSV_HEADER, RATINGS_CSV_HEADER, USERS_CSV_HEADER
from ratelab.shared import scratch_table_path
from ratelab.sources.edges import read_edges
from ratelab.sources.ratings import read_books_csv, read_ratings_csv, read_users_csv
from ratelab.sources.specs import NAIVE_BAYES, NEIGHBOURS, STUMP, TREE, specs_frame
from ratelab.sources.tables import read_predictions, write_table


def edges_text_strict(spark, sf_dir):
    """The second write replaces the first."""
    path = scratch_table_path(spark, "edges")
    edges = proxies.all_edges(spark, sf_dir)
    write_table(edges.select("dst", "src"), path, "csv")
    write_table(edges, path, "csv", overwrite=True)
    return read_edges(spark, path)


def edges_text_drop(spark, sf_dir):
    """Every tenth part is named, not numbered."""
    path = scratch_table_path(spark, "edges")
    number = F.col("src").cast("string")
    src = F.when(F.col("src") % 10 == 0, F.concat(F.lit("part "), number)).otherwise(number)
    write_table(proxies.all_edges(spark, sf_dir).withColumn("src", src), path, "csv")
    return read_edges(spark, path, mode="drop")


def csv_star(spark, sf_dir):
    """Files with a header; books of every fifth year have two editions, and every rating meets both."""
    path = scratch_table_path(spark, "csv")
    books = proxies.books(spark, sf_dir)
    second = books.where(F.col("year_raw").cast("int") % 5 == 0).withColumn("title", F.concat("title", F.lit(" 2")))
    images = [F.concat(F.lit("http://images/"), F.col("isbn")) for _ in BOOKS_CSV_HEADER[5:]]
    _write_csv(books.union(second).select("*", *images), f"{path}/books", BOOKS_CSV_HEADER)
    users = proxies.users(spark, sf_dir).select("user_id", "location", "age_raw")
    _write_csv(users, f"{path}/users", USERS_CSV_HEADER)
    ratings = proxies.ratings(spark, sf_dir).select("user_id", "isbn", "rating")
    _write_csv(ratings, f"{path}/ratings", RATINGS_CSV_HEADER)
    return star(
        clean_books(read_books_csv(spark, f"{path}/books")),
        clean_users(read_users_csv(spark, f"{path}/users")),
        drop_implicit(read_ratings_csv(spark, f"{path}/ratings")),
        dedup=False,
        hot=proxies.hot_books_and_users(spark, sf_dir),
    )


def _write_csv(df, path, header):
    df.toDF(*header).write.csv(path, header=True, sep=";")


def predictions_text(spark, sf_dir):
    """Averages written as lines of commas, measured from the lines."""
    path = scratch_table_path(spark, "predictions")
    write_table(ensemble_average(spark, sf_dir), path, "csv")
    row = evaluate.metrics(read_predictions(spark, path))
    return row.withColumns({c: F.round(c, 6) for c in ("mape", "smape", "rmse")})


def spec_lines(spark, sf_dir):
    """A specification per part; every tenth size leaves a blank line."""
    path = scratch_table_path(spark, "specs")
    size = F.col("p_size")
    algo = (
        F.when(size % 4 == 0, f":{TREE}:-C")
        .when(size % 4 == 1, f":{NAIVE_BAYES}")
        .when(size % 4 == 2, f":{STUMP}")
        .otherwise(F.concat(F.lit(f":{NEIGHBOURS}:"), size.cast("string")))
    )
    line = F.when(size % 10 == 0, " ").otherwise(F.concat(size.cast("string"), algo))
    write_table(proxies.table(spark, sf_dir, "part").select(line.alias("value")), path, "text")
    return specs_frame(spark, path)


QUERIES = {
    "edges_text_strict": edges_text_strict,
    "edges_text_drop": edges_text_drop,
    "csv_star": csv_star,
    "predictions_text": predictions_text,
    "spec_lines": spec_lines,
}

ORACLE = {
    "edges_text_strict": "SELECT l_partkey AS src, l_suppkey AS dst FROM lineitem",
    "edges_text_drop": "SELECT l_partkey AS src, l_suppkey AS dst FROM lineitem WHERE l_partkey % 10 <> 0",
    "csv_star": f"""WITH {BOOKS_SQL}, {USERS_SQL}, {RATINGS_SQL},
        editions AS (SELECT * FROM books_const
                     UNION ALL
                     SELECT isbn, title || ' 2', author, year, publisher
                     FROM books_const SEMI JOIN (SELECT isbn FROM books WHERE raw_year % 5 = 0) USING (isbn))
        SELECT user_id, isbn, rating, title, author, year, publisher, location, age
        FROM ratings JOIN editions USING (isbn) JOIN users_const USING (user_id)""",
    "predictions_text": RATING_ORACLE["metrics_exact"],
    "spec_lines": f"""
        SELECT CAST(p_size AS DOUBLE) AS sample_pct,
               CASE p_size % 4 WHEN 0 THEN '{TREE}' WHEN 1 THEN '{NAIVE_BAYES}'
                               WHEN 2 THEN '{STUMP}' ELSE '{NEIGHBOURS}' END AS algo,
               CASE p_size % 4 WHEN 0 THEN '-C' WHEN 3 THEN CAST(p_size AS VARCHAR) END AS param
        FROM part WHERE p_size % 10 <> 0""",
}
