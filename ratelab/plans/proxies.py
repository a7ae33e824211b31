"""The test tables read as the two domains.

Graph: a line item is an edge from its part to its supplier. Ratings: parts are
books, customers are users, line items are ratings.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelab.functions.cleaning import clean_books, clean_users, drop_implicit
from ratelab.operators.graph import filter_max_id
from ratelab.operators.joins import ROWS_PER_SLICE, HotKeys, hot_keys
from ratelab.operators.star import star

# Unique at the larger scale factors.
ROW_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LINES_PER_ORDER = 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def all_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst")
    )


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges between ids that both kinds of node use."""
    largest = table(spark, sf_dir, "supplier").agg(F.max("s_suppkey")).scalar()
    return filter_max_id(all_edges(spark, sf_dir), largest)


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("isbn"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("author"),
        (F.col("p_size") + 1960).cast("string").alias("year_raw"),
        F.col("p_type").alias("publisher"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").alias("user_id"),
            F.lower("r_name").alias("location"),
            (F.col("c_acctbal") / 100).cast("int").cast("string").alias("age_raw"),
        )
    )


def rating_value() -> Column:
    return F.col("l_quantity").cast("int") % 11


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ordered_items(spark, sf_dir).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").cast("string").alias("isbn"),
        rating_value().alias("rating"),
        row_key().alias("row_key"),
    )


def _ordered_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select(*ROW_KEY, "l_quantity")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    # An order has a handful of lines: no key is hot.
    return items.join(orders, "l_orderkey")


def row_key() -> Column:
    return F.concat_ws("|", *ROW_KEY)


def hot_books_and_users(spark: SparkSession, sf_dir: str) -> tuple[HotKeys, HotKeys]:
    """From one column of lineitem and one of orders, before any join."""
    isbns = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").cast("string").alias("isbn"))
    buyers = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("user_id"))
    (hot_books,) = hot_keys(isbns, ["isbn"])
    # Orders stand for up to LINES_PER_ORDER ratings each.
    (hot_users,) = hot_keys(buyers, ["user_id"], rows_per_slice=ROWS_PER_SLICE // LINES_PER_ORDER)
    return hot_books, hot_users


def rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned star with the row key, constant rules."""
    return star(
        clean_books(books(spark, sf_dir)),
        clean_users(users(spark, sf_dir)),
        drop_implicit(ratings(spark, sf_dir)),
        hot=hot_books_and_users(spark, sf_dir),
    )


# Raw lines, as the reader would find them, with the faults real files have.


def book_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 7th size has a comma and an entity in the title, every 11th a
    publisher in the year field, every 13th a missing tail."""
    size = F.col("p_size")
    title = F.when(size % 7 == 0, F.concat("p_name", F.lit(", it's R&amp;D"))).otherwise(F.col("p_name"))
    year = F.when(size % 11 == 0, "DK Publishing Inc").otherwise((size + 1960).cast("string"))
    tail = F.when(size % 13 == 0, "").otherwise(F.concat(F.lit('";"'), year, F.lit('";"'), "p_type"))
    line = F.concat(
        F.lit('"'), F.col("p_partkey").cast("string"), F.lit('";"'), title,
        F.lit('";"'), "p_brand", tail, F.lit('"'),
    )
    return table(spark, sf_dir, "part").select(line.alias("line"))


def rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 13th sum of part and line number has a bad user, quantities over
    45 a bad rating."""
    user = F.when((F.col("l_partkey") + F.col("l_linenumber")) % 13 == 0, "x").otherwise(
        F.col("o_custkey").cast("string")
    )
    value = F.when(F.col("l_quantity") > 45, "n/a").otherwise(rating_value().cast("string"))
    line = F.concat(
        F.lit('"'), user, F.lit('";"'), F.col("l_partkey").cast("string"),
        F.lit('";"'), value, F.lit('"'),
    )
    return _ordered_items(spark, sf_dir).select(line.alias("line"))


def user_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 10th customer has no age, every 17th a bad id, every 19th a
    semicolon inside the location."""
    key = F.col("user_id")
    uid = F.when(key % 17 == 0, F.concat(F.lit("id"), key.cast("string"))).otherwise(key.cast("string"))
    place = F.when(key % 19 == 0, F.concat(F.lit("a;"), "location")).otherwise(F.col("location"))
    age = F.when(key % 10 == 0, "NULL").otherwise(F.col("age_raw"))
    line = F.concat(F.lit('"'), uid, F.lit('";"'), place, F.lit('";"'), age, F.lit('"'))
    return users(spark, sf_dir).select(line.alias("line"))
