"""Explicit schemas; nothing in the package infers one."""

from pyspark.sql import types as T


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


EDGE_TEXT = _schema(src=T.StringType(), dst=T.StringType())
EDGES = _schema(src=T.LongType(), dst=T.LongType())

BOOKS_RAW = _schema(
    isbn=T.StringType(),
    title=T.StringType(),
    author=T.StringType(),
    year_raw=T.StringType(),
    publisher=T.StringType(),
)
USERS_RAW = _schema(
    user_id_raw=T.StringType(), location=T.StringType(), age_raw=T.StringType()
)
RATINGS_RAW = _schema(
    user_id_raw=T.StringType(), isbn=T.StringType(), rating_raw=T.StringType()
)

STAR = _schema(
    isbn=T.StringType(),
    title=T.StringType(),
    author=T.StringType(),
    year=T.IntegerType(),
    publisher=T.StringType(),
    location=T.StringType(),
    age=T.IntegerType(),
    rating=T.IntegerType(),
)
MODEL_SPECS = _schema(
    sample_pct=T.DoubleType(), algo=T.StringType(), param=T.StringType()
)
PREDICTIONS = _schema(
    isbn=T.StringType(), actual=T.DoubleType(), predicted=T.DoubleType()
)

# Header names of the semicolon-separated ratings files.
BOOKS_CSV_HEADER = (
    "ISBN",
    "Book-Title",
    "Book-Author",
    "Year-Of-Publication",
    "Publisher",
    "Image-URL-S",
    "Image-URL-M",
    "Image-URL-L",
)
USERS_CSV_HEADER = ("User-ID", "Location", "Age")
RATINGS_CSV_HEADER = ("User-ID", "ISBN", "Book-Rating")
