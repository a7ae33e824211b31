"""Cleaning rules for years, publishers, ages, locations and ratings."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the constant rules.
DEFAULT_YEAR = 1994
LAST_VALID_YEAR = 2006
DEFAULT_AGE = 35
# Fixed values of the data-driven rules.
FIRST_BAD_YEAR = 2005
CHILD_AGE = 5
OLD_AGE = 90
NO_PUBLISHER = "other"
# Location buckets and the fragments that select the first one.
HOME, ABROAD = "usa", "non-usa"
HOME_FRAGMENTS = ("usa", "us", "america")


def drop_implicit(ratings: DataFrame) -> DataFrame:
    return ratings.filter(F.col("rating") != 0)


def year_const(year: Column) -> Column:
    return F.when(year.between(1, LAST_VALID_YEAR), year).otherwise(DEFAULT_YEAR)


def year_mean(books: DataFrame, year: str = "year_raw") -> DataFrame:
    """One row: the mean of all parseable years, bad ones included, truncated."""
    mean = F.avg(F.col(year).try_cast("int")).cast("int")
    return books.agg(F.coalesce(mean, F.lit(DEFAULT_YEAR)).alias("year_mean"))


def publisher_fill(publisher: Column) -> Column:
    return F.coalesce(publisher, F.lit(NO_PUBLISHER))


def clean_books(books: DataFrame, rule: str = "const") -> DataFrame:
    """Replace ``year_raw`` by an int ``year``.

    "const": years outside 1..2006 become 1994. "mean": years that are not a
    number, zero, or 2005 and later become the mean year, and a missing
    publisher becomes "other".
    """
    year = F.col("year_raw").try_cast("int")
    publisher = F.col("publisher")
    if rule == "const":
        year = year_const(year)
    elif rule == "mean":
        bad = year.isNull() | (year == 0) | (year >= FIRST_BAD_YEAR)
        year = F.when(bad, year_mean(books).scalar()).otherwise(year)
        publisher = publisher_fill(publisher)
    else:
        raise ValueError(f"rule must be 'const' or 'mean': {rule}")
    new = {"year_raw": year.alias("year"), "publisher": publisher.alias("publisher")}
    return books.select(*[new.get(c, F.col(c)) for c in books.columns])


def location_bucket(location: Column, match: str = "substring") -> Column:
    """"usa" or "non-usa".

    "substring" looks for the fragments anywhere, case as written, and so also
    takes "russia"; "country" compares the last comma-separated part.
    """
    if match == "substring":
        # "us" covers "usa".
        home = location.contains("us") | location.contains("america")
    elif match == "country":
        country = F.lower(F.trim(F.element_at(F.split(location, ","), -1)))
        home = country.isin(*HOME_FRAGMENTS)
    else:
        raise ValueError(f"match must be 'substring' or 'country': {match}")
    return F.when(home, HOME).otherwise(ABROAD)


def clean_users(
    users: DataFrame,
    rule: str = "const",
    fill: int | Column | None = None,
    match: str = "substring",
) -> DataFrame:
    """Replace ``age_raw`` by an int ``age``.

    "const": also buckets the location; ages that are missing or not positive
    become 35, with no upper bound. "range": ages up to 5, from 90, or missing
    become ``fill``, by default the mean age inside the range; the location
    stays as it is.
    """
    age = F.col("age_raw").try_cast("int")
    location = F.col("location")
    if rule == "const":
        age = F.when(age > 0, age).otherwise(DEFAULT_AGE)
        location = location_bucket(location, match)
    elif rule == "range":
        valid = (age > CHILD_AGE) & (age < OLD_AGE)
        if fill is None:
            mean = users.filter(valid).agg(F.avg(age).cast("int").alias("age_mean")).scalar()
            fill = F.coalesce(mean, F.lit(DEFAULT_AGE))
        elif not isinstance(fill, Column):
            fill = F.lit(fill)
        age = F.when(valid, age).otherwise(fill)
    else:
        raise ValueError(f"rule must be 'const' or 'range': {rule}")
    new = {"age_raw": age.alias("age"), "location": location.alias("location")}
    return users.select(*[new.get(c, F.col(c)) for c in users.columns])


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that comes last by ``order``.

    An aggregate rather than a window: a key with very many rows is reduced
    before the shuffle. Remaining columns break ties, so the pick is fixed.
    """
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(*order, *[c for c in rest if c not in order])
    return (
        df.groupBy(*keys)
        .agg(F.max(ranked).alias("last"))
        .select(*[c if c in keys else F.col(f"last.{c}").alias(c) for c in df.columns])
    )
