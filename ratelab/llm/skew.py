"""A join that adaptive execution may split."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_unique(facts: DataFrame, rows: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """``facts`` joined to ``rows`` that are unique in ``on``, however many facts share one key.

    ``rows`` usually come from an aggregation by the same key and would keep
    its partitioning, with which Spark doesn't split a skewed join. A second
    key, which the first one determines, makes the join shuffle both sides
    itself, so that a hot key's facts are split over tasks at run time.
    """
    second = "_hash_of_key"
    left = facts.withColumn(second, F.xxhash64(on))
    right = rows.withColumn(second, F.xxhash64(on))
    return left.join(right, [on, second], how).drop(second)
