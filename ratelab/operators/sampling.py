"""Train/test splits and samples with replacement, drawn from hashes of row keys.

A draw depends on a row's key and the seed only: equal in any order, in any
number of partitions and in any engine with md5; nothing is sorted or
checkpointed. Without key columns a row's key is its content and, among equal
rows, its number; that takes a shuffle, so name key columns where there are any.
"""

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ratelab.operators.features import numbered
from ratelab.shared import scratch_table_path
from ratelab.sources.tables import TEST, TRAIN

# A draw uses so many hexadecimal digits of an md5 sum: 52 bits.
DIGITS = 13

_NO_KEY = (T.MapType, T.UserDefinedType, T.VariantType)
_KEY, _COPY = "_row_key", "_copy"


def hash_bucket(key_cols: Sequence[str], buckets: int = 100) -> Column:
    """Bucket of a row key, the same in any engine with md5."""
    key = F.concat_ws("|", *key_cols)
    head = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    return head % buckets


def hash_split(df: DataFrame, key_cols: Sequence[str], pct: int = 90) -> DataFrame:
    """Adds ``split``; rows with equal keys stay on one side."""
    return df.withColumn("split", F.when(hash_bucket(key_cols) < pct, TRAIN).otherwise(TEST))


def uniform_draw(key: Column, seed: int) -> Column:
    """A number in [0, 1) from a row key and a seed."""
    head = F.substring(F.md5(F.concat_ws("|", key, F.lit(str(seed)))), 1, DIGITS)
    return F.conv(head, 16, 10).cast("double") / float(16**DIGITS)


def poisson_steps(mean: float) -> list[float]:
    """Cumulative probabilities: a draw u makes as many copies as there are steps at or below u."""
    steps, total, term, k = [], 0.0, math.exp(-mean), 0
    while k < mean or term > 1e-17:
        total += term
        steps.append(total)
        k += 1
        term *= mean / k
    return steps


#: A larger mean is the sum of independent draws of at most this mean each.
MOST_MEAN = 64.0


def poisson_copies(key: Column, mean: float, seed: int) -> Column:
    """How many copies a row makes: a Poisson draw of any mean from its key, by one md5 for every 64 of it."""
    whole, rest = divmod(mean, MOST_MEAN)

    def copies(at: float, draw: Column) -> Column:
        # The draw is bound once: a column compared with every step would be computed as often.
        steps = F.array(*map(F.lit, poisson_steps(at)))
        return F.aggregate(F.array(draw), F.lit(0), lambda n, u: n + F.size(F.filter(steps, lambda step: step <= u)))

    first = copies(rest, uniform_draw(key, seed))
    if not whole:
        return first
    more = F.transform(
        F.sequence(F.lit(1), F.lit(int(whole))),
        lambda i: copies(MOST_MEAN, uniform_draw(F.concat_ws("|", key, F.lit("more"), i.cast("string")), seed)),
    )
    return first + F.aggregate(more, F.lit(0), lambda n, m: n + m)


def _keyed(df: DataFrame, key_cols: Sequence[str] | None) -> DataFrame:
    if key_cols is not None:
        return df.withColumn(_KEY, F.concat_ws("|", *key_cols))
    plain = [f.name for f in df.schema if not isinstance(f.dataType, _NO_KEY)]
    content = F.to_json(F.struct(*plain), {"ignoreNullFields": "false"})
    nth = F.row_number().over(Window.partitionBy("_content").orderBy(F.lit(1)))
    numbered = df.withColumn("_content", content).withColumn("_nth", nth)
    return numbered.withColumn(_KEY, F.concat_ws("|", "_content", "_nth")).drop("_content", "_nth")


def with_row_id(df: DataFrame, name: str) -> DataFrame:
    """Adds an id that a row has in every run: a hash of its content, and its number among equal rows."""
    return _keyed(df, None).withColumn(name, F.md5(_KEY)).drop(_KEY)


def draw_split(
    df: DataFrame, pct: float = 90.0, seed: int = 1, key_cols: Sequence[str] | None = None
) -> DataFrame:
    """Adds ``split`` by an independent draw per row key."""
    drawn = uniform_draw(F.col(_KEY), seed)
    return (
        _keyed(df, key_cols)
        .withColumn("split", F.when(drawn < pct / 100.0, TRAIN).otherwise(TEST))
        .drop(_KEY)
    )


def random_split(
    df: DataFrame,
    weights: Sequence[float] = (0.9, 0.1),
    seed: int = 1,
    key_cols: Sequence[str] | None = None,
) -> list[DataFrame]:
    """Parts of a random split, one draw per row key."""
    drawn = _keyed(df, key_cols).withColumn("_draw", uniform_draw(F.col(_KEY), seed)).drop(_KEY)
    parts, whole, low = [], float(sum(weights)), 0.0
    for i, weight in enumerate(weights):
        inside = F.col("_draw") >= low / whole
        if i < len(weights) - 1:
            inside = inside & (F.col("_draw") < (low + weight) / whole)
        parts.append(drawn.filter(inside).drop("_draw"))
        low += weight
    return parts


def bootstrap(
    df: DataFrame, fraction: float, seed: int = 1, key_cols: Sequence[str] | None = None
) -> DataFrame:
    """Sample with replacement, ``fraction`` of the rows on average."""
    return _copies(df, fraction, seed, key_cols).drop(_COPY, _KEY)


def row_keys(df: DataFrame, key_cols: Sequence[str] | None) -> DataFrame:
    """Adds ``_row_key``: the named columns, else the content and a number among equal rows."""
    return _keyed(df, key_cols)


def _copies(df, fraction, seed, key_cols):
    """Every row as often as a Poisson draw from its key says, with the copy's number."""
    keyed = _keyed(df, key_cols)
    often = poisson_copies(F.col(_KEY), fraction, seed)
    # A row without copies explodes to nothing; a filter beside it would draw again.
    numbers = F.transform(F.array_repeat(F.lit(1), often), lambda one, i: one + i)
    return keyed.withColumn(_COPY, F.explode(numbers))


#: Draws of one task, when there are more than the default number of tasks takes.
DRAWS_PER_TASK = 5_000_000


def resample(
    df: DataFrame,
    pct: float,
    seed: int = 1,
    key_cols: Sequence[str] | None = None,
    label: str | None = None,
    bias: float = 0.0,
) -> DataFrame:
    """Exactly ``floor(n * pct / 100)`` of n rows, drawn with replacement. Runs jobs.

    Each draw takes any row alike; with probability ``bias`` it first takes one of
    the classes that occur in ``label``, each alike (null is a class), and then any of
    its rows. A draw is a hash of its number and the seed, a row's place comes from its
    class and the md5 of its key, so the sample is the same in any partitioning;
    ``key_cols`` must tell rows apart. Only keys and classes are sorted, draws of one
    place are added up before they meet a key, and rows are shuffled once. An
    empty table gives an empty one.
    """
    if not 0.0 <= bias <= 1.0:
        raise ValueError(f"bias must be from 0 to 1: {bias}")
    if bias and label is None:
        raise ValueError("a bias needs a label")
    spark = df.sparkSession
    identified = _keyed(df, key_cols).withColumn("_drawn_id", F.unhex(F.md5(_KEY))).drop(_KEY)
    group = [F.col(label).alias("_class")] if bias else []
    order = ["_class", "_drawn_id"] if bias else ["_drawn_id"]
    # Written first: numbering reads its input twice, and the rows may be costly to make.
    path = scratch_table_path(spark, "keys")
    keys = identified.select("_drawn_id", *group)
    keys.write.parquet(path)
    places = numbered(spark.read.schema(keys.schema).parquet(path), order, "_place")
    n = places.count()
    many = int(n * pct / 100)
    tasks = max(spark.sparkContext.defaultParallelism, -(-many // DRAWS_PER_TASK))
    number = F.col("id").cast("string")

    def drawn(purpose: str, upto: Column) -> Column:
        key = F.concat_ws("|", F.lit(purpose), number) if purpose else number
        return F.floor(uniform_draw(key, seed) * upto).cast("bigint")

    draws = spark.range(0, many, 1, tasks).select("id", drawn("", F.lit(n)).alias("_place"))
    if bias:
        classes = places.groupBy("_class").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
        classes = classes.withColumn("_nth", F.row_number().over(Window.orderBy("_first")) - 1).drop("_class")
        biased = uniform_draw(F.concat_ws("|", F.lit("bias"), number), seed) < bias
        draws = draws.withColumn("_nth", F.when(biased, drawn("class", F.lit(classes.count()))))
        inside = F.col("_first") + drawn("", F.col("_rows"))
        draws = draws.join(classes, "_nth", "left").withColumn("_place", F.coalesce(inside, "_place"))
    times = draws.groupBy("_place").agg(F.count(F.lit(1)).cast("int").alias("_times"))
    chosen = places.join(times, "_place").select("_drawn_id", "_times")
    copies = identified.join(chosen, "_drawn_id").withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("_times"))))
    return copies.drop("_drawn_id", "_times", "_copy")


def sampled_split(
    df: DataFrame,
    fraction: float = 1.0,
    weights: Sequence[float] = (0.9, 0.1),
    seed: int = 1,
    leaky: bool = False,
    key_cols: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Train and test with a bootstrap of the train side.

    ``leaky`` samples before splitting, so copies of a row can land on both.
    """
    if leaky:
        drawn = _copies(df, fraction, seed, key_cols)
        train, test = random_split(drawn, weights, seed + 1, [_KEY, _COPY])
        return train.drop(_COPY), test.drop(_COPY)
    train, test = random_split(df, weights, seed, key_cols)
    return bootstrap(train, fraction, seed + 1, key_cols), test


def bagged_sample(
    train: DataFrame,
    sample_pct: float,
    model_id: int,
    base_seed: int = 1,
    key_cols: Sequence[str] | None = None,
    exact: bool = False,
) -> DataFrame:
    """The bag of one ensemble member; each member has its own seed.

    ``exact`` draws exactly that percentage of the rows (``resample``), else it
    is the mean of a Poisson draw per row.
    """
    if exact:
        return resample(train, sample_pct, base_seed + model_id, key_cols)
    return bootstrap(train, sample_pct / 100.0, base_seed + model_id, key_cols)
