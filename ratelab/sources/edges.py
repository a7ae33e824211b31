"""Edge-list text files: ``src,dst`` per line, further fields ignored."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelab.schemas import EDGE_TEXT


def read_edges(spark: SparkSession, path: str, mode: str = "strict") -> DataFrame:
    """Columns ``src, dst`` as bigint.

    ``mode="strict"`` fails the job on an id that is no integer; "drop" leaves
    the line out.
    """
    return edges_from_text(spark.read.schema(EDGE_TEXT).csv(path), mode)


def edges_from_text(fields: DataFrame, mode: str = "strict") -> DataFrame:
    if mode == "strict":
        bad = F.concat(F.lit("edge id is no integer: "), F.coalesce("src", F.lit("")), F.lit(","), F.coalesce("dst", F.lit("")))
        ok = F.col("src").try_cast("bigint").isNotNull() & F.col("dst").try_cast("bigint").isNotNull()
        fields = fields.filter(ok | F.raise_error(bad).cast("boolean"))
    elif mode != "drop":
        raise ValueError(f"mode must be 'strict' or 'drop': {mode}")
    edges = fields.select(*[F.col(c).try_cast("bigint").alias(c) for c in ("src", "dst")])
    return edges.dropna() if mode == "drop" else edges
