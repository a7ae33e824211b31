"""Tables the stages hand to each other, and the sinks that write them."""

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelab.schemas import PREDICTIONS

TRAIN, TEST = "TRAIN", "TEST"


def write_table(df: DataFrame, path: str, fmt: str = "parquet", overwrite: bool = False) -> None:
    df.write.mode("overwrite" if overwrite else "errorifexists").format(fmt).save(path)


def write_split(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """Train and test rows in one pass, one folder each."""
    mode = "overwrite" if overwrite else "errorifexists"
    df.write.mode(mode).partitionBy("split").parquet(path)


def read_split(spark: SparkSession, path: str, split: str, schema=None) -> DataFrame:
    """One side of a written split; the other folder is not read."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path).filter(F.col("split") == split).drop("split")


def metric_rows(row: DataFrame, labels: dict[str, str]) -> DataFrame:
    """A one-row frame as ``metric, value`` rows under the given labels."""
    pairs = [F.struct(F.lit(v).alias("metric"), F.col(c).cast("double").alias("value")) for c, v in labels.items()]
    return row.select(F.inline(F.array(*pairs)))


def prediction_rows(predictions: DataFrame, with_label: bool, columns: Sequence[str] = ("title", "author", "predicted", "features")) -> DataFrame:
    return predictions.select(*columns, *(["rating"] if with_label else []))


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PREDICTIONS).csv(path)


def write_model(model: PipelineModel, path: str, overwrite: bool = False) -> None:
    writer = model.write()
    (writer.overwrite() if overwrite else writer).save(path)


def read_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    return df.limit(rows)
