"""A fitted tree or forest with the category means it was fitted on."""

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ratelab.operators.features import MeanEncoding
from ratelab.sources.tables import read_model, write_model


@dataclass
class TreeModel:
    encoding: MeanEncoding
    pipeline: PipelineModel

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``features`` and the model's predictions."""
        return self.pipeline.transform(self.encoding.transform(df)).drop(*self.encoding.columns())

    def save(self, path: str, overwrite: bool = False) -> None:
        self.encoding.save(f"{path}/means", overwrite)
        write_model(self.pipeline, f"{path}/tree", overwrite)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "TreeModel":
        return cls(MeanEncoding.load(spark, f"{path}/means"), read_model(f"{path}/tree"))
