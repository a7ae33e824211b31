"""Python functions over Arrow batches, in workers that may not have this package."""

import io
import zipfile
from pathlib import Path

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from ratelab.llm.files import shared_folder

PACKAGE = Path(__file__).resolve().parents[1]


def ship_package(spark: SparkSession) -> None:
    """Gives this package to the executors, once per application, by way of the shared folder."""
    context = spark.sparkContext
    if getattr(context, "_ratelab_shipped", False):
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for file in sorted(PACKAGE.rglob("*.py")):
            archive.write(file, f"{PACKAGE.name}/{file.relative_to(PACKAGE)}")
    uri = f"{shared_folder(spark, PACKAGE.name)}.zip"
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    with system.open_output_stream(path, compression=None) as out:
        out.write(packed.getvalue())
    context.addPyFile(uri)
    context._ratelab_shipped = True


def map_batches(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow``, with this package at hand in the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)
