"""Files that tasks write and read themselves, in the shared folder."""

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelab.shared import scratch_table_path


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the session's shared folder, as a URI that pyarrow opens in any task."""
    path = scratch_table_path(spark, name)
    scheme, colon, rest = path.partition(":")
    if not colon:
        return f"file://{path}"
    return path if rest.startswith("//") else f"{scheme}://{rest}"


def byte_ranges(
    offsets: Sequence[int], lengths: Sequence[int], gap: int, most: int
) -> Iterator[tuple[int, int]]:
    """First and last-plus-one of the records, sorted by offset, that one read takes: neighbours
    at most ``gap`` bytes apart, ``most`` bytes together or one longer record alone."""
    start = 0
    for i in range(1, len(offsets) + 1):
        if (
            i == len(offsets)
            or offsets[i] - (offsets[i - 1] + lengths[i - 1]) > gap
            or offsets[i] + lengths[i] - offsets[start] > most
        ):
            yield start, i
            start = i


def spread_by_stretch(index: DataFrame, stretch: int) -> DataFrame:
    """Index rows (``file, offset, length``) by file and stretch of a file, sorted, for readers.

    Index rows are few bytes, what they name is many: the number of tasks goes
    by the bytes to read, one stretch each, and above 2,000 tasks 1 GiB each.
    Runs a job over the index.
    """
    whole = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, min(-(-whole // stretch), max(2_000, whole >> 30)))
    spread = index.repartition(tasks, "file", F.floor(F.col("offset") / stretch))
    return spread.sortWithinPartitions("file", "offset")
