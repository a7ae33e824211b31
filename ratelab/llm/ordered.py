"""Sums over all rows before a row, in an order over the whole table."""

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelab.llm.tasks import map_batches
from ratelab.shared import cut_lineage


def ordered_totals(df: DataFrame, order: Sequence[Column | str], sums: dict[str, str]) -> DataFrame:
    """Adds for each ``{new: old}`` of ``sums`` the total of ``old`` over the rows before this one.

    Range partitions keep the order, each adds up its own rows as they stream
    through, and starts from the total of the partitions before it. Only one
    row per partition reaches the driver. Runs jobs. A null counts as zero;
    rows that tie in ``order`` come in any order, fixed once they are placed.
    """
    placed = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order))
    totals = placed.groupBy(F.spark_partition_id().alias("part"))
    per_part = totals.agg(*(F.sum(old).alias(new) for new, old in sums.items())).collect()
    running, starts = [0] * len(sums), {}
    for row in sorted(per_part, key=lambda r: r["part"]):
        starts[row["part"]] = list(running)
        running = [total + (row[new] or 0) for total, new in zip(running, sums)]

    def add(batches):
        carry = starts.get(TaskContext.get().partitionId(), [0] * len(sums))
        for batch in batches:
            columns = list(batch.columns)
            for i, old in enumerate(sums.values()):
                values = batch.column(old).cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
                upto = np.cumsum(values)
                columns.append(pa.array(carry[i] + upto - values, pa.int64()))
                carry[i] += int(upto[-1]) if len(upto) else 0
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *sums])

    schema = T.StructType([*placed.schema.fields, *(T.StructField(new, T.LongType()) for new in sums)])
    return map_batches(placed, add, schema)
