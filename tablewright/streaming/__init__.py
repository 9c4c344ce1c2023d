"""Plans over streams: each micro-batch is compiled and written like a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from tablewright.plans.compiler import PlanBuilder
from tablewright.plans.config import Table
from tablewright.plans.writer import TableWriter
from tablewright.sources.readers import load_sources


def writes(stream: DataFrame, config: Table, writer: TableWriter, checkpoint: str) -> DataStreamWriter:
    """A stream writer whose micro-batches are the plan's first source. Merges repeat safely if a batch does."""
    first = config.sources[0].name

    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        builder = PlanBuilder(config)
        others = load_sources(spark, config.sources[1:])
        context = builder.context(run_id=f"batch-{number}")
        writer.write(spark, builder.build(spark, context, {first: df} | others), config, context)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
