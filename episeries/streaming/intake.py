"""Files are processed once, whichever run first sees them.

The source's checkpoint is the list of processed files; ``availableNow`` works
off what is there and stops, so the same job serves a daily schedule. Both the
checkpoint and the output must lie on storage all executors reach: a lost
executor or driver then costs a retry and no data.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

#: The partition column that says which batch wrote a row.
BATCH = "batch"
Tables = Callable[[DataFrame], Mapping[str, DataFrame]]


def process_new_files(
    spark: SparkSession,
    source: str,
    schema: str,
    transform: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    file_format: str = "parquet",
    options: dict[str, str] | None = None,
    files_per_batch: int | None = None,
) -> None:
    """Append ``transform`` of the files not seen before to a parquet table."""
    reader = spark.readStream.format(file_format).schema(schema).options(**(options or {}))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    (
        transform(reader.load(source))
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
        .awaitTermination()
    )


def publish_batch(batch: DataFrame, number: int, tables: Tables, root: str) -> None:
    """Write each of the batch's tables to the partition that bears the batch's number.

    A batch that is run again, because its run was lost before it was recorded as done,
    replaces exactly what it wrote: each table has every batch's rows once.
    """
    for name, df in tables(batch).items():
        df.write.mode("overwrite").parquet(f"{root}/{name}/{BATCH}={number}")


def publish_new_files(
    spark: SparkSession,
    source: str,
    tables: Tables,
    root: str,
    checkpoint: str,
    file_format: str,
    schema: str,
    options: Mapping[str, str] | None = None,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> None:
    """Several tables from one pass over the files not seen before.

    ``prepare`` works on the stream (file names are known there), ``tables`` on each batch.
    """
    files = spark.readStream.format(file_format).schema(schema).options(**(options or {}))
    (
        prepare(files.load(source))
        .writeStream.foreachBatch(lambda df, number: publish_batch(df, number, tables, root))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """All that has been published of a table."""
    return spark.read.parquet(f"{root}/{name}").drop(BATCH)
