"""Online scoring as a stream of application files, with the rejected ones beside the scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from riskloom.operators.applications import check_applications, score_valid

SCORES, REJECTS, BATCH = "scores", "rejects", "batch"


def read_application_stream(spark: SparkSession, path: str, schema,
                            files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def score_stream(applications: DataFrame, woe: DataFrame, points: DataFrame,
                 coefficients: dict[str, float], intercept: float, output: str,
                 checkpoint: str, key: str = "id") -> StreamingQuery:
    """Score all files that are there and stop; valid and rejected applications go to two sinks.

    Every batch replaces its own folder in ``output/scores`` and in
    ``output/rejects``, named by the batch's number.  A batch that was
    interrupted, or written but not noted in ``checkpoint``, is computed from
    the same files again after a restart and replaces what it had left, so
    nothing is lost or repeated.  Stateless: one narrow stage per sink, and the
    checked applications are read from their files once.
    """
    def write(batch: DataFrame, number: int) -> None:
        checked = check_applications(batch).persist()
        try:
            good = F.size("errors") == 0
            scores = score_valid(checked.where(good).drop("errors"), woe, points, coefficients, intercept, key)
            for part, name in ((scores, SCORES), (checked.where(~good), REJECTS)):
                part.write.mode("overwrite").parquet(f"{output}/{name}/{BATCH}={number}")
        finally:
            checked.unpersist()

    return (applications.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def read_scores(spark: SparkSession, output: str) -> DataFrame:
    """The scores of all batches, with ``batch``."""
    return spark.read.parquet(f"{output}/{SCORES}")


def read_rejects(spark: SparkSession, output: str) -> DataFrame:
    """The rejected applications of all batches with their ``errors`` and ``batch``."""
    return spark.read.parquet(f"{output}/{REJECTS}")
