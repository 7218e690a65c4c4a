"""Continuous scoring of JSON requests with Structured Streaming.

Every step is narrow (parse, clean, vectorise inside the row, score per Arrow batch), so the
query is stateless, append-only, and needs neither a watermark nor a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from windrow.plans.engine import Engine
from windrow.sources.requests import parse_requests, render_responses


def read_requests(spark: SparkSession, path: str, id_col: str = "id", max_files: int = 64) -> DataFrame:
    """Stream of ``(id, value)`` rows from parquet files that keep arriving in a folder."""
    return (
        spark.readStream.schema(f"{id_col} bigint, value string")
        .option("maxFilesPerTrigger", max_files)
        .parquet(path)
    )


def score_requests(requests: DataFrame, engine: Engine, id_col: str = "id") -> DataFrame:
    """Prediction rows of all accepted requests; works on a stream and on a table."""
    accepted, _ = parse_requests(requests)
    return engine.score(accepted, id_col, mode_col="speed")


def start(
    requests: DataFrame, engine: Engine, out: str, checkpoint: str, id_col: str = "id", as_json: bool = False,
    available_now: bool = False, rejected: str | None = None,
) -> StreamingQuery:
    """Write prediction rows (or JSON responses) to ``out`` as requests arrive.

    Rejected requests go to ``rejected`` (default: ``out`` + "-rejected"), from the same read of the
    batch. Each batch overwrites the folder of its own number, so a repeated batch changes nothing.
    """
    refused = rejected or f"{out}-rejected"

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        accepted, wrong = parse_requests(batch)
        scored = engine.score(accepted, id_col, mode_col="speed")
        rows = render_responses(scored) if as_json else scored
        rows.write.mode("overwrite").parquet(f"{out}/batch={number}")
        wrong.write.mode("overwrite").parquet(f"{refused}/batch={number}")
        batch.unpersist()

    writer = requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
