"""One training run as one call: choose copies, build, record, save."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.functions import text as T
from windrow.operators import balance
from windrow.plans.engine import Engine, Params, build_from
from windrow.plans.report import engine_metrics, run_stamp
from windrow.scale import share
from windrow.sources import artifacts, sinks
from windrow.sources import documents as D


@dataclass
class Training:
    """The fitted engine and what a run leaves behind, read back from the tables of the run.

    ``rejects(source_id)`` are catalogue sources without a readable text, ``audit`` the class counts
    after parity, ``progress`` the windows taken per visited source, ``checks`` the integrity gate,
    ``metrics`` the four models' figures. ``version`` names the saved engine.
    """

    engine: Engine
    vectors: DataFrame
    version: str
    rejects: DataFrame
    audit: DataFrame
    progress: DataFrame
    checks: DataFrame
    metrics: DataFrame


def train(
    books: DataFrame, catalog: DataFrame, taxonomy: DataFrame, path: str, run_id: str, params: Params | None = None,
    lemmas: DataFrame | None = None, candidate: str | None = None, min_chars: int = T.MIN_SOURCE_CHARS,
    strict: bool = False, moment: datetime | None = None,
) -> Training:
    """Build an engine, write the run's tables below ``path`` and save the engine there.

    ``books(source_id, text)`` holds text or bytes; with ``candidate``, the column that ranks the
    copies of a source, the best readable copy is taken. Tables are keyed by ``run_id``: a run
    repeated under its id replaces them. The engine's manifest is written last, so a run that
    breaks off leaves the engine saved before it in use.
    """
    spark, params = books.sparkSession, params or Params()
    read = D.decoded(books, "text", min_chars)
    if candidate is not None:
        # Joined once; counting, cutting and rejects read the kept copies.
        read = share(D.first_valid_candidate(read, "source_id", candidate, "text", F.col("text").isNotNull()))
    engine, vectors, counts = build_from(D.stripped(read), catalog, taxonomy, params, lemmas, strict)
    known = D.readable(read).select("source_id")
    tables = {
        "rejects": catalog.select("source_id").distinct().join(known, "source_id", "left_anti"),
        "progress": balance.progress(counts, params.quota),
        "audit": spark.createDataFrame(engine.audit, "t2_idx int, t2 string, t1 string, n bigint, expected bigint, status string, note string"),
        "checks": spark.createDataFrame(engine.checks, "name string, status string, detail string"),
        "metrics": engine_metrics(engine, vectors, run_stamp(moment)),
    }
    written = {name: sinks.write_run(rows, f"{path}/{name}", run_id) for name, rows in tables.items()}
    counts.unpersist()
    if candidate is not None:
        read.unpersist()
    return Training(engine, vectors, artifacts.save(engine, spark, f"{path}/engine"), **written)
