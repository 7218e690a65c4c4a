"""Ordered source catalogues."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.operators.ordering import number_in_group


def catalog_of(sources: DataFrame, class_col: str, id_col: str) -> DataFrame:
    """``catalog(t2, seq, source_id)`` in id order, from any table that names a class per source."""
    narrow = sources.select(F.col(class_col).alias("t2"), F.col(id_col).alias("source_id"))
    return number_in_group(narrow, "t2", "source_id").select("t2", "seq", "source_id")


def scan(catalog: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Every class with its sources; a class without sources stays as one row of nulls.

    The small taxonomy is broadcast to the catalogue, so a class that owns much of it is not
    gathered in one task; the empty classes are added from a distinct of class names.
    """
    columns = ["t1_idx", "t1", "t2_idx", "t2", "seq", "source_id"]
    filled = catalog.join(F.broadcast(taxonomy), "t2").select(*columns)
    empty = taxonomy.join(catalog.select("t2").distinct(), "t2", "left_anti").select(
        "t1_idx", "t1", "t2_idx", "t2",
        F.lit(None).cast("bigint").alias("seq"), F.lit(None).cast("bigint").alias("source_id"),
    )
    return filled.unionByName(empty)
