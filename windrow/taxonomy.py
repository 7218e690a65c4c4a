"""Two-level label hierarchy as a dimension table.

A taxonomy is ordered: the position of a label in its list is its integer code.
The table form is ``taxonomy(t1_idx int, t1 string, t2_idx int, t2 string)``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The default branches, schools and source ids, in code order.
DEFAULT_HIERARCHY = [
    ("Metaphysics", ["Idealism", "Materialism"]),
    ("Epistemology", ["Rationalism", "Empiricism"]),
    ("Value Theory", ["Existentialism", "Nihilism", "Stoicism"]),
]
DEFAULT_SOURCES = {
    "Idealism": [4280, 52821, 5683, 39064, 51635, 4723, 1323, 38427, 38428, 40868],
    "Materialism": [3207, 7319, 40770, 8909, 61408, 61409, 1041, 27814, 73877, 73906],
    "Rationalism": [59, 4391, 919, 920, 921, 922, 3800, 7304, 7305, 7306],
    "Empiricism": [10615, 9662, 4705, 10574, 11074, 2759, 5827, 2529, 34763, 11690],
    "Existentialism": [600, 28054, 2554, 2197, 6853, 1399, 1727, 5200, 7849, 40745],
    "Nihilism": [4363, 1998, 52263, 51356, 38226, 38227, 30723, 38145, 52319, 52318],
    "Stoicism": [2680, 45109, 10661, 3774, 44822, 1308, 8769, 57271, 61460, 56164],
}
# Fixed value: loss weight of the second-level class with code 5; all others weigh 1.
DEFAULT_T2_LOSS_WEIGHTS = {5: 1.4}


@dataclass(frozen=True)
class Labels:
    """Driver-side label lists of a taxonomy (a handful of names, never data-sized)."""

    t1: tuple[str, ...]
    t2: tuple[str, ...]
    parent: tuple[int, ...]


def taxonomy_table(spark: SparkSession, hierarchy=None) -> DataFrame:
    """Dimension table of a list of ``(branch, [school, ...])`` in code order."""
    rows, t2_idx = [], 0
    for t1_idx, (t1, schools) in enumerate(hierarchy or DEFAULT_HIERARCHY):
        for t2 in schools:
            rows.append((t1_idx, t1, t2_idx, t2))
            t2_idx += 1
    return spark.createDataFrame(rows, "t1_idx int, t1 string, t2_idx int, t2 string")


def catalog_table(spark: SparkSession, sources=None) -> DataFrame:
    """``catalog(t2, seq, source_id)``: the ordered source list of every class."""
    raw = spark.createDataFrame(
        [(k, v) for k, v in (sources or DEFAULT_SOURCES).items()],
        "t2 string, ids array<bigint>",
    )
    return raw.select("t2", F.posexplode("ids").alias("seq", "source_id")).select(
        "t2", F.col("seq").cast("bigint").alias("seq"), "source_id"
    )


def labels_of(taxonomy: DataFrame) -> Labels:
    """Collect the label lists; a taxonomy is a small dimension by definition."""
    rows = taxonomy.select("t1_idx", "t1", "t2_idx", "t2").distinct().orderBy("t2_idx").collect()
    t1 = {r.t1_idx: r.t1 for r in rows}
    return Labels(
        t1=tuple(t1[i] for i in sorted(t1)),
        t2=tuple(r.t2 for r in rows),
        parent=tuple(r.t1_idx for r in rows),
    )


def encode(df: DataFrame, taxonomy: DataFrame, how: str = "inner") -> DataFrame:
    """Attach both codes and the branch name to rows that carry the school name ``t2``."""
    return df.join(F.broadcast(taxonomy.select("t2", "t2_idx", "t1", "t1_idx")), "t2", how)


def decode(df: DataFrame, taxonomy: DataFrame, how: str = "inner") -> DataFrame:
    """Attach the names to rows that carry the school code ``t2_idx``."""
    return df.join(F.broadcast(taxonomy.select("t2_idx", "t2", "t1", "t1_idx")), "t2_idx", how)
