"""Pre-training checks of a labelled corpus as one table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.functions import text as T

# Fixed value: largest tolerated ratio between the biggest and the smallest class.
IMBALANCE_LIMIT = 3


def class_distribution(corpus: DataFrame) -> DataFrame:
    """``(tier, label, n)`` for both label levels."""
    both = corpus.groupBy("t1_idx", "t2_idx").agg(F.count(F.lit(1)).alias("n"))
    return (
        both.select(F.explode(F.array(
            F.struct(F.lit("t1").alias("tier"), F.col("t1_idx").alias("label"), "n"),
            F.struct(F.lit("t2").alias("tier"), F.col("t2_idx").alias("label"), "n"),
        )).alias("r"))
        .select("r.*")
        .groupBy("tier", "label")
        .agg(F.sum("n").alias("n"))
    )


def duplicate_rows(corpus: DataFrame, text_col: str = "text") -> DataFrame:
    """One row, ``surplus``: copies beyond the first of every text.

    Grouped by a 256-bit digest of the text, so the shuffle carries 64 characters per text
    and copies are combined before it.
    """
    per_text = (
        corpus.filter(F.col(text_col).isNotNull())
        .groupBy(F.sha2(F.col(text_col), 256).alias("h"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return per_text.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("surplus"))


def label_drift(corpus: DataFrame, reference: DataFrame, label: str) -> DataFrame:
    """One row, ``drift``: total-variation distance between the class shares of two tables."""
    def shares(df: DataFrame, name: str) -> DataFrame:
        n = df.groupBy(label).agg(F.count(F.lit(1)).alias("c"))
        total = n.agg(F.sum("c").alias("t")).scalar()
        return n.select(label, (F.col("c") / total).alias(name))

    both = shares(corpus, "a").join(shares(reference, "b"), label, "full_outer")
    gap = F.abs(F.coalesce("a", F.lit(0.0)) - F.coalesce("b", F.lit(0.0)))
    return both.agg((F.coalesce(F.sum(gap), F.lit(0.0)) / 2).alias("drift"))


def integrity_report(
    corpus: DataFrame, reference: DataFrame | None = None, drift_limit: float = 0.1
) -> DataFrame:
    """``checks(name, status, detail)`` of ``corpus(t1_idx, t2_idx, text)``."""
    dist = corpus.groupBy("t1_idx", "t2_idx").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("text").isNull() | (T.strip_space("text") == "")).alias("missing"),
    )
    t1 = dist.groupBy("t1_idx").agg(F.sum("n").alias("n")).agg(
        F.struct(F.max("n").alias("big"), F.min("n").alias("small"), F.count(F.lit(1)).alias("k")).alias("s")
    )
    totals = dist.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("missing"), F.lit(0)).alias("missing"),
        F.count_distinct("t2_idx").alias("t2_classes"),
    )
    drift = F.lit(None).cast("double")
    if reference is not None:
        drift = label_drift(corpus, reference, "t2_idx").scalar()
    one = totals.select(
        "*", t1.scalar().alias("t1"), duplicate_rows(corpus).scalar().alias("surplus"), drift.alias("drift")
    ).select("*", "t1.big", "t1.small", F.col("t1.k").alias("t1_classes"))

    def check(name, status, detail):
        return F.struct(F.lit(name).alias("name"), status.alias("status"), detail.alias("detail"))

    def text_of(column):
        return F.col(column).cast("string")

    ratio = F.col("big") / F.greatest(F.col("small"), F.lit(1))
    passed, warning = F.lit("PASSED"), F.lit("WARNING")
    # Check names, status words and detail texts of the report.
    checks = F.array(
        check("Total Samples", F.lit("INFO"), text_of("rows")),
        check("T1 Classes", F.lit("INFO"), text_of("t1_classes")),
        check("T2 Classes", F.lit("INFO"), text_of("t2_classes")),
        check("Duplicate Check", F.when(F.col("surplus") > 0, warning).otherwise(passed),
              F.concat(text_of("surplus"), F.lit(" exact duplicates found"))),
        check("Missing Values", F.when(F.col("missing") > 0, warning).otherwise(passed),
              F.concat(text_of("missing"), F.lit(" null/empty samples"))),
        check("Class Imbalance (T1)",
              F.when(F.col("big") > IMBALANCE_LIMIT * F.col("small"), warning).otherwise(passed),
              F.concat(F.lit("Ratio max/min = "), F.format_string("%.1f", ratio))),
        check("Data Drift",
              F.when(F.col("drift").isNull(), F.lit("SKIPPED"))
              .when(F.col("drift") > drift_limit, warning).otherwise(passed),
              F.when(F.col("drift").isNull(), F.lit("No reference dataset provided"))
              .otherwise(F.concat(F.lit("Distance = "), F.format_string("%.4f", F.col("drift"))))),
    )
    return one.select(F.explode(checks).alias("c")).select("c.*")


def integrity_verdict(report: DataFrame, strict: bool = False) -> bool:
    """True means go on. Only ``strict`` lets a warning stop the run."""
    if not strict:
        return True
    return report.filter(F.col("status") == "WARNING").isEmpty()
