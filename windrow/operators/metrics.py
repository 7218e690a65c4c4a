"""Classification metrics from a table of true and predicted codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.functions import text as T


def confusion_long(scored: DataFrame, y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """``(y_true, y_pred, n)`` of the pairs that occur."""
    return scored.groupBy(F.col(y).alias("y_true"), F.col(p).alias("y_pred")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(scored: DataFrame, labels: list[int], y="y_true", p="y_pred") -> DataFrame:
    """Square matrix: one row per true code, one ``pred_<code>`` column per code, zeros filled."""
    grid = scored.sparkSession.createDataFrame([(int(k),) for k in labels], "y_true int")
    cells = (
        confusion_long(scored, y, p).groupBy("y_true").pivot("y_pred", labels).agg(F.sum("n"))
    )
    return grid.join(cells, "y_true", "left").select(
        "y_true", *[F.coalesce(F.col(str(k)), F.lit(0)).alias(f"pred_{k}") for k in labels]
    )


def _ratio(a, b):
    return F.when(b > 0, a / b).otherwise(0.0)


def class_scores(confusion: DataFrame, by: list[str] = ()) -> DataFrame:
    """Precision, recall, F1, support of every label seen in truth or prediction.

    Works on the confusion counts, so its size is labels squared, not rows. An empty
    denominator gives 0. ``by`` names extra key columns, such as the model.
    """
    by = list(by)
    hit = F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0)
    sides = confusion.select(*by, F.explode(F.array(
        F.struct(F.col("y_true").alias("label"), hit.alias("tp"), F.col("n").alias("truth"),
                 F.lit(0).cast("bigint").alias("said")),
        F.struct(F.col("y_pred").alias("label"), F.lit(0).cast("bigint").alias("tp"),
                 F.lit(0).cast("bigint").alias("truth"), F.col("n").alias("said")),
    )).alias("s")).select(*by, "s.*")
    sums = sides.groupBy(*by, "label").agg(
        F.sum("tp").alias("tp"), F.sum("truth").alias("support"), F.sum("said").alias("said")
    )
    return sums.select(
        *by, "label", "tp", "support",
        _ratio(F.col("tp"), F.col("said")).alias("precision"),
        _ratio(F.col("tp"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("tp"), F.col("said") + F.col("support")).alias("f1"),
    )


def macro_of(scores: DataFrame, by: list[str] = ()) -> DataFrame:
    """Accuracy and macro precision, recall, F1 from :func:`class_scores`, 4 decimals."""
    return scores.groupBy(*by).agg(
        F.round(F.sum("tp") / F.sum("support"), 4).alias("accuracy"),
        F.round(F.avg("precision"), 4).alias("precision"),
        F.round(F.avg("recall"), 4).alias("recall"),
        F.round(F.avg("f1"), 4).alias("f1_macro"),
    )


def macro_metrics(scored: DataFrame, y="y_true", p="y_pred") -> DataFrame:
    """One row of :func:`macro_of` over all labels present in truth or prediction."""
    return macro_of(class_scores(confusion_long(scored, y, p)))


def classification_report(scored: DataFrame, y="y_true", p="y_pred") -> DataFrame:
    """``(label, precision, recall, f1, support)`` per class, then accuracy and both averages."""
    return report_of(class_scores(confusion_long(scored, y, p)))


def report_of(scores: DataFrame, by: list[str] = ()) -> DataFrame:
    """The report of :func:`class_scores`, one per group of ``by``, in one pass over the counts."""
    by, total = list(by), F.sum("support")

    def row(name, a, b, c, n):
        return F.struct(name.cast("string").alias("label"), a.alias("precision"), b.alias("recall"), c.alias("f1"), n.alias("support"))

    def weighted(m):
        return F.sum(F.col(m) * F.col("support")) / total

    acc = F.sum("tp") / total
    classes = F.collect_list(row(*[F.col(c) for c in ("label", "precision", "recall", "f1", "support")]))
    summary = F.array(
        row(F.lit("accuracy"), acc, acc, acc, total),
        row(F.lit("macro avg"), F.avg("precision"), F.avg("recall"), F.avg("f1"), total),
        row(F.lit("weighted avg"), weighted("precision"), weighted("recall"), weighted("f1"), total),
    )
    # A group has as many entries as there are classes.
    grouped = scores.groupBy(*by).agg(classes.alias("c"), summary.alias("s"))
    return grouped.select(*by, F.explode(F.concat("c", "s")).alias("r")).select(*by, "r.*")


def edge_cases(scored: DataFrame, order: list[str], limit: int = 10) -> DataFrame:
    """The first ``limit`` wrong rows in corpus order with a text preview."""
    return (
        scored.filter(F.col("y_true") != F.col("y_pred"))
        .orderBy(*order)
        .limit(limit)
        .select(*order, F.col("true_class"), F.col("predicted"), T.preview("text").alias("preview"))
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """``(label, n, weight)`` with weight = n / (classes * class size)."""
    n = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    ratio = n.agg((F.sum("n") / F.count(F.lit(1))).alias("r")).scalar()
    return n.select(label, "n", (ratio / F.col("n")).alias("weight"))


def weighted_cross_entropy(df: DataFrame, label: str, probs: str, weights: dict[int, float]) -> DataFrame:
    """One row, ``loss``: sum of w[y] * -ln p[y] over sum of w[y]."""
    w = F.lit(1.0)
    if weights:
        table = F.create_map(*[F.lit(x) for kv in sorted(weights.items()) for x in kv])
        w = F.coalesce(table[F.col(label)], F.lit(1.0))
    terms = df.select(w.alias("w"), (-F.log(F.col(probs)[F.col(label)])).alias("nll"))
    return terms.agg((F.sum(F.col("w") * F.col("nll")) / F.sum("w")).alias("loss"))
