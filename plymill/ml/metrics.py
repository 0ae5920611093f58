"""Exact evaluation metrics as aggregations over scored rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plymill.operators.keyed import running_totals

EPSILON = 2.220446049250313e-16
THRESHOLDS = [index / 100 for index in range(5, 100, 5)]


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return _share(precision * recall * 2.0, precision + recall)


def binary_counts(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    yes, said = F.col(label) == 1, F.col(prediction) == 1
    return scored.agg(
        F.count_if(yes & said).alias("tp"),
        F.count_if(~yes & said).alias("fp"),
        F.count_if(yes & ~said).alias("fn"),
        F.count_if(~yes & ~said).alias("tn"),
    )


def binary_metrics(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1; a zero denominator gives 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    precision, recall = _share(tp, tp + fp), _share(tp, tp + fn)
    return binary_counts(scored, label, prediction).select(
        _share(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        _f1(precision, recall).alias("f1"),
    )


def curve_points(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One row per distinct score: positives and negatives at, and at or above, the score."""
    per_score = scored.groupBy((-F.col(score)).alias("position")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    return running_totals(per_score, [], "position", ["pos", "neg"])


def ranking_metrics(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """ROC-AUC with ties counted half, and average precision over distinct scores of any range."""
    points = curve_points(scored, label, score)
    positives, negatives = F.sum("pos").cast("double"), F.sum("neg").cast("double")
    above = F.sum(F.col("neg") * (F.col("pos_before") + F.col("pos") / 2))
    steps = F.sum(F.col("pos") * F.try_divide(F.col("pos_upto"), F.col("pos_upto") + F.col("neg_upto")))
    return points.agg(
        F.try_divide(above, positives * negatives).alias("roc_auc"), F.try_divide(steps, positives).alias("pr_auc")
    )


def threshold_sweep(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Precision, recall and F1 at 19 thresholds, counted in one pass without copying rows."""
    yes = F.col(label) == 1
    counted = scored.agg(
        F.count_if(yes).alias("positives"),
        *[
            column
            for i, cut in enumerate(THRESHOLDS)
            for column in (
                F.count_if((F.col(score) >= cut) & yes).alias(f"tp_{i}"),
                F.count_if(F.col(score) >= cut).alias(f"said_{i}"),
            )
        ],
    )
    rows = counted.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(cut).alias("threshold"),
                        _share(F.col(f"tp_{i}"), F.col(f"said_{i}")).alias("precision"),
                        _share(F.col(f"tp_{i}"), F.col("positives")).alias("recall"),
                    )
                    for i, cut in enumerate(THRESHOLDS)
                ]
            )
        ).alias("r")
    ).select("r.*")
    return rows.withColumn("f1", _f1(F.col("precision"), F.col("recall")))


def confusion(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return scored.groupBy(label, prediction).agg(F.count("*").alias("n"))


def confusion_matrix(
    scored: DataFrame, classes: list, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """One row per actual class, one zero-filled column per predicted class."""
    said = [F.count_if(F.col(prediction) == name).alias(f"predicted_{name}") for name in classes]
    counted = scored.groupBy(label).agg(*said)
    kind = scored.schema[label].dataType.simpleString()
    actual = scored.sparkSession.createDataFrame([(name,) for name in classes], f"{label} {kind}")
    filled = [F.coalesce(f"predicted_{name}", F.lit(0)).alias(f"predicted_{name}") for name in classes]
    return actual.join(counted, label, "left").select(label, *filled)


def per_class_metrics(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support of every class seen as label or prediction."""
    cells = confusion(scored, label, prediction)
    sides = cells.select(
        F.explode(
            F.array(
                F.struct(F.col(label).alias("class"), F.col("n").alias("actual"), F.lit(0).cast("bigint").alias("said")),
                F.struct(F.col(prediction).alias("class"), F.lit(0).cast("bigint").alias("actual"), F.col("n").alias("said")),
            )
        ).alias("s"),
        F.when(F.col(label) == F.col(prediction), F.col("n")).otherwise(0).alias("hit"),
    )
    # a diagonal cell appears once as label and once as prediction, so hits count half
    summed = sides.groupBy("s.class").agg(
        F.sum("s.actual").alias("support"), F.sum("s.said").alias("said"), (F.sum("hit") / 2).alias("hits")
    )
    precision, recall = _share(F.col("hits"), F.col("said")), _share(F.col("hits"), F.col("support"))
    return summed.select(
        "class", "support", precision.alias("precision"), recall.alias("recall"), _f1(precision, recall).alias("f1"), "hits"
    )


def multiclass_metrics(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy, balanced accuracy, macro and weighted F1, and log loss.

    ``label`` indexes the array column ``probabilities``; the loss is left out
    when the frame has none.
    """
    classes = per_class_metrics(scored, label, prediction)
    support = F.sum("support")
    summary = classes.agg(
        (F.sum("hits") / support).alias("accuracy"),
        F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"),
        F.avg("f1").alias("macro_f1"),
        (F.sum(F.col("f1") * F.col("support")) / support).alias("weighted_f1"),
    )
    if "probabilities" not in scored.columns:
        return summary
    own = F.get("probabilities", F.col(label).cast("int"))
    clipped = F.least(F.greatest(own, F.lit(EPSILON)), F.lit(1 - EPSILON))
    loss = scored.agg((-F.avg(F.ln(clipped))).alias("log_loss"))
    return summary.withColumn("log_loss", loss.scalar())


def compare(models: dict[str, DataFrame]) -> DataFrame:
    """Metric rows of several models stacked, with the model's name."""
    rows = [df.select(F.lit(name).alias("model"), "*") for name, df in models.items()]
    united = rows[0]
    for other in rows[1:]:
        united = united.unionByName(other, allowMissingColumns=True)
    return united
