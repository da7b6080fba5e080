"""Classification metrics: confusion counts, exact rank AUC, average precision."""

from pyspark.sql import functions as F

from riskloom.functions.probability import hard_predict
from riskloom.operators import ranking as R, ties

METRIC_COLUMNS = [
    "model_name", "true_positives", "false_positives", "true_negatives", "false_negatives",
    "accuracy", "precision", "recall", "f1_score", "roc_auc", "pr_auc", "total_samples",
    "positive_rate",
]


def _confusion_columns(y, p, threshold):
    guess = hard_predict(F.col(p), threshold)

    def cell(label, prediction):
        return F.count(F.when((F.col(y) == label) & (guess == prediction), 1))

    return [
        cell(1, 1).alias("true_positives"), cell(0, 1).alias("false_positives"),
        cell(0, 0).alias("true_negatives"), cell(1, 0).alias("false_negatives"),
        F.count(F.lit(1)).alias("total_samples"),
    ]


def confusion(df, y="y", p="p", threshold=0.5, groups=()):
    """Counts of the four cells; labels other than 0 and 1 count only in the total."""
    return df.groupBy(*groups).agg(*_confusion_columns(y, p, threshold))


def _ratio(top, bottom):
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def classification_metrics(counts):
    """Adds accuracy, precision, recall, F1 and positive rate; 0 where a denominator is 0."""
    tp, fp, tn, fn, n = (F.col(c) for c in (
        "true_positives", "false_positives", "true_negatives", "false_negatives", "total_samples"))
    with_rates = counts.withColumns({
        "accuracy": _ratio(tp + tn, n),
        "precision": _ratio(tp, tp + fp),
        "recall": _ratio(tp, tp + fn),
        "positive_rate": _ratio(tp + fn, n),
    })
    precision, recall = F.col("precision"), F.col("recall")
    return with_rates.withColumn(
        "f1_score", _ratio(F.lit(2.0) * (precision * recall), precision + recall))


def roc_auc(df, y="y", p="p", groups=(), eps=ties.TIE_EPS, rows_per_bucket=R.ROWS_PER_BUCKET):
    """Rank-sum AUC; 0.5 without rows or with one class. Equal scores merge before any shuffle."""
    groups = list(groups)
    scores = df.groupBy(*groups, p).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col(y) == 1, 1)).alias("pos"))
    tied = ties.tie_members(scores, p, groups, eps, rows_per_bucket).groupBy(*groups, "anchor").agg(
        F.min("before").alias("before"), F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    sums = tied.groupBy(*groups).agg(
        F.sum("pos").cast("double").alias("n_pos"),
        F.sum(F.col("n") - F.col("pos")).cast("double").alias("n_neg"),
        F.sum(F.col("pos") * ties.mean_rank(F.col("before"), F.col("n"))).alias("rank_sum"),
    )
    n_pos, n_neg = F.col("n_pos"), F.col("n_neg")
    u = F.col("rank_sum") - n_pos * (n_pos + 1) / F.lit(2.0)
    auc = F.greatest(F.least(u / (n_pos * n_neg), F.lit(1.0)), F.lit(0.0))
    return sums.select(
        *groups, F.when((n_pos > 0) & (n_neg > 0), auc).otherwise(F.lit(0.5)).alias("roc_auc"))


def cumulative_pr(df, y="y", p="p", tie="customer_id", groups=(), rows_per_bucket=R.ROWS_PER_BUCKET):
    """Rows by falling score (ties by ``tie``, not merged) with rank, hits so far and precision."""
    hit = F.when(F.col(y) == 1, 1).otherwise(0)
    walked = R.running_totals(
        df.select(*groups, tie, y, p), p, tie, {"hits": hit}, ascending=False, groups=groups,
        rows_per_bucket=rows_per_bucket)
    return walked.withColumn("precision_at_row", F.col("hits") / F.col("rank"))


def pr_auc(df, y="y", p="p", tie="customer_id", groups=(), rows_per_bucket=R.ROWS_PER_BUCKET):
    """Mean over the positives of the precision at their row; 0 without positives."""
    curve = cumulative_pr(df, y, p, tie, groups, rows_per_bucket)
    mean = F.avg(F.when(F.col(y) == 1, F.col("precision_at_row")))
    return curve.groupBy(*groups).agg(
        F.least(F.coalesce(mean, F.lit(0.0)), F.lit(1.0)).alias("pr_auc"))


def auc_by(df, group, y="y", p="p", tie="customer_id", rows_per_bucket=R.ROWS_PER_BUCKET):
    """Both areas per group."""
    return roc_auc(df, y, p, [group], rows_per_bucket=rows_per_bucket).join(
        pr_auc(df, y, p, tie, [group], rows_per_bucket), group)


def evaluate_by(df, group="model_name", y="y", p="p", threshold=0.5, tie="customer_id",
                rows_per_bucket=R.ROWS_PER_BUCKET):
    """One 13-column metrics row per group."""
    counts = classification_metrics(confusion(df, y, p, threshold, [group]))
    return counts.join(auc_by(df, group, y, p, tie, rows_per_bucket), group).select(
        F.col(group).alias("model_name"), *METRIC_COLUMNS[1:])


def evaluate(df, name, y="y", p="p", threshold=0.5, tie="customer_id",
             rows_per_bucket=R.ROWS_PER_BUCKET):
    """The metrics row of one model; without rows all zeros and a ROC area of 0.5."""
    counts = classification_metrics(confusion(df, y, p, threshold))
    return counts.withColumns({
        "model_name": F.lit(name),
        "roc_auc": roc_auc(df, y, p, rows_per_bucket=rows_per_bucket).scalar(),
        "pr_auc": pr_auc(df, y, p, tie, rows_per_bucket=rows_per_bucket).scalar(),
    }).select(*METRIC_COLUMNS)
