"""Quality of scores from counts per distinct score: ranking figures, and calibration.

Nothing sorts all rows. Rows are counted per score first; what lies below a score is summed over
ranges (``operators/ordered.py``), so scores may be as many as rows.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillscope.operators.ordered import with_running
from tillscope.sources.lake import stage


def score_counts(scored: DataFrame, group: list[str], score: str = "probability", label: str = "label") -> DataFrame:
    """(group, score, pos, neg): rows of label 1 and 0 per distinct score. Rows without score or label take no part."""
    known = scored.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    pos = F.col(label) == 1
    return known.groupBy(*group, F.col(score).alias("score")).agg(F.count_if(pos).alias("pos"), F.count_if(~pos).alias("neg"))


def curve(scored: DataFrame, group: list[str], score: str = "probability", label: str = "label") -> DataFrame:
    """(group, score, pos, neg, tp, fp, positives, negatives): rows at or above each score, and of the whole group.

    ``tp / (tp + fp)`` is the precision at that threshold, ``tp / positives`` the recall and
    ``fp / negatives`` the rate of false alarms.
    """
    counts = score_counts(scored, group, score, label)
    below = stage(with_running(counts, group, ["score"], {"_pos": "pos", "_neg": "neg"}), "score-counts")
    names = [f"_g{i}" for i in range(len(group))]
    sizes = below.groupBy(*(F.col(g).alias(x) for g, x in zip(group, names))).agg(
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives")
    )
    same = F.lit(True)
    for g, x in zip(group, names):
        same = same & F.col(g).eqNullSafe(F.col(x))
    return below.join(sizes, same).select(
        *group, "score", "pos", "neg", (F.col("positives") - F.col("_pos")).alias("tp"),
        (F.col("negatives") - F.col("_neg")).alias("fp"), "positives", "negatives",
    )


def ranking(scored: DataFrame, group: list[str], score: str = "probability", label: str = "label") -> DataFrame:
    """Per group: positives, negatives, auc, average_precision.

    ``auc`` is the share of pairs of one row of each label in which the row of label 1 scores
    higher, equal scores counting half, exactly; NULL if a label is absent. The average precision
    is the mean precision at the scores of the rows of label 1.
    """

    def whole(x: Column) -> Column:
        return x.cast("decimal(19,0)")

    above = F.col("negatives") - F.col("fp")  # rows of label 0 that score lower
    won = F.sum(whole(F.col("pos")) * whole(2 * above + F.col("neg"))).cast("double")
    precise = F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp")))
    pos, neg = F.max("positives"), F.max("negatives")
    return curve(scored, group, score, label).groupBy(*group).agg(
        pos.alias("positives"),
        neg.alias("negatives"),
        F.round(F.try_divide(won, 2.0 * pos * neg), 9).alias("auc"),
        F.round(F.try_divide(precise, pos), 9).alias("average_precision"),
    )


def _pool(batches):
    """Scores in rising order with their counts; neighbours whose shares do not rise are pooled."""
    blocks: list[list] = []  # positives, rows, scores, each one's rows and positives
    for batch in batches:
        for s, n, p in zip(*(batch[c].to_pylist() for c in ("score", "n", "positives"))):
            blocks.append([p, n, [(s, n, p)]])
            while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
                p2, n2, rows = blocks.pop()
                blocks[-1][0] += p2
                blocks[-1][1] += n2
                blocks[-1][2] += rows
    out = [(s, n, p, pos / of) for pos, of, rows in blocks for s, n, p in rows]
    kinds = [("score", pa.float64()), ("n", pa.int64()), ("positives", pa.int64()), ("calibrated", pa.float64())]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, (_, k) in enumerate(kinds)], [c for c, _ in kinds])


def calibration(scored: DataFrame, score: str = "probability", label: str = "label", places: int = 4) -> DataFrame:
    """(score, n, positives, calibrated): the non-decreasing shares of label 1 nearest to the observed ones.

    Pool-adjacent-violators over scores of 0 to 1, rounded to ``places``: at most 10**places + 1
    rows (10,001) reach the one task that pools, however many rows are scored.
    """
    known = scored.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    counts = known.groupBy(F.round(score, places).cast("double").alias("score")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("positives")
    )
    pooled = counts.repartition(1).sortWithinPartitions("score")
    return pooled.mapInArrow(_pool, "score double, n long, positives long, calibrated double")


def calibrate(scored: DataFrame, table: DataFrame, score: str = "probability", places: int = 4) -> DataFrame:
    """Adds ``calibrated``: the share of the highest score of ``table`` that is not above the row's, or of its lowest.

    NULL for a NULL score or an empty table.
    """
    steps = 10**places
    grid = scored.sparkSession.range(steps + 1).select((F.col("id") / steps).alias("_score"))
    known = table.select(F.round("score", places).alias("_score"), F.col("calibrated").alias("_known"))
    at = Window.orderBy("_score")  # over the grid's rows
    filled = F.coalesce(
        F.last("_known", True).over(at.rowsBetween(Window.unboundedPreceding, 0)),
        F.first("_known", True).over(at.rowsBetween(0, Window.unboundedFollowing)),
    )
    lookup = stage(grid.join(known, "_score", "left").select("_score", filled.alias("calibrated")), "calibration")
    return scored.join(lookup, F.round(score, places) == F.col("_score"), "left").drop("_score")


def reliability(scored: DataFrame, group: list[str], score: str, label: str = "label") -> DataFrame:
    """Per group: rows, mean squared error of the score (Brier) and share of label 1."""
    hit = F.col(label).cast("double")
    return scored.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg((F.col(score) - hit) ** 2), 9).alias("brier"), F.round(F.avg(hit), 9).alias("share")
    )
