"""Detector evaluation: matching, average precision, best F1."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boxlake.operators.detections import BOX, overlapping
from boxlake.scratch import stored

THRESHOLDS = [round(0.50 + 0.05 * k, 2) for k in range(10)]
MAX_DETECTIONS = 500


def ranked(detections: DataFrame, most: int = MAX_DETECTIONS) -> DataFrame:
    """detections with rank: by falling confidence within a picture, ties by det_no; at most `most`."""
    w = W.partitionBy("image_id").orderBy(F.desc("confidence"), "det_no")
    return detections.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= most)


def match_detections(detections: DataFrame, truth: DataFrame, thresholds: list[float] = THRESHOLDS) -> DataFrame:
    """threshold, image_id, det_no, truth_no of matched detections.

    By falling confidence each detection takes the free truth box it overlaps most, if by at least the threshold. Overlapping pairs of
    a picture, in that order, are folded once per threshold.
    """
    d, t = ranked(detections).select("image_id", "rank", "det_no", *BOX), truth.select("image_id", "truth_no", *BOX)
    pairs = overlapping(d, t, ["image_id"], min(thresholds)).select("image_id", "a.rank", "a.det_no", "b.truth_no", "iou")
    item = F.struct("rank", (-F.col("iou")).alias("less"), "truth_no", "det_no")
    lists = pairs.groupBy("image_id").agg(F.sort_array(F.collect_list(item)).alias("p"))
    lists = lists.withColumn("threshold", F.explode(F.array(*(F.lit(x) for x in thresholds))))
    kept = F.aggregate(
        "p",
        F.slice("p", 1, 0),
        lambda k, x: F.when((-x["less"] < F.col("threshold")) | F.exists(k, lambda q: (q["det_no"] == x["det_no"]) | (q["truth_no"] == x["truth_no"])), k).otherwise(F.array_append(k, x)),
    )
    return lists.select("threshold", "image_id", F.inline(kept)).select("threshold", "image_id", "det_no", "truth_no")


def curve(detections: DataFrame, matches: DataFrame, truth: DataFrame, thresholds: list[float] = THRESHOLDS) -> DataFrame:
    """threshold, confidence, precision, recall, envelope, one point per confidence value (rounded to 6): detections of equal confidence count together.

    The points are written, as each measure reads them more than once.
    """
    d = stored(ranked(detections).select("image_id", "det_no", F.round("confidence", 6).alias("confidence")))
    all_ = d.groupBy("confidence").agg(F.count("*").alias("n")).withColumn("threshold", F.explode(F.array(*(F.lit(x) for x in thresholds))))
    hit = d.join(matches, ["image_id", "det_no"]).groupBy("threshold", "confidence").agg(F.count("*").alias("tp"))
    total = truth.agg(F.count("*").alias("truths"))
    down = W.partitionBy("threshold").orderBy(F.desc("confidence"))
    rows = all_.join(hit, ["threshold", "confidence"], "left").crossJoin(F.broadcast(total))  # one row
    rows = rows.withColumns({"tps": F.sum(F.coalesce("tp", F.lit(0))).over(down), "ns": F.sum("n").over(down)})
    rows = rows.withColumns({"precision": F.col("tps") / F.col("ns"), "recall": F.col("tps") / F.nullif("truths", F.lit(0))})
    best = F.max("precision").over(W.partitionBy("threshold").orderBy("confidence"))
    return stored(rows.withColumn("envelope", best).select("threshold", "confidence", "precision", "recall", "envelope"))


def average_precision(points: DataFrame) -> DataFrame:
    """metric, value: map_50_95, map_50, map_75 by 101 recall points, and mar_500, the mean final recall."""
    grid = points.select("threshold").distinct().withColumn("at", F.explode(F.transform(F.sequence(F.lit(0), F.lit(100)), lambda k: k / F.lit(100.0))))
    # the highest precision at a recall of at least each point: the envelope of the first point that reaches it
    steps = points.withColumn("cell", F.floor(F.col("recall") * 100 + F.lit(1e-9)))
    reach = steps.groupBy("threshold", "cell").agg(F.max("envelope").alias("p"))
    cells = grid.withColumn("cell", F.round(F.col("at") * 100).cast("bigint")).join(reach, ["threshold", "cell"], "left")
    p = F.coalesce(F.max("p").over(W.partitionBy("threshold").orderBy(F.desc("cell"))), F.lit(0.0))
    ap = cells.withColumn("p", p).groupBy("threshold").agg(F.avg("p").alias("ap"))
    last = points.groupBy("threshold").agg(F.max("recall").alias("ar"))
    one = ap.join(last, "threshold").agg(
        F.avg("ap").alias("a"), F.max(F.when(F.col("threshold") == 0.5, F.col("ap"))).alias("b"), F.max(F.when(F.col("threshold") == 0.75, F.col("ap"))).alias("c"), F.avg("ar").alias("d")
    )
    return one.selectExpr("stack(4, 'map_50_95', a, 'map_50', b, 'map_75', c, 'mar_500', d) as (metric, value)")


def f1_sweep(points: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The best F1 over confidences at one overlap, with its precision and recall; ties: the highest confidence."""
    rows = points.filter(F.col("threshold") == threshold)
    f1 = F.coalesce(2 * F.col("precision") * F.col("recall") / F.nullif(F.col("precision") + F.col("recall"), F.lit(0.0)), F.lit(0.0))
    return rows.select("confidence", "precision", "recall", f1.alias("f1")).orderBy(F.desc("f1"), F.desc("confidence")).limit(1)
