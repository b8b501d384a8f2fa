"""K-Means over a popularity table, cluster labels, and per-label summaries.

The input of the fit is the aggregated (item, grp) table, not the posts. It is laid out
deterministically (hash-partitioned on the keys into a fixed number of partitions and
sorted inside them) and checkpointed before the fit: K-Means' k-means|| initialisation
samples per partition, so the same layout and seed give the same centres, and the
iterations re-read the checkpoint instead of re-running the scan/join/aggregate.
"""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import attach_stats
from ..schema import require_columns
from ..session import materialize

# The reference's cluster labels.
HOTSPOT_LABEL = "🔥 Popular Hotspot"
HIDDEN_GEM_LABEL = "💎 Hidden Gem"
REGULAR_LABEL = "📍 Regular Destination"

LAYOUT_PARTITIONS = 32  # of the fit's input
FEATURES = ("review_count", "popularity_score")  # the two K-Means inputs
OUTPUT = ["item", "grp", "review_count", "popularity_score", "prediction"]


def cluster_items(popularity: DataFrame, k: int = 4, seed: int = 42,
                  partitions: int = LAYOUT_PARTITIONS) -> DataFrame:
    """K-Means on (review_count, popularity_score), then labelled:
    (item, grp, review_count, popularity_score, prediction, cluster_label). The layout, and
    with it the result, depends on ``partitions`` and ``seed`` only, not on the session's
    settings; pass more partitions for a pair table of many gigabytes."""
    require_columns(popularity, "item", "grp", *FEATURES)
    laid_out = (
        popularity.select("item", "grp", "review_count", "popularity_score")
        .repartition(partitions, "item", "grp")
        .sortWithinPartitions("item", "grp")
    )
    # A NULL score (all counts equal) enters the vector as 0.0: the assembler rejects NULL.
    inputs = laid_out.withColumn("_rc", F.col("review_count").cast("double")).withColumn(
        "_score_f", F.coalesce(F.col("popularity_score"), F.lit(0.0))
    )
    assembler = VectorAssembler(inputCols=["_rc", "_score_f"], outputCol="features")
    features = materialize(assembler.transform(inputs))
    model = KMeans(k=k, seed=seed, featuresCol="features").fit(features)
    clustered = model.transform(features).select(*OUTPUT)
    return label_clusters(clustered)


def best_cuts(values: list[int], weights: list[int], k: int) -> list[int]:
    """Where the sorted distinct ``values`` (with their weights) are cut into at most ``k`` runs of
    least total squared distance to the runs' means: the first index of each run but the first.

    Dynamic program over runs; the best last cut moves on with the end of the run, so that each
    layer takes n log n steps (divide and conquer)."""
    n, k = len(values), min(k, len(values))
    sums = [(0, 0, 0)]
    for x, w in zip(values, weights, strict=True):
        a, b, c = sums[-1]
        sums.append((a + w, b + w * x, c + w * x * x))

    def cost(i: int, j: int) -> float:  # of the run values[i:j]; exact up to the last division
        w, x, xx = (b - a for a, b in zip(sums[i], sums[j], strict=True))
        return (w * xx - x * x) / w

    best = [0.0] + [cost(0, j) for j in range(1, n + 1)]
    cuts: list[list[int]] = []
    for layer in range(1, k):
        now, cut = [float("inf")] * (n + 1), [0] * (n + 1)
        stack = [(layer + 1, n, layer, n - 1)]
        while stack:
            low, high, first, last = stack.pop()
            if low > high:
                continue
            j = (low + high) // 2
            for i in range(max(first, layer), min(last, j - 1) + 1):
                c = best[i] + cost(i, j)
                if c < now[j]:
                    now[j], cut[j] = c, i
            stack += [(low, j - 1, first, cut[j]), (j + 1, high, cut[j], last)]
        best = now
        cuts.append(cut)
    out, j = [], n
    for cut in reversed(cuts):
        j = cut[j]
        out.append(j)
    return out[::-1]


def optimal_clusters(popularity: DataFrame, k: int = 4) -> DataFrame:
    """The best possible K-Means clusters: (item, grp, review_count, popularity_score, prediction),
    numbered by rising count.

    The two features are collinear (the score is the scaled count), so clusters are intervals of the
    count and the optimum is a dynamic program over the histogram of distinct counts. Only that
    histogram reaches the driver: counts that add up to N posts have at most sqrt(2 N) distinct
    values. NULL counts have no cluster."""
    require_columns(popularity, "item", "grp", *FEATURES)
    counts = popularity.where(F.col("review_count").isNotNull()).groupBy("review_count").agg(F.count(F.lit(1)).alias("n"))
    histogram = sorted((r["review_count"], r["n"]) for r in counts.collect())
    values, weights = [x for x, _ in histogram], [w for _, w in histogram]
    prediction = F.when(F.col("review_count").isNotNull(), F.lit(0))
    for i in best_cuts(values, weights, k) if values else []:
        prediction = prediction + F.when(F.col("review_count") >= F.lit(values[i]), 1).otherwise(0)
    return popularity.select("item", "grp", "review_count", "popularity_score", prediction.cast("int").alias("prediction"))


def cluster_cost(clustered: DataFrame) -> DataFrame:
    """One row per cluster: (prediction, item_count, mean_count, cost), cost the squared distances of
    the counts to their mean, rounded to 4 decimals. Summed over clusters it measures any clustering
    of a popularity table, so that a K-Means result can be held against the optimum."""
    n, x = F.count("review_count"), F.col("review_count").cast("decimal(38,0)")
    spread = F.sum(x * x).cast("double") - F.sum(x).cast("double") * F.sum(x).cast("double") / n
    return clustered.groupBy("prediction").agg(
        n.alias("item_count"), F.round(F.sum(x).cast("double") / n, 4).alias("mean_count"), F.round(spread, 4).alias("cost")
    )


def label_clusters(clustered: DataFrame) -> DataFrame:
    """Name clusters by their mean popularity: the highest mean -> hotspot, the lowest ->
    hidden gem (which wins when both are the same cluster), others -> regular. Equal means
    resolve to the lowest cluster id. The per-cluster means are at most k rows; the two
    chosen ids are a one-row aggregate broadcast back to every row."""
    require_columns(clustered, "prediction", "popularity_score")
    means = (
        clustered.groupBy("prediction")
        .agg(F.avg("popularity_score").alias("_mean"))
        .where(F.col("_mean").isNotNull())
    )
    labelled = attach_stats(
        clustered,
        means,
        F.max(F.struct(F.col("_mean"), (-F.col("prediction")).alias("_neg_id"))).alias("_hot"),
        F.min(F.struct(F.col("_mean"), F.col("prediction").alias("_id"))).alias("_gem"),
    )
    label = (
        F.when(F.col("prediction") == F.col("_gem._id"), F.lit(HIDDEN_GEM_LABEL))
        .when(F.col("prediction") == -F.col("_hot._neg_id"), F.lit(HOTSPOT_LABEL))
        .otherwise(F.lit(REGULAR_LABEL))
    )
    return labelled.withColumn("cluster_label", label).drop("_hot", "_gem")


def cluster_summary(labelled: DataFrame) -> DataFrame:
    """Per label: (cluster_label, item_count, avg_popularity, avg_reviews), means rounded
    to 2 decimals. As in pandas' ``count``, NULL items are not counted."""
    out = labelled.groupBy("cluster_label").agg(
        F.count("item").alias("item_count"),
        F.round(F.avg("popularity_score"), 2).alias("avg_popularity"),
        F.round(F.avg(F.col("review_count").cast("double")), 2).alias("avg_reviews"),
    )
    return out.orderBy("cluster_label")


def cluster_samples(labelled: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` members of each label in popularity order (score descending, then
    item, grp): (cluster_label, item, grp, review_count, popularity_score, sample_rank).
    Planned as a WindowGroupLimit: at most ``n`` rows per label leave each task."""
    w = Window.partitionBy("cluster_label").orderBy(
        F.col("popularity_score").desc_nulls_last(), F.col("item").asc_nulls_first(), F.col("grp").asc_nulls_first()
    )
    ranked = labelled.withColumn("sample_rank", F.row_number().over(w))
    return ranked.where(F.col("sample_rank") <= F.lit(n)).select(
        "cluster_label", "item", "grp", "review_count", "popularity_score", "sample_rank"
    )
