"""Evaluation: multiset and overlap precision and recall, curves, threshold tuning, diagnostics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import overlap


def f_score(precision: Column, recall: Column, beta: float = 1.0) -> Column:
    """F-beta; 0 if either is 0."""
    b = beta * beta
    return F.when((precision == 0) | (recall == 0), F.lit(0.0)).otherwise(F.try_divide((1 + b) * precision * recall, b * precision + recall))


def ordinals(items: DataFrame, keys: list[str]) -> DataFrame:
    """Counts of equal items: the k-th of one side matches the k-th of the other, so matches are the lesser count."""
    return items.groupBy(*keys).agg(F.count("*").alias("n"))


def multiset_counts(predictions: DataFrame, labels: DataFrame, keys: list[str], penalize_duplicates: bool = True) -> DataFrame:
    """One row: true positives, predictions, labels."""
    p, t = ordinals(predictions, keys), ordinals(labels, keys)
    if not penalize_duplicates:
        p = p.withColumn("n", F.lit(1).cast("long"))
    both = p.withColumnRenamed("n", "np").join(t.withColumnRenamed("n", "nt"), keys, "full_outer").fillna(0, ["np", "nt"])
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return both.agg(zero(F.least("np", "nt")).alias("tp"), zero("np").alias("n_pred"), zero("nt").alias("n_label"))


def scores(counts: DataFrame, beta: float = 1.0) -> DataFrame:
    """Precision (1 without predictions), recall (1 without labels), F-beta."""
    p = F.when(F.col("n_pred") == 0, 1.0).otherwise(F.col("tp") / F.col("n_pred"))
    r = F.when(F.col("n_label") == 0, 1.0).otherwise(F.col("tp") / F.col("n_label"))
    return counts.withColumn("precision", p).withColumn("recall", r).withColumn("fscore", f_score(F.col("precision"), F.col("recall"), beta))


def unmatched(items: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    """Items beyond the other side's count of each: false positives, or with the sides swapped false negatives."""
    a, b = ordinals(items, keys), ordinals(others, keys).withColumnRenamed("n", "m")
    return a.join(b, keys, "left").withColumn("n", F.col("n") - F.coalesce("m", F.lit(0))).where("n > 0").select(*keys, "n")


def many_to_one(overlaps: DataFrame) -> DataFrame:
    return overlap.largest(overlaps).select("row_id", "col_id", "vals")


def one_to_one(overlaps: DataFrame) -> DataFrame:
    return overlap.largest(many_to_one(overlaps), "col_id", "row_id").select("row_id", "col_id", "vals")


def ignore(overlaps: DataFrame, ignored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Overlaps without predictions that overlap an ignored label (col_id) most, and without those labels; and the predictions that went."""
    gone = many_to_one(overlaps).join(ignored.select("col_id").distinct(), "col_id", "left_semi").select("row_id")
    return overlaps.join(gone, "row_id", "left_anti").join(ignored.select("col_id").distinct(), "col_id", "left_anti"), gone


def overlap_scores(overlaps: DataFrame, rows: DataFrame, cols: DataFrame, mode: str = "conservative") -> DataFrame:
    """One row: matched and all predictions (row_id), matched and all labels (col_id), precision, recall.

    mode: bare (any overlap matches), liberal (predictions to their largest label), conservative
    (one to one).
    """
    used = {"bare": lambda o: o, "liberal": many_to_one, "conservative": one_to_one}[mode](overlaps.where("vals > 0"))
    side = lambda ids, k: ids.select(k).distinct().join(used.select(k).distinct().withColumn("m", F.lit(1)), k, "left").agg(F.count("m").alias(f"m_{k}"), F.count("*").alias(f"n_{k}"))
    both = side(rows, "row_id").crossJoin(side(cols, "col_id"))  # one row each
    rate = lambda k: F.when(F.col(f"n_{k}") == 0, 1.0).otherwise(F.col(f"m_{k}") / F.col(f"n_{k}"))
    return both.withColumn("precision", rate("row_id")).withColumn("recall", rate("col_id"))


def threshold_counts(scored: DataFrame, score: str, label: str, bins: int, low: float, high: float) -> DataFrame:
    """For each bin, the true positives, false positives and false negatives of keeping scores in it or above; the last bin holds its upper edge."""
    bin_ = F.least(F.floor((F.col(score) - low) * bins / (high - low)), F.lit(bins - 1)).cast("long")
    hist = scored.where((F.col(score) >= low) & (F.col(score) <= high)).groupBy(bin_.alias("bin")).agg(F.count_if(F.col(label)).alias("pos"), F.count_if(~F.col(label)).alias("neg"))
    up = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = hist.select("bin", F.sum("pos").over(up).alias("tp"), F.sum("neg").over(up).alias("fp"), F.sum("pos").over(whole).alias("all_pos"))
    return out.select("bin", "tp", "fp", (F.col("all_pos") - F.col("tp")).alias("fn"))


def best_threshold(counts: DataFrame, beta: float = 1.0) -> DataFrame:
    """The bin of the best F-beta; the lowest of equals."""
    p, r = F.try_divide("tp", F.col("tp") + F.col("fp")), F.try_divide("tp", F.col("tp") + F.col("fn"))
    scored = counts.withColumn("fscore", f_score(F.coalesce(p, F.lit(0.0)), F.coalesce(r, F.lit(0.0)), beta))
    return scored.orderBy(F.desc("fscore"), "bin").limit(1)


def cumulative(steps: DataFrame, key: str, sums: list[str], descending: bool = True) -> DataFrame:
    """steps with running sums of columns in order of key, by ranges: one task numbers the ranges only."""
    from ..storage import written

    order = F.desc(key) if descending else F.asc(key)
    dealt = written(steps.repartitionByRange(order).withColumn("__range", F.spark_partition_id()), "steps")
    totals = dealt.groupBy("__range").agg(*(F.sum(c).alias(f"__{c}") for c in sums))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("__range", *(F.coalesce(F.sum(f"__{c}").over(before), F.lit(0)).alias(f"__{c}") for c in sums))
    own = Window.partitionBy("__range").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = dealt.withColumns({c: F.sum(c).over(own) for c in sums})
    return inside.join(totals, "__range").select(*(c for c in steps.columns if c not in sums), *((F.col(c) + F.col(f"__{c}")).alias(c) for c in sums))


def curve(scored: DataFrame, labels: int | DataFrame, score: str = "score", hit: str = "hit") -> DataFrame:
    """True and false positives and false negatives of keeping each distinct score or above. labels: their number, or the table of them."""
    n = labels if isinstance(labels, int) else labels.count()
    steps = scored.groupBy(score).agg(F.count_if(F.col(hit)).alias("tp"), F.count("*").alias("kept"))
    out = cumulative(steps, score, ["tp", "kept"])
    return out.select(score, "tp", (F.col("kept") - F.col("tp")).alias("fp"), (F.lit(n) - F.col("tp")).alias("fn"))


def edge_curve(predictions: DataFrame, labels: DataFrame, keys: list[str], score: str = "score") -> DataFrame:
    """Precision and recall of keeping scored predictions from each distinct score on. Of equal predictions the least scores match labels, as many as there are."""
    ranked = predictions.withColumn("__k", F.row_number().over(Window.partitionBy(*keys).orderBy(score)))
    known = ordinals(labels, keys)
    hits = ranked.join(known, keys, "left").select(score, (F.col("__k") <= F.coalesce("n", F.lit(0))).alias("hit"))
    out = curve(hits, labels, score)
    return out.withColumn("precision", F.try_divide("tp", F.col("tp") + F.col("fp"))).withColumn("recall", F.try_divide("tp", F.col("tp") + F.col("fn")))


def curve2d(scored: DataFrame, a: str, b: str, hit: str = "hit", inclusive: bool = True) -> DataFrame:
    """For each pair of distinct values, hits and others with both scores at least (inclusive) or above them.

    Counts are summed along one axis after the other over the grid of distinct values, never by
    comparing rows with rows.
    """
    cells = scored.groupBy(a, b).agg(F.count_if(F.col(hit)).alias("h"), F.count_if(~F.col(hit)).alias("m"))
    grid = scored.select(a).distinct().crossJoin(scored.select(b).distinct()).join(cells, [a, b], "left").fillna(0, ["h", "m"])
    last = Window.currentRow if inclusive else -1
    for axis, other in ((a, b), (b, a)):
        w = Window.partitionBy(other).orderBy(F.desc(axis)).rowsBetween(Window.unboundedPreceding, last)
        grid = grid.withColumn("h", F.coalesce(F.sum("h").over(w), F.lit(0))).withColumn("m", F.coalesce(F.sum("m").over(w), F.lit(0)))
    return grid.select(a, b, F.col("h").alias("tp"), F.col("m").alias("fp"))


def scores2d(grid: DataFrame, positives: int, beta: float = 1.0) -> DataFrame:
    """curve2d() with fn, precision, recall and F-beta; positives: hits in all."""
    out = grid.withColumn("fn", F.lit(positives) - F.col("tp"))
    p, r = F.try_divide("tp", F.col("tp") + F.col("fp")), F.try_divide("tp", F.col("tp") + F.col("fn"))
    return out.withColumn("precision", p).withColumn("recall", r).withColumn("fscore", f_score(F.col("precision"), F.col("recall"), beta))


def lower_grid(scored: DataFrame, a: str, b: str, hit: str = "hit") -> DataFrame:
    """For each pair of distinct values, hits (fn) with both scores below them: what a pair of inclusive thresholds on either axis leaves out."""
    cells = scored.groupBy(a, b).agg(F.count_if(F.col(hit)).alias("fn"))
    grid = scored.select(a).distinct().crossJoin(scored.select(b).distinct()).join(cells, [a, b], "left").fillna(0, ["fn"])
    for axis, other in ((a, b), (b, a)):
        w = Window.partitionBy(other).orderBy(axis).rowsBetween(Window.unboundedPreceding, -1)
        grid = grid.withColumn("fn", F.coalesce(F.sum("fn").over(w), F.lit(0)))
    return grid


def iso_curve(spark, fscore: float, recalls: list[float] | None = None, beta: float = 1.0) -> DataFrame:
    """recall, precision of a constant F-beta, where the precision is not negative."""
    rows = [(float(r),) for r in (recalls if recalls is not None else [(k + 1) / 100 for k in range(100)])]
    b = beta * beta
    out = spark.createDataFrame(rows, "recall double").withColumn("precision", F.try_divide(fscore * F.col("recall"), (1 + b) * F.col("recall") - b * fscore))
    return out.where("precision >= 0")


def size_tuning(segments: DataFrame, hits: DataFrame, thresholds: list[int], labels: int | DataFrame) -> DataFrame:
    """For each size threshold, predictions kept and labels found. segments: row_id, size; hits: row_id, col_id. labels: their number, or the table of them."""
    n = labels if isinstance(labels, int) else labels.count()
    passed = F.filter(F.array(*(F.lit(t).cast("long") for t in thresholds)), lambda t: t <= F.col("size"))
    kept = segments.select("row_id", F.explode(passed).alias("threshold"))
    found = kept.join(hits, "row_id", "left").groupBy("threshold").agg(F.count_distinct("row_id").alias("n_pred"), F.count_distinct(F.when(F.col("col_id").isNotNull(), F.col("row_id"))).alias("tp_pred"), F.count_distinct("col_id").alias("tp_label"))
    return found.withColumn("n_label", F.lit(n))


def best_of(scored: DataFrame, columns: list[str], score: str = "fscore") -> DataFrame:
    """The row of the best score; the least columns of equals. Null and NaN scores don't count."""
    return scored.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double"))).orderBy(F.desc(score), *columns).limit(1)


def distance_score(pred: DataFrame, label: DataFrame, distance: int, resolution=(4, 4, 40)) -> DataFrame:
    """Thresholded distance errors: predicted voxels farther than distance from any label voxel, labels farther from any prediction, and the other predicted voxels."""
    from .edges import near_pairs

    both = pred.select("x", "y", "z", F.lit(0).alias("side")).unionByName(label.select("x", "y", "z", F.lit(1).alias("side"))).distinct()
    span = 1 << 18
    rows = both.withColumn("key", (((F.col("z").cast("long") * span + F.col("y")) * span + F.col("x")) * 2 + F.col("side")).cast("long"))
    pairs = near_pairs(rows, float(distance), [], "key", ["x", "y", "z"], resolution, inclusive=True).where("id1 % 2 != id2 % 2")
    near = pairs.select(F.explode(F.array("id1", "id2")).alias("key")).distinct().withColumn("near", F.lit(True))
    out = rows.join(near, "key", "left")
    return out.agg(F.count_if((F.col("side") == 0) & F.col("near").isNull()).alias("fp"), F.count_if((F.col("side") == 1) & F.col("near").isNull()).alias("fn"), F.count_if((F.col("side") == 0) & F.col("near")).alias("tp"))


def cremi_score(dense: DataFrame, pred: str, label: str, distance: float = 200, resolution=(4, 4, 40), keys: tuple[str, ...] = ()) -> DataFrame:
    """One row, or one a box of keys: tp, fp, fn by distance to the other side's nearest voxel, the summed distances of missed labels (dgt) and of false positives (df), and 1 - F.

    dense: a row for every voxel of each box.
    """
    from .proximity import euclidean2

    rows = dense.select(*keys, "x", "y", "z", (F.col(pred) != 0).alias("p"), (F.col(label) != 0).alias("l"))
    rows = euclidean2(euclidean2(rows, F.col("p"), "to_p", resolution, keys), F.col("l"), "to_l", resolution, keys)
    far = lambda c: F.col(c).isNull() | (F.col(c) > F.lit(distance) * F.lit(distance))
    total = lambda own, c: F.coalesce(F.sum(F.when(own & far(c), F.sqrt(c))), F.lit(0.0))
    out = rows.groupBy(*keys).agg(F.count_if(F.col("p") & ~far("to_l")).alias("tp"), F.count_if(F.col("p") & far("to_l")).alias("fp"), F.count_if(F.col("l") & far("to_p")).alias("fn"), total(F.col("l"), "to_p").alias("dgt"), total(F.col("p"), "to_l").alias("df"))
    return out.withColumn("score", F.lit(1.0) - F.coalesce(F.try_divide(2.0 * F.col("tp"), 2.0 * F.col("tp") + F.col("fp") + F.col("fn")), F.lit(0.0)))


def unmatched_ids(overlaps: DataFrame, ids: DataFrame, key: str, mode: str = "bare") -> DataFrame:
    """ids (key) without a match: predictions (row_id) or labels (col_id)."""
    used = {"bare": lambda o: o, "liberal": many_to_one, "conservative": one_to_one}[mode](overlaps.where("vals > 0"))
    return ids.select(key).distinct().join(used.select(key).distinct(), key, "left_anti")


def segmented_edge_scores(overlaps: DataFrame, pred_ids: DataFrame, label_ids: DataFrame, pred_edges: DataFrame, label_edges: DataFrame, key: str = "cleft_segid") -> DataFrame:
    """Multiset scores after predicted segments take the id of the label that they overlap most.

    A segment without overlap takes the least label id. An edge of a segment that pred_ids lacks is
    an error.
    """
    least = label_ids.agg(F.min("col_id").alias("least"))
    mapping = pred_ids.select("row_id").distinct().join(overlap.largest(overlaps), "row_id", "left").crossJoin(least).select(F.col("row_id").alias(key), F.coalesce("col_id", "least").alias("__to"))
    rest = [c for c in pred_edges.columns if c != key]
    found = F.coalesce("__to", F.raise_error(F.lit("an edge's segment is not in the volume")).cast("long"))
    mapped = pred_edges.join(mapping, key, "left").select(found.alias(key), *rest)
    return scores(multiset_counts(mapped, label_edges, [key, *rest]))


def summed_overlaps(pairs: DataFrame, pre: DataFrame, post: DataFrame) -> DataFrame:
    """pairs (pre_id, post_id) with col_id, the cleft of which both terminals together hold most; the least id of equals, null without any. pre, post: row_id, col_id, vals."""
    both = pairs.join(pre.withColumnRenamed("row_id", "pre_id"), "pre_id").unionByName(pairs.join(post.withColumnRenamed("row_id", "post_id"), "post_id").select("pre_id", *[c for c in pairs.columns if c != "pre_id"], "col_id", "vals"))
    whole = both.groupBy("pre_id", "post_id", "col_id").agg(F.sum("vals").alias("vals"))
    best = F.max(F.struct("vals", (-F.col("col_id")).alias("less")))
    top = whole.groupBy("pre_id", "post_id").agg(best.alias("b")).select("pre_id", "post_id", (-F.col("b.less")).alias("col_id"))
    return pairs.join(top, ["pre_id", "post_id"], "left")


def threshold_grid(scored: DataFrame, labels: DataFrame, pre_thresholds: list[float], post_thresholds: list[float], key: str = "cleft_segid", seg: str = "segid", beta: float = 1.0) -> DataFrame:
    """Multiset scores of assignment by each pair of thresholds: pre_t, post_t, tp, n_pred, n_label, precision, recall, fscore.

    scored: key, seg, pre, post. Every pair of partners is one row with the pairs of thresholds that
    give it, so the grid multiplies no join. A segment without a partner over a pre threshold falls
    back to its best one, on the post side to none. labels: key, presyn_segid, postsyn_segid.
    """
    own = Window.partitionBy(key)
    best = F.row_number().over(own.orderBy(F.desc("pre"), seg)) == 1
    ranked = scored.withColumn("__best", best).withColumn("__top", F.max("pre").over(own))
    thresholds = lambda ts: F.array(*(F.lit(float(t)) for t in ts))
    pre = ranked.select(key, F.col(seg).alias("presyn_segid"), F.explode(F.filter(thresholds(pre_thresholds), lambda t: (F.col("pre") > t) | (F.col("__best") & (F.col("__top") <= t)))).alias("pre_t"))
    post = scored.select(key, F.col(seg).alias("postsyn_segid"), F.explode(F.filter(thresholds(post_thresholds), lambda t: F.col("post") > t)).alias("post_t"))
    keys = [key, "presyn_segid", "postsyn_segid"]
    preds = pre.join(post, key).groupBy("pre_t", "post_t", *keys).agg(F.count("*").alias("np"))
    known = ordinals(labels, keys).withColumnRenamed("n", "nt")
    n = labels.count()
    counts = preds.join(known, keys, "left").groupBy("pre_t", "post_t").agg(F.sum(F.least(F.col("np"), F.coalesce("nt", F.lit(0)))).alias("tp"), F.sum("np").alias("n_pred"))
    return scores(counts.withColumn("n_label", F.lit(n).cast("long")), beta)


def dataset_scores(voxels: DataFrame, dataset: str, pred: str, label: str, ignored: DataFrame | None = None, beta: float = 1.0) -> DataFrame:
    """A row for each volume of a data set: one-to-one matches, predictions, labels, precision, recall, F-beta. ignored: dataset, label ids that don't count, nor predictions that overlap them most."""
    found = overlap.count(voxels, pred, label, [dataset])
    gone = None
    if ignored is not None:
        bad = ignored.select(dataset, F.col(label).alias("col_id")).distinct()
        gone = _largest_in(found, dataset, "row_id", "col_id").join(bad, [dataset, "col_id"], "left_semi").select(dataset, "row_id")
        found = found.join(gone, [dataset, "row_id"], "left_anti").join(bad, [dataset, "col_id"], "left_anti")
    matched = _largest_in(_largest_in(found, dataset, "row_id", "col_id"), dataset, "col_id", "row_id").groupBy(dataset).agg(F.count("*").alias("tp"))
    out = voxels.select(dataset).distinct().join(matched, dataset, "left")
    for column, name, key, less in ((pred, "n_pred", "row_id", gone), (label, "n_label", "col_id", None if ignored is None else bad)):
        ids = voxels.where(F.col(column) != 0).select(dataset, F.col(column).alias(key)).distinct()
        ids = ids if less is None else ids.join(less, [dataset, key], "left_anti")
        out = out.join(ids.groupBy(dataset).agg(F.count("*").alias(name)), dataset, "left")
    return scores(out.fillna(0, ["tp", "n_pred", "n_label"]), beta)


def _largest_in(overlaps: DataFrame, dataset: str, by: str, of: str) -> DataFrame:
    best = F.max(F.struct(F.col("vals"), (-F.col(of)).alias("less")))
    return overlaps.groupBy(dataset, by).agg(best.alias("b")).select(dataset, by, (-F.col("b.less")).alias(of), F.col("b.vals").alias("vals"))


def total_scores(by_dataset: DataFrame, beta: float = 1.0) -> DataFrame:
    """dataset_scores() of all volumes together."""
    return scores(by_dataset.agg(*(F.sum(c).alias(c) for c in ("tp", "n_pred", "n_label"))), beta)
