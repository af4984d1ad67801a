"""Clustering: Spark ML KMeans fits, nearest-centroid assignment, and quality
measures (inertia, Davies-Bouldin, Calinski-Harabasz, silhouette over all rows in
linear time), k sweep with best-k selection (M5*, A18-A22, W1).

Centroid tables hold k rows of d values (bounded by k x d) and are broadcast.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.operators.relational import average_rank, with_scalars
from marquee.session import cut_lineage

DIGITS = 6


def sq_dist(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, x: acc + x)


def _attach(df: DataFrame, small: DataFrame, keys) -> DataFrame:
    """Join a small per-group table (one row per group or per (group, cluster)): broadcast."""
    keys = list(keys)
    return df.join(F.broadcast(small), keys) if keys else df.crossJoin(F.broadcast(small))


def centroids(df: DataFrame, label: str = "cluster", vec: str = "vec", by=()) -> DataFrame:
    """Mean vector and size per label (within each ``by`` group): (*by, cluster, centroid, n), in one pass."""
    keys = [*by, label]
    x = df.select(*keys, array_to_vector(vec).alias("_x"))
    means = x.groupBy(*keys).agg(Summarizer.mean(F.col("_x")).alias("_m"), F.count(F.lit(1)).alias("n"))
    return means.select(*keys, vector_to_array("_m").alias("centroid"), "n")


def assign_centroid(df: DataFrame, cents: DataFrame, vec: str = "vec", label: str = "cluster", keep=()) -> DataFrame:
    """Nearest centroid (squared Euclidean; ties: lower cluster id) for every row, without a shuffle.
    The centroids are one broadcast row of k arrays; rows with equal ids stay rows of their own. Columns of ``keep``
    go along."""
    table = cents.agg(F.sort_array(F.collect_list(F.struct(F.col(label).alias("c"), F.col("centroid").alias("m")))).alias("_cents"))
    x = with_scalars(df.select("id", *dict.fromkeys([vec, *keep])), table)
    nearest = F.array_min(F.transform("_cents", lambda t: F.struct(sq_dist(F.col(vec), t["m"]).alias("d"), t["c"].alias("c"))))
    return x.select("id", *keep, nearest.alias("_b")).select("id", *keep, F.col("_b.c").alias("assigned"), F.col("_b.d").alias("sq_distance"))


def inertia(df: DataFrame, label: str = "cluster", vec: str = "vec", by=()) -> DataFrame:
    """Sum of squared distances to the own centroid (per ``by`` group)."""
    keys = [*by, label]
    c = centroids(df, label, vec, by)
    j = _attach(df, c.select(*keys, "centroid"), keys)
    return j.groupBy(*by).agg(F.round(F.sum(sq_dist(F.col(vec), F.col("centroid"))), DIGITS).alias("inertia"))


def davies_bouldin(df: DataFrame, label: str = "cluster", vec: str = "vec", by=()) -> DataFrame:
    """Mean over clusters of max_j (s_i + s_j) / ||c_i - c_j||, s = mean distance to the centroid."""
    keys = [*by, label]
    c = centroids(df, label, vec, by)
    j = _attach(df, c.select(*keys, "centroid"), keys)
    s = j.groupBy(*keys).agg(F.avg(F.sqrt(sq_dist(F.col(vec), F.col("centroid")))).alias("s"))
    return _separation(c.join(s, keys), by, label)


def _separation(clusters: DataFrame, by, label: str = "cluster") -> DataFrame:
    """A19 of the clusters' centroids and mean distances ``s``."""
    cs = clusters.select(*by, F.col(label).alias("i"), F.col("centroid").alias("ci"), F.col("s").alias("si"))
    other = cs.select(*by, F.col("i").alias("j"), F.col("ci").alias("cj"), F.col("si").alias("sj"))
    pairs = _attach(cs, other, by).where(F.col("i") != F.col("j"))  # k x k per group, bounded by k
    r = pairs.select(*by, "i", ((F.col("si") + F.col("sj")) / F.sqrt(sq_dist(F.col("ci"), F.col("cj")))).alias("r"))
    return r.groupBy(*by, "i").agg(F.max("r").alias("m")).groupBy(*by).agg(
        F.round(F.avg("m"), DIGITS).alias("davies_bouldin"))


def calinski_harabasz(df: DataFrame, label: str = "cluster", vec: str = "vec", by=()) -> DataFrame:
    """(B / (k - 1)) / (W / (n - k))."""
    keys = [*by, label]
    c = centroids(df, label, vec, by)
    allc = centroids(df.withColumn("_all", F.lit(0)), "_all", vec, by).select(*by, F.col("centroid").alias("g"))
    j = _attach(df, c.select(*keys, "centroid"), keys)
    w = j.groupBy(*by).agg(F.sum(sq_dist(F.col(vec), F.col("centroid"))).alias("W"), F.count(F.lit(1)).alias("n"))
    b = _attach(c, allc, by).groupBy(*by).agg(
        F.sum(F.col("n") * sq_dist(F.col("centroid"), F.col("g"))).alias("B"), F.count(F.lit(1)).alias("k_"))
    out = w.join(b, list(by)) if by else w.crossJoin(b)
    return out.select(*by, _ratio().alias("calinski_harabasz"))


def _ratio():
    return F.round((F.col("B") / (F.col("k_") - 1)) / (F.col("W") / (F.col("n") - F.col("k_"))), DIGITS)


def hash_sample(df: DataFrame, size: int, key: str = "id", salt: str = ":sample") -> DataFrame:
    """Deterministic sample: the ``size`` rows with the smallest md5(key || salt) (a sampling operator)."""
    return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(salt))), key).limit(size)


def silhouette(df: DataFrame, label: str = "cluster", vec: str = "vec", by=()) -> DataFrame:
    """Mean silhouette of every row, with squared Euclidean distances.

    The mean distance of x to a cluster is |x|^2 - 2 x.m + s, with m the cluster's mean vector and s its
    mean squared norm, so one pass over the rows with k cluster sums replaces all pairs. Rows alone in
    their cluster count 0. The sums are one broadcast row per ``by`` group (bounded by k x d)."""
    keys = [*by, label]
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)
    norms = df.groupBy(*keys).agg(F.avg(dot(F.col(vec), F.col(vec))).alias("s"))
    sums = centroids(df, label, vec, by).join(norms, keys)
    entry = F.struct(F.col(label).alias("c"), F.col("centroid").alias("m"), F.col("s"), F.col("n").cast("double").alias("n"))
    table = sums.groupBy(*by).agg(F.collect_list(entry).alias("_sums"))
    x = _attach(df, table, by).withColumn("_xx", dot(F.col(vec), F.col(vec)))
    far = F.transform("_sums", lambda t: F.struct(
        t["c"].alias("c"), t["n"].alias("n"), (F.col("_xx") - 2 * dot(F.col(vec), t["m"]) + t["s"]).alias("d")))
    x = x.select(*keys, far.alias("_far"))
    own = F.filter("_far", lambda t: t["c"] == F.col(label))[0]
    other = F.array_min(F.transform(F.filter("_far", lambda t: t["c"] != F.col(label)), lambda t: t["d"]))
    x = x.select(*keys, F.when(own["n"] > 1, own["d"] * own["n"] / (own["n"] - 1)).alias("a"), other.alias("b"))
    score = F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
    score = F.when(F.col("a").isNull() | F.col("b").isNull(), 0.0).otherwise(score)
    return x.groupBy(*by).agg(F.round(F.avg(score), DIGITS).alias("silhouette"))


def silhouette_sample(df: DataFrame, size: int, label: str = "cluster", vec: str = "vec") -> DataFrame:
    """A21 as a sampling operator: exact Euclidean silhouette of the ``size`` ids with the smallest hashes;
    singleton clusters score 0. The caller's size bounds the broadcast sample and the pairs."""
    smp = hash_sample(df.select("id", label, vec), size)
    a = smp.select(F.col("id").alias("i"), F.col(label).alias("li"), F.col(vec).alias("vi"))
    b = smp.select(F.col("id").alias("j"), F.col(label).alias("lj"), F.col(vec).alias("vj"))
    d = a.join(F.broadcast(b), F.col("i") != F.col("j")).select("i", "li", "lj", F.sqrt(sq_dist(F.col("vi"), F.col("vj"))).alias("d"))
    ab = d.groupBy("i", "li", "lj").agg(F.avg("d").alias("md")).groupBy("i").agg(
        F.max(F.when(F.col("li") == F.col("lj"), F.col("md"))).alias("a"),
        F.min(F.when(F.col("li") != F.col("lj"), F.col("md"))).alias("b"))
    sc = F.when(F.col("a").isNull() | F.col("b").isNull(), 0.0).otherwise((F.col("b") - F.col("a")) / F.greatest("a", "b"))
    return ab.agg(F.round(F.avg(sc), DIGITS).alias("silhouette"))


def quality_by_group(df: DataFrame, by, label: str = "cluster", vec: str = "vec") -> DataFrame:
    """The four measures for many labelings at once (one row per ``by`` group), each over all rows."""
    by = list(by)
    return (silhouette(df, label, vec, by).join(calinski_harabasz(df, label, vec, by), by)
            .join(davies_bouldin(df, label, vec, by), by).join(inertia(df, label, vec, by), by))


def kmeans_fit(df: DataFrame, k: int, seed: int = 42, vec: str = "vec", max_iter: int = 20):
    """M5: Spark ML KMeans on array vectors (converted at the ML boundary)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    data = df.select("id", array_to_vector(vec).alias("features"))
    model = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features", predictionCol="cluster").fit(data)
    return model, model.transform(data).select("id", "cluster")


def model_centroids(model, spark) -> DataFrame:
    """Fitted centres as a k-row frame (cluster, centroid)."""
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, "cluster int, centroid array<double>")


def sweep_assignments(df: DataFrame, ks, seed: int = 42, vec: str = "vec") -> DataFrame:
    """(id, vec, labels): the rows with their label in each of the fits, one KMeans per k, written to the shared folder.
    All fits label a row in one pass."""
    from pyspark.ml import PipelineModel

    base = df.select("id", vec).persist()
    try:
        models = []
        for k in ks:
            model, _ = kmeans_fit(base, k, seed, vec)
            models.append(model.setPredictionCol(f"_k{k}"))
        rows = base.select("id", array_to_vector(vec).alias("features"))
        labels = PipelineModel(models).transform(rows).select("id", F.array(*[f"_k{k}" for k in ks]).alias("labels"))
        return cut_lineage(base.join(labels, "id"))
    finally:
        base.unpersist()


def _label_sums(vec: str, ks: list[int]):
    """Per task: size, vector sum and sum of squared norms of each cluster of each fit."""
    def run(it):
        total = {}
        for pdf in it:
            if pdf.empty:
                continue
            x, labels = np.stack(pdf[vec].to_numpy()), np.stack(pdf["labels"].to_numpy())
            x = np.hstack([x, (x * x).sum(axis=1)[:, None], np.ones((len(x), 1))])
            for i, k in enumerate(ks):
                member = (labels[:, i] == np.arange(k)[:, None]).astype(float)
                total[k] = total.get(k, 0.0) + member @ x
        for k, sums in total.items():
            yield pd.DataFrame({"k": k, "cluster": np.arange(k), "sums": list(sums)})
    return run


def _label_measures(vec: str, ks: list[int], sums: dict[int, np.ndarray]):
    """Per task: sums of silhouette scores, squared distances and distances to the own centroid of each cluster."""
    def run(it):
        total = {}
        for pdf in it:
            if pdf.empty:
                continue
            x, labels = np.stack(pdf[vec].to_numpy()), np.stack(pdf["labels"].to_numpy())
            xx, rows = (x * x).sum(axis=1), np.arange(len(x))
            for i, k in enumerate(ks):
                own, n = labels[:, i], sums[k][:, -1]
                size = np.maximum(n, 1.0)
                m, s = sums[k][:, :-2] / size[:, None], sums[k][:, -2] / size
                far = xx[:, None] - 2 * (x @ m.T) + s
                far[:, n == 0] = np.inf
                a = far[rows, own] * n[own] / np.maximum(n[own] - 1, 1.0)
                far[rows, own] = np.inf
                b = far.min(axis=1)
                most = np.maximum(a, b)
                known = (n[own] > 1) & np.isfinite(b) & (most != 0)
                score = np.where(known, (b - a) / np.where(known, most, 1.0), 0.0)
                sq = ((x - m[own]) ** 2).sum(axis=1)
                part = np.stack([np.bincount(own, w, k) for w in (score, sq, np.sqrt(sq))], axis=1)
                total[k] = total.get(k, 0.0) + part
        for k, part in total.items():
            yield pd.DataFrame({"k": k, "cluster": np.arange(k), "score": part[:, 0], "sq": part[:, 1], "dist": part[:, 2]})
    return run


def quality_of_fits(fits: DataFrame, ks, vec: str = "vec") -> DataFrame:
    """The four measures of each fit of ``sweep_assignments`` over all rows, as ``quality_by_group`` defines them.

    Two passes over the rows, each once for all fits: sums per cluster, then distances to the means. Tasks emit a row
    for each cluster of each fit; the sums of the first pass (bounded by clusters x d) go to the tasks of the second."""
    ks = [int(k) for k in ks]
    per_task = fits.mapInPandas(_label_sums(vec, ks), "k int, cluster int, sums array<double>")
    sums = {k: {} for k in ks}
    for r in per_task.groupBy("k", "cluster").agg(Summarizer.sum(array_to_vector("sums")).alias("s")).collect():
        sums[r["k"]][r["cluster"]] = r["s"].toArray()
    sums = {k: np.stack([of[c] for c in range(k)]) for k, of in sums.items() if of}
    rows = [(k, c, int(v[-1]), [float(y) for y in v[:-2] / v[-1]]) for k, of in sums.items() for c, v in enumerate(of) if v[-1] > 0]
    c = fits.sparkSession.createDataFrame(rows, "k int, cluster int, n bigint, centroid array<double>")
    measures = fits.mapInPandas(_label_measures(vec, ks, sums), "k int, cluster int, score double, sq double, dist double")
    measures = measures.groupBy("k", "cluster").agg(F.sum("score").alias("score"), F.sum("sq").alias("sq"), F.sum("dist").alias("dist"))
    c = cut_lineage(c.join(F.broadcast(measures), ["k", "cluster"]))
    whole = c.groupBy("k").agg(F.sum("n").alias("_rows"), Summarizer.mean(array_to_vector("centroid"), F.col("n").cast("double")).alias("_g"))
    b = c.join(F.broadcast(whole.select("k", "_rows", vector_to_array("_g").alias("g"))), "k").groupBy("k").agg(
        F.sum("score").alias("score"), F.sum("sq").alias("W"), F.max("_rows").alias("n"),
        F.sum(F.col("n") * sq_dist(F.col("centroid"), F.col("g"))).alias("B"), F.count(F.lit(1)).alias("k_"))
    cs = c.select("k", "cluster", "centroid", (F.col("dist") / F.col("n")).alias("s"))
    return b.join(_separation(cs, ["k"]), "k").select(
        "k", F.round(F.col("score") / F.col("n"), DIGITS).alias("silhouette"), _ratio().alias("calinski_harabasz"),
        "davies_bouldin", F.round("W", DIGITS).alias("inertia"))


def k_sweep(df: DataFrame, ks, seed: int = 42, vec: str = "vec") -> DataFrame:
    """The four quality measures of all fits, computed over all rows in two passes."""
    out = quality_of_fits(sweep_assignments(df, ks, seed, vec), ks, vec)
    return out.select(F.col("k").cast("int").alias("k"), "silhouette", "calinski_harabasz", "davies_bouldin", "inertia")


def segment_by_vote(df: DataFrame, ks, seed: int = 42, vec: str = "vec") -> DataFrame:
    """M5c + W1: (id, cluster) of the fit whose k has the best total rank over the four measures (ties: smaller k)."""
    fits = sweep_assignments(df, ks, seed, vec)
    votes = cut_lineage(k_rank_vote(quality_of_fits(fits, ks, vec)))
    chosen = votes.agg(F.min(F.struct("rank_total", "k")).alias("_b")).select(F.col("_b.k").alias("_k"))
    place = F.array_position(F.array(*[F.lit(int(k)) for k in ks]), F.col("_k")).cast("int")
    return with_scalars(fits, chosen).select("id", F.element_at("labels", place).alias("cluster"))


def k_rank_vote(metrics: DataFrame) -> DataFrame:
    """Average rank per metric (silhouette and CH high is good; DB and inertia low is good)
    and their total; the metric table has one row per k (small), so an unpartitioned window is fine."""
    x = average_rank(metrics, "silhouette", False, "r_sil")
    x = average_rank(x, "calinski_harabasz", False, "r_ch")
    x = average_rank(x, "davies_bouldin", True, "r_db")
    x = average_rank(x, "inertia", True, "r_in")
    return x.withColumn("rank_total", F.col("r_sil") + F.col("r_ch") + F.col("r_db") + F.col("r_in"))


def best_k(metrics: DataFrame, by: str = "silhouette", highest: bool = True) -> DataFrame:
    """The k of the best value (ties: smaller k)."""
    o = F.col(by).desc() if highest else F.col(by).asc()
    w = Window.orderBy(o, F.col("k").asc())
    return metrics.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).select("k", by)
