"""Model operators re-aimed at Spark ML.

* item content encoding: PCA on assembled tag vectors (linear stand-in for the encoder);
* user encoding / rating model: ALS (explicit) on the long ratings, iterated in ``als.py``;
* implicit item factors: the same with implicit preferences;
* bridge content -> factors: one least-squares fit for all factors at once, from
  normal-equation sums aggregated by Spark (d x d, bounded by the dimension);
* fold-in of new users: factors looked up in files, normal equations of one user after another, and
  sums per (user, salt) of heavy users.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.operators import als, relational
from marquee.operators.relational import dense_index
from marquee.session import cut_lineage, ensure_checkpoint_dir
from marquee.sources.io import write_table

DIGITS = 6


# ------------------------------------------------------------------ metrics
def regression_metrics(pred: DataFrame, label: str = "rating", prediction: str = "prediction") -> DataFrame:
    """Rmse, mse, mae, r2 (1 - SSE / SST) in one pass plus the label mean."""
    e = F.col(label) - F.col(prediction)
    m = pred.agg(F.avg(F.col(label)).alias("_mu"))
    x = pred.crossJoin(F.broadcast(m))
    return x.agg(
        F.sum(e * e).alias("sse"), F.sum((F.col(label) - F.col("_mu")) ** 2).alias("sst"),
        F.avg(F.abs(e)).alias("mae"), F.count(F.lit(1)).alias("n"),
    ).select(
        F.round(F.sqrt(F.col("sse") / F.col("n")), DIGITS).alias("rmse"),
        F.round(F.col("sse") / F.col("n"), DIGITS).alias("mse"),
        F.round("mae", DIGITS).alias("mae"),
        F.round(F.lit(1.0) - F.col("sse") / F.col("sst"), DIGITS).alias("r2"),
    )


def masked_mse(observed: DataFrame, reconstructed: DataFrame, keys: list[str], value: str = "value",
               rec: str = "reconstruction") -> DataFrame:
    """Mean squared error over the observed (stored, non-zero) cells only."""
    j = observed.where(F.col(value) != 0).join(reconstructed, keys)
    return j.agg(F.round(F.avg((F.col(value) - F.col(rec)) ** 2), DIGITS).alias("masked_mse"))


# ---------------------------------------------------------------------- ALS
#: Blocks of users and of items of the fit that draws the random start. The start depends on the blocks of users,
#: which stay those of Spark.
USER_BLOCKS, ITEM_BLOCKS = 10, 6


@dataclass
class CodedAls:
    """An ALS model with the dense codes of its ids, which Spark's ALS holds as 32-bit integers."""

    user_factors: als.Factors
    item_factors: als.Factors
    users: DataFrame  # id, code
    items: DataFrame

    def _side(self, which: str) -> DataFrame:
        """id, features (array<float>)."""
        found, codes = (self.item_factors, self.items) if which == "item" else (self.user_factors, self.users)
        return found.vectors(codes)

    def factors(self, which: str = "item") -> DataFrame:
        return self._side(which).select("id", F.col("features").cast("array<double>").alias("vec"))

    def predict(self, df: DataFrame, user: str = "userId", item: str = "movieId") -> DataFrame:
        """``df`` with ``prediction``; null for ids that the model doesn't know."""
        u, i = (codes.select(F.col("id").alias(f"_{x}id"), F.col("code").cast("bigint").alias(f"_{x}")) for x, codes in (("u", self.users), ("i", self.items)))
        x = df.join(u, F.col(user) == F.col("_uid"), "left").join(i, F.col(item) == F.col("_iid"), "left")
        dot = als.dots(self.user_factors, self.item_factors)
        return x.withColumn("prediction", dot("_u", "_i")).drop("_uid", "_iid", "_u", "_i")

    def recommend_all(self, n: int) -> DataFrame:
        """userId, movieId, predicted_rating and rank of the n best items of every user."""
        x = als.best_items(self.user_factors, self.item_factors, n, self.users).withColumnRenamed("id", "userId")
        items = self.items.select(F.col("code").alias("item"), F.col("id").alias("movieId"))
        x = x.join(items.hint("merge"), "item")  # by the sizes that Spark guesses it could broadcast the lists
        return x.select("userId", "movieId", F.col("score").alias("predicted_rating"), "rank")


@dataclass
class CodedRatings:
    """Ratings under the dense codes of their ids, dealt for ALS, and the codes; any number of fits can read them."""

    dealt: als.Dealt
    users: DataFrame  # id, code
    items: DataFrame


def als_ratings(ratings: DataFrame, user: str = "userId", item: str = "movieId", users: DataFrame | None = None,
                items: DataFrame | None = None) -> CodedRatings:
    """``ratings`` coded and dealt. They are read three times: pass a written table. Rows with a null or unknown id are
    left out; a null or NaN rating is refused."""
    def coded(column: str) -> DataFrame:
        ids = ratings.select(F.col(column).alias("id")).where(F.col(column).isNotNull())
        return cut_lineage(dense_index(ids, "id", "code").select("id", "code"))

    ensure_checkpoint_dir(ratings.sparkSession)
    users, items = coded(user) if users is None else users, coded(item) if items is None else items
    data = ratings.select(F.col(user).alias("_uid"), F.col(item).alias("_iid"), F.col("rating").cast("float").alias("rating"))
    data = data.join(users.select(F.col("id").alias("_uid"), F.col("code").cast("int").alias("_u")), "_uid")
    data = data.join(items.select(F.col("id").alias("_iid"), F.col("code").cast("int").alias("_i")), "_iid")
    known = F.when(F.col("rating").isNull() | F.isnan("rating"), F.raise_error(F.lit("ALS: a rating is null or NaN"))).otherwise(F.col("rating"))
    path = write_table(data.select("_u", "_i", known.cast("float").alias("rating")), "coded-ratings")
    dealt = als.deal(ratings.sparkSession.read.parquet(path))
    als.discard(path)
    return CodedRatings(dealt, users, items)


def als_fit(ratings: DataFrame | CodedRatings, rank: int = 64, reg: float = 0.1, max_iter: int = 15, implicit: bool = False,
            alpha: float = 1.0, seed: int = 42, user: str = "userId", item: str = "movieId",
            users: DataFrame | None = None, items: DataFrame | None = None) -> CodedAls:
    """ALS on dense codes, so ids can be any long. ``users`` and ``items`` (id, code) come from an
    ``IdDictionary`` where codes must outlive the fit; by default the ratings' ids are coded in order. Several fits share
    the ratings that ``als_ratings`` has dealt.

    Spark's ALS draws the start. A user's first vector depends on the users alone, not on their ratings, so it gets
    one rating of each; ``als.iterate`` solves its equations without shuffling factors."""
    from pyspark.ml.recommendation import ALS

    coded = ratings if isinstance(ratings, CodedRatings) else als_ratings(ratings, user, item, users, items)
    spark = coded.users.sparkSession
    first = spark.read.parquet(coded.dealt.by_user).groupBy("_u").agg(F.min("_i").alias("_i"), F.min("rating").alias("rating"))
    start = ALS(rank=rank, regParam=reg, maxIter=0, implicitPrefs=implicit, alpha=alpha, seed=seed, userCol="_u", itemCol="_i",
                ratingCol="rating", numUserBlocks=USER_BLOCKS, numItemBlocks=ITEM_BLOCKS).fit(first)
    found = als.iterate(coded.dealt, start.userFactors, rank, reg, max_iter, alpha if implicit else None)
    if coded is not ratings:
        coded.dealt.discard()
    return CodedAls(*found, coded.users, coded.items)


def factors(model: CodedAls, which: str = "item") -> DataFrame:
    return model.factors(which)


# ---------------------------------------------------------------------- PCA
@dataclass
class Pca:
    """Principal axes (d x k) and the mean (d) of the fitted rows: bounded by the dimension."""

    axes: np.ndarray
    mean: np.ndarray


def pca_fit(vectors: DataFrame, k: int, vec: str = "vec") -> Pca:
    """PCA (covariance d x d on the driver: fine for d ~ 1000 tags, not for n_items columns)."""
    from pyspark.ml.feature import PCA

    data = vectors.select(array_to_vector(vec).alias("features"))
    model = PCA(k=k, inputCol="features", outputCol="enc").fit(data)
    mean = data.select(Summarizer.mean(F.col("features")).alias("m")).first()["m"].toArray()
    return Pca(model.pc.toArray(), mean)


def pca_encode(model: Pca, vectors: DataFrame, vec: str = "vec") -> DataFrame:
    """Projections of the centred rows."""
    axes, mean = model.axes, model.mean

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def encode(x: pd.Series) -> pd.Series:
        return pd.Series(list((np.stack(x.to_numpy()) - mean) @ axes) if len(x) else [], dtype=object)

    return vectors.select("id", encode(F.col(vec)).alias("vec"))


def pca_errors(model: Pca, vectors: DataFrame, vec: str = "vec") -> DataFrame:
    """M6: per row the squared error of mean + P z, and the squared distance from the mean."""
    axes, mean = model.axes, model.mean

    @F.pandas_udf("error double, spread double")
    def measure(x: pd.Series) -> pd.DataFrame:
        rows = np.stack(x.to_numpy()) - mean if len(x) else np.zeros((0, len(mean)))
        rest = rows - (rows @ axes) @ axes.T
        return pd.DataFrame({"error": (rest ** 2).sum(axis=1), "spread": (rows ** 2).sum(axis=1)})

    return vectors.select("id", F.size(vec).alias("d"), measure(F.col(vec)).alias("m")).select("id", "d", "m.error", "m.spread")


def pca_reconstruction_mse(model: Pca, vectors: DataFrame, vec: str = "vec") -> DataFrame:
    """M6: mean squared error over every cell."""
    return pca_errors(model, vectors, vec).agg(F.round(F.sum("error") / F.sum("d"), DIGITS).alias("reconstruction_mse"))


# ------------------------------------------------------------ bridge (M9)
def _gram_rows(x_col: str, y_col: str):
    """Per task, the rows of its [X 1]^T [X 1 | Y]: d + 1 rows of d + 1 + factors values."""
    def run(it):
        total = None
        for pdf in it:
            if pdf.empty:
                continue
            x = np.stack(pdf[x_col].to_numpy())
            x = np.hstack([x, np.ones((x.shape[0], 1))])
            part = x.T @ np.hstack([x, np.stack(pdf[y_col].to_numpy())])
            total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"i": np.arange(len(total)), "sums": list(total)})
    return run


def bridge_fit(content: DataFrame, targets: DataFrame, ridge: float = 1e-6) -> np.ndarray:
    """M9: least squares for every factor at once: (X^T X + l I) B = X^T Y.

    Each task emits the rows of its own sums; Spark adds them up row by row (partially before the
    shuffle, and no task holds more than some rows of the matrix). The summed (d+1) x (d+1) system,
    independent of the number of items, is solved on the driver."""
    j = content.select("id", F.col("vec").alias("x")).join(targets.select("id", F.col("vec").alias("y")), "id")
    rows = j.select("x", "y").mapInPandas(_gram_rows("x", "y"), "i bigint, sums array<double>")
    total = rows.groupBy("i").agg(Summarizer.sum(array_to_vector("sums")).alias("s")).orderBy("i").collect()
    m = np.stack([r["s"].toArray() for r in total])
    d1 = len(m)
    return np.linalg.solve(m[:, :d1] + ridge * np.eye(d1), m[:, d1:])


def bridge_predict(content: DataFrame, beta: np.ndarray, out: str = "pred") -> DataFrame:
    """Predicted factors for (new) items: [x, 1] @ B as an Arrow-batched pandas UDF."""
    b = beta

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def predict(xs: pd.Series) -> pd.Series:
        if len(xs) == 0:
            return pd.Series([], dtype=object)
        X = np.stack(xs.to_numpy())
        X = np.hstack([X, np.ones((X.shape[0], 1))])
        return pd.Series(list(X @ b))

    return content.withColumn(out, predict(F.col("vec")))


def bridge_scores(content: DataFrame, targets: DataFrame, beta: np.ndarray) -> DataFrame:
    """M9 report: r2, mae and target std per factor (in-sample), long form."""
    p = bridge_predict(content, beta).select("id", "pred").join(targets.select("id", F.col("vec").alias("y")), "id")
    z = p.select(F.posexplode(F.arrays_zip("y", "pred")).alias("factor", "v")).select(
        "factor", F.col("v.y").alias("y"), F.col("v.pred").alias("p"))
    m = z.groupBy("factor").agg(F.avg("y").alias("_mu"))
    s = z.join(F.broadcast(m), "factor").groupBy("factor").agg(
        F.sum((F.col("y") - F.col("p")) ** 2).alias("sse"), F.sum((F.col("y") - F.col("_mu")) ** 2).alias("sst"),
        F.avg(F.abs(F.col("y") - F.col("p"))).alias("mae"), F.stddev_pop("y").alias("std"))
    return s.select("factor", F.when(F.col("sst") == 0, F.lit(None)).otherwise(1 - F.col("sse") / F.col("sst")).alias("r2"),
                    "mae", "std")


def weak_dims(scores: DataFrame, threshold: float = 0.1) -> DataFrame:
    """Mean r2 / mae / std over factors and the list of weak factors (r2 < threshold)."""
    return scores.agg(
        F.avg("r2").alias("mean_r2"), F.avg("mae").alias("mean_mae"), F.avg("std").alias("mean_std"),
        F.sort_array(F.collect_list(F.when(F.col("r2") < threshold, F.col("factor")))).alias("weak_factors"))


# ---------------------------------------------------------- fold-in
FOLD_SALTS = 8  # a heavy user's ratings are dealt over so many keys


def _user_sums(side: als.Factors):
    """Normal-equation sums of one (user, salt) after another: rows come sorted by them."""
    lookup = als._Lookup(side)

    def run(it):
        key, a, b, n = None, None, None, 0
        for pdf in it:
            at, found = lookup.find(pdf["movieId"].to_numpy())
            known, rating = pdf[["userId", "salt"]].iloc[at].reset_index(drop=True), pdf["rating"].to_numpy()[at]
            for k, rows in known.groupby(["userId", "salt"], sort=False).indices.items():
                if k != key:
                    if key is not None:
                        yield pd.DataFrame({"userId": [key[0]], "sums": [np.concatenate([a.ravel(), b, [n]])]})
                    key, a, b, n = k, 0.0, 0.0, 0
                a, b, n = a + found[rows].T @ found[rows], b + found[rows].T @ rating[rows], n + len(rows)
        if key is not None:
            yield pd.DataFrame({"userId": [key[0]], "sums": [np.concatenate([a.ravel(), b, [n]])]})

    return run


def _fold_heavy(ratings: DataFrame, side: als.Factors, reg: float) -> DataFrame:
    """Vectors of users whose ratings are dealt by (user, salt); the few sums of a user are added up, then solved."""
    j = ratings.withColumn("salt", F.pmod(F.xxhash64("movieId"), F.lit(FOLD_SALTS))).repartition("userId", "salt")
    parts = j.sortWithinPartitions("userId", "salt").mapInPandas(_user_sums(side), "userId bigint, sums array<double>")
    comb = parts.groupBy("userId").agg(Summarizer.sum(array_to_vector("sums")).alias("s")).select(
        F.col("userId").alias("id"), vector_to_array("s").alias("sums"))

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def solve(sums: pd.Series) -> pd.Series:
        out = []
        for s in sums:
            d = int(round((-1 + (1 + 4 * (len(s) - 1)) ** 0.5) / 2))  # d * d + d + 1 values
            out.append(np.linalg.solve(s[: d * d].reshape(d, d) + reg * s[-1] * np.eye(d), s[d * d : -1]))
        return pd.Series(out, dtype=object)

    return comb.select("id", solve("sums").alias("vec"))


def fold_in_users(ratings: DataFrame, item_factors: DataFrame, reg: float = 0.1) -> DataFrame:
    """User vectors x_u = (V_u^T V_u + reg * n_u I)^-1 V_u^T r_u against fixed item factors.

    The factors are written to files that tasks look up by position, so ratings are shuffled without them, and neither
    is broadcast. A task adds up and solves one user after another; the ratings of users with more than
    ``relational.HEAVY`` of them are dealt by (user, salt). ``ratings`` are read twice."""
    side = als.positions(item_factors, ratings.sparkSession.sparkContext.defaultParallelism)
    known = F.coalesce(F.col("rating").cast("double"), F.lit(float("nan")))
    rated = ratings.select(F.col("userId").cast("bigint").alias("userId"), F.col("movieId").cast("bigint").alias("movieId"), known.alias("rating"))
    rated = rated.where("userId IS NOT NULL AND movieId IS NOT NULL")
    heavy = rated.groupBy("userId").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > relational.HEAVY).select("userId")
    heavy = cut_lineage(heavy)

    def solve(batches):
        for codes, vecs in als._solved(batches, side, reg, None, some=True):
            yield pa.RecordBatch.from_arrays([pa.array(codes), als._lists(vecs)], names=["id", "vec"])

    def light(rows: DataFrame) -> DataFrame:
        return rows.repartition("userId").sortWithinPartitions("userId").mapInArrow(solve, "id bigint, vec array<double>")

    if heavy.isEmpty():
        return light(rated)
    return light(rated.join(heavy, "userId", "left_anti")).unionByName(_fold_heavy(rated.join(heavy, "userId", "left_semi"), side, reg))


# ------------------------------------------------------- genre donor
def closest_by_genres(requests: DataFrame, movies: DataFrame, with_vector: DataFrame) -> DataFrame:
    """For each request (request_id, genres array) the movie with a vector sharing the most
    genres (ties: smallest movieId); a request without genres or overlap gets no donor and overlap 0.

    Requests and movies collapse to their distinct genre sets first; overlaps are counted by one
    equi-join on the genre between the two (few) lists of sets."""
    from marquee.functions.columns import genre_tokens

    def canonical(c):
        return F.array_sort(F.array_distinct(F.coalesce(c, F.array().cast("array<string>"))))

    rq = requests.select("request_id", canonical(F.col("genres")).alias("g"))
    mv = movies.join(with_vector.select(F.col("id").alias("movieId")), "movieId", "left_semi")
    sets = mv.select(canonical(genre_tokens("genres")).alias("s"), "movieId").groupBy("s").agg(F.min("movieId").alias("movieId"))
    wanted = rq.select("g").distinct().select("g", F.explode("g").alias("t"))
    hits = wanted.join(sets.select("s", "movieId", F.explode("s").alias("t")), "t").groupBy("g", "s").agg(
        F.count(F.lit(1)).cast("int").alias("overlap"), F.min("movieId").alias("movieId"))
    found = hits.groupBy("g").agg(F.min(F.struct((-F.col("overlap")).alias("neg"), F.col("movieId"))).alias("_b"))
    return rq.hint("merge").join(found, "g", "left").select(  # by the size of the movies' files Spark would broadcast requests
        "request_id", F.col("_b.movieId").alias("donor_id"), F.coalesce(-F.col("_b.neg"), F.lit(0)).alias("overlap"))
