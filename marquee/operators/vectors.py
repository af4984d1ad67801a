"""Vector operators on (id, vec array<double>) frames.

Per-dimension statistics are one aggregate pass (Summarizer) into one row of d-length arrays
(bounded by the dimension), broadcast to the rows that need them.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators.relational import with_scalars


def dim_stats(df: DataFrame, vec: str = "vec") -> DataFrame:
    """One row of per-dimension arrays: mins, maxs, means, stds (population)."""
    x = df.select(array_to_vector(vec).alias("_x"))
    stats = Summarizer.metrics("min", "max", "mean", "variance").summary(F.col("_x"))
    st = x.groupBy(F.lit(1).alias("_one")).agg(stats.alias("s"), F.count(F.lit(1)).alias("n"))
    population = (F.col("n") - 1) / F.col("n")  # the summary's variance is that of a sample
    return st.select(
        vector_to_array("s.min").alias("mins"), vector_to_array("s.max").alias("maxs"),
        vector_to_array("s.mean").alias("means"),
        F.transform(vector_to_array("s.variance"), lambda v: F.sqrt(v * population)).alias("stds"),
    )


def minmax_scale(df: DataFrame, vec: str = "vec", out: str = "scaled", stats: DataFrame | None = None) -> DataFrame:
    """M1: (x - min) / (max - min) per dimension; a constant dimension maps to 0.

    ``stats`` lets a fitted scaler be re-applied to new rows (values may leave [0, 1])."""
    st = dim_stats(df, vec) if stats is None else stats
    x = with_scalars(df, st.select("mins", "maxs"))
    rng = F.zip_with("maxs", "mins", lambda a, b: F.when(a - b == 0, F.lit(1.0)).otherwise(a - b))
    shifted = F.zip_with(F.col(vec), F.col("mins"), lambda a, b: a - b)
    return x.withColumn(out, F.zip_with(shifted, rng, lambda a, r: a / r)).drop("mins", "maxs")


def standard_scale(df: DataFrame, vec: str = "vec", out: str = "scaled", stats: DataFrame | None = None) -> DataFrame:
    """M2: (x - mean) / std_pop per dimension; std 0 -> divide by 1 (scikit-learn rule)."""
    st = dim_stats(df, vec) if stats is None else stats
    x = with_scalars(df, st.select("means", "stds"))
    sd = F.transform("stds", lambda s: F.when(s == 0, F.lit(1.0)).otherwise(s))
    centred = F.zip_with(F.col(vec), F.col("means"), lambda a, b: a - b)
    return x.withColumn(out, F.zip_with(centred, sd, lambda a, s: a / s)).drop("means", "stds")


def constant_dims(df: DataFrame, vec: str = "vec", tol: float = 1e-4) -> DataFrame:
    """Dimensions whose population std is below ``tol``."""
    long = df.select(F.posexplode(vec).alias("pos", "x"))
    return long.groupBy("pos").agg(F.stddev_pop("x").alias("std")).where(F.col("std") < tol)


def round_vec(c, digits: int = 6):
    return F.transform(c if not isinstance(c, str) else F.col(c), lambda x: F.round(x, digits))


def concat_vectors(a: DataFrame, b: DataFrame, key: str = "id", out: str = "vec") -> DataFrame:
    """Entity-wise concatenation of two vector sets (inner join on id)."""
    return a.select(key, F.col("vec").alias("_a")).join(b.select(key, F.col("vec").alias("_b")), key).select(
        key, F.concat("_a", "_b").alias(out))
