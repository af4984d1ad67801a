"""Relational operators: aggregates, joins, ranking, set operations.

Every operator takes and returns DataFrames; 1-row statistics are attached with a
broadcast join of the single row, never fetched to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.columns import genre_tokens
from marquee.session import cut_lineage

# ---------------------------------------------------------------- aggregates


def popularity(ratings: DataFrame, item: str = "movieId", mean_name: str = "ave_rating",
               count_name: str = "rating_count") -> DataFrame:
    """A1: mean rating and vote count per item (partial aggregation before the shuffle)."""
    return ratings.groupBy(item).agg(
        F.avg("rating").alias(mean_name), F.count("rating").alias(count_name)
    )


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a 1-row frame to every row (broadcast, no pair blow-up)."""
    return df.crossJoin(F.broadcast(one_row))


def scalar_mean(df: DataFrame, c: str, name: str) -> DataFrame:
    """A2: global mean as a 1-row frame."""
    return df.agg(F.avg(c).alias(name))


def scalar_quantile(df: DataFrame, c: str, p: float, name: str) -> DataFrame:
    """A3: exact quantile with linear interpolation (pandas default) as a 1-row frame.

    Order statistics over a range-partitioned table of distinct values and their counts, so a
    continuous column is never held by one task. Nulls are left out."""
    values = df.select(F.col(c).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    upto = running_total(values.groupBy("_v").agg(F.count(F.lit(1)).alias("_n")), [F.col("_v").asc()], "_n", "_upto")
    ranked = upto.crossJoin(F.broadcast(upto.agg(F.max("_upto").alias("_all"))))
    pos = (F.col("_all") - 1) * F.lit(float(p))
    at = ranked.agg(F.min(F.when(F.col("_upto") > F.floor(pos), F.col("_v"))).alias("_lo"),
                    F.min(F.when(F.col("_upto") > F.ceil(pos), F.col("_v"))).alias("_hi"),
                    F.max(pos - F.floor(pos)).alias("_f"))
    return at.select((F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_f")).alias(name))


def group_quantile(df: DataFrame, keys: Sequence[str], c: str, p: float, name: str) -> DataFrame:
    """A3 per group: the exact quantile (linear interpolation) of every ``keys`` group as (*keys, name).

    Distinct values of a group are counted, range-partitioned on (keys, value) and totalled over the ranges, so no task
    holds a group, however large; a group leaves two order statistics. Null values and rows with a null key are left out."""
    values = df.select(*keys, F.col(c).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    counts = values.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))
    upto = running_total(counts, [F.col("_v").asc()], "_n", "_upto", keys, total="_all")
    pos = (F.col("_all") - 1) * F.lit(float(p))
    at = upto.groupBy(*keys).agg(F.min(F.when(F.col("_upto") > F.floor(pos), F.col("_v"))).alias("_lo"),
                                 F.min(F.when(F.col("_upto") > F.ceil(pos), F.col("_v"))).alias("_hi"),
                                 F.max(pos - F.floor(pos)).alias("_f"))
    return at.select(*keys, (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_f")).alias(name))


def interaction_matrix(ratings: DataFrame, user: str = "userId", item: str = "movieId") -> DataFrame:
    """Long sparse matrix with duplicate (user, item) cells summed."""
    return ratings.groupBy(user, item).agg(F.sum("rating").alias("rating"))


def next_id(df: DataFrame, c: str, name: str = "next_id") -> DataFrame:
    """max(id) + 1 as a 1-row frame."""
    return df.agg((F.max(c) + 1).alias(name))


def assign_new_ids(new_rows: DataFrame, existing: DataFrame, c: str, order_by: str) -> DataFrame:
    """A12 (batch): new ids max+1, max+2, ... in ``order_by`` order; ids come
    from range offsets, not from a single-partition window."""
    base = next_id(existing, c, "_base")
    indexed = dense_index(new_rows, order_by, "_k", distinct=False)
    return with_scalars(indexed, base).withColumn(c, F.col("_base") + F.col("_k")).drop("_base", "_k")


def distinct_tokens(df: DataFrame, c: str = "genres", name: str = "genre") -> DataFrame:
    """Trimmed distinct genre tokens."""
    return df.select(F.explode(genre_tokens(c)).alias("_g")).select(F.trim("_g").alias(name)).distinct()


# ------------------------------------------------------------------- ranking


def top_k(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """T1 (global): TakeOrderedAndProject — each task keeps n, the driver merges."""
    return df.orderBy(*order).limit(n)


def top_k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
                    rank_col: str = "rank") -> DataFrame:
    """T1 (per request): row_number <= n, planned as WindowGroupLimit before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


def keep_last(df: DataFrame, key: str, seq: str) -> DataFrame:
    """Last written row per key (max_by over the write sequence)."""
    others = [c for c in df.columns if c not in (key, seq)]
    s = F.struct(F.col(seq), *[F.col(c) for c in others])
    return df.groupBy(key).agg(F.max(s).alias("_last")).select(key, *[F.col(f"_last.{c}").alias(c) for c in others])


def running_total(df: DataFrame, order: Sequence[Column], amount: str | None, name: str,
                  keys: Sequence[str] = (), total: str | None = None) -> DataFrame:
    """Inclusive running total of ``amount`` (None: row count) in ``order``, within each key group; with ``total``
    also the group's whole sum on every row.

    The rows are range-partitioned on (keys, order) and written once; totals per (range, key) then
    give each range its offset. No task holds more than a range, however large a key group is, and
    everything stays in the JVM. ``order`` should break ties (equal rows fall into one range)."""
    ranged = df.repartitionByRange(*[F.col(k) for k in keys], *order).sortWithinPartitions(*keys, *order)
    fixed = cut_lineage(ranged.withColumn("_at", F.monotonically_increasing_id())).withColumn(
        "_part", F.shiftright("_at", 33))
    one = F.lit(1) if amount is None else F.col(amount)
    part = fixed.groupBy(*keys, "_part").agg(F.sum(one).alias("_sum"), F.min("_at").alias("_first"))
    w = Window.partitionBy(*keys).orderBy("_part") if keys else Window.orderBy("_part")  # one row per range and key
    offset = part.select(*keys, "_part", "_first", (F.sum("_sum").over(w) - F.col("_sum")).alias("_before"),
                         *([F.sum("_sum").over(Window.partitionBy(*keys)).alias(total)] if total else []))
    joined = fixed.join(offset, [*keys, "_part"])
    if amount is None:
        inside = F.col("_at") - F.col("_first") + 1
    else:
        inside = F.sum(one).over(Window.partitionBy(*keys, "_part").orderBy("_at"))
    return joined.withColumn(name, F.col("_before") + inside).drop("_at", "_part", "_first", "_before")


def dense_index(df: DataFrame, c: str, name: str = "idx", distinct: bool = True) -> DataFrame:
    """0-based code over sorted values (LabelEncoder order: numeric, not text)."""
    base = df.select(c).distinct() if distinct else df
    return running_total(base, [F.col(c).asc()], None, name).withColumn(name, F.col(name) - 1)


def average_rank(df: DataFrame, c: str, ascending: bool, name: str) -> DataFrame:
    """1-based rank with ties sharing the mean rank (pandas default)."""
    o = F.col(c).asc() if ascending else F.col(c).desc()
    w = Window.orderBy(o)
    tie = Window.partitionBy(c)
    return df.withColumn(name, F.rank().over(w) + (F.count(F.lit(1)).over(tie) - 1) / 2.0)


# ---------------------------------------------------------------- set / join


def semi(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    return df.join(keys, on, "left_semi")


def anti(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    return df.join(keys, on, "left_anti")


#: Rows of one key on the right side of a ``split_join`` above which the key is cut into parts.
HEAVY = 100_000


def split_join(left: DataFrame, right: DataFrame, key: str, spread: str, limit: int | None = None) -> DataFrame:
    """Inner equi-join on ``key`` in which no task holds a whole heavy key: rows of ``right`` are dealt over parts of
    about ``limit`` rows by the hash of ``spread``, and rows of ``left`` are copied once a part. ``right`` is read twice,
    so pass a written table. At most one key in ``limit`` rows is heavy."""
    limit = HEAVY if limit is None else limit
    heavy = right.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)
    heavy = heavy.select(F.col(key).alias("_key"), F.ceil(F.col("_n") / limit).cast("int").alias("_parts"))
    if heavy.isEmpty():
        return left.join(right, key)
    heavy, parts = cut_lineage(heavy), F.coalesce("_parts", F.lit(1))
    copied = left.join(heavy, left[key] == heavy["_key"], "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    dealt = right.join(heavy, right[key] == heavy["_key"], "left").withColumn("_part", F.pmod(F.xxhash64(spread), parts).cast("int"))
    return copied.drop("_key", "_parts").join(dealt.drop("_key", "_parts"), [key, "_part"]).drop("_part")


def left_fill(left: DataFrame, right: DataFrame, on: str | list[str], fill: dict) -> DataFrame:
    """Left outer join then zero-fill the right-hand columns."""
    return left.join(right, on, "left").na.fill(fill)
