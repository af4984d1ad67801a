"""Column functions (all JVM-side built-ins; no Python UDFs)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rank weights run linearly from 20 (best) down to 1.
WEIGHT_TOP = 20.0
WEIGHT_BOTTOM = 1.0

# Similarity level thresholds (exactly 1.0, > 0.99, > 0.95, > 0.90, else).
SIMILARITY_LEVELS = (
    (1.0, "identical"),
    (0.99, "near identical"),
    (0.95, "close"),
    (0.90, "medium"),
)
SIMILARITY_LEVEL_ELSE = "weak"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def genre_tokens(genres: str | Column) -> Column:
    """Null-tolerant split of 'A|B|C' (P15/F1): null -> empty array."""
    return F.coalesce(F.split(col(genres), "[|]"), F.array().cast("array<string>"))


def genre_match_count(genres: str | Column, wanted: Iterable[str]) -> Column:
    """Number of wanted genres that occur as a substring of lower(genres)."""
    low = F.lower(F.coalesce(col(genres), F.lit("")))
    terms = F.array(*[F.lower(F.lit(g)) for g in wanted])
    return F.size(F.filter(terms, lambda t: F.contains(low, t)))


def weighted_rating(v: str | Column, r: str | Column, m: str | Column, c: str | Column) -> Column:
    """v/(v+m)*R + m/(v+m)*C."""
    v, r, m, c = col(v), col(r), col(m), col(c)
    return (v / (v + m)) * r + (m / (v + m)) * c


def shrunk_rating(v: str | Column, r: str | Column, m: str | Column) -> Column:
    """v/(v+m)*R (no prior term)."""
    v, r, m = col(v), col(r), col(m)
    return (v / (v + m)) * r


def rank_weight(rn: str | Column, n: str | Column) -> Column:
    """linspace(20, 1, n) at 1-based position rn, rounded half-even; n == 1 -> 20."""
    rn, n = col(rn), col(n)
    step = F.lit(WEIGHT_BOTTOM - WEIGHT_TOP) / (n - 1).cast("double")
    return F.when(n <= 1, F.lit(WEIGHT_TOP)).otherwise(F.rint((rn - 1).cast("double") * step + F.lit(WEIGHT_TOP)))


def dot(a: str | Column, b: str | Column) -> Column:
    """Dot product, summed left to right. (An unrolled sum of element products was measured
    3x slower: the generated method grows past the JIT size limit.)"""
    return F.aggregate(F.zip_with(col(a), col(b), lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def norm(a: str | Column) -> Column:
    return F.sqrt(F.aggregate(col(a), F.lit(0.0), lambda acc, x: acc + x * x))


def cosine(a: str | Column, b: str | Column, norm_a: Column | None = None, norm_b: Column | None = None) -> Column:
    """cosine similarity, 0 when either norm is 0 (scikit-learn rule)."""
    na = norm(a) if norm_a is None else norm_a
    nb = norm(b) if norm_b is None else norm_b
    return F.when((na == 0) | (nb == 0), F.lit(0.0)).otherwise(dot(a, b) / (na * nb))


def similarity_level(s: str | Column) -> Column:
    """label a similarity value."""
    s = col(s)
    (one, l1), (t2, l2), (t3, l3), (t4, l4) = SIMILARITY_LEVELS
    return (
        F.when(s == one, l1)
        .when(s > t2, l2)
        .when(s > t3, l3)
        .when(s > t4, l4)
        .otherwise(SIMILARITY_LEVEL_ELSE)
    )


def parse_id_list(text: str | Column) -> Column:
    """S14: '1, 23, x, 45' -> array<bigint> of the all-digit items."""
    parts = F.transform(F.split(col(text), ","), lambda x: F.trim(x))
    digits = F.filter(parts, lambda x: x.rlike("^[0-9]+$"))
    return F.transform(digits, lambda x: x.cast("bigint"))


def ratings_map(ids: str | Column, ratings: str | Column) -> Column:
    """Zip ids and ratings to a map; length mismatch raises; a repeated id keeps its
    last value (dict semantics) instead of tripping the duplicate-map-key error."""
    ids, ratings = col(ids), col(ratings)
    pairs = F.arrays_zip(ids.alias("k"), ratings.cast("array<double>").alias("v"))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(ids, i + 2, F.size(ids)), lambda y: y == p["k"]))
    return F.when(F.size(ids) == F.size(ratings), F.map_from_entries(last)).otherwise(
        F.raise_error(F.lit("ids and ratings differ in length")).cast("map<bigint,double>")
    )


def multi_hot(tokens: str | Column, classes: Iterable[str] | Column) -> Column:
    """0/1 vector over sorted classes; unknown tokens ignored."""
    cls = classes if isinstance(classes, Column) else F.array(*[F.lit(c) for c in classes])
    t = col(tokens)
    return F.transform(cls, lambda c: F.array_contains(t, c).cast("double"))


def hash_bucket(key: str | Column, buckets: int = 10) -> Column:
    """M4: deterministic bucket from md5 of the key text; equals DuckDB's
    ('0x' || substr(md5(key), 1, 8))::BIGINT % buckets."""
    h = F.conv(F.substring(F.md5(col(key).cast("string")), 1, 8), 16, 10).cast("bigint")
    return (h % F.lit(buckets)).cast("int")


def is_subset(a: str | Column, b: str | Column) -> Column:
    """every element of a is in b."""
    return F.size(F.array_except(col(a), col(b))) == 0
