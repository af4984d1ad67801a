"""Similarity queries over keyed vector sets.

Every scoring runs on one plan: a grid of (request block x candidate block) cells inside each
cluster (one cluster for scans without clusters). Requests are hashed by request_id, so a cell
holds all of a request's rows for its cluster and can cut its list to what the request needs;
candidates are hashed by id. A hot cluster becomes many cells of bounded size, a cell is one BLAS
matmul, and only the cut lists are shuffled again.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.columns import cosine, genre_tokens, norm, rank_weight, similarity_level
from marquee.operators import als
from marquee.operators.relational import top_k_per_group
from marquee.session import cut_lineage

SCORE_DIGITS = 6
# Seeds / candidates per block of the grid (a cell holds at most BLOCK_ROWS x BLOCK_ROWS similarities, ~8 MB).
BLOCK_ROWS = 1024
# The same for buckets of hashes, whose cells are scored in chunks of rows; a cell can pass on all its pairs.
LSH_ROWS, _LSH_CHUNK = 4096, 512
# Seeds whose similarities are summed at a time (a request can have more than a block).
_SUM_CHUNK = 256
# Candidate blocks of sums are so many times as long: a seed is copied once a block, and a block passes on a list a request.
_WIDE = 4
# Lists are cut on unrounded scores in a cell and ranked on rounded ones: scores this close to the cut stay.
_NEAR = 2 * 10.0 ** -SCORE_DIGITS


def _vectors_with_norm(vectors: DataFrame) -> DataFrame:
    return vectors.select("id", "vec", "cluster", norm("vec").alias("nrm"))


def catalogue(movies: DataFrame) -> DataFrame:
    """Movies usable as results: title and genres present (P14), tokens split once (P15). Joins with them merge: by the
    size of its files, a tenth of that of the rows, Spark would broadcast the table through the driver."""
    return movies.where(F.col("title").isNotNull() & F.col("genres").isNotNull()).select(
        "movieId", "title", "genres", genre_tokens("genres").alias("tokens"))


def seed_rows(requests: DataFrame, vectors: DataFrame, movies: DataFrame) -> DataFrame:
    """Requests resolved to seed vectors; unknown seeds (no movie or no vector) drop out (see P17)."""
    v = _vectors_with_norm(vectors)
    m = movies.select("movieId", genre_tokens("genres").alias("s_tokens")).hint("merge")
    return requests.select("request_id", "movieId").join(m, "movieId").join(
        v.withColumnRenamed("id", "movieId"), "movieId").select(
        "request_id", F.col("movieId").alias("seed_id"), F.col("vec").alias("s_vec"),
        F.col("nrm").alias("s_nrm"), "cluster", "s_tokens")


def cluster_candidates(vectors: DataFrame, movies: DataFrame) -> DataFrame:
    v = _vectors_with_norm(vectors)
    return v.join(catalogue(movies).hint("merge"), v.id == F.col("movieId")).select(
        F.col("id").alias("movie_id"), F.col("vec").alias("c_vec"), F.col("nrm").alias("c_nrm"),
        "cluster", "title", "genres", F.col("tokens").alias("c_tokens"))


def same_cluster_pairs(requests: DataFrame, vectors: DataFrame, movies: DataFrame) -> DataFrame:
    """J10 + F11 + F6: (request, seed, candidate) pairs inside the seed's cluster, seed excluded, with
    cosine similarity, plain and gated (0 where the two share no genre). All pairs are the result:
    an equi-join on the cluster, split by AQE where a cluster is hot."""
    pairs = seed_rows(requests, vectors, movies).join(cluster_candidates(vectors, movies), "cluster").where(
        F.col("seed_id") != F.col("movie_id"))
    sim = cosine("s_vec", "c_vec", F.col("s_nrm"), F.col("c_nrm"))
    x = pairs.select("request_id", "seed_id", "movie_id", "title", "genres", "cluster",
                     F.arrays_overlap("s_tokens", "c_tokens").alias("_shared"), sim.alias("similarity"))
    return x.withColumn("gated", F.when(F.col("_shared"), F.col("similarity")).otherwise(F.lit(0.0))).drop("_shared")


def rank_and_weight(scored: DataFrame, score: str, top_n: int, key: str = "movie_id") -> DataFrame:
    """T1 per request + W3 weights, ties on id ascending."""
    top = top_k_per_group(scored, ["request_id"], [F.col(score).desc(), F.col(key).asc()], top_n)
    n = F.count(F.lit(1)).over(Window.partitionBy("request_id"))
    return top.withColumn("_n", n).withColumn("weight", rank_weight("rank", "_n")).drop("_n")


def cells(requests: DataFrame, candidates: DataFrame, candidate_id: str, block: int | None = None, wide: int = 1):
    """Both sides dealt over the grid: each request row once per candidate block of its cluster (``wide`` times as long),
    each candidate once per request block. Returns the two grouped frames for a cogrouped kernel."""
    block = BLOCK_ROWS if block is None else block
    ns = requests.groupBy("cluster").agg(F.count(F.lit(1)).alias("_ns"))
    nc = candidates.groupBy("cluster").agg(F.count(F.lit(1)).alias("_nc"))
    grid = ns.join(nc, "cluster").select(
        "cluster", F.ceil(F.col("_ns") / block).cast("int").alias("_sb"), F.ceil(F.col("_nc") / (block * wide)).cast("int").alias("_cb"))
    key = ["cluster", "s_block", "c_block"]
    s = requests.join(grid, "cluster").withColumns({
        "cluster": F.col("cluster").alias("cluster"),  # a column of its own on either side
        "s_block": F.pmod(F.xxhash64("request_id"), F.col("_sb")).cast("int"),
        "c_block": F.explode(F.sequence(F.lit(0), F.col("_cb") - 1))}).drop("_sb", "_cb")
    c = candidates.join(grid, "cluster").withColumns({
        "cluster": F.col("cluster").alias("cluster"),
        "c_block": F.pmod(F.xxhash64(candidate_id), F.col("_cb")).cast("int"),
        "s_block": F.explode(F.sequence(F.lit(0), F.col("_sb") - 1))}).drop("_sb", "_cb")
    return s.groupBy(*key), c.groupBy(*key)


def cosine_matrix(s_vec, s_nrm, c_vec, c_nrm) -> np.ndarray:
    """Cosines of all rows of one side with all of the other; 0 where a norm is 0."""
    den = np.outer(s_nrm.to_numpy(), c_nrm.to_numpy())
    dots = np.stack(s_vec.to_numpy()) @ np.stack(c_vec.to_numpy()).T
    return np.where(den == 0, 0.0, dots / np.where(den == 0, 1.0, den))


def _unit_rows(vectors, norms) -> np.ndarray:
    """Vectors over their norms, zeros where a norm is 0: products of such rows are cosines."""
    norms = norms.to_numpy()[:, None]
    return np.where(norms == 0, 0.0, np.stack(vectors.to_numpy()) / np.where(norms == 0, 1.0, norms))


def best(scores: np.ndarray, usable: np.ndarray, n: int) -> np.ndarray:
    """Per row, whether a usable column is among the n largest or within rounding of them."""
    x = np.where(usable, scores, -np.inf)
    if n >= x.shape[1]:
        return usable
    cut = -np.partition(-x, n - 1, axis=1)[:, n - 1]
    return usable & (x >= cut[:, None] - _NEAR)


def _sum_kernel(gate: bool, own: bool, top_n: int):
    """Cosine sums over each request's seeds in a cell (gated by shared tokens, self pairs masked), cut to
    the request's ``top_n``; with ``own`` the request's seeds are no candidates. Seeds lie in order of their
    requests, so each similarity is added once."""

    def tokens_matrix(lists, vocab):
        out = np.zeros((len(lists), len(vocab)), np.float32)
        for i, ts in enumerate(lists):
            out[i, [vocab[t] for t in ts]] = 1.0
        return out

    def run(_key, sp: pd.DataFrame, cp: pd.DataFrame) -> pd.DataFrame:
        if sp.empty or cp.empty:
            return pd.DataFrame({"request_id": pd.Series([], dtype="int64"),
                                 "movie_id": pd.Series([], dtype="int64"), "sim_sum": pd.Series([], dtype="float64")})
        codes, reqs = pd.factorize(sp["request_id"])
        order = np.argsort(codes, kind="stable")
        codes, sp = codes[order], sp.iloc[order]
        if gate:
            vocab = {t: i for i, t in enumerate({t for ts in [*sp["s_tokens"], *cp["c_tokens"]] for t in ts})}
            s_tokens, c_tokens = tokens_matrix(sp["s_tokens"], vocab), tokens_matrix(cp["c_tokens"], vocab).T
        # where a seed is itself the candidate
        at = pd.DataFrame({"id": sp["seed_id"].to_numpy(), "r": np.arange(len(sp))}).merge(
            pd.DataFrame({"id": cp["movie_id"].to_numpy(), "c": np.arange(len(cp))}), on="id").sort_values("r")
        r, c = at["r"].to_numpy(), at["c"].to_numpy()
        s_unit, c_unit = _unit_rows(sp["s_vec"], sp["s_nrm"]), _unit_rows(cp["c_vec"], cp["c_nrm"]).T
        ends = np.searchsorted(codes, np.arange(len(reqs)), side="right")
        found, done, wide = [], 0, len(cp)
        while done < len(reqs):  # whole requests, about _SUM_CHUNK seeds at a time
            low = ends[done - 1] if done else 0
            last = max(done + 1, int(np.searchsorted(ends, low + _SUM_CHUNK, side="right")))
            sums = np.zeros((last - done, wide))
            for at in range(low, ends[last - 1], _SUM_CHUNK):
                part = slice(at, min(at + _SUM_CHUNK, ends[last - 1]))
                sims = s_unit[part] @ c_unit
                if gate:
                    sims *= s_tokens[part] @ c_tokens > 0
                here = slice(*np.searchsorted(r, [part.start, part.stop]))
                sims[r[here] - at, c[here]] = 0.0
                own_codes, first = np.unique(codes[part] - done, return_index=True)
                sums[own_codes] += np.add.reduceat(sims, first, axis=0)
            usable = np.ones(sums.shape, dtype=bool)
            here = slice(*np.searchsorted(r, [low, ends[last - 1]]))
            cell, hits = np.unique((codes[r[here]] - done) * wide + c[here], return_counts=True)
            seeds = np.diff(ends[done:last], prepend=low)
            usable.flat[cell if own else cell[hits == seeds[cell // wide]]] = False
            i, j = np.nonzero(best(sums, usable, top_n))
            found.append((i + done, j, sums[i, j]))
            done = last
        i, j, sums = (np.concatenate(x) for x in zip(*found))
        return pd.DataFrame({"request_id": np.asarray(reqs)[i].astype("int64"),
                             "movie_id": cp["movie_id"].to_numpy()[j].astype("int64"), "sim_sum": sums})

    return run


def content_neighbours(requests: DataFrame, vectors: DataFrame, movies: DataFrame, *, top_n: int = 50,
                       gate: bool = True, exclude_seeds: bool = False, blocked: DataFrame | None = None) -> DataFrame:
    """Sum of similarities over a request's seeds, per candidate, then top-n with weights.

    gate: genre gate (R2-R5); exclude_seeds: drop the request's own seeds (R5, R6);
    blocked: movieIds removed before the cut (R3, R5)."""
    seeds = seed_rows(requests, vectors, movies)
    cands = cluster_candidates(vectors, movies)
    if blocked is not None:
        cands = cands.join(blocked.select(F.col("movieId").alias("movie_id")), "movie_id", "left_anti")
    s, c = cells(seeds, cands, "movie_id", wide=_WIDE)
    agg = s.cogroup(c).applyInPandas(_sum_kernel(gate, exclude_seeds, top_n),
                                     "request_id bigint, movie_id bigint, sim_sum double")
    if exclude_seeds:  # a seed without a vector in this cluster's cell can still be a candidate of another cluster
        own = requests.select("request_id", F.col("movieId").alias("movie_id"))
        agg = agg.join(own, ["request_id", "movie_id"], "left_anti")
    agg = agg.select("request_id", "movie_id", F.round("sim_sum", SCORE_DIGITS).alias("similarity_score"))
    out = rank_and_weight(agg, "similarity_score", top_n)
    names = catalogue(movies).select(F.col("movieId").alias("movie_id"), "title", "genres")
    return out.join(names.hint("merge"), "movie_id").select(
        "request_id", "movie_id", "title", "genres", "similarity_score", "weight", "rank")


def seed_info(requests: DataFrame, movies: DataFrame) -> DataFrame:
    """R2 side output: the requested seeds with title and genre set."""
    return requests.join(movies, "movieId").select(
        "request_id", F.col("movieId").alias("movie_id"), "title",
        F.array_sort(F.array_distinct(genre_tokens("genres"))).alias("genre_set"))


def _knn_kernel(k: int, exclude_self: bool):
    def run(_key, sp: pd.DataFrame, cp: pd.DataFrame) -> pd.DataFrame:
        if sp.empty or cp.empty:
            r = c = np.zeros(0, dtype=int)
            sims = np.zeros((0, 0))
        else:
            sims = cosine_matrix(sp["q_vec"], sp["q_nrm"], cp["c_vec"], cp["c_nrm"])
            usable = np.ones(sims.shape, dtype=bool)
            if exclude_self:
                usable = sp["query_id"].to_numpy()[:, None] != cp["candidate_id"].to_numpy()[None, :]
            r, c = np.nonzero(best(sims, usable, k))
        return pd.DataFrame({"request_id": sp["request_id"].to_numpy()[r], "query_id": sp["query_id"].to_numpy()[r],
                             "candidate_id": cp["candidate_id"].to_numpy()[c], "similarity": sims[r, c]})

    return run


def _query_rows(requests: DataFrame, vectors: DataFrame, *keep: str) -> DataFrame:
    return requests.select("request_id", "id").join(
        vectors.select("id", F.col("vec").alias("q_vec"), norm("vec").alias("q_nrm"), *keep), "id").withColumnRenamed(
        "id", "query_id")


def _candidate_rows(vectors: DataFrame, *keep: str) -> DataFrame:
    return vectors.select(F.col("id").alias("candidate_id"), F.col("vec").alias("c_vec"), norm("vec").alias("c_nrm"), *keep)


def found_in_cells(queries: DataFrame, candidates: DataFrame, k: int, exclude_self: bool) -> DataFrame:
    """The k best candidates of each request in each block of its clusters (and those within rounding of them)."""
    q, c = cells(queries, candidates, "candidate_id")
    return q.cogroup(c).applyInPandas(
        _knn_kernel(k, exclude_self), "request_id bigint, query_id bigint, candidate_id bigint, similarity double")


def _nearest(queries: DataFrame, candidates: DataFrame, k: int, exclude_self: bool) -> DataFrame:
    scored = found_in_cells(queries, candidates, k, exclude_self).withColumn("similarity", F.round("similarity", SCORE_DIGITS))
    return top_k_per_group(scored, ["request_id"], [F.col("similarity").desc(), F.col("candidate_id").asc()], k)


def knn_scan(requests: DataFrame, req_vectors: DataFrame, candidates: DataFrame, k: int,
             exclude_self: bool = True) -> DataFrame:
    """J12 + T1: exact k nearest candidates by cosine for each request, on the grid (one cluster).

    Work is requests x candidates, as an exact scan must be; each cell passes on k rows a request."""
    one = F.lit(0).alias("cluster")
    return _nearest(_query_rows(requests, req_vectors).select("*", one), _candidate_rows(candidates).select("*", one),
                    k, exclude_self)


def cosine_pairs(requests: DataFrame, req_vectors: DataFrame, candidates: DataFrame) -> DataFrame:
    """Each request with every candidate but itself. All pairs are the result, so nothing is ranked."""
    pairs = _query_rows(requests, req_vectors).join(_candidate_rows(candidates), F.col("query_id") != F.col("candidate_id"))
    return pairs.select("request_id", "query_id", "candidate_id",
                        F.round(cosine("q_vec", "c_vec", F.col("q_nrm"), F.col("c_nrm")), SCORE_DIGITS).alias("similarity"))


def similar_users(requests: DataFrame, train: DataFrame, test: DataFrame, k: int = 10, search=knn_scan) -> DataFrame:
    """Most similar test users for each train user, with level label (F13). ``search`` is ``knn_scan`` or
    ``pivots.knn_pivots``, which fits batches of many requests."""
    top = search(requests, train, test, k, exclude_self=False)
    return top.select("request_id", F.col("query_id").alias("train_user_id"),
                      F.col("candidate_id").alias("test_user_id"), "similarity",
                      similarity_level("similarity").alias("similarity_level"), "rank")


def nearest_in_cluster(requests: DataFrame, train: DataFrame, test: DataFrame) -> DataFrame:
    """Nearest test item inside the train item's cluster (W5); requests without
    any cluster mate are reported with a null neighbour instead of raising."""
    q = _query_rows(requests, train, "cluster")
    near = _nearest(q, _candidate_rows(test, "cluster"), 1, True)
    return q.select("request_id", "query_id").join(near.drop("rank"), ["request_id", "query_id"], "left")


def _bucket_kernel(max_dist: float, queries: als.Factors, candidates: als.Factors, tables: int):
    """Pairs of a bucket that share none of the tables before, and lie closer than ``max_dist``. The files have the vectors
    and their ``tables`` hashes."""
    sides = als._Lookup(queries), als._Lookup(candidates)

    def run(_key, sp: pd.DataFrame, cp: pd.DataFrame) -> pd.DataFrame:
        rows, columns, found = [np.zeros(0, int)], [np.zeros(0, int)], [np.zeros(0)]
        if len(sp) and len(cp):
            table = int(sp["t"].iloc[0])
            (q, hq), (c, hc) = (np.split(side.take(x["row"].to_numpy()), [-tables], axis=1) for side, x in zip(sides, (sp, cp)))
            qq, cc, own = (q * q).sum(axis=1), (c * c).sum(axis=1), cp["candidate_id"].to_numpy()
            for at in range(0, len(q), _LSH_CHUNK):
                part = slice(at, at + _LSH_CHUNK)
                sq = np.maximum(qq[part, None] + cc - 2 * (q[part] @ c.T), 0.0)
                good = (np.sqrt(sq) < max_dist) & (sp["request_id"].to_numpy()[part, None] != own)
                for before in range(table):
                    good &= hq[part, before, None] != hc[:, before]
                r, k = np.nonzero(good)
                rows.append(at + r)
                columns.append(k)
                found.append(1 - sq[r, k] / 2)
        r, k = np.concatenate(rows), np.concatenate(columns)
        return pd.DataFrame({"query_id": sp["request_id"].to_numpy()[r], "candidate_id": cp["candidate_id"].to_numpy()[k], "similarity": np.concatenate(found)})

    return run


def knn_lsh(vectors: DataFrame, queries: DataFrame, threshold: float, bucket_length: float = 0.5,
            num_tables: int = 4, seed: int = 42) -> DataFrame:
    """M11 at scale: approximate cosine neighbours by random projections on unit vectors
    (BucketedRandomProjectionLSH; Euclidean distance d on unit vectors = sqrt(2 - 2 cos)).

    The pairs are those of ``approxSimilarityJoin``, which shuffles both vectors of every pair that shares a bucket.
    Here buckets are joined on the grid: rows go once to each block they meet, as ids, and cells take the vectors and
    hashes from files by position. A pair is scored in the first table in which it shares a bucket, and only pairs
    within the distance leave a cell, as ids."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector, vector_to_array

    def unit(df):
        n = norm("vec")
        return df.select("id", array_to_vector(F.when(n == 0, F.col("vec")).otherwise(
            F.transform("vec", lambda x: x / n))).alias("features"))

    lsh = BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes", bucketLength=bucket_length,
                                      numHashTables=num_tables, seed=seed)
    items = unit(vectors)
    model = lsh.fit(items)
    max_dist = float((2.0 - 2.0 * threshold) ** 0.5)

    def hashed(df):
        x = model.transform(unit(df)).select("id", vector_to_array("features").alias("vec"),
                                             F.transform("hashes", lambda h: vector_to_array(h)[0]).alias("h"))
        x = cut_lineage(x.distinct()).withColumn("row", F.monotonically_increasing_id())
        stored = x.select(F.col("row").alias("id"), F.concat("vec", "h").alias("vec"))
        return x, als.positions(stored, df.sparkSession.sparkContext.defaultParallelism)

    q = hashed(queries)
    c = q if queries is vectors else hashed(vectors)

    def posted(df, name):
        """A row for each hash table; the bucket is the cluster of the grid."""
        own = [F.col(x).alias(y) for x, y in (("id", name), ("row", "row"))]  # columns of its own on either side
        return df.select(*own, F.posexplode("h").alias("t", "_v")).withColumn("cluster", F.concat_ws(":", "t", "_v")).drop("_v")

    s, b = cells(posted(q[0], "request_id"), posted(c[0], "candidate_id"), "candidate_id", LSH_ROWS)
    kernel = _bucket_kernel(max_dist, q[1], c[1], num_tables)
    found = s.cogroup(b).applyInPandas(kernel, "query_id bigint, candidate_id bigint, similarity double")
    return found.withColumn("similarity", F.round("similarity", SCORE_DIGITS))
