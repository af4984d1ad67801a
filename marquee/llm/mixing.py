"""Temperature mixing of sources into budgeted block permutations (operator 5).

A source with the share p of all tokens gets the weight p ** a, normalised. The exponent a is the
smallest in [0, 1] (the flattest mixture) at which no source is repeated more than ``max_repeats`` times as often as the
least repeated one, and the entropy of the weights stays within ``entropy`` of its maximum. It is
found by sections of the interval, each one aggregate over the table of shares.

The budget is the smallest at which no source is cut: the least repeated one passes exactly once,
so every document is in the mixture. A source's stream is its documents in the order of a hash that
changes with each pass (a source without tokens is dealt evenly by it): full passes, then a last pass up to the hash where the budget is reached.
Streams are dealt over blocks in proportion, so every block holds the target weights; inside a
block documents lie in hash order.

Only built-in functions are used. Prefix sums run over (source, pass, bucket of the hash), then
over the rows of the one bucket of each source in which its budget ends; no window holds a source.

Defined cases: a null source is the source ''. Null and blank texts have no tokens; they are in the
passes like other documents, and a source without tokens passes once. Rows with equal ids share
their hash and so their passes. An empty table gives no rows. Other columns are not read by ``mix``
and are carried untouched by ``mixed_documents``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import written
from marquee.operators.relational import running_total

SECTIONS, ROUNDS = 32, 5


def _source() -> Column:
    return F.coalesce("source", F.lit("")).alias("source")


def _tokens() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("n_tokens")


def _hash(epoch: Column, seed: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), epoch.cast("string"), F.col("doc_id").cast("string")))


def _exponent(shares: DataFrame, max_repeats: float, entropy: float) -> float:
    """The smallest exponent that meets both limits; 1 where even the natural shares don't."""
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        grid = [low + i * (high - low) / SECTIONS for i in range(SECTIONS + 1)]
        each = shares.select("tokens", "share", "sources", F.posexplode(F.array(*map(F.lit, grid))).alias("i", "a"))
        power = F.pow("share", "a")
        sums = each.groupBy("i", "a", "sources").agg(F.sum(power).alias("z"), F.sum(power * F.log("share")).alias("q"), (F.max(power / F.col("tokens")) / F.min(power / F.col("tokens"))).alias("repeats"))
        spread = F.log("z") - F.col("a") * F.col("q") / F.col("z")
        good = sums.where((F.col("repeats") <= max_repeats) & (spread <= entropy * F.log("sources") + 1e-12)).agg(F.min("i")).first()[0]
        if good is None:
            return 1.0
        low, high = grid[max(good - 1, 0)], grid[good]
    return high


class Plan:
    """What is known of the mixture before rows are dealt: limits a source, and blocks a bucket."""

    def __init__(self, rows: DataFrame, max_repeats: float, entropy: float, block_tokens: int, seed: str):
        """``rows``: doc_id, source, n_tokens; read several times, so pass a written table."""
        self.seed = seed
        totals = written(rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens")), "mix-totals")
        used = totals.where("tokens > 0")
        whole = used.agg(F.sum("tokens").alias("all"), F.count("*").cast("double").alias("sources"))
        shares = written(used.join(F.broadcast(whole)).select("source", "tokens", "sources", (F.col("tokens") / F.col("all")).alias("share")), "mix-shares")
        a = self.exponent = _exponent(shares, max_repeats, entropy)

        powers = shares.withColumn("power", F.pow("share", F.lit(a)))
        sums = powers.agg(F.sum("power").alias("z"), F.min(F.col("power") / F.col("tokens")).alias("least"))
        budget = F.floor(F.col("tokens") * (F.col("power") / F.col("tokens") / F.col("least")) + 1e-6).cast("long")
        budgets = powers.join(F.broadcast(sums)).select("source", (F.col("power") / F.col("z")).alias("weight"), F.greatest("tokens", budget).alias("budget"))
        budgets = totals.join(budgets, "source", "left").select(
            "source",
            "tokens",
            F.coalesce("weight", F.lit(0.0)).alias("weight"),
            F.coalesce("budget", F.lit(0)).alias("budget"),
            F.coalesce(F.expr("budget div tokens"), F.lit(1)).alias("passes"),
            F.coalesce(F.expr("budget % tokens"), F.lit(0)).alias("rest"),
        )
        budgets = written(budgets, "mix-budgets")
        self.total = budgets.agg(F.sum("budget")).first()[0] or 0
        self.blocks = max(1, math.ceil(self.total / block_tokens))
        self.digits = 2
        while 16**self.digits < 4 * self.blocks:
            self.digits += 1
        self.limits = written(self._limits(rows, budgets), "mix-limits")
        dealt = self.passes(rows).groupBy("source", "epoch", "bucket", "tokens", "budget").agg(F.sum("n_tokens").alias("n"))
        dealt = running_total(dealt, [F.col("bucket").asc()], "n", "upto", ["source", "epoch"])
        at = F.col("epoch") * F.col("tokens") + F.col("upto") - F.col("n")
        block = F.least(F.lit(self.blocks - 1), F.floor(at.cast("double") * self.blocks / F.col("budget")))
        evenly = F.floor(F.conv("bucket", 16, 10).cast("long") * self.blocks / 16**self.digits)  # no tokens: by hash
        self.buckets = written(dealt.select("source", "epoch", "bucket", F.when(F.col("budget") > 0, block).otherwise(evenly).cast("long").alias("block")), "mix-blocks")

    def _limits(self, rows: DataFrame, budgets: DataFrame) -> DataFrame:
        """The budgets with ``last``: the largest hash that the last, partial pass takes; null if there is none."""
        partial = budgets.where("rest > 0").select("source", "passes", "rest")
        hashed = rows.join(partial, "source").withColumn("hash", _hash(F.col("passes"), self.seed))
        hashed = hashed.withColumn("bucket", F.substring("hash", 1, self.digits))
        buckets = hashed.groupBy("source", "bucket", "rest").agg(F.sum("n_tokens").alias("n"))
        buckets = running_total(buckets, [F.col("bucket").asc()], "n", "upto", ["source"]).withColumn("before", F.col("upto") - F.col("n"))
        final = buckets.where("before < rest").groupBy("source").agg(F.max_by(F.struct("bucket", "before"), "bucket").alias("b"))
        final = written(final.select("source", "b.*"), "mix-last-buckets")
        inside = hashed.join(final, ["source", "bucket"]).groupBy("source", "hash", "before", "rest").agg(F.sum("n_tokens").alias("n"))
        inside = inside.withColumn("at", F.col("before") + F.sum("n").over(Window.partitionBy("source").orderBy("hash")) - F.col("n"))
        last = inside.where("at < rest").groupBy("source").agg(F.max("hash").alias("last"))
        return budgets.join(last, "source", "left")

    def passes(self, rows: DataFrame) -> DataFrame:
        """Every row of ``rows`` (doc_id and source among others) once for each pass that takes it."""
        rows = rows.join(self.limits, "source")
        more = F.when(_hash(F.col("passes"), self.seed) <= F.col("last"), F.col("passes")).otherwise(F.col("passes") - 1)
        rows = rows.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), more)))
        rows = rows.withColumn("hash", _hash(F.col("epoch"), self.seed))
        return rows.withColumn("bucket", F.substring("hash", 1, self.digits))

    def dealt(self, rows: DataFrame) -> DataFrame:
        return self.passes(rows).join(self.buckets, ["source", "epoch", "bucket"])


def _counted(docs: DataFrame) -> DataFrame:
    return written(docs.select("doc_id", _source(), _tokens()), "mix-tokens")


def mix(docs: DataFrame, max_repeats: float = 2.0, entropy: float = 0.999, block_tokens: int = 4_000_000, seed: str = "mix") -> DataFrame:
    """doc_id, source, epoch, n_tokens, weight (of the source), block and slot (order in the block)."""
    rows = _counted(docs)
    dealt = Plan(rows, max_repeats, entropy, block_tokens, seed).dealt(rows)
    slot = F.row_number().over(Window.partitionBy("block").orderBy("hash", "source", "epoch", "n_tokens")) - 1
    return dealt.select("doc_id", "source", "epoch", "n_tokens", F.round("weight", 9).alias("weight"), "block", slot.cast("long").alias("slot"))


def mixed_documents(docs: DataFrame, max_repeats: float = 2.0, entropy: float = 0.999, block_tokens: int = 4_000_000, seed: str = "mix") -> DataFrame:
    """The rows of ``docs``, once a pass, in the order of the mixture."""
    plan = Plan(_counted(docs), max_repeats, entropy, block_tokens, seed)
    dealt = plan.dealt(docs.select("doc_id", _source(), F.struct("*").alias("document")))
    ordered = dealt.select("document", "block", "hash").repartitionByRange("block", "hash").sortWithinPartitions("block", "hash")
    return ordered.select("document.*")
