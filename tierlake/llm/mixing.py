"""Temperature mixing of sources: weights from exponentiated token shares, realised as block permutations of a budget.

The exponent is the largest in [0, 1] whose weights reach the target entropy, raised if need be until no source is repeated
more often than allowed. A source's quota of the budget becomes whole passes over its documents and a part of one more. In
every pass the source's blocks (documents dealt by hash, at most about ``block_tokens`` tokens and ``block_rows`` rows) are
permuted, and so are the documents of a block; the last pass takes documents in that order until the quota is met. Where the
quota ends is found from sums: of groups of blocks, of the blocks of one group, and of the documents of one block, in which
equal rows count as one with a number. So a source with a third of all rows, or a row repeated that often, is no single
task's work. Built-in functions only; the driver sees one row of sums for each exponent tried.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tierlake.sources.staging import stage

WORD = "[^\\x20\\x09-\\x0D]+"
ENTROPY_SHARE = 0.9999
MAX_REPEATS = 4.0
BLOCK_TOKENS = 1 << 20
BLOCK_ROWS = 1 << 16
STEPS = 30
_WIDE = 5  # bisection steps made in one pass over the sources


def _hash(*parts: Column | str) -> Column:
    """Text hash of parts, equal in every engine that has MD5."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(p).cast("string"), F.lit("")) if isinstance(p, str) else p for p in parts]))


def find_exponent(sources: DataFrame, budget: int, entropy_share: float, max_repeats: float) -> float:
    """Exponent for ``sources`` (``tokens``), found on a grid of 2**-30 by bisection, 31 exponents a pass.

    Entropy falls and the smallest source's repetition falls as the exponent grows. The result is the largest exponent with
    the wanted share of the highest entropy, or the smallest that keeps to ``max_repeats`` if that is larger. If no exponent
    keeps to it, 1 is returned, which repeats all sources alike.
    """
    top = sources.agg(F.max(F.ln("tokens")), F.count(F.lit(1))).first()
    if not top[1]:
        return 1.0
    target = entropy_share * math.log(top[1])
    shifted = sources.select("tokens", (F.ln("tokens") - F.lit(top[0])).alias("d"))

    def measure(points: list[int]) -> dict[int, tuple[float, float]]:
        tried = shifted.withColumn("k", F.explode(F.lit(points))).withColumn("a", F.col("k") / F.lit(float(1 << STEPS)))
        power = F.exp(F.col("a") * F.col("d"))
        sums = tried.groupBy("k", "a").agg(F.sum(power).alias("z"), F.sum(power * F.col("d")).alias("s"), F.max(power / F.col("tokens")).alias("r"))
        rows = sums.select("k", (F.ln("z") - F.col("a") * F.col("s") / F.col("z")).alias("h"), (F.col("r") / F.col("z") * F.lit(float(budget))).alias("r"))
        return {r["k"]: (r["h"], r["r"]) for r in rows.collect()}

    def first_that(good) -> int:
        """Smallest point that holds, by bisection over 0 .. 2**30, given that points above it hold as well."""
        low, high = 0, 1 << STEPS
        while low < high:
            step = max(1, (high - low) >> _WIDE)
            points = sorted({*range(low, high, step)})
            known = measure(points)
            held = [p for p in points if good(*known[p])]
            high = min(held, default=high)
            below = [p for p in points if p < high]
            low = max(below) + 1 if below else high
        return high

    flat = first_that(lambda h, r: h < target) - 1  # the largest that still reaches the entropy
    if flat >= (1 << STEPS) - 1:
        flat = 1 << STEPS
    spared = first_that(lambda h, r: r <= max_repeats)
    return max(flat, spared, 0) / float(1 << STEPS)


def _spent(order: W, tokens: str = "tokens") -> Column:
    """Tokens of the rows up to and with this one."""
    return F.sum(tokens).over(order.rowsBetween(W.unboundedPreceding, W.currentRow))


def mix_sources(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    budget: int | None = None,
    entropy_share: float = ENTROPY_SHARE,
    max_repeats: float = MAX_REPEATS,
    block_tokens: int = BLOCK_TOKENS,
    block_rows: int = BLOCK_ROWS,
    seed: str = "0",
) -> DataFrame:
    """The mixture's schedule, a row per use of a document: ``doc_id, source, epoch, block, n_tokens, mix_key, doc_key``.

    Ordered by ``mix_key`` and ``doc_key`` it is the training order. Tokens are words between white space; ``budget`` defaults
    to all tokens. In a source's last pass the document at the quota's end is used if at least half of it fits, or if the
    source would get no token otherwise, so a source misses its quota by half its longest document at most (by the document,
    if it is the only one used). A null source is a source of its own, apart from the empty one; a null text has no tokens.
    Texts without tokens come along with whole passes and, in the last one, before the quota's end. A source without tokens
    has no weight and isn't used, nor is one whose quota rounds to zero. Repeated rows are documents of their own; a null key
    is hashed as empty text, next to its text. An empty table gives no rows.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        F.regexp_count(body, F.lit(WORD)).cast("long").alias("n_tokens"),
        F.md5(body).alias("digest"),
    )
    rows = stage(rows.withColumn("group", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))), "tokens")
    sources = rows.groupBy("group").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    sources = stage(sources.filter("tokens > 0"), "sources")
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    budget = int(total) if budget is None else budget
    exponent = find_exponent(sources, budget, entropy_share, max_repeats)
    top = sources.agg(F.max(F.ln("tokens")).alias("top"))
    power = F.exp(F.lit(exponent) * (F.ln("tokens") - F.lit(top.first()[0] or 0.0)))
    sums = sources.agg(F.sum(power)).first()[0] or 1.0
    quota = F.round(F.lit(float(budget)) * power / F.lit(sums)).cast("long")
    most = F.greatest(F.col("tokens") / F.lit(float(block_tokens)), F.col("rows") / F.lit(float(block_rows)))
    plan = sources.withColumn("quota", quota).select(
        "group",
        F.expr("quota div tokens").alias("passes"),
        F.expr("quota % tokens").alias("rest"),
        F.ceil(most).cast("long").alias("blocks"),
    )
    plan = stage(plan, "plan")

    block = F.pmod(F.conv(F.substring(_hash(F.lit(seed), "doc_id", "digest"), 1, 8), 16, 10).cast("long"), F.col("blocks"))
    dealt = rows.join(plan, "group").withColumn("block", block)
    keys = lambda frame, epoch: frame.withColumn("mix_key", _hash(F.lit(seed), "group", epoch, "block"))
    inside = lambda epoch: _hash(F.lit(seed), epoch, "doc_id", "digest")

    # what of the last pass begins before the quota's end: groups of blocks, then blocks, then documents
    sizes = dealt.groupBy("group", "passes", "rest", "block").agg(F.sum("n_tokens").alias("tokens"))
    sizes = stage(keys(sizes, "passes").withColumn("part", F.substring("mix_key", 1, 3)), "blocks")
    parts = sizes.groupBy("group", "rest", "part").agg(F.sum("tokens").alias("tokens"))
    parts = parts.withColumn("past", _spent(W.partitionBy("group").orderBy("part")) - F.col("tokens"))
    parts = parts.filter("past < rest").select("group", "part", "past")
    upto = F.col("past") + _spent(W.partitionBy("group", "part").orderBy("mix_key", "block"))
    last = sizes.join(parts, ["group", "part"]).withColumn("upto", upto).filter("upto - tokens < rest")
    last = stage(last.select("group", "block", F.expr("upto < rest").alias("whole"), F.expr("upto - tokens").alias("before")), "last-pass")
    tried = dealt.join(last, ["group", "block"])
    same = ["doc_id", "source", "digest", "group", "block", "n_tokens", "passes", "rest", "before"]
    cut = tried.filter("not whole").groupBy(same).agg(F.count(F.lit(1)).alias("copies"))
    cut = cut.withColumns({"tokens": F.col("n_tokens") * F.col("copies"), "doc_key": inside("passes")})
    cut = cut.withColumn("room", F.col("rest") - F.col("before") - _spent(W.partitionBy("group", "block").orderBy("doc_key")) + F.col("tokens"))
    cut = cut.filter("room > 0").withColumn("fit", F.expr("if(n_tokens = 0, copies, least(copies, room div n_tokens))"))
    left = F.col("room") - F.col("fit") * F.col("n_tokens")
    alone = (F.col("passes") == 0) & (left == F.col("rest"))
    more = (F.col("fit") < F.col("copies")) & (left > 0) & ((2 * left >= F.col("n_tokens")) | alone)
    cut = cut.withColumn("uses", F.col("fit") + more.cast("long")).filter("uses > 0").withColumn("use", F.explode(F.expr("sequence(1L, uses)")))
    # the sum hides how the rows are partitioned: Spark 4.1 can fail on unions of equally partitioned frames
    cut = cut.withColumn("block", F.col("block") + F.lit(0))
    columns = ["doc_id", "source", "digest", "group", "block", "n_tokens"]
    part = tried.filter("whole").select(*columns, F.col("passes").alias("epoch"))
    part = part.unionByName(cut.select(*columns, F.col("passes").alias("epoch")))
    full = dealt.filter("passes > 0").withColumn("epoch", F.explode(F.expr("sequence(0L, passes - 1)")))
    used = keys(full.select(*columns, "epoch").unionByName(part), "epoch").withColumn("doc_key", inside("epoch"))
    return used.select("doc_id", "source", F.col("epoch").cast("int").alias("epoch"), "block", "n_tokens", "mix_key", "doc_key")
