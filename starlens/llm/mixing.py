"""Mixing sources to target weights: temperature, bisected; budgeted block permutations.

With token shares ``p`` of the sources, the weights are ``p^a / sum(p^a)``.
The exponent ``a`` in [0, 1] is bisected: it falls (the mixture flattens) until
the entropy of the weights reaches ``target_entropy`` times its maximum, but
never so far that any source is read more than ``max_repeats`` times.

The weights are then realised exactly, not by drawing rows.  The documents of
a source are dealt by hash into about the square root of their number of
blocks; every pass over the source is its own permutation of the blocks; whole
passes come first, and the last pass is cut where the source's token quota
ends, inside a block by the hash order of its documents.  No window ever holds
more than the square root of a source, so a source with a third of all rows
needs no special case.  DataFrame functions only; the driver sees sums over
sources, never rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starlens.llm.common import table, written

TARGET_ENTROPY = 0.95  # of the entropy of equal weights
MAX_REPEATS = 2.0
SEED = "mix-1"
LEVELS, ROUNDS = 5, 6  # bisection levels per pass over the shares, passes: a is met to 2^-30


def word_count(text: Column) -> Column:
    """Tokens of a text: runs of characters other than blank, tab and line ends."""
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t\\r\\n]+")), F.lit(0)).cast("long")


def _hash(*parts: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(SEED), *(F.coalesce(p.cast("string"), F.lit("\\N")) for p in parts)).cast("binary"))


def _number(digest: Column) -> Column:
    return F.conv(F.left(digest, F.lit(8)), 16, 10).cast("long")


def bisect_exponent(shares: DataFrame, target_entropy: float, max_repeats: float, budget_share: float | None) -> float:
    """The exponent for the positive shares ``p`` (one row per source).  Each
    pass aggregates the shares at 2^LEVELS - 1 exponents, which decides LEVELS
    bisection steps at once."""
    low, high, steps = 0.0, 1.0, 1 << LEVELS
    for _ in range(ROUNDS):
        grid = [low + (high - low) * k / steps for k in range(steps + 1)]
        sums = shares.agg(
            F.count("p").alias("n"), F.min("p").alias("least"), F.max("p").alias("most"),
            *(F.sum(F.pow("p", F.lit(a))).alias(f"z{k}") for k, a in enumerate(grid)),
            *(F.sum(F.pow("p", F.lit(a)) * F.ln("p")).alias(f"l{k}") for k, a in enumerate(grid))).first()

        def raise_it(k: int) -> bool:
            a, z = grid[k], sums[f"z{k}"]
            entropy = math.log(z) - a * sums[f"l{k}"] / z
            if budget_share is None:
                repeats = (sums["most"] / sums["least"]) ** (1 - a)
            else:
                repeats = budget_share * sums["least"] ** (a - 1) / z
            return repeats > max_repeats or entropy >= target_entropy * math.log(sums["n"])

        if not sums["n"] or (high == 1.0 and raise_it(steps)):
            return 1.0
        if low == 0.0 and not raise_it(0):
            return 0.0
        k = 0
        for bit in reversed(range(LEVELS)):  # the largest grid point that must still be raised
            k += (1 << bit) if raise_it(k + (1 << bit)) else 0
        low, high = grid[k], grid[k + 1]
    return high


def plan_mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                 target_entropy: float = TARGET_ENTROPY, max_repeats: float = MAX_REPEATS,
                 budget_tokens: int | None = None) -> DataFrame:
    """(id, h, source, weight, pass, block, place, tokens, n_rows): one row for
    each pass in which a document is read; ``place`` is its block's rank in
    that pass's permutation, h the hash of the text, n_rows the number of
    equal input rows it stands for, tokens their sum.

    Without ``budget_tokens`` the budget is the smallest that reads every
    document at least once, so nothing is dropped.  With one, the last pass of
    a source ends before its quota is exceeded.  A null source is a source of
    its own.  Rows equal in id, source and text are one unit.  Documents
    without a token go with their block; a source without any token has no
    share and is read once, at weight 0.  A very long text is one unit with all
    its tokens, and is never cut.  An empty table gives no rows.
    """
    units = written(
        docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                    F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")).alias("h"),
                    word_count(F.col(text_col).cast("string")).alias("tokens"))
        .groupBy("id", "source", "h").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n_rows"))
        .withColumn("u", _hash(F.col("id"), F.col("h"))), "mix-units")
    shares = written(units.groupBy("source").agg(F.sum("tokens").alias("total"), F.count("*").alias("n")), "mix-shares")
    grand, top = shares.agg(F.sum("total"), F.max("total")).first()
    shares = shares.withColumn("p", F.when(F.col("total") > 0, F.col("total") / F.lit(float(grand or 1))))
    budget_share = None if budget_tokens is None or not grand else budget_tokens / grand
    a = bisect_exponent(shares.where("p > 0").select("p"), target_entropy, max_repeats, budget_share)
    z = shares.where("p > 0").agg(F.sum(F.pow("p", F.lit(a)))).first()[0] or 1.0
    if budget_share is None:
        repeats = F.pow(F.lit(float(top or 0)) / F.nullif("total", F.lit(0)), F.lit(1 - a))
    else:
        repeats = F.lit(budget_share / z) * F.pow("p", F.lit(a - 1))
    quotas = shares.select(
        "source", "total", F.ceil(F.sqrt("n")).alias("n_blocks"),
        F.round(F.coalesce(F.pow("p", F.lit(a)) / F.lit(z), F.lit(0.0)), 9).alias("weight"),
        F.coalesce(F.floor(F.col("total") * repeats + 0.5), F.lit(0)).alias("quota"))
    quotas = quotas.withColumns({
        "full": F.when(F.col("total") > 0, F.floor(F.col("quota") / F.greatest("total", F.lit(1)))).otherwise(1),
        "source_": F.col("source")}).drop("source")
    quotas = quotas.withColumn("rest", F.col("quota") - F.col("full") * F.col("total"))

    placed = units.join(quotas.select("source_", "n_blocks"), F.col("source").eqNullSafe(F.col("source_"))).withColumn(
        "block", F.pmod(_number(F.col("u")), F.col("n_blocks"))).drop("source_", "n_blocks")
    blocks = placed.groupBy("source", "block").agg(F.sum("tokens").alias("size"))
    passes = blocks.join(quotas, F.col("source").eqNullSafe(F.col("source_"))).withColumn(
        "pass", F.explode(F.sequence(F.lit(1), F.col("full").cast("int") + 1)))
    order = Window.partitionBy("source", "pass").orderBy("turn", "block")
    passes = passes.withColumn("turn", _hash(F.col("source"), F.col("block"), F.col("pass"))).withColumns({
        "place": F.row_number().over(order),
        "before": F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1))})
    room = F.col("rest") - F.coalesce("before", F.lit(0))
    whole_pass = F.col("pass") <= F.col("full")
    passes = passes.where(whole_pass | (room > 0)).select(
        F.col("source").alias("source_"), F.col("block").alias("block_"), "pass", "place", "weight",
        F.when(~whole_pass & (room < F.col("size")), room).alias("room"))
    read = placed.join(passes, F.col("source").eqNullSafe(F.col("source_")) & (F.col("block") == F.col("block_")))
    # At most one block of a source is cut: the only rows that need an order among documents.
    cut = read.where("room IS NOT NULL").withColumn("so_far", F.sum("tokens").over(
        Window.partitionBy("source", "block", "pass").orderBy("u").rowsBetween(Window.unboundedPreceding, 0)))
    out = ["id", "h", "source", "weight", "pass", "block", "place", "tokens", "n_rows"]
    return read.where("room IS NULL").select(out).unionByName(cut.where("so_far <= room").select(out))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **limits) -> DataFrame:
    """The columns of ``docs``, a row for every reading that ``plan_mixture``
    gives it, in the order of passes and of the blocks' places in them: range
    partitions, sorted, so that files written from them follow the permuted
    blocks.  Within a place documents go by a hash, which interleaves sources.
    Equal rows are read equally often, one after the other; an empty table
    gives no rows; a very long text is one row and moves whole, twice."""
    plan = plan_mixture(docs, id_col, text_col, source_col, **limits).select(
        F.col("id").alias("id_"), F.col("source").alias("source_"), F.col("h").alias("h_"), "pass", "place")
    plan = written(plan, "mixture").hint("merge")  # a row for every reading: met by a shuffle join at every size
    rows = docs.select(
        F.struct("*").alias("row"), F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
        F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")).alias("h"))
    met = rows.join(plan, F.col("id").eqNullSafe(F.col("id_")) & F.col("source").eqNullSafe(F.col("source_"))
                    & (F.col("h") == F.col("h_")))
    order = [F.col("pass"), F.col("place"), F.xxhash64("id", "h")]
    return met.repartitionByRange(*order).sortWithinPartitions(*order).select("row.*")


def op1_mixing(spark, sf_dir: str) -> DataFrame:
    plan = plan_mixture(table(spark, sf_dir, "documents"))
    return plan.select(F.col("id").alias("doc_id"), "source", "weight", F.col("pass"), "block", "place", "tokens")


_STEP = "list_sum(list_transform(ps, lambda p: pow(p, (lo + hi) / 2)))"
ORACLE_SQL = f"""
WITH RECURSIVE units AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS h,
    len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\r\\n]+'))::BIGINT AS tokens
  FROM {{documents}}
), keyed AS (
  SELECT *, md5(concat_ws('|', '{SEED}', doc_id::VARCHAR, h)) AS u FROM units
), totals AS (
  SELECT source, sum(tokens)::DOUBLE AS total, count(*) AS n FROM keyed GROUP BY source
), shares AS (
  SELECT *, total / (SELECT sum(total) FROM totals) AS p FROM totals
), one AS (
  SELECT list(p ORDER BY p) AS ps, max(p) AS top, min(p) AS low, count(*) AS k FROM shares
), steps AS (
  SELECT 0 AS i, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi
  UNION ALL
  SELECT i + 1, CASE WHEN up THEN (lo + hi) / 2 ELSE lo END, CASE WHEN up THEN hi ELSE (lo + hi) / 2 END FROM (
    SELECT i, lo, hi, pow(top / low, 1 - (lo + hi) / 2) > {MAX_REPEATS}
      OR ln({_STEP}) - (lo + hi) / 2 * list_sum(list_transform(ps, lambda p: pow(p, (lo + hi) / 2) * ln(p))) / {_STEP}
        >= {TARGET_ENTROPY} * ln(k) AS up
    FROM steps, one WHERE i < {LEVELS * ROUNDS})
), exponent AS (
  SELECT hi AS a FROM steps WHERE i = {LEVELS * ROUNDS}
), quotas AS (
  SELECT source, total, ceil(sqrt(n))::BIGINT AS n_blocks,
    round(pow(p, a) / (SELECT sum(pow(p, a)) FROM shares, exponent), 9) AS weight,
    floor(total * pow((SELECT max(total) FROM shares) / total, 1 - a) + 0.5)::BIGINT AS quota
  FROM shares, exponent
), parts AS (
  SELECT *, (quota // total::BIGINT) AS full_, quota % total::BIGINT AS rest FROM quotas
), placed AS (
  SELECT k.*, ('0x' || left(u, 8))::BIGINT % n_blocks AS block, weight, full_, rest FROM keyed k JOIN parts USING (source)
), blocks AS (
  SELECT source, block, sum(tokens)::BIGINT AS size, any_value(full_) AS full_, any_value(rest) AS rest
  FROM placed GROUP BY source, block
), passes AS (
  SELECT source, block, size, full_, rest, unnest(generate_series(1, full_ + 1)) AS pass FROM blocks
), turns AS (
  SELECT *, md5(concat_ws('|', '{SEED}', source, block::VARCHAR, pass::VARCHAR)) AS turn FROM passes
), ranked AS (
  SELECT *, row_number() OVER w AS place, coalesce(sum(size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM turns WINDOW w AS (PARTITION BY source, pass ORDER BY turn, block)
), read AS (
  SELECT p.*, r.pass, r.place, r.pass <= r.full_ AS all_of_it, r.rest - r.before AS room,
    sum(p.tokens) OVER (PARTITION BY p.source, p.block, r.pass ORDER BY p.u ROWS UNBOUNDED PRECEDING) AS so_far
  FROM placed p JOIN ranked r USING (source, block)
  WHERE r.pass <= r.full_ OR r.rest > r.before
)"""
OP1_SQL = ORACLE_SQL.format(documents="documents") + """
SELECT doc_id, source, weight, pass::INTEGER AS pass, block, place::INTEGER AS place, tokens
FROM read WHERE all_of_it OR so_far <= room"""
