"""Mixing sources to target weights by Poisson replication, in DataFrame functions alone.

A source with n rows and the weight w should make w / sum(w) of ``total`` rows, so its rows are repeated
total * w / sum(w) / n times on average. Each row draws its own number of copies: a uniform number from a
keyed hash of its identity is put through the inverse of the Poisson distribution with that mean. Rows are
exploded by their counts and shuffled globally by another keyed hash. Draws depend on the row and the seed
alone, so a lost task repeats them, and hot sources need no exchange of their own: counts are partial
aggregates, and rows are dealt by the hash of their copies.

A null source is a source like any other. Sources without a weight, and weights that are null, not finite or
not above zero, give no copies; weights of absent sources count for nothing. Rows that agree in all identity
columns draw alike. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrylane.llm.common import Workspace, free_name

#: Hex digits of a hash that make a uniform number; 52 bits are exact in a double.
UNIFORM_DIGITS = 13


def keyed_hash(seed: int, *parts: Column) -> Column:
    """32 hex digits; a null part differs from every text."""
    texts = [F.coalesce(F.concat(F.lit("="), p.cast("string")), F.lit("-")) for p in parts]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *texts))


def uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the parts alone."""
    digits = F.substring(keyed_hash(seed, *parts), 1, UNIFORM_DIGITS)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(16**UNIFORM_DIGITS))


def poisson_steps(rate: Column) -> Column:
    """The Poisson distribution function at 0, 1, 2, ... as far as doubles tell it from 1."""
    longest = F.ceil(rate + 10 * F.sqrt(rate) + 30).cast("int")
    # Growing an array copies it, so it is grown in parts: about the square root of its length, of that length each.
    part = F.ceil(F.sqrt(longest.cast("double"))).cast("int")
    none = F.array().cast("array<double>")

    def start(steps: Column, log_factorial: Column = F.lit(0.0), below: Column = F.lit(0.0)) -> Column:
        return F.struct(log_factorial.alias("log_factorial"), below.alias("below"), steps.alias("steps"))

    def step(state: Column, k: Column) -> Column:
        log_factorial = state.log_factorial + F.when(k > 0, F.log(k.cast("double"))).otherwise(0.0)
        below = state.below + F.exp(k * F.log(rate) - rate - log_factorial)
        return start(F.concat(state.steps, F.array(below)), log_factorial, below)

    def steps_of_part(state: Column, first: Column) -> Column:
        numbers = F.sequence(first, F.least(first + part - 1, longest))
        return F.aggregate(numbers, start(none, state.log_factorial, state.below), step,
                           lambda done: start(F.concat(state.steps, F.array(done.steps)), done.log_factorial, done.below))

    parts = start(F.array().cast("array<array<double>>"))
    return F.aggregate(F.sequence(F.lit(0), longest, part), parts, steps_of_part, lambda state: F.flatten(state.steps))


def repetition_rates(docs: DataFrame, weights: DataFrame | None = None, total: int | None = None,
                     temperature: float = 0.5, source: str = "source") -> DataFrame:
    """Per source: ``source``, ``n_rows``, ``rate``. One row per source.

    ``weights`` has the columns source and weight; without it a source weighs n ** ``temperature``, which lifts
    small sources over large ones. ``total`` is the number of rows wanted on average, by default that of ``docs``.
    """
    counts = docs.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("n_rows"))
    if weights is None:
        weighed = counts.withColumn("weight", F.pow(F.col("n_rows").cast("double"), F.lit(float(temperature))))
    else:
        given = weights.groupBy(F.col("source").alias("weight_of")).agg(F.sum(F.col("weight").cast("double")).alias("weight"))
        weighed = counts.join(given, F.col("source").eqNullSafe(F.col("weight_of")), "left").drop("weight_of")
    usable = F.col("weight").isNotNull() & ~F.isnan("weight") & (F.col("weight") > 0) & (F.col("weight") < float("inf"))
    weighed = weighed.withColumn("weight", F.when(usable, F.col("weight")).otherwise(0.0))
    sums = weighed.agg(F.sum("weight").alias("all_weights"), F.sum("n_rows").alias("all_rows"))
    wanted = F.col("all_rows").cast("double") if total is None else F.lit(float(total))
    return weighed.join(sums, F.col("all_weights") > 0).select(
        "source", "n_rows", (F.col("weight") * wanted / F.col("all_weights") / F.col("n_rows")).alias("rate"))


def mix(docs: DataFrame, weights: DataFrame | None = None, total: int | None = None, seed: int = 0,
        identity: tuple[str, ...] = ("doc_id",), source: str = "source", temperature: float = 0.5) -> DataFrame:
    """``docs`` repeated to the target weights and shuffled; ``copy`` numbers the copies of a row from 0.

    The order is by ``shuffle_key`` within each partition, and partitions are dealt by its hash. Columns of
    ``docs`` called copy or shuffle_key stay; the new ones then take another name.
    """
    ws = Workspace(docs.sparkSession, "mixing")
    copy, shuffle_key = free_name(docs, "copy"), free_name(docs, "shuffle_key")
    rates = repetition_rates(docs, weights, total, temperature, source).where(F.col("rate") > 0)
    # Written, so that the planner knows its size: it is broadcast only below the session's limit.
    of, steps_of, u, n = (free_name(docs, name) for name in ("mix_source", "mix_steps", "mix_u", "mix_n"))
    steps = ws.save(rates.select(F.col("source").alias(of), poisson_steps(F.col("rate")).alias(steps_of)), "steps")
    drawn = uniform(seed, *[F.col(c) for c in identity])
    rows = docs.join(steps, F.col(source).eqNullSafe(F.col(of))).withColumn(u, drawn)
    rows = rows.withColumn(n, F.size(F.filter(steps_of, lambda s: s <= F.col(u)))).where(F.col(n) > 0)
    copies = rows.select(*[F.col(c) for c in docs.columns], F.explode(F.sequence(F.lit(0), F.col(n) - 1)).alias(copy))
    keyed = copies.withColumn(shuffle_key, keyed_hash(seed + 1, *[F.col(c) for c in identity], F.col(copy)))
    return keyed.repartition(F.col(shuffle_key)).sortWithinPartitions(shuffle_key)


MIX_SQL = """
WITH counts AS (SELECT source, count(*) AS n_rows FROM documents GROUP BY source),
rates AS (
    SELECT source, sqrt(n_rows) * sum(n_rows) OVER () / sum(sqrt(n_rows)) OVER () / n_rows AS rate FROM counts),
logs AS (
    SELECT source, rate, k, CASE WHEN k > 0 THEN ln(k) ELSE 0 END AS log_k
    FROM rates, LATERAL (SELECT unnest(range(0, ceil(rate + 10 * sqrt(rate) + 31)::BIGINT)) AS k)),
terms AS (
    SELECT source, k, exp(k * ln(rate) - rate - sum(log_k) OVER (PARTITION BY source ORDER BY k)) AS p FROM logs),
steps AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS below FROM terms),
draws AS (
    SELECT *, ('0x' || substr(md5('0|=' || doc_id), 1, 13))::BIGINT / 4503599627370496.0 AS u FROM documents),
drawn AS (
    SELECT d.doc_id, count(*) FILTER (s.below <= d.u) AS n
    FROM draws d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source GROUP BY d.doc_id)
SELECT d.*, c.copy::INTEGER AS copy, md5('1|=' || d.doc_id || '|=' || c.copy) AS shuffle_key
FROM documents d JOIN drawn USING (doc_id), LATERAL (SELECT unnest(range(0, n)) AS copy) c
"""
