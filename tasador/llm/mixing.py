"""Mixing of sources by temperature, in Spark's own expressions.

A source's weight is its share of all tokens to the power alpha, normalised.
Alpha is bisected in [0, 1] to the flattest mixture that neither exceeds the
target entropy nor repeats a source more often than allowed. The weights are
realised in token budgets: every source runs through permutations of its
documents, pass after pass, up to its budget; each source's run is cut into the
same number of blocks, and a block holds its documents of all sources in
random order.

Tokens are the words of a text and one end, so that an empty text counts one.
Permutations come from MD5 of seed, pass and id, so they do not depend on the
partitioning. Running totals are computed in buckets of bounded size and the
buckets' totals, so a source with a third of all rows is no single task.

Defined results: null is a source of its own; null text has one token; rows
with equal id in a source are adjacent in its permutations. An empty table
gives an empty mixture. Extra columns are carried along; columns that begin
with ``mix_`` are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tasador.plans.joins import lookup_join
from tasador.plans.workspace import materialize, materialize_measured


@dataclass(frozen=True)
class Settings:
    """``entropy``: target, as a share of that of equal weights. ``repeats``: most
    passes over a source. ``budget``: tokens of the mixture as a multiple of all
    tokens; None for the least with which every document occurs.
    ``block_tokens``: about the size of a block. ``bucket_rows``: rows of a
    permutation's bucket."""

    entropy: float = 0.98
    repeats: float = 4.0
    budget: float | None = 1.0
    block_tokens: int = 1 << 18
    bucket_rows: int = 4096
    seed: int = 7


#: Steps of bisection: 8 jobs of 4 steps each.
JOBS, STEPS = 8, 4
WORD = r"[^\x20\x09-\x0D]+"


def tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long") + 1


def source_stats(rows: DataFrame) -> DataFrame:
    """Tokens, documents and share of each source, in the shared folder."""
    own = rows.groupBy("mix_source").agg(
        F.sum("mix_tokens").alias("tokens"), F.count("*").alias("docs")
    )
    stats = materialize(own, "mix-sources")
    total = stats.agg(F.sum("tokens").alias("total"))
    return stats.crossJoin(F.broadcast(total)).withColumn("share", F.col("tokens") / F.col("total"))


def _fits(stats: DataFrame, alphas: list[float], s: Settings) -> list[bool]:
    """Of each exponent: whether the mixture keeps both limits."""
    sums = [F.count("*").alias("n"), F.min("share").alias("least"), F.max("share").alias("most")]
    for i, a in enumerate(alphas):
        power = F.exp(a * F.log("share"))
        sums += [F.sum(power).alias(f"z{i}"), F.sum(power * F.log("share")).alias(f"l{i}")]
    row = stats.agg(*sums)
    tests = []
    for i, a in enumerate(alphas):
        z = F.col(f"z{i}")
        entropy = F.log(z) - a * F.col(f"l{i}") / z
        # The rarest source is repeated most, and the largest one sets the least budget.
        if s.budget is None:
            repeated = F.exp((a - 1) * F.log(F.col("least") / F.col("most")))
        else:
            repeated = s.budget * F.exp((a - 1) * F.log("least")) / z
        tests.append((entropy <= s.entropy * F.log("n") + 1e-12) & (repeated <= s.repeats + 1e-12))
    return [bool(x) for x in row.select(F.array(*tests).alias("fits")).first()["fits"]]


def exponent(stats: DataFrame, s: Settings) -> float:
    """The least exponent in [0, 1] that keeps the limits; 1 if none below does.

    Both limits are easier to keep the larger the exponent is, so it is
    bisected; a job tests the points of several steps.
    """
    low, high, parts = 0.0, 1.0, 1 << STEPS
    if _fits(stats, [0.0], s)[0]:
        return 0.0
    for _ in range(JOBS):
        points = [low + (high - low) * i / parts for i in range(1, parts)]
        first = next((i for i, fit in enumerate(_fits(stats, points, s)) if fit), parts - 1)
        low, high = ([low, *points][first], [*points, high][first])
    return high


def budgets(stats: DataFrame, alpha: float, s: Settings) -> DataFrame:
    """Weight (nine digits), budget in tokens and blocks of every source."""
    raw = stats.withColumn("raw", F.exp(alpha * F.log("share")))
    z = raw.agg(F.sum("raw").alias("z"), F.max(F.col("share") / F.col("raw")).alias("turn"))
    weight = F.round(F.col("raw") / F.col("z"), 9)
    size = F.col("total") * (F.lit(s.budget) if s.budget is not None else F.col("turn") * F.col("z"))
    budget = F.round(weight * size).cast("long")
    if s.budget is None:
        budget = F.greatest(budget, F.col("tokens"))
    return raw.crossJoin(F.broadcast(z)).select(
        "mix_source", "tokens", "docs", weight.alias("weight"), budget.alias("budget"),
        F.greatest(F.lit(1), F.ceil(size / s.block_tokens)).cast("long").alias("blocks"),
    )


def _hash(s: Settings, *parts: str) -> Column:
    texts = [F.coalesce(F.col(p).cast("string"), F.lit("")) for p in parts]
    return F.md5(F.concat_ws("|", F.lit(str(s.seed)), *texts))


def mix(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The mixture: a row for every use of a document.

    Adds ``mix_tokens``, ``mix_pass`` (from 0), ``mix_weight`` of the source and
    ``mix_block`` (from 0), in which ``mix_order`` sorts the rows at random.
    """
    docs = docs.drop(*[c for c in docs.columns if c.startswith("mix_")])
    rows = docs.withColumns({
        "mix_source": F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")),
        "mix_tokens": tokens(F.col("text")),
    })
    stats = source_stats(rows)
    plan = budgets(stats, exponent(stats, s), s)
    # A row for each source and pass; the last pass may be partial.
    runs = plan.select("*", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("budget") - 1) / F.col("tokens"))
    )).alias("mix_pass")).filter("budget > 0")
    # Broadcast up to a measured size; with more sources than that, large ones are spread.
    runs, size = materialize_measured(runs, "mix-runs")
    used = lookup_join(
        rows, runs, ["mix_source"], ["doc_id"], how="inner", lookup_bytes=size
    ).withColumn("mix_hash", _hash(s, "mix_pass", "doc_id"))
    share = F.conv(F.substring("mix_hash", 1, 13), 16, 10).cast("double") / float(1 << 52)
    used = used.withColumn(
        "mix_bucket", F.floor(share * F.ceil(F.col("docs") / s.bucket_rows)).cast("long")
    )
    run = ["mix_source", "mix_pass"]
    sums = used.groupBy(*run, "mix_bucket").agg(F.sum("mix_tokens").alias("bucket_tokens"))
    before = Window.partitionBy(*run).orderBy("mix_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*run, "mix_bucket", F.coalesce(
        F.sum("bucket_tokens").over(before), F.lit(0)
    ).alias("bucket_start"))
    inside = Window.partitionBy(*run, "mix_bucket").orderBy("mix_hash").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    placed = used.withColumn("mix_end", F.sum("mix_tokens").over(inside)).join(
        sums, [*run, "mix_bucket"]
    )
    end = F.col("mix_end") + F.col("bucket_start") + F.col("mix_pass") * F.col("tokens")
    start = end - F.col("mix_tokens")
    return placed.filter(end <= F.col("budget")).select(
        *docs.columns, "mix_tokens", "mix_pass", F.col("weight").alias("mix_weight"),
        F.call_function("div", start * F.col("blocks"), F.col("budget")).alias("mix_block"),
        _hash(s, "doc_id", "mix_pass").alias("mix_order"),
    )


#: The same for DuckDB, with the settings of ``mix`` for the registered query.
def oracle(s: Settings) -> str:
    steps = JOBS * STEPS
    budget = f"{s.budget!r}"
    return rf"""
WITH RECURSIVE rows_ AS (
  SELECT doc_id, source, coalesce('=' || source, '') AS src,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) + 1 AS n
  FROM documents),
stats AS (
  SELECT src, sum(n)::BIGINT AS tokens, sum(n) / (SELECT sum(n) FROM rows_)::DOUBLE AS share
  FROM rows_ GROUP BY src),
bisect AS (
  SELECT 0 AS step, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high
  UNION ALL
  SELECT step + 1, CASE WHEN fits THEN low ELSE (low + high) / 2 END,
         CASE WHEN fits THEN (low + high) / 2 ELSE high END
  FROM (SELECT step, low, high, (
      SELECT ln(sum(exp(a * ln(share)))) - any_value(a) * sum(exp(a * ln(share)) * ln(share))
               / sum(exp(a * ln(share))) <= {s.entropy!r} * ln(count(*)) + 1e-12
             AND {budget} * exp((any_value(a) - 1) * ln(min(share))) / sum(exp(a * ln(share)))
               <= {s.repeats!r} + 1e-12
      FROM (SELECT share, (low + high) / 2 AS a FROM stats)) AS fits
    FROM bisect WHERE step < {steps})),
alpha AS (
  SELECT CASE WHEN (SELECT ln(count(*)) <= {s.entropy!r} * ln(count(*)) + 1e-12
                       AND {budget} / min(share) / count(*) <= {s.repeats!r} + 1e-12 FROM stats)
         THEN 0.0 ELSE high END AS a FROM bisect WHERE step = {steps}),
plan AS (
  SELECT src, tokens, round(exp(a * ln(share)) / sum(exp(a * ln(share))) OVER (), 9) AS weight,
         sum(tokens) OVER () AS total
  FROM stats, alpha),
sized AS (
  SELECT *, round(weight * total * {budget})::BIGINT AS budget,
         greatest(1, ceil(total * {budget} / {s.block_tokens}))::BIGINT AS blocks FROM plan),
used AS (
  SELECT doc_id, source, src, n, pass, tokens, weight, budget, blocks,
         md5('{s.seed}|' || pass || '|' || doc_id) AS hash
  FROM rows_ JOIN sized USING (src), LATERAL (
    SELECT unnest(range(0, (budget - 1) // tokens + 1)) AS pass) WHERE budget > 0),
placed AS (
  SELECT *, sum(n) OVER (PARTITION BY src, pass ORDER BY hash ROWS UNBOUNDED PRECEDING)::BIGINT
            + pass * tokens AS finish FROM used)
SELECT doc_id, source, n AS n_tokens, pass::BIGINT AS mix_pass, weight AS mix_weight,
       ((finish - n) * blocks // budget)::BIGINT AS mix_block,
       row_number() OVER (PARTITION BY (finish - n) * blocks // budget
         ORDER BY md5('{s.seed}|' || doc_id || '|' || pass))::BIGINT AS mix_slot
FROM placed WHERE finish <= budget
"""
