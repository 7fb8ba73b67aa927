"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells (source, language, topic); a cell's weight is its tokens.  Raking scales the
cells in turn so that the weights' marginals meet the target shares of every source, language and
topic, until no factor of a pass differs from 1 by more than `tolerance` (or `rounds` passes are made, as for
targets that contradict each other); the last pass's largest difference is returned as `marginal_error`.  A cell's fitted / observed weight is its rate r
(its mean over the tokens is 1).  A document is sampled with the calibrated probability min(1, r):
over-represented cells are thinned, under-represented ones are kept whole, and `weight` = r / p is
the importance weight that makes the sample's expected weights meet the targets exactly.  The draw
is a hash of seed and id, so it repeats.

Only DataFrame operations.  The cell table is a grouped sum (combined before the shuffle); raking
works on that table alone; it returns to the documents in an equi-join on the cell.

Defined cases: a null source or language is a value of its own; null and empty texts have topic `empty`
and one token; rows that repeat an id share its draw; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import discard, materialise

DIMENSIONS = ("source", "lang", "topic")
# target share of a value, before normalising: its observed share to this power
TEMPER = {"source": 0.7, "lang": 0.8, "topic": 0.9}
TOLERANCE = 1e-9
ROUNDS = 40                  # passes at most
SEED = "mix"


def topic(text: Column) -> Column:
    """Topic of a text by its form: table, list, prose, or empty."""
    n = F.length(text)
    bars = n - F.length(F.replace(text, F.lit("|"), F.lit("")))
    lines = n - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    return (F.when(F.coalesce(n, F.lit(0)) == 0, "empty").when(bars * 50 > n, "table")
            .when(lines * 120 > n, "list").otherwise("prose"))


def tokens(text: Column) -> Column:
    """Tokens of a text: a quarter of its characters, at least one."""
    return F.greatest(F.lit(1), F.floor((F.coalesce(F.length(text), F.lit(0)) + 3) / 4)).cast("long")


def tempered(cells: DataFrame, dim: str, power: float) -> DataFrame:
    """Target shares of a dimension (value, share): observed shares to a power, normalised."""
    seen = cells.groupBy(F.col(dim).alias("value")).agg(F.sum("n").alias("n"))
    raw = seen.select("value", F.pow(F.col("n").cast("double"), F.lit(power)).alias("raw"))
    total = raw.agg(F.sum("raw").alias("total")).first()["total"]
    return raw.select("value", (F.col("raw") / F.lit(total)).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> tuple[DataFrame, float]:
    """(cells (dimensions, n) with `fitted`, the weights whose marginals meet the target shares; the largest relative
    error of a marginal in the last pass).

    Each step is a grouped sum and an equi-join on one dimension; every pass is written, which keeps
    the plan short, and one number comes back from it.  A value without a target keeps its weight.
    The targets join the cells once, before the passes: a pass has one join a dimension.
    """
    total = cells.agg(F.sum("n").alias("t")).first()["t"] or 0
    now = cells.withColumn("fitted", F.col("n").cast("double"))
    for dim, goal in targets.items():
        goal = goal.select(F.col("value").alias("__w"), F.col("share").alias(f"__goal_{dim}"))
        now = now.join(goal, F.col(dim).eqNullSafe(F.col("__w")), "left").drop("__w")
    now = written = materialise(now, "rake")
    error = 0.0
    for _ in range(rounds):
        now = now.withColumn("off", F.lit(0.0))
        for dim in targets:
            sums = now.groupBy(F.col(dim).alias("__v")).agg(F.sum("fitted").alias("__s"), F.max(f"__goal_{dim}").alias("__g"))
            factor = sums.select(
                "__v", F.coalesce(F.col("__g") * F.lit(float(total)) / F.col("__s"), F.lit(1.0)).alias("__f"))
            now = now.join(factor, F.col(dim).eqNullSafe(F.col("__v"))).withColumn(
                "fitted", F.col("fitted") * F.col("__f")).withColumn("off", F.greatest("off", F.abs(F.col("__f") - 1))).drop("__v", "__f")
        now = materialise(now, "rake")
        discard(written)
        written = now
        error = now.agg(F.max("off").alias("e")).first()["e"] or 0.0
        if error <= tolerance:
            break
    return now.drop("off", *[f"__goal_{d}" for d in targets]), float(error)


def _placed(docs: DataFrame, targets: dict[str, DataFrame] | None, temper: dict[str, float] | None, id_col: str,
            text_col: str, rounds: int, seed: str) -> DataFrame:
    """Every row of `docs` as a struct `__doc`, with its id, cell, tokens, rate and draw."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc")).select(
        "__doc", F.col(f"__doc.`{id_col}`").alias("__id"), F.col("__doc.source").alias("source"), F.col("__doc.lang").alias("lang"),
        topic(F.col(f"__doc.`{text_col}`")).alias("topic"), tokens(F.col(f"__doc.`{text_col}`")).alias("tokens"))
    cells = materialise(rows.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("n")), "cells")
    if targets is None:
        power = temper or TEMPER
        targets = {d: materialise(tempered(cells, d, power[d]), "target") for d in DIMENSIONS}
    raked, error = rake(cells, targets, rounds)
    fitted = raked.select(*[F.col(d).alias(f"__{d}") for d in DIMENSIONS], (F.col("fitted") / F.col("n")).alias("rate"))
    same = reduce(lambda a, b: a & b, [F.col(d).eqNullSafe(F.col(f"__{d}")) for d in DIMENSIONS])
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("__id").cast("string"), F.lit("")))), 1, 8),
                  16, 10).cast("double") / 4294967296.0
    return rows.join(fitted, same).withColumn("draw", draw).withColumn("marginal_error", F.lit(error))


def calibrate(docs: DataFrame, targets: dict[str, DataFrame] | None = None, temper: dict[str, float] | None = None,
              id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, seed: str = SEED) -> DataFrame:
    """Per document: id, its cell, tokens, rate, p, weight, sampled, and marginal_error (of the fit, the same in every row)."""
    p = F.least(F.lit(1.0), F.col("rate"))
    slim = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys((id_col, "source", "lang", text_col))])
    return _placed(slim, targets, temper, id_col, text_col, rounds, seed).select(
        F.col("__id").alias(id_col), *DIMENSIONS, "tokens", "rate", p.alias("p"), (F.col("rate") / p).alias("weight"),
        (F.col("draw") < p).alias("sampled"), "marginal_error")


def sample(docs: DataFrame, targets: dict[str, DataFrame] | None = None, temper: dict[str, float] | None = None,
           id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, seed: str = SEED) -> DataFrame:
    """The sampled rows of `docs`, all columns: one pass that joins the fitted cells and filters; each row is decided in
    its own cell."""
    return _placed(docs, targets, temper, id_col, text_col, rounds, seed).where(
        F.col("draw") < F.least(F.lit(1.0), F.col("rate"))).select("__doc.*")


def oracle(rounds: int = 24, seed: str = SEED, digits: int = 6) -> str:
    """The same in SQL, enough passes unrolled that more would not show."""
    steps = ["""rows AS MATERIALIZED (
  SELECT doc_id, source, lang, CASE WHEN coalesce(length(text), 0) = 0 THEN 'empty'
      WHEN (length(text) - length(replace(text, '|', ''))) * 50 > length(text) THEN 'table'
      WHEN (length(text) - length(replace(text, chr(10), ''))) * 120 > length(text) THEN 'list' ELSE 'prose' END AS topic,
    greatest(1, (coalesce(length(text), 0) + 3) // 4) AS tokens FROM documents)""",
             "c AS MATERIALIZED (SELECT source, lang, topic, sum(tokens) AS n, CAST(sum(tokens) AS DOUBLE) AS f FROM rows GROUP BY ALL)"]
    for d in DIMENSIONS:
        steps.append(f"t_{d} AS MATERIALIZED (SELECT {d} AS v, pow(CAST(sum(n) AS DOUBLE), {TEMPER[d]}) / "
                     f"sum(pow(CAST(sum(n) AS DOUBLE), {TEMPER[d]})) OVER () AS share FROM c GROUP BY {d})")
    last = "c"
    for r in range(rounds):
        for d in DIMENSIONS:
            new = f"r{r}_{d}"
            steps.append(f"{new} AS MATERIALIZED (SELECT a.source, a.lang, a.topic, a.n, a.f * t.share * (SELECT sum(n) FROM c) / "
                         f"sum(a.f) OVER (PARTITION BY a.{d}) AS f FROM {last} a JOIN t_{d} t ON t.v IS NOT DISTINCT FROM a.{d})")
            last = new
    return (f"WITH {', '.join(steps)} SELECT doc_id, rows.source, rows.lang, rows.topic, tokens, round(f / n, {digits}) AS rate, "
            f"round(least(1.0, f / n), {digits}) AS p, round(f / n / least(1.0, f / n), {digits}) AS weight, "
            f"CAST('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) / 4294967296.0 < least(1.0, f / n) AS sampled, 0.0::double AS marginal_error "
            f"FROM rows JOIN {last} x ON x.source IS NOT DISTINCT FROM rows.source AND x.lang IS NOT DISTINCT FROM rows.lang AND x.topic = rows.topic")
