"""Mixing sources to target weights by iterative proportional fitting (operator 4).

Documents fall into cells of (source, language, topic).  The cells' token
weights are raked: scaled by turns so that their sums over each dimension
meet the target shares, again and again.  A cell's raked tokens over its own
tokens is its sampling rate, scaled to the token budget.  Cells that would need
more than all of their tokens are taken whole and all are raked again with that
limit, so the sample still meets the targets; ``shares`` reports them beside
what is met.  Each document is kept with its cell's probability by a hash of
its id.

No value can give more tokens than it has.  Target shares made here are limited
to ``MOST`` of what a value has at the budget, and what is cut off goes to the
other values in proportion; targets that a caller gives stay as they are and
the budget is lowered to the greatest at which each value has enough.

All of it is DataFrame operations.  Documents are only read and hashed; the
raking runs on the table of cells, summed before the shuffle.

Null or empty texts weigh 0 tokens but can be sampled; a null source or
language is a value of its own; a null id is hashed as the word null.
Repeated rows have one fate.  Dimensions that a target names but no document
has are ignored, the other shares are scaled to add up to one; a value
without a target has share 0 and is not sampled.  No ties arise.  An empty
table gives an empty result.  Extra columns are carried, whatever their
names; the operator's own are prefixed inside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

DIMS = ("source", "lang", "topic")
SWEEPS = 12              # of raking, each over all dimensions
CAP_SWEEPS = 12          # of raking again with whole cells
CAP_ROUNDS = 6           # of scaling to the budget in the end
FILL_ROUNDS = 6          # of spreading what a limited target leaves
TEMPER = 0.7             # targets of the query: shares to this power
BUDGET = 0.8             # of all tokens
MOST = 0.95              # of a value's tokens that a target made here asks for
MEASURES = ("tokens", "rows", "weight", "probability")


def tokens(text: Column) -> Column:
    """Words by separators: blanks and line ends, and one more if there is any text."""
    text = F.coalesce(text, F.lit(""))
    bare = F.replace(F.replace(text, F.lit(" "), F.lit("")), F.lit("\n"), F.lit(""))
    return F.when(F.length(text) == 0, 0).otherwise(F.length(text) - F.length(bare) + 1).cast("long")


def topic(text: Column) -> Column:
    """A coarse topic from marks in the whole text."""
    text = F.coalesce(text, F.lit(""))
    return (F.when(F.contains(text, F.lit("|")), "table").when(F.contains(text, F.lit("@")), "contact")
            .when(F.contains(text, F.lit("\n")), "article").otherwise("note"))


def place(id_col: Column) -> Column:
    """A number in [0, 1) from the id, the same in every engine that has md5."""
    digest = F.md5(F.coalesce(id_col.cast("string"), F.lit("null")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(2.0 ** 32)


def tempered(cells: DataFrame, dim: str, power: float = TEMPER, budget: float = BUDGET) -> DataFrame:
    """Targets: each value's share of the tokens, to a power, and within what the value has at the budget."""
    sums = C.written(cells.groupBy(dim).agg(F.sum("tokens").cast("double").alias("t")), "sums")
    total, powers = sums.agg(F.sum("t"), F.sum(F.pow("t", F.lit(power)))).first()
    if not total:
        return sums.select(F.col(dim).alias("value"), F.lit(0.0).alias("share"))
    raw, most = F.pow("t", F.lit(power)) / F.lit(powers), F.lit(MOST / budget) * F.col("t") / F.lit(total)
    k = 1.0
    for _ in range(FILL_ROUNDS):
        full = raw * F.lit(k) >= most
        taken, rest = sums.agg(F.coalesce(F.sum(F.when(full, most)), F.lit(0.0)), F.sum(F.when(~full, raw))).first()
        if not rest:
            break
        k = (1 - taken) / rest
    return sums.select(F.col(dim).alias("value"), F.least(raw * F.lit(k), most).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], sweeps: int = SWEEPS) -> DataFrame:
    """Adds weight: the cells' shares, raked to the target shares.

    ``cells`` has the dimensions and tokens; a target has value and share.
    """
    shares, w = cells, F.col("tokens").cast("double")
    for dim, target in targets.items():
        t = target.select(F.col("value").alias("__value"), F.col("share").alias(f"__t_{dim}"))
        shares = shares.join(t, F.col(dim).eqNullSafe(F.col("__value")), "left").drop("__value").na.fill(0.0, [f"__t_{dim}"])
    shares = C.written(shares.withColumn("weight", w), "cells")
    # shares of the values that occur in a cell with tokens
    totals = {}
    for dim in targets:
        totals[dim] = shares.where("tokens > 0").groupBy(dim).agg(F.max(f"__t_{dim}").alias("t")).agg(F.sum("t")).first()[0] or 1.0
    out = shares
    for sweep in range(sweeps):
        for dim in targets:
            share = F.col(f"__t_{dim}") / F.lit(float(totals[dim]))
            group = F.sum("weight").over(Window.partitionBy(dim))
            out = out.withColumn("weight", F.when(group > 0, F.col("weight") * share / group).otherwise(F.lit(0.0)))
        if sweep % 4 == 3 and sweep + 1 < sweeps:
            out = C.written(out, "raked")
    return out.drop(*(f"__t_{d}" for d in targets))


def dimensions(cells: DataFrame) -> list[str]:
    return [c for c in cells.columns if c not in MEASURES]


def feasible(raked: DataFrame, budget: float) -> float:
    """The budget, or the greatest share of all tokens at which every value has what its weight asks for."""
    total = raked.agg(F.sum("tokens")).first()[0] or 0
    for dim in dimensions(raked):
        has = raked.groupBy(dim).agg(F.sum("tokens").alias("t"), F.sum("weight").alias("w")).where("w > 0")
        least = has.agg(F.min(F.col("t") / F.col("w"))).first()[0]
        if total and least is not None:
            budget = min(budget, least / total)
    return budget


def probabilities(raked: DataFrame, budget: float = BUDGET, sweeps: int = CAP_SWEEPS, rounds: int = CAP_ROUNDS) -> DataFrame:
    """Adds probability: the tokens kept in expectation are the feasible budget, in the weights' shares of each value."""
    raked = C.written(raked, "raked")
    total = raked.agg(F.sum("tokens")).first()[0] or 0
    budget = feasible(raked, budget)
    out = raked.withColumn("__want", F.col("weight") * F.lit(float(budget * total)))
    for dim in dimensions(raked):
        out = out.withColumn(f"__aim_{dim}", F.sum("__want").over(Window.partitionBy(dim)))
    for sweep in range(sweeps):
        for dim in dimensions(raked):
            kept = F.sum(F.least(F.col("__want"), F.col("tokens").cast("double"))).over(Window.partitionBy(dim))
            out = out.withColumn("__want", F.when(kept > 0, F.col("__want") * F.col(f"__aim_{dim}") / kept).otherwise(F.lit(0.0)))
        if sweep % 4 == 3:
            out = C.written(out, "capped")
    scale = 1.0
    for _ in range(rounds):
        whole = F.col("__want") * F.lit(scale) >= F.col("tokens")
        taken, rest = out.where("tokens > 0").agg(F.coalesce(F.sum(F.when(whole, F.col("tokens"))), F.lit(0)),
                                                  F.coalesce(F.sum(F.when(~whole, F.col("__want"))), F.lit(0.0))).first()
        if not rest:
            break
        scale = (budget * total - taken) / rest
    rate = F.col("__want") * F.lit(scale) / F.col("tokens")
    return out.withColumn("probability", F.when(F.col("tokens") > 0, F.least(F.lit(1.0), rate)).otherwise(F.lit(float(budget)))).select(
        *raked.columns, "probability")


def shares(rates: DataFrame) -> DataFrame:
    """dim, value, target and achieved: each value's share of the weights, and of the tokens that are sampled in expectation."""
    dims = dimensions(rates)
    kept = rates.select("weight", (F.col("probability") * F.col("tokens")).alias("kept"), F.explode(F.array(*(
        F.struct(F.lit(d).alias("dim"), F.col(d).cast("string").alias("value")) for d in dims))).alias("__at")).select("__at.*", "weight", "kept")
    both = C.written(kept.groupBy("dim", "value").agg(F.sum("weight").alias("target"), F.sum("kept").alias("kept")), "shares")
    weights, tokens = both.agg(F.sum("target"), F.sum("kept")).first()
    n = len(dims)        # every cell is counted once in each dimension
    return both.select("dim", "value", (F.col("target") / F.lit((weights or 1.0) / n)).alias("target"),
                       (F.col("kept") / F.lit((tokens or 1.0) / n)).alias("achieved"))


def cells_of(docs: DataFrame, dims: dict[str, Column], n_tokens: Column) -> DataFrame:
    return docs.groupBy(*(c.alias(d) for d, c in dims.items())).agg(F.sum(n_tokens).alias("tokens"), F.count("*").alias("rows"))


def calibrated(cells: DataFrame, targets: dict[str, DataFrame] | None = None, budget: float = BUDGET) -> DataFrame:
    """Cells with weight and probability; targets are tempered shares unless given."""
    cells = C.written(cells, "cells")
    return probabilities(rake(cells, targets or {d: tempered(cells, d, budget=budget) for d in dimensions(cells)}), budget)


def sample(docs: DataFrame, dims: dict[str, Column], n_tokens: Column, id_col: str = "doc_id",
           targets: dict[str, DataFrame] | None = None, budget: float = BUDGET) -> DataFrame:
    """The sampled rows of ``docs``, columns unchanged."""
    rates = calibrated(cells_of(docs, dims, n_tokens), targets, budget)
    keys = [F.col(d).alias(f"__{d}") for d in dims]
    rates = rates.select(*keys, F.col("probability").alias("__p"))
    marked = docs.withColumns({f"__own_{d}": c for d, c in dims.items()})
    same = None
    for d in dims:
        one = F.col(f"__own_{d}").eqNullSafe(F.col(f"__{d}"))
        same = one if same is None else same & one
    return marked.join(rates, same).where(place(F.col(id_col)) < F.col("__p")).select(*docs.columns)
