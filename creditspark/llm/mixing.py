"""Mixing sources to target weights by temperature, laid out as budgeted block permutations.

Weights are source token shares raised to one exponent and normalised. The exponent is found
by nested sections of [0, 1] to meet a target entropy or a limit on repetition. A source's
weight times the token budget says how many passes over it the mix takes; each pass is a fresh
permutation of the source's blocks and of the rows within them, and the last one stops where
the budget does. All of it is DataFrame functions.

A source of n rows has about sqrt(n) blocks of about sqrt(n) rows, so running sums go over
blocks and within blocks, and no task holds a source, however large its share.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditspark.llm.common import cut, small

REPEAT_LIMIT = 2.0
SEED = 17
_WIDTH = 31  # points tried at once; seven rounds give 35 bits
_ROUNDS = 7


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def sized(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    size: Column | None = None,
    carry: bool = False,
) -> DataFrame:
    """(doc_id, source, g, mark, n_tokens, row): g names the source, null too; row: the docs' own columns, with ``carry``."""
    own = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        F.to_json(F.struct(F.col(source_col).alias("source"))).alias("g"),
        F.xxhash64(F.col(text_col)).alias("mark"),
        (words(F.col(text_col)) if size is None else size).alias("n_tokens"),
        *own,
    )


def source_totals(rows: DataFrame) -> DataFrame:
    """(g, n_rows, tokens) of each source of ``sized`` rows."""
    return rows.groupBy("g").agg(F.count("*").alias("n_rows"), F.sum("n_tokens").alias("tokens"))


def exponent(totals: DataFrame, entropy: float | None = None, repeat_limit: float | None = None, whole: bool = False) -> float:
    """The least exponent in [0, 1] that gives at most ``repeat_limit`` passes over any source,
    or the greatest that gives at least ``entropy`` (as a share of the uniform mix's).

    Passes count against a budget of the corpus's own size, or with ``whole`` against the least
    budget that takes every source at least once. One row of sums per round reaches the driver.
    1 (shares as they are) meets any limit of 1 or more; 0 (uniform) any entropy up to 1.
    """
    if (entropy is None) == (repeat_limit is None):
        raise ValueError("give either an entropy or a limit on repetition")
    filled = totals.where("tokens > 0")
    whole_sum = filled.agg(F.sum("tokens"), F.count("*")).first()
    if not whole_sum[1]:
        return 1.0
    shares = filled.select((F.col("tokens") / float(whole_sum[0])).alias("p"))
    low, high = 0.0, 1.0
    for _ in range(_ROUNDS):
        tried = [low + (high - low) * (i + 1) / (_WIDTH + 1) for i in range(_WIDTH)]
        sums = []
        for a in tried:
            w = F.pow("p", F.lit(a))
            gain = F.pow("p", F.lit(a - 1))  # passes, up to the normalisation
            sums += [F.sum(w), F.sum(w * F.log(w)), F.max(gain), F.min(gain)]
        row = shares.agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()
        met = []
        for i in range(_WIDTH):
            z, wlog, most, least = row[4 * i : 4 * i + 4]
            if repeat_limit is not None:
                met.append(most / (least if whole else z) <= repeat_limit)
            else:
                met.append((math.log(z) - wlog / z) >= entropy * math.log(whole_sum[1]))
        if repeat_limit is not None:  # met from some exponent on
            first = met.index(True) if True in met else _WIDTH
            low, high = (tried[first - 1] if first else low), (tried[first] if first < _WIDTH else high)
        else:  # met up to some exponent
            last = _WIDTH - 1 - met[::-1].index(True) if True in met else -1
            low, high = (tried[last] if last >= 0 else low), (tried[last + 1] if last + 1 < _WIDTH else high)
    return high if repeat_limit is not None else low


def targets(totals: DataFrame, alpha: float, budget: int | None = None, whole: bool = False) -> DataFrame:
    """(g, n_rows, tokens, weight, passes, rest): whole passes over each source and tokens of one more.

    ``budget``: tokens of the mix, by default as many as there are. With ``whole`` it is the least
    that takes every source at least once. A source without tokens has weight 0 and costs nothing:
    with ``whole`` its rows are taken once, else those of its part pass.
    """
    both = totals.crossJoin(  # one row of sums
        totals.where("tokens > 0").agg(
            F.sum("tokens").alias("all"),
            F.sum(F.pow("tokens", F.lit(alpha))).alias("z"),
            F.max(F.pow("tokens", F.lit(1 - alpha))).alias("most"),
        )
    )
    weight = F.when(F.col("tokens") > 0, F.pow("tokens", F.lit(alpha)) / F.col("z")).otherwise(0.0)
    if whole:
        tokens = F.pow("tokens", F.lit(alpha)) * F.col("most")
    else:
        tokens = weight * (F.col("all").cast("double") if budget is None else F.lit(float(budget)))
    due = both.select("g", "n_rows", "tokens", weight.alias("weight"), F.round(tokens).cast("long").alias("due"))
    passes = F.when(F.col("tokens") > 0, F.floor(F.try_divide("due", "tokens"))).otherwise(0)
    return due.withColumn("passes", passes.cast("int")).withColumn("rest", F.col("due") - F.col("passes") * F.col("tokens"))


def _dealt(rows: DataFrame, goal: DataFrame, seed: int) -> DataFrame:
    """``rows`` with their source's plan and their block."""
    plan = small(goal.select(F.col("g").alias("_g"), "n_rows", "tokens", "passes", "rest", "due"))
    block = F.pmod(F.xxhash64("doc_id", "mark", F.lit(seed)), F.ceil(F.sqrt("n_rows")))
    return rows.join(plan, F.col("g") == F.col("_g")).withColumn("block", block).drop("_g", "n_rows")


def permute(rows: DataFrame, goal: DataFrame, whole_rows: DataFrame | None = None, seed: int = SEED) -> DataFrame:
    """The rows of the mix: (doc_id, source, pass, block, offset, n_tokens, at).

    With ``whole_rows`` (``sized`` rows that carry) it is their own columns instead; ``rows`` are the same
    rows without. ``offset``: tokens of the source before the row in its pass. ``at``: the share of
    the source's part of the mix that lies before the row; ordered by it, the mix has its
    weights all along. A row is in the part pass if it ends within the budget.
    """
    turn = F.explode(F.sequence(F.lit(0), F.col("passes")))
    before = Window.partitionBy("g", "pass").orderBy(F.xxhash64("block", "pass", F.lit(seed)), "block")
    blocks = cut(
        _dealt(rows, goal, seed)
        .groupBy("g", "block", "passes")
        .agg(F.sum("n_tokens").alias("held"))
        .select("g", "block", "held", turn.alias("pass"))
        .withColumn("before", F.sum("held").over(before.rowsBetween(Window.unboundedPreceding, 0)) - F.col("held"))
        .select(F.col("g").alias("_g"), F.col("block").alias("_block"), "pass", "before")
    )
    dealt = _dealt(rows if whole_rows is None else whole_rows, goal, seed)
    same = (F.col("g") == F.col("_g")) & (F.col("block") == F.col("_block"))
    placed = dealt.join(small(blocks), same).where("pass < passes or before <= rest")
    inside = Window.partitionBy("g", "pass", "block").orderBy(
        F.xxhash64("doc_id", "mark", "pass", F.lit(seed)), "doc_id", "mark"
    )
    offset = F.col("before") + F.sum("n_tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_tokens")
    taken = placed.withColumn("offset", offset).where("pass < passes or offset + n_tokens <= rest")
    if whole_rows is not None:
        return taken.select("row.*")
    at = F.when(F.col("due") > 0, (F.col("pass") * F.col("tokens") + F.col("offset")) / F.col("due")).otherwise(0.0)
    return taken.select("doc_id", "source", "pass", "block", "offset", "n_tokens", at.alias("at"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    entropy: float | None = None,
    repeat_limit: float | None = None,
    budget: int | None = None,
    whole: bool = False,
    carry: bool = False,
    seed: int = SEED,
) -> DataFrame:
    """Sources mixed by temperature to an ``entropy`` or ``repeat_limit`` (2 if neither is given).

    Tokens are words between blanks. A null or empty text costs nothing and is taken where it
    comes before the cut. A null source is a source. Equal rows are each placed; which of them comes first
    makes no difference. No rows give no rows. Columns of other names pass with ``carry``.
    """
    if entropy is None and repeat_limit is None:
        repeat_limit = REPEAT_LIMIT
    rows = cut(sized(docs, id_col, text_col, source_col))
    totals = cut(source_totals(rows))
    goal = cut(targets(totals, exponent(totals, entropy, repeat_limit, whole), budget, whole))
    return permute(rows, goal, sized(docs, id_col, text_col, source_col, carry=True) if carry else None, seed)
