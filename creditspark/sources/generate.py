"""Seeded synthetic loans, one per given key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from creditspark import schema as S
from creditspark.functions.loan import format_loan_id
from creditspark.functions.numeric import clip, round_half_even, sigmoid

# --- fixed values: the distributions -------------------------------------------
AMOUNT = (9.5, 0.6, 1_000.0, 40_000.0)
INCOME = (10.9, 0.5, 15_000.0, 300_000.0)
SCORE = (680.0, 80.0, 300.0, 850.0)
PURPOSE_WEIGHTS = [0.45, 0.20, 0.15, 0.08, 0.05, 0.07]
OWNERSHIP_WEIGHTS = [0.45, 0.40, 0.15]
TERM_WEIGHTS = [0.6, 0.4]
DELINQUENCY_SUCCESS = 0.7
INTERCEPT = -3.5
# ----------------------------------------------------------------------------------
TWO_PI = 6.283185307179586


def _digest(key: Column, seed: int, block: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:{block}:"), key.cast("string")))


def _uniforms(digest: Column) -> list[Column]:
    """Four uniforms in (0, 1) from one digest, independent of partitioning."""
    words = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("double") for i in range(4)]
    return [(w + 0.5) / F.lit(4294967296.0) for w in words]


def _normal(u1: Column, u2: Column) -> Column:
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(TWO_PI) * u2)


def _weighted(u: Column, values: list, weights: list[float]) -> Column:
    edges, total = [], 0.0
    for w in weights[:-1]:
        total += w
        edges.append(total)
    out = F.when(u < edges[0], F.lit(values[0]))
    for edge, v in zip(edges[1:], values[1:-1]):
        out = out.when(u < edge, F.lit(v))
    return out.otherwise(F.lit(values[-1]))


def generate_loans(keys: DataFrame, key: str = "id", seed: int = 42) -> DataFrame:
    """Canonical loans for the given whole-number keys; about 15 % default.

    Every draw is a hash of seed and key, so a row does not depend on the others, on
    the partitioning or on retries. ``spark.range(1, n + 1)`` gives ``n`` loans.
    """
    k = F.col(key)
    blocks = keys.select(k.alias("k"), *[_digest(k, seed, b).alias(f"d{b}") for b in range(6)])
    draws = blocks.select(
        "k", *[u.alias(f"u{4 * b + i}") for b in range(6) for i, u in enumerate(_uniforms(F.col(f"d{b}")))]
    )
    u = [F.col(f"u{i}") for i in range(24)]
    amount_mean, amount_sd, amount_low, amount_high = AMOUNT
    income_mean, income_sd, income_low, income_high = INCOME
    score_mean, score_sd, score_low, score_high = SCORE
    beta_2_5 = F.array_sort(F.array(*u[8:14]))[1]
    base = draws.select(
        "k",
        clip(F.exp(F.lit(amount_mean) + amount_sd * _normal(u[0], u[1])), amount_low, amount_high).alias("amount"),
        clip(F.exp(F.lit(income_mean) + income_sd * _normal(u[2], u[3])), income_low, income_high).alias("income"),
        F.floor(u[4] * 31).alias("employment_years"),
        clip(F.lit(score_mean) + score_sd * _normal(u[5], u[6]), score_low, score_high).cast("long").alias("credit_score"),
        clip(beta_2_5, 0.01, 0.99).alias("dti"),
        (F.floor(u[7] * 19) + 1).alias("num_open_accounts"),
        clip(F.floor(F.log(u[14]) / F.log(F.lit(1 - DELINQUENCY_SUCCESS))), 0, 10).alias("num_delinquencies"),
        _weighted(u[15], S.LOAN_PURPOSES, PURPOSE_WEIGHTS).alias("loan_purpose"),
        _weighted(u[16], S.HOME_OWNERSHIP, OWNERSHIP_WEIGHTS).alias("home_ownership"),
        _weighted(u[17], S.LOAN_TERMS, TERM_WEIGHTS).cast("long").alias("loan_term_months"),
        (_normal(u[18], u[19]) * 0.5).alias("noise"),
        u[20].alias("draw"),
    )
    odds = reduce(
        lambda a, b: a + b,
        [
            F.lit(INTERCEPT),
            (F.col("dti") - 0.3) * 0.8,
            (F.col("credit_score") - 680) * -0.008,
            F.col("num_delinquencies") * 0.5,
            F.col("employment_years") * -0.03,
            (F.col("amount") / F.col("income") - 0.3) * 0.2,
            F.col("noise"),
        ],
    )
    return base.select(
        format_loan_id(F.col("k")).alias("loan_id"),
        round_half_even(F.col("amount"), 2).alias("loan_amount"),
        round_half_even(F.col("income"), 2).alias("annual_income"),
        "employment_years",
        "credit_score",
        round_half_even(F.col("dti"), 4).alias("debt_to_income_ratio"),
        "num_open_accounts",
        "num_delinquencies",
        "loan_purpose",
        "home_ownership",
        "loan_term_months",
        F.when(F.col("draw") < sigmoid(odds), 1).otherwise(0).cast("long").alias("loan_default"),
    )
