"""Row-level loan expressions: features, decisions, labels and messages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from creditspark import schema as S
from creditspark.functions.numeric import clip, fixed


def loan_to_income(amount: Column, income: Column) -> Column:
    """amount / income within [0, 10]; zero or missing income gives 0."""
    ratio = F.coalesce(F.try_divide(amount.cast("double"), income.cast("double")), F.lit(0.0))
    return clip(ratio, 0.0, 10.0)


def log_floor0(c: Column) -> Column:
    """log(1 + max(x, 0)); null stays null."""
    return F.when(c.isNotNull(), F.log1p(F.greatest(c.cast("double"), F.lit(0.0))))


def score_band(
    score: Column,
    edges: list[float] = S.SCORE_BAND_EDGES,
    labels: list[str] = S.SCORE_BAND_LABELS,
    outside: str | None = "nan",
) -> Column:
    """Label of the left-closed interval holding the score, else ``outside``."""
    if len(edges) != len(labels) + 1:
        raise ValueError("need one more edge than labels")
    band = F.when(score.isNull() | (score < edges[0]), F.lit(outside))
    for upper, label in zip(edges[1:], labels):
        band = band.when(score < upper, F.lit(label))
    return band.otherwise(F.lit(outside))


def delinquency_flag(c: Column, threshold: int = 2) -> Column:
    return F.coalesce(c >= threshold, F.lit(False)).cast("int")


def format_loan_id(number: Column) -> Column:
    """``LOAN_`` and the number padded with zeros to at least seven digits."""
    digits = number.cast("long").cast("string")
    return F.concat(F.lit("LOAN_"), F.lpad(digits, F.greatest(F.lit(7), F.length(digits)), F.lit("0")))


def decision(probability: Column, threshold: float = 0.5) -> Column:
    return F.when(probability >= threshold, "REJECT").otherwise("APPROVE")


def confidence(probability: Column) -> Column:
    away = F.abs(probability - F.lit(0.5))
    return F.when(away >= 0.30, "HIGH").when(away >= 0.15, "MEDIUM").otherwise("LOW")


def risk_tier(probability: Column) -> Column:
    return (
        F.when(probability < 0.20, "LOW_RISK")
        .when(probability < 0.45, "MEDIUM_RISK")
        .when(probability < 0.70, "HIGH_RISK")
        .otherwise("VERY_HIGH_RISK")
    )


def factor_direction(contribution: Column) -> Column:
    return F.when(contribution > 0, "increases_risk").otherwise("decreases_risk")


def request_id(key: Column | None = None) -> Column:
    """``req_`` + 16 hex digits; derived from ``key`` when given, else random."""
    digits = F.md5(key.cast("string")) if key is not None else F.replace(F.uuid(), F.lit("-"), F.lit(""))
    return F.concat(F.lit("req_"), F.substring(digits, 1, 16))


def iso_timestamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def compact_timestamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd'T'HHmmss")


def date_path(ts: Column) -> Column:
    return F.date_format(ts, "yyyy/MM/dd")


def psi_message(severity: Column, feature: Column, value: Column, limit: Column) -> Column:
    """``<Severity> PSI drift on '<feature>': <value> > <limit>``, three decimals."""
    return F.concat(
        F.initcap(severity), F.lit(" PSI drift on '"), feature, F.lit("': "),
        fixed(value, 3), F.lit(" > "), fixed(limit, 3),
    )


def live_auc_message(value: Column, limit: Column) -> Column:
    return F.concat(F.lit("Live AUC "), fixed(value, 4), F.lit(" < threshold "), fixed(limit, 4))


def promotion_reason(test_auc: Column, threshold: float) -> Column:
    sign = F.when(test_auc >= threshold, "≥").otherwise("<")
    return F.concat(
        F.lit("Test AUC "), fixed(test_auc, 4), F.lit(" "), sign,
        F.lit(" threshold "), fixed(F.lit(float(threshold)), 4),
    )
