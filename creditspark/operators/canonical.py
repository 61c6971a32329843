"""Raw card-account table to the canonical loan table, as one narrow projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from creditspark import schema as S
from creditspark.functions.loan import format_loan_id
from creditspark.functions.numeric import clip, count_where, round_half_even, to_number
from creditspark.operators.columns import column_or, lookup, resolve_column

BILL_NAMES = ["bill_amt1", "bill_amt_1", "bill_amt"]
TARGET_NAMES = [
    "default_payment_next_month",
    "default-payment-next-month",
    "y",
    "default",
    "class",
]


def status_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("pay_") and not c.startswith("pay_amt")]


def payment_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("pay_amt")]


def payment_score(status: list[str]) -> Column:
    """300 + 550 x share of months paid on time, truncated; 650 without history."""
    if not status:
        return F.lit(650).cast("long")
    on_time = count_where([F.col(c) <= 0 for c in status])
    return clip(F.lit(300) + F.lit(550) * (on_time / F.lit(len(status))), 300.0, 850.0).cast("long")


def months_late(status: list[str]) -> Column:
    return clip(count_where([F.col(c) > 0 for c in status]), 0, 50).cast("long")


def months_paid(paid: list[str]) -> Column:
    return clip(count_where([F.col(c) > 0 for c in paid]), 1, 100).cast("long")


def income_proxy(limit: Column) -> Column:
    """Three times the unbounded limit, then bounded and rounded to cents."""
    return round_half_even(clip(limit * 3, 1_000.0, 10_000_000.0), 2)


def employment_years(age: Column) -> Column:
    return clip(age - 22, 0.0, 50.0).cast("long")


def debt_ratio(bill: Column, income: Column) -> Column:
    monthly = income / 12
    return round_half_even(clip(bill / F.when(monthly == 0, 1.0).otherwise(monthly), 0.0, 2.0), 4)


def loan_term(limit: Column) -> Column:
    return F.when(limit > 200_000, 60).otherwise(36).cast("long")


def canonicalize(df: DataFrame) -> DataFrame:
    """The twelve canonical columns from a card table with varying column names."""
    types = {f.name: f.dataType for f in df.schema.fields}
    id_name = resolve_column(df, ["id"], position=0)
    limit_name = resolve_column(df, ["limit_bal", "LIMIT_BAL"], ("limit",), 1)
    age_name = resolve_column(df, ["age", "AGE"], ("age",))
    bill_name = resolve_column(df, BILL_NAMES, ("bill", "amt"))
    edu_name = resolve_column(df, ["education", "EDUCATION"], ("edu",))
    marriage_name = resolve_column(df, ["marriage", "MARRIAGE"], ("marr",))
    target_name = resolve_column(df, TARGET_NAMES, position=-1)

    limit = to_number(column_or(df, limit_name, None), 10_000)
    income = income_proxy(limit)
    years = employment_years(to_number(column_or(df, age_name, None), 30))
    ratio = debt_ratio(to_number(column_or(df, bill_name, None), 0), income)
    return df.select(
        format_loan_id(F.col(f"`{id_name}`")).alias("loan_id"),
        round_half_even(clip(limit, 100.0, 100_000.0), 2).alias("loan_amount"),
        income.alias("annual_income"),
        (years if age_name else F.lit(5).cast("long")).alias("employment_years"),
        payment_score(status_columns(df)).alias("credit_score"),
        (ratio if bill_name else F.lit(0.3)).alias("debt_to_income_ratio"),
        months_paid(payment_columns(df)).alias("num_open_accounts"),
        months_late(status_columns(df)).alias("num_delinquencies"),
        (
            lookup(F.col(edu_name), types[edu_name], S.EDUCATION_TO_PURPOSE, "other")
            if edu_name
            else F.lit("debt_consolidation")
        ).alias("loan_purpose"),
        (
            lookup(F.col(marriage_name), types[marriage_name], S.MARRIAGE_TO_OWNERSHIP, "RENT")
            if marriage_name
            else F.lit("RENT")
        ).alias("home_ownership"),
        loan_term(limit).alias("loan_term_months"),
        to_number(F.col(f"`{target_name}`"), 0).cast("long").alias("loan_default"),
    )
