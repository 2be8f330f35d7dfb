"""Column helpers: ladders, flags, money and exact ratios.  All stay inside codegen."""

from __future__ import annotations

import operator
from collections.abc import Iterable
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.rules import Groups, Ladder

_COMPARE = {
    "<": operator.lt,
    "<=": operator.le,
    "=": operator.eq,
    ">=": operator.ge,
    ">": operator.gt,
}

MONEY = "decimal(10,2)"
NO_MONEY = Decimal("0.00")


def first_match(branches: Iterable[tuple[Column, str]], otherwise: Column | str) -> Column:
    """Label of the first condition that is true; NULL conditions fall through."""
    branches = list(branches)
    condition, label = branches[0]
    start = F.when(condition, F.lit(label))
    chained = reduce(lambda acc, branch: acc.when(branch[0], F.lit(branch[1])), branches[1:], start)
    return chained.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))


def steps(value: Column, rule_steps) -> list[tuple[Column, str]]:
    return [(_COMPARE[sign](value, F.lit(bound)), label) for sign, bound, label in rule_steps]


def ladder(value: Column, rule: Ladder) -> Column:
    return first_match(steps(value, rule.steps), rule.otherwise)


def grouped(value: Column, rule: Groups) -> Column:
    return first_match([(value.isin(*members), label) for members, label in rule.groups], rule.otherwise)


def flag(condition: Column) -> Column:
    """TRUE only where the condition is true: a NULL condition is FALSE."""
    return F.coalesce(condition, F.lit(False))


def money(value: Column) -> Column:
    return value.cast(MONEY)


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def or_no_money(value: Column) -> Column:
    """Zero of a decimal type, so the filled column keeps its precision."""
    return F.coalesce(value, F.lit(NO_MONEY))


def money_sum(value: Column) -> Column:
    """Sum of a DECIMAL(10,2) expression as DECIMAL(20,2), added up in whole cents.

    Longs are several times cheaper to add, buffer and shuffle than 20-digit decimals.
    Nothing is lost below 9e16 units of currency in one group, where the sum raises.
    """
    return (F.sum((value * 100).cast("bigint")) * F.lit(Decimal("0.01"))).cast("decimal(20,2)")


def quotient(numerator: Column, denominator: Column) -> Column:
    """Division of money, kept to 8 places, half up; NULL for a zero denominator."""
    return (numerator / F.nullif(denominator, F.lit(0))).cast("decimal(18,8)")


def percent(part: Column, whole: Column) -> Column:
    return F.round(quotient(part, whole) * F.lit(Decimal(100)), 2).cast("decimal(18,2)")


def share_of(amount: Column, hundredths: Column) -> Column:
    """``amount * hundredths / 100`` without a division, rounded half up to cents."""
    return F.round(amount * hundredths * F.lit(Decimal("0.01")), 2).cast("decimal(18,2)")
