"""Small Column helpers for expressions built from higher-order functions."""

from pyspark.sql import Column, DataFrame, functions as F


def let(value: Column, body) -> Column:
    """``body(value)`` with `value` evaluated once.

    Inside a lambda, a repeated sub-expression is evaluated at every use. A one-element
    transform binds it to a lambda variable instead.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def running_totals(values: Column) -> Column:
    """0 and the prefix sums of an array<bigint>, so one element more than `values`."""
    return F.aggregate(
        values, F.array(F.lit(0).cast("bigint")),
        lambda acc, v: F.concat(acc, F.array(F.element_at(acc, -1) + v)))


def one_row_each(df: DataFrame, keep, array: Column, name: str) -> DataFrame:
    """`keep` and one row per element of `array`; rows with no element are dropped.

    A plain explode gets a filter "array is not empty" from the optimizer, which is pushed
    down and evaluates the array a second time. The outer form does not.
    """
    return df.select(*keep, F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())
