"""Helpers for expressions over arrays inside one row.

Longer array expressions are written as SQL text: one text is one call to the
JVM, while the same expression built from Column functions takes hundreds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    Higher-order functions re-evaluate whatever their lambda refers to for each
    element, and Catalyst may inline a projected column into that lambda.  A
    one-element ``transform`` binds the value instead.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def bind(value: Column, name: str, body: str) -> Column:
    """``let`` with the body as SQL text over ``name``."""
    bound = F.call_function("transform", F.array(value), F.expr(f"{name} -> {body}"))
    return F.get(bound, F.lit(0))


def sql_let(value: str, name: str, body: str) -> str:
    """``let`` with both parts as SQL text."""
    return f"transform(array({value}), {name} -> {body})[0]"


def sql_strings(words: Iterable[str]) -> str:
    """Comma-separated string literals."""
    escaped = (word.replace("\\", "\\\\").replace("'", "\\'") for word in words)
    return ", ".join(f"'{word}'" for word in escaped)


def sql_runs(keys: str, p: str) -> str:
    """Runs of equal values in a sorted array: ``array<struct<start, length>>``.

    ``p`` makes the variable names unique where expressions are nested.
    """
    ends = f"""filter(
        transform({p}k, ({p}x, {p}i) -> if({p}x <=> get({p}k, {p}i + 1), null, {p}i)),
        {p}i -> {p}i is not null)"""
    runs = f"""transform({p}e, ({p}x, {p}r) -> named_struct(
        'start', coalesce(get({p}e, {p}r - 1) + 1, 0),
        'length', {p}x - coalesce(get({p}e, {p}r - 1), -1)))"""
    return sql_let(keys, f"{p}k", sql_let(ends, f"{p}e", runs))


def total(array: Column) -> Column:
    """Sum of an ``array<double>``; 0.0 when empty."""
    return F.aggregate(array, F.lit(0.0), lambda acc, x: acc + x)
