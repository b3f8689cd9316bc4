"""Manipulation of result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_OPS = {
    "==": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "in": lambda c, v: c.isin(*v),
    "not_in": lambda c, v: ~c.isin(*v),
    "is_null": lambda c, _: c.isNull(),
    "not_null": lambda c, _: c.isNotNull(),
    "between": lambda c, v: c.between(*v),
    "value_bin": lambda c, v: (c >= v[0]) & (c < v[1]),
}


def predicate(tree: dict) -> Column:
    """A column from a tree of {"and": [...]}, {"or": [...]} and {"var", "op", "value"}."""
    for join, op in (("and", lambda a, b: a & b), ("or", lambda a, b: a | b)):
        if join in tree:
            parts = [predicate(t) for t in tree[join]]
            if not parts:
                raise ValueError(f"an empty {join} group")
            out = parts[0]
            for p in parts[1:]:
                out = op(out, p)
            return out
    if tree["op"] not in _OPS:
        raise ValueError(f"no such operator: {tree['op']}")
    return _OPS[tree["op"]](F.col(tree["var"]), tree.get("value"))


def select(df: DataFrame, columns: dict[str, str] | Sequence[str]) -> DataFrame:
    """Columns, or new names with the columns they rename."""
    return df.select(*[F.col(old).alias(new) for new, old in columns.items()]) if isinstance(columns, dict) else df.select(*columns)


def where(df: DataFrame, tree: dict) -> DataFrame:
    return df.where(predicate(tree))


def merge(left: DataFrame, right: DataFrame, by: Sequence[str], how: str = "inner", many: bool = False) -> DataFrame:
    """An equi-join; unless ``many``, keys that are not unique on the right are an error."""
    if not many and not right.groupBy(*by).count().where("count > 1").isEmpty():
        raise ValueError("keys of the right table are not unique")
    return left.join(right, list(by), how)


def bind(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
