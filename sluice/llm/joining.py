"""Joins of rows with facts of their keys where one key may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .session import fresh_names

#: Keys with at least this share of the counted rows are salted; there are at most 1 / HOT_SHARE of them, so their list is broadcast.
HOT_SHARE, SALTS = 1 / 256, 64


def join_facts(rows: DataFrame, facts: DataFrame, key: str | list[str], n: str) -> DataFrame:
    """``rows`` left-joined with ``facts`` (one row for each key, with the number ``n`` of its rows), without the column n.

    Rows of the most frequent keys, and those without a key, are dealt to SALTS parts; facts of frequent keys are repeated in each.
    """
    keys = [key] if isinstance(key, str) else key
    hot, salt = fresh_names([*rows.columns, *facts.columns], "hot", "salt")
    total = facts.agg(F.sum(n)).first()[0] or 0
    often = F.col(n) >= F.greatest(F.lit(2), F.ceil(F.lit(HOT_SHARE * total)))
    every = F.array(*(F.lit(k) for k in range(SALTS)))
    salted = facts.withColumn(salt, F.explode(F.when(often, every).otherwise(F.array(F.lit(0))))).drop(n)
    frequent = facts.filter(often).select(*keys, F.lit(True).alias(hot))
    spread = F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int")
    missing = F.lit(False)
    for k in keys:
        missing |= F.col(k).isNull()
    marked = rows.join(F.broadcast(frequent), keys, "left").withColumn(salt, F.when(F.col(hot) | missing, spread).otherwise(0)).drop(hot)
    return marked.join(salted, [*keys, salt], "left").drop(salt)
