"""Keyed upsert as a DataFrame computation (K6, K7).

Spark has no ``MERGE INTO`` for plain parquet tables, so an upsert computes the next
version of the table: ``upsert_frames(base, changes, ...)`` returns the rows to write.

Semantics (rows applied in ``order_col`` order, as sequential ``INSERT ... ON CONFLICT``):

* several changes for one key: the last one wins, also when its value is null
  (``max_by`` of a struct keeps a null field of the winning row);
* ``update_cols`` given (K7): a stored key only gets those columns updated, the other
  stored columns stay; a new key takes the insert-only columns from its first change and
  the update columns from its last;
* changes with a null key are rejected into a separate frame (a primary key refuses them).

A null ``order_col`` is the lowest order: such a change loses to any ordered one of its key.

Plan shape: one full outer join of the base and the deduped changes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def split_null_keys(changes: DataFrame, keys) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)``: rows with a complete key, rows with a null key part."""
    ks = _keys(keys)
    null_any = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in ks])
    return changes.where(~null_any), changes.where(null_any)


def last_per_key(changes: DataFrame, keys, order_col: str | None,
                 update_cols: list[str], insert_cols: list[str]) -> DataFrame:
    """One row per key: update columns of the last change, insert columns of the first.

    ``max_by``/``min_by`` are combinable aggregates: a hot key is reduced map-side.
    Without ``order_col`` the greatest row wins (deterministic, order-free).
    """
    ks = _keys(keys)
    upd = F.struct(*[F.col(c) for c in update_cols]) if update_cols else F.struct(F.lit(0).alias("_"))
    ins = F.struct(*[F.col(c) for c in insert_cols]) if insert_cols else F.struct(F.lit(0).alias("_"))
    if order_col:
        # max_by skips null orders, so the order is a struct whose first field puts them lowest
        # and whose last field, the row itself, decides between equal orders
        at = [F.col(order_col).isNotNull().alias("has"), F.col(order_col).alias("at")]
        aggs = [F.max_by(upd, F.struct(*at, upd.alias("row"))).alias("_rl_u"),
                F.min_by(ins, F.struct(*at, ins.alias("row"))).alias("_rl_i")]
    else:
        aggs = [F.max(upd).alias("_rl_u"), F.min(ins).alias("_rl_i")]
    grouped = changes.groupBy(*ks).agg(*aggs)
    cols = [F.col(k) for k in ks]
    cols += [F.col(f"_rl_u.{c}").alias(c) for c in update_cols]
    cols += [F.col(f"_rl_i.{c}").alias(c) for c in insert_cols]
    return grouped.select(*cols)


def upsert_frames(base: DataFrame, changes: DataFrame, keys, order_col: str | None = None,
                  update_cols: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Next table version after applying ``changes`` to ``base``; ``(result, rejected)``.

    ``update_cols=None`` updates every non-key column (K6); a list updates only those (K7).
    """
    ks = _keys(keys)
    columns = base.columns
    value_cols = [c for c in columns if c not in ks]
    upd = list(value_cols if update_cols is None else update_cols)
    ins = [c for c in value_cols if c not in upd]
    valid, rejected = split_null_keys(changes, ks)
    last = last_per_key(valid.select(*ks, *upd, *ins, *([order_col] if order_col else [])),
                        ks, order_col, upd, ins)
    typed = [F.col(c).cast(base.schema[c].dataType).alias(c) for c in columns]
    old = base.select(*ks, *[F.col(c).alias(f"_rl_old_{c}") for c in value_cols], F.lit(True).alias("_rl_base"))
    new = last.select(*ks, *[F.col(c).alias(f"_rl_new_{c}") for c in value_cols], F.lit(True).alias("_rl_hit"))
    j = old.join(new, ks, "full")
    out = [F.col(k) for k in ks]
    for c in value_cols:
        if c in upd:   # a matched or new key takes the change, a null value included
            out.append(F.when(F.col("_rl_hit"), F.col(f"_rl_new_{c}")).otherwise(F.col(f"_rl_old_{c}")).alias(c))
        else:          # insert-only column: kept for stored keys, from the first change for new ones
            out.append(F.when(F.col("_rl_base"), F.col(f"_rl_old_{c}")).otherwise(F.col(f"_rl_new_{c}")).alias(c))
    return j.select(*out).select(*typed), rejected
