"""A long history cut to the keys of a batch before it is shuffled (for J1, J5, P6 and I1).

``new_rows(batch, cut_to_keys(history, batch, key), key)`` gives the rows of ``new_rows(batch, history, key)``, but
only the history's rows whose key may be in the batch reach the join's shuffle. The keys of the batch are marked
in a bitmap of fixed size, built by a combinable ``bit_or`` and broadcast as words of 64 bits: at most ``BITS / 64``
rows of two longs, however large the batch. What passes is the rows that match and a share of the others, about the
batch's keys over ``BITS`` (6 % at a million keys); the join after it is exact. A batch with many
more keys than bits lets everything pass and has paid for one more scan of its key columns.

The cut is a filter between scan and shuffle, with no shuffle of its own: both sides of the join that follows still come
straight from their shuffles, so AQE can split a hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of the bitmap: 262,144 words, under 10 MB as a broadcast relation.
BITS = 1 << 24

#: Types whose equal values hash alike. Others (floats, text under a collation, nested types) are not cut.
_HASHABLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType, T.DateType, T.TimestampType,
             T.TimestampNTZType, T.BinaryType, T.DecimalType)


def _slot(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(BITS))


def _cuttable(a: T.DataType, b: T.DataType) -> bool:
    return a == b and (isinstance(a, _HASHABLE) or a == T.StringType())


def key_words(batch: DataFrame, keys: list[str]) -> DataFrame:
    """The bitmap of the batch's keys: ``(_rl_word, _rl_bits)``, one row per word with a bit set. Null counts as a value."""
    marked = batch.select(_slot(keys).alias("_rl_slot"))
    return marked.groupBy(F.shiftright("_rl_slot", 6).alias("_rl_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(_rl_slot & 63 as int))")).alias("_rl_bits"))


def cut_to_keys(history: DataFrame, batch: DataFrame, keys) -> DataFrame:
    """Rows of ``history`` whose key may be in ``batch`` (null like any value): all that match, few others.

    Keys whose types differ, or have no hash that agrees with equality, are not cut: the history comes back as it is.
    """
    ks = [keys] if isinstance(keys, str) else list(keys)
    if not all(_cuttable(history.schema[k].dataType, batch.schema[k].dataType) for k in ks):
        return history
    slot = _slot(ks)
    hit = (F.shiftright(slot, 6) == F.col("_rl_word")) & (
        F.expr("_rl_bits").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))) != 0)
    return history.join(F.broadcast(key_words(batch, ks)), hit, "left_semi")
