"""Bloom filter as a table: which rows may hold a key of a smaller table, decided before any shuffle.

A key hashes to one slot of 64 bits and to PROBES bits in it.  The bits of all keys are or-ed per slot on the map side, so the filter is built by
one small aggregate and never passes through the driver as a whole.  Rows are probed by a broadcast join on the slot: the
filter is broadcast only while its counted slots stay within ``max_slots`` (about 24 bytes each); beyond that the rows are returned as they are.
A filter has no false negatives; hits are to be verified by an exact join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

#: Bits set per key, bits of the filter per key (some one to two percent of other rows pass), slots that may be broadcast.
PROBES = 4
BITS_PER_KEY = 16
MAX_SLOTS = 4_000_000


def _slot(keys: Sequence[str], slots: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(slots))


def _mask(keys: Sequence[str]) -> Column:
    """PROBES bits of 64, six bits of a second hash each."""
    other = F.xxhash64(*keys, F.lit("mask"))
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(other, 6 * k).bitwiseAND(63).cast("int")) for k in range(PROBES)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def bloom_filter(table: DataFrame, keys: Sequence[str], bits_per_key: int = BITS_PER_KEY) -> tuple[DataFrame, int]:
    """(slot, bits) of the distinct keys of ``table``, and the number of slots hashed to."""
    slots = max(1, -(-table.count() * bits_per_key // 64))
    return table.groupBy(_slot(keys, slots).alias("__slot")).agg(F.bit_or(_mask(keys)).alias("__bits")), slots


def may_hold(rows: DataFrame, table: DataFrame, keys: Sequence[str], max_slots: int = MAX_SLOTS) -> DataFrame:
    """Rows whose key may be in ``table``, which should hold each key once; all rows if the filter would be too large to broadcast."""
    bits, slots = bloom_filter(table, keys)
    if slots > max_slots:
        return rows
    hashed = rows.withColumns({"__own_slot": _slot(keys, slots), "__mask": _mask(keys)})
    hit = (F.col("__own_slot") == F.col("__slot")) & (F.col("__bits").bitwiseAND(F.col("__mask")) == F.col("__mask"))
    return hashed.join(F.broadcast(bits), hit, "left_semi").select(*rows.columns)
