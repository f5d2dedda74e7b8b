"""Bloom filters as rows: a short set of keys prunes a long history before it is shuffled.

The filter is a small table of blocks of eight 64-bit words. A key belongs to one block and sets one
bit in each of its words, so filters are built by ``bit_or`` with partial aggregation and looked up by
one broadcast join on the block number, all inside generated code.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaymill.session import BROADCAST_LIMIT_BYTES

WORDS = 8
#: 512 bits a block, 16 bits a key: some 0.3 % of foreign keys pass.
KEYS_PER_BLOCK = 32
#: What a block takes in a broadcast relation, at most: nine longs, row header and hash slot.
BLOCK_BYTES = 128

#: Types whose equal values hash alike; floats (-0.0) and collated text are not among them.
HASHABLE = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.DateType,
    T.TimestampType, T.TimestampNTZType, T.BinaryType, T.BooleanType,
)


def prunable(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> bool:
    """Whether the keys have one type on both sides and equal values hash alike."""
    types = [(left.schema[k].dataType, right.schema[k].dataType) for k in keys]
    return all(a == b and (isinstance(a, HASHABLE) or a == T.StringType()) for a, b in types)


def block_count(n_keys: int) -> int:
    return max(1, -(-n_keys // KEYS_PER_BLOCK))


def _block(keys: Sequence[str], blocks: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(blocks).cast("bigint"))


def _mask(bits: str, word: int) -> Column:
    """One bit of a word, chosen by six bits of the key's second hash."""
    place = F.shiftright(bits, 6 * word).bitwiseAND(63).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)


def _hashed(df: DataFrame, keys: Sequence[str], blocks: int) -> DataFrame:
    second = F.xxhash64(F.lit("bits"), *keys)
    return df.withColumns({"_block": _block(keys, blocks), "_bits": second})


def bloom_filter(df: DataFrame, keys: Sequence[str], blocks: int) -> DataFrame:
    """The blocks that ``df``'s keys set bits in: ``_block`` and words ``_w0`` to ``_w7``."""
    words = [F.bit_or(_mask("_bits", i)).alias(f"_w{i}") for i in range(WORDS)]
    return _hashed(df.select(*keys), keys, blocks).groupBy("_block").agg(*words)


def possible_matches(
    history: DataFrame,
    few: DataFrame,
    keys: Sequence[str],
    n_keys: int,
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Rows of ``history`` whose key may be among the keys of ``few``; no row that matches is lost.

    ``n_keys`` bounds the distinct keys of ``few`` and so the filter's size. Where the filter would
    outgrow ``limit_bytes``, or a key's type differs or does not hash, the history is given as it
    is. ``few`` is read once more; let it be a stored table. NULL keys hash like any other value.
    """
    keys, blocks = list(keys), block_count(n_keys)
    if blocks * BLOCK_BYTES > limit_bytes or not prunable(history, few, keys):
        return history
    found = F.broadcast(bloom_filter(few, keys, blocks))
    held = [F.col(f"_w{i}").bitwiseAND(_mask("_bits", i)) != 0 for i in range(WORDS)]
    joined = _hashed(history, keys, blocks).join(found, "_block")
    return joined.filter(reduce(and_, held)).select(*history.columns)
