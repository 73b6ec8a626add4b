"""Lookups that every task holds whole, in bounded memory: an exact index of a code list, a Bloom filter of a set of keys.

Both are one stored row, read by a scalar subquery, so a lookup is an expression in the scan stage: no join, no exchange, no Python.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from claimtrail.sources.scratch import settle

MAX_INDEX_BYTES = 8 << 20  # of codes, with what each takes beside its text
_ENTRY = 32

MIN_BITS, MAX_BITS = 1 << 16, 1 << 26  # of a Bloom filter: 8 KB to 8 MB
BITS_PER_KEY = 10  # wanted: about 1 key in 100 passes wrongly
LEAST_BITS = 5  # with fewer, over one key in ten passes wrongly and the filter isn't worth its cost
PROBES = 5


def _power(n: int, least: int) -> int:
    return max(least, 1 << max(0, n - 1).bit_length())


@dataclass(frozen=True)
class CodeIndex:
    """Codes in hashed buckets, about one to a bucket."""

    table: DataFrame  # one row: an array of buckets
    buckets: int
    lengths: tuple[int, ...]

    def holds(self, text: Column) -> Column:
        """The text is one of the codes; never NULL."""
        bucket = F.get(self.table.scalar(), F.pmod(F.xxhash64(text), F.lit(self.buckets)).cast("int"))
        return F.coalesce(F.array_contains(bucket, text), F.lit(False))


def code_index(codes: DataFrame, max_bytes: int = MAX_INDEX_BYTES) -> CodeIndex | None:
    """Index of a stored list of distinct codes (its first column, text), or ``None`` if it takes more than ``max_bytes``."""
    code = F.col(codes.columns[0])
    size = F.sum(F.octet_length(code) + _ENTRY)
    count, taken, lengths = codes.agg(F.count(code), F.coalesce(size, F.lit(0)), F.collect_set(F.length(code))).first()
    if taken > max_bytes:
        return None
    buckets = _power(count, 1)
    held = codes.groupBy(F.pmod(F.xxhash64(code), F.lit(buckets)).alias("b")).agg(F.collect_list(code).alias("held"))
    every = codes.sparkSession.range(buckets).select(F.col("id").alias("b")).join(held, "b", "left")
    ordered = F.sort_array(F.collect_list(F.struct("b", "held")))
    table = settle(every.agg(ordered.alias("_all")).select(F.col("_all.held").alias("buckets")), "code-index")
    return CodeIndex(table, buckets, tuple(sorted(lengths)))


def common_types(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> list[T.DataType]:
    """The types in which an equi-join compares its keys."""
    null = lambda df, key: F.lit(None).cast(df.schema[key].dataType)
    return [left.sparkSession.range(0).select(F.coalesce(null(left, k), null(right, k)).alias("k")).schema["k"].dataType for k in keys]


def key_hash(keys: Sequence[str], kinds: Sequence[T.DataType]) -> Column:
    """64 bits of the keys, alike on both sides of a join."""
    return F.xxhash64(*[F.col(k).cast(kind) for k, kind in zip(keys, kinds)])


def _places(hashed: Column, bits: int) -> list[Column]:
    """Bits that stand for a hash: its halves, the second added again and again."""
    low, high = hashed.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(hashed, 32).bitwiseOR(F.lit(1))
    return [(low + high * F.lit(i)).bitwiseAND(F.lit(bits - 1)) for i in range(PROBES)]


@dataclass(frozen=True)
class KeyFilter:
    """Bloom filter of a set of hashed keys: false only for keys that aren't in it."""

    table: DataFrame  # one row: the bits, 64 to a number
    bits: int

    def may_hold(self, hashed: Column) -> Column:
        words = self.table.scalar()
        tests = [F.getbit(F.get(words, F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1 for p in _places(hashed, self.bits)]
        return reduce(lambda a, b: a & b, tests)


def key_filter(hashes: DataFrame, max_bits: int = MAX_BITS) -> KeyFilter | None:
    """Filter of a stored column of hashed keys, or ``None`` where so many keys would fill ``max_bits``."""
    name = hashes.columns[0]
    count = hashes.count()
    bits = min(_power(count * BITS_PER_KEY, MIN_BITS), max_bits)
    if count * LEAST_BITS > bits:
        return None
    places = hashes.select(F.explode(F.array(*_places(F.col(name), bits))).alias("p"))
    word = F.shiftright("p", 6).alias("w")
    bit = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("p").bitwiseAND(F.lit(63)).cast("int"))).alias("set")
    held = places.groupBy(word).agg(bit)
    every = hashes.sparkSession.range(bits // 64).select(F.col("id").alias("w")).join(held, "w", "left")
    ordered = F.sort_array(F.collect_list(F.struct("w", F.coalesce("set", F.lit(0)).alias("set"))))
    return KeyFilter(settle(every.agg(ordered.alias("_all")).select(F.col("_all.set").alias("words")), "key-filter"), bits)
