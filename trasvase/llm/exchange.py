"""Chunks of documents in id order, and packed lists of hashes that chunks and hash ranges send each other.

A document's words are hashed inside the chunk that holds it. Chunks send sorted hashes, cut to as many bits as the corpus
needs and packed as differences, to the hash range that compares them; the range answers each chunk with the hashes that
matter there. So every window of the corpus is compared for one or two bytes of shuffle, no chunk or range holds more
than a fixed amount, and one frequent hash is one number a chunk.
"""

from __future__ import annotations

import ctypes
import inspect
import math
import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trasvase.session import stored

#: Bytes of text a chunk should have; hashes a range should have.
CHUNK_BYTES, RANGE_HASHES = 8 << 20, 1 << 19

#: Odd multipliers of the positions in a window.
_ODD = np.array([xxhash.xxh64_intdigest(b"window%d" % k) | 1 for k in range(64)], np.uint64)


def give_back() -> None:
    """Hands memory that is free back to the system, so that a reused worker does not keep what its largest group took."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def handing_back(group: Callable[..., pa.Table]) -> Callable[..., pa.Table]:
    """A function of a group (or of two that belong together) after which its memory is handed back."""

    def one(table: pa.Table) -> pa.Table:
        found = group(table)
        give_back()
        return found

    def two(left: pa.Table, right: pa.Table) -> pa.Table:
        found = group(left, right)
        give_back()
        return found

    return one if len(inspect.signature(group).parameters) == 1 else two


def corpus_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))))).first()[0] or 0


def in_chunks(docs: DataFrame, size: int) -> tuple[DataFrame, int]:
    """``docs`` with ``_chunk``, the number of a range of ascending doc_id (nulls are in the first), and how many there are.

    ``size`` is the bytes of text. An id's chunk is the whole ``CHUNK_BYTES`` of text of all smaller ids, so limits depend on
    the data alone; they are a number a chunk. All rows with one id, or with none, are in one chunk, whatever they take.
    """
    limits = chunk_limits(docs) if size > CHUNK_BYTES else []
    if not limits:
        return docs.withColumn("_chunk", F.lit(0)), 1
    held = F.array(*[F.lit(x) for x in limits])
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(limits).bit_length()))])
    found = F.aggregate(steps, F.lit(0), lambda a, s: F.when(F.get(held, a + s - 1) <= F.col("doc_id"), a + s).otherwise(a))
    return docs.withColumn("_chunk", F.coalesce(found, F.lit(0))), len(limits) + 1


def chunk_limits(docs: DataFrame) -> list:
    """The smallest id of each chunk but the first. Bytes are added up inside ranges of ids and over the ranges before."""
    sizes = docs.groupBy("doc_id").agg(F.sum(F.octet_length(F.coalesce("text", F.lit("")))).alias("_bytes"))
    sizes = stored(sizes.repartitionByRange("doc_id").withColumn("_range", F.spark_partition_id()), "sizes")
    ahead = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one number a range
    ranges = sizes.groupBy("_range").agg(F.sum("_bytes").alias("_all"))
    ranges = ranges.select("_range", F.coalesce(F.sum("_all").over(ahead), F.lit(0)).alias("_ahead"))
    smaller = Window.partitionBy("_range").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_ahead") + F.coalesce(F.sum("_bytes").over(smaller), F.lit(0))
    chunk = F.floor(before / CHUNK_BYTES).alias("_chunk")
    firsts = sizes.join(ranges, "_range").select("doc_id", chunk).groupBy("_chunk").agg(F.min("doc_id").alias("first"))
    return sorted(row[0] for row in firsts.filter("_chunk > 0 AND first IS NOT NULL").select("first").collect())


def bits_for(size: int) -> int:
    """Bits of a hash so that about one in a thousand windows of ``size`` bytes of text meets another by chance."""
    return min(63, max(24, math.ceil(math.log2(size / 4 + 2)) + 10))


def ranges_for(size: int) -> int:
    return max(1, math.ceil(size / 6 / RANGE_HASHES))


def range_of(hashes: np.ndarray, bits: int, ranges: int) -> np.ndarray:
    """Number of the hash range; it does not fall as the hash rises."""
    top = min(bits, 24)
    return ((hashes >> np.uint64(bits - top)) * np.uint64(ranges) >> np.uint64(top)).astype(np.int64)


def pack(sorted_hashes: np.ndarray) -> bytes:
    """Differences of sorted hashes, byte by byte of equal weight, compressed."""
    if not len(sorted_hashes):
        return b""
    steps = np.diff(sorted_hashes, prepend=np.uint64(0)).astype("<u8")
    width = max(1, (int(steps[1:].max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(steps[1:].view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + sorted_hashes[:1].astype("<u8").tobytes() + zstandard.compress(planes.tobytes(), 1)


def unpack(packed: bytes) -> np.ndarray:
    if not packed:
        return np.zeros(0, np.uint64)
    width = packed[0]
    planes = np.frombuffer(zstandard.decompress(packed[9:]), np.uint8).reshape(width, -1)
    steps = np.zeros((planes.shape[1] + 1, 8), np.uint8)
    steps[1:, :width] = planes.T
    steps[0] = np.frombuffer(packed[1:9], np.uint8)
    return np.cumsum(steps.reshape(-1).view("<u8"), dtype=np.uint64)


def pack_numbers(numbers: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(numbers).tobytes(), 1) if len(numbers) else b""


def unpack_numbers(packed: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(packed), kind) if packed else np.zeros(0, kind)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def window_hashes(hashes: np.ndarray, width: int, salt: int = 0) -> np.ndarray:
    """Hash of every window of ``width`` words; empty for fewer words."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, np.uint64(salt))
    for k in range(width):
        total += hashes[k : k + n] * _ODD[(k + 7 * salt) % 64]
    total ^= total >> np.uint64(31)
    return total * np.uint64(0x9E3779B97F4A7C15)


def member(hashes: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    """Whether each hash is in the sorted set."""
    if not len(sorted_set):
        return np.zeros(len(hashes), bool)
    at = np.searchsorted(sorted_set, hashes)
    return sorted_set[np.minimum(at, len(sorted_set) - 1)] == hashes
