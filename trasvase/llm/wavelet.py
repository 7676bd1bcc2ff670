"""Token shards as wavelet matrices.

A shard is one compressed file: the ids and lengths of its documents, and a wavelet matrix of their token ids. The matrix
has one plane of bits per bit of an id, highest first; each plane is ordered stably by the plane above it. With counts of
ones per block of bits, a token can be read at any place, counted in any range and found by its number, without decoding
the rest.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trasvase.llm import exchange as ex
from trasvase.llm.substring_dedup import _in_order
from trasvase.llm.tokens import encoder, line_of
from trasvase.session import scratch_path

#: Bits counted together in a plane's directory; first bytes of a file; id that ends a document.
BLOCK, MAGIC, END = 512, b"WVM1", 0


class WaveletMatrix:
    """Planes (bit arrays), zeros per plane, and ones before each block of each plane."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int], ranks: list[np.ndarray]):
        self.n, self.planes, self.zeros, self.ranks = n, planes, zeros, ranks

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        levels = max(1, int(ids.max(initial=0)).bit_length())
        planes, zeros, ranks = [], [], []
        now, other = ids.copy(), np.empty_like(ids)  # in turn: a plane's order and the next
        for level in reversed(range(levels)):
            bits = (now & now.dtype.type(1 << level)).astype(bool)
            planes.append(np.packbits(bits))
            zeros.append(len(bits) - int(np.count_nonzero(bits)))
            np.compress(~bits, now, out=other[: zeros[-1]])
            np.compress(bits, now, out=other[zeros[-1] :])
            now, other = other, now
            ranks.append(_directory(planes[-1]))
        return cls(len(ids), planes, zeros, ranks)

    def to_bytes(self) -> bytes:
        out = [struct.pack("<QB", self.n, len(self.planes))]
        for plane, zeros, ranks in zip(self.planes, self.zeros, self.ranks):
            for part in (plane.tobytes(), np.diff(ranks, prepend=0).astype("<u2").tobytes()):
                packed = zstandard.compress(part, 1)
                out += [struct.pack("<QI", zeros, len(packed)), packed]
        return b"".join(out)

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        n, levels = struct.unpack_from("<QB", data)
        at, planes, zeros, ranks = 9, [], [], []
        for k in range(2 * levels):
            zero, size = struct.unpack_from("<QI", data, at)
            part = zstandard.decompress(data[at + 12 : at + 12 + size]) if n else b""
            at += 12 + size
            if k % 2:
                ranks.append(np.cumsum(np.frombuffer(part, "<u2"), dtype=np.int64))
            else:
                planes.append(np.frombuffer(part, np.uint8))
                zeros.append(zero)
        return cls(n, planes, zeros, ranks)

    def _ones(self, level: int, i: int) -> int:
        """Ones in the first ``i`` bits of a plane."""
        block, plane = i // BLOCK, self.planes[level]
        whole = plane[block * BLOCK // 8 : i // 8]
        count = int(self.ranks[level][block]) if block < len(self.ranks[level]) else 0
        if block >= len(self.ranks[level]):  # just past the last block
            return self.n - self.zeros[level]
        count += int(np.bitwise_count(whole).sum())
        return count + (int(plane[i // 8]) >> (8 - i % 8)).bit_count() if i % 8 else count

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i // 8]) >> (7 - i % 8) & 1

    def access(self, i: int) -> int:
        """Token at place ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        token = 0
        for level, zeros in enumerate(self.zeros):
            bit = self._bit(level, i)
            ones = self._ones(level, i)
            i = zeros + ones if bit else i - ones
            token = token << 1 | bit
        return token

    def _range(self, token: int, start: int, end: int) -> tuple[int, int]:
        if token < 0 or token.bit_length() > len(self.planes):
            return 0, 0
        for level, zeros in enumerate(self.zeros):
            a, b = self._ones(level, start), self._ones(level, end)
            start, end = (zeros + a, zeros + b) if token >> (len(self.planes) - 1 - level) & 1 else (start - a, end - b)
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of a token in places ``start`` to ``end``."""
        a, b = self._range(token, start, self.n if end is None else end)
        return b - a

    def _select(self, level: int, bit: int, k: int) -> int:
        """Place of the ``k``-th (from 0) bit of that value in a plane."""
        low, high = 0, self.n
        while low < high:
            mid = (low + high) // 2
            ones = self._ones(level, mid + 1)
            low, high = (mid + 1, high) if (ones if bit else mid + 1 - ones) <= k else (low, mid)
        return low

    def select(self, token: int, k: int) -> int:
        """Place of the ``k``-th (from 0) occurrence of a token."""
        a, b = self._range(token, 0, self.n)
        if not 0 <= k < b - a:
            raise IndexError(k)
        i = a + k
        for level in reversed(range(len(self.planes))):
            bit = token >> (len(self.planes) - 1 - level) & 1
            i = self._select(level, bit, i - self.zeros[level] if bit else i)
        return i

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]

    def decode(self) -> np.ndarray:
        """All tokens in order, plane by plane from the last."""
        now = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for level in reversed(range(len(self.planes))):
            bits = np.unpackbits(self.planes[level], count=self.n).astype(bool)
            above = np.empty_like(now)
            above[~bits], above[bits] = now[: self.zeros[level]], now[self.zeros[level] :] | now.dtype.type(1 << (len(self.planes) - 1 - level))
            now = above
        return now


def _directory(plane: np.ndarray) -> np.ndarray:
    """Ones before each block of a plane."""
    counts = np.bitwise_count(plane)
    sums = np.add.reduceat(counts, np.arange(0, len(counts), BLOCK // 8), dtype=np.int64) if len(counts) else np.zeros(0, np.int64)
    return np.concatenate([[0], np.cumsum(sums)[:-1]]).astype(np.int64)[: len(sums)]


def shard_file(doc_ids: pa.Array, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """One compressed file: document ids and lengths, then the matrix."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, pa.schema([("doc_id", doc_ids.type), ("length", pa.int64())])) as out:
        out.write_batch(pa.record_batch([doc_ids, pa.array(lengths, pa.int64())], names=["doc_id", "length"]))
    head = zstandard.compress(sink.getvalue().to_pybytes(), 3)
    return MAGIC + struct.pack("<I", len(head)) + head + WaveletMatrix.build(ids).to_bytes()


def open_shard(data: bytes) -> tuple[pa.Array, np.ndarray, WaveletMatrix]:
    """Document ids, their lengths in tokens, and the matrix of a file."""
    if data[:4] != MAGIC:
        raise ValueError("not a token shard")
    (size,) = struct.unpack_from("<I", data, 4)
    head = pa.ipc.open_stream(zstandard.decompress(data[8 : 8 + size])).read_all()
    return head["doc_id"].combine_chunks(), head["length"].to_numpy(), WaveletMatrix.from_bytes(data[8 + size :])


def _encode(path: str):
    def encode(table: pa.Table) -> pa.Table:
        table = _in_order(table)
        ids, lengths = line_of(table["text"], encoder(path), END)
        data = shard_file(table["doc_id"].combine_chunks(), lengths, ids)
        return pa.table({"shard": table["_chunk"][:1], "tokens": pa.array([len(ids)], pa.int64()), "file": pa.array([data], pa.binary())})

    return encode


def write_shards(docs: DataFrame, tokenizer: str, folder: str) -> None:
    """Write the token shards of ``docs`` (doc_id, text) to a folder that all executors reach.

    Shards follow ascending doc_id (null first), and so do documents within; rows with one doc_id go by their texts. A null
    or empty text has the end id only. Other columns are ignored.
    """
    plain = docs.select("doc_id", "text")
    chunked, _ = ex.in_chunks(plain, ex.corpus_bytes(plain))
    files = chunked.groupBy("_chunk").applyInArrow(ex.handing_back(_encode(tokenizer)), "shard int, tokens long, file binary")
    files.write.option("compression", "uncompressed").parquet(folder)


def _read(id_type: pa.DataType):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, data in zip(batch["shard"].to_pylist(), batch["file"]):
                ids, lengths, matrix = open_shard(data.as_py())
                tokens = matrix.decode()
                ends = np.cumsum(lengths)
                sums = [zlib.crc32(tokens[b - n : b].astype("<u4")) for n, b in zip(lengths.tolist(), ends.tolist())]
                yield pa.record_batch(
                    {
                        "shard": pa.array([shard] * len(sums), pa.int32()),
                        "doc_id": ids.cast(id_type),
                        "place": pa.array(ends - lengths, pa.int64()),
                        "n_tokens": pa.array(lengths, pa.int64()),
                        "ids_crc32": pa.array(sums, pa.int64()),
                    }
                )

    return read


def read_shards(files: DataFrame, id_type: str = "bigint") -> DataFrame:
    """Per document of the shard files: doc_id, start, n_tokens, ids_crc32."""
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    rows = files.select("shard", "file").mapInArrow(_read(kinds[id_type]), f"shard int, doc_id {id_type}, place long, n_tokens long, ids_crc32 long")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one number a shard
    starts = files.select("shard", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("before"))
    return rows.join(starts, "shard").select("doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


def token_shards(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write ``docs`` as token shards in the shared folder and give each document's place and checksum from the files."""
    spark, folder = docs.sparkSession, scratch_path(docs.sparkSession, "token-shards")
    write_shards(docs, tokenizer, folder)
    return read_shards(spark.read.schema("shard int, tokens long, file binary").parquet(folder), dict(docs.dtypes)["doc_id"])
