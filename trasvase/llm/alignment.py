"""Alignment of two tokenizers' tokens, and in how many documents of the corpus each pair of ids is linked.

Both tokenizers cut the same bytes, so an A token and a B token are linked where their byte ranges overlap. The first pass
encodes every text once, stores the ids and counts, task by task, how many documents hold each pair. From the distinct
pairs a minimal perfect hash is built, bucket by bucket; it gives each pair a place in a dense vector of counts, and the
tasks' vectors are added up in a tree. The hash says nothing of pairs it does not know, so the keys are kept beside the
counts and compared. The second pass aligns the documents again and looks the counts up.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from trasvase.llm import exchange as ex
from trasvase.llm.tokens import PieceEncoder, Remembered, encoder, held_by_worker, slices
from trasvase.session import stored

#: Buckets of pairs, by A id: all pairs of an id are in one, and none can have more than its ids times the B vocabulary.
BUCKETS = 64
#: Tasks whose vectors are added at once; pairs looked up in one pass, 13 bytes each in a worker and as many for the hash.
FAN, LOOKED_UP = 16, 2_000_000
#: Pairs a task holds before it adds them up; token ids turned to text at once.
HELD, AT_ONCE = 1_000_000, 1 << 18
#: Bytes of A ids aligned at once.
ALIGNED_BYTES = 1 << 20

_BYTE, _SPACE = "<0x%02X>", "▁"


# ---------------------------------------------------------------- bytes of tokens


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for themselves, the rest in order from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


def byte_level_tokens(path: str) -> list[bytes]:
    """Bytes of each id of a byte-level vocabulary."""
    letters, vocabulary = _byte_letters(), encoder(path, True).tokenizer.get_vocab(with_added_tokens=True)
    found = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        found[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
    return found


def piece_tokens(model: SentencePieceProcessor) -> list[bytes]:
    """Bytes of each id of a vocabulary of pieces."""
    single = {_BYTE % b: bytes([b]) for b in range(256)}
    names = [model.id_to_piece(i) for i in range(model.vocab_size())]
    return [single[name] if name in single and model.is_byte(i) else name.replace(_SPACE, " ").encode() for i, name in enumerate(names)]


class ByteLevel:
    """Ids of whole texts by a byte-level file, as ordinary text, by its merges as ranks, which is the same and faster."""

    def __init__(self, path: str):
        self.whole, self.tokens = encoder(path, True).tokenizer, byte_level_tokens(path)
        model = json.loads(self.whole.to_str())["model"]
        merged = ["".join(pair.split(" ") if isinstance(pair, str) else pair) for pair in model["merges"]]
        first = len(model["vocab"]) - len(merged)
        if any(model["vocab"][token] != first + k for k, token in enumerate(merged)):
            raise ValueError("ids do not follow the order of the merges")
        ranks = {self.tokens[i]: i for i in model["vocab"].values()}
        self.ranked = tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        try:
            return self.ranked.encode_to_numpy(text).astype(np.uint16)
        except ValueError:  # its pattern gives up on a million spaces in a row
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint16)


class Tables:
    """Both vocabularies as bytes, and the length of each token."""

    def __init__(self, a: str, b: str):
        self.encode_a, self.encode_b = ByteLevel(a), PieceEncoder(b)
        self.bytes_b = piece_tokens(self.encode_b.model)
        self.length_a, self.length_b = (np.array([len(x) for x in t], np.int64) for t in (self.encode_a.tokens, self.bytes_b))
        self.pieces_of = Remembered(self._noted)
        self.odd: set[str] = set()

    def _noted(self, pieces: list[str]) -> list[bytes]:
        """B ids of pieces; those whose bytes are not given back are noted."""
        found = self.encode_b.ids(pieces)
        if self._joined(b"".join(found)) != "".join(pieces).encode():
            self.odd.update(piece for piece, ids in zip(pieces, found) if self._joined(ids) != piece.encode())
        return found

    def _joined(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_b.__getitem__, np.frombuffer(ids, np.uint16).tolist()))

    def ids(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both for each text; none if the bytes of either are not those of the text after a space."""
        none = np.zeros(0, np.uint16)
        cut = [self.encode_b.pieces(text) if text else [] for text in texts]
        held = iter(self.pieces_of([pieces for pieces in cut if pieces is not None]))
        out = []
        for text, pieces in zip(texts, cut):
            whole = (" " + text).encode() if text else b""
            a = self.encode_a(" " + text) if text else none
            b = next(held) if pieces is not None else self.encode_b.whole(text)
            same = int(self.length_a[a].sum()) == len(whole)  # A tokens are parts of the text
            if pieces is None or self.odd and not self.odd.isdisjoint(pieces):
                same = same and self._joined(b.tobytes()) == whole
            out.append((a, b) if same else (none, none))
        self.pieces_of.forget([piece for piece in self.odd if piece in self.pieces_of.known])
        self.odd.clear()
        return out


def tables(a: str, b: str) -> Tables:
    return held_by_worker(Tables, a, b)


# ---------------------------------------------------------------- alignment


class Aligned:
    """Some documents aligned, one after the other, as one run of bytes.

    ``ends_a``, ``ends_b`` are the token ends; ``n_a``, ``n_b`` (tokens), ``n_links`` and ``n_groups`` are by document.
    ``keys`` has the A id of each link in its high and the B id in its low 16 bits.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, length_a: np.ndarray, length_b: np.ndarray):
        self.a, self.b, self.n_a, self.n_b = a, b, n_a, n_b
        self.ends_a, self.ends_b = np.cumsum(length_a[a]), np.cumsum(length_b[b])
        size = int(self.ends_a[-1]) + 1 if len(a) else 1
        at_a, at_b = np.zeros(size, bool), np.zeros(size, bool)
        at_a[self.ends_a], at_b[self.ends_b] = True, True
        self.both = at_a & at_b
        ends = np.flatnonzero(at_a | at_b)  # each is the end of what one A and one B token share
        token_a, token_b = (np.cumsum(at, dtype=np.int32)[ends] - at[ends] for at in (at_a, at_b))
        self.keys = a[token_a].astype(np.uint32) << np.uint32(16) | b[token_b]
        doc_ends = np.concatenate([[0], self.ends_a])[np.cumsum(n_a)]
        self.n_links = np.diff(np.searchsorted(ends, doc_ends, side="right"), prepend=0)
        groups = np.cumsum(self.both, dtype=np.int32)
        self.n_groups = np.diff(groups[doc_ends], prepend=0)
        self.group_of = groups - self.both  # of the token that ends here

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs, ascending, and how many of the documents hold each."""
        doc = np.repeat(np.arange(len(self.n_links), dtype=np.uint64), self.n_links)
        once = np.unique(doc << np.uint64(32) | self.keys)
        return np.unique((once & np.uint64(0xFFFFFFFF)).astype(np.uint32), return_counts=True)

    def signs(self) -> np.ndarray:
        """All tokens in the order of the groups, A before B: id * 3 and 0, 1 at the end of a group's A, 2 of its B tokens."""
        group_a, group_b = self.group_of[self.ends_a], self.group_of[self.ends_b]
        n = int(self.both.sum())
        upto_a, upto_b = np.cumsum(np.bincount(group_a, minlength=n)), np.cumsum(np.bincount(group_b, minlength=n))
        out = np.empty(len(self.a) + len(self.b), np.int32)
        out[np.arange(len(self.a)) + np.concatenate([[0], upto_b])[group_a]] = self.a.astype(np.int32) * 3 + self.both[self.ends_a]
        out[np.arange(len(self.b)) + upto_a[group_b]] = self.b.astype(np.int32) * 3 + 2 * self.both[self.ends_b]
        return out


class Signs(list):
    """Text of each sign."""

    def __init__(self):
        super().__init__(b"%d%c" % (i, end) for i in range(1 << 16) for end in b",|;")


def groups_sha256(signs: np.ndarray) -> str:
    """Checksum of a document's groups as ``a1,a2|b1;a3|b2,b3``; empty without tokens."""
    if not len(signs):
        return ""
    text, whole = held_by_worker(Signs), hashlib.sha256()
    for k in range(0, len(signs), AT_ONCE):
        part = b"".join(map(text.__getitem__, signs[k : k + AT_ONCE].tolist()))
        whole.update(part if k + AT_ONCE < len(signs) else part[:-1])
    return whole.hexdigest()


def _column(values: list[np.ndarray]) -> pa.Array:
    return pa.array([v.tobytes() for v in values], pa.binary())


def _of(batch: pa.RecordBatch, t: Tables) -> Aligned:
    a, b = (np.frombuffer(b"".join(x.as_buffer() for x in batch[name]), np.uint16) for name in "ab")
    n_a, n_b = (pc.binary_length(batch[name]).to_numpy(zero_copy_only=False).astype(np.int64) // 2 for name in "ab")
    return Aligned(a, b, n_a, n_b, t.length_a, t.length_b)


# ---------------------------------------------------------------- minimal perfect hash


def _slot(keys: np.ndarray, level: int, size: int | np.ndarray) -> np.ndarray:
    x = keys.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (level + 1) % (1 << 64))
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return ((x ^ x >> np.uint64(31)) % np.asarray(size).astype(np.uint64)).astype(np.int64)


def build_hash(keys: np.ndarray) -> tuple[list[int], bytes]:
    """Sizes of the levels, and their bits: keys alone in their slot of a level stay there, the others go on to the next."""
    sizes, bits = [], []
    while len(keys):
        size = (2 * len(keys) + 7) // 8 * 8
        slot = _slot(keys, len(sizes), size)
        alone = np.bincount(slot, minlength=size) == 1
        sizes.append(size)
        bits.append(np.packbits(alone).tobytes())
        keys = keys[~alone[slot]]
    return sizes, b"".join(bits)


class PerfectHash:
    """Hashes of several buckets side by side; ``sizes`` and ``bits`` by bucket, empty for a bucket that is not held."""

    def __init__(self, sizes: list[list[int]], bits: list[bytes]):
        self.levels = max(map(len, sizes), default=0)
        self.size = np.zeros((len(sizes), self.levels), np.int64)
        for row, held in zip(self.size, sizes):
            row[: len(held)] = held
        self.start = (np.cumsum(self.size.ravel()) - self.size.ravel()).reshape(self.size.shape)
        self.bits = np.unpackbits(np.frombuffer(b"".join(bits), np.uint8)).astype(bool)
        self.rank = np.cumsum(self.bits, dtype=np.int32) - self.bits

    def places(self, keys: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        """Place of each key; for one that was not built in, any place or -1."""
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level in range(self.levels):
            size = self.size[buckets[left], level]
            left, size = left[size > 0], size[size > 0]
            at = self.start[buckets[left], level] + _slot(keys[left], level, size)
            hit = self.bits[at]
            out[left[hit]] = self.rank[at[hit]]
            left = left[~hit]
        return out


def bucket_of(keys: np.ndarray) -> np.ndarray:
    return ((keys >> np.uint32(16)) * np.uint32(40503) & np.uint32(0xFFFF)).astype(np.int64) * BUCKETS >> 16


def _packed(values: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(values).tobytes(), 1)


def _unpacked(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    every = every[order]
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    return every[first], np.add.reduceat(np.concatenate(counts)[order], first)


# ---------------------------------------------------------------- passes


def _encode(a: str, b: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tables(a, b)
        for batch in batches:
            for rows in slices(batch):
                ids = t.ids(rows["text"].to_pylist())
                yield pa.record_batch({"doc_id": rows["doc_id"], "a": _column([x for x, _ in ids]), "b": _column([y for _, y in ids])})

    return encode


_PARTS = "bucket int, part int, keys binary, counts binary"
_KEYS = "bucket int, part int, keys binary"
_HASHES = "bucket int, n long, sizes array<int>, bits binary, keys binary"
_VECTORS = "bucket int, part int, vector binary"


def _count(a: str, b: str):
    """Per task and bucket: the pairs of its documents, and how many hold each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, keys, counts, size = tables(a, b), [], [], 0
        for batch in batches:
            for rows in slices(batch, "a", ALIGNED_BYTES):
                found = _of(rows, t).pairs()
                keys.append(found[0])
                counts.append(found[1])
                size += len(found[0])
                if size > HELD:
                    found = _summed(keys, counts)
                    keys, counts, size = [found[0]], [found[1]], 0
        if not keys:
            return
        every, held = _summed(keys, counts)
        bucket, part = bucket_of(every), TaskContext.get().partitionId()
        rows = []
        for k in np.unique(bucket).tolist():
            mine = bucket == k
            rows.append((k, part, ex.pack(every[mine].astype(np.uint64)), _packed(held[mine].astype(np.int64))))
        yield _rows(rows, _PARTS)

    return count


def _rows(rows: list[tuple], shape: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}
    fields = [x.split() for x in shape.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.record_batch([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def _table(rows: list[tuple], shape: str) -> pa.Table:
    return pa.Table.from_batches([_rows(rows, shape)])


def _union(table: pa.Table) -> np.ndarray:
    return np.unique(np.concatenate([ex.unpack(x) for x in table["keys"].to_pylist()]))


def _join_keys(table: pa.Table) -> pa.Table:
    return _table([(table["bucket"][0].as_py(), table["part"][0].as_py() // FAN, ex.pack(_union(table)))], _KEYS)


def _build(table: pa.Table) -> pa.Table:
    """The hash of a bucket, and its keys by their places."""
    bucket, keys = table["bucket"][0].as_py(), _union(table).astype(np.uint32)
    sizes, bits = build_hash(keys)
    by_place = np.empty_like(keys)
    by_place[PerfectHash([sizes], [bits]).places(keys, np.zeros(len(keys), np.int64))] = keys
    return _table([(bucket, len(keys), sizes, bits, _packed(by_place))], _HASHES)


def _vector(parts: pa.Table, hashes: pa.Table) -> pa.Table:
    """Sum of the dense vectors of a few tasks, by the hash of their bucket."""
    if not parts.num_rows:
        return _table([], _VECTORS)
    known = PerfectHash([hashes["sizes"][0].as_py()], [hashes["bits"][0].as_py()])
    total = np.zeros(int(known.bits.sum()), np.int64)
    for keys, counts in zip(parts["keys"].to_pylist(), parts["counts"].to_pylist()):
        keys = ex.unpack(keys).astype(np.uint32)
        total[known.places(keys, np.zeros(len(keys), np.int64))] += _unpacked(counts, np.int64)
    return _table([(parts["bucket"][0].as_py(), parts["part"][0].as_py() // FAN, _packed(total))], _VECTORS)


def _add_vectors(table: pa.Table) -> pa.Table:
    total = sum(_unpacked(x, np.int64) for x in table["vector"].to_pylist())
    return _table([(table["bucket"][0].as_py(), table["part"][0].as_py() // FAN, _packed(total))], _VECTORS)


def _tree(rows: DataFrame, merge: Callable[[pa.Table], pa.Table], shape: str, parts: int) -> DataFrame:
    """Rows of a bucket merged ``FAN`` at a time until at most ``FAN`` are left."""
    while parts > FAN:
        rows = rows.groupBy("bucket", F.floor(F.col("part") / FAN)).applyInArrow(ex.handing_back(merge), shape)
        parts = -(-parts // FAN)
    return rows


def pair_counts(tokens: DataFrame, a: str, b: str) -> DataFrame:
    """Per bucket, stored: the hash of its pairs, their keys by place, and in how many documents each pair is linked."""
    parts = stored(tokens.select("a", "b").mapInArrow(_count(a, b), _PARTS), "pairs")
    tasks = (parts.agg(F.max("part")).first()[0] or 0) + 1
    keys = _tree(parts.select("bucket", "part", "keys"), _join_keys, _KEYS, tasks)
    hashes = stored(keys.groupBy("bucket").applyInArrow(ex.handing_back(_build), _HASHES), "pair-hashes")
    group = F.floor(F.col("part") / FAN)
    groups = -(-tasks // FAN)
    spread = hashes.select("bucket", "sizes", "bits", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("g"))
    vectors = parts.withColumn("g", group).groupBy("bucket", "g").cogroup(spread.groupBy("bucket", "g")).applyInArrow(ex.handing_back(_vector), _VECTORS)
    while groups > 1:
        vectors = vectors.groupBy("bucket", group).applyInArrow(ex.handing_back(_add_vectors), _VECTORS)
        groups = -(-groups // FAN)
    return stored(hashes.join(vectors.select("bucket", "vector"), "bucket"), "pair-counts")


class Counts:
    """Pairs of some buckets: their hash, keys, counts, and whether a count is the highest of its A id."""

    def __init__(self, rows: list[dict]):
        by_bucket = {r["bucket"]: r for r in rows}
        held = [by_bucket.get(k) for k in range(BUCKETS)]
        self.hash = PerfectHash([r["sizes"] if r else [] for r in held], [r["bits"] if r else b"" for r in held])
        join = lambda name, kind: np.concatenate([_unpacked(r[name], kind) for r in held if r] or [np.zeros(0, kind)])
        self.keys, self.counts = join("keys", np.uint32), join("vector", np.int64)
        best = np.zeros(1 << 16, np.int64)
        np.maximum.at(best, self.keys >> 16, self.counts)
        self.best = self.counts == best[self.keys >> 16]

    def of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count of each key, 0 for one that is not held, and whether it is its A id's highest."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = self.hash.places(keys, bucket_of(keys))
        known = (at >= 0) & (self.keys[at] == keys)
        return np.where(known, self.counts[at], 0), known & self.best[at]


_SUMS = "doc_id {kind}, a binary, b binary, n_best long, count_sum long"
_RESULT = "doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _look_up(a: str, b: str, held, last: bool):
    """Adds what the pairs of a block give to each document's sums; the last block's pass gives the whole row."""

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, counts = tables(a, b), Counts(held.value)
        for batch in batches:
            for rows in slices(batch, "a", ALIGNED_BYTES):
                found = _of(rows, t)
                keys, back = np.unique(found.keys, return_inverse=True)
                count, best = (x[back] for x in counts.of(keys))
                ends = np.cumsum(found.n_links)
                by_doc = lambda x: np.diff(np.concatenate([[0], np.cumsum(x, dtype=np.int64)])[ends], prepend=0)
                out = {"doc_id": rows["doc_id"]}
                if not last:
                    out |= {"a": rows["a"], "b": rows["b"]}
                sums = {"n_best": rows["n_best"].to_numpy() + by_doc(best), "count_sum": rows["count_sum"].to_numpy() + by_doc(count)}
                if last:
                    signs, stops = found.signs(), np.cumsum(found.n_a + found.n_b)
                    shas = [groups_sha256(signs[s:e]) for s, e in zip((stops - found.n_a - found.n_b).tolist(), stops.tolist())]
                    sums = {"n_a": found.n_a, "n_b": found.n_b, "n_groups": found.n_groups, "n_links": found.n_links} | sums
                out |= {name: pa.array(x, pa.int64()) for name, x in sums.items()}
                if last:
                    out["groups_sha256"] = pa.array(shas, pa.string())
                yield pa.record_batch(out)

    return look_up


def _blocks(sizes: list[tuple[int, int]], most: int) -> list[list[int]]:
    """Buckets (number, pairs) in runs of at most ``most`` pairs; a larger bucket is alone."""
    blocks, size = [[]], 0
    for bucket, n in sorted(sizes):
        if blocks[-1] and size + n > most:
            blocks.append([])
            size = 0
        blocks[-1].append(bucket)
        size += n
    return blocks


def align(docs: DataFrame, a: str | None = None, b: str | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``a`` is a byte-level file of the tokenizers library, ``b`` a file of the sentencepiece library. Texts that are null, empty or
    not given back byte by byte have no tokens: zeros and an empty checksum, and no pair. Rows with one doc_id are
    documents of their own, null ids stay null, other columns are ignored. A pass looks up ``LOOKED_UP`` pairs, a
    corpus with more takes as many passes as needed and adds up what they find.
    """
    a, b = a or public_tokenizers.path("byte_bpe_50k.json"), b or public_tokenizers.path("piece_bpe_32k.model")
    kind, spark = dict(docs.dtypes)["doc_id"], docs.sparkSession
    tokens = stored(docs.select("doc_id", "text").mapInArrow(_encode(a, b), f"doc_id {kind}, a binary, b binary"), "token-pairs")
    counted = pair_counts(tokens, a, b)
    blocks = _blocks([tuple(r) for r in counted.select("bucket", "n").collect()], LOOKED_UP)
    rows = tokens.withColumns({"n_best": F.lit(0).cast("long"), "count_sum": F.lit(0).cast("long")})
    for k, block in enumerate(blocks):
        last = k == len(blocks) - 1
        known = counted.where(F.col("bucket").isin(block)).collect()  # LOOKED_UP pairs, or one bucket
        held = spark.sparkContext.broadcast([row.asDict() for row in known])
        rows = rows.mapInArrow(_look_up(a, b, held, last), (_RESULT if last else _SUMS).format(kind=kind))
        rows = rows if last else stored(rows, "pair-sums")
    return rows
