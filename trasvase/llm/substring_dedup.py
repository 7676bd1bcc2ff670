"""Substring dedup with fixed-block anchors.

Every document is cut into blocks of ten words that do not overlap: the reference blocks. Every window of ten words
probes their index; as any run of twenty words holds a whole block, a run that occurs twice has such a hit at both
places. Hits are extended to the windows of twenty words around them, windows are compared exactly, and neighbouring
repeats join to maximal exact repeats. The first occurrence of a window (smaller doc_id, earlier start) stays.

Three passes over chunks of documents in id order share one shuffle of the text: the first sends block and probe hashes
to hash ranges, which answer with hits; the second sends the windows around hits, and the range answers each chunk with
those that an earlier chunk has; the third marks these, and what repeats within the chunk, and cuts them out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trasvase.llm import exchange as ex

#: Words of a repeated window, and of a block: two blocks less one word must fit in a window.
WINDOW, BLOCK = 20, 10

_SENT = "_range int, _chunk int, probes binary, twice binary, blocks binary"
_ANSWER = "_chunk int, hashes binary, tags binary"
_WINDOWS = "_range int, _chunk int, hashes binary, tags binary"


def _texts(table: pa.Table) -> list[bytes]:
    return [x or b"" for x in table["text"].cast(pa.binary()).to_pylist()]


def _chunk_words(table: pa.Table) -> list[np.ndarray]:
    return [ex.word_hashes(x.split()) for x in _texts(table)]  # bytes split at white space of ASCII only


def _in_order(table: pa.Table) -> pa.Table:
    """Rows by doc_id (null first), then text, so that the first occurrence does not depend on the dealing out."""
    keys = [("doc_id", "ascending"), ("text", "ascending")]
    return table.take(pc.sort_indices(table, sort_keys=keys, null_placement="at_start"))


def _windows(words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Hash and tag of every window of the chunk, and where each document's begin (one more at the end)."""
    hashes = [ex.window_hashes(w, WINDOW) for w in words]
    tags = [(ex.window_hashes(w, WINDOW, salt=3) >> np.uint64(32)).astype(np.uint32) for w in words]
    starts = [0, *np.cumsum([len(h) for h in hashes]).tolist()]
    return np.concatenate(hashes or [np.zeros(0, np.uint64)]), np.concatenate(tags or [np.zeros(0, np.uint32)]), starts


def _send(bits: int, ranges: int):
    cut = np.uint64(64 - bits)

    def send(table: pa.Table) -> pa.Table:
        probes, blocks = [], []
        for w in _chunk_words(table):
            if len(w) >= WINDOW:
                h = ex.window_hashes(w, BLOCK) >> cut
                probes.append(h)
                blocks.append(h[::BLOCK])
        rows = []
        if probes:
            every, counts = np.unique(np.concatenate(probes), return_counts=True)
            lists = [every, every[counts > 1], np.unique(np.concatenate(blocks))]
            edges = [np.searchsorted(ex.range_of(x, bits, ranges), np.arange(ranges + 1)) for x in lists]
            chunk = table["_chunk"][0].as_py()
            for r in range(ranges):
                parts = [ex.pack(x[e[r] : e[r + 1]]) for x, e in zip(lists, edges)]
                if parts[0]:
                    rows.append((r, chunk, *parts))
        return _table(rows, _SENT)

    return send


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "binary": pa.binary(), "long": pa.int64()}
    fields = [tuple(x.split()) for x in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.table({n: pa.array(c, kinds[k]) for (n, k), c in zip(fields, columns)})


def _hits(table: pa.Table) -> pa.Table:
    """Per chunk the hashes that are a block somewhere and occur at another place too."""
    chunks, probes = table["_chunk"].to_pylist(), [ex.unpack(x) for x in table["probes"].to_pylist()]
    blocks = np.unique(np.concatenate([ex.unpack(x) for x in table["blocks"].to_pylist()]))
    twice = [ex.unpack(x) for x in table["twice"].to_pylist()]
    every = np.sort(np.concatenate([*probes, *twice]))  # a hash is here once a chunk, and once more if twice in it
    again = np.unique(every[1:][every[1:] == every[:-1]])
    hits = again[ex.member(again, blocks)]
    rows = []
    for chunk, own in zip(chunks, probes):
        found = own[ex.member(own, hits)]
        if len(found):
            rows.append((chunk, ex.pack(found), b""))
    return _table(rows, _ANSWER)


def _extend(bits: int, ranges: int):
    cut = np.uint64(64 - bits)

    def extend(table: pa.Table, answer: pa.Table) -> pa.Table:
        """The windows around hits, once each, for the hash ranges."""
        if not table.num_rows or not answer.num_rows:
            return _table([], _WINDOWS)
        hits = np.sort(np.concatenate([ex.unpack(x) for x in answer["hashes"].to_pylist()]))
        hashes, tags = [], []
        for w in _chunk_words(table):
            if len(w) < WINDOW:
                continue
            hit = np.concatenate([[0], np.cumsum(ex.member(ex.window_hashes(w, BLOCK) >> cut, hits))])
            reach = WINDOW - BLOCK + 1
            near = np.flatnonzero(hit[reach:] > hit[:-reach])
            if len(near):
                hashes.append(ex.window_hashes(w, WINDOW)[near])
                tags.append((ex.window_hashes(w, WINDOW, salt=3)[near] >> np.uint64(32)).astype(np.uint32))
        rows = []
        if hashes:
            h, t = np.concatenate(hashes), np.concatenate(tags)
            order = np.argsort(h, kind="stable")
            h, t = h[order], t[order]
            new = np.concatenate([[True], (h[1:] != h[:-1]) | (t[1:] != t[:-1])])
            h, t = h[new], t[new]
            edges = np.searchsorted(ex.range_of(h, 64, ranges), np.arange(ranges + 1))
            chunk = table["_chunk"][0].as_py()
            for r in range(ranges):
                a, b = edges[r], edges[r + 1]
                if a < b:
                    rows.append((r, chunk, ex.pack(h[a:b]), ex.pack_numbers(t[a:b])))
        return _table(rows, _WINDOWS)

    return extend


def _earlier(table: pa.Table) -> pa.Table:
    """Per chunk the windows that a chunk before it has as well."""
    order = np.argsort(np.array(table["_chunk"].to_pylist()), kind="stable")
    chunks, packed, tags = (table[c].to_pylist() for c in ("_chunk", "hashes", "tags"))
    lists = [ex.unpack(packed[i]) for i in order]
    marks = [ex.unpack_numbers(tags[i], np.uint32) for i in order]
    h, t = np.concatenate(lists), np.concatenate(marks)
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    place = np.lexsort((owner, t, h))
    same = np.concatenate([[False], (h[place][1:] == h[place][:-1]) & (t[place][1:] == t[place][:-1])])
    late = np.zeros(len(h), bool)
    late[place[same]] = True
    rows, at = [], 0
    for i, own, mark in zip(order, lists, marks):
        mine = late[at : at + len(own)]
        at += len(own)
        if mine.any():
            rows.append((chunks[i], ex.pack(own[mine]), ex.pack_numbers(mark[mine])))
    return _table(rows, _ANSWER)


def _covered(table: pa.Table, answer: pa.Table) -> list[np.ndarray]:
    """Per document of the chunk, which words a repeated window covers."""
    words = _chunk_words(table)
    h, t, starts = _windows(words)
    order = np.argsort(h, kind="stable")  # equal windows stay in the order of their places
    again = np.zeros(len(h), bool)
    if len(h):
        again[order[1:]] = (h[order][1:] == h[order][:-1]) & (t[order][1:] == t[order][:-1])
    if answer.num_rows:
        late = np.concatenate([ex.unpack(x) for x in answer["hashes"].to_pylist()])
        mark = np.concatenate([ex.unpack_numbers(x, np.uint32) for x in answer["tags"].to_pylist()])
        o = np.argsort(late, kind="stable")
        late, mark = late[o], mark[o]
        if len(late):
            at = np.minimum(np.searchsorted(late, h), len(late) - 1)
            again |= (late[at] == h) & (mark[at] == t)
    out = []
    for w, a, b in zip(words, starts, starts[1:]):
        edge = np.zeros(len(w) + 1, np.int64)
        if b > a:
            edge[: b - a] += again[a:b]
            edge[WINDOW : WINDOW + b - a] -= again[a:b]
        out.append(np.cumsum(edge)[:-1] > 0)
    return out


def _digest(table: pa.Table, answer: pa.Table) -> pa.Table:
    table = _in_order(table)
    kept, removed, total, spans = [], [], [], []
    for text, gone in zip(_texts(table), _covered(table, answer) if table.num_rows else []):
        words = text.split()
        left = b" ".join([w for w, g in zip(words, gone.tolist()) if not g]) if gone.any() else b" ".join(words)
        kept.append(hashlib.sha256(left).hexdigest())
        total.append(len(words))
        removed.append(int(gone.sum()))
        turn = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
        spans.append([{"start": int(a), "end": int(b)} for a, b in zip(turn[::2], turn[1::2])])
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.table(
        {
            "doc_id": table["doc_id"],
            "n_words": pa.array(total, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "kept_sha256": pa.array(kept, pa.string()),
            "spans": pa.array(spans, span),
        }
    )


def _cut_out(table: pa.Table, answer: pa.Table) -> pa.Table:
    table = _in_order(table)
    texts = table["text"].to_pylist()
    for i, gone in enumerate(_covered(table, answer) if table.num_rows else []):
        if gone.any():
            words = texts[i].encode().split()
            texts[i] = b" ".join([w for w, g in zip(words, gone.tolist()) if not g]).decode()
    place = table.column_names.index("text")
    return table.set_column(place, "text", pa.array(texts, table["text"].type)).drop_columns(["_chunk"])


def _passes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chunked documents, and the answer each chunk gets."""
    size = ex.corpus_bytes(docs)
    bits, ranges = ex.bits_for(size), ex.ranges_for(size)
    chunked, _ = ex.in_chunks(docs, size)
    sent = chunked.groupBy("_chunk").applyInArrow(ex.handing_back(_send(bits, ranges)), _SENT)
    hits = sent.groupBy("_range").applyInArrow(ex.handing_back(_hits), _ANSWER)
    windows = chunked.groupBy("_chunk").cogroup(hits.groupBy("_chunk")).applyInArrow(ex.handing_back(_extend(bits, ranges)), _WINDOWS)
    return chunked, windows.groupBy("_range").applyInArrow(ex.handing_back(_earlier), _ANSWER)


def substring_dedup(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_words, n_removed, kept_sha256, and the removed ``spans`` of words.

    Null and empty texts have no words. Rows with one doc_id count as documents of their own, in the order of their
    texts; a null doc_id comes before all others. Other columns are ignored.
    """
    chunked, answer = _passes(docs.select("doc_id", "text"))
    shape = f"doc_id {dict(docs.dtypes)['doc_id']}, n_words long, n_removed long, kept_sha256 string, spans array<struct<start: long, end: long>>"
    return chunked.groupBy("_chunk").cogroup(answer.groupBy("_chunk")).applyInArrow(ex.handing_back(_digest), shape)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``; texts without any stay as they are, other columns always, whatever their names."""
    chunked, answer = _passes(docs.toDF(*[c if c in ("doc_id", "text") else f"c{i}" for i, c in enumerate(docs.columns)]))
    shape = T.StructType([f for f in chunked.schema.fields if f.name != "_chunk"])
    cut = chunked.groupBy("_chunk").cogroup(answer.groupBy("_chunk")).applyInArrow(ex.handing_back(_cut_out), shape)
    return cut.toDF(*docs.columns)
