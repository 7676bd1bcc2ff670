"""Order-preserving packing of documents into sequences by dynamic programming.

Documents stand in a line by doc_id. A sequence is a window of at most ``LENGTH`` tokens of the line; windows are cut at
document ends, at sentence ends or, in long sentences, every ``STRIDE`` tokens. The cost of a window is its padding plus a
penalty for a cut inside a document, and the cheapest cuts are found in one pass over the places: the best place to begin
the window that ends here is the front of a monotone queue, as the padding splits into a part of each end. The line is
dealt out in chunks of documents in id order, which are packed on their own.
"""

from __future__ import annotations

import re
import zlib
from collections import deque

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame

from trasvase.llm import exchange as ex
from trasvase.llm.substring_dedup import _in_order
from trasvase.llm.tokens import encoder, held_by_worker, line_of

#: Tokens of a sequence; id that ends a document; longest stretch of a sentence without a place to cut.
LENGTH, END, STRIDE = 4096, 2, 256
#: Penalties, in tokens of padding, of a cut at a sentence end and of one inside a sentence.
SENTENCE, INSIDE = 4, 64
#: Bytes of text encoded at once: the last stage of a pipeline shares its worker's memory with what came before.
AT_ONCE = 2 << 20

_ENDS = re.compile(r"[.!?]+(</w>)?")


def places(lengths: np.ndarray, sentence_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where the line may be cut, ascending, and their penalties; the last is its end.

    ``sentence_end`` tells of each token whether a sentence ends after it.
    """
    kinds = np.zeros(len(sentence_end) + 1, np.uint8)  # of each place: none, inside a sentence, sentence end, document end
    kinds[1:] = sentence_end
    kinds *= 2
    kinds[np.cumsum(lengths)] = 3
    soft = np.flatnonzero(kinds)
    gaps = np.diff(soft, prepend=0)
    for k in np.flatnonzero(gaps > STRIDE):
        kinds[soft[k] - gaps[k] + STRIDE : soft[k] : STRIDE] = 1
    every = np.flatnonzero(kinds)
    return every, np.array([0, INSIDE, SENTENCE, 0])[kinds[every]]


def cuts(at: np.ndarray, penalty: np.ndarray, length: int = LENGTH) -> list[int]:
    """The places (ascending, the last of ``at`` included) that cut the line at least cost.

    No two neighbouring places may be more than ``length`` apart. Ties go to the earlier beginning of a window.
    """
    at = np.concatenate([[0], at])
    least = np.searchsorted(at, at - length).tolist()  # first beginning of a window that ends here
    value, back = [0], [0]  # cost and place together: what a window costs beyond it, but for its end, which all share
    queue: deque[int] = deque([0])  # beginnings by place, each cheaper than all before it
    for j, extra in enumerate((penalty + length).tolist(), 1):
        first = least[j]
        while queue[0] < first:
            queue.popleft()
        i = queue[0]
        back.append(i)
        here = value[i] + extra
        value.append(here)
        while queue and value[queue[-1]] > here:
            queue.pop()
        queue.append(j)
    found, j = [], len(at) - 1
    while j:
        found.append(int(at[j]))
        j = back[j]
    return found[::-1]


class SentenceEnds:
    """Which ids end a sentence."""

    def __init__(self, path: str):
        self.closes = np.zeros(65536, bool)
        self.closes[[i for token, i in encoder(path).tokenizer.get_vocab().items() if _ENDS.fullmatch(token)]] = True


def _pack(path: str, length: int, with_ids: bool):
    def pack(table: pa.Table) -> pa.Table:
        table = _in_order(table)
        line, sizes = line_of(table["text"], encoder(path), END, AT_ONCE)
        doc_ids, chunk = table["doc_id"].combine_chunks(), table["_chunk"][0].as_py()
        del table
        ends = np.array(cuts(*places(sizes, held_by_worker(SentenceEnds, path).closes[line]), length))
        doc_ends = np.cumsum(sizes)
        stops = np.unique(np.concatenate([doc_ends, ends]))
        starts = np.concatenate([[0], stops[:-1]])
        doc = np.searchsorted(doc_ends, starts, side="right")
        sequence = np.searchsorted(ends, starts, side="right")
        begins = np.concatenate([[0], ends[:-1]])
        out = {
            "doc_id": doc_ids.take(pa.array(doc)),
            "start": pa.array(starts - (doc_ends - sizes)[doc], pa.int64()),
            "length": pa.array(stops - starts, pa.int64()),
            "ids_crc32": pa.array([zlib.crc32(line[a:b].astype("<u4")) for a, b in zip(starts.tolist(), stops.tolist())], pa.int64()),
            "doc_tokens": pa.array(sizes[doc], pa.int64()),
            "sequence_id": pa.array((chunk << 32) + sequence, pa.int64()),
            "offset": pa.array(starts - begins[sequence], pa.int64()),
        }
        if with_ids:
            out["ids"] = pa.array([line[a:b].astype(np.int32) for a, b in zip(starts.tolist(), stops.tolist())], pa.list_(pa.int32()))
        return pa.table(out)

    return pack


def pack(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """Per piece of a document of ``docs`` (doc_id, text): doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts have the end id only. Rows with one doc_id are documents of their own; a null doc_id comes
    first. Other columns are ignored. ``length`` must be at least ``STRIDE``; ``with_ids`` adds the token ids.
    """
    if length < STRIDE:
        raise ValueError(f"sequences must have at least {STRIDE} tokens")
    plain = docs.select("doc_id", "text")
    chunked, _ = ex.in_chunks(plain, ex.corpus_bytes(plain))
    shape = f"doc_id {dict(docs.dtypes)['doc_id']}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    return chunked.groupBy("_chunk").applyInArrow(ex.handing_back(_pack(path, length, with_ids)), shape + (", ids array<int>" if with_ids else ""))
