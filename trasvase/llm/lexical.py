"""Ranked lexical search by the best position algorithm.

Documents are read once for the terms of a block of items: what a document holds of them is stored, and counted over the
whole corpus. Each part of the stored table then has its own impact lists, one a term, in falling order of what the term
adds to a document's score. All lists of an item are read downwards in step; a document met in one list is looked up in all
others, which also tells its places there. The best position of a list is the last place up to which all places have been
seen, so the sum of the impacts at the best positions bounds every document not met so far. A part stops as soon as that
sum is strictly below its own k-th score: a tie could still go to a smaller id. Parts are dealt out by documents, so the
best of all parts are the best of the corpus, whatever the dealing.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trasvase.llm.tokens import slices
from trasvase.session import stored

#: Bytes of item texts searched in one pass; postings of one part; first step down the lists, doubled at each turn.
BLOCK_BYTES, PART_POSTINGS, STEP = 1 << 20, 2_000_000, 16

# Fixed values of the score.
SCALE, K, LENGTH_SHARE = 1_000_000_000, 12, 25

#: ASCII that is no letter or digit parts terms, A-Z become small; bytes of other characters stay as they are.
_TERMS = bytes(b if chr(b).isalnum() else 32 for b in range(128)).lower() + bytes(range(128, 256))


def terms_of(text: str | None) -> list[bytes]:
    """Terms of a text in order, as UTF-8; null has none."""
    return text.encode().translate(_TERMS).split() if text else []


def weight(n_docs: int, holding: int) -> int:
    """What a term held by ``holding`` of ``n_docs`` documents weighs."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding + 1)))


def _postings(numbers: dict[bytes, int]):
    """Per document: its terms in all, and which of the asked terms it holds how often."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch):
                lengths, held = [], []
                for text in rows["text"].to_pylist():
                    found = terms_of(text)
                    lengths.append(len(found))
                    held.append(np.fromiter((t for t in map(numbers.get, found) if t is not None), np.int64))
                sizes = [len(h) for h in held]
                keys = np.concatenate([*held, np.zeros(0, np.int64)]) + np.repeat(np.arange(len(held)) << 32, sizes)
                keys, times = np.unique(keys, return_counts=True)
                offsets = pa.array(np.searchsorted(keys, np.arange(len(held) + 1) << 32), pa.int32())
                yield pa.record_batch(
                    {
                        "doc_id": rows["doc_id"],
                        "n": pa.array(lengths, pa.int64()),
                        "terms": pa.ListArray.from_arrays(offsets, pa.array(keys & 0xFFFFFFFF, pa.int32())),
                        "times": pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64())),
                    }
                ).filter(pa.array(np.array(lengths) > 0))

    return read


class ImpactLists:
    """Impact lists of some documents: postings by document, and by term in falling order of impact.

    ``starts`` has where each document's postings begin (one more at the end), ``terms`` and ``impacts`` are theirs.
    ``order`` breaks ties between documents, the smaller first.
    """

    def __init__(self, starts: np.ndarray, terms: np.ndarray, impacts: np.ndarray, order: np.ndarray, n_terms: int):
        self.starts, self.terms, self.impacts, self.order = starts, terms, impacts, order
        self.docs = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        by_list = np.lexsort((-impacts, terms))
        self.list_docs, self.list_impacts = self.docs[by_list], impacts[by_list]
        self.bounds = np.searchsorted(terms[by_list], np.arange(n_terms + 1))
        place = np.empty(len(terms), np.int64)
        place[by_list] = np.arange(len(terms))
        self.place = place - self.bounds[terms]  # of each posting in its list

    def _direct(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Postings of the documents, and whose each is."""
        sizes = self.starts[docs + 1] - self.starts[docs]
        first = np.repeat(self.starts[docs] - np.cumsum(sizes) + sizes, sizes)
        return first + np.arange(int(sizes.sum())), np.repeat(np.arange(len(docs)), sizes)

    def best(self, wanted: dict[int, int], k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """The ``k`` best documents for terms with their repeats, their scores, and how many documents were looked at.

        Only scores above 0 count.
        """
        held = [t for t in wanted if self.bounds[t + 1] > self.bounds[t]]
        begins = np.array([self.bounds[t] for t in held], np.int64)
        sizes = np.array([self.bounds[t + 1] - self.bounds[t] for t in held], np.int64)
        times = np.array([wanted[t] for t in held], np.int64)
        number = np.full(len(self.bounds), -1)
        number[held] = np.arange(len(held))
        flat = np.cumsum(sizes) - sizes
        seen = np.zeros(int(sizes.sum()), bool)
        met = np.zeros(len(self.starts) - 1, bool)
        position = np.zeros(len(held), np.int64)  # places seen without a gap, from the top
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        depth, step, looked = 0, STEP, 0
        while depth < (sizes.max() if held else 0):
            reach = np.clip(sizes - depth, 0, step)
            first = np.repeat(begins + depth - np.cumsum(reach) + reach, reach)
            new = np.unique(self.list_docs[first + np.arange(len(first))])  # sorted access
            depth, step = depth + step, step * 2
            new = new[~met[new]]
            met[new] = True
            looked += len(new)
            at, owner = self._direct(new)
            which = number[self.terms[at]]
            at, owner, which = at[which >= 0], owner[which >= 0], which[which >= 0]
            seen[flat[which] + self.place[at]] = True
            sums = np.concatenate([[0], np.cumsum(self.impacts[at] * times[which])])
            ends = np.searchsorted(owner, np.arange(len(new) + 1))
            totals = sums[ends[1:]] - sums[ends[:-1]]
            docs, scores = np.concatenate([docs, new[totals > 0]]), np.concatenate([scores, totals[totals > 0]])
            keep = np.lexsort((self.order[docs], -scores))[:k]
            docs, scores = docs[keep], scores[keep]
            bound = 0
            for i in range(len(held)):
                rest = seen[flat[i] + position[i] : flat[i] + sizes[i]]
                gap = int(rest.argmin()) if len(rest) else 0
                position[i] += len(rest) if len(rest) and rest[gap] else gap
                if position[i] < sizes[i]:  # else no other document holds the term
                    bound += int(self.list_impacts[begins[i] + max(position[i] - 1, 0)]) * int(times[i])
            if bound == 0 or len(scores) == k and bound < scores[-1]:
                break
        return docs, scores, looked


def _search(items: list[dict[int, int]], weights: np.ndarray, n_docs: int, n_terms: int, k: int):
    """The best documents of each part for each item; ``items`` by number, as terms with their repeats."""

    def part(tables: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(tables).combine_chunks()
        starts = np.concatenate([[0], np.cumsum(pc.list_value_length(table["terms"]).to_numpy())])
        terms = table["terms"].combine_chunks().flatten().to_numpy()
        times = table["times"].combine_chunks().flatten().to_numpy()
        share = 100 - LENGTH_SHARE + LENGTH_SHARE * table["n"].to_numpy() * n_docs // max(n_terms, 1)
        impacts = weights[terms] * (SCALE * times // (1000 * times + K * np.repeat(share, np.diff(starts))))
        ids = table["doc_id"].combine_chunks()
        order = np.empty(len(ids), np.int64)
        order[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
        lists = ImpactLists(starts, terms, impacts, order, len(weights))
        found = [lists.best(wanted, k)[:2] for wanted in items]
        sizes = [len(docs) for docs, _ in found]
        return pa.record_batch(
            {
                "item": pa.array(np.repeat(np.arange(len(items)), sizes), pa.int32()),
                "doc_id": ids.take(pa.array(np.concatenate([docs for docs, _ in found]))),
                "score": pa.array(np.concatenate([scores for _, scores in found]), pa.int64()),
            }
        )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch["terms"].flatten())
            if size >= PART_POSTINGS:
                yield part(held)
                held, size = [], 0
        if held:
            yield part(held)

    return search


def _block(docs: DataFrame, items: list[tuple], k: int, shape: str) -> DataFrame:
    """The ``k`` best documents of the corpus for each (item_id, text)."""
    asked = [Counter(terms_of(text)) for _, text in items]
    numbers = {term: i for i, term in enumerate(sorted(set().union(*asked)))}
    kind = dict(docs.dtypes)["doc_id"]
    read = docs.select("doc_id", "text").mapInArrow(_postings(numbers), f"doc_id {kind}, n long, terms array<int>, times array<long>")
    postings = stored(read, "postings")
    n_docs, n_terms = postings.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = np.zeros(len(numbers), np.int64)
    for term, count in postings.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("c")).collect():
        holding[term] = count  # a row an asked term
    weights = np.array([weight(n_docs, int(h)) for h in holding], np.int64)
    wanted = [{numbers[t]: c for t, c in item.items()} for item in asked]
    found = postings.where(F.size("terms") > 0).mapInArrow(_search(wanted, weights, n_docs, n_terms, k), f"item int, doc_id {kind}, score long")
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    names = docs.sparkSession.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(items)], f"item int, item_id {shape}")
    return found.withColumn("rank", place).where(F.col("rank") <= k).join(names, "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """Per row of ``items`` (item_id, text) its ``k`` best rows of ``docs`` (doc_id, text): item_id, rank, doc_id, score.

    Items are searched in blocks of about ``BLOCK_BYTES`` of text, each in one pass over the documents; counts are over all
    documents. Null or empty texts have no terms: such an item finds nothing, such a document is not found and not
    counted. Rows that share an id are documents, or items, of their own; equal scores go by ascending doc_id, null last.
    Other columns are ignored, whatever their names. Empty tables give no rows.
    """
    spark, kind = docs.sparkSession, dict(items.dtypes)["item_id"]
    asked = items.select("item_id", "text").where(F.octet_length("text") > 0)
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // BLOCK_BYTES + 1
    found = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id {dict(docs.dtypes)['doc_id']}, score long")
    for b in range(blocks if size else 0):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()  # about BLOCK_BYTES
        if rows:
            found = found.unionByName(_block(docs, [tuple(r) for r in rows], k, kind))
    return found
