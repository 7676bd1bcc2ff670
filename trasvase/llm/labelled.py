"""Labels of documents: which rows may train, and a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """True for every fifth document by a checksum of its id, and for a null id: such rows never train."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """At most ``most`` training documents (doc_id, text, y), the first by a hash of their id.

    A document labelled more than once takes the smallest label, an id with several texts the smallest text that is not
    null; null labels are ignored. The ids are bounded by ``most``, so they are broadcast and the documents are only filtered.
    """
    known = labels.where(F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min(F.col(label)).cast("int").alias("y"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("y").alias("y"))
