"""Quality rules: plain counts of a text, and a log-likelihood ratio between trusted and raw text.

A text is a bag of hashed word unigrams and bigrams. Two multinomials over the hash buckets are counted, one over
trusted texts and one over the whole corpus; a document's score is the mean log ratio of the two over its n-grams, and
every document below a fixed threshold is refused. All of it is DataFrame expressions: the counts are one partial
aggregate to at most ``buckets`` rows, the ratios one constant array of that length. Which documents are trusted is found by
a join with their ids; before it, a bitmap of hashed ids, of one size whatever their number, lets only texts through that
may be trusted, and the rest are counted where they are read.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trasvase.llm.words import SPACE, ascii_lower, words

#: Hash buckets of the two multinomials; trusted n-grams added to the seen and to the expected count of each bucket.
BUCKETS = 10_000
PRIOR = 5.0
#: Mean log ratio below which a document is refused.
THRESHOLD = -0.15
#: Bits of the bitmap of trusted ids, 1 MB in all.
BITS = 1 << 23
#: A document fails the base rules with fewer words, or more percent of them in repeated windows.
LEAST_WORDS, MOST_REPEATED, WINDOW = 10, 20, 5


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` (any columns, repeated rows kept) with a struct ``_q`` of the base counts.

    A null text counts as empty: all counts 0. Only expressions over the row itself: no shuffle, texts of any length.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    at = lambda i: F.get(F.col("_w"), i)
    steps = docs.withColumns({"_w": words(F.col(text)), "_l": lines}).withColumn(
        "_h",
        F.transform(
            F.slice("_w", 1, F.greatest(F.size("_w") - (WINDOW - 1), F.lit(0))),
            lambda w, i: F.xxhash64(w, *[at(i + k) for k in range(1, WINDOW)]),
        ),
    )
    twice = F.size(F.array_distinct("_h")) < F.size("_h")
    steps = steps.withColumn("_s", F.when(twice, F.array_sort(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    beside = lambda i: F.get(F.col("_s"), i)["h"]
    again = F.filter("_s", lambda x, i: (x["h"].eqNullSafe(F.when(i > 0, beside(i - 1)))) | x["h"].eqNullSafe(beside(i + 1)))
    steps = steps.withColumn("_p", F.array_sort(F.transform(again, lambda x: x["i"])))
    covered = F.aggregate(
        F.transform("_p", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("_p"), i + 1), p + WINDOW) - p)),
        F.lit(0).cast("long"),
        lambda a, x: a + x,
    )
    return steps.withColumn(
        "_q",
        F.struct(
            F.size("_w").cast("long").alias("n_words"),
            (F.length(whole) - F.regexp_count(whole, F.lit(SPACE))).cast("long").alias("word_chars"),
            F.regexp_count(whole, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
            F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        ),
    ).drop("_w", "_l", "_h", "_s", "_p")


def base_failed(q: str = "_q") -> Column:
    return (F.col(f"{q}.n_words") < LEAST_WORDS) | (100 * F.col(f"{q}.n_repeat_words") > MOST_REPEATED * F.col(f"{q}.n_words"))


def _grams(w: str, buckets: int) -> Column:
    """Bucket numbers of the unigrams and bigrams of the word array in column ``w``."""
    one = F.transform(w, lambda x: F.pmod(F.xxhash64(x), F.lit(buckets)).cast("int"))
    two = F.transform(
        F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))),
        lambda x, i: F.pmod(F.xxhash64(x, F.get(F.col(w), i + 1)), F.lit(buckets)).cast("int"),
    )
    return F.concat(one, two)


def _maybe_trusted(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``docs`` with ``_maybe``, false only where ``doc_id`` is not among the ids of ``known`` (column ``_t``)."""

    def bit(name: str) -> Column:
        return F.pmod(F.xxhash64(F.col(name)), F.lit(BITS)) + 1

    maps = known.groupBy(F.bitmap_bucket_number(bit("_t")).alias("_b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit("_t"))).alias("_bits"))
    at = F.bitmap_bit_position(bit("doc_id"))
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(_at div 8 as int) + 1, 1)")), 16, 10).cast("long")
    held = docs.withColumn("_at", at).join(F.broadcast(maps), F.bitmap_bucket_number(bit("doc_id")) == F.col("_b"), "left")
    return held.withColumn("_maybe", F.coalesce(F.getbit(byte, F.col("_at") % 8) == 1, F.lit(False)))


def log_ratios(corpus: DataFrame, trusted_ids: DataFrame, buckets: int = BUCKETS) -> list[float]:
    """Log of trusted share over raw share, by bucket: ``buckets`` numbers, whatever the size of the corpus.

    ``corpus`` (doc_id, text) and ``trusted_ids`` (doc_id) are counted whole, whatever their size. With no trusted
    document, or an empty corpus, every ratio is 0. Ratios are rounded, so they do not depend on how rows were dealt out.
    """
    known = trusted_ids.select(F.col("doc_id").alias("_t")).distinct()
    plain = _maybe_trusted(corpus.select("doc_id", "text"), known)
    sure = plain.where("NOT _maybe").select("text", F.lit(None).alias("_t"))
    asked = plain.where("_maybe").select("doc_id", "text").join(known.hint("merge"), F.col("doc_id") == F.col("_t"), "left")
    flagged = asked.select("text", "_t").unionByName(sure)
    flagged = flagged.select(words(ascii_lower(F.col("text"))).alias("_w"), F.col("_t").isNotNull().cast("long").alias("_y"))
    counts = (
        flagged.select("_y", F.explode(_grams("_w", buckets)).alias("b"))
        .groupBy("b")
        .agg(F.count("*").alias("raw"), F.sum("_y").alias("good"))
        .collect()  # a row a bucket at most
    )
    raw, good = [0] * buckets, [0] * buckets
    for row in counts:
        raw[row["b"]], good[row["b"]] = row["raw"], row["good"]
    if not sum(good):
        return [0.0] * buckets
    part = sum(good) / sum(raw)
    return [round(math.log((g + PRIOR) / (r * part + PRIOR)), 4) for g, r in zip(good, raw)]


def likelihood_ratio(docs: DataFrame, ratios: list[float]) -> DataFrame:
    """``docs`` with ``_llr``: mean log ratio over the n-grams of ``text``; 0 for a text without words."""
    held = F.from_json(F.lit(json.dumps(ratios)), "array<double>")
    scored = docs.withColumn("_lw", words(ascii_lower(F.col("text")))).withColumn("_g", _grams("_lw", len(ratios)))
    total = F.aggregate("_g", F.lit(0.0), lambda a, g: a + F.get(held, g))
    return scored.withColumn("_llr", F.round(total / F.greatest(F.size("_g"), F.lit(1)), 6)).drop("_lw", "_g")


def quality_rules(docs: DataFrame, trusted_ids: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): counts, score and verdicts.

    Nulls: a null text is empty and fails the base rules, a null doc_id is never trusted and is kept as it is.
    Repeated rows are judged one by one; other columns are ignored, whatever their names.
    """
    plain = docs.select("doc_id", "text")
    judged = likelihood_ratio(base_counts(plain), log_ratios(plain, trusted_ids))
    failed = base_failed()
    return judged.select(
        "doc_id", "_q.*", F.col("_llr").alias("llr"), failed.alias("base_failed"), (~failed & (F.col("_llr") >= threshold)).alias("kept")
    )


def trusted_sample(labels: DataFrame) -> DataFrame:
    """Ids of all documents labelled good."""
    return labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
