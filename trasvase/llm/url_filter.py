"""URL filters: rules by host and path, and a logistic regression on hashed character n-grams for the other URLs.

Training runs on a small labelled table: each step is one Spark job that sums the gradient by bucket, and only the
weights (one number a bucket) pass through the driver. Sums are taken on whole numbers, so the weights do not depend on
how rows were dealt out. Scoring is one expression over the row.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trasvase.llm.words import ascii_lower
from trasvase.session import stored

#: Rules of the query: verdict, host, path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Hash buckets, lengths of the n-grams, labelled rows used at most, steps, step size, ridge.
BUCKETS, SIZES, SAMPLE, STEPS, RATE, RIDGE = 1 << 12, (3, 4), 4096, 15, 8.0, 1e-4
_UNIT = 1 << 30


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path; both empty for null or an URL without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda k: F.coalesce(F.regexp_extract(url, pattern, k), F.lit(""))
    return ascii_lower(part(1)), part(2)


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, at, prefix in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(prefix)
        found = F.when(fits, F.struct(F.lit(at + prefix).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _grams(chars: str, tag: str, buckets: int) -> list[Column]:
    """Bucket numbers of the n-grams of the character array in column ``chars``."""

    def of_size(n: int) -> Column:
        starts = F.slice(chars, 1, F.greatest(F.size(chars) - (n - 1), F.lit(0)))
        follow = lambda i: [F.get(F.col(chars), i + k) for k in range(1, n)]
        return F.transform(starts, lambda c, i: F.pmod(F.xxhash64(F.lit(f"{tag}{n}"), c, *follow(i)), F.lit(buckets)).cast("int"))

    return [of_size(n) for n in SIZES]


def with_grams(urls: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``urls`` (_host, _path) with ``_g``: the distinct buckets of its n-grams, with marks at both ends."""
    chars = lambda c: F.split(F.concat(F.lit("^"), F.col(c), F.lit("$")), "")
    held = urls.withColumns({"_hc": chars("_host"), "_pc": chars("_path")})
    return held.withColumn("_g", F.array_distinct(F.concat(*_grams("_hc", "h", buckets), *_grams("_pc", "p", buckets)))).drop("_hc", "_pc")


def _chance(weights: list[float], bias: float) -> Column:
    held = F.from_json(F.lit(json.dumps(weights)), "array<double>")
    total = F.aggregate("_g", F.lit(0.0), lambda a, g: a + F.get(held, g))
    return 1 / (1 + F.exp(-(F.lit(bias) + total / F.sqrt(F.greatest(F.size("_g"), F.lit(1))))))


def train(labelled: DataFrame, buckets: int = BUCKETS, steps: int = STEPS) -> tuple[list[float], float]:
    """Weights by bucket and bias from ``labelled`` (_g, _y with 1 for block), which is small by contract.

    Both classes weigh the same. Without rows, or with one class only, all weights are 0 and the bias decides for the
    class there is; without rows it is for allow.
    """
    held = stored(labelled.select("_g", F.col("_y").cast("double").alias("_y")).coalesce(2), "url-sample")
    n, ones = held.agg(F.count("*"), F.sum("_y")).first()
    ones = ones or 0
    if ones in (0, n):
        return [0.0] * buckets, 1.0 if n and ones else -1.0
    weights, bias = [0.0] * buckets, 0.0
    share = F.when(F.col("_y") == 1, 0.5 / ones).otherwise(0.5 / (n - ones))
    for _ in range(steps):
        slope = F.round((F.col("_y") - _chance(weights, bias)) * share * n * _UNIT).cast("long")
        each = held.select(slope.alias("s"), F.size("_g").alias("k"), F.explode(F.concat(F.array(F.lit(-1)), "_g")).alias("b"))
        part = F.when(F.col("b") < 0, F.col("s")).otherwise(F.round(F.col("s") / F.sqrt("k")).cast("long"))
        for b, total in each.groupBy("b").agg(F.sum(part)).collect():  # one row a bucket at most
            if b < 0:
                bias += RATE / 4 * total / _UNIT / n
            else:
                weights[b] += RATE * (total / _UNIT / n - RIDGE * weights[b])
        weights = [round(w, 9) for w in weights]
        bias = round(bias, 9)
    return weights, bias


def url_filter(pages: DataFrame, rules=RULES, sample: int = SAMPLE) -> DataFrame:
    """Verdict on every row of ``pages`` (page_id, url).

    The labelled table is made of the URLs that a rule decides: at most ``sample`` of them, the first by a hash. Null or
    odd URLs have an empty host and path and are judged by the model like any other; repeated rows are kept; other
    columns are ignored; an empty table gives an empty result.
    """
    host, path = host_and_path(F.col("url"))
    split = pages.select("page_id", host.alias("_host"), path.alias("_path"))
    ruled = split.withColumn("_r", fitting_rule(F.col("_host"), F.col("_path"), rules))
    known = ruled.where("_r IS NOT NULL").select("_host", "_path", (F.col("_r.verdict") == "block").cast("int").alias("_y")).distinct()
    small = known.orderBy(F.xxhash64("_host", "_path"), "_host", "_path").limit(sample)
    weights, bias = train(with_grams(small))
    chance = F.round(_chance(weights, bias), 6)
    return with_grams(ruled).select(
        "page_id",
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_r.rule").alias("rule"),
        F.coalesce(F.col("_r.verdict"), F.when(chance >= 0.5, "block").otherwise("allow")).alias("verdict"),
        chance.alias("chance"),
    )


def chance_of(weights: list[float], bias: float, grams: list[int]) -> float:
    """The model's chance of block for one URL, in plain Python: for tests."""
    total = sum(weights[g] for g in grams) / math.sqrt(max(len(grams), 1))
    return 1 / (1 + math.exp(-(bias + total)))
