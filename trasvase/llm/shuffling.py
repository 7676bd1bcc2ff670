"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

The rows of a table are taken as source blocks, runs of rows of one file. Shards are cut into target blocks whose sizes
are known beforehand. How many rows each source block sends to each target block is one draw from the multivariate
hypergeometric law with those row and column sums, so that every way to deal out the rows is equally likely. The draw is
a tree: the sources are halved again and again, and what a target gets is divided between the halves, each node with its
own seed. A task walks from the root to its block and so has its row of the matrix without the others'. It permutes the
block's rows, deals them out by that row, and after the exchange each target block is permuted again, which gives slots.
Everything follows from the seed and the files, so lost tasks repeat what they did, however the files are split.
"""

from __future__ import annotations

import math
from collections import OrderedDict
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trasvase.session import scratch_path

SHARDS, SEED = 8, 20
#: Rows of a block, at least, and most target blocks (beside one a shard): larger tables have larger blocks.
BLOCK_ROWS, MOST_BLOCKS = 8_192, 32_768
#: Rows from which the library's own draw no longer works.
_LARGE = 1_000_000_000


def _large_draw(rng: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """Hypergeometric draw by ratio of uniforms, for any size."""
    total = good + bad
    mean = sample * good / total
    spread = math.sqrt(mean * (bad / total) * (total - sample) / max(total - 1, 1) + 0.5)
    low, high = max(0, sample - bad), min(good, sample)
    mode = min(max((sample + 1) * (good + 1) // (total + 2), low), high)

    def height(x: int) -> float:
        return -(math.lgamma(x + 1) + math.lgamma(good - x + 1) + math.lgamma(sample - x + 1) + math.lgamma(bad - sample + x + 1))

    # width of the hat for a law with one peak: a part for its spread and a part for its steps
    width, top = 2 * math.sqrt(2 / math.e) * spread + 3 - 2 * math.sqrt(3 / math.e), height(mode)
    while True:
        u, v = max(rng.random(), 1e-300), rng.random()
        x = math.floor(mean + 0.5 + width * (v - 0.5) / u)
        if low <= x <= high and 2 * math.log(u) <= height(x) - top:
            return x


def divide(rng: np.random.Generator, columns: np.ndarray, sample: int) -> np.ndarray:
    """What ``sample`` rows, drawn without replacement from all, take of each column."""
    total = int(columns.sum())
    if total < _LARGE:
        return rng.multivariate_hypergeometric(columns, sample, method="marginals")
    taken = np.zeros_like(columns)
    for i in np.flatnonzero(columns).tolist():
        here = int(columns[i])
        total -= here  # what the columns after this one hold
        if not total:
            taken[i] = sample
        elif here + total < _LARGE:
            taken[i] = rng.hypergeometric(here, total, sample)
        else:
            taken[i] = _large_draw(rng, here, total, sample)
        sample -= int(taken[i])
    return taken


@dataclass(frozen=True)
class Matrix:
    """The communication matrix: sums of its rows (as running sums from 0), sums of its columns, and the seed."""

    before: np.ndarray
    columns: np.ndarray
    seed: int

    def row(self, source: int) -> np.ndarray:
        """Rows that a source block sends to each target block."""
        low, high, held = 0, len(self.before) - 1, self.columns
        while high - low > 1:
            middle = (low + high) // 2
            rng = np.random.default_rng([self.seed, 1, low, high])
            left = divide(rng, held, int(self.before[middle] - self.before[low]))
            if source < middle:
                high, held = middle, left
            else:
                low, held = middle, held - left
        return held

    def targets(self, source: int) -> np.ndarray:
        """Target block of each row of a source block: its row of the matrix, permuted."""
        row = self.row(source)
        dealt = np.repeat(np.arange(len(row), dtype=np.int32), row)
        np.random.default_rng([self.seed, 2, source]).shuffle(dealt)
        return dealt


def block_rows(rows: int) -> int:
    return max(BLOCK_ROWS, -(-rows // MOST_BLOCKS))


def target_blocks(rows: int, shards: int) -> list[tuple[int, int, int]]:
    """Size, shard and first slot there of each target block. Shard sizes are at most one apart."""
    found = []
    for shard in range(shards):
        held = rows // shards + (shard < rows % shards)
        parts = max(1, -(-held // block_rows(rows)))
        ends = [k * held // parts for k in range(parts + 1)]
        found += [(b - a, shard, a) for a, b in zip(ends, ends[1:])]
    return found


def _dealer(files: dict[str, tuple[int, int]], matrix: Matrix, size: int):
    """Target block and number of a row, by its file and its place there."""
    held: OrderedDict[int, np.ndarray] = OrderedDict()

    def targets(block: int) -> np.ndarray:
        if block not in held:
            held[block] = matrix.targets(block)
            if len(held) > 4:
                held.popitem(last=False)
        return held[block]

    @F.pandas_udf("struct<block: int, number: long>")
    def deal(file: pd.Series, index: pd.Series) -> pd.DataFrame:
        at = np.array([files[name] for name in file], np.int64).reshape(-1, 2)
        index = index.to_numpy(np.int64)
        block, place = at[:, 0] + index // size, index % size
        out = np.zeros(len(index), np.int32)
        for b in np.unique(block).tolist():
            mine = block == b
            out[mine] = targets(b)[place[mine]]
        return pd.DataFrame({"block": out, "number": at[:, 1] + index})

    return deal


def shuffled(spark: SparkSession, path: str, shards: int = SHARDS, seed: int = SEED, columns: list[str] | None = None) -> DataFrame:
    """The rows of a Parquet table in a uniform shuffle: ``_shard``, ``_slot`` (from 0 in each shard) and ``_row``, a struct of its columns.

    Every way to deal out and to order the rows is as likely as any other, by ``seed``. Shard sizes are at most one apart.
    The driver holds the files' names and one number a source block.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    table = spark.read.parquet(path)
    meta = table.metadataColumn("_metadata")
    row = F.struct(*[table[f"`{name}`"] for name in columns or table.columns]).alias("_row")
    plain = table.select(row, meta.getField("file_path").alias("_file"), meta.getField("row_index").alias("_index"))
    sizes = sorted(tuple(r) for r in plain.groupBy("_file").agg(F.max("_index") + 1).collect())
    total = sum(n for _, n in sizes)
    size, files, counts, seen = block_rows(total), {}, [], 0
    for file, n in sizes:
        files[file] = (len(counts), seen)
        counts += [min(size, n - k) for k in range(0, n, size)]
        seen += n
    targets = target_blocks(total, shards)
    matrix = Matrix(np.cumsum(np.array([0, *counts], np.int64)), np.array([n for n, _, _ in targets], np.int64), seed)
    known = spark.createDataFrame([(b, s, first) for b, (_, s, first) in enumerate(targets)], "_block int, _shard int, _first long")
    sent = plain.select("_row", _dealer(files, matrix, size)("_file", "_index").alias("_to"))
    sent = sent.select("_row", F.col("_to.block").alias("_block"), F.col("_to.number").alias("_number"))
    again = Window.partitionBy("_block").orderBy(F.xxhash64(F.lit(seed), "_number"), "_number")
    placed = sent.withColumn("_place", F.row_number().over(again) - 1).join(F.broadcast(known), "_block")  # MOST_BLOCKS and shards at most
    return placed.select("_shard", (F.col("_first") + F.col("_place")).alias("_slot"), "_row")


def write_shards(spark: SparkSession, path: str, folder: str, shards: int = SHARDS, seed: int = SEED, columns: list[str] | None = None) -> None:
    """Write the rows of the Parquet table ``path`` as shards: a folder ``_shard=...`` each, files in the order of ``_slot``.

    ``_row`` holds the columns as they are, whatever their names; nulls, empty and long texts and repeated rows stay.
    """
    rows = shuffled(spark, path, shards, seed, columns).sortWithinPartitions("_shard", "_slot")
    rows.write.partitionBy("_shard").option("compression", "zstd").parquet(folder)


def shard_rows(spark: SparkSession, path: str, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Write the documents (doc_id, text) of a Parquet table as shards to the shared folder and give each row's place from the files.

    Columns: doc_id, size (bytes of the text, null as empty, plus 1), text_crc32 (null as empty), law, shard, slot,
    grown_shard (null: the law is ``rows``). Rows with one doc_id or text are rows of their own. An empty table gives no rows.
    """
    folder = scratch_path(spark, "shards")
    write_shards(spark, path, folder, shards, seed, ["doc_id", "text"])
    kind = dict(spark.read.parquet(path).dtypes)["doc_id"]
    held = spark.read.schema(f"_slot long, _row struct<doc_id: {kind}, text: string>, _shard int").parquet(folder)
    text = F.coalesce("_row.text", F.lit("")).cast("binary")
    return held.select(
        "_row.doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.lit("rows").alias("law"),
        F.col("_shard").alias("shard"), F.col("_slot").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
