"""Exact top-k by inner product over a vector-approximation file.

The file holds, for every distinct vector, one byte a component: the cell of the component between its smallest and its
largest value. Scanning the cells gives an upper and a lower bound of each inner product. Queries and vectors are dealt
to a grid of blocks of fixed size; a block hands on what its own bounds cannot rule out. Per query, the k-th best lower
bound over all blocks is the mark, and exact vectors are read from the best upper bound down to that mark: beyond it the
k-th result is certain. Copies of one vector are a single entry with its k + 1 smallest ids.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trasvase.session import stored

#: Rows of a block of vectors and of queries; cells a component has; scale of the whole-number components.
VECTORS, QUERIES, CELLS, SCALE = 16_384, 4_096, 256, 256


def whole_vectors(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v) with v = floor(scale * x); rows with a null id, null, empty or non-finite vectors are left out.

    An id with several rows counts once, with its smallest vector.
    """
    held = table.select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    fine = held.where("vec_id IS NOT NULL AND size(e) > 0").where(
        F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    )
    whole = fine.select("vec_id", F.transform("e", lambda x: F.floor(x * scale).cast("long")).alias("v"))
    return whole.groupBy("vec_id").agg(F.min("v").alias("v"))


def approximation_file(vectors: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """The file (dim, key, block, cells) and the entries (key, v, ids); ``key`` is a digest of the vector."""
    entry = vectors.withColumn("key", F.sha2(F.concat_ws(",", "v"), 256))
    first = entry.withColumn("r", F.row_number().over(Window.partitionBy("key").orderBy("vec_id"))).where(F.col("r") <= k + 1)
    entries = stored(
        first.groupBy("key").agg(F.first("v").alias("v"), F.array_sort(F.collect_list("vec_id")).alias("ids")).withColumn("dim", F.size("v")),
        "topk-entries",
    )
    edges = entries.select("dim", F.posexplode("v").alias("j", "x")).groupBy("dim", "j").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    wide = edges.withColumn("step", F.floor((F.col("hi") - F.col("lo")) / CELLS).cast("long") + 1)
    wide = wide.groupBy("dim").agg(F.array_sort(F.collect_list(F.struct("j", "lo", "step"))).alias("g"))  # one number a component
    n = entries.count()
    cut = entries.join(wide, "dim").select(
        "key", "dim", "g", F.pmod(F.xxhash64("key"), F.lit(-(-n // VECTORS) or 1)).cast("int").alias("block"),
        F.zip_with("v", "g", lambda x, g: F.floor((x - g["lo"]) / g["step"]).cast("short")).alias("cells"),
    )
    return stored(cut, "topk-file"), entries


def _scan(k: int):
    def scan(file: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        """Entries of the block that may be among a query's k best: query_id, key, upper, lower."""
        out = [(np.zeros(0, np.int64), np.zeros(0, object), np.zeros(0), np.zeros(0))]
        if len(file) and len(asked):
            low = np.array([g["lo"] for g in file["g"].iloc[0]], np.float64)
            step = np.array([g["step"] for g in file["g"].iloc[0]], np.float64)
            base = low + np.stack(file["cells"].to_numpy()).astype(np.float64) * step
            keys = np.array(file["key"].tolist(), object)
            ids = asked["query_id"].to_numpy()
            q = np.stack(asked["v"].to_numpy()).astype(np.float64)
            spread = (step - 1) * np.abs(q)
            up, down = np.where(q > 0, spread, 0).sum(1), np.where(q < 0, spread, 0).sum(1)
            for at in range(0, len(q), 256):
                mid = q[at : at + 256] @ base.T
                lower, upper = mid - down[at : at + 256, None], mid + up[at : at + 256, None]
                mark = np.partition(lower, -min(k + 1, lower.shape[1]), axis=1)[:, -min(k + 1, lower.shape[1])]
                row, col = np.nonzero(upper >= mark[:, None])
                out.append((ids[at + row], keys[col], upper[row, col], lower[row, col]))
        return pd.DataFrame(dict(zip(("query_id", "key", "upper", "lower"), map(np.concatenate, zip(*out)))))

    return scan


def top_k(table: DataFrame, is_query: str, k: int = 5) -> DataFrame:
    """The ``k`` rows with the highest inner product for each row where ``is_query`` holds, its own row left out.

    ``table`` has vec_id and embedding; other columns are ignored. Columns: query_id, rank (from 1; ties to the smaller
    id), vec_id, score. Vectors meet only vectors of their own length; a query alone has no row. An inner product must
    fit in 53 bits.
    """
    vectors = stored(whole_vectors(table), "topk-vectors")
    file, entries = approximation_file(vectors, k)
    asked = vectors.where(is_query).select(F.col("vec_id").alias("query_id"), "v", F.size("v").alias("dim"))
    blocks, parts = file.agg(F.max("block")).first()[0], -(-asked.count() // QUERIES)
    grid = file.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(max(parts, 1) - 1))))
    dealt = asked.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(max(parts, 1))).cast("int"))
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks or 0))))
    by = ["dim", "block", "part"]
    found = grid.groupBy(by).cogroup(dealt.groupBy(by)).applyInPandas(_scan(k), "query_id long, key string, upper double, lower double")
    best = Window.partitionBy("query_id").orderBy(F.col("lower").desc(), "key")
    found = stored(found, "topk-bounds")
    marks = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).groupBy("query_id").agg(F.min(F.struct(-F.col("r"), "lower")).alias("m"))
    marks = marks.select("query_id", F.col("m.lower").alias("mark"))
    read = found.join(marks, "query_id").where("upper >= mark").select("query_id", "key")
    exact = read.join(entries.select("key", F.col("v").alias("c"), "ids"), "key").join(asked.select("query_id", "v"), "query_id")
    score = F.aggregate(F.zip_with("v", "c", lambda a, b: a * b), F.lit(0).cast("long"), lambda a, x: a + x)
    rows = exact.select("query_id", score.alias("score"), F.explode("ids").alias("vec_id")).where("vec_id != query_id")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
