"""Mixing sources to target weights by hierarchical budgeting.

The tree is domain, language, source; a node's weight counts against its siblings. A token budget is handed down from
the root: a node gets its share of its parent's budget, but no more than its subtree can give, and what it cannot take
goes to its siblings in proportion to their weights. As a node's limit is the sum of its leaves' limits, a shortage is
made good among siblings first and reaches the ancestors' siblings only when the whole subtree is used up.

A leaf can give its tokens ``max_epochs`` times. Its budget is some whole epochs and a prefix of one more; each epoch
has its own seeded order of the documents. The prefix is found from sums per key range, so a leaf of any size is never
sorted as a whole, and documents only meet a small table of leaves: no text is shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trasvase.llm.words import WORD
from trasvase.session import stored

LEVELS = ("domain", "lang", "source")


@dataclass(frozen=True)
class Mix:
    """Whole-number weights by name and level (others have ``other``), budget as a part of all tokens, epochs, seed."""

    domain: dict = field(default_factory=dict)
    lang: dict = field(default_factory=dict)
    source: dict = field(default_factory=dict)
    other: int = 1
    part: tuple[int, int] = (3, 5)
    max_epochs: int = 2
    seed: int = 20


#: The mix of the query.
PRODUCTION = Mix(
    domain={"web": 4, "news": 3, "books": 2, "code": 1},
    lang={"en": 5, "de": 2, "fr": 2, "es": 2},
    source={"src0": 2, "src1": 3},
)
#: The mix of the pipeline: the same weights over as many tokens as there are.
WHOLE = replace(PRODUCTION, part=(1, 1))


def domain_of(source: Column) -> Column:
    """Domain of a source name: by its number modulo four; names without a number are web."""
    number = F.coalesce(F.regexp_extract(source, "([0-9]{1,9})$", 1).try_cast("int"), F.lit(0))
    return F.element_at(F.array(*[F.lit(x) for x in ("web", "news", "books", "code")]), (F.pmod(number, F.lit(4)) + 1).cast("int"))


def _weight(names: dict, other: int, column: str) -> Column:
    found = F.lit(other)
    for name, w in names.items():
        found = F.when(F.col(column) == name, F.lit(int(w))).otherwise(found)
    return found.cast("long")


def _share(nodes: DataFrame, above: list[str], name: str) -> DataFrame:
    """Budgets of siblings (``cap``, ``weight``) from their parent's ``given``, as whole numbers.

    Siblings stand in the order of limit over weight; those at the front take their limit as long as the rest could not
    do with less, and the others share what is left by weight. Up to one token a sibling is lost to rounding.
    """
    order = Window.partitionBy(*above).orderBy(F.col("cap") / F.greatest("weight", F.lit(1)), name)
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    left = F.col("given") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    whole = Window.partitionBy(*above)
    full = nodes.withColumn("full", F.col("cap") * F.sum("weight").over(after) <= left * F.col("weight"))
    taken = F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(whole)
    weights = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(whole)
    full = full.withColumns({"taken": taken, "weights": weights})
    return full.withColumn("budget", F.when(F.col("full"), F.col("cap")).otherwise(F.expr("((given - taken) * weight) div nullif(weights, 0)")))


def leaf_budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """``leaves`` (domain, lang, source, tokens, docs) with ``budget``."""
    weights = {f"w_{c}": _weight(getattr(mix, c), mix.other, c) for c in LEVELS}
    cap = F.when(F.least(*[F.col(f"w_{c}") for c in LEVELS]) > 0, F.col("tokens") * mix.max_epochs).otherwise(0)
    leaves = leaves.withColumns(weights).withColumn("cap", cap)
    total = leaves.agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens"))
    up, down = mix.part
    root = total.select(F.least("cap", F.expr(f"tokens * {up} div {down}")).alias("given"))
    domains = leaves.groupBy("domain").agg(F.sum("cap").alias("cap"), F.max("w_domain").alias("weight")).withColumn("given", root.scalar())
    domains = _share(domains, [], "domain").select("domain", F.col("budget").alias("given"))
    langs = leaves.groupBy("domain", "lang").agg(F.sum("cap").alias("cap"), F.max("w_lang").alias("weight")).join(domains, "domain")
    langs = _share(langs, ["domain"], "lang").select("domain", "lang", F.col("budget").alias("given"))
    last = leaves.withColumnRenamed("w_source", "weight").join(langs, ["domain", "lang"])
    return _share(last, ["domain", "lang"], "source").select(*LEVELS, "tokens", "docs", F.coalesce("budget", F.lit(0)).alias("budget"))


def _key(seed: int, epoch: Column, doc: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc.cast("string"), F.lit(""))))


def _tree(docs: DataFrame) -> DataFrame:
    held = docs.select(
        F.col("doc_id").alias("d"),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("t"),
        F.coalesce(F.col("lang").cast("string"), F.lit("(none)")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("(none)")).alias("source"),
    )
    return held.withColumn("domain", domain_of(F.col("source")))


def leaf_plan(docs: DataFrame, mix: Mix = PRODUCTION) -> DataFrame:
    """Per leaf: ``epochs`` whole epochs, and of the next one the keys up to ``cut`` (null: none)."""
    narrow = stored(_tree(docs), "mix-documents")
    leaves = stored(
        leaf_budgets(narrow.groupBy(*LEVELS).agg(F.sum("t").alias("tokens"), F.count("*").alias("docs")), mix).withColumns(
            {"epochs": F.coalesce(F.expr("budget div nullif(tokens, 0)"), F.lit(0)), "rest": F.coalesce(F.expr("budget % nullif(tokens, 0)"), F.lit(0))}
        ),
        "mix-leaves",
    )
    most = leaves.agg(F.max("docs")).first()[0] or 1
    digits = max(1, math.ceil(math.log(max(most, 2), 16) / 2))  # about as many key ranges in the largest leaf as keys in a range
    part = leaves.where("rest > 0").select(*LEVELS, "epochs", "rest")
    keyed = narrow.join(part, list(LEVELS)).withColumn("key", _key(mix.seed, F.col("epochs"), F.col("d")))
    units = keyed.withColumn("range", F.substring("key", 1, digits))
    sums = units.groupBy(*LEVELS, "range", "rest").agg(F.sum("t").alias("t"))
    order = Window.partitionBy(*LEVELS).orderBy("range")
    ends = sums.withColumn("end", F.sum("t").over(order))
    edge = ends.where("end > rest").groupBy(*LEVELS).agg(F.min(F.struct("range", (F.col("rest") - F.col("end") + F.col("t")).alias("room"))).alias("e"))
    edge = stored(edge.select(*LEVELS, F.col("e.range").alias("range"), F.col("e.room").alias("room")), "mix-edges")
    inside = units.join(edge, [*LEVELS, "range"]).groupBy(*LEVELS, "range", "room", "key").agg(F.sum("t").alias("t"))
    fits = inside.withColumn("end", F.sum("t").over(Window.partitionBy(*LEVELS).orderBy("key"))).where("end <= room")
    cuts = fits.groupBy(*LEVELS).agg(F.max("key").alias("key"))
    cut = edge.join(cuts, list(LEVELS), "left").select(*LEVELS, F.coalesce("key", "range").alias("cut"))
    plan = leaves.select(*LEVELS, F.col("epochs").cast("int").alias("epochs"), "budget", "rest").join(cut, list(LEVELS), "left")
    return stored(plan.withColumn("cut", F.when(F.col("rest") > 0, F.coalesce("cut", F.lit("g")))).drop("rest"), "mix-plan")


def mix_sources(docs: DataFrame, mix: Mix = PRODUCTION) -> DataFrame:
    """Each row of ``docs`` once per epoch it is taken in, with a struct ``_mix`` (domain, lang, source, n_tokens, epoch).

    Null languages and sources are nodes of their own, null texts have no tokens, rows with one doc_id stand or fall
    together within a leaf, and a leaf without tokens gives nothing. All other columns pass through, whatever their names,
    but for a column ``_mix``, which is replaced.
    """
    own = "_mix_"
    while any(c.lower().startswith(own) for c in docs.columns):
        own += "_"
    plan = leaf_plan(docs, mix).select(*[F.col(c).alias(f"{own}of_{c}") for c in (*LEVELS, "epochs", "cut")])
    leaf = docs.withColumns(
        {
            f"{own}lang": F.coalesce(F.col("lang").cast("string"), F.lit("(none)")),
            f"{own}source": F.coalesce(F.col("source").cast("string"), F.lit("(none)")),
            f"{own}domain": domain_of(F.col("source")),
        }
    )
    held = leaf.join(plan, [F.col(f"{own}{c}") == F.col(f"{own}of_{c}") for c in LEVELS])
    epochs, cut = F.col(f"{own}of_epochs"), F.col(f"{own}of_cut")
    last = epochs - F.when(cut.isNotNull() & (_key(mix.seed, epochs, F.col("doc_id")) <= cut), 0).otherwise(1)
    taken = held.withColumn(f"{own}last", last).where(F.col(f"{own}last") >= 0)
    taken = taken.withColumn(f"{own}epoch", F.explode(F.sequence(F.lit(0), F.col(f"{own}last"))))
    count = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    return taken.select(
        *[docs[f"`{c}`"] for c in docs.columns if c.lower() != "_mix"],
        F.struct(
            *[F.col(f"{own}{c}").alias(c) for c in LEVELS], count.alias("n_tokens"), F.col(f"{own}epoch").cast("int").alias("epoch")
        ).alias("_mix"),
    )
