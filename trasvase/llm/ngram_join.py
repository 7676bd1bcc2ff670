"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is its set of distinct five-word shingles. Shingles stand in one global order, rare ones first. If two sets
are similar enough, the prefixes that hold all but (needed overlap - m) shingles of each share at least m shingles, for
any m. Each document picks its own m: a longer prefix has more postings to read but leaves fewer candidates, and the
frequencies of its shingles tell what each choice would cost. Sets are verified only if as many prefix shingles are
shared as the smaller m of the two.

Document frequencies come from packed hash lists (see ``exchange``), so shingles of one document only never leave their
chunk, and a document with too few shared shingles is done there. Equal sets become one class. Classes are linked in two
steps that end in the same components as all pairs would: first every class is verified against one hub, the class it
shares most prefix shingles with among those with fewest of their own; then every class against the members of every
other component it may have a link into. A group of thousands of near copies is so joined through hubs, and no pairs of a
group are ever listed. Where the number of links of each document is asked for too, all classes of a component then meet in
cells, and a cell hands on one number a class.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trasvase.llm import exchange as ex
from trasvase.llm.substring_dedup import _table, _texts
from trasvase.session import stored

#: Words of a shingle; similarity in percent; largest m a document may pick.
SHINGLE, SIMILAR, MOST_MATCHES = 5, 75, 8
#: Cost of verifying a candidate, per shingle of the document, against the cost of reading one posting.
VERIFY = 0.2
#: Classes and members that meet in one cell, about.
CELL = 512

_SENT = "_range int, _chunk int, hashes binary, twice binary, counts binary"
_ANSWER = "_chunk int, hashes binary, counts binary"
_PROFILE = "doc_id {id}, n long, sig long, tokens array<long>, m int, prefix int"


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; a text of one to four words is one shingle."""
    words = ex.word_hashes(text.lower().split())  # bytes: letters and white space of ASCII only
    if 0 < len(words) < SHINGLE:
        return ex.window_hashes(words, len(words), salt=len(words))
    return np.unique(ex.window_hashes(words, SHINGLE))


def needed(n: int) -> int:
    """Shingles that a set of ``n`` must share with any set similar to it."""
    return -(-SIMILAR * n // 100)


def best_matches(n: int, frequencies: np.ndarray) -> tuple[int, int]:
    """Number m of prefix shingles a partner must share, and how many shared shingles the prefix then holds.

    ``frequencies`` are those of the shingles that other documents have too, in order; the others come before them. Any m
    is exact; the one of least estimated cost is taken: postings read, and postings over m candidates to verify.
    """
    alone = n - len(frequencies)
    reach = np.concatenate([[0], np.cumsum(frequencies - 1, dtype=np.float64)])
    best = (np.inf, 1, 0)
    for m in range(1, min(MOST_MATCHES, needed(n)) + 1):
        prefix = n - needed(n) + m - alone
        postings = reach[min(prefix, len(frequencies))]
        best = min(best, (postings + postings / m * VERIFY * n, m, prefix))
    return best[1], best[2]


def _send(bits: int, ranges: int):
    cut = np.uint64(64 - bits)

    def send(table: pa.Table) -> pa.Table:
        sets = [shingles(x) >> cut for x in _texts(table)]
        every, counts = np.unique(np.concatenate(sets), return_counts=True)
        twice, more = every[counts > 1], counts[counts > 1].astype(np.uint32)
        edges = [np.searchsorted(ex.range_of(x, bits, ranges), np.arange(ranges + 1)) for x in (every, twice)]
        chunk, rows = table["_chunk"][0].as_py(), []
        for r in range(ranges):
            (a, b), (c, d) = [(e[r], e[r + 1]) for e in edges]
            if a < b:
                rows.append((r, chunk, ex.pack(every[a:b]), ex.pack(twice[c:d]), ex.pack_numbers(more[c:d])))
        return _table(rows, _SENT)

    return send


def _frequencies(table: pa.Table) -> pa.Table:
    """Per chunk its hashes that two documents or more have, with the number of documents."""
    chunks, lists = table["_chunk"].to_pylist(), [ex.unpack(x) for x in table["hashes"].to_pylist()]
    twice = [ex.unpack(x) for x in table["twice"].to_pylist()]
    more = [ex.unpack_numbers(x, np.uint32) for x in table["counts"].to_pylist()]
    every, counts = np.unique(np.concatenate(lists), return_counts=True)
    for own, count in zip(twice, more):
        counts[np.searchsorted(every, own)] += count.astype(np.int64) - 1
    shared, number = every[counts > 1], np.minimum(counts[counts > 1], 2**32 - 1).astype(np.uint32)
    rows = []
    for chunk, own in zip(chunks, lists):
        found = own[ex.member(own, shared)]
        if len(found):
            rows.append((chunk, ex.pack(found), ex.pack_numbers(number[np.searchsorted(shared, found)])))
    return _table(rows, _ANSWER)


def _profiles(bits: int):
    cut = np.uint64(64 - bits)

    def profiles(table: pa.Table, answer: pa.Table) -> pa.Table:
        """A row a document: set size, signature, and its shared shingles in order if they may be enough for a link."""
        known = np.concatenate([np.zeros(0, np.uint64), *[ex.unpack(x) for x in answer["hashes"].to_pylist()]])
        number = np.concatenate([np.zeros(0, np.uint32), *[ex.unpack_numbers(x, np.uint32) for x in answer["counts"].to_pylist()]])
        order = np.argsort(known, kind="stable")
        known, number = known[order], number[order]
        sizes, signs, tokens, matches, prefixes = [], [], [], [], []
        for text in _texts(table) if table.num_rows else []:
            own = shingles(text)
            low = own >> cut
            found = ex.member(low, known)
            sizes.append(len(own))
            signs.append(int(ex.xxhash.xxh3_64_intdigest(own.tobytes())) - 2**63)
            if not len(own) or int(found.sum()) < needed(len(own)):
                tokens.append(None)
                matches.append(0)
                prefixes.append(0)
                continue
            count = number[np.searchsorted(known, low[found])]
            place = np.lexsort((own[found], count))
            m, prefix = best_matches(len(own), count[place])
            tokens.append(own[found][place].view(np.int64))
            matches.append(m)
            prefixes.append(prefix)
        return pa.table(
            {
                "doc_id": table["doc_id"],
                "n": pa.array(sizes, pa.int64()),
                "sig": pa.array(signs, pa.int64()),
                "tokens": pa.array(tokens, pa.list_(pa.int64())),
                "m": pa.array(matches, pa.int32()),
                "prefix": pa.array(prefixes, pa.int32()),
            }
        )

    return profiles


def profiles(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n, sig, and for rows that may link with another: tokens, m, prefix."""
    plain = docs.select("doc_id", "text")
    size = ex.corpus_bytes(plain)
    bits, ranges = ex.bits_for(size), ex.ranges_for(size)
    chunked, _ = ex.in_chunks(plain, size)
    sent = chunked.groupBy("_chunk").applyInArrow(ex.handing_back(_send(bits, ranges)), _SENT)
    answer = sent.groupBy("_range").applyInArrow(ex.handing_back(_frequencies), _ANSWER)
    shape = _PROFILE.format(id=dict(plain.dtypes)["doc_id"])
    return chunked.groupBy("_chunk").cogroup(answer.groupBy("_chunk")).applyInArrow(ex.handing_back(_profiles(bits)), shape)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The links among ``pairs`` (a, b) of classes."""
    left = sets.select(F.col("sig").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("sig").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    common = both.select("a", "b", "na", "nb", F.size(F.array_intersect("ta", "tb")).cast("long").alias("c"))
    return common.where(100 * F.col("c") >= SIMILAR * (F.col("na") + F.col("nb") - F.col("c"))).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(sig, comp) for every class with a link; ``comp`` is the smallest class of its component.

    Large stars and small stars in turn: links are drawn to the smallest neighbour until nothing changes. Each round is a
    table in the shared folder.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    edges = stored(edges, "join-links")
    before = None
    while True:
        ways = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = ways.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = ways.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        star = large.join(small, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(star.union(small.select("u", F.col("m").alias("v"))).where("u != v").distinct(), "join-stars")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("u").alias("sig"), F.col("v").alias("comp")).union(edges.select(F.col("v").alias("sig"), F.col("v").alias("comp"))).distinct()


def postings_of(sets: DataFrame) -> DataFrame:
    """(token, sig, n, m, alone, pos) for the shared shingles in each class's prefix; ``pos`` counts the unshared before."""
    held = sets.withColumn("alone", (F.col("n") - F.size("tokens")).cast("int"))
    each = held.select("sig", "n", "m", "alone", F.posexplode(F.slice("tokens", 1, F.col("prefix"))).alias("at", "token"))
    return each.select("token", "sig", "n", "m", "alone", (F.col("alone") + F.col("at") + 1).alias("pos"))


def hub_pairs(postings: DataFrame) -> DataFrame:
    """For each class (a) the one class (b) it shares most prefix shingles with, among the hub of each shingle.

    The hub is the class with the smallest part of shingles of its own, as an original has among its near copies.
    """
    rank = F.struct((F.col("alone") / F.col("n")).alias("own"), "sig")
    hubs = postings.groupBy("token").agg(F.min(rank)["sig"].alias("b"), F.count("*").alias("k")).where("k > 1")
    shared = postings.join(hubs.select("token", "b"), "token").where("sig != b").groupBy(F.col("sig").alias("a"), "b").count()
    return shared.groupBy("a").agg(F.max(F.struct("count", F.col("b"))).alias("x")).select("a", "x.b")


def reachable(postings: DataFrame, labels: DataFrame) -> DataFrame:
    """(sig, comp): the classes that may have a link into a component that is not theirs.

    Of two sets of given sizes the overlap needed is known: each must have as many shared shingles, and a common one
    counts only if it stands early enough in both. A component stands in a shingle's list with one row a set size, by the
    best of its members, and of two components the classes of the smaller meet the larger. So a list costs what its small
    components need, not its square. A class must share m prefix shingles with members of one size.
    """
    whole = labels.groupBy("comp").agg(F.count("*").alias("size"))
    known = postings.join(labels, "sig", "left").withColumn("comp", F.coalesce("comp", "sig")).join(whole, "comp", "left")
    known = known.withColumns({"rank": F.struct(F.coalesce("size", F.lit(1)).alias("size"), "comp"), "shared": F.col("n") - F.col("alone")})
    groups = known.groupBy("token", "rank", "n").agg(
        F.max("shared").alias("shared"), F.min("pos").alias("pos"), F.max("m").alias("m"), F.min("m").alias("least")
    )
    heads = groups.groupBy("token").agg(F.max("rank").alias("head"), F.min("rank").alias("tail")).where("head != tail")
    named = lambda s: [F.col(c).alias(f"{c}{s}") for c in ("rank", "n", "m", "shared", "pos")]
    left = known.join(heads, "token").where("rank != head").select("token", "sig", *named(1))
    right = groups.select("token", "least", *named(2))
    overlap = F.ceil(SIMILAR * (F.col("n1") + F.col("n2")) / (100 + SIMILAR))
    room = F.least("m1", "m2") - overlap
    early = (F.col("pos1") <= F.col("n1") + room) & (F.col("pos2") <= F.col("n2") + room)
    enough = F.least("shared1", "shared2") >= overlap
    met = left.join(right, "token").where(enough & early & (F.col("rank1") < F.col("rank2")))
    met = met.groupBy("sig", F.col("rank2.comp").alias("comp"), "n2")
    return met.agg(F.count("*").alias("k"), F.min(F.least("m1", "least")).alias("m")).where("k >= m").select("sig", "comp").distinct()


def _meet(asked: pa.Table, held: pa.Table) -> pa.Table:
    """For each asked set and component the most similar of the held members, if the two are a link."""
    rows: list[tuple[int, int]] = []
    if asked.num_rows and held.num_rows:
        members, sizes, sigs = held["comp"].to_numpy(), held["n"].to_numpy(), held["sig"].to_numpy()
        lists = held["tokens"].combine_chunks()
        flat, edges = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
        owner = np.repeat(np.arange(len(edges)), edges)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        for sig, comp, n, own in zip(*(asked[c].to_pylist() for c in ("sig", "comp", "n")), asked["tokens"]):
            tokens = own.values.to_numpy()
            a, b = np.searchsorted(flat, tokens), np.searchsorted(flat, tokens, side="right")
            found = np.concatenate([owner[x:y] for x, y in zip(a.tolist(), b.tolist())])
            common = np.bincount(found, minlength=len(sizes)) * (members == comp)
            union = n + sizes - common
            best = int(np.argmax(common / union))
            if common[best] and 100 * common[best] >= SIMILAR * union[best]:
                rows.append((sig, int(sigs[best])))
    return _table(rows, "a long, b long")


def open_links(postings: DataFrame, sets: DataFrame, labels: DataFrame) -> DataFrame:
    """A link (a, b) for each class and each other component it has links into, with at least one per pair of components.

    Classes and the members of the components they may reach meet in cells of bounded size, each class with each block of
    members; only links leave a cell.
    """
    reach = stored(reachable(postings, labels), "join-reach")
    members = sets.join(labels, "sig", "left").select("sig", "n", "tokens", F.coalesce("comp", "sig").alias("comp"))
    asked = reach.groupBy("comp").agg(F.count("*").alias("asked"))
    size = members.groupBy("comp").agg(F.count("*").alias("size")).join(asked, "comp")
    parts = stored(size.select("comp", F.ceil(F.col("asked") / CELL).alias("ways"), F.ceil(F.col("size") / CELL).alias("blocks")), "join-cells")
    spread = F.pmod(F.xxhash64("comp"), F.lit(max(1, -(-reach.count() // CELL))))
    deal = lambda c, k: F.pmod(F.xxhash64(c), F.col(k))
    all_of = lambda k: F.explode(F.sequence(F.lit(0).cast("long"), F.col(k) - 1))
    names = ["cell", "way", "block", "comp", "sig", "n", "tokens"]
    left = reach.join(parts, "comp").withColumns({"way": deal("sig", "ways"), "cell": spread}).withColumn("block", all_of("blocks"))
    left = left.join(sets.select("sig", "n", "tokens"), "sig").select(*names).toDF(*names)
    right = members.join(parts, "comp").withColumns({"block": deal("sig", "blocks"), "cell": spread}).withColumn("way", all_of("ways"))
    right = right.select(*names).toDF(*names)
    by = names[:3]
    return left.groupBy(by).cogroup(right.groupBy(by)).applyInArrow(ex.handing_back(_meet), "a long, b long")


def _joined(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of ``docs`` (doc_id, n, sig), classes (sig, n, copies, tokens, ...) and (sig, comp) of classes with a link."""
    rows = stored(profiles(docs), "join-profiles")
    classes = rows.where("tokens IS NOT NULL").groupBy("sig", "n").agg(
        F.min("doc_id").alias("low"), F.count("*").alias("copies"), F.first("tokens").alias("tokens"), F.first("m").alias("m"), F.first("prefix").alias("prefix")
    )
    sets = stored(classes, "join-classes")
    postings = stored(postings_of(sets), "join-postings")
    links = stored(verified(hub_pairs(postings), sets), "join-hub-links")
    first = stored(components(links), "join-hub-components")
    more = stored(open_links(postings, sets, first), "join-open-links")
    return rows, sets, components(links.union(more))


def _labelled(rows: DataFrame, sets: DataFrame, comps: DataFrame) -> DataFrame:
    """``rows`` without tokens, with component_id (null: the row's own id)."""
    ends = stored(sets.select("sig", "low").join(comps, "sig"), "join-ends")
    labels = ends.join(ends.groupBy("comp").agg(F.min("low").alias("component_id")), "comp").select("sig", "component_id")
    alone = sets.join(comps, "sig", "left_anti").select("sig", F.col("low").alias("component_id"))
    return rows.drop("tokens").join(stored(labels.union(alone), "join-labels"), "sig", "left")


def _count_links(table: pa.Table) -> pa.Table:
    """Per set of a cell the copies of the sets in it that it has a link to; within a block, or between two blocks."""
    comps, sizes, blocks, copies = [table[c].to_numpy() for c in ("comp", "n", "block", "copies")]
    across = table["low"][0].as_py() != table["high"][0].as_py()
    lists = table["tokens"].combine_chunks()
    flat, edges = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
    owner = np.repeat(np.arange(len(edges)), edges)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    rows = []
    for at, (sig, own) in enumerate(zip(table["sig"].to_pylist(), table["tokens"])):
        tokens = own.values.to_numpy()
        a, b = np.searchsorted(flat, tokens), np.searchsorted(flat, tokens, side="right")
        common = np.bincount(np.concatenate([owner[x:y] for x, y in zip(a.tolist(), b.tolist())]), minlength=len(sizes))
        linked = (comps == comps[at]) & (100 * common >= SIMILAR * (sizes[at] + sizes - common))
        linked &= blocks != blocks[at] if across else np.arange(len(sizes)) != at
        if linked.any():
            rows.append((sig, int(copies[linked].sum())))
    return _table(rows, "sig long, links long")


def class_links(sets: DataFrame, comps: DataFrame) -> DataFrame:
    """(sig, links): for every class with a link the documents of other classes it has a link to.

    All links of a class are in its component. The classes of a component are dealt into blocks, and each block meets itself
    and each other block once, in a cell of bounded size; a cell gives one number a class, whatever the number of links.
    """
    ways = comps.groupBy("comp").agg(F.ceil(F.count("*") / CELL).alias("ways"))
    cells = max(1, -(-comps.count() // CELL))
    each = sets.select("sig", "n", "copies", "tokens").join(comps.join(ways, "comp"), "sig")
    each = each.withColumns({"block": F.pmod(F.xxhash64("sig"), F.col("ways")), "cell": F.pmod(F.xxhash64("comp"), F.lit(cells))})
    each = each.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("ways") - 1)))
    each = each.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("ways", "other")
    found = each.groupBy("cell", "low", "high").applyInArrow(ex.handing_back(_count_links), "sig long, links long")
    return found.groupBy("sig").agg(F.sum("links").alias("links"))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    ``component_id`` is the smallest doc_id reachable by links, its own included. Null and empty texts have no shingle
    and no link. Rows with one doc_id are documents of their own; a null doc_id counts as larger than all others, and a
    component of such rows only has none. Other columns are ignored.
    """
    return _labelled(*_joined(docs)).select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def jaccard_links(docs: DataFrame) -> DataFrame:
    """``jaccard_components`` with class_id, one number for all rows of equal sets, and n_links.

    ``n_links`` is the number of other rows whose sets are similar enough, equal sets included. ``class_id`` is null for a
    row without shingles.
    """
    rows, sets, comps = _joined(docs)
    comps = stored(comps, "join-components")
    others = class_links(sets, comps)
    links = sets.join(others, "sig", "left").select("sig", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    found = _labelled(rows, sets, comps).join(stored(links, "join-links-of-classes"), "sig", "left")
    return found.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), F.when(F.col("n") > 0, F.col("sig")).alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` without those whose component has a smaller doc_id; all columns as they were, whatever their names.

    Only the ids to drop are joined back, so a document meets at most one row. Documents with no id stay.
    """
    found = jaccard_components(docs)
    drop = stored(found.where("component_id != doc_id").select("doc_id").distinct(), "join-drop")
    return docs.join(drop, docs["doc_id"] == drop["doc_id"], "left_anti")
