"""Ranked lexical search, uniform shards and token alignment against plain versions, and on edges."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from test_operators import ROWS, SMALL, as_bag, documents, frame, pairs_of, prose, texts  # noqa: F401
from trasvase.llm import alignment, lexical, queries, shuffling, tokens
from trasvase.session import scratch_path

# ---------------------------------------------------------------- 11 ranked lexical search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    return TERM.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def plain_scores(docs, wanted):
    """(doc_id, score) of every document, in the order of the ranks."""
    held = [(i, plain_terms(t)) for i, t in docs]
    held = [(i, ws, collections.Counter(ws)) for i, ws in held if ws]
    n_docs, n_terms = len(held), sum(len(ws) for _, ws, _ in held)
    df = collections.Counter(t for _, _, c in held for t in c)
    found = []
    for i, ws, c in held:
        m = 100 - 25 + 25 * len(ws) * n_docs // n_terms
        score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in wanted if c[t])
        if score > 0:
            found.append((i, score))
    return sorted(found, key=lambda r: (-r[1], r[0] is None, r[0] or 0))


def plain_search(docs, items, k):
    return as_bag((item, rank, *row) for item, t in items for rank, row in enumerate(plain_scores(docs, plain_terms(t))[:k], 1))


ITEMS = [(1, BASE := ROWS[0][1][:300]), (2, None), (3, ""), (4, "?!"), (5, "uno DOS uno café 你好"), (6, "nowhere"), (1, BASE), (None, "x y x"), (7, ROWS[9][1])]


@pytest.mark.parametrize("block,part", [(1 << 20, 2_000_000), (400, 50)])
def test_search(spark, texts, monkeypatch, block, part):  # noqa: F811
    monkeypatch.setattr(lexical, "BLOCK_BYTES", block)
    monkeypatch.setattr(lexical, "PART_POSTINGS", part)
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id long, text string, rank int")
    found = lexical.search(texts.repartition(3), items, 4)
    assert found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert as_bag(found.collect()) == plain_search(pairs_of(texts), ITEMS, 4)


def test_search_of_nothing(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical.search(frame(spark).limit(0), items).count() == 0
    assert lexical.search(frame(spark), items.limit(0)).count() == 0


def test_search_ties_go_to_the_smaller_id(spark):
    docs = [(i, "same words here") for i in range(50, 0, -1)] + [(i, "other text") for i in range(100, 160)]
    found = lexical.search(frame(spark, docs).repartition(7), spark.createDataFrame([(1, "same words")], "item_id long, text string")).collect()
    assert sorted((r.rank, r.doc_id) for r in found) == [(i, i) for i in range(1, 21)]


def test_best_positions_stop_early_and_lose_nothing():
    draw = np.random.default_rng(7)
    sooner = 0
    for _ in range(60):
        n, n_terms = int(draw.integers(1, 400)), int(draw.integers(1, 7))
        held = [np.sort(draw.choice(n_terms, draw.integers(0, n_terms + 1), replace=False)) for _ in range(n)]
        starts, terms = np.cumsum([0, *map(len, held)]), np.concatenate([*held, []]).astype(np.int32)
        impacts = (1000 / draw.integers(1, 1000, len(terms))).astype(np.int64)
        lists = lexical.ImpactLists(starts, terms, impacts, np.arange(n), n_terms)
        wanted = {t: int(draw.integers(1, 4)) for t in range(n_terms) if draw.random() < 0.8}
        scores = [sum(int(i) * wanted.get(int(t), 0) for t, i in zip(terms[a:b], impacts[a:b])) for a, b in zip(starts, starts[1:])]
        expected = sorted((-s, d) for d, s in enumerate(scores) if s > 0)[:5]
        docs, found, looked = lists.best(wanted, 5)
        assert list(zip((-found).tolist(), docs.tolist())) == expected
        sooner += looked < sum(1 for h in held if set(h.tolist()) & set(wanted))
    assert sooner > 10


# ---------------------------------------------------------------- 12 shards


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(shuffling, "BLOCK_ROWS", 40)


def test_shards(spark, texts, small_blocks):  # noqa: F811
    path = scratch_path(spark, "test-docs")
    texts.repartition(3).write.parquet(path)
    rows = shuffling.shard_rows(spark, path).collect()
    plain = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in pairs_of(texts)]
    assert as_bag(r[:3] for r in rows) == as_bag(plain)
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert (r.law, r.grown_shard) == ("rows", None)
    sizes = [len(slots[s]) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(v) == list(range(len(v))) for v in slots.values())
    # the same, however the files are split into tasks
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
        assert as_bag(shuffling.shard_rows(spark, path).collect()) == as_bag(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert as_bag(shuffling.shard_rows(spark, path, seed=1).collect()) != as_bag(rows)


def test_shards_keep_every_column_and_the_order_of_slots(spark, small_blocks):
    docs = frame(spark, [(i, f"t{i}") for i in range(300)]).withColumns({"_slot": F.lit("a"), "_shard": F.lit("b"), "_row": F.lit(None).cast("int")})
    path, folder = scratch_path(spark, "test-docs"), scratch_path(spark, "test-shards")
    docs.write.parquet(path)
    shuffling.write_shards(spark, path, folder, 3)
    held = spark.read.parquet(folder)
    assert as_bag(held.select("_row.*").collect()) == as_bag(docs.collect())
    at = held.select("_slot", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("i")).collect()
    for _, group in itertools.groupby(sorted(at, key=lambda r: (r.f, r.i)), key=lambda r: r.f):
        slots = [r._slot for r in group]
        assert slots == sorted(slots)


def test_shards_of_nothing(spark):
    path = scratch_path(spark, "test-docs")
    frame(spark).limit(0).write.parquet(path)
    assert shuffling.shard_rows(spark, path).count() == 0


def test_matrix_has_exact_sums_and_the_law_of_a_uniform_shuffle():
    before, columns = np.array([0, 3, 3, 8, 12]), np.array([5, 4, 3])
    hits = np.zeros((12, 3))
    for seed in range(4000):
        matrix = shuffling.Matrix(before, columns, seed)
        rows = [matrix.row(k) for k in range(4)]
        assert sum(rows).tolist() == columns.tolist() and [int(r.sum()) for r in rows] == [3, 0, 5, 4]
        dealt = np.concatenate([matrix.targets(k) for k in range(4)])
        hits[np.arange(12), dealt] += 1
    expected = 4000 * columns / 12
    assert (((hits - expected) ** 2 / expected).sum(axis=1) < 16).all()  # chi squared, 2 degrees of freedom


def test_draw_for_large_tables_follows_the_law():
    good, bad, sample, rng = 60, 140, 50, np.random.default_rng(3)
    drawn = collections.Counter(shuffling._large_draw(rng, good, bad, sample) for _ in range(40_000))
    chance = {x: math.comb(good, x) * math.comb(bad, sample - x) / math.comb(good + bad, sample) for x in range(sample + 1)}
    for x, p in chance.items():
        assert abs(drawn[x] - 40_000 * p) < 5 * math.sqrt(40_000 * p) + 5
    wide = shuffling.divide(rng, np.array([10**12, 0, 3 * 10**12, 5]), 2 * 10**12)
    assert wide.sum() == 2 * 10**12 and abs(wide[0] - 5 * 10**11) < 10**8 and wide[1] == 0 and 0 <= wide[3] <= 5


# ---------------------------------------------------------------- 13 alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain_tokens(text):
    """Ids with their byte ranges, by whole texts."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    held = plain_tokens.__dict__
    if "a" not in held:
        held["a"], held["b"] = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
        held["a"].encode_special_tokens = True
        held["bytes"] = alignment.byte_level_tokens(A)
    a, b = held["a"], held["b"]
    if not text:
        return [], []
    first = [(i, held["bytes"][i]) for i in a.encode(" " + text, add_special_tokens=False).ids]
    second = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
    if any(b"".join(x for _, x in t) != (" " + text).encode() for t in (first, second)):
        return [], []
    return tuple([(i, e - len(x), e) for (i, x), e in zip(t, itertools.accumulate(len(x) for _, x in t))] for t in (first, second))


def plain_alignment(rows):
    held, counts = [], collections.Counter()
    for i, text in rows:
        a, b = plain_tokens(text)
        links, first = [], 0
        for x, s, e in a:
            while b[first][2] <= s:
                first += 1
            links += [(x, y) for y, *_ in itertools.takewhile(lambda t: t[1] < e, b[first:])]
        common = sorted({e for *_, e in a} & {e for *_, e in b})
        within = lambda t, lo, hi: ",".join(str(x) for x, _, e in t if lo < e <= hi)
        groups = [within(a, lo, hi) + "|" + within(b, lo, hi) for lo, hi in zip([0, *common], common)] if len(common) < 3000 else None
        held.append((i, len(a), len(b), common, links, groups))
        counts.update(set(links))
    best = {}
    for (x, _), n in counts.items():
        best[x] = max(best.get(x, 0), n)
    out = {}
    for k, (i, n_a, n_b, common, links, groups) in enumerate(held):
        sha = None if groups is None else hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out[k] = (i, n_a, n_b, len(common), len(links), sum(counts[x] == best[x[0]] for x in links), sum(counts[x] for x in links), sha)
    return list(out.values())


ODD = ["\x00", "\n", "\n\n", " ", "  ", "\t", "▁", "　", "\xa0", "​", "<s>", "</s>", "<unk>", "<|endoftext|>", "<0x0A>", "é", "é", "你好"]
ODD += ["'s", "it's", "a_b", "\U0001f600", "ﬁ", "İ", "abc", "word", "\r\n", "12", "--", "\x85", "\x1c", "﻿", "क्ष"]


def no_long_groups(rows):
    return as_bag(tuple(r)[:7] for r in rows), {(r[0], r[7]) for r in rows}


@pytest.mark.parametrize("looked_up", [2_000_000, 12_000])
def test_alignment(spark, texts, monkeypatch, looked_up):  # noqa: F811
    monkeypatch.setattr(alignment, "LOOKED_UP", looked_up)
    monkeypatch.setattr(alignment, "FAN", 3)
    found, expected = alignment.align(texts.repartition(5)).collect(), plain_alignment(pairs_of(texts))
    assert no_long_groups(found)[0] == no_long_groups(expected)[0]
    assert no_long_groups(found)[1] >= {x for x in no_long_groups(expected)[1] if x[1] is not None}


def test_alignment_of_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(alignment, "AT_ONCE", 7)
    draw = random.Random(4)
    rows = [(i, "".join(draw.choices(ODD, k=draw.randint(0, 12)))) for i in range(3000)]
    assert as_bag(alignment.align(frame(spark, rows)).collect()) == as_bag(plain_alignment(rows))
    assert alignment.align(frame(spark).limit(0)).count() == 0


def test_perfect_hash():
    draw = np.random.default_rng(5)
    keys = [np.unique(draw.integers(0, 1 << 32, n, dtype=np.uint32)) for n in (0, 1, 2, 5000)]
    sizes, bits = zip(*(alignment.build_hash(k) for k in keys))
    for k, s, b in zip(keys, sizes, bits):
        places = alignment.PerfectHash([s], [b]).places(k, np.zeros(len(k), np.int64))
        assert sorted(places.tolist()) == list(range(len(k)))  # minimal: each place once
    every, bucket = np.concatenate(keys), np.repeat(np.arange(4), [len(k) for k in keys])
    assert sorted(alignment.PerfectHash(sizes, bits).places(every, bucket).tolist()) == list(range(len(every)))


def test_pieces_give_the_ids_of_whole_texts():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    draw = random.Random(6)
    odd = ["".join(draw.choices([*ODD, " the", ",", " x1y", "É", "ǆ", " I'LL"], k=draw.randint(0, 12))) for _ in range(4000)] + [prose(300), ""]
    model = SentencePieceProcessor(model_file=B)
    encode = tokens.PieceEncoder(B)
    assert all(encode(t).tolist() == model.encode(t) for t in odd)
    for path in (A, public_tokenizers.path("word_bpe_49k.json")):
        for plain in (False, True):
            encode, whole = tokens.Encoder(path, plain), Tokenizer.from_file(path)
            whole.encode_special_tokens = plain
            assert all(encode(t).tolist() == whole.encode(t, add_special_tokens=False).ids for t in odd)


def test_a_million_spaces():
    assert len(alignment.ByteLevel(A)(" " * 1_500_000)) == len(tokens.Encoder(A, True)(" " * 1_500_000))


def test_remembered_pieces_stay_within_their_bytes(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED_BYTES", 40_000)
    asked = []
    held = tokens.Remembered(lambda new: asked.extend(new) or [bytes([len(p) % 256, 0]) for p in new])
    for k in range(300):
        pieces = ["the", "and", "x" * 100, *(f"{k}-{j}" for j in range(20))]
        assert held([pieces])[0].tolist() == [len(p) % 256 for p in pieces]
        assert held.size <= 40_000 and "x" * 100 not in held.known
    assert asked.count("the") < 10


def test_registered(spark):
    for name in ("op11_lexical_search", "op12_uniform_shards", "op13_token_alignment"):
        assert queries.QUERIES[name](spark, SMALL).count() > 0
    assert queries.QUERIES["op12_uniform_shards"](spark, SMALL).count() == documents(spark).count()
