"""Each operator against a plain version, and on nulls, empty and long texts, ties, repeated rows and empty tables."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import compare
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from trasvase.llm import (
    exchange, mixing, ngram_join, packing, quality_classifier, quality_rules, queries, substring_dedup, topk, toxicity, url_filter, wavelet,
)

SMALL = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")

DRAW = random.Random(5)
VOCABULARY = ["".join(DRAW.choices("abcdefghij", k=DRAW.randint(1, 7))) for _ in range(400)]


def prose(n, draw=DRAW):
    return " ".join(draw.choices(VOCABULARY, k=n))


LONG, BASE = prose(20_000), prose(200)
ROWS = [
    (1, BASE), (2, BASE), (2, BASE), (3, BASE + " one more word here"), (4, None), (5, ""), (6, "  \n\t "), (7, "Uno  dos"), (8, "uno dos"),
    (9, LONG), (10, prose(60) + "\n" + BASE[300:800] + "\n" + prose(60)), (None, prose(40)), (11, "it's a_b caf\u00e9 \u4f60\u597d e\u0301 \u00a0\u2003x <|endoftext|> \u0130I"), (18, "plain <|endoftext|><|startoftext|>x"),
    (12, "x\nx\n\nx y\nx y"), (13, "a b c d e f g " * 40), (14, "$$$ ### ||| <a> & %"), (15, prose(3)), (16, prose(4)), (17, prose(5)),
]
SHAPE = "doc_id long, text string, lang string, source string, n_chars long, score double, kept string, Words string"


def frame(spark, rows=ROWS):
    more = [(i, t, None if i == 4 else "en", None if i == 5 else f"src{(i or 0) % 3}", len(t or ""), 0.5, "k", "w") for i, t in rows]
    return spark.createDataFrame(more, SHAPE)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(params=["edges", "given"])
def texts(request, spark):
    return frame(spark) if request.param == "edges" else documents(spark)


@pytest.fixture
def chunks(monkeypatch):
    """Several chunks and hash ranges on small data."""
    monkeypatch.setattr(exchange, "CHUNK_BYTES", 40_000)
    monkeypatch.setattr(exchange, "RANGE_HASHES", 3_000)


def pairs_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def as_bag(rows):
    return collections.Counter(map(tuple, rows))


# ---------------------------------------------------------------- 1 quality rules


def plain_counts(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = collections.Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit)


def test_base_counts(spark, texts):
    rows = quality_rules.base_counts(texts).select("doc_id", "_q.*", quality_rules.base_failed().alias("bad")).collect()
    expected = []
    for i, t in pairs_of(texts):
        c = plain_counts(t)
        expected.append((i, *c, c[0] < 10 or 100 * c[4] > 20 * c[0]))
    assert as_bag(rows) == as_bag(expected)


def test_likelihood_ratio(spark):
    good, bad = [(i, prose(80)) for i in range(40)], [(i, " ".join(f"q{DRAW.randint(0, 50)}z" for _ in range(80))) for i in range(40, 50)]
    docs = frame(spark, good + bad)
    out = quality_rules.quality_rules(docs, quality_rules.trusted_sample(labels(spark, [(i, 1, 0) for i in range(0, 40, 2)])))
    assert {r.doc_id for r in out.collect() if r.kept} == set(range(40))
    assert all(r.llr == 0 for r in quality_rules.quality_rules(docs, labels(spark).select("doc_id")).collect())
    assert quality_rules.quality_rules(docs.limit(0), labels(spark).select("doc_id")).count() == 0


def test_every_trusted_document_counts(spark):
    known = spark.range(30_000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    assert quality_rules.trusted_sample(known).count() == 30_000
    docs = known.selectExpr("doc_id", "concat('w', doc_id % 300) AS text").union(spark.range(30_000, 30_300).selectExpr("id", "concat('z', id % 300)"))
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    ratios = quality_rules.log_ratios(docs, quality_rules.trusted_sample(known), 50)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with ids too many to broadcast
        assert quality_rules.log_ratios(docs, quality_rules.trusted_sample(known), 50) == ratios
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
    buckets = docs.withColumn("_w", F.array("text")).select("doc_id", F.explode(quality_rules._grams("_w", 50)).alias("b")).collect()
    raw, good = collections.Counter(r.b for r in buckets), collections.Counter(r.b for r in buckets if r.doc_id < 30_000)
    part = 30_000 / 30_300
    assert ratios == [round(math.log((good[b] + 5) / (raw[b] * part + 5)), 4) for b in range(50)]


# ---------------------------------------------------------------- 2 URL filter

URLS = [
    (1, "http://A.Example.org/es/1"), (2, "https://example.org/en/12?x"), (3, "https://x.org"), (4, "https://x.org/"), (5, "ftp://b.com/fr/"),
    (6, "http://b.com/de/7#t"), (7, None), (8, ""), (9, "no scheme"), (10, "http://c.net/de/1"), (10, "http://c.net/de/1"), (11, "a\n://y.com/fr/\nz"),
    (12, "http://notexample.org/es/"), (13, "http://d.net/" + "x" * 20_000), (None, "http://com/fr/x"),
]


def plain_rule(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host) :])[0]
    host = host.translate({i: i + 32 for i in range(65, 91)})
    fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    _, rule, verdict = max(fits, default=(0, None, None))
    return host, path, rule, verdict


def test_url_filter(spark):
    pages = spark.createDataFrame([(i, u, "h", "v") for i, u in URLS], "page_id long, url string, host string, verdict string")
    rows = url_filter.url_filter(pages).collect()
    assert as_bag((r.page_id, r.host, r.path, r.rule) for r in rows) == as_bag((i, *plain_rule(u)[:3]) for i, u in URLS)
    for r in rows:
        assert r.verdict == ({v[1] + v[2]: v[0] for v in url_filter.RULES}.get(r.rule) or ("block" if r.chance >= 0.5 else "allow"))
    assert url_filter.url_filter(pages.limit(0)).count() == 0


def test_url_model_learns_and_matches_a_plain_sum(spark):
    rows = [(f"www.a{i}.net", f"/good/{i}", 0) for i in range(40)] + [(f"www.b{i}.net", f"/casino/{i}", 1) for i in range(20)]
    held = url_filter.with_grams(spark.createDataFrame(rows, "_host string, _path string, _y int"))
    weights, bias = url_filter.train(held)
    for r in held.withColumn("p", url_filter._chance(weights, bias)).collect():
        assert math.isclose(r.p, url_filter.chance_of(weights, bias, r._g), abs_tol=1e-9)
        assert (r.p >= 0.5) == bool(r._y)


# ---------------------------------------------------------------- 3 and 5 tokens


def whole_ids(path, text):
    from tokenizers import Tokenizer

    tokenizer = whole_ids.__dict__.setdefault(path, Tokenizer.from_file(path))
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def in_order(docs):
    return sorted(pairs_of(docs), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))


def test_token_shards(spark, texts, chunks):
    expected, start = [], 0
    for i, t in in_order(texts):
        ids = [*whole_ids(BYTES, t), 0]
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert as_bag(wavelet.token_shards(texts, BYTES).collect()) == as_bag(expected)


def test_token_shards_of_nothing(spark):
    assert wavelet.token_shards(frame(spark).limit(0), BYTES).count() == 0


@pytest.mark.parametrize("n,top", [(1, 1), (7, 2), (513, 9), (5000, 50257)])
def test_wavelet_matrix(n, top):
    ids = np.random.default_rng(n).integers(0, top, n).astype(np.uint16)
    matrix = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(ids).to_bytes())
    assert (matrix.decode() == ids).all()
    draw = random.Random(n)
    for i in [0, n - 1, *draw.choices(range(n), k=40)]:
        token, a = int(ids[i]), draw.randint(0, n)
        b = draw.randint(a, n)
        assert matrix.access(i) == token
        assert matrix.count(token, a, b) == int((ids[a:b] == token).sum())
        assert matrix.occurrences(token)[:5] == np.flatnonzero(ids == token)[:5].tolist()
    assert matrix.count(top + 70_000) == 0
    with pytest.raises(IndexError):
        matrix.access(n)
    with pytest.raises(IndexError):
        matrix.select(int(ids[0]), n)


def test_packing(spark, texts, chunks):
    rows = packing.pack(texts, WORDS, with_ids=True).collect()
    expected = collections.Counter((i, tuple([*whole_ids(WORDS, t), 2])) for i, t in pairs_of(texts))
    found = collections.Counter()
    for (i, _), group in itertools.groupby(sorted(rows, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: (r.doc_id, id(r) * 0)):
        whole = []
        for r in group:
            if r.start == 0 and whole:
                found[i, tuple(whole)] += 1
                whole = []
            assert (r.start, r.length, r.ids_crc32) == (len(whole), len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes()))
            whole += r.ids
            assert r.doc_tokens >= len(whole)
        found[i, tuple(whole)] += 1
    assert found == expected
    lengths = collections.defaultdict(int)
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == lengths[r.sequence_id]
        lengths[r.sequence_id] += r.length
    assert max(lengths.values()) <= packing.LENGTH
    assert packing.pack(texts.limit(0), WORDS).count() == 0


def plain_cost(at, penalty, length):
    at, penalty = [0, *at], [0, *penalty]
    cost = [0] + [math.inf] * (len(at) - 1)
    for j in range(1, len(at)):
        cost[j] = min(cost[i] + length - at[j] + at[i] + penalty[j] for i in range(j) if at[j] - at[i] <= length)
    return cost[-1]


def test_cuts_cost_as_little_as_all_cuts_tried():
    draw = random.Random(3)
    for _ in range(60):
        at = list(itertools.accumulate(draw.choices(range(1, 30), k=draw.randint(1, 60))))
        penalty = [draw.choice([0, 4, 64]) for _ in at]
        found = packing.cuts(np.array(at), np.array(penalty), 40)
        windows = np.diff([0, *found])
        assert windows.max() <= 40 and found[-1] == at[-1]
        assert sum(40 - windows) + sum(penalty[at.index(x)] for x in found) == plain_cost(at, penalty, 40)


# ---------------------------------------------------------------- 4 toxicity


def plain_segments(scores):
    """All maximal segments by their definition: best, then the same on both sides."""
    best = max(((sum(scores[a:b]), a - b, a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=(0,))
    if best[0] <= 1e-9:
        return []
    _, _, a, b = best
    return [*plain_segments(scores[:a]), (a, b), *[(x + b, y + b) for x, y in plain_segments(scores[b:])]]


def test_segments_are_the_maximal_ones():
    draw = random.Random(8)
    for _ in range(40):
        scores = {w: round(draw.uniform(-2, 3), 3) for w in "abc"}
        model = toxicity.Model(scores, 1.0, 1.0, 1.0, 0.0)
        tokens = draw.choices(["a", "b", "c", "zz"], k=14)
        values = [scores.get(t, -toxicity.DRIFT) for t in tokens]
        found, n = model.segments(" ".join(tokens))
        assert n == 14
        assert math.isclose(sum(s for s, _, _ in found), sum(sum(values[a:b]) for a, b in plain_segments(values)), abs_tol=1e-6)


def test_toxicity(spark):
    bad = ["vile", "nasty", "scum"]
    rows = [(i, prose(60) + (" " + " ".join(DRAW.choices(bad, k=3)) + " " + prose(20) if i % 4 == 0 else "")) for i in range(200)]
    known = labels(spark, [(i, 1, int(i % 4 == 0)) for i, _ in rows] + [(1, 1, None), (2, None, 0)])
    out = {r.doc_id: r for r in toxicity.classify(frame(spark, rows), known).collect()}
    assert sum(r.predicted == (i % 4 == 0) for i, r in out.items()) >= 195
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in out.items())
    edges = toxicity.classify(frame(spark), known).collect()
    assert len(edges) == len(ROWS) and all(0 <= r.score <= 1 for r in edges)
    assert {r.score for r in toxicity.classify(frame(spark), labels(spark)).collect()} == {0.5}
    assert toxicity.classify(frame(spark).limit(0), known).count() == 0


def test_tokens_are_whole_words_and_pieces_of_runs():
    assert toxicity.tokens_of("A loser, lose\u2019 \u00c9t\u00e9; LOSES") == ["a", "loser", "lose", "\u00c9t\u00e9", "loses"]
    assert toxicity.tokens_of("\u4f60\u597d\u5417\u3002\u597d ok\u0e01\u0e02\u0e03 \U0001f600\U0001f600") == [
        "\u4f60\u597d", "\u597d\u5417", "\u597d", "ok", "\u0e01\u0e02", "\u0e02\u0e03", "\U0001f600", "\U0001f600"
    ]
    assert toxicity.tokens_of(None) == []


def test_toxicity_of_words_with_one_beginning_and_of_text_without_spaces(spark):
    draw, signs = random.Random(6), [chr(0x4E00 + i) for i in range(80)]
    rows = [(i, prose(30, draw) + (" loser loser " if i % 4 == 0 else " lose loses ") + prose(30, draw)) for i in range(200)]
    for i in range(200, 400):
        text = draw.choices(signs, k=60)
        rows.append((i, "".join(text[:40]) + ("\u5783\u573e\u5e9f\u7269" if i % 4 == 0 else "") + "".join(text[40:])))
    out = {r.doc_id: r.predicted for r in toxicity.classify(frame(spark, rows), labels(spark, [(i, 1, int(i % 4 == 0)) for i, _ in rows])).collect()}
    assert sum(p == (i % 4 == 0) for i, p in out.items() if i < 200) >= 195
    assert sum(p == (i % 4 == 0) for i, p in out.items() if i >= 200) >= 195


# ---------------------------------------------------------------- 8 quality classifier


def test_descent_separates():
    draw = np.random.default_rng(1)
    rows = [(np.sort(draw.choice(20, 5, replace=False)) + (20 if i % 2 else 0), np.full(5, 0.4)) for i in range(60)]
    y = np.array([1.0 if i % 2 else -1.0 for i in range(60)])
    weight, bias = quality_classifier.descend(rows, y, 40, np.ones(60))
    assert all((weight[at] @ v + bias) * s > 0 for (at, v), s in zip(rows, y))


def test_quality_classifier(spark):
    rows = [(i, prose(60) if i % 5 else " ".join(w.upper() + "!!" for w in prose(60).split())) for i in range(200)]
    known = labels(spark, [(i, int(i % 5 > 0), 0) for i, _ in rows] + [(3, None, 0)])
    docs = frame(spark, rows)
    out = quality_classifier.classify(docs, known).collect()
    assert all(r.predicted == int(r.doc_id % 5 > 0) for r in out)
    kept = quality_classifier.keep_good(docs, known)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, _ in rows if i % 5}
    edges = quality_classifier.classify(frame(spark), known).collect()
    assert len(edges) == len(ROWS) and all(0 <= r.score <= 1 for r in edges) and [r.held_out for r in edges if r.doc_id is None] == [True]
    assert {r.score for r in quality_classifier.classify(frame(spark), labels(spark)).collect()} == {0.5}
    assert quality_classifier.classify(docs.limit(0), known).count() == 0


# ---------------------------------------------------------------- 6 top-k


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "VECTORS", 60)
    monkeypatch.setattr(topk, "QUERIES", 2)
    draw = np.random.default_rng(4)
    rows = [(int(i), draw.normal(0, 0.3, 8).tolist(), "x") for i in range(300)]
    rows += [(i, [0.5] * 8, "x") for i in range(300, 420)] + [(420, [0.1] * 3, "x"), (450, [0.2] * 3, "x"), (7, rows[7][1], "x")]
    rows += [(500, None, "x"), (550, [None] * 8, "x"), (600, [math.nan] * 8, "x"), (650, [], "x"), (None, [0.9] * 8, "x"), (700, [math.inf] * 8, "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    held = {i: np.floor(256 * np.array(v)).astype(int) for i, v, _ in rows if i is not None and v and None not in v and np.isfinite(v).all()}
    expected = []
    for q in (i for i in held if i % 50 == 0):
        near = sorted((-int(held[q] @ v), i) for i, v in held.items() if i != q and len(v) == len(held[q]))[:5]
        expected += [(q, k, i, -s) for k, (s, i) in enumerate(near, 1)]
    assert as_bag(topk.top_k(table, "vec_id % 50 = 0").collect()) == as_bag(expected)
    assert topk.top_k(table.limit(0), "vec_id % 50 = 0").count() == 0


# ---------------------------------------------------------------- 7 substring dedup


def test_substring_dedup(spark, texts, chunks):
    seen, expected = set(), []
    for i, t in in_order(texts):
        words = WORD.findall(t or "")
        gone = [False] * len(words)
        for p in range(len(words) - 19):
            window = tuple(words[p : p + 20])
            if window in seen:
                gone[p : p + 20] = [True] * 20
            seen.add(window)
        left = " ".join(w for w, g in zip(words, gone) if not g)
        expected.append((i, len(words), sum(gone), hashlib.sha256(left.encode()).hexdigest(), left if any(gone) else t))
    found = substring_dedup.substring_dedup(texts)
    assert as_bag(found.drop("spans").collect()) == as_bag(r[:4] for r in expected)
    assert all(r.n_removed == sum(s.end - s.start for s in r.spans) for r in found.collect())
    cut = substring_dedup.remove_repeats(texts)
    assert cut.schema == texts.schema or cut.dtypes == texts.dtypes
    assert as_bag(pairs_of(cut)) == as_bag((r[0], r[4]) for r in expected)
    assert substring_dedup.substring_dedup(texts.limit(0)).count() == 0


# ---------------------------------------------------------------- 10 n-gram join


def plain_components(rows):
    sets = []
    for _, t in rows:
        words = WORD.findall((t or "").translate({i: i + 32 for i in range(65, 91)}))
        sets.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set()))
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            parent[top(b)] = top(a)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[top(i)] = min(doc, low.get(top(i), doc))
    return as_bag((doc, len(sets[i]), low.get(top(i))) for i, (doc, _) in enumerate(rows))


def test_ngram_join(spark, texts, chunks):
    rows = [(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(texts).collect()]
    assert as_bag(rows) == plain_components(pairs_of(texts))


def test_ngram_join_of_a_large_group(spark, chunks, monkeypatch):
    monkeypatch.setattr(ngram_join, "CELL", 16)
    base, rows = prose(150).split(), []
    for i in range(160):
        words = base[:]
        for _ in range(DRAW.choice([0, 1, 2, 3, 4, 5, 6])):
            words[DRAW.randrange(150)] = f"n{DRAW.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    found = [(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(frame(spark, rows)).collect()]
    assert as_bag(found) == plain_components(rows)


def plain_links(rows):
    sets = []
    for _, t in rows:
        words = WORD.findall((t or "").translate({i: i + 32 for i in range(65, 91)}))
        sets.append(frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) or (frozenset([tuple(words)]) if words else frozenset()))
    count = [0] * len(rows)
    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            count[a] += 1
            count[b] += 1
    return as_bag((doc, len(s), n) for (doc, _), s, n in zip(rows, sets, count)), len({s for s in sets if s})


def test_ngram_join_counts_every_link(spark, texts, chunks):
    rows = ngram_join.jaccard_links(texts).collect()
    expected, classes = plain_links(pairs_of(texts))
    assert as_bag((r.doc_id, r.n_shingles, r.n_links) for r in rows) == expected
    assert len({r.class_id for r in rows} - {None}) == classes
    assert as_bag((r.doc_id, r.n_shingles, r.component_id) for r in rows) == plain_components(pairs_of(texts))


def test_ngram_join_counts_links_inside_a_large_group(spark, chunks, monkeypatch):
    monkeypatch.setattr(ngram_join, "CELL", 16)
    base, rows = prose(150).split(), []
    for i in range(160):
        words = base[:]
        for _ in range(DRAW.choice([0, 1, 2, 3, 4, 5, 6])):
            words[DRAW.randrange(150)] = f"n{DRAW.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    found = ngram_join.jaccard_links(frame(spark, rows)).collect()
    assert as_bag((r.doc_id, r.n_shingles, r.n_links) for r in found) == plain_links(rows)[0]
    assert ngram_join.jaccard_links(frame(spark).limit(0)).count() == 0


def test_ngram_join_of_nothing(spark):
    assert ngram_join.jaccard_components(frame(spark).limit(0)).count() == 0


def test_any_choice_of_matches_keeps_every_similar_pair():
    draw = random.Random(2)
    for _ in range(200):
        n = draw.randint(1, 60)
        frequencies = np.sort(np.array(draw.choices(range(2, 40), k=draw.randint(ngram_join.needed(n), n))))
        m, prefix = ngram_join.best_matches(n, frequencies)
        assert 1 <= m <= max(1, ngram_join.needed(n)) and prefix == n - ngram_join.needed(n) + m - (n - len(frequencies))


# ---------------------------------------------------------------- 9 source mix


def test_shortage_goes_to_siblings_before_ancestors(spark):
    rows = [("web", "en", "a", 100), ("web", "en", "b", 1000), ("web", "de", "c", 1000), ("news", "en", "d", 4000)]
    leaves = spark.createDataFrame(rows, "domain string, lang string, source string, tokens long").withColumn("docs", F.lit(1).cast("long"))
    mix = mixing.Mix(part=(2000, 6100), max_epochs=1)
    found = {r.source: r.budget for r in mixing.leaf_budgets(leaves, mix).collect()}
    assert found == {"a": 100, "b": 400, "c": 500, "d": 1000}  # a falls short by 150: b takes it, not c or d
    scarce = {r.source: r.budget for r in mixing.leaf_budgets(leaves, mixing.Mix(part=(5000, 6100), max_epochs=1)).collect()}
    assert scarce == {"a": 100, "b": 1000, "c": 1000, "d": 2900}  # web is used up, the rest goes to news
    none = {r.source: r.budget for r in mixing.leaf_budgets(leaves, mixing.Mix(domain={"web": 0}, part=(1, 1), max_epochs=1)).collect()}
    assert none == {"a": 0, "b": 0, "c": 0, "d": 4000}


def test_mix_edges(spark):
    docs = frame(spark)
    rows = mixing.mix_sources(docs).collect()
    assert set(rows[0].asDict()) == {*docs.columns, "_mix"}
    total = sum(len(WORD.findall(t or "")) for _, t in ROWS)
    assert sum(r._mix.n_tokens for r in rows) <= total * 3 // 5
    assert as_bag(rows) == as_bag(mixing.mix_sources(docs.repartition(3)).collect())
    assert mixing.mix_sources(docs.limit(0)).count() == 0


def test_pipeline_mix_hands_out_all_tokens(spark):
    rows = [(i, prose(50), ["en", "de", "fr", "es"][i % 4], f"src{i // 4 % 8}", 0) for i in range(640)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.mixed(spark, docs, SMALL).collect()
    assert 640 - 32 - 2 <= len(out) <= 640  # each leaf may lose part of a document, rounding less than two in all
    assert max(collections.Counter(r.doc_id for r in out).values()) == 2


# ---------------------------------------------------------------- registered queries and pipeline


@pytest.fixture(scope="module")
def con():
    return compare.duck(SMALL)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_twin(spark, con, name):
    assert compare.differences(queries.QUERIES[name](spark, SMALL), con, queries.ORACLES[name]) == []


def test_pipeline(spark):
    docs, seen = documents(spark), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        if name != "packing":
            assert out.columns == docs.columns
            path = corpus_pipeline.scratch_path(spark, "test-stage")
            out.write.parquet(path)
            docs = spark.read.parquet(path)
            seen.append(docs.count())
    assert seen[0] < documents(spark).count() and seen[0] > seen[1] == seen[2]
    pieces = corpus_pipeline.run(spark, SMALL).collect()
    whole = {(r.doc_id, r.doc_tokens) for r in pieces}
    assert sum(r.length for r in pieces) >= sum(n for _, n in whole)
    assert {r.doc_id for r in pieces} == {r.doc_id for r in docs.collect()}


def test_pipeline_rows_after_every_stage(spark, tmp_path, chunks):
    draw = random.Random(9)
    passage, rows = prose(25, draw), []
    for i in range(200):
        text = prose(60, draw) if i % 5 else " ".join(w.upper() + "!!" for w in prose(60, draw).split())
        if i % 5 and i % 7 == 0:
            text = prose(40, draw) + " " + passage + " " + prose(40, draw)
        if i % 5 in (2, 4) and i % 3 == 0:
            text = rows[-1][1] + " and more"
        rows.append((i, text, ["en", "de"][i % 2], f"src{i % 6}", len(text), 0.5, "k", "w"))
    spark.createDataFrame(rows, SHAPE).write.parquet(f"{tmp_path}/documents.parquet")
    labels(spark, [(i, int(i % 5 > 0), 0) for i in range(200)]).write.parquet(f"{tmp_path}/labels.parquet")

    good = [(r[0], r[1]) for r in rows if r[0] % 5]
    low = plain_component_of(good)
    first = [(i, t) for i, t in good if low[i] == i]
    seen, cut = set(), []
    for i, t in first:
        words = t.split()
        gone = [False] * len(words)
        for p in range(len(words) - 19):
            window = tuple(words[p : p + 20])
            if window in seen:
                gone[p : p + 20] = [True] * 20
            seen.add(window)
        cut.append((i, " ".join(w for w, g in zip(words, gone) if not g)))
    assert len(good) > len(first) and first != cut

    docs, expected = spark.read.parquet(f"{tmp_path}/documents.parquet"), [good, first, cut]
    before = {r[0]: r for r in rows}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        path = f"{tmp_path}/stage-{k}"
        stage(spark, docs, str(tmp_path)).write.parquet(path)
        docs = spark.read.parquet(path)
        if k < 3:
            whole = [(i, t, *before[i][2:4], len(t), *before[i][5:]) for i, t in expected[k]]
            assert as_bag(docs.collect()) == as_bag(whole), name
    con = compare.duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/stage-2/*.parquet')")
    mix = con.execute(f"SELECT doc_id FROM ({queries._mix_sql(mixing.WHOLE)})").fetchall()
    held = dict(cut)
    assert as_bag(pairs_of(docs)) == as_bag((i, held[i]) for (i,) in mix)

    tokens = collections.Counter()
    for i, t in pairs_of(docs):
        tokens[i] += len(whole_ids(WORDS, t)) + 1
    packed = collections.Counter()
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        packed[r.doc_id] += r.length
    assert packed == tokens


def plain_component_of(rows):
    return {doc: low for doc, _, low in plain_components(rows)}
