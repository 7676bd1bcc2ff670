import random
import re

import pytest
from plain import ranked_pairs, walk
from pyspark.sql import functions as F

from trasvase.operators import allocate as al
from trasvase.operators import pairs
from trasvase.operators.pairs import PRODUCT
from trasvase.session import stored

ROLE_SCHEMA = (
    "CODEPRODUIT int, CODECOLORIS int, NOMPRODUIT string, LIBCOLORIS string, CODEMAGASIN string, "
    "PERFIL string, STOCK_TOTAL long, VELOCIDAD_SEMANAL_REAL double, VELOCIDAD_OPERATIVA int, SEMANAS_ROTACION int, APORTE long"
)
MOVE = [
    "CODEPRODUIT", "CODECOLORIS", "EMISOR", "RECEPTOR", "STOCK_INICIAL_RECEPTOR", "STOCK_ANTES", "APORTE", "STOCK_DESPUES",
    "COBERTURA_ANTES", "COBERTURA_DESPUES",
]


def make_roles(seed, groups, stores):
    """Stores at random sending or needing; few distinct values, so that rank keys tie often."""
    rnd = random.Random(seed)
    roles = []
    for product, size in enumerate(groups):
        for store in rnd.sample(range(stores), size):
            sold = rnd.choice([1, 2, 2, 4, 8, 12])
            stock = rnd.randint(0, 6)
            role = rnd.choice(["EMISOR", "EMISOR", "RECEPTOR"])
            working = 1 if sold < 4 else round(sold / 4)
            roles.append(
                {
                    "product": product, "colour": seed % 2, "store": str(store), "role": role, "stock": stock,
                    "speed": sold / 4, "working": working, "weeks": round(stock / working),
                    "holds": stock if rnd.random() < 0.9 else rnd.randint(0, 9),
                }
            )
    return roles


def make_minutes(seed, stores):
    rnd = random.Random(seed)
    return {
        (str(a), str(b)): rnd.choice([5, 10, 10, 20, 40])
        for a in range(stores) for b in range(stores) if a != b and rnd.random() < 0.8
    }


def network(spark, roles, minutes, at_once=pairs.PAIRS_AT_ONCE):
    rows = [
        (
            r["product"], r["colour"], f"P{r['product']}", f"C{r['colour']}", r["store"], r["role"],
            r["stock"], float(r["speed"]), r["working"], r["weeks"], r["holds"],
        )
        for r in roles
    ]
    routes = spark.createDataFrame(
        [(a, b, m) for (a, b), m in minutes.items()], "CODIGO_ORIGEN string, CODIGO_DESTINO string, DISTANCIA_MINUTOS int"
    )
    return pairs.network_of(spark.createDataFrame(rows, ROLE_SCHEMA), routes, at_once)


def rows(df, *columns):
    return sorted(tuple(row) for row in df.select(*columns).collect())


@pytest.mark.parametrize("limits", [al.Limits(), al.Limits(max_cover=3, max_units=6), al.Limits(max_cover=20, max_units=9)])
def test_moves_and_outcomes_equal_a_plain_loop(spark, limits):
    seed = 1
    roles, minutes = make_roles(seed, [25, 12, 3, 1], 30), make_minutes(seed, 30)
    expected, outcomes = walk(roles, minutes, limits.max_cover, limits.max_units)
    done = al.allocate(network(spark, roles, minutes), limits)
    assert rows(done.moves, *MOVE) == sorted(expected)
    found = rows(al.pair_outcomes(done), *PRODUCT, "RECEPTOR", "EMISOR", "RESULTADO")
    assert found == sorted((*key, value) for key, value in outcomes.items())


@pytest.mark.parametrize("at_once", [1, 12])
def test_groups_in_several_rounds_have_the_same_result(spark, at_once):
    roles, minutes = make_roles(3, [20, 9, 4], 24), make_minutes(3, 24)
    limits = al.Limits(max_cover=6, max_units=9)
    expected, outcomes = walk(roles, minutes, limits.max_cover, limits.max_units)
    done = al.allocate(network(spark, roles, minutes, at_once), limits)
    assert al.rounds_of(done.queue) > 1 and done.queue.agg(F.max("TROZOS")).first()[0] > 1
    assert rows(done.moves, *MOVE) == sorted(expected)
    found = rows(al.pair_outcomes(done), *PRODUCT, "RECEPTOR", "EMISOR", "RESULTADO")
    assert found == sorted((*key, value) for key, value in outcomes.items())


def test_senders_and_receivers_meet_once_for_all_rounds(spark, monkeypatch):
    """A round reads its own offers, not all senders and receivers again; rounds without work are not run."""
    roles, minutes = make_roles(3, [20, 9, 4], 24), make_minutes(3, 24)
    expected, _ = walk(roles, minutes, 6, 9)
    held = network(spark, roles + [r for r in roles if r["role"] == "EMISOR"], minutes, 2)  # senders listed twice give once
    limits, met, folds = al.Limits(max_cover=6, max_units=9), [], []
    queue = stored(al.receiver_queue(held, limits), "queue")
    meet, fold = al.meet, al._fold
    monkeypatch.setattr(al, "meet", lambda *args, **named: met.append(1) or meet(*args, **named))
    monkeypatch.setattr(al, "_fold", lambda offers: folds.append(1) or fold(offers))
    moves = al.walk_rounds(held, queue)
    used = queue.filter("TRABAJO > 0").select("RONDA").distinct().count()
    assert al.rounds_of(queue) > used > 1
    assert (len(met), len(folds)) == (1, used)
    assert len(expected) > 3 and rows(moves, *MOVE) == sorted(expected)


def test_log_is_the_same_in_any_number_of_rounds(spark):
    roles, minutes = make_roles(8, [14, 5], 16), make_minutes(8, 16)
    logs = []
    for at_once in (pairs.PAIRS_AT_ONCE, 4):
        done = al.allocate(network(spark, roles, minutes, at_once), al.Limits())
        outcomes = stored(al.pair_outcomes(done), "outcomes")
        stock = _stock(spark, [("1", 0, 0, "a", "S", 1)])
        flags = al.size_coverage_flag(done, stock, outcomes)
        assert rows(al.size_coverage_flag(done, stock), *flags.columns) == rows(flags, *flags.columns)
        log = al.allocation_log(done, outcomes, flags, done.network.roles)
        logs.append(sorted(map(str, log.collect())))
    assert logs[0] == logs[1] and len(logs[0]) > 20


def test_one_product_in_thousands_of_stores(spark):
    """One product holds nearly all rows: rounds are cut by pairs, drop senders that cannot matter, and agree with the loop."""
    roles, stores = make_roles(5, [2500, 3], 2500), 2500
    needing = {r["store"] for r in roles if r["role"] == "RECEPTOR"}
    rnd = random.Random(5)
    minutes = {(r["store"], n): rnd.choice([5, 10, 10, 20, 40]) for r in roles if r["role"] == "EMISOR" for n in needing if rnd.random() < 0.1}
    limits = al.Limits()
    expected, _ = walk(roles, minutes, limits.max_cover, limits.max_units)
    done = al.allocate(network(spark, roles, minutes, 20_000), limits)
    assert stores > len(needing) > 500 and len(expected) > 500 and al.rounds_of(done.queue) > 2
    assert rows(done.moves, *MOVE) == sorted(expected)


def test_routes_are_read_inside_the_pair(spark):
    """No exchange by both store codes, even if nothing may be broadcast; of two times for one way the shorter counts."""
    roles = [_role("1", "EMISOR", 2, 2), _role("2", "EMISOR", 1, 1), _role("8", "RECEPTOR", 3, sold=8), _role("9", "RECEPTOR", 0)]
    held = network(spark, roles, {})
    table = spark.createDataFrame(
        [("1", "8", 9), ("1", "8", 5), ("2", "9", 7), ("2", "1", 3), ("7", "9", 1), ("1", "9", None)], "CODIGO_ORIGEN string, CODIGO_DESTINO string, DISTANCIA_MINUTOS int"
    )
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = pairs.meet(pairs.senders(held.roles), pairs.receivers(held.roles), pairs.Network(held.roles, pairs.routes_of(table), 10))
        assert rows(found, "EMISOR", "RECEPTOR", "DISTANCIA_MINUTOS") == [("1", "8", 5), ("2", "9", 7)]
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
    exchanges = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    assert exchanges and not any("EMISOR" in x and "RECEPTOR" in x for x in exchanges)


def test_a_tie_of_many_pairs_is_numbered_in_parts(spark):
    """All pairs agree in speed, weeks, stock and minutes: they are one value of the first level and are ranked by store codes."""
    n = 300
    table = spark.range(n * n).selectExpr("1 AS g", "0 AS tie", "CAST(id % 300 AS STRING) AS r", "CAST(id DIV 300 AS STRING) AS e")
    ranked = pairs.numbered(stored(table, "ties"), {"tie": False}, {"r": False}, {"e": True}, "RANK", ["g"])
    names = [str(k) for k in range(n)]
    expected = {(r, e): k for k, (r, e) in enumerate(((r, e) for r in sorted(names) for e in sorted(names, reverse=True)), 1)}
    assert {(x.r, x.e): x.RANK for x in ranked.collect()} == expected


@pytest.mark.parametrize("at_once", [pairs.PAIRS_AT_ONCE, 5])
def test_pair_rank(spark, at_once):
    roles, minutes = make_roles(4, [20, 10, 2], 25), make_minutes(4, 25)
    expected = [
        (product, colour, e["store"], r["store"], rank)
        for (product, colour), group in ranked_pairs(roles, minutes).items()
        for rank, (e, r, _) in enumerate(group, 1)
    ]
    ranked = pairs.pair_rank(network(spark, roles, minutes, at_once))
    assert rows(ranked, *PRODUCT, "EMISOR", "RECEPTOR", "PAIR_RANK") == sorted(expected)
    first = {}
    for product, colour, _, receiver, rank in expected:
        first[product, colour, receiver] = min(rank, first.get((product, colour, receiver), rank))
    found = pairs.receiver_rank(ranked).select(*PRODUCT, "RECEPTOR", "RECEIVER_RANK").distinct()
    assert rows(found, *PRODUCT, "RECEPTOR", "RECEIVER_RANK") == sorted((*k, v) for k, v in first.items())


def test_moves_keep_the_limits(spark):
    roles, minutes = make_roles(6, [40, 40], 40), make_minutes(6, 40)
    limits = al.Limits(max_cover=5, max_units=8)
    moves = al.transfer_allocation(network(spark, roles, minutes), limits).collect()
    holds = {(r["product"], r["store"]): r for r in roles}
    sent = [(m.CODEPRODUIT, m.EMISOR) for m in moves]
    assert len(sent) == len(set(sent)) > 0
    for m in moves:
        assert m.APORTE == holds[m.CODEPRODUIT, m.EMISOR]["holds"] > 0
        assert m.STOCK_DESPUES == m.STOCK_ANTES + m.APORTE <= limits.max_units
        assert m.STOCK_DESPUES / holds[m.CODEPRODUIT, m.RECEPTOR]["working"] <= limits.max_cover
    by_receiver = {}
    for m in sorted(moves, key=lambda m: m.STOCK_ANTES):
        before = by_receiver.get((m.CODEPRODUIT, m.RECEPTOR), m.STOCK_INICIAL_RECEPTOR)
        assert m.STOCK_ANTES == before
        by_receiver[m.CODEPRODUIT, m.RECEPTOR] = m.STOCK_DESPUES


def test_same_result_for_any_partitioning(spark):
    roles, minutes = make_roles(7, [30, 20, 10], 30), make_minutes(7, 30)
    results = []
    for partitions, shuffled in (("1", False), ("8", True)):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        if shuffled:
            random.Random(1).shuffle(roles)
        try:
            results.append(rows(al.transfer_allocation(network(spark, roles, minutes), al.Limits()), *MOVE))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1]


def test_cover_limit_compares_like_the_division(spark):
    """4.35 * 100 is 434.99999999999994 in doubles, yet 435 / 100 is within 4.35."""
    speeds = spark.createDataFrame([(1,), (3,), (7,), (10,), (100,)], "VELOCIDAD_OPERATIVA_RECEPTOR int")
    for cover in (8, 4.35, 8.1, 0.7, 2.3, 1 / 3):
        found = speeds.select("VELOCIDAD_OPERATIVA_RECEPTOR", al._ceiling(al.Limits(max_cover=cover, max_units=10_000)))
        for speed, ceiling in found.collect():
            assert ceiling / speed <= cover < (ceiling + 1) / speed


def _stock(spark, lines):
    schema = (
        "CODEMAGASIN string, CODEPRODUIT int, CODECOLORIS int, CODEBARRES string, TAILLE string, TOTAL long"
    )
    return spark.createDataFrame(lines, schema)


def _stores(spark, roles):
    return spark.createDataFrame([(r["store"], f"Store {r['store']}") for r in roles], "CODIGO_TIENDA string, NOMBRE_TIENDA string")


def _role(store, role, stock, holds=0, product=1, sold=4):
    return {
        "product": product, "colour": 0, "store": store, "role": role, "stock": stock, "speed": sold / 4,
        "working": max(1, round(sold / 4)), "weeks": stock, "holds": holds,
    }


def test_thin_sizes_are_reported_and_moves_stand(spark):
    """Receiver 9 has no stock rows, so its opening share is 0; receiver 8 gains nothing in breadth."""
    roles = [
        _role("1", "EMISOR", 2, 2), _role("2", "EMISOR", 1, 1),
        _role("8", "RECEPTOR", 3, sold=8), _role("9", "RECEPTOR", 0, sold=4),
        _role("3", "EMISOR", 4, 4, product=2),
    ]
    minutes = {("1", "8"): 5, ("2", "8"): 5, ("1", "9"): 5, ("2", "9"): 5}
    stock = _stock(spark, [
        ("1", 1, 0, "a", "S", 2), ("1", 1, 0, "b", "M", 0), ("1", 1, 0, "c", "L", 0), ("2", 1, 0, "a", "S", 1),
        ("8", 1, 0, "a", "S", 3), ("8", 1, 0, "b", "M", 0),
    ])
    done = al.allocate(network(spark, roles, minutes), al.Limits(max_cover=2.5, max_units=5))
    assert rows(done.moves, "EMISOR", "RECEPTOR") == [("1", "8"), ("2", "9")]
    outcomes = al.pair_outcomes(done)
    assert rows(al.size_coverage(done.network, stock), "RECEPTOR", "COBERTURA_TALLAS") == [("8", 0.5), ("9", 0.0)]
    flags = al.size_coverage_flag(done, stock, outcomes)
    # 8 ends with one of three sizes; it stopped at sender 1, where its cover was reached
    assert rows(flags, "EMISOR", "RECEPTOR", "MOTIVO") == [("1", "8", al.FEW_SIZES)]
    assert flags.first().COBERTURA_FINAL == pytest.approx(1 / 3)
    stuck = al.stuck_products(done, outcomes, flags)
    assert rows(stuck, "CODEPRODUIT", "EMISOR", "MOTIVO") == [(1, "1", al.FEW_SIZES), (2, "3", al.NO_SALES)]
    final = rows(al.receiver_final_sizes(done, stock), "RECEPTOR", "CODEBARRES", "STOCK_TOTAL")
    assert final == [("8", "a", 5), ("8", "b", 0), ("8", "c", 0), ("9", "a", 1)]

    listed = spark.createDataFrame([(1, 0), (2, 0), (3, 0)], "CODEPRODUIT int, CODECOLORIS int")
    log = al.allocation_log(done, outcomes, flags, listed)
    order = [F.asc("CODEPRODUIT"), F.asc("ORDEN_RECEPTOR"), F.asc_nulls_last("ORDEN_PAR"), F.asc("PASO")]
    assert [r.MSG for r in log.orderBy(*order).collect()] == [
        "INICIO EVALUACIÓN", "4 pares generados",
        "2 productes de 1 a 8", "Emisor 1 acceptat", "Cobertura máxima assolida per receptor 8",
        "Coberturas de tallas insuficiente",
        "0 productes de 1 a 9", "1 productes de 2 a 9", "Emisor 2 acceptat",
        "INICIO EVALUACIÓN", "Producto estancado",
        "INICIO EVALUACIÓN", "Producto estancado",
    ]


def test_move_table_and_log_of_a_refused_receiver(spark):
    roles = [_role("1", "EMISOR", 9, 9), _role("2", "EMISOR", 8, 8), _role("8", "RECEPTOR", 1, sold=4)]
    minutes = {("1", "8"): 5, ("2", "8"): 7}
    done = al.allocate(network(spark, roles, minutes), al.Limits(max_cover=9, max_units=20))
    stock = _stock(spark, [("2", 1, 0, "a", "S", 5), ("2", 1, 0, "b", "M", 3), ("2", 1, 0, "c", None, 0), ("2", 1, 0, "d", "M", 0)])
    photos = spark.createDataFrame([("a", 1, 0, "z"), ("b", 1, 0, "y")], "EAN string, CODEPRODUIT int, CODECOLORIS int, URL_FOTO string")
    (move,) = al.move_table(done, stock, photos, _stores(spark, roles)).collect()
    assert (move.EMISOR, move.TALLAS, move.URL_FOTO, move.NOMBRE_RECEPTOR) == ("2", "M, S", "y", "Store 8")
    assert (move.COBERTURA_ANTES, move.COBERTURA_DESPUES) == (1, 9)
    assert rows(al.rejected_pairs(al.pair_outcomes(done)), "EMISOR", "MOTIVO") == [("1", al.OVER_COVER)]
    few = al.allocate(network(spark, roles, minutes), al.Limits(max_cover=20, max_units=5))
    assert few.moves.isEmpty()
    outcomes = al.pair_outcomes(few)
    assert rows(al.rejected_pairs(outcomes), "EMISOR", "MOTIVO") == [("1", al.OVER_UNITS), ("2", al.OVER_UNITS)]
    flags = al.size_coverage_flag(few, stock, outcomes)
    messages = {r.MSG for r in al.allocation_log(few, outcomes, flags, few.network.roles).collect()}
    assert "Receptor 8 sin posibilidad de enviarle stock" in messages
    assert "Emisor 1 rebutjat. Supera cantitat d'unitats màximes" in messages


def test_published_cover_rounds_half_to_even(spark):
    roles = [_role("1", "EMISOR", 1, 1), _role("8", "RECEPTOR", 4, sold=8)]
    done = al.allocate(network(spark, roles, {("1", "8"): 5}), al.Limits())
    photos = spark.createDataFrame([], "EAN string, CODEPRODUIT int, CODECOLORIS int, URL_FOTO string")
    (move,) = al.move_table(done, _stock(spark, []), photos, _stores(spark, roles)).collect()
    assert (move.STOCK_DESPUES, move.COBERTURA_DESPUES, move.URL_FOTO, move.TALLAS) == (5, 2, "#", "")


def test_routes_keep_only_ways_of_stores_that_meet(spark):
    """Ways between stores without a product in common leave the table as it is read, and no row holds all ways of a store."""
    roles = [_role(str(n), "EMISOR", 2, 2) for n in range(3)] + [_role("900", "RECEPTOR", 0), _role("901", "RECEPTOR", 1)]
    held = network(spark, roles, {(str(a), str(b)): (a + b) % 50 + 1 for a in range(3) for b in range(400, 1000)})
    kept = held.distance.minutes.select("EMISOR", F.explode(F.map_keys("MINUTOS")).alias("RECEPTOR"))
    assert kept.count() < 3 * 30 and held.distance.minutes.agg(F.max(F.size("MINUTOS"))).first()[0] < 30
    found = pairs.meet(pairs.senders(held.roles), pairs.receivers(held.roles), held)
    assert rows(found, "EMISOR", "RECEPTOR", "DISTANCIA_MINUTOS") == sorted((str(a), str(b), (a + b) % 50 + 1) for a in range(3) for b in (900, 901))


def test_a_large_route_table_is_built_in_many_tasks(spark):
    from trasvase.fixtures import Given

    assert Given(spark, "/root/testdata/sf0.001").distancias.rdd.getNumPartitions() == 8


def test_pairs_of_one_piece_are_ranked_and_named_without_an_exchange(spark):
    """Senders and receivers are dealt out, their pairs are not; a store listed twice brings its pairs with each of its names."""
    roles, minutes = make_roles(6, [12, 9, 3], 15), make_minutes(6, 15)
    codes = sorted({r["store"] for r in roles})
    stores = spark.createDataFrame([(c, f"N{c}") for c in codes] + [(codes[0], "again")], "CODIGO_TIENDA string, NOMBRE_TIENDA string")
    names = {c: [f"N{c}"] + (["again"] if c == codes[0] else []) for c in codes}
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        held = network(spark, roles, {})
        held = pairs.Network(held.roles, pairs.routes_of(spark.createDataFrame([(a, b, m) for (a, b), m in minutes.items()], "CODIGO_ORIGEN string, CODIGO_DESTINO string, DISTANCIA_MINUTOS int")), held.pairs_at_once)
        flat = pairs.Network(held.roles, lambda a, b: F.when(a != b, F.lit(7)), held.pairs_at_once)
        found = pairs.candidate_pairs(held, stores).collect()
        plan = pairs.receiver_rank(pairs.pair_rank(flat))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
    expected = {
        (key, e["store"], r["store"], a, b) for key, group in ranked_pairs(roles, minutes).items() for e, r, _ in group for a in names[e["store"]] for b in names[r["store"]]
    }
    assert sorted(expected) == sorted(((x.CODEPRODUIT, x.CODECOLORIS), x.EMISOR, x.RECEPTOR, x.NOMBRE_EMISOR, x.NOMBRE_RECEPTOR) for x in found)
    exchanges = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    assert exchanges and not any("RECEPTOR" in x or "EMISOR" in x for x in exchanges)


def _three_stores(spark):
    """Store 1 gives to 8 and 2 does not; nobody needs the product that 3 holds."""
    roles = [_role("1", "EMISOR", 2, 2), _role("2", "EMISOR", 0, 0), _role("8", "RECEPTOR", 3, sold=8), {**_role("3", "EMISOR", 5, 5), "product": 77}]
    held = network(spark, roles, {("1", "8"): 5, ("2", "8"): 9})
    product, colour = roles[0]["product"], roles[0]["colour"]
    stock = _stock(spark, [("1", product, colour, "a", "S", 2), ("2", product, colour, "a", "S", 0), ("8", product, colour, "b", "M", 3), ("3", 77, colour, "c", "S", 5)])
    return held, stock


def test_only_stock_of_stores_that_gave_is_summed(spark, monkeypatch):
    """Sizes of the receivers are read once for both shares, and senders of products nobody needs meet nobody."""
    held, stock = _three_stores(spark)
    summed, own, met = [], [], []
    available, sizes, meet = al.available_by_size, al.receiver_sizes, al.meet
    monkeypatch.setattr(al, "available_by_size", lambda rows: summed.append(rows) or available(rows))
    monkeypatch.setattr(al, "receiver_sizes", lambda *args: own.append(1) or sizes(*args))
    monkeypatch.setattr(al, "meet", lambda giving, *args, **named: met.append(giving) or meet(giving, *args, **named))
    done = al.allocate(held)
    al.size_coverage_flag(done, stock)
    assert rows(done.moves, "EMISOR", "RECEPTOR") == [("1", "8")]
    assert [rows(found, "CODEMAGASIN") for found in summed] == [[("1",)]] and len(own) == 1
    assert all(("3",) not in rows(giving, "EMISOR") for giving in met) and len(met) >= 3


def test_hardly_a_way_between_stores_that_never_meet_is_kept(spark):
    stores = spark.range(20_000).selectExpr("cast(id as string) AS CODIGO_DESTINO")
    table = stores.selectExpr("'S' AS CODIGO_ORIGEN", "CODIGO_DESTINO", "1 AS DISTANCIA_MINUTOS")
    met = stores.filter("CODIGO_DESTINO % 100 = 7").selectExpr("'S' AS EMISOR", "CODIGO_DESTINO AS RECEPTOR")
    kept = pairs.routes_of(table, met).minutes.select("EMISOR", F.explode("MINUTOS").alias("RECEPTOR", "M"))
    assert kept.join(met, ["EMISOR", "RECEPTOR"]).count() == 200
    assert kept.count() < 200 + 100  # one bit a receiver kept some 480 more
