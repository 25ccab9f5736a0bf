import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from hexmosaic.functions import geo, text
from hexmosaic.functions import hexgrid as hx
from hexmosaic.operators import closest, dedupe, match
from hexmosaic.session import cut_lineage

SCHEMA = "id long, lat double, lng double, name string"


def brute(spark, ours, truth, radius, min_sim):
    """Sorted greedy over site pairs, sites giving out their copies in id order."""
    a, b = spark.createDataFrame(ours, SCHEMA), spark.createDataFrame(truth, SCHEMA)
    norm = (lambda c: text.normalise_name(F.col(c))) if min_sim is not None else (lambda c: F.lit(""))
    d = geo.haversine_m(F.col("a.lat"), F.col("a.lng"), F.col("b.lat"), F.col("b.lng"))
    s = text.jaccard(text.trigrams(norm("a.name")), text.trigrams(norm("b.name")))
    rows = a.alias("a").crossJoin(b.alias("b")).select(
        F.col("a.id").alias("x"), F.col("b.id").alias("y"), d.alias("d"), s.alias("s"),
        F.concat_ws("|", "a.lat", "a.lng", norm("a.name")).alias("sx"), F.concat_ws("|", "b.lat", "b.lng", norm("b.name")).alias("sy"),
    ).where(F.col("d") <= radius)
    if min_sim is not None:
        rows = rows.where(F.col("s") >= min_sim)
    rows = rows.collect()
    first_x, first_y = {}, {}
    for r in rows:
        first_x[r.sx] = min(first_x.get(r.sx, r.x), r.x)
        first_y[r.sy] = min(first_y.get(r.sy, r.y), r.y)
    # smallest id of the whole site, also where only some copies are listed
    rows.sort(key=lambda r: (r.d, -r.s, first_x[r.sx], first_y[r.sy], r.x, r.y))
    ux, uy, out = set(), set(), set()
    for r in rows:
        if r.x not in ux and r.y not in uy:
            ux.add(r.x)
            uy.add(r.y)
            out.add((r.x, r.y))
    return out


def sample(seed, n, copies):
    rnd = random.Random(seed)
    names = ["Wat Phnom", "wat phnom", "Wat Phnum", "Central Market", "Market Central", "Cafe"]
    out = []
    for i in range(n):
        if copies and i % 3 == 0:
            out.append((i, 11.5, 104.9, "Wat Phnom"))
        else:
            out.append((i, 11.5 + rnd.uniform(0, 0.003), 104.9 + rnd.uniform(0, 0.003), rnd.choice(names)))
    return out


@pytest.mark.parametrize("min_sim,copies", [(None, False), (None, True), (0.5, False), (0.5, True)])
def test_matching_equals_greedy(spark, min_sim, copies):
    ours, truth = sample(1, 60, copies), sample(2, 50, copies)
    m = match.match_points(spark.createDataFrame(ours, SCHEMA), spark.createDataFrame(truth, SCHEMA), 100.0, min_sim)
    got = [(r.ours_id, r.truth_id) for r in m.collect()]
    assert len(got) == len({x for x, _ in got}) == len({y for _, y in got})
    assert set(got) == brute(spark, ours, truth, 100.0, min_sim)


@pytest.mark.parametrize("min_sim", [None, 0.0, 0.5])
def test_dense_places_take_halved_radii(spark, monkeypatch, min_sim):
    monkeypatch.setattr(match, "BLOCK_SITES", 40)
    ours, truth = sample(3, 50, True), sample(4, 60, True)
    m = match.match_points(spark.createDataFrame(ours, SCHEMA), spark.createDataFrame(truth, SCHEMA), 100.0, min_sim)
    assert {(r.ours_id, r.truth_id) for r in m.collect()} == brute(spark, ours, truth, 100.0, min_sim)


@pytest.mark.parametrize("lat,lng", [(0.0, 0.0), (50.0, 179.9999), (75.0, -180.0), (-89.9, 3.0), (89.9995, 90.0)])
def test_partners_are_found_everywhere(spark, lat, lng):
    rnd = random.Random(3)
    step = 95 / 111195.08
    ours, truth = [], []
    for i in range(200):
        turn, y = rnd.uniform(0, 360), lat + (i - 100) * 0.02 * (abs(lat) < 80)
        ours.append((i, y, (lng + 1.7 * i + 180) % 360 - 180 if abs(lat) < 80 else turn, "x"))
        east = i % 2 and abs(y) < 80
        x = ours[-1][2] + (step / math.cos(math.radians(y)) if east else 0)
        truth.append((i, y if east else y - step * (1 if y > 0 else -1), (x + 180) % 360 - 180, "x"))
    m = match.match_points(spark.createDataFrame(ours, SCHEMA), spark.createDataFrame(truth, SCHEMA), 100.0)
    got = {(r.ours_id, r.truth_id) for r in m.collect()}
    assert len(got) == 200 if abs(lat) < 80 else got == brute(spark, ours, truth, 100.0, None)


def test_similarity_of_zero_filters_nothing(spark):
    ours = [(i, 11.5, 104.9 + i * 1e-6, f"aa{i}") for i in range(300)]
    truth = [(i, 11.5001, 104.9 + i * 1e-6, f"zz{i}") for i in range(300)]
    m = match.match_points(spark.createDataFrame(ours, SCHEMA), spark.createDataFrame(truth, SCHEMA), 100.0, 0.0)
    assert m.count() == 300


def test_a_hot_place_takes_all_its_partners_at_once(spark, monkeypatch):
    ours = [(i, 11.5, 104.9, "x") for i in range(400)]
    truth = [(i, 11.5 + (i + 1) * 1e-6, 104.9, "x") for i in range(300)]
    rounds = counted_rounds(monkeypatch)
    m = match.match_points(spark.createDataFrame(ours, SCHEMA), spark.createDataFrame(truth, SCHEMA), 100.0)
    assert {(r.ours_id, r.truth_id) for r in m.collect()} == {(i, i) for i in range(300)}
    assert len(rounds) == 1


def counted_rounds(monkeypatch):
    """Rounds of all radii; joins over all pairs are an error."""
    rounds, real = [], match._decide

    def watched(*args):
        for t in real(*args):
            rounds.append(t)
            yield t

    monkeypatch.setattr(match, "_decide", watched)
    monkeypatch.setattr(match, "_greedy", lambda p: pytest.fail("all pairs"))
    return rounds


def greedy_near(ours, truth, radius):
    """Closest-first matching of distinct places, over all pairs in numpy."""
    x, y = (np.array([[r[1], r[2]] for r in rows]) for rows in (ours, truth))
    d = closest.distance(x[:, None, 0], x[:, None, 1], y[None, :, 0], y[None, :, 1])
    used, taken, out = np.zeros(len(x), bool), np.zeros(len(y), bool), set()
    for k in np.argsort(d, axis=None, kind="stable"):
        i, j = divmod(int(k), len(y))
        if d[i, j] > radius:
            break
        if not used[i] and not taken[j]:
            used[i] = taken[j] = True
            out.add((i, j))
    return out


def test_far_groups_measure_few_of_their_pairs(spark, monkeypatch):
    rnd = random.Random(5)
    group = lambda east: [(i, 11.5 + rnd.uniform(0, 9e-5), 104.9 + east + rnd.uniform(0, 9e-5), "x") for i in range(1500)]
    ours, truth = group(0.0), group(80 / 108_900)
    rounds = counted_rounds(monkeypatch)
    m = match.match_points(spark.createDataFrame(ours, SCHEMA), spark.createDataFrame(truth, SCHEMA), 100.0)
    got = {(r.ours_id, r.truth_id) for r in m.collect()}
    assert got == greedy_near(ours, truth, 100.0) and len(rounds) <= 2

    sides = [closest.Side([r[0] for r in rows], np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), np.ones(1500, int), [()] * 1500, np.ones(1500, bool)) for rows in (ours, truth)]
    closest.Tally.measured = 0
    assert {(i, j) for i, j, *_ in closest.decide(*sides, 100.0, None)} == got
    assert closest.Tally.measured < 2_250_000 / 4


def test_a_chain_takes_few_rounds(spark, monkeypatch):
    """Each place is nearer to the next one than to the one before, so all wait for the last."""
    ours, truth, lng = [], [], 104.9
    for i in range(40):
        (ours, truth)[i % 2].append((i // 2, 11.5, lng, "x"))
        lng += (95 - i * 0.9) / 108_900
    rounds = counted_rounds(monkeypatch)
    m = match.match_points(spark.createDataFrame(ours, SCHEMA), spark.createDataFrame(truth, SCHEMA), 100.0)
    assert {(r.ours_id, r.truth_id) for r in m.collect()} == greedy_near(ours, truth, 100.0)
    assert len(rounds) <= 6


@pytest.mark.parametrize("min_sim", [None, 0.5])
def test_blocks_agree_at_their_borders(spark, monkeypatch, min_sim):
    """Points over many blocks, in chains that cross their borders."""
    rnd = random.Random(12)
    names = ["North Gate", "north gate", "South Gate", "Gate"]
    make = lambda n: [(i, 11.5 + rnd.uniform(0, 0.004), 104.9 + rnd.uniform(0, 0.03), rnd.choice(names)) for i in range(n)]
    ours, truth = make(500), make(450)
    monkeypatch.setattr(match, "REACH", 2)
    m = match.match_points(spark.createDataFrame(ours, SCHEMA), spark.createDataFrame(truth, SCHEMA), 80.0, min_sim)
    want = brute(spark, ours, truth, 80.0, min_sim)
    assert {(r.ours_id, r.truth_id) for r in m.collect()} == want


def test_too_crowded_blocks_are_joined(spark, monkeypatch):
    monkeypatch.setattr(match, "BLOCK_SITES", 3)
    ours, truth = sample(5, 40, False), sample(6, 40, False)
    m = match.match_points(spark.createDataFrame(ours, SCHEMA), spark.createDataFrame(truth, SCHEMA), 100.0)
    assert {(r.ours_id, r.truth_id) for r in m.collect()} == brute(spark, ours, truth, 100.0, None)


def test_a_common_stem_gives_few_candidates():
    n = 400
    names = [f"  central market {i:03d} " for i in range(n)]
    grams = [{x[k : k + 3] for k in range(len(x) - 2)} for x in names]
    sides = [closest.Side(list(range(n)), np.full(n, 11.5) + np.arange(n) * 1e-7 + k * 1e-8, np.full(n, 104.9), np.ones(n, int), grams, np.ones(n, bool)) for k in (0, 1)]
    closest.Tally.measured = 0
    assert len(closest.decide(*sides, 100.0, 0.9)) == n
    assert closest.Tally.measured < n * 45


def test_capacities_on_both_sides_equal_greedy(spark):
    rnd = random.Random(9)
    spots = [(11.5 + rnd.uniform(0, 0.002), 104.9 + rnd.uniform(0, 0.002)) for _ in range(12)]
    make = lambda n, seed: [(i, *random.Random(seed + i).choice(spots[seed % 2 :: 2]), "x") for i in range(n)]
    ours, truth = make(70, 100), make(50, 201)
    m = match.match_points(spark.createDataFrame(ours, SCHEMA), spark.createDataFrame(truth, SCHEMA), 150.0)
    assert {(r.ours_id, r.truth_id) for r in m.collect()} == brute(spark, ours, truth, 150.0, None)


def test_inspection_lists_every_point_once(spark):
    ours, truth = spark.createDataFrame(sample(1, 30, True), SCHEMA), spark.createDataFrame(sample(2, 40, True), SCHEMA)
    m = match.match_points(ours, truth, 60.0)
    rows = match.inspect_matches(ours, truth, m, 8).collect()
    assert sorted(r.ours_id for r in rows if r.ours_id is not None) == list(range(30))
    assert sorted(r.truth_id for r in rows if r.truth_id is not None) == list(range(40))
    assert sum(r.kind == "matched" for r in rows) == m.count()


def test_no_match(spark):
    a = spark.createDataFrame([(1, 11.0, 104.0, "x")], SCHEMA)
    b = spark.createDataFrame([(1, 12.0, 104.0, "x")], SCHEMA)
    m = match.match_points(a, b)
    assert m.count() == 0
    c = match.compare_by_cell(a, b, m, spark.createDataFrame([], "h3 long, population double"), 8)
    r = match.agreement(c).first()
    assert (r["ours"], r["ground_truth"], r["recall"], r["precision"]) == (1, 1, 0.0, 0.0)
    assert [x.gt_minus_ours for x in match.biggest_differences(c, 1).collect()] in ([1], [-1])


def test_similarity(spark):
    pairs = [("Wat Phnom", "wat-phnom!"), ("abc", "xyz"), (None, "x"), ("វត្តភ្នំ", "វត្តភ្នំ"), ("", "")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r[0] for r in df.select(text.name_similarity(F.col("a"), F.col("b"))).collect()]
    assert got[0] > 0.4 and got[1] == 0.0 and got[3] == 1.0 and got[4] == 0.0
    n = df.select(text.normalise_name(F.lit("  The  Café, No.1! ")).alias("n")).first()["n"]
    assert n == "the café no1"


def test_components_equal_union_find(spark):
    rnd = random.Random(7)
    edges = [(f"n{rnd.randrange(60):02d}", f"n{rnd.randrange(60):02d}") for _ in range(40)]
    edges += [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(40)] + [("hub", f"h{i}") for i in range(30)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    rows = dedupe.connected_components(spark.createDataFrame(edges, "a string, b string")).collect()
    got = {r.node: r.component for r in rows}
    assert len(rows) == len(got)
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}


def test_dedupe_groups_and_survivors(spark):
    rows = [
        ("osm", "1", "Wat Phnom", None, 11.5, 104.9),
        ("osm", "2", "Wat Phnom", None, 11.5, 104.9),
        ("overture", "a", "Wat Phnom!", 0.9, 11.50001, 104.90001),
        ("overture", "b", "Cafe", 0.7, 11.5, 104.9),
        ("osm", "3", "Cafe", None, 11.6, 104.9),
        ("osm", "4", None, None, 11.5, 104.9),
        ("overture", "c", "Same", 0.2, 11.7, 104.9),
        ("overture", "d", "Same", 0.3, 11.7, 104.9),
    ]
    p = spark.createDataFrame(rows, "source string, source_id string, name string, confidence double, lat double, lng double")
    p = p.withColumn("h3_res11", hx.cell(F.col("lat"), F.col("lng"), 11))
    g = defaultdict(set)
    for r in dedupe.duplicate_groups(p).collect():
        g[r.dup_group_id].add((r.source, r.source_id))
    assert sorted(map(len, g.values())) == [1, 1, 1, 1, 1, 3]
    kept = {(r.source, r.source_id) for r in dedupe.dedupe_pois(p, ["osm", "overture"]).collect()}
    assert kept == {(r[0], r[1]) for r in rows} - {("osm", "1"), ("osm", "2")}
    assert dedupe.dedupe_pois(p, ["osm"]).count() == len(rows)


@pytest.mark.parametrize("twin,kept", [("Zoo", 3), ("ATM", 2)])
def test_copies_of_one_source_stay_together(spark, twin, kept):
    rows = [("x", "1", "ATM", 0.9), ("x", "2", "ATM", 0.9), ("y", "9", twin, 0.5)]
    p = spark.createDataFrame(rows, "source string, source_id string, name string, confidence double")
    p = p.withColumn("h3_res11", hx.cell(F.lit(11.5), F.lit(104.9), 11))
    got = {(r.source, r.source_id) for r in dedupe.dedupe_pois(p, ["x", "y"]).collect()}
    assert {("x", "1"), ("x", "2")} <= got and len(got) == kept


def test_a_common_stem_gives_few_duplicate_candidates(spark):
    """Names of one stem in one cell: the rarest grams tell them apart before sets are compared."""
    rows = [(k, f"{k}{i}", f"Central Market Phnom Penh {i * 37 % 1000:03d}", 0.5) for k in ("x", "y") for i in range(300)]
    p = spark.createDataFrame(rows, "source string, source_id string, name string, confidence double")
    p = p.withColumn("h3_res11", hx.cell(F.lit(11.5), F.lit(104.9), 11))
    sites = dedupe.duplicate_sites(p).cache()
    for least in (0.9, 0.97):
        links = dedupe.duplicate_pairs(sites, least).collect()
        pairs = sites.alias("a").join(sites.alias("b"), F.col("a.source") < F.col("b.source"))
        want = pairs.where(text.jaccard(F.col("a.grams"), F.col("b.grams")) >= least).select("a.site", "b.site")
        assert sorted(map(tuple, links)) == sorted(map(tuple, want.collect())) and len(links) >= 300
    # of 90,000 pairs, at the stricter similarity only those that share a rare gram are looked at
    asked = dedupe.gram_candidates(dedupe.rare_first(sites), 0.97).count()
    assert asked <= 5 * len(links)


def test_duplicate_candidates_are_not_broadcast(spark):
    # rows repeated by gram and cell, however small the files of the sites are, stay out of the driver's memory
    rows = [(s, f"{s}{i}", f"stem {i}", 7) for s in ("a", "b") for i in range(20)]
    p = spark.createDataFrame(rows, "source string, source_id string, name string, h3_res11 long")
    sites = cut_lineage(dedupe.duplicate_sites(p))
    plan = dedupe.gram_candidates(sites.withColumn("ordered", F.sort_array("grams")), 0.9)._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_wide_tiles_hold_what_lies_around_and_repeat_few_sites(spark):
    """High in the north across the antimeridian, with tiles of the first and a later round."""
    rng = random.Random(11)
    rows = [(i, 72 + rng.random() * 0.3, (179.4 + rng.random() * 1.2 + 180) % 360 - 180, 1, [f"g{i}"]) for i in range(600)]
    sites = spark.createDataFrame(rows, "site long, lat double, lng double, cap long, grams array<string>")
    width = match._width(sites, sites, 100.0)
    assert width == match.WIDTHS[0]
    at = {r[0]: (r[1], r[2]) for r in rows}
    for turn in (0, 1):
        got = match._blocks(sites, sites.limit(0), 100.0, turn, width).collect()
        assert len(got) < 2 * len(rows) and sorted(r.site for r in got if r.home) == sorted(at)
        held, homes = {}, {}
        for r in got:
            held.setdefault(r.tile, set()).add(r.site)
            if r.home:
                homes.setdefault(r.tile, []).append(r.site)
        lat, lng = (np.array([at[i][k] for i in range(600)]) for k in (0, 1))
        for tile, own in homes.items():
            d = closest.distance(lat[own][:, None], lng[own][:, None], lat[None], lng[None])
            assert set(np.flatnonzero((d <= match.REACH * 100.0).any(0)).tolist()) <= held[tile]


def test_names_far_apart_are_not_measured():
    n = 20
    lat, lng = (x.ravel() for x in np.meshgrid(11 + np.arange(n) * 0.01, 104 + np.arange(n) * 0.01))
    grams = [["cus", "ust", "sto", "tom", "ome", "mer", f"x{i}", f"y{i}"] for i in range(n * n)]
    side = lambda k: closest.Side(list(range(n * n)), lat + k, lng, np.ones(n * n, int), grams, np.ones(n * n, bool))
    before = closest.Tally.measured
    got = closest.decide(side(0.0), side(0.0005), 100.0, 0.5)
    assert sorted((i, j) for i, j, *_ in got) == [(i, i) for i in range(n * n)] and closest.Tally.measured - before <= 4 * n * n
