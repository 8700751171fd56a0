import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.llm import entities, packing, variants


READER = variants.Reader({"건설": "건설", "construction": "건설", "미디어": "미디어", "식품": "식품", "상사": "상사"})


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("주식회사 라송봄려건설", ("라송봄려", "건설", "h")), ("(주)라송봄려 건설", ("라송봄려", "건설", "h")), ("건설 라송봄려", ("라송봄려", "건설", "h")), ("（주）라송봄려Construction", ("라송봄려", "건설", "h")),
        ("Rasongbomryeo Construction Inc.", ("rasongbomryeo", "건설", "l")), ("Construction, Rasongbomryeo", ("rasongbomryeo", "건설", "l")), ("fkthdqhafurjstjf", ("라송봄려", "건설", "h")),
        ("우리 라송봄려", ("라송봄려", "", "h")), ("라송봄려네", ("라송봄려", "", "h")), ("라송​봄려.건설", ("라송봄려", "건설", "h")), ("", ("", "", "l")), ("(주)", ("", "", "l")),
    ],
)
def test_reading_names(text, want):
    assert READER(text) == want


def edits(a, b):
    """Unrestricted reference: edits with adjacent transpositions."""
    d = {(i, -1): i + 1 for i in range(-1, len(a))} | {(-1, j): j + 1 for j in range(-1, len(b))}
    for i in range(len(a)):
        for j in range(len(b)):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i] != b[j]))
            if i and j and a[i] == b[j - 1] and a[i - 1] == b[j]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a) - 1, len(b) - 1]


def test_pigeonhole_finds_every_pair_within_k():
    rng = random.Random(6)
    for _ in range(600):
        a = "".join(rng.choice("abcd") for _ in range(rng.randint(1, 9)))
        b = list(a)
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "b"])
        b = "".join(b)
        for k in (1, 2):
            n = edits(a, b)
            assert variants.banded(a, b, k) == min(n, k + 1)
            insertions_only = n if n <= k else None
            if b and insertions_only is not None and abs(len(a) - len(b)) <= k and levenshtein(a, b) <= k:
                index = {(len(b), i, s) for i, (_, s) in enumerate(variants.segments(b, k)) if s}
                assert index & {(n, number, s) for n, number, _, s in variants.probes(a, k)} or len(b) <= k


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_crowded_segments_lose_nothing(spark):
    rng = random.Random(11)
    # all cores share their first half
    cores = sorted({"가나" + "".join(rng.choice("다라마바사아자차") for _ in range(2)) for _ in range(60)} | {"ganadara", "ganadaro", "gnaadara"})
    df = spark.createDataFrame([(i, c, "건설", "l" if c.isascii() else "h") for i, c in enumerate(cores)], "id long, core string, trade string, script string")
    both = [{tuple(r) for r in variants.segment_join(df, df, crowded=n).collect()} for n in (3, 10**6)]
    assert both[0] == both[1] and len(both[0]) > 50


def test_segment_join_finds_all_pairs(spark):
    rng = random.Random(12)
    cores = {"가", "각", "갸", "나", "낙", "가가", "뷁", "ab", "abc", "abcde", "abdce"}
    for alphabet, sizes, more in (("가각나낙다라", (1, 2, 3, 4), 60), ("abn", (5, 6, 7, 8), 60)):
        for _ in range(more):
            x = [rng.choice(alphabet) for _ in range(rng.choice(sizes))]
            cores.add("".join(x))
            at = rng.randrange(len(x))
            cores.add("".join(x[:at] + [rng.choice(alphabet)] + x[at + rng.randint(0, 1) :]))
            at = max(1, at)
            cores.add("".join(x[: at - 1] + x[at : at + 1] + x[at - 1 : at] + x[at + 1 :]))
    # Latin spellings of Hangul cores, some misspelt
    for c in [c for c in sorted(cores) if not c.isascii() and len(c) > 2][:40]:
        latin = variants.hangul.to_latin(c)
        cores |= {latin, latin[:2] + latin[3:], latin[: len(latin) // 2] + "x" + latin[len(latin) // 2 :]}
    rows = [(i, c, t, "l" if c.isascii() else "h") for i, (c, t) in enumerate((c, rng.choice(["", "건설", "식품", None])) for c in sorted(cores))]
    df = spark.createDataFrame(rows, "id long, core string, trade string, script string")
    want = {}
    for i, a, t, s in rows:
        for j, b, u, z in rows:
            if i != j and (not t or t == u):
                x, y = (a, b) if s == z else (variants.hangul.to_latin(a), variants.hangul.to_latin(b))
                w = variants.cost("h" if s == z == "h" else "l", x, y)
                if w is not None:
                    want[i, j] = w
    kinds = {(rows[i][3], rows[j][3], bool(rows[i][2])) for i, j in want}
    assert len(kinds) == 8
    for crowded in (3, 10**6):
        assert {(l, r): w for l, r, w in variants.segment_join(df, df, crowded=crowded).collect()} == want


def test_variants_follow_established_names(spark):
    known = spark.createDataFrame([(1, "주식회사 라송봄려건설"), (2, "라송봄려미디어"), (3, "가래균곤건설"), (4, "가래군곤건설"), (5, None)], "cid long, name string")
    rows = [(1, "라송봄려건설(주)", None), (2, "라숑봄려건설", None), (3, "Rasongbomryeo Construction", None), (4, "RASNOGBOMRYEO CONSTRUCTION", None), (5, "라송봄려미디어", None), (6, "라송봄려", None), (7, "라송봄려", None), (8, "가래균곤건설", None), (9, "가래군곤건설", None), (10, "아무개", 2), (11, None, None), (12, "", None), (13, "전혀다른이름식품", None), (13, "전혀다른이름식품", None), (14, "x" * 20_000, None)]
    df = spark.createDataFrame(rows, "id long, alias string, cid long").withColumn("core", F.lit("clash"))
    got = {r["id"]: (r["core"], r["trade"]) for r in variants.link_variants(df, "id", ["alias"], known, "name", "cid", "cid", READER).collect()}
    assert {got[i] for i in (1, 2, 3, 4)} == {("라송봄려", "건설")}
    assert got[5] == got[10] == ("라송봄려", "미디어")
    # two lines of business share the core: a name without one stands for neither
    assert got[6] == got[7] == ("라송봄려", "")
    assert got[8] != got[9]
    assert 11 not in got and 12 not in got and got[13] == ("전혀다른이름", "식품")
    pairs = {tuple(r) for r in variants.variant_pairs(variants.link_variants(df, "id", ["alias"], known, "name", "cid", "cid", READER), "id").collect()}
    assert pairs == {(1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4), (5, 10), (6, 7)}
    assert variants.link_variants(df.limit(0), "id", ["alias"], known, "name", "cid", "cid", READER).count() == 0


def test_names_follow_across_scripts(spark):
    known = spark.createDataFrame([(1, "라송봄려건설")], "cid long, name string")
    rows = [(1, "라송봄려"), *[(i, "Rasongbomryeo Construction") for i in (2, 3)], (4, "가래군곤식품"), *[(i, "Garaegungon Foods") for i in (5, 6)]]
    df = spark.createDataFrame(rows, "id long, alias string")
    reader = variants.Reader({"건설": "건설", "construction": "건설", "식품": "식품", "foods": "식품"})
    pairs = {tuple(r) for r in variants.variant_pairs(variants.link_variants(df, "id", ["alias"], known, "name", reader=reader), "id").collect()}
    assert pairs == {(1, 2), (1, 3), (2, 3), (4, 5), (4, 6), (5, 6)}


def test_alternating_directions_minimise():
    rng = np.random.default_rng(7)
    for _ in range(20):
        h, n = entities.Hinges(), 4
        terms = []
        for _ in range(8):
            i, j, b, w = rng.integers(n), rng.integers(n), rng.normal(), rng.random() * 3 + 0.1
            if i != j:
                h.add([np.array([i]), np.array([j])], [1.0, -1.0], np.array([b]), np.array([w]))
                terms.append((i, j, b, w))
        h.at_most_one(np.array([0, 1]), np.array([0, 0]))
        x = h.solve(np.zeros(n, dtype=int), rounds=3000, tolerance=1e-8)[0]
        assert x[0] + x[1] <= 1 + 1e-3 and x.min() >= 0 and x.max() <= 1
        value = lambda v: sum(w * max(0, v[i] - v[j] + b) ** 2 for i, j, b, w in terms)  # noqa: B023, E731
        for _ in range(300):
            y = np.clip(x + rng.normal(scale=0.2, size=n), 0, 1)
            if y[0] + y[1] <= 1:
                assert value(x) <= value(y) + 1e-3


def test_places_do_not_depend_on_each_other():
    rng = np.random.default_rng(8)

    def problem(k):
        g = np.random.default_rng(k)
        groups, ents = int(g.integers(1, 6)), int(g.integers(1, 4))
        rows = [(i, e) for i in range(groups) for e in range(ents)]
        share = g.random(groups)
        return [(i, e, share[i] / share.sum(), *g.choice([0, 0.5, 0.7, 0.8, 1.0], 4), 1.0, 1.0) for i, e in rows]

    def solve(ks):
        place, group, entity, rest, at = [], [], [], [], 0
        for p, k in enumerate(ks):
            rows = problem(k)
            place += [p] * len(rows)
            group += [at + r[0] for r in rows]
            entity += [10 * k + r[1] for r in rows]
            rest += [r[2:] for r in rows]
            at += max(r[0] for r in rows) + 1
        share, name, addr, number, industry, kn, ki = np.array(rest).T
        return np.array(place), entities.solve_places(np.array(place), np.array(group), np.array(entity), share, {"name": name, "addr": addr, "number": number, "industry": industry, "number_known": kn, "industry_known": ki})

    alone = {k: solve([k])[1] for k in range(40)}
    order = rng.permutation(40)
    place, (truth, rest) = solve(list(order))
    for p, k in enumerate(order):
        assert (truth[place == p] == alone[k][0]).all() and rest[place == p].all() and alone[k][1].all()


def test_entities(spark):
    companies = [(1, "라송봄려건설", "111100", "110", "3111010400", "A"), (2, "라송봄려건설", "111100", "120", "3112010500", "A"), (3, "라송봄려미디어", "222200", "110", "3111010400", "B"), (4, "무관상사", None, "130", "3113010600", None)]
    c = spark.createDataFrame(companies, "company_id long, name string, number string, sigungu string, dong string, industry string")
    r = [
        (10, "라송봄려건설(주)", "111100", "31", "110", "3111010400", "104", "A", "5-1"),
        (11, "라숑봄려건설", None, "31", "110", "3111010300", "103", None, "5-1"),  # the village is wrong: its place tells
        (12, "라송봄려건설", "111100", "31", None, None, "105", "A", "7"),  # the district is missing
        (13, "라송봄려", "222200", "31", "110", "3111010400", "104", "B", "9"),  # no trade: number and industry tell
        (14, "라송봄려건설", "111100", "39", "190", "3919011100", "111", "A", "44"),  # a branch that isn't listed
        (15, "다른회사식품", "111100", "31", "110", "3111010400", "104", "C", "5"),
        (16, None, "111100", "31", "110", "3111010400", "104", "A", "5-1"),
        (17, "무관상사", None, "31", "130", "3113010600", None, None, None),
    ]
    df = spark.createDataFrame(r + r[:2], "raw_id long, name string, number string, sido string, sigungu string, dong string, emdong string, industry string, lot string").withColumn("core", F.lit(0))
    got = {x["raw_id"]: (x["company_id"], x["confidence"]) for x in entities.match_entities(df, c, reader=READER).collect()}
    assert {k: v[0] for k, v in got.items()} == {10: 1, 11: 1, 12: 2, 13: 3, 17: 4}
    assert all(0.5 <= v[1] <= 1 for v in got.values()) and got[10][1] > got[13][1]
    assert entities.match_entities(df.limit(0), c, reader=READER).count() == entities.match_entities(df, c.limit(0), reader=READER).count() == 0


def test_packing(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice([0, 3, 40, 55, 60, 99, 100, 101, 250])) for i in range(700)] + [(5000, None), (None, 10), (5001, 1000)]
    df = spark.createDataFrame(rows + rows[:50], "id long, size long").withColumn("part", F.lit("clash"))
    out = packing.pack(df, "id", F.col("size"), 100, shard_items=150).collect()
    fill, parts = {}, {}
    for r in out:
        fill[r["container"]] = fill.get(r["container"], 0) + r["size"]
        parts.setdefault(r["id"], []).append((r["part"], r["start"], r["size"]))
    assert max(fill.values()) <= 100
    for i, s in rows:
        got = sorted(parts[i])
        assert sum(x[2] for x in got) == (s or 0) and (len(got) > 1) == ((s or 0) > 100)
        assert [x[1] for x in got] == [100 * k for k in range(len(got))]
    least = -(-sum(s or 0 for _, s in rows) // 100)
    assert len(fill) <= least * 1.2
    assert packing.pack(df.limit(0), "id", F.col("size"), 100).count() == 0


def test_crossover_keeps_items():
    rng = random.Random(9)
    sizes = [rng.randint(1, 60) for _ in range(120)]
    a, b = (packing.evolve(sizes, 100, seed, generations=0) for seed in (1, 2))
    for child in (packing.crossover(a, b, sizes, 100, rng), packing.mutate(a, sizes, 100, rng)):
        assert sorted(i for items in child.bins for i in items) == list(range(120)) and max(child.fills) <= 100
    assert packing.evolve(sizes, 100, 3).fitness >= a.fitness


def triplets(bins, rng):
    """Sizes whose best packing is known: three fill each of ``bins`` containers of 1000."""
    out = []
    for _ in range(bins):
        a = rng.randint(380, 490)
        b = rng.randint(251, (1000 - a) // 2)
        out += [a, b, 1000 - a - b]
    rng.shuffle(out)
    return out


def decreasing(sizes, capacity):
    bins = []
    packing.best_fit(sizes, sorted(range(len(sizes)), key=lambda i: -sizes[i]), bins, [], capacity)
    return len(bins)


@pytest.mark.parametrize("bins", [20, 40, 80])
def test_evolution_beats_best_fit_on_triplets(bins):
    rng = random.Random(bins)
    for seed in range(3):
        sizes = triplets(bins, rng)
        plain = decreasing(sizes, 1000)
        best = packing.evolve(sizes, 1000, seed, generations=40)
        assert sorted(i for b in best.bins for i in b) == list(range(3 * bins)) and max(best.fills) <= 1000
        assert bins <= len(best.bins) < plain
        assert len(best.bins) - bins <= (plain - bins) / 2


def test_trading_fills_bins():
    rng = random.Random(12)
    for _ in range(200):
        sizes = [rng.randint(1, 60) for _ in range(30)]
        bins, left = [], []
        packing.best_fit(sizes, list(range(20)), bins, [], 100)
        fills = [sum(sizes[i] for i in b) for b in bins]
        before = list(fills)
        left = packing.trade(bins, fills, list(range(20, 30)), sizes, 100)
        assert sorted([i for b in bins for i in b] + left) == list(range(30))
        assert fills == [sum(sizes[i] for i in b) for b in bins] and max(fills) <= 100
        assert all(x >= y for x, y in zip(fills, before)) and sum(fills) >= sum(before)


def test_shards_share_their_last_containers(spark):
    rng = random.Random(13)
    sizes = [rng.randint(5, 40) for _ in range(900)]
    df = spark.createDataFrame(list(enumerate(sizes)), "id long, size long")
    out = packing.pack(df, "id", F.col("size"), 100, shard_items=60).collect()
    assert sorted(r["id"] for r in out) == list(range(900))
    fill = {}
    for r in out:
        fill[r["container"]] = fill.get(r["container"], 0) + r["size"]
    # fifteen shards would leave room in fifteen containers
    assert max(fill.values()) <= 100 and len(fill) <= -(-sum(sizes) // 100) + 3


def test_lines_of_business_are_learned(spark):
    """Lines that are in no list, with their English words, a synonym and a misspelling."""
    rng = random.Random(21)
    syllable = lambda: chr(rng.randrange(0xAC00, 0xD7A4, 28))
    lines = {"조경": "landscaping", "제과점": "bakery", "한의원": "clinic", "광고기획": "advertising"}
    firms = [("".join(syllable() for _ in range(rng.randint(3, 4))), t) for t in lines for _ in range(25)]
    known = spark.createDataFrame([(f"주식회사 {c}{t}",) for c, t in firms] + [(None,), ("",)], "name string")
    typed = []
    for i, (c, t) in enumerate(firms):
        latin = variants.hangul.to_latin(c)
        typed += [f"{c} {t}", f"{latin.title()} {lines[t].title()} Co., Ltd" if i % 3 else f"{lines[t].upper()}, {latin}", f"{c}{lines[t].title()}", c]
        if t == "제과점" and i % 4 == 0:
            typed.append(f"{c}베이커리")
    names = spark.createDataFrame([(x,) for x in typed] + [(None,), ("",), ("x" * 9000,)], "name string")
    trades = variants.learn_trades(known, names).trades
    assert {t: trades.get(t) for t in lines} == {t: t for t in lines}
    assert {w: trades.get(w) for w in lines.values()} == {w: t for t, w in lines.items()}
    assert trades["베이커리"] == "제과점" and all(v in lines for v in trades.values())
    assert not any(len(t) < 2 for t in trades)
    linked = variants.link_variants(names.where("name <> ''").distinct().withColumn("id", F.monotonically_increasing_id()), "id", ["name"], known, "name")
    assert linked.where("trade <> ''").select("core", "trade").distinct().count() == len(set(firms))
    assert variants.learn_trades(known.limit(0), names).trades == variants.learn_trades(known.limit(0), names.limit(0)).trades == {}


def test_units_are_drawn_out_only_while_forced():
    counts = {}
    for head in (x + y for x in "가나다라마바사아자차" for y in "카타파하"):
        for line in ("모터스", "씨앤에스", "전자"):
            name = head + line
            for n in range(1, 7):
                counts[name[-n:]] = counts.get(name[-n:], 0) + 1
    assert variants.units(counts, 10) == {"모터스", "씨앤에스", "전자"}
