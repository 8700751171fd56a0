import random

import pytest
from pyspark.sql import functions as F

from weftline.functions import hashing, names, text, values
from weftline.operators.lineage import cut
from weftline.operators import checks, pairs, relational as rel, state, trees
from weftline.operators.snapshots import snapshot_changes


def rows(df, *cols):
    return {tuple(r[c] for c in cols) if cols else tuple(r) for r in df.collect()}


def test_snapshot_changes(spark):
    data = [("X", 1, "a", "n"), ("X", 1, "b", "n"), ("X", 1, "b", "n"), ("X", 3, "a", "m"), ("X", 3, "c", None), ("X", 7, "c", "q"), ("X", 7, "d", None), ("Y", 3, "a", "n"), ("Y", 4, "a", None), ("Y", 5, "a", "z"), (None, 3, "a", "n"), ("X", None, "a", "n"), ("X", 3, None, "n")]
    df = spark.createDataFrame(data, "s string, t int, k string, v string").withColumn("change", F.lit("clash"))
    got = rows(snapshot_changes(df, ["s"], "t", ["k"], ["v"]), "s", "t", "k", "change")
    assert got == {("X", 3, "a", "changed"), ("X", 3, "b", "removed"), ("X", 3, "c", "added"), ("X", 7, "a", "removed"), ("X", 7, "d", "added")}
    strict = rows(snapshot_changes(df, ["s"], "t", ["k"], ["v"], null_is_unknown=False), "s", "t", "k", "change")
    assert strict - got == {("X", 7, "c", "changed"), ("Y", 4, "a", "changed"), ("Y", 5, "a", "changed")}
    assert snapshot_changes(df.limit(0), ["s"], "t", ["k"], ["v"]).count() == 0


def test_snapshot_changes_against_brute_force(spark):
    rng = random.Random(1)
    data = {(rng.choice("XY"), rng.randrange(6), rng.randrange(30)): rng.choice("ab") for _ in range(400)}
    df = spark.createDataFrame([(*k, v) for k, v in data.items()], "s string, t int, k int, v string")
    want = set()
    for s in "XY":
        times = sorted({t for a, t, _ in data if a == s})
        for old, new in zip(times, times[1:]):
            for k in range(30):
                a, b = data.get((s, old, k)), data.get((s, new, k))
                if a != b:
                    want.add((s, new, k, "added" if a is None else "removed" if b is None else "changed"))
    assert rows(snapshot_changes(df, ["s"], "t", ["k"], ["v"]), "s", "t", "k", "change") == want


def test_gates_and_zero_rows(spark):
    df = spark.createDataFrame([(0, 0), (0, None), (1, 0)], "a int, b int")
    assert rel.drop_all_zero(df, ["a", "b"]).count() == 2 and rel.drop_all_zero(df, ["a", "b"], null_is_zero=True).count() == 1
    assert rel.all_or_nothing(df, F.col("a") >= 0).count() == 3 and rel.all_or_nothing(df, F.col("a") < 0).count() == 0
    with pytest.raises(ValueError):
        rel.all_or_nothing(df, F.col("a") > 0)


def test_upsert_is_idempotent_and_refuses_repeated_keys(spark):
    t = spark.createDataFrame([(1, "a", 1), (2, "b", None), (3, "c", 3)], "k int, v string, n int")
    s = spark.createDataFrame([(2, None, 5), (3, "c", 3), (4, "d", 4)], "k int, v string, n int")
    once = state.upsert(t, s, ["k"])
    assert rows(once, "k", "v", "n", "_action") == {(1, "a", 1, "kept"), (2, None, 5, "updated"), (3, "c", 3, "unchanged"), (4, "d", 4, "inserted")}
    again = state.upsert(once.drop("_action"), s, ["k"])
    assert rows(again, "k", "v", "n") == rows(once, "k", "v", "n") and rows(again, "_action") == {("kept",), ("unchanged",)}
    assert rows(state.upsert(t, s, ["k"], merge="sparse"), "k", "v", "n") >= {(2, "b", 5)}
    assert rows(state.upsert(t, s, ["k"], merge="fill", insert=False), "k", "v", "n") == {(1, "a", 1), (2, "b", 5), (3, "c", 3)}
    with pytest.raises(ValueError):
        state.upsert(t, s.unionByName(s), ["k"])


def test_guarded_queue_conflict(spark):
    q = spark.createDataFrame([(1, "error", "P1"), (2, "done", "P1"), (3, "queued", "P0")], "k int, status string, priority string")
    new = spark.createDataFrame([(k, "queued", "P0") for k in (1, 2, 3, 4)], "k int, status string, priority string")
    out = state.upsert(q, new, ["k"], when=F.col("t.status") != "done", update={"status": F.when(F.col("t.status") == "error", "queued").otherwise(F.col("t.status")), "priority": F.least("t.priority", "s.priority")})
    assert rows(out, "k", "status", "priority") == {(1, "queued", "P0"), (2, "done", "P1"), (3, "queued", "P0"), (4, "queued", "P0")}


def test_scd(spark):
    known = spark.createDataFrame([(1, "A", 10, 20), (2, "B", 10, None), (3, "C", 10, None)], "k int, name string, listed int, delisted int")
    today = spark.createDataFrame([(1, "A"), (2, "B2"), (4, "D")], "k int, name string")
    assert rows(state.scd_apply(known, today, ["k"], "name", F.lit(30))) == {(1, "A", 10, None, "relisted"), (2, "B2", 10, None, "renamed"), (3, "C", 10, 30, "delisted"), (4, "D", 30, None, "listed")}


def test_children_parents_and_queue(spark):
    t = spark.createDataFrame([(1, "a", 1), (1, "b", 1), (2, "c", 1), (3, "d", 1)], "p int, k string, n int")
    s = spark.createDataFrame([(1, "b", 2), (1, "b", 2), (1, "x", 2)], "p int, k string, n int")
    assert rows(state.replace_children(t, s, "p", ["k"])) == {(1, "b", 2), (1, "x", 2), (2, "c", 1), (3, "d", 1)}
    gone = spark.createDataFrame([(3,)], "p int")
    assert (3, "d", 1) not in rows(state.replace_children(t, s, "p", ["k"], gone))
    kids, parents = state.find_or_create(t.select("k", F.col("n").cast("string").alias("name")), spark.createDataFrame([("old", "0")], "pid string, name string"), "name", "pid")
    assert parents.count() == 2 and rows(kids.select("pid")) == rows(parents.where("name = '1'").select("pid"))
    claimed = state.claim(t, ["k"], F.col("p") < 3, [F.desc("k")], 2, {"n": F.lit(9)})
    assert rows(claimed) == {(1, "a", 1), (1, "b", 9), (2, "c", 9), (3, "d", 1)}


def test_asof_against_loop(spark):
    rng = random.Random(2)
    left = [(rng.choice("ab"), rng.randrange(40)) for _ in range(60)]
    right = [(rng.choice("abc"), rng.randrange(40), rng.randrange(100)) for _ in range(40)]
    l, r = spark.createDataFrame(left, "k string, t int"), spark.createDataFrame(right, "k string, t int, v int")  # noqa: E741
    for strict in (True, False):
        def prior(k, t, strict=strict):
            ok = [(a, v) for x, a, v in right if x == k and (a < t or not strict and a == t)]
            return max(ok)[1] if ok else None

        assert sorted((x["k"], x["t"], x["prior_v"] or -1) for x in rel.asof_prior(l, r, ["k"], "t", ["v"], strict).collect()) == sorted((k, t, prior(k, t) or -1) for k, t in left)


def test_ranks(spark):
    df = spark.createDataFrame([(1, 10), (2, 7), (3, 7), (4, 1)], "k int, v int")
    assert rows(rel.percentile_desc(df, "v"), "k", "percentile") == {(1, 1.0), (2, 0.75), (3, 0.75), (4, 0.25)}
    big = spark.range(1000).select("id", (F.col("id") * 7919 % 1000).alias("v"))
    assert all(r["rank"] == 1000 - r["v"] for r in rel.global_rank(big, [F.desc("v")]).collect())
    assert rel.global_rank(big.limit(0), [F.desc("v")]).count() == 0


def test_ranks_within_groups_against_loop(spark):
    rng = random.Random(8)
    data = [(i, rng.choice(["a", "a", "a", "b", None]), rng.choice([None, 1, 2, 2, 2, 3, 7, 9])) for i in range(300)]
    df = spark.createDataFrame(data, "id int, g string, v int").repartition(3)
    got = {r["id"]: r["before"] for r in rel.before(df, ["g"], [F.desc_nulls_last("v"), F.col("id")]).collect()}
    key = lambda r: (r[2] is None, -(r[2] or 0), r[0])
    assert got == {i: sum(x[1] == g and key(x) < key((i, g, v)) for x in data) for i, g, v in data}
    pct = {r["id"]: r["percentile"] for r in rel.percentile_desc(df, "v", ["g"]).collect()}
    for i, g, v in data:
        group = [x for x in data if x[1] == g]
        assert pct[i] == pytest.approx((len(group) - sum((x[2] or 0) > (v or 0) for x in group)) / len(group))
    near = {r["g"]: (r["a"], r["b"]) for r in rel.percentile_nearest(df, ["g"], "v", {"a": 0.3, "b": 1.0}).collect()}
    for g in ("a", "b", None):
        vs = sorted(x[2] for x in data if x[1] == g and x[2] is not None)
        assert near[g] == (vs[round((len(vs) - 1) * 0.3)], vs[-1])
    assert rel.before(df.limit(0), ["g"], [F.col("id")]).count() == rel.percentile_desc(df.limit(0), "v").count() == 0


def test_components_and_similarity_join(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(100 + i, 101 + i) for i in range(40)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {(x, find(x)) for a, b in edges if a != b for x in (a, b)}
    assert rows(pairs.components(spark.createDataFrame(edges, "a long, b long"))) == want
    sets = [(i, [rng.randrange(12) for _ in range(rng.randint(0, 10))]) for i in range(120)] + [(500, None), (501, [1]), (502, [1])]
    got = rows(pairs.jaccard_links(spark.createDataFrame(sets, "id long, s array<long>"), "id", "s", 0.8), "a", "b")
    assert got == {(i, j) for i, x in sets for j, y in sets if i < j and x and y and len({*x} & {*y}) / len({*x} | {*y}) >= 0.8}


def test_near_duplicates(spark):
    base = " ".join(f"word{i}" for i in range(60))
    docs = [(1, base), (2, base), (3, base + " tail"), (4, "other " * 3), (5, None), (6, ""), (7, "word1 word2"), (8, base.upper() + "!"), (9, "head " + base + " tail")]
    got = {r["id"]: (r["class_id"], r["copies"], r["links"]) for r in pairs.near_duplicates(spark.createDataFrame(docs, "id long, text string"), "id", "text").collect()}
    assert got == {1: (1, 3, 2), 2: (1, 3, 2), 8: (1, 3, 2), 3: (1, 1, 2), 9: (1, 1, 2), 4: (4, 1, 0), 5: (5, 1, 0), 6: (6, 1, 0), 7: (7, 1, 0)}


def test_trees(spark):
    nested = '[{"id":"c1","replies":[{"id":"r1","replies":[{"id":"q1"}]},{"content":"lost","replies":[{"id":"x"}]},{"id":"r2"}]},{"id":"c2"}]'
    df = spark.createDataFrame([("p", nested), ("bad", "{"), ("none", None)], "post string, js string")
    assert rows(trees.flatten_comments(df, "post", "js"), "id", "parent_id", "root_id", "path", "depth") == {("c1", None, "c1", "001", 0), ("r1", "c1", "c1", "001.001", 1), ("q1", "r1", "c1", "001.001.001", 2), ("r2", "c1", "c1", "001.003", 1), ("c2", None, "c2", "002", 0)}
    assert ("c2", "c1") in rows(trees.flatten_comments(df, "post", "js", compat=True), "id", "root_id")
    edges = spark.createDataFrame([(1, None), (2, 1), (3, 1), (4, 3), (5, None), (6, 7), (7, 6)], "n int, p int")
    assert rows(trees.build_paths(edges, "n", "p", "n")) == {(1, 1, "001", 0), (2, 1, "001.001", 1), (3, 1, "001.002", 1), (4, 1, "001.002.001", 2), (5, 5, "002", 0)}


def test_checks(spark):
    df = spark.createDataFrame([(1, -1), (2, None), (3, 5)], "k int, v int")
    good, bad = checks.quarantine(df, {"negative": F.col("v") < 0, "missing": F.col("v").isNull()})
    assert rows(good, "k") == {(3,)} and rows(bad, "k", "reason") == {(1, "negative"), (2, "missing")}
    checks.assert_unique(df, ["k"])
    checks.assert_rows(df)
    with pytest.raises(ValueError):
        checks.assert_rows(df.limit(0))


@pytest.mark.parametrize(
    ("make", "value", "want"),
    [
        (text.tokens, "Hello http://x.y/z 가나 a B2!", ["hello", "가나", "b2"]),
        (lambda c: text.shingles(F.split(c, " ")), "a b c d e f", ["a b c d e", "b c d e f"]),
        (lambda c: text.shingles(F.split(c, " ")), "a b c d", ["a", "b", "c", "d"]),
        (text.key_b, "ＤＢ  Ｕ＋ 요금", "dbu+요금"),
        (text.strip_html, "<p>a&nbsp;&lt;b<br>c</p>", "a <b c"),
        (text.norm_url, "https://A.Example/x%20y/z?q=1#f", "a.example/x y/z"),
        (lambda c: text.abs_url(F.lit("https://a.example/b/c?d"), c), "../e", "https://a.example/b/../e"),
        (lambda c: text.abs_url(F.lit("https://a.example"), c), "//h/i", "https://h/i"),
        (text.image_token, "https://A.example/p/q.png?x", "a.example/q.png"),
        (lambda c: text.embed_token(c, F.lit("v1")), "https://www.youtube.com/watch", "yt:v1"),
        (lambda c: text.embed_token(c, F.lit(None).cast("string")), "https://t.example/u/status/42", "x:42"),
        (lambda c: text.match_terms(c, {"s24": "S", "s24ultra": "U", "fold": "F"}), "folds24ultras24", ["F", "U", "S"]),
        (lambda c: text.split_scenarios(c, "2안"), "1안 a\n2안 b\n2안 c", ["1안 a\n", "2안 b\n2안 c"]),
        (lambda c: F.date_format(text.date_from_filename(c), "yyyyMMdd"), "a_20200619.csv", "20200619"),
        (lambda c: F.date_format(text.date_from_filename(c), "yyyyMMdd"), "2021년 3월.csv", "20210301"),
        (lambda c: F.date_format(text.date_from_filename(c), "yyyyMMdd"), "x_20201350.csv", None),
        (lambda c: F.date_format(text.utc_iso_to_kst_date(c), "yyyyMMdd"), "2024-01-01T15:30:00.000Z", "20240102"),
        (names.security_type, "C우(전환)", "convertible preferred"),
        (names.security_type, "A스팩12호", "SPAC"),
        (names.company_base_name, "CJ4우(전환)", "CJ"),
        (names.company_base_name, "B리츠우", "B리츠우"),
        (names.letters_to_hangul, "HDC", "에이치디씨"),
        (names.hangul_to_keys, "삼성 A과", "tkatjd Arhk"),
        (names.pad_ticker, "1234567", "1234567"),
        (names.normalize_company, "㈜ 가나 (구 다라) ＡＢ", "가나ab"),
        (names.canonicalize_company, "주식회사 가나 Soft  강남점", "가나 Soft"),
        (names.canonicalize_company, "(주)", None),
        (names.company_types, "(주)가나 협동조합", ["주식회사", "협동조합"]),
        (names.company_type, "㈜가나", "주식회사"),
        (lambda c: names.stem_id(c, "clogo"), "clogo-17.png", 17),
        (values.safe_int, "2.5", 2),
        (values.safe_int, "x", None),
        (lambda c: values.salvage_json(c, "a int")["a"], 'text ```json\n{"a": 3,}\n```', 3),
        (lambda c: values.salvage_json(c, "a int")["a"], "nothing", None),
        (lambda c: values.sorted_json(F.split(c, ",")), "b,a", '["a","b"]'),
        (lambda c: values.image_mime(F.unhex(c)), "FFD8FFE000104A46", "image/jpeg"),
        (lambda c: F.bit_count(hashing.hash64(c, 3)) >= 0, "x", True),
        (names.nfkc, "ＡＢ㈜", "AB(주)"),
        (names.unaccent, "Café 한글", "Cafe 한글"),
        (names.keys_to_hangul, "tkatjd", "삼성"),
    ],
)
def test_functions(spark, make, value, want):
    df = spark.createDataFrame([(value,), (None,)], "c string")
    got = [r[0] for r in df.select(make(F.col("c"))).collect()]
    assert got[0] == want


@pytest.mark.parametrize(
    ("typed", "want"),
    [("5분 전", "2024-03-01 02:55:00"), ("2시간 전", "2024-03-01 01:00:00"), ("7", "2024-03-01 02:53:00"), ("09:30", "2024-03-01 00:30:00"), ("12.31 23:00", "2023-12-31 14:00:00"), ("2024.02.28 09:00", "2024-02-28 00:00:00"), ("24/02/28", "2024-02-27 15:00:00"), ("2024-02-28T09:00:00Z", "2024-02-28 09:00:00"), ("어제", None)],
)
def test_board_times(spark, typed, want):
    df = spark.createDataFrame([(typed,)], "c string")
    c = text.kst_to_utc(F.col("c"), F.lit("2024-03-01 03:00:00").cast("timestamp"))
    assert df.select(F.date_format(c, "yyyy-MM-dd HH:mm:ss")).first()[0] == want


def test_sketches(spark):
    df = spark.createDataFrame([(["a", "b", "c"], ["a", "b", "c", "c"], [])], "x array<string>, y array<string>, z array<string>")
    r = df.select(hashing.sketch_jaccard(hashing.minhash(F.col("x")), hashing.minhash(F.col("y"))).alias("j"), hashing.minhash(F.col("z")).alias("none"), hashing.simhash60(F.col("z")).alias("zero"), hashing.hash64(F.lit("x"), 1, "blake2b").alias("b"), F.size(hashing.bands(hashing.minhash(F.col("x")), 32, 4)).alias("n"), hashing.trigram_similarity(F.lit("cat"), F.lit("cats")).alias("t"), hashing.hamming(F.lit(5), F.lit(3)).alias("h")).first()
    assert r["j"] == 1.0 and r["none"] is None and r["zero"] == 0 and r["n"] == 32 and r["h"] == 2
    both = hashing.add_minhash(df.select("x", "z", hashing.minhash(F.col("x"), 16).alias("m")), F.col("x"), "a", 16).select("m", "a").first()
    assert both["m"] == both["a"] and hashing.add_minhash(df, F.col("z"), "a").first()["a"] is None
    assert r["t"] == pytest.approx(3 / 6) and -(2**63) <= r["b"] < 2**63


def test_dictionary_matches_every_title(spark, tmp_path):
    from weftline.plans.composites import c15_dictionary

    titles = ["galaxy s24", "ＧＡＬＡＸＹ　Ｓ２４", "갤럭시 S24", "갤럭시 s24", "gal​axy s 24", "Straße①", "gаlаxy", "—", None]
    spark.createDataFrame([(i, t) for i, t in enumerate(titles)], "post_id long, title string").write.parquet(f"{tmp_path}/ss_normalized_posts.parquet")
    spark.createDataFrame([("S24", ["galaxys24", "갤럭시s24"]), ("Street", ["strasse1"])], "name string, aliases_keyb array<string>").write.parquet(f"{tmp_path}/phone_models.parquet")
    got = {r["title"]: r["names"] for r in c15_dictionary(spark, str(tmp_path)).collect()}
    assert got == dict(zip(titles[:-1], ["S24", "S24", "S24", "S24", "S24", "Street", "", ""]))


def test_sketch_links_recall(spark, tmp_path):
    from weftline.plans.composites import c03_sketch_links

    rng = random.Random(5)
    docs = []
    for base in range(40):
        words = [f"b{base}w{rng.randrange(10**6)}" for _ in range(150)]
        docs.append(words)
        for changes in (1, 2, 3, 3, 4, 8):
            docs.append([f"x{rng.randrange(10**6)}" if i in spots else w for spots in [set(rng.sample(range(150), changes))] for i, w in enumerate(words)])
    data = [*enumerate(" ".join(w) for w in docs), (900, " ".join(docs[0]).upper()), (901, None), (902, "")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    sets = [{" ".join(w[i : i + 5]) for i in range(len(w) - 4)} for w in docs]
    exact = {(i, j): round(len(x & y) / len(x | y), 6) for i, x in enumerate(sets) for j, y in enumerate(sets) if i < j and len(x & y) / len(x | y) >= 0.8}
    got = {(r["a"], r["b"]): r["similarity"] for r in c03_sketch_links(spark, str(tmp_path)).collect()}
    assert got.pop((0, 900)) == 1.0  # a copy
    assert sum(r["links"] for r in pairs.near_duplicates(df.where("doc_id < 900"), "doc_id", "text").collect()) == 2 * len(exact)
    assert got.items() <= exact.items() and len(got) >= 0.98 * len(exact) > 50


def test_strip_html_of_texts_without_tags(spark, tmp_path):
    import hashlib

    from weftline.plans.functions import f15_strip_html

    spark.createDataFrame([(1, "<p>a</p>"), (2, "a&nbsp;&amp;&lt;b"), (3, " a\n\tb "), (4, "ab"), (5, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    assert rows(f15_strip_html(spark, str(tmp_path))) == {(1, md5("a")), (2, md5("a &<b")), (3, md5("a b")), (4, md5("ab"))}


def test_sketches_of_documents(spark, tmp_path):
    import hashlib

    from weftline.plans import functions as plan

    rng = random.Random(6)
    words = [[f"w{rng.randrange(60)}x" for _ in range(rng.choice((3, 40, 5000)))] for _ in range(20)] + [[]]
    data = [(i * 50, " ".join(w)) for i, w in enumerate(words)] + [(7, None)]
    spark.createDataFrame(data, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    number = lambda x, n: int(hashlib.md5(x.encode()).hexdigest()[:n], 16)
    want_sim, sketch = {}, {}
    for i, w in enumerate(words):
        h = [number("0|" + x, 15) for x in w]
        want_sim[i * 50] = sum(1 << b for b in range(60) if 2 * sum(x >> b & 1 for x in h) > len(h))
        g = {" ".join(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {*w}
        small = [number(x, 7) for x in g]
        sketch[i * 50] = [min((x * a + b) % hashing.PRIME for x in small) for a, b in map(hashing.permutation, range(128))] if g else None
    assert dict(rows(plan.f04_simhash_documents(spark, str(tmp_path)))) == want_sim
    assert dict(rows(plan.f05_minhash_documents(spark, str(tmp_path)))) == {k: v and ",".join(map(str, v)) for k, v in sketch.items()}
    got = [tuple(r) for r in plan.f06_sketch_jaccard_documents(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted((q, k, sum(x == y for x, y in zip(a, b)) / 128 if a and b else 0.0) for q, a in sketch.items() if q % 100 == 0 for k, b in sketch.items())


def test_html_blocks_keep_long_addresses(spark):
    address = "data:image/png;base64," + "A" * 1_200_000
    blocks = spark.createDataFrame([(f'a<img src="{address}">b',)], "c string").select(text.html_blocks(F.col("c"))).first()[0]
    assert [tuple(b) for b in blocks] == [("text", "a"), ("image", address), ("text", "b")]


def test_confirm_rule(spark):
    from weftline.plans import clusters

    cases = [((0.80, 0.0, 0.0), (0.80, "text")), ((0.60, 0.82, 0.0), (0.71, "both")), ((0.74, 0.0, 0.9), (0.9, "embed")), ((0.74, 0.0, 0.84), None), ((0.54, 0.82, 0.0), None), ((0.1, 0.6, 0.85), (0.85, "embed"))]
    df = spark.createDataFrame([c[0] for c in cases], "t double, g double, e double")
    got = [r[0] and (round(r[0]["similarity"], 4), r[0]["kind"]) for r in df.select(clusters.confirm(F.col("t"), F.col("g"), F.col("e"))).collect()]
    assert got == [c[1] for c in cases]


def _posts(spark, rng, sets):
    rows = [(i, float(score), t, g, e) for i, (score, t, g, e) in enumerate(sets)]
    df = spark.createDataFrame(rows, "post_id long, score double, text array<string>, gallery array<string>, embed array<string>")
    df = hashing.add_simhash(df, F.col("text"), "simhash")
    for k in ("text", "gallery", "embed"):
        df = hashing.add_minhash(df, F.col(k), k)
    return df


def test_clusters_against_all_pairs(spark):
    from weftline.plans import clusters

    rng = random.Random(41)
    word = lambda: f"w{rng.randrange(4000)}"
    sets = []
    for _ in range(12):
        base = [[word() for _ in range(40)] for _ in range(3)]
        for _ in range(5):
            vary = lambda x: [word() if rng.random() < p else y for p in [rng.choice((0, 0.02, 0.1))] for y in x]
            sets.append((rng.randrange(5), *map(vary, base)))
    sets += [sets[0]] * 4 + [(1, [], [], []), (2, [], [], []), (1, None, None, None)]
    posts = cut(_posts(spark, rng, sets))
    known = spark.createDataFrame([("old2", 1), ("old1", 2), ("old3", 30)], "cluster string, post_id long")
    got = {r["post_id"]: r for r in clusters.build_clusters(posts, known).collect()}
    sk = {r["post_id"]: r for r in posts.collect()}
    same = lambda x, y: sum(a == b for a, b in zip(x, y)) / 128 if x and y else 0.0
    parent, own = {i: i for i in sk}, {}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sk:
        for b in sk:
            if a < b:
                t, g, e = (same(sk[a][k], sk[b][k]) for k in clusters.EVIDENCE)
                c = (t, "text") if t >= 0.75 else ((g + t) / 2, "both") if g >= 0.8 and t >= 0.55 else (max(e, (t + g) / 2), "embed") if e >= 0.85 and (t >= 0.5 or g >= 0.6) else None
                if c:
                    own[a, b] = own[b, a] = c
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    groups = {}
    for i in sk:
        groups.setdefault(find(i), []).append(i)
    groups = {k: v for k, v in groups.items() if len(v) > 1}
    assert set(got) == {i for v in groups.values() for i in v} and len(groups) >= 10
    olds = {1: "old2", 2: "old1", 30: "old3"}
    for k, v in groups.items():
        rep = min(v, key=lambda i: (-sk[i]["score"], i))
        name = min([olds[i] for i in v if i in olds], default=f"c{k}")
        for i in v:
            r = got[i]
            assert (r["cluster"], r["size"], r["is_representative"]) == (name, len(v), i == rep)
            assert (round(r["similarity"], 9), r["kind"]) == ((round(own[rep, i][0], 9), own[rep, i][1]) if (rep, i) in own else (0.0, None))
    assert clusters.build_clusters(posts.limit(0).select(*posts.columns), known).count() == 0


def _written(spark):
    """Bytes of shuffles that all tasks have written so far."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    found = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(found.apply(i).totalShuffleWrite() for i in range(found.size()))


def test_clusters_shuffle_no_pair_in_vain(spark):
    """Few words make nearly all posts meet in buckets; the evidence of what meets was shuffled with every pair once."""
    from weftline.plans import clusters

    rng = random.Random(43)
    take = lambda words, n: [rng.choice(words) for _ in range(n)]
    contents = [take([f"c{i}" for i in range(40)], 8) for _ in range(12)]
    sets = [(rng.randrange(3), take([f"w{i}" for i in range(22)], rng.choice((5, 6, 7))), rng.choice(contents), rng.choice([[], None, *contents[:4]])) for _ in range(400)]
    posts = cut(_posts(spark, rng, sets))
    sk = {r["post_id"]: r for r in posts.collect()}
    before, batch = _written(spark), spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    # a word's rows come in several batches
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {r["post_id"]: r for r in clusters.build_clusters(posts, spark.createDataFrame([], "cluster string, post_id long")).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    assert _written(spark) - before < 5_000_000
    same = lambda x, y: sum(a == b for a, b in zip(x, y)) / 128 if x and y else 0.0
    parent, own, met = {i: i for i in sk}, {}, 0

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for a in sk:
        for b in range(a + 1, len(sk)):
            x, y = sk[a], sk[b]
            if any((x["simhash"] >> 15 * i) % 32768 == (y["simhash"] >> 15 * i) % 32768 for i in range(4)) or any(x["text"][i : i + 4] == y["text"][i : i + 4] for i in range(0, 128, 4)):
                met += 1
                t, g, e = (same(x[k], y[k]) for k in clusters.EVIDENCE)
                c = (t, "text") if t >= 0.75 else ((g + t) / 2, "both") if g >= 0.8 and t >= 0.55 else (max(e, (t + g) / 2), "embed") if e >= 0.85 and (t >= 0.5 or g >= 0.6) else None
                if c:
                    own[a, b] = own[b, a] = c
                    parent[max(find(a), find(b))] = min(find(a), find(b))
    groups = {}
    for i in sk:
        groups.setdefault(find(i), []).append(i)
    groups = {k: v for k, v in groups.items() if len(v) > 1}
    assert met > 10 * len(own) / 2 and {k for _, k in own.values()} == {"text", "both", "embed"}
    assert set(got) == {i for v in groups.values() for i in v}
    for k, v in groups.items():
        rep = min(v, key=lambda i: (-sk[i]["score"], i))
        for i in v:
            r = got[i]
            assert (r["cluster"], r["size"], r["is_representative"]) == (f"c{k}", len(v), i == rep)
            assert (round(r["similarity"], 9), r["kind"]) == ((round(own[rep, i][0], 9), own[rep, i][1]) if (rep, i) in own else (0.0, None))


def test_merging_clusters_moves_members(spark):
    from weftline.plans import clusters

    rng = random.Random(42)
    base = [f"w{rng.randrange(900)}" for _ in range(60)]
    sets = [(i % 4, base[: 60 - i % 2], [], []) for i in range(8)] + [(0, [f"x{rng.randrange(900)}" for _ in range(60)], [], []) for _ in range(4)]
    ev = cut(_posts(spark, rng, sets)).select("post_id", "text", "gallery", "embed")
    m = spark.createDataFrame([("a", i, float(i), False) for i in range(5)] + [("b", i, 9.0, False) for i in (4, 5, 6, 7)] + [("z", i, 1.0, False) for i in range(8, 12)], "cluster string, post_id long, score double, is_representative boolean")
    c = spark.createDataFrame([("a", 0, 20, 5), ("b", 5, 10, 4), ("z", 8, 1, 4)], "cluster string, representative long, created int, size int")
    decisions = clusters.merge_decisions(c, m, ev)
    assert rows(decisions) == {("a", "a"), ("b", "a")}
    after, members = clusters.apply_merges(c, m, decisions)
    assert rows(after) == {("a", 5, 20, 8), ("z", 8, 1, 4)}
    assert rows(members, "cluster", "post_id") == {("a", i) for i in range(8)} | {("z", i) for i in range(8, 12)}
    assert rows(members.where("is_representative"), "cluster", "post_id") == {("a", 5), ("z", 8)}
    # of equal sizes the older cluster is kept
    older = clusters.merge_decisions(c.withColumn("size", F.lit(4)), m, ev)
    assert rows(older) == {("a", "b"), ("b", "b")}


def test_tiers_against_loop(spark):
    from difflib import SequenceMatcher

    rng = random.Random(51)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randint(3, 8)))
    right = [(i % 6, w, w.upper(), w) for i, w in enumerate(sorted({word() for _ in range(40)}))]
    left = [(right[0][0], "normalised only", "zz", right[0][1])]
    for g, n, _, _ in right:
        for k in range(4):
            x = n if k == 0 else n[:-1] + rng.choice("abz") if k == 1 else n + "a" if k == 2 else word()
            left.append((g, f"{len(left)}", x if k else n.upper(), None if k == 3 and rng.random() < 0.3 else x))
    l, r = spark.createDataFrame(left, "g int, k string, x string, y string"), spark.createDataFrame(right, "g int, n string, x string, y string")
    want = {}
    for g, k, x, y in left:
        mine = [t for t in right if t[0] == g]
        for tier, (v, at) in enumerate(((x, 2), (y, 3)), 1):
            hit = [t[1] for t in mine if v is not None and t[at] == v]
            if hit:
                want[k] = (min(hit), tier, 1.0)
                break
        else:
            near = [(-SequenceMatcher(None, y, t[3]).ratio(), t[1]) for t in mine if y is not None]
            near = [n for n in near if n[0] <= -0.85]
            if near:
                want[k] = (min(near)[1], 3, -min(near)[0])
    got = {r["k"]: (r["n"], r["tier"], r["ratio"]) for r in pairs.tiered_matches(l, r, ["g"], "k", "n", ["x", "y"]).collect()}
    assert got == want and {v[1] for v in want.values()} == {1, 2, 3}


def test_blake2b_and_64_bits(spark):
    import hashlib

    words = ["a", "b", "b", "가"]
    df = spark.createDataFrame([(words,), ([],), (None,)], "w array<string>")
    got = [r[0] for r in df.select(hashing.simhash64(F.col("w"))).collect()]
    h = [int(hashlib.md5(f"0|{w}".encode()).hexdigest()[:16], 16) for w in words]
    want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    assert got == [f"{want:016x}", "0" * 16, "0" * 16]
    b = spark.createDataFrame([("x",), (None,)], "c string").select(hashing.hash64(F.col("c"), 3, "blake2b")).collect()
    assert b[0][0] == int.from_bytes(hashlib.blake2b(b"3|x", digest_size=8).digest(), "big", signed=True) and b[1][0] is None
