import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from weftline.functions import hangul
from weftline.llm import freevalues, leaks, lookalikes, quality


def test_rewriter_forms():
    fix = lookalikes.plain_rewriter()
    same = ["NURI 14", "ＮＵＲＩ　１４", "NU​R‍I 1⁠4", "ΝURΙ 14", "NURІ 14"]
    assert {fix(s) for s in same} == {"NURI 14"}
    assert fix("Café") == fix("Café") == fix("Саfе‍́") == "Café"
    assert fix(unicodedata.normalize("NFD", "미라쥬 노트")) == "미라쥬 노트"
    assert fix("𝐍𝖴𝑅𝙸 𝟏𝟜") == "NURI 14" and fix("①") == "①"
    assert fix("ﾡ") == fix("ㄱ") == fix("ᄀ")
    # case, punctuation and the number of spaces show, and so do different letters
    assert len({fix(s) for s in ("NURI 14", "nuri 14", "NURI  14", "NURI14", "NURI 14.", "NUR1 14")}) == 6
    assert fix("") == "" and fix("​﻿") == ""


def test_rewriter_is_idempotent_over_random_text():
    fix, rng = lookalikes.plain_rewriter(), random.Random(2)
    pool = "aбΑ ẹ́́‍한한ㅎＡ１ｱ½㈜…" + chr(0x1E69) + chr(0x212B)
    for _ in range(500):
        s = "".join(rng.choice(pool) for _ in range(12))
        assert fix(fix(s)) == fix(s) == fix(unicodedata.normalize("NFD", s)) == fix(unicodedata.normalize("NFC", s))


def test_representative_is_the_most_frequent():
    assert lookalikes.Rewriter(lookalikes.representatives({"Ａ": 10, "A": 3}))("xA") == "xＡ"


def test_pairs(spark):
    rows = [("f", "1", "Ａb"), ("f", "2", "Ab"), ("f", "2", "Ab"), ("f", "3", "Ab"), ("g", "4", "Ab"), ("f", "5", None), ("f", "6", ""), ("f", "7", "​"), (None, "8", "Ab"), ("f", "9", "x" * 100_000)]
    df = spark.createDataFrame(rows, "field string, key string, text string").withColumn("canonical", F.lit(1))
    assert {tuple(r) for r in lookalikes.same_look_pairs(df, "field", "key", "text").collect()} == {("f", "1", "2"), ("f", "1", "3"), ("f", "6", "7")}
    assert lookalikes.same_look_pairs(df.limit(0), "field", "key", "text").count() == 0


def test_equal_texts_never_meet(spark):
    """3,000 keys of one spelling and one of another: 3,000 pairs, and no more rows between."""
    df = spark.range(3001).select(F.lit("f").alias("field"), F.format_string("%05d", "id").alias("key"), F.when(F.col("id") == 7, "ＡＢ").otherwise("AB").alias("text"))
    pairs = lookalikes.same_look_pairs(df, "field", "key", "text")
    assert pairs.count() == 3000
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "raw_a" in plan and pairs.where("key_a = '00007' or key_b = '00007'").count() == 3000


def test_leaks_equal_brute_force(spark):
    rng = random.Random(3)
    words = ["가나다", "abc", "delta", "12", "공장을", "넘기고", "Ｘ", "é"]
    items = [(i, " ".join(rng.choice(words) for _ in range(60))) for i in range(12)] + [(99, "short"), (98, None)]
    docs = []
    for i in range(120):
        base = " ".join(rng.choice(words) for _ in range(rng.randint(0, 80)))
        k, a = rng.randrange(12), rng.randrange(60)
        cut = items[k][1][a : a + rng.choice([20, 55, 60, 70, 75, 120, 400])]
        docs.append((i, base + rng.choice(["", "!! ", "​"]) + cut.upper() + base))
    docs += [(500, None), (501, ""), (502, items[3][1]), (502, items[3][1]), (None, items[4][1])]
    d, b = spark.createDataFrame(docs, "id long, text string"), spark.createDataFrame(items, "id long, text string")
    want = set()
    for i, t in docs:
        for k, s in items:
            if t and s:
                x, y = leaks.letters(t), leaks.letters(s)
                if any(y[a : a + 60] in x for a in range(len(y) - 59)):
                    want.add((i, k))
    got = leaks.leaked_items(d, "id", "text", b, "id", "text")
    assert got.columns == ["id", "item_id"]
    assert {tuple(r) for r in got.collect()} == want and len(want) > 20
    # the same in many passes
    assert {tuple(r) for r in leaks.leaked_items(d, "id", "text", b, "id", "text", pass_chars=300).collect()} == want
    assert leaks.leaked_items(d.limit(0), "id", "text", b, "id", "text").count() == leaks.leaked_items(d, "id", "text", b.limit(0), "id", "text").count() == 0


def brute_leaks(doc, items, run):
    x = leaks.letters(doc)
    return {k for k, y in items if any(y[a : a + run] in x for a in range(len(y) - run + 1))}


@pytest.mark.parametrize(("run", "block"), [(1, 1), (2, 3), (7, 2), (8, 3), (13, 10), (20, 4)])
def test_shift_table_loses_no_run(run, block):
    rng = random.Random(run)
    make = lambda n: "".join(rng.choice("ab") if rng.random() < 0.7 else rng.choice("cdefg") for _ in range(n))
    stock = make(run - 1 if run > 2 else 2)
    # stock phrases in front, behind and in the middle of many items
    items = [(i, make(rng.randint(0, 40))) for i in range(20)]
    items += [(100 + i, s) for i, s in enumerate([stock + make(30) for _ in range(12)] + [make(30) + stock for _ in range(12)] + [make(15) + stock + make(15) for _ in range(12)])]
    searcher = leaks.Searcher(items, run, block)
    for piece in searcher.sides:
        for end in range(searcher.block, searcher.m + 1):
            assert searcher.shift[piece[end - searcher.block : end]] <= searcher.m - end
    hits = 0
    for _ in range(300):
        k, a = rng.randrange(len(items)), rng.randrange(30)
        doc = make(rng.randint(0, 30)) + rng.choice(["", stock, items[k][1][a : a + rng.randint(1, 2 * run)]]) + make(rng.randint(0, 30))
        want = brute_leaks(doc, items, run)
        hits += len(want)
        assert set(searcher.search(doc)) == want
    assert hits > 100


def test_long_items_come_in_slices(spark):
    rng = random.Random(9)
    long = "".join(chr(rng.randint(0xAC00, 0xD7A3)) for _ in range(5000))
    items = spark.createDataFrame([(1, long), (2, long[100:900])], "item_id long, text string")
    docs = [(i, "x" + long[a : a + 60] + "y") for i, a in enumerate(range(0, 4941, 7))] + [(9999, long[:59])]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = {tuple(r) for r in leaks.leaked_items(d, "doc_id", "text", items, "item_id", "text", pass_chars=1000).collect()}
    assert got == {(i, 1) for i, _ in docs[:-1]} | {(i, 2) for i, a in enumerate(range(0, 4941, 7)) if 100 <= a <= 840}


NAMES = {"누리폰 14": ["누리폰14", "NURI 14"], "누리폰 14 프로": ["누리폰14프로", "NURI 14 PRO"], "하람 S24": ["하람S24", "HARAM S24", "하람24"], "미라쥬 노트 8": ["MIRÁGE NOTE 8"]}


@pytest.mark.parametrize(
    ("value", "name"),
    [("누리폰14", "누리폰 14"), ("누니폰 14", "누리폰 14"), ("snflvhs 14 vmfh", "누리폰 14 프로"), ("NUIR 14 PRO", "누리폰 14 프로"), ("하람람 S24", "하람 S24"), ("8 미라쥬 노트", "미라쥬 노트 8"), ("mirage-note-8!!", "미라쥬 노트 8"), ("ＨＡＲＡＭ Ѕ24", "하람 S24"), ("하람 S25", None), ("하람 A24", None), ("누리폰", None), ("", None), ("누리폰 14 미니", None)],
)
def test_dictionary(value, name):
    found = freevalues.Dictionary(NAMES).candidates(value)
    assert min(found, key=found.get, default=None) == name


def test_distance_is_symmetric_and_counts_transpositions():
    assert freevalues.distance("abcd", "abdc", 2) == freevalues.distance("abdc", "abcd", 2) == 0.7
    assert freevalues.distance("산지문봄", "지산문봄", 0.75) == 0.7
    assert freevalues.distance("가나", "가나나", 1) == 0.5
    assert freevalues.distance("가나다", "라마바", 1) == float("inf")


def test_matching_values(spark):
    ref = spark.createDataFrame([("m", n, a) for n, a in NAMES.items()] + [("m", None, None)], "field string, name string, spellings array<string>")
    values = ["누리폰 14", "누리폰14 블랙", "NURI 14 PRO 블랙", "하람24 블랙", "누니폰14블랙", "맥북", None, "", "누리폰 14 " + "x" * 50_000]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)] * 2, "id long, m string").withColumn("cost", F.lit(0))
    got = {r["id"]: r["name"] for r in freevalues.map_column_values(rows, "id", ["m"], ref).collect()}
    U = freevalues.UNMATCHED
    assert got == {1: "누리폰 14", 2: "누리폰 14 프로", 3: "하람 S24", 4: "누리폰 14", 5: U, 6: U, 7: U, 8: U}
    # the same in blocks of any size
    for block in (1, 2, 3):
        again = freevalues.map_column_values(rows, "id", ["m"], ref, block=block)
        assert {r["id"]: r["name"] for r in again.collect()} == got
    assert freevalues.map_column_values(rows.limit(0), "id", ["m"], ref).count() == 0


def test_keyboard_round_trip():
    rng = random.Random(4)
    for _ in range(300):
        s = "".join(chr(rng.randint(0xAC00, 0xD7A3)) for _ in range(6))
        assert hangul.from_keys(hangul.to_keys(s)) == s
    assert hangul.to_keys("삼성") == "tkatjd"


PROSE = "어제 매장에 들러 계약서를 읽어 본 뒤에 마음을 정했다. 가격이 내려가지 않는다면 나는 다음 달에 해지할 생각이다."
ENGLISH = "We waited until Sunday because the subsidy was expected to rise, and then the shop closed for the holiday."
KINDS = {
    "prose": [PROSE, ENGLISH, "혹시 개통하신 분 계시면 후기 좀 남겨 주세요\n저도 약정이 걸려 있어서 못 바꾸고 있어요 ㅎㅎ", "> " + PROSE, "※ 문의는 영업시간에 접수처로 연락 부탁드립니다."],
    "other": ["model,cap,carrier\n누리 14,128GB,NRT\n누리 15,256GB,GON\n하람 S24,1TB,GON", "| a | b | c |\n| --- | --- | --- |\n| 1 | 2 | 3 |", "색상: 블랙\n용량: 256GB\n재고: 없음", "0adaa6b05e33019ad55d4bfb661006251c00066e", "■■■■☆☆☆☆====\n□□□□", "ujaz xjlwkqjohtpdxs xsy gfwb gsjv qrwe;ahygqpbg", "10:27:12 INFO crawl fetch id=3541340 rc=2", "#디자인 #교육 #상사 #테크"],
}


def test_lines_and_shares(spark):
    docs = [(i, t, k) for i, (k, t) in enumerate((k, t) for k, ts in KINDS.items() for t in ts * 5)]
    docs += [(900, None, None), (901, "", None), (902, " \n \n", None), (903, (PROSE + " ") * 3000, "prose"), (904, PROSE + "\n" + "\n".join(f"누리 {i},128GB,NRT,{i}000" for i in range(40)), "other")]
    df = spark.createDataFrame(docs, "id long, text string, prose string")
    common = spark.createDataFrame([("ko", w) for w in "나는 뒤에 다음 것을 그리고".split()] + [("en", w) for w in "we the was to and for then until".split()] + [("en", None)], "lang string, word string")
    out = {r["id"]: r for r in quality.line_shares(df, "id", "text", common).collect()}
    for i, _, kind in docs:
        if kind is None:
            assert out[i]["chars"] == 0 and out[i]["prose"] is None
        else:
            assert (out[i]["prose"] > 0.5) == (kind == "prose"), docs[i if i < 900 else i - 904 - 1][:2]
            assert out[i]["prose"] + out[i]["list"] + out[i]["table"] + out[i]["junk"] == pytest.approx(1)
    assert quality.line_shares(df.limit(0), "id", "text", common).count() == 0
    stats = {r["id"]: r for r in quality.statistics(df, "id", "text", common).collect()}
    assert stats[900]["words"] == stats[901]["words"] == 0 and stats[901]["symbol_ratio"] is None
    assert stats[903]["words"] == 3000 * len(PROSE.split())


def brute_posteriors(model, levels):
    """Posterior of every line by summing over all sequences of states."""
    import itertools

    like = model.weigh(levels)
    total = [[0.0] * quality.K for _ in levels]
    for states in itertools.product(range(quality.K), repeat=len(levels)):
        p = model.start[states[0]] * like[0][states[0]]
        for i in range(1, len(levels)):
            p *= model.move[states[i - 1]][states[i]] * like[i][states[i]]
        for i, k in enumerate(states):
            total[i][k] += p
    return [[x / sum(row) for x in row] for row in total]


def test_forward_backward_equals_enumeration():
    import numpy as np

    rng = np.random.default_rng(3)
    model = quality.Model(rng.integers(0, 50, quality.K), rng.integers(0, 50, (quality.K, quality.K)), rng.integers(0, 90, (2, quality.K, quality.FEATURES, 8)))
    count = np.array([3, 0, 5, 1, 4])
    levels = rng.integers(0, 3, (13, quality.FEATURES)).astype(np.uint8)
    moves = np.zeros((quality.K, quality.K), np.int64)
    got = model.posteriors(levels, count, moves)
    at = 0
    for n in count:
        if n:
            assert got[at : at + n] == pytest.approx(np.array(brute_posteriors(model, levels[at : at + n])))
            # a document's result doesn't depend on those beside it
            assert (model.posteriors(levels[at : at + n], np.array([n])) == got[at : at + n]).all()
        at += n
    assert moves.sum() == pytest.approx(9 * quality.UNIT, abs=9 * 16)


def test_labels_come_from_the_model_alone(spark):
    """Seeds are read by the first estimate only: other seeds in the written copy change no label of a given model."""
    import numpy as np

    common = frozenset("나는 뒤에 다음 것을 the was to and".split())
    words = quality.Words(common)
    texts = [t for ts in KINDS.values() for t in ts]
    levels, seeds, _, count = quality.observe(texts, words)
    first = quality.Model(np.ones(4), np.ones((4, 4)), np.ones((2, 4, quality.FEATURES, 8)))
    assert np.allclose(first.posteriors(levels, count), 0.25, atol=0.25) and set(seeds) <= set(range(5))
    # one observation per line, however long
    long = " ".join([PROSE] * 500)
    assert quality.observe([long], words)[3].tolist() == [1] and quality.observe([long], words)[2].tolist() == [len(long)]


def test_shares_do_not_depend_on_partitions(spark):
    docs = [(i, t) for i, t in enumerate(t for ts in KINDS.values() for t in ts * 3)]
    df = spark.createDataFrame(docs, "id long, text string")
    common = spark.createDataFrame([("나는",), ("the",), ("was",)], "word string")
    one, many = (sorted(tuple(r) for r in quality.line_shares(df.repartition(n), "id", "text", common).collect()) for n in (1, 7))
    assert one == many


def test_long_reference_lists(spark):
    """A list just over the size of a block gives what it gives in one."""
    rng = random.Random(14)
    name = lambda: "".join(chr(rng.randint(0xAC00, 0xD7A3)) for _ in range(5))
    names = sorted({name() for _ in range(401)})
    ref = spark.createDataFrame([("m", n, [f"{n}폰"]) for n in names], "field string, name string, spellings array<string>")
    typed = names[:150] + [n + "블랙" for n in names[100:250]] + [n + "폰블랙" for n in names[:60]] + [n[:2] + n[3] + n[2] + n[4] for n in names[200:300]] + [n + rng.choice("가나다") for n in names[300:]] + [name() for _ in range(50)]
    rows = spark.createDataFrame(list(enumerate(typed)), "id long, m string")
    got = [sorted(map(tuple, freevalues.map_column_values(rows, "id", ["m"], ref, block=n).collect())) for n in (400, 401, 150)]
    assert got[0] == got[1] == got[2] and sum(r[2] != freevalues.UNMATCHED for r in got[0]) > 300
