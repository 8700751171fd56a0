import datetime
import json
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.operators import lineage
from weftline.operators.lineage import cut, forget_all, scope, spread
from weftline.session import checkpoint_dir
from weftline.plans import pipelines as pipe
from weftline.sources import calendar, files, sinks
from weftline.sources.market import MarketSource
from weftline.streaming import streams


def test_crawler_files(spark, tmp_path):
    post = {"post_id": "1", "title": "t", "comments": [{"id": "c", "replies": [{"id": "r"}]}], "tags": ["a"], "view_count": 3}
    (tmp_path / "a.json").write_text(json.dumps([{"meta": {"site": "s"}, "posts": [post, post | {"post_id": "2"}, post]}]))
    (tmp_path / "b.json").write_text(json.dumps({"meta": {"site": "s2"}, "posts": [post]}))
    posts = files.read_posts(spark, str(tmp_path))
    assert {tuple(r) for r in files.post_id_counts(posts).collect()} == {("a.json", 3, 2, 1), ("b.json", 1, 1, 0)}
    assert json.loads(posts.first()["comments"])[0]["replies"][0]["id"] == "r"
    (tmp_path / "c.json").write_text('[{"meta": ')
    with pytest.raises(Exception, match="(?i)malformed|parse|FAILED_READ"):
        files.read_posts(spark, str(tmp_path)).count()


def test_versions_and_checks(spark, tmp_path):
    (tmp_path / "가입_20200619.csv").write_text("a,b\n" + "1,2\n" * 50)
    (tmp_path / "none.csv").write_text("")
    (tmp_path / "wide.txt").write_text("a\tb\n" + "x" * 300)
    (tmp_path / "word.csv").write_text("no delimiter here\n" + "x" * 300)
    v = files.file_versions(spark, str(tmp_path), "*.csv")
    seen = v.where("stem <> 'none'").withColumn("version", F.when(F.col("stem") == "word", "old").otherwise(F.col("version")))
    assert [r["stem"] for r in files.changed_files(v, seen).collect()] == ["none", "word"]
    got = {F_: (ok, why) for F_, ok, why, _ in map(tuple, files.check_files(spark, str(tmp_path), least=100).collect())}
    assert {k if k.isascii() else "x": v for k, v in got.items() if k.isascii()} == {"none.csv": (False, "too small"), "wide.txt": (False, "suffix"), "word.csv": (False, "no delimiter")}
    assert files.dated_files(spark, str(tmp_path)).first()["month"] == "2020-06"


def test_encodings(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("이름,값\n가나,1\n\"다\n라\",\n나쁜 줄\n".encode("cp949"))
    (tmp_path / "b.csv").write_bytes("﻿이름,값\n마바,2\n".encode())
    got = {(r["name"], r["value"]) for r in files.read_csv_probe(spark, str(tmp_path), ["name", "value"]).collect()}
    assert got == {("가나", "1"), ("다\n라", None), ("마바", "2")}


def test_positional_csv(spark, tmp_path):
    (tmp_path / "p.csv").write_text("x,y\n1,2024-01-15\nbad,2024-02-15\n,\n")
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("d", T.DateType())])
    got = {(r["n"], str(r["d"]), r["_bad"]) for r in files.read_positional_csv(spark, str(tmp_path / "p.csv"), schema).collect()}
    assert got == {(1, "2024-01-15", False), (None, "2024-02-15", True), (None, "None", False)}


def test_log_and_defaults(spark):
    df = spark.createDataFrame([("10:27:12 INFO crawl rc=2\nnoise\n10:27:13 WARN again",)], "t string")
    assert {tuple(r) for r in files.parse_run_log(df, "t").collect()} == {("10:27:12", "INFO", "crawl", 2), ("10:27:13", "WARN", "again", None)}
    wide = files.with_defaults(df, {"t": "string", "extra": "int"})
    assert wide.dtypes == [("t", "string"), ("extra", "int")]
    assert files.cast_columns(df, {"t": "int"}).first()["t"] is None


def test_calendar(spark):
    days = [r["date"] for r in calendar.month_end_business_days(spark, 2020, 2020, datetime.date(2021, 6, 1)).orderBy("date").collect()]
    assert len(days) == 12 and days[4] == datetime.date(2020, 5, 29) and days[11] == datetime.date(2020, 12, 30)
    assert len(calendar.month_end_business_days(spark, 2020, 2020, datetime.date(2020, 7, 1)).collect()) == 4


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([("d1", "A", 1), ("d1", "B", 2), ("d2", "A", 3)], "date string, ex string, v int")
    sinks.overwrite_partitions(df, path, ["date", "ex"])
    sinks.overwrite_partitions(df.where("date = 'd1' and ex = 'A'").withColumn("v", F.lit(9)), path, ["date", "ex"])
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [2, 3, 9]
    root = str(tmp_path / "snap")
    assert sinks.current_snapshot(spark, root) is None
    sinks.publish_snapshot(df, root)
    sinks.publish_snapshot(sinks.current_snapshot(spark, root).where("v > 1"), root)
    assert sinks.current_snapshot(spark, root).count() == 2
    sinks.write_copy_text(spark.createDataFrame([("a\tb\nc", None)], "x string, y int"), str(tmp_path / "c"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "c")).collect()] == ["a b c\t\\N"]
    sinks.write_csv_bom(df.limit(1), str(tmp_path / "bom"))
    assert next((tmp_path / "bom").glob("*.csv")).read_bytes().startswith("﻿date".encode())


def test_market_source(spark, tmp_path):
    df = spark.createDataFrame([(datetime.date(2024, 1, 2), "1", "A", "n"), (datetime.date(2024, 1, 3), "2", "B", "m")], "date date, ticker string, exchange string, name string")
    df.write.partitionBy("date", "exchange").parquet(str(tmp_path / "m" / "names"))
    spark.dataSource.register(MarketSource)
    got = spark.read.format("weftline_market").option("path", str(tmp_path / "m")).option("dates", "2024-01-02,2024-01-03").option("exchanges", "A,C").load()
    assert [tuple(r) for r in got.collect()] == [(datetime.date(2024, 1, 2), "1", "A", "n")]


def test_jdbc_reads_in_ranges(spark):
    from weftline.sources.tables import jdbc_query

    url = "jdbc:derby:memory:weftline_test;create=true"
    df = spark.createDataFrame([(i, f"n{i}", None if i == 3 else i % 4) for i in range(50)], "id int, name string, k int")
    df.write.format("jdbc").option("url", url).option("dbtable", "T").option("createTableColumnTypes", "name VARCHAR(20)").mode("overwrite").save()
    got = jdbc_query(spark, url, 'SELECT "id", "name", "k" FROM T WHERE "id" < 40', column="k", lower=0, upper=4, parts=3)
    assert got.rdd.getNumPartitions() == 3 and {tuple(r) for r in got.collect()} == {tuple(r) for r in df.where("id < 40").collect()}
    assert jdbc_query(spark, url, 'SELECT "id" FROM T').count() == 50


def test_cut_survives_void_and_clashes(spark):
    df = cut(spark.range(3).select("id", F.lit(None).alias("nothing")))
    assert df.count() == 3 and df.dtypes[1] == ("nothing", "string")


def test_copies_of_a_scope_are_deleted(spark):
    outer = cut(spark.range(2))
    with scope(spark):
        inner = cut(spark.range(3))
        assert inner.count() == 3
    assert outer.count() == 2
    with pytest.raises(Exception, match="(?i)not.*exist"):
        inner.count()


def test_spread_shuffles_small_tables_only(spark, monkeypatch):
    df = spark.range(10).coalesce(1)
    assert spread(df, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(lineage, "SMALL", 10)
    assert spread(df, "id").rdd.getNumPartitions() == 1


def test_no_local_folder_on_a_cluster(spark):
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    Session.conf = type("Conf", (), {"get": lambda self, k, d=None: d})()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_copies_are_deleted(spark):
    df = cut(spark.range(3))
    assert forget_all(spark) >= 1 and forget_all(spark) == 0
    with pytest.raises(Exception, match="(?i)not.*exist"):
        df.count()


def test_rotation_counter_in_stream_equals_loop(spark, tmp_path):
    rows = [("a", 0), ("a", 600), ("a", 1200), ("a", 1800), ("b", 0), ("b", 1260), ("b", 2520), ("a", 90000)]
    # a watermark begins at 1970, and rows at or before it are late
    start = 1_700_000_000
    spark.createDataFrame(rows, "k string, s long").select("k", F.timestamp_seconds(F.col("s") + start).alias("ts")).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, ts timestamp").parquet(str(tmp_path / "in"))
    out = streams.rotation_stream(stream, "k", "ts")
    q = streams.to_table(out, str(tmp_path / "out"), str(tmp_path / "state"))
    q.awaitTermination()
    got = {(r["key"], r["at"] - start): (r["consecutive"], r["shown"]) for r in streams.current_table(spark, str(tmp_path / "out"), out.schema).collect()}
    # three showings in a row suppress for a day; a gap of 21 minutes starts anew
    assert got == {("a", 0): (1, True), ("a", 600): (2, True), ("a", 1200): (0, True), ("a", 1800): (0, False), ("b", 0): (1, True), ("b", 1260): (1, True), ("b", 2520): (1, True), ("a", 90000): (1, True)}


def test_rotation_state_ends_and_late_rows_change_nothing(spark, tmp_path):
    src, hour = tmp_path / "in", 3600
    # one file a batch, in this order; the third row of a comes after a later one, its fourth is older than the watermark
    batches = [[("a", 1000 * hour), ("a", 1000 * hour + 60)], [("a", 1000 * hour + 30), ("b", 1000 * hour)], [("b", 1200 * hour)], [("a", 900 * hour), ("a", 1200 * hour)]]
    for rows in batches:
        spark.createDataFrame(rows, "k string, s long").select("k", F.timestamp_seconds("s").alias("ts")).coalesce(1).write.mode("append").parquet(str(src))
        time.sleep(1.1)
    stream = spark.readStream.schema("k string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(str(src))
    out = streams.rotation_stream(stream, "k", "ts")
    streams.to_table(out, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = sorted((r["key"], r["at"] / hour - 1000, r["consecutive"], r["shown"]) for r in streams.current_table(spark, str(tmp_path / "out"), out.schema).collect())
    assert [(k, round(at, 4), n, shown) for k, at, n, shown in got] == [("a", 0, 1, True), ("a", 0.0083, 2, False), ("a", 0.0167, 2, True), ("a", 200, 1, True), ("b", 0, 1, True), ("b", 200, 1, True)]


def test_replayed_epochs_change_nothing(spark, tmp_path):
    root = str(tmp_path / "keyed")
    make = lambda rows: spark.createDataFrame(rows, "k int, v string")
    read = lambda: sorted((tuple(r) for r in streams.current_table(spark, root, make([]).schema).collect()), key=lambda r: (r[0] is None, r[0] or 0))
    assert read() == []
    first, second, third = [(i, "a") for i in range(20)] + [(None, "n")], [(3, "b"), (30, "b")], [(3, "c")]
    streams.merge_epoch(make(first), 0, root, ["k"], 4)
    streams.merge_epoch(make(second), 1, root, ["k"], 4)
    want = sorted([(i, "b" if i == 3 else "a") for i in range(20)] + [(30, "b")]) + [(None, "n")]
    assert read() == want
    # the epoch comes again: after it was applied, and after it failed before its manifest
    streams.merge_epoch(make(second), 1, root, ["k"], 4)
    assert read() == want
    kept = streams.read_manifest(spark, root)
    make([(3, "half")]).withColumn("__bucket", F.lit(0)).write.partitionBy("__bucket").parquet(f"{root}/epoch=2")
    assert read() == want and streams.read_manifest(spark, root) == kept
    streams.merge_epoch(make(third), 2, root, ["k"], 4)
    assert (3, "c") in read() and (3, "half") not in read() and (None, "n") in read()
    # untouched buckets were not written again
    assert len(list((tmp_path / "keyed" / "epoch=2").glob("__bucket=*"))) == 1
    streams.merge_epoch(make(third), 3, root, ["k"], 4)
    assert (3, "c") in read()


def test_appended_epochs_are_overwritten_by_their_replay(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.range(5).coalesce(1).write.parquet(src)
    stream = spark.readStream.schema("id long").parquet(src)
    for _ in range(2):
        # the second query has lost its checkpoint and reads all again
        state = str(tmp_path / f"state{_}")
        streams.to_table(stream, str(tmp_path / "out"), state).awaitTermination()
        assert streams.current_table(spark, str(tmp_path / "out"), stream.schema).count() == 5


def test_resolution_decisions(spark):
    raw = spark.createDataFrame([(1, "가나다라건설", "n1", "a1", "i"), (2, "(주)마바사아식품", None, None, None), (3, "가나다라건성", None, "a9", "x"), (4, "전혀", None, None, None)], "raw_id long, name string, number string, addr_key string, industry string")
    dim = spark.createDataFrame([(7, "가나다라건설", "n1", "a1", "i"), (8, "자차카타", "n2", "a2", "j")], "company_id long, name string, number string, addr_key string, industry string")
    alias = spark.createDataFrame([(8, "마바사아식품"), (None, "다른")], "company_id long, name string")
    got = {r["raw_id"]: (r["company_id"], r["rule"], r["decision"]) for r in pipe.resolve_entities(raw, dim, alias).collect()}
    assert got[1] == (7, "NUMBER_ADDR", "ACCEPTED") and got[2] == (8, "ALIAS", "ACCEPTED") and got[4] == (None, None, "NO_CANDIDATE")
    assert got[3][:2] == (7, "NAME_KNN") and got[3][2] == "REJECTED"
