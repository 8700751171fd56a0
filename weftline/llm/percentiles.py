"""Percentiles of very large numeric columns by merging centroid digests.

A digest is a table: one row per cluster with its group keys, ``mean``,
``weight``, ``low`` and ``high``. Sorted values are clustered so that no
cluster spans more than one unit of the scale function

    k(q) = delta / (2 pi) * asin(2 q - 1)

which makes clusters thin near both ends and at most pi/delta of the weight
wide in the middle. Digests of parts, days or files are merged by putting
their clusters together and clustering again, so they combine in any order.
``low`` and ``high`` bound every cluster, so the rank of any point is bounded
rigorously, whatever was merged; what the bounds leave open is settled by a
second counting pass over the data.

Without ids that may repeat, every input partition makes its digests before
anything is shuffled, over Arrow batches; only clusters travel. Where repeated
ids must be found, rows are shuffled once, by group: the groups of more than
``HOT`` rows, counted first, are spread over as many parts by their ids and
their digests merged; all others are whole where they are sorted. So a group
that holds a third of all rows is never sorted in one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from weftline.operators.lineage import cut

DELTA = 200
#: Rows (or clusters) of a group that one task sorts.
HOT = 1_000_000
#: Rows that an input partition clusters at a time.
CHUNK = 500_000


def _salts(df: DataFrame, asked: int | None, per_group: int = 1) -> int:
    """Parts in which points and rows meet: as many as there are shuffle partitions, so a hot group spreads over all of them."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return asked or max(8, n // per_group)


def _k(q: Column, delta: int) -> Column:
    return F.floor(F.asin(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), 2 * q - 1))) * (delta / 6.283185307179586)).cast("int")


def _names(keys: list[str]) -> list[str]:
    return [f"__k{i}" for i in range(len(keys))]


def _rows(df: DataFrame, keys: list[str], value: str, row_id: str | None, salts: Column, keep: list[str] = ()) -> DataFrame:
    """(__k..., __salt, keep..., __v, __w): each row once, numeric and not NaN, hash-partitioned by keys and salt."""
    v = F.col(value).cast("double")
    spread = F.col(row_id) if row_id else v
    rows = df.select(*[F.col(k).alias(n) for k, n in zip(keys, _names(keys))], *keep, v.alias("__v"), F.pmod(F.xxhash64(spread), salts).cast("int").alias("__salt"), *([F.col(row_id).alias("__id")] if row_id else []))
    rows = rows.where(F.col("__v").isNotNull() & ~F.isnan("__v"))
    part = [*_names(keys), "__salt", *keep]
    if row_id:
        # one shuffle serves removal of repeated rows, sorting and clustering
        return rows.repartition(*part).groupBy(*part, "__id").agg(F.min("__v").alias("__v")).select(*part, "__v", F.lit(1).cast("long").alias("__w"))
    # equal values become one weighted value before the shuffle
    return rows.groupBy(*part, "__v").agg(F.count(F.lit(1)).alias("__w"))


def _cluster(df: DataFrame, part: list[str], delta: int) -> DataFrame:
    """df: part columns, __v, __w, __lo, __hi, sorted by __v within part -> one row per cluster."""
    order = Window.partitionBy(*part).orderBy("__v", "__lo", "__hi", "__w")
    whole = Window.partitionBy(*part)
    q = (F.sum("__w").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__w") / 2) / F.sum("__w").over(whole)
    return (
        df.withColumn("__c", _k(q, delta))
        .groupBy(*part, "__c")
        .agg(F.sum(F.col("__v") * F.col("__w")).alias("__s"), F.sum("__w").alias("__w"), F.min("__lo").alias("__lo"), F.max("__hi").alias("__hi"))
        .withColumn("__v", F.col("__s") / F.col("__w"))
        .drop("__s", "__c")
    )


def _out(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*[F.col(n).alias(k) for k, n in zip(keys, _names(keys))], F.col("__v").alias("mean"), F.col("__w").alias("weight"), F.col("__lo").alias("low"), F.col("__hi").alias("high"))


def _partial(rows: DataFrame, keys: list[str], delta: int) -> DataFrame:
    """Clusters of (__k..., __v, __w, __lo, __hi) rows, made in every partition where they lie; equal to ``_cluster`` of each chunk."""
    schema = T.StructType([*[rows.schema[k] for k in keys], T.StructField("__v", T.DoubleType()), T.StructField("__w", T.LongType()), T.StructField("__lo", T.DoubleType()), T.StructField("__hi", T.DoubleType())])
    arrow = to_arrow_schema(schema)

    def cluster(t: pa.Table) -> pa.RecordBatch:
        code = np.zeros(len(t), dtype=np.int64)
        for k in keys:
            d = t.column(k).combine_chunks().dictionary_encode(null_encoding="encode")
            part = np.asarray(d.indices).astype(np.int64)
            _, code = np.unique(code * (len(d.dictionary) + 1) + part, return_inverse=True)
            code = code.reshape(-1)
        v, w, lo, hi = (np.asarray(t.column(c)) for c in ("__v", "__w", "__lo", "__hi"))
        order = np.lexsort((w, hi, lo, v, code))
        code, v, w, lo, hi = code[order], v[order], w[order], lo[order], hi[order]
        start = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
        upto = np.cumsum(w)
        group = np.cumsum(np.append(True, code[1:] != code[:-1])) - 1
        before = np.append(0, upto[start[1:] - 1])[group]
        total = np.add.reduceat(w, start)[group]
        q = (upto - before - w / 2) / total
        k = np.floor(np.arcsin(np.clip(2 * q - 1, -1.0, 1.0)) * (delta / 6.283185307179586)).astype(np.int64)
        at = np.flatnonzero(np.append(True, (code[1:] != code[:-1]) | (k[1:] != k[:-1])))
        weight = np.add.reduceat(w, at)
        first = pa.array(order[at])
        columns = [t.column(key).combine_chunks().take(first) for key in keys]
        return pa.RecordBatch.from_arrays([*columns, pa.array(np.add.reduceat(v * w, at) / weight), pa.array(weight), pa.array(np.minimum.reduceat(lo, at)), pa.array(np.maximum.reduceat(hi, at))], names=arrow.names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for b in batches:
            held.append(b)
            n += len(b)
            if n >= CHUNK:
                yield cluster(pa.Table.from_batches(held))
                held, n = [], 0
        if n:
            yield cluster(pa.Table.from_batches(held))

    return rows.select(*keys, "__v", "__w", "__lo", "__hi").mapInArrow(run, schema)


def _merge(clusters: DataFrame, keys: list[str], delta: int) -> DataFrame:
    """One digest per group; groups of more than HOT clusters are merged in parts first."""
    clusters = cut(clusters)
    many = clusters.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > HOT)
    if many.take(1):
        hot = many.select(*[F.col(k).alias(f"{k}h") for k in keys], "__n")
        on = [F.col(k).eqNullSafe(F.col(f"{k}h")) for k in keys]
        part = F.pmod(F.xxhash64("__v", "__w", "__lo", "__hi"), F.ceil(F.col("__n") / HOT)).cast("int")
        clusters = _cluster(clusters.join(hot, on, "left").withColumn("__salt", F.coalesce(part, F.lit(0))), [*keys, "__salt"], delta).drop("__salt")
    return _cluster(clusters, keys, delta)


def build_digest(df: DataFrame, keys: list[str], value: str, *, row_id: str | None = None, delta: int = DELTA, salts: int | None = None) -> DataFrame:
    """Digest of ``value`` for each group of ``keys``.

    ``row_id`` names the column by which repeated rows count once (rows with
    one id must agree in keys; of differing values the least counts). Null and
    NaN values are left out, so a group without values has no rows; null keys
    form groups of their own. An empty table gives an empty digest. Other
    columns of ``df`` are ignored, whatever their names. ``salts`` parts of
    every group may be asked for; by default only of groups beyond HOT rows.
    """
    names = _names(keys)
    part = [*names, "__salt"]
    bounds = {"__lo": F.col("__v"), "__hi": F.col("__v")}
    v = F.col(value).cast("double")
    plain = df.where(v.isNotNull() & ~F.isnan(v))
    if not row_id:
        rows = plain.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], v.alias("__v"), F.lit(1).cast("long").alias("__w")).withColumns(bounds)
        return _out(_merge(_partial(rows, names, delta), names, delta), keys)
    if salts:
        return _out(_cluster(_cluster(_rows(df, keys, value, row_id, F.lit(salts)).withColumns(bounds), part, delta).drop("__salt"), names, delta), keys)
    hot = plain.groupBy(*[F.col(k).alias(f"__h{i}") for i, k in enumerate(keys)]).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > HOT)
    if not hot.take(1):
        return _out(_cluster(_rows(df, keys, value, row_id, F.lit(1)).withColumns(bounds), part, delta), keys)
    # a hot group is one of at most rows / HOT
    hot = cut(hot)
    on = [F.col(k).eqNullSafe(F.col(f"__h{i}")) for i, k in enumerate(keys)]
    parts = _rows(df.join(hot, on, "left"), keys, value, row_id, F.coalesce(F.ceil(F.col("__n") / HOT), F.lit(1)), keep=["__n"]).withColumns(bounds)
    once = cut(_cluster(parts, [*part, "__n"], delta))
    return _out(once.where("__n is null").drop("__salt", "__n").unionByName(_cluster(once.where("__n is not null"), names, delta)), keys)


def merge_digests(digest: DataFrame, keys: list[str], *, delta: int = DELTA) -> DataFrame:
    """Digest over coarser (or equal) ``keys`` from the union of other digests."""
    rows = digest.select(*[F.col(k).alias(n) for k, n in zip(keys, _names(keys))], F.col("mean").alias("__v"), F.col("weight").alias("__w"), F.col("low").alias("__lo"), F.col("high").alias("__hi"))
    return _out(_cluster(rows, _names(keys), delta), keys)


def quantiles(digest: DataFrame, keys: list[str], ps: dict[str, float]) -> DataFrame:
    """Estimated quantiles, one column per entry of ``ps``, and the group's ``n``.

    Between the middles of neighbouring clusters the value is interpolated;
    beyond the outermost middles it is the group's least or greatest value.
    """
    w = Window.partitionBy(*keys).orderBy("mean", "low", "high", "weight")
    d = digest.withColumn("__at", F.sum("weight").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("weight") / 2)
    d = d.withColumns({"__n": F.sum("weight").over(Window.partitionBy(*keys)), "__at1": F.lead("__at").over(w), "__m1": F.lead("mean").over(w), "__at0": F.lag("__at").over(w)})
    aggs = [F.max("__n").alias("n")]
    for name, p in ps.items():
        t = F.lit(p) * F.col("__n")
        inside = F.col("mean") + (F.col("__m1") - F.col("mean")) * (t - F.col("__at")) / (F.col("__at1") - F.col("__at"))
        value = F.when(F.col("__at0").isNull() & (t < F.col("__at")), F.col("low")).when(F.col("__at1").isNull() & (t >= F.col("__at")), F.when(t > F.col("__at"), F.col("high")).otherwise(F.col("mean"))).when((t >= F.col("__at")) & (t < F.col("__at1")), inside)
        aggs.append(F.max(value).alias(name))
    return d.groupBy(*keys).agg(*aggs)


def rank_bounds(digest: DataFrame, keys: list[str], points: DataFrame, point: str = "point") -> DataFrame:
    """Bounds of each point's rank in its group, from the digest alone.

    ``points`` holds the keys and ``point``. Result: distinct points with
    ``n``, ``below_min <= count(value < point) <= below_max`` and
    ``upto_min <= count(value <= point) <= upto_max``. Points of groups that
    have no digest are left out; null keys meet null keys.
    """
    p = points.select(*[F.col(k).alias(n) for k, n in zip(keys, _names(keys))], F.col(point).cast("double").alias("__p")).where(F.col("__p").isNotNull()).distinct()
    d = digest.select(*[F.col(k).alias(f"__d{i}") for i, k in enumerate(keys)], "weight", "low", "high")
    on = [F.col(n).eqNullSafe(F.col(f"__d{i}")) for i, n in enumerate(_names(keys))]
    x, w = F.col("__p"), F.col("weight")
    s = lambda c: F.sum(F.when(c, w).otherwise(0))
    out = p.join(d, on, "inner").groupBy(*_names(keys), "__p").agg(F.sum("weight").alias("n"), s(F.col("high") < x).alias("below_min"), s(F.col("low") < x).alias("below_max"), s(F.col("high") <= x).alias("upto_min"), s(F.col("low") <= x).alias("upto_max"))
    return out.select(*[F.col(n).alias(k) for k, n in zip(keys, _names(keys))], F.col("__p").alias(point), "n", "below_min", "below_max", "upto_min", "upto_max")


def count_ranks(df: DataFrame, keys: list[str], value: str, points: DataFrame, point: str = "point", *, row_id: str | None = None, salts: int | None = None) -> DataFrame:
    """Second pass: exact ``n``, ``below`` and ``upto`` of each point in its group.

    Points are repeated for every salt, so rows meet them where they lie and a
    hot group is counted by ``salts`` tasks; sums are combined before the
    second shuffle. Points of groups without values are left out.
    """
    # points are repeated for every salt, so there are fewer salts than in digests
    salts = _salts(df, salts, 16)
    p = points.select(*[F.col(k).alias(f"__d{i}") for i, k in enumerate(keys)], F.col(point).cast("double").alias("__p")).where(F.col("__p").isNotNull()).distinct()
    groups = p.select(*[f"__d{i}" for i in range(len(keys))]).distinct()
    # rows of groups nobody asks about are dropped before the shuffle
    df = df.join(groups, [F.col(k).eqNullSafe(F.col(f"__d{i}")) for i, k in enumerate(keys)], "left_semi")
    p = p.withColumn("__s", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    rows = _rows(df.select(*keys, value, *([row_id] if row_id else [])), keys, value, row_id, F.lit(salts))
    on = [F.col(n).eqNullSafe(F.col(f"__d{i}")) for i, n in enumerate(_names(keys))] + [F.col("__salt") == F.col("__s")]
    x, v, w = F.col("__p"), F.col("__v"), F.col("__w")
    out = rows.join(p, on, "inner").groupBy(*_names(keys), "__p").agg(F.sum("__w").alias("n"), F.sum(F.when(v < x, w).otherwise(0)).alias("below"), F.sum(F.when(v <= x, w).otherwise(0)).alias("upto"))
    return out.select(*[F.col(n).alias(k) for k, n in zip(keys, _names(keys))], F.col("__p").alias(point), "n", "below", "upto")


def certified_quantiles(df: DataFrame, keys: list[str], value: str, ps: dict[str, float], *, row_id: str | None = None, delta: int = DELTA, salts: int | None = None) -> DataFrame:
    """Quantile estimates and, as ``<name>_error``, their true rank error from a counting pass.

    The error is how far p lies outside [share below, share at or below].
    """
    est = cut(quantiles(build_digest(df, keys, value, row_id=row_id, delta=delta, salts=salts), keys, ps))
    long = est.select(*keys, F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(p)).alias("p"), F.col(n).alias("point")) for n, p in ps.items()])).alias("q")).select(*keys, "q.*")
    ranks = count_ranks(df, keys, value, long, row_id=row_id, salts=salts).select(*[F.col(k).alias(f"__d{i}") for i, k in enumerate(keys)], F.col("point").alias("__p"), "n", "below", "upto")
    on = [F.col(k).eqNullSafe(F.col(f"__d{i}")) for i, k in enumerate(keys)] + [F.col("point") == F.col("__p")]
    err = F.greatest(F.lit(0.0), F.col("below") / F.col("n") - F.col("p"), F.col("p") - F.col("upto") / F.col("n"))
    return long.join(ranks, on).groupBy(*keys).agg(F.max("n").alias("n"), *[F.max(F.when(F.col("name") == n, F.col("point"))).alias(n) for n in ps], *[F.max(F.when(F.col("name") == n, err)).alias(f"{n}_error") for n in ps])


def stored_figures_off(values: DataFrame, stored: DataFrame, keys: list[str], value: str, figures: dict[str, float], *, tolerance: float = 0.10, row_id: str | None = None, delta: int = DELTA, salts: int | None = None) -> DataFrame:
    """Keys of ``stored`` rows one of whose ``figures`` (column -> p) is off by more than ``tolerance`` of rank.

    Digest bounds decide most figures; those within the bounds' width of the
    tolerance are counted exactly. Null figures and groups without values
    aren't off. Repeated rows of ``stored`` give one row.
    """
    asked = stored.select(*keys, F.explode(F.array(*[F.struct(F.col(c).cast("double").alias("point"), F.lit(float(p)).alias("p")) for c, p in figures.items()])).alias("f")).select(*keys, "f.*").where(F.col("point").isNotNull()).distinct()
    # groups nobody asks about are dropped before anything is shuffled
    groups = asked.select(*[F.col(k).alias(f"__g{i}") for i, k in enumerate(keys)]).distinct()
    values = values.join(groups, [F.col(k).eqNullSafe(F.col(f"__g{i}")) for i, k in enumerate(keys)], "left_semi")
    digest = build_digest(values, keys, value, row_id=row_id, delta=delta, salts=salts)
    bounds = rank_bounds(digest, keys, asked)
    dn = [F.col(k).alias(f"__b{i}") for i, k in enumerate(keys)]
    on = [F.col(k).eqNullSafe(F.col(f"__b{i}")) for i, k in enumerate(keys)] + [F.col("point") == F.col("__p")]
    # a hair of slack keeps shares that equal the limit on its near side in floating point
    hi, lo, n = F.col("p") + (tolerance + 1e-9), F.col("p") - (tolerance + 1e-9), F.col("n")
    surely = (F.col("below_min") > hi * n) | (F.col("upto_max") < lo * n)
    maybe = (F.col("below_max") > hi * n) | (F.col("upto_min") < lo * n)
    judged = cut(
        asked.join(bounds.select(*dn, F.col("point").alias("__p"), "n", "below_min", "below_max", "upto_min", "upto_max"), on)
        .select(*keys, "point", "p", surely.alias("surely"), maybe.alias("maybe"))
        .where("maybe")
    )
    unsure = judged.where(~F.col("surely"))
    exact = count_ranks(values, keys, value, unsure, row_id=row_id, salts=salts)
    counted = unsure.join(exact.select(*dn, F.col("point").alias("__p"), "n", "below", "upto"), on).where((F.col("below") > hi * n) | (F.col("upto") < lo * n))
    return judged.where("surely").select(*keys).unionByName(counted.select(*keys)).distinct()
