"""Selections, joins, aggregates and ranks composed of built-in operators.

Every top-k, first, latest or rank takes a total order from the caller, so
results do not depend on partitioning. Ties that the given order leaves open
are the caller's choice of ``tie`` columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.operators.lineage import cut


def drop_all_zero(df: DataFrame, cols: list[str], null_is_zero: bool = False) -> DataFrame:
    """Without rows whose columns are all zero; a null keeps the row unless it counts as zero."""
    zero = [F.coalesce(F.col(c), F.lit(0)) == 0 if null_is_zero else F.coalesce(F.col(c) == 0, F.lit(False)) for c in cols]
    return df.where(~reduce(lambda a, b: a & b, zero))


def all_or_nothing(df: DataFrame, valid: Column) -> DataFrame:
    """``df`` if all rows are valid, no rows if none is; raises if only some are."""
    bad, n = df.select(F.count_if(~F.coalesce(valid, F.lit(False))).alias("bad"), F.count(F.lit(1)).alias("n")).first()
    if 0 < bad < n:
        raise ValueError(f"{bad} of {n} rows are invalid")
    return df if not bad else df.limit(0)


def latest_by(df: DataFrame, keys: list[str], order: list[str], newest: bool = True) -> DataFrame:
    """The row with the greatest (or least) ``order`` per key, as one aggregate: no sort, no window."""
    rest = F.struct(*df.columns)
    pick = F.max_by if newest else F.min_by
    return df.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(pick(rest, F.struct(*order)).alias("__r")).select("__r.*")


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key; null keys are equal to each other."""
    return latest_by(df, keys, order, newest=False)


def first_last(df: DataFrame, keys: list[str], order: list[str], cols: list[str]) -> DataFrame:
    """first_<c> and last_<c> of each column per key, in one aggregate."""
    o = F.struct(*order)
    return df.groupBy(*keys).agg(*[f(c, o).alias(f"{n}_{c}") for c in cols for f, n in ((F.min_by, "first"), (F.max_by, "last"))])


def diff_outer(new: DataFrame, old: DataFrame, keys: list[str], compare: list[str]) -> DataFrame:
    """keys, new and old values of ``compare``, action: added, removed, changed or same."""
    n = new.select(*keys, *[F.col(c).alias(f"new_{c}") for c in compare], F.lit(1).alias("__n"))
    o = old.select(*keys, *[F.col(c).alias(f"old_{c}") for c in compare], F.lit(1).alias("__o"))
    same = reduce(lambda a, b: a & b, [F.col(f"new_{c}").eqNullSafe(F.col(f"old_{c}")) for c in compare], F.lit(True))
    action = F.when(F.col("__o").isNull(), "added").when(F.col("__n").isNull(), "removed").when(same, "same").otherwise("changed")
    return n.join(o, keys, "full").select(*keys, *[f"new_{c}" for c in compare], *[f"old_{c}" for c in compare], action.alias("action"))


def asof_prior(left: DataFrame, right: DataFrame, keys: list[str], on: str, cols: list[str], strict: bool = True) -> DataFrame:
    """left and prior_<c>: values of the latest right row before (or at) ``on`` with the same keys.

    One shuffle by keys over the union of both sides, then a running last
    value; nothing is joined. Of right rows at one time the greatest counts.
    """
    r = right.groupBy(*keys, on).agg(F.max(F.struct(*cols)).alias("__v")).select(*keys, F.col(on).alias("__at"), F.lit(1 if strict else 0).alias("__side"), "__v", F.lit(None).cast(left.select(F.struct("*")).schema[0].dataType).alias("__row"))
    rows = left.select(*keys, F.col(on).alias("__at"), F.lit(0 if strict else 1).alias("__side"), F.lit(None).cast(r.schema["__v"].dataType).alias("__v"), F.struct("*").alias("__row"))
    w = Window.partitionBy(*keys).orderBy("__at", "__side").rowsBetween(Window.unboundedPreceding, 0)
    out = rows.unionByName(r).withColumn("__p", F.last("__v", ignorenulls=True).over(w)).where(F.col("__row").isNotNull())
    return out.select("__row.*", *[F.col(f"__p.{c}").alias(f"prior_{c}") for c in cols])


def enrich_null_fk(fact: DataFrame, dim: DataFrame, keys: list[str], fk: str, cols: list[str]) -> DataFrame:
    """``fact`` with ``fk`` and ``cols`` taken from ``dim`` where its ``fk`` is null; linked rows stay."""
    d = dim.select(*keys, F.col(fk).alias("__fk"), *[F.col(c).alias(f"__{c}") for c in cols]).dropDuplicates(keys)
    own = [c for c in fact.columns if c not in (fk, *cols)]
    take = lambda c, new: F.when(F.col(fk).isNull(), F.col(new)).otherwise(F.col(c) if c in fact.columns else F.lit(None)).alias(c)
    return fact.join(d, keys, "left").select(*own, *[take(c, f"__{c}") for c in cols], take(fk, "__fk"))


def range_explode(df: DataFrame, ts: str, ranges: dict[str, int], as_of: Column) -> DataFrame:
    """One row per trailing range (name -> seconds, closed at both ends) that a row belongs to: no range join."""
    age = F.unix_timestamp(as_of) - F.unix_timestamp(ts)
    names = F.filter(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(s).alias("seconds")) for n, s in ranges.items()]), lambda r: (age >= 0) & (age <= r["seconds"]))
    return df.withColumn("range", F.explode(F.transform(names, lambda r: r["name"])))


def top_k_list(df: DataFrame, key: list[str], item: str, k: int, weight: Column | None = None, name: str = "items") -> DataFrame:
    """key and the k items of greatest weight (count by default), ties by item, as an array."""
    n = df.where(F.col(item).isNotNull()).groupBy(*key, item).agg((F.count(F.lit(1)) if weight is None else weight).alias("__n"))
    w = Window.partitionBy(*key).orderBy(F.desc("__n"), item)
    top = n.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= k)
    return top.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("__r", item))), lambda x: x[item]).alias(name))


def ordered_concat(df: DataFrame, key: list[str], text: str, order: list[Column], sep: str = " | ", name: str = "joined") -> DataFrame:
    """Texts of each key joined in order, null and blank ones skipped."""
    rows = df.where(F.trim(F.coalesce(F.col(text), F.lit(""))) != "")
    w = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("__r", F.row_number().over(w)).groupBy(*key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__r", text))), lambda x: x[text]), sep).alias(name))


def mode_by(df: DataFrame, keys: list[str], value: str, ties: list[Column] = ()) -> DataFrame:
    """Most frequent value per key; ties by ``ties`` (after the count), then the least value."""
    n = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*keys).orderBy(F.desc("n"), *ties, value)
    return n.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def group_percentiles(df: DataFrame, keys: list[str], value: str, ps: dict[str, float], as_int: bool = False) -> DataFrame:
    """Exact continuous percentiles per key, with min, max, avg and n; ``as_int`` rounds halves away from zero.

    Exact percentiles hold one count per distinct value of a group in memory;
    for groups of billions of values use the digests of the llm package.
    """
    r = (lambda c: F.round(c).cast("long")) if as_int else (lambda c: c)
    cols = [r(F.percentile(value, F.lit(p))).alias(n) for n, p in ps.items()]
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.min(value).alias("min"), *cols, F.max(value).alias("max"), r(F.avg(value)).alias("avg"), F.count(value).alias("n"))


def rollup_via(df: DataFrame, mapping: DataFrame, key: str, parent: str, by: list[str], measures: list[str]) -> DataFrame:
    """Sums of ``measures`` by ``parent`` of the key (itself where ``mapping`` has none) and ``by``."""
    m = mapping.select(F.col(key).alias("__k"), F.col(parent).alias("__p")).dropDuplicates(["__k"])
    # branches are summed before they are mapped
    pre = df.groupBy(key, *by).agg(*[F.sum(c).alias(c) for c in measures])
    return pre.join(m, F.col(key) == F.col("__k"), "left").groupBy(F.coalesce("__p", key).alias(parent), *by).agg(*[F.sum(c).alias(c) for c in measures])


def status_counts(df: DataFrame, keys: list[str], status: str, statuses: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.count_if(F.col(status) == s).alias(s.lower()) for s in statuses], F.count(F.lit(1)).alias("total"))


def queue_eta(df: DataFrame, queued: Column, done: Column, minutes: float, keys: list[str] = ()) -> DataFrame:
    """queued, done per minute and minutes until the queue is empty at that rate (1e-4 a minute at least)."""
    out = df.groupBy(*keys).agg(F.count_if(queued).alias("queued"), (F.count_if(done) / minutes).alias("per_minute"))
    return out.withColumn("eta", F.col("queued") / F.greatest("per_minute", F.lit(1e-4)))


def global_rank(df: DataFrame, order: list[Column], name: str = "rank", ties: bool = False) -> DataFrame:
    """Row number (or rank, if ``ties`` share one) over the whole table without one task for all rows.

    Rows are range-partitioned by ``order`` and written; each partition ranks
    its own rows, and the sizes of the partitions before it, one number each,
    are added.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = cut(df.repartitionByRange(n, *order).withColumn("__p", F.spark_partition_id()))
    before, offsets = 0, []
    for r in sorted(parts.groupBy("__p").count().collect()):
        offsets += [F.lit(r["__p"]), F.lit(before)]
        before += r["count"]
    w = Window.partitionBy("__p").orderBy(*order)
    local = (F.rank() if ties else F.row_number()).over(w)
    shift = F.try_element_at(F.create_map(*offsets), F.col("__p")) if offsets else F.lit(0)
    return parts.withColumn(name, (local + shift).cast("long")).drop("__p")


def before(df: DataFrame, partition: list[str], order: list[Column], weight: Column | None = None, name: str = "before") -> DataFrame:
    """``df`` and how many rows (or how much ``weight``) of its group come before each in ``order``, which is total.

    A group isn't gathered in one task: rows are range-partitioned by group
    and order, each range counts its own, and what the ranges before it hold
    of the same group, a number for each range and group in it, is joined.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = cut(df.withColumn("__w", F.lit(1) if weight is None else weight).repartitionByRange(n, *[F.col(c) for c in partition], *order).withColumn("__p", F.spark_partition_id()))
    earlier = Window.partitionBy(*partition).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = parts.groupBy("__p", *partition).agg(F.sum("__w").alias("__n")).withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
    sizes = sizes.select(F.col("__p").alias("__q"), *[F.col(c).alias(f"__g{i}") for i, c in enumerate(partition)], "__before")
    own = Window.partitionBy("__p", *partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    counted = parts.withColumn("__own", F.coalesce(F.sum("__w").over(own), F.lit(0)))
    on = [F.col("__p") == F.col("__q"), *[F.col(c).eqNullSafe(F.col(f"__g{i}")) for i, c in enumerate(partition)]]
    return counted.join(sizes, on).select(*[c for c in df.columns], (F.col("__own") + F.col("__before")).cast("long").alias(name))


def rank_metrics(df: DataFrame, key: str, metrics: list[str], partition: list[str] = ()) -> DataFrame:
    """Long table (partition, key, metric, value, rank): greatest first, nulls last, ties by key."""
    long = df.unpivot([*partition, key], metrics, "metric", "value")
    ranked = before(long, [*partition, "metric"], [F.desc_nulls_last("value"), F.col(key)])
    return ranked.select(*long.columns, (F.col("before") + 1).cast("int").alias("rank"))


def percentile_desc(df: DataFrame, value: str, partition: list[str] = (), name: str = "percentile") -> DataFrame:
    """(n - rows with a greater value) / n: the greatest value has 1, ties share the best, nulls are least.

    Distinct values are ranked by their counts and joined back, so a value
    that many rows have is one row where it counts.
    """
    counts = df.groupBy(*partition, value).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.groupBy(*partition).agg(F.sum("__n").alias("__t")) if partition else counts.agg(F.sum("__n").alias("__t"))
    ranked = before(counts, list(partition), [F.desc_nulls_last(value)], F.col("__n"), "__greater")
    cols = [*partition, value]
    ranked = ranked.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(cols)], "__greater")
    out = df.join(ranked, [F.col(c).eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(cols)])
    out = out.join(total.select(*[F.col(c).alias(f"__t{i}") for i, c in enumerate(partition)], "__t"), [F.col(c).eqNullSafe(F.col(f"__t{i}")) for i, c in enumerate(partition)]) if partition else out.crossJoin(F.broadcast(total))
    return out.select(*df.columns, ((F.col("__t") - F.col("__greater")) / F.col("__t")).alias(name))


def next_version(df: DataFrame, history: DataFrame, key: str, digest: str, order: list[str]) -> DataFrame:
    """New (key, digest, version) rows: contents not yet in ``history``, numbered on from its greatest version."""
    new = keep_first(df.join(history.select(key, digest), [key, digest], "left_anti"), [key, digest], order)
    top = history.groupBy(key).agg(F.max("version").alias("__v"))
    w = Window.partitionBy(key).orderBy(*order, digest)
    return new.join(top, key, "left").select(key, digest, (F.row_number().over(w) + F.coalesce("__v", F.lit(0))).cast("int").alias("version"))


def percentile_nearest(df: DataFrame, keys: list[str], value: str, ps: dict[str, float]) -> DataFrame:
    """Nearest-rank percentiles: the value at index round((n - 1) p) of the sorted values, halves to even.

    Distinct values of a group are numbered by what comes before them.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.groupBy(*keys).agg(F.sum("__n").alias("__t")).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__t")
    rows = before(counts, keys, [F.col(value)], F.col("__n"), "__i").join(total, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)])
    at = lambda p: F.bround((F.col("__t") - 1) * p)
    return rows.groupBy(*keys).agg(*[F.max(F.when((F.col("__i") <= at(p)) & (at(p) < F.col("__i") + F.col("__n")), F.col(value))).alias(n) for n, p in ps.items()])


def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
