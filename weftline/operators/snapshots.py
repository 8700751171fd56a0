"""What changed between full snapshots of a table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def snapshot_changes(df: DataFrame, series: list[str], at: str, key: list[str], compare: list[str], *, null_is_unknown: bool = True) -> DataFrame:
    """Rows added, removed or changed between each snapshot and the one before it in its series.

    ``series`` names the columns that tell series of snapshots apart, ``at``
    the snapshot's time, ``key`` the record's key. Result: series, ``at`` (of
    the later snapshot), key, ``change``.

    Every record meets its counterpart in a full outer join on (series,
    snapshot number, key), comparing hashes of the canonical columns, so the
    work spreads over snapshots and keys alike and no series or key is
    gathered in one task. With ``null_is_unknown`` a column counts as changed
    only if it is known on both sides; otherwise null is a value like others.
    Repeated records of a snapshot are one record; where they differ, the
    greatest known value of each column counts. Rows without series, time or
    key belong to no record and are left out. A series' first snapshot has no
    changes; an empty table has none either. Other columns are ignored.
    """
    ks, ss = [f"__k{i}" for i in range(len(key))], [f"__s{i}" for i in range(len(series))]
    rows = df.select(*[F.col(c).alias(n) for c, n in zip([*series, *key], [*ss, *ks])], F.col(at).alias("__at"), *[F.col(c).alias(f"__c{i}") for i, c in enumerate(compare)])
    rows = rows.where(" and ".join(f"{c} is not null" for c in [*ss, *ks, "__at"]))
    # one row per snapshot: far smaller than the table, combined before its shuffle
    w = Window.partitionBy(*ss).orderBy("__at")
    times = rows.select(*ss, "__at").distinct().withColumns({"__n": F.row_number().over(w), "__next": F.lead("__at").over(w)})
    hashes: Iterable[str] = [f"__h{i}" for i in range(len(compare))]
    rows = rows.groupBy(*ss, "__at", *ks).agg(*[F.max(f"__c{i}").alias(f"__c{i}") for i in range(len(compare))])
    tag = F.lit(None).cast("long") if null_is_unknown else F.lit(0).cast("long")
    rows = rows.select(*ss, "__at", *ks, *[F.when(F.col(f"__c{i}").isNotNull(), F.xxhash64(f"__c{i}")).otherwise(tag).alias(h) for i, h in enumerate(hashes)])
    rows = rows.join(times, [*ss, "__at"])
    new = rows.select(*ss, "__n", *ks, F.col("__at").alias("__new_at"), *hashes)
    old = rows.where(F.col("__next").isNotNull()).select(*ss, (F.col("__n") + 1).alias("__n"), *ks, F.col("__next").alias("__old_at"), *[F.col(h).alias(f"{h}o") for h in hashes])
    both = new.join(old, [*ss, "__n", *ks], "full")
    differs = F.lit(False)
    for h in hashes:
        differs = differs | F.coalesce(F.col(h) != F.col(f"{h}o"), F.lit(False))
    change = F.when(F.col("__old_at").isNull(), F.when(F.col("__n") > 1, F.lit("added"))).when(F.col("__new_at").isNull(), F.lit("removed")).when(differs, F.lit("changed"))
    out = both.select(*[F.col(s).alias(c) for s, c in zip(ss, series)], F.coalesce("__new_at", "__old_at").alias(at), *[F.col(k).alias(c) for k, c in zip(ks, key)], change.alias("change"))
    return out.where(F.col("change").isNotNull())
