"""Filling containers of fixed capacity: a grouping genetic algorithm on islands.

Items are spread by hash over shards of about ``shard_items``, so each packing
problem is small and none grows with the data. Every shard is evolved by
several islands. An individual is a set of bins; crossover injects whole
well-filled bins of one parent into the other, removes the bins that hold
injected items a second time, and best-fits what this displaced, after trading
displaced items for one or two smaller ones of a bin where that fills it
better. Between epochs each island passes its elite to the next island of its
shard. The emptiest container of every shard is dissolved and these items are
packed again together, until there is one shard, so room left over in shards
adds up to whole containers.

Only ids and sizes are shuffled, never texts. An item larger than the capacity
is cut into full pieces, which fill containers of their own, and a rest, which
is packed like any other item; nothing else is split.
"""

from __future__ import annotations

import random
from bisect import bisect_left, bisect_right, insort

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.operators.lineage import cut, forget

SHARD_ITEMS = 2000
ISLANDS = 2
EPOCHS = 2
GENERATIONS = 12
POPULATION = 6


def best_fit(sizes: list[int], items: list[int], bins: list[list[int]], fills: list[int], capacity: int) -> None:
    """Put ``items``, in their order, each into the fullest bin with room, opening bins as needed."""
    room = sorted((capacity - f, b) for b, f in enumerate(fills))
    for i in items:
        at = bisect_left(room, (sizes[i], -1))
        if at < len(room):
            left, b = room.pop(at)
        else:
            left, b = capacity, len(bins)
            bins.append([])
            fills.append(0)
        bins[b].append(i)
        fills[b] += sizes[i]
        insort(room, (left - sizes[i], b))


class Individual:
    def __init__(self, bins: list[list[int]], sizes: list[int], capacity: int) -> None:
        self.bins = [b for b in bins if b]
        self.fills = [sum(sizes[i] for i in b) for b in self.bins]
        # Falkenauer's cost: full bins beside empty ones are better than evenly used ones
        self.fitness = (-len(self.bins), sum((f / capacity) ** 2 for f in self.fills))

    def assignment(self, n: int) -> list[int]:
        out = [0] * n
        for b, items in enumerate(self.bins):
            for i in items:
                out[i] = b
        return out


def crossover(a: Individual, b: Individual, sizes: list[int], capacity: int, rng: random.Random) -> Individual:
    """Inject well-filled bins of ``b`` into ``a``."""
    order = sorted(range(len(b.bins)), key=lambda k: -b.fills[k])
    picked = rng.sample(order[: max(1, len(order) // 2)], max(1, len(order) // 8))
    injected = [b.bins[k] for k in picked]
    taken = {i for items in injected for i in items}
    kept, displaced = [list(x) for x in injected], []
    for items in a.bins:
        if taken.isdisjoint(items):
            kept.append(list(items))
        else:
            displaced += [i for i in items if i not in taken]
    return _refit(kept, displaced, sizes, capacity)


def mutate(a: Individual, sizes: list[int], capacity: int, rng: random.Random) -> Individual:
    """Empty the least filled bin and a few others, and best-fit their items."""
    order = sorted(range(len(a.bins)), key=lambda k: a.fills[k])
    gone = {order[0], *rng.sample(range(len(a.bins)), min(len(a.bins), 3))}
    return _refit([list(x) for k, x in enumerate(a.bins) if k not in gone], [i for k in gone for i in a.bins[k]], sizes, capacity)


def trade(bins: list[list[int]], fills: list[int], items: list[int], sizes: list[int], capacity: int) -> list[int]:
    """Exchange one or two items of a bin for one or two of ``items`` wherever that fills the bin better; what is left of ``items``.

    Every trade makes a bin fuller and the remainder smaller, so it ends.
    """
    free = sorted((sizes[i], i) for i in items)
    for b in sorted(range(len(bins)), key=lambda k: fills[k]):
        room = capacity - fills[b]
        if not room or not free:
            continue
        singles = [s for s, _ in free]
        couples = sorted((free[x][0] + free[y][0], x, y) for x in range(len(free)) for y in range(x)) if len(free) <= 40 else []
        sums = [c[0] for c in couples]
        best: tuple[int, tuple[int, ...], tuple[int, ...]] | None = None
        out = [(sizes[i], (i,)) for i in bins[b]] + [(sizes[i] + sizes[j], (i, j)) for n, i in enumerate(bins[b]) for j in bins[b][:n]]
        for gone, which in out:
            at = bisect_right(singles, gone + room) - 1
            if at >= 0 and (gain := singles[at] - gone) > (best[0] if best else 0):
                best = (gain, which, (at,))
            at = bisect_right(sums, gone + room) - 1
            if at >= 0 and (gain := sums[at] - gone) > (best[0] if best else 0):
                best = (gain, which, couples[at][1:])
        if best:
            gain, gone_items, come = best
            bins[b] = [i for i in bins[b] if i not in gone_items] + [free[x][1] for x in come]
            fills[b] += gain
            free = sorted([f for x, f in enumerate(free) if x not in come] + [(sizes[i], i) for i in gone_items])
    return [i for _, i in free]


def _refit(bins: list[list[int]], items: list[int], sizes: list[int], capacity: int) -> Individual:
    fills = [sum(sizes[i] for i in b) for b in bins]
    items = trade(bins, fills, items, sizes, capacity)
    items.sort(key=lambda i: -sizes[i])
    best_fit(sizes, items, bins, fills, capacity)
    return Individual(bins, sizes, capacity)


def evolve(sizes: list[int], capacity: int, seed: int, elites: list[list[int]] = (), generations: int = GENERATIONS, population: int = POPULATION) -> Individual:
    """Best packing of one island; ``elites`` are assignments (bin of each item) from elsewhere.

    Evolution ends early at a packing that needs no more bins than the total
    size does, which none can better.
    """
    rng = random.Random(seed)
    n, least = len(sizes), -(-sum(sizes) // capacity)
    people: list[Individual] = []
    for assignment in elites:
        bins: list[list[int]] = [[] for _ in range(max(assignment, default=-1) + 1)]
        for i, b in enumerate(assignment):
            bins[b].append(i)
        people.append(Individual(bins, sizes, capacity))
    while len(people) < population:
        noise = 0.0 if not people else 0.3
        order = sorted(range(n), key=lambda i: -sizes[i] * (1 - noise * rng.random()))
        bins = []
        best_fit(sizes, order, bins, [], capacity)
        people.append(Individual(bins, sizes, capacity))
        if len(people[-1].bins) <= max(1, least):
            return people[-1]
    for _ in range(generations):
        people.sort(key=lambda x: x.fitness, reverse=True)
        if len(people[0].bins) <= max(1, least):
            break
        half = people[: max(2, population // 2)]
        people = half + [crossover(*rng.sample(half, 2), sizes, capacity, rng) if rng.random() < 0.7 else mutate(rng.choice(half), sizes, capacity, rng) for _ in range(population - len(half))]
    return max(people, key=lambda x: x.fitness)


def _tasks(df: DataFrame, problems: int) -> int:
    """Tasks for so many problems: one each while there are cores for it. Given as a number, they aren't merged by their bytes, which say nothing of the work."""
    return max(1, min(problems, 4 * df.sparkSession.sparkContext.defaultParallelism))


def _evolve_shards(rest: DataFrame, shards: int, capacity: int, islands: int, epochs: int, seed: int) -> DataFrame:
    """(__id, part, rest, shard, bin) of (__id, part, rest), written once."""
    rest = rest.withColumn("shard", F.pmod(F.xxhash64("__id", F.lit(shards)), F.lit(shards)).cast("int"))
    rest = rest.withColumn("at", F.row_number().over(Window.partitionBy("shard").orderBy("__id", "part")) - 1)
    lists = cut(rest.groupBy("shard").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "rest"))), lambda x: x["rest"]).alias("sizes")))
    schema = "shard int, island int, sizes array<long>, assignment array<int>, bins int, fitness double"
    tasks = _tasks(rest, shards * islands)

    def run(epoch: int):
        def island(batches):
            for pdf in batches:
                rows = []
                for shard, number, sizes, elites in zip(pdf["shard"], pdf["island"], pdf["sizes"], pdf["elites"]):
                    sizes = [int(x) for x in sizes]
                    best = evolve(sizes, capacity, hash((seed, int(shard), int(number), epoch)), [[int(b) for b in e] for e in elites])
                    rows.append((shard, number, sizes, best.assignment(len(sizes)), len(best.bins), best.fitness[1]))
                yield pd.DataFrame(rows, columns=["shard", "island", "sizes", "assignment", "bins", "fitness"])

        return island

    spread = lists.withColumns({"island": F.explode(F.sequence(F.lit(0), F.lit(islands - 1))), "elites": F.array().cast("array<array<int>>")})
    done = cut(spread.repartition(tasks, "shard", "island").mapInPandas(run(0), schema))
    for epoch in range(1, epochs):
        # where every shard needs no more containers than its total size does, there is nothing left to gain
        least = F.ceil(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x) / capacity)
        if not done.groupBy("shard").agg(F.min("bins").alias("b"), F.max(F.greatest(least, F.lit(1))).alias("l")).where("b > l").take(1):
            break
        # each island continues from its own best and from the elite of the island before it
        elite = done.select("shard", ((F.col("island") + 1) % islands).alias("island"), F.col("assignment").alias("from"))
        both = done.join(elite, ["shard", "island"]).select("shard", "island", "sizes", F.array("assignment", "from").alias("elites"))
        new = cut(both.repartition(tasks, "shard", "island").mapInPandas(run(epoch), schema))
        forget(done)
        done = new
    best = done.groupBy("shard").agg(F.min_by("assignment", F.struct("bins", (-F.col("fitness")).alias("f"), "island")).alias("assignment"))
    placed = best.select("shard", F.posexplode("assignment").alias("at", "bin"))
    packed = cut(rest.join(placed, ["shard", "at"]).select("__id", "part", "rest", "shard", "bin"))
    forget(done)
    forget(lists)
    return packed


def pack(df: DataFrame, item_id: str, size: Column, capacity: int, *, shard_items: int = SHARD_ITEMS, islands: int = ISLANDS, epochs: int = EPOCHS, seed: int = 17) -> DataFrame:
    """(item_id, part, start, size, container): every item in a container of ``capacity``.

    ``part`` counts the pieces of an item from 0, ``start`` is where a piece
    begins. Rows with one id are one item of their greatest size; a null size
    is 0, a null id is an id. Items of size 0 take part like others. An empty
    table gives an empty result. Sizes beyond the capacity are the only ones
    split, and each container holds at most ``capacity``.
    """
    items = df.select(F.col(item_id).alias("__id"), F.greatest(F.coalesce(size.cast("long"), F.lit(0).cast("long")), F.lit(0).cast("long")).alias("s")).groupBy("__id").agg(F.max("s").alias("s"))
    items = cut(items)
    cap = F.lit(capacity).cast("long")
    # pieces 0..full-1 fill containers; the rest, if any or if the item is not larger, is packed
    full = F.when(F.col("s") > cap, F.floor(F.col("s") / cap)).otherwise(0).cast("int")
    items = items.withColumns({"full": full, "rest": F.col("s") - full * cap})
    out = items.where("full > 0").select("__id", F.explode(F.sequence(F.lit(0), F.col("full") - 1)).alias("part")).select("__id", "part", (F.col("part") * cap).alias("start"), cap.alias("size"), F.concat_ws(":", F.lit("whole"), F.coalesce(F.col("__id").cast("string"), F.lit("")), F.col("part").cast("string")).alias("container"))
    todo, level, shards = items.where("full = 0 or rest > 0").select("__id", F.col("full").alias("part"), "rest"), 0, 0
    while shards != 1:
        shards = max(1, -(-todo.count() // shard_items))
        packed = _evolve_shards(todo, shards, capacity, islands, epochs, seed + level)
        done = packed
        if shards > 1:
            # one container of each shard, so what is packed again shrinks by the containers of a shard each time
            fill = packed.groupBy("shard", "bin").agg(F.sum("rest").alias("fill"))
            last = fill.groupBy("shard").agg(F.min(F.struct("fill", "bin")).alias("l")).select("shard", F.col("l.bin").alias("bin"))
            todo, done = cut(packed.join(last, ["shard", "bin"], "left_semi").select("__id", "part", "rest")), packed.join(last, ["shard", "bin"], "left_anti")
        out = out.unionByName(done.select("__id", "part", (F.col("part") * cap).alias("start"), F.col("rest").alias("size"), F.concat_ws(":", F.lit("level"), F.lit(str(level)), F.col("shard").cast("string"), F.col("bin").cast("string")).alias("container")))
        level += 1
    return out.withColumnRenamed("__id", item_id)
