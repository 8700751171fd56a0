"""Matching entities across sources without keys: soft-logic linkage.

Whether a record describes an entity is a truth value in [0, 1]. Weighted
rules say how it follows from similarities of name, number, address and
industry; exclusivity says that a record describes one entity at most;
transitivity says that records of one place describe the same. With the rules
relaxed by Lukasiewicz logic each is a hinge, and the most probable truth
values minimise a convex sum of squared hinges. It is solved by alternating
directions (consensus ADMM): every rule keeps its own copy of the values it
speaks of and is solved in closed form, then copies are averaged and drawn
together.

Rules only ever connect the records of one place (same established name and
same lot), so every place is a problem of its own; a task solves all places of
an Arrow batch at once with flat arrays. Records with equal evidence are
equal, so they enter as one group with a weight: a place that holds a third of
all records is no larger a problem than any other.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.variants import Reader, establish, learn_trades, read_names
from weftline.operators.lineage import cut

#: Weights of the rules.
WEIGHTS = {
    "name_addr": 4.0, "name_number": 1.5, "number_addr": 3.0, "name_part": 1.5, "name_industry": 0.3,
    "not_addr": 2.0, "not_name": 2.0, "not_number": 0.7, "not_industry": 0.3, "prior": 0.2, "same_place": 6.0,
}
#: Rounds after which a place that still moves is left as it is, and marked; given places take a few hundred.
ROUNDS = 20_000
#: Rounds between two looks at whether a place has come to rest.
LOOK = 10
RHO = 1.0


class Hinges:
    """sum of weight * max(0, a.x + b)^2 under hard a.x + b <= 0 for x in [0, 1]^n, as flat arrays."""

    def __init__(self) -> None:
        self.pot: list[np.ndarray] = []
        self.var: list[np.ndarray] = []
        self.coef: list[np.ndarray] = []
        self.weight: list[np.ndarray] = []
        self.b: list[np.ndarray] = []
        self.n = 0

    def add(self, variables: list[np.ndarray], coefs: list[float], b: np.ndarray, weight: np.ndarray) -> None:
        """One hinge per entry, over one variable of each array."""
        keep = weight > 0
        m = int(keep.sum())
        if not m:
            return
        ids = self.n + np.arange(m)
        for v, c in zip(variables, coefs):
            self.pot.append(ids)
            self.var.append(v[keep])
            self.coef.append(np.full(m, c))
        self.b.append(np.broadcast_to(b, keep.shape)[keep].astype(float))
        self.weight.append(weight[keep].astype(float))
        self.n += m

    def at_most_one(self, variables: np.ndarray, group: np.ndarray) -> None:
        """Hard: the variables of each group sum to one at most. Groups are numbered from 0."""
        m = int(group.max()) + 1 if len(group) else 0
        self.pot.append(self.n + group)
        self.var.append(variables)
        self.coef.append(np.ones(len(variables)))
        self.b.append(np.full(m, -1.0))
        self.weight.append(np.full(m, np.inf))
        self.n += m

    def solve(self, place: np.ndarray, rounds: int = ROUNDS, rho: float = RHO, tolerance: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
        """(values of the variables, whether their place came to rest); ``place`` numbers the variables' places from 0.

        Every place is stopped by its own test alone, so its values don't
        depend on the places solved beside it.
        """
        size = len(place)
        pot, var, coef = np.concatenate(self.pot), np.concatenate(self.var), np.concatenate(self.coef)
        b, weight = np.concatenate(self.b), np.concatenate(self.weight)
        places = int(place.max()) + 1 if size else 0
        out, rest = np.full(size, 0.5), np.zeros(places, dtype=bool)
        names = np.arange(size)
        z, u = np.full(size, 0.5), np.zeros(len(var))
        for done in range(0, rounds, LOOK):
            if done == 0 or len(names) > 2 * np.count_nonzero(~rest[place[names]]):
                # places at rest leave the arrays; what stays keeps its order
                stay = ~rest[place[names]]
                at = np.cumsum(stay) - 1
                keep = stay[var]
                pots, pot = np.unique(pot[keep], return_inverse=True)
                var, coef, u, z, names, b, weight = at[var[keep]], coef[keep], u[keep], z[stay], names[stay], b[pots], weight[pots]
                norm = np.bincount(pot, coef * coef, len(b))
                count = np.maximum(1, np.bincount(var, minlength=len(names)))
                hard = np.isinf(weight)
                soft = np.where(hard, 0, weight)
                factor = np.where(hard, 1 / norm, 2 * soft / (rho + 2 * soft * norm))
            for _ in range(LOOK):
                v = z[var] - u
                over = np.bincount(pot, coef * v, len(b)) + b
                # closed form: stay if satisfied, else step back along the hinge
                x = v - coef * (factor * np.maximum(0, over))[pot]
                new = np.clip(np.bincount(var, x + u, len(names)) / count, 0, 1)
                u = u + x - new[var]
                old, z = z, new
            moved = np.zeros(places)
            np.maximum.at(moved, place[names], np.abs(z - old))
            apart = np.zeros(places)
            np.maximum.at(apart, place[names[var]], np.abs(x - z[var]))
            going = ~rest[place[names]]
            out[names[going]] = z[going]
            rest |= (moved < tolerance) & (apart < 10 * tolerance)
            if rest.all():
                break
        return out, rest[place]


def solve_places(place: np.ndarray, group: np.ndarray, entity: np.ndarray, share: np.ndarray, sims: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Truth values of (group of a place, entity) rows, and whether their place came to rest.

    ``place``, ``group`` and ``entity`` number the rows from 0, groups across
    places; ``share`` is the group's share of its place's records; ``sims``
    holds name, addr, number, industry in [0, 1] and the flags number_known,
    industry_known.
    """
    w, rows = WEIGHTS, np.arange(len(place))
    name, addr, number, industry = (sims[k] for k in ("name", "addr", "number", "industry"))
    known, ind_known = sims["number_known"], sims["industry_known"]
    pairs, pair = np.unique(np.stack([place, entity]), axis=1, return_inverse=True)
    z = len(rows) + pair.reshape(-1)
    h = Hinges()
    up = lambda rule, truth: h.add([rows], [-1.0], truth, w[rule] * share * (truth > 0))
    down = lambda rule, truth, on: h.add([rows], [1.0], -truth, w[rule] * share * on)
    both = lambda a, b: np.maximum(0, a + b - 1)
    up("name_addr", both(name, addr * (addr >= 1)))
    up("name_part", both(name, addr * (addr < 1)))
    up("name_number", both(name, number))
    up("number_addr", both(number, addr))
    up("name_industry", both(name, industry))
    down("not_addr", addr, np.ones(len(rows)))
    down("not_name", name, np.ones(len(rows)))
    down("not_number", number, known)
    down("not_industry", industry, ind_known)
    down("prior", np.zeros(len(rows)), np.ones(len(rows)))
    same = w["same_place"] * share
    h.add([rows, z], [1.0, -1.0], np.zeros(len(rows)), same)
    h.add([rows, z], [-1.0, 1.0], np.zeros(len(rows)), same)
    h.at_most_one(rows, group)
    h.at_most_one(len(rows) + np.arange(pairs.shape[1]), np.unique(pairs[0], return_inverse=True)[1])
    truth, rest = h.solve(np.concatenate([place, pairs[0]]))
    return truth[: len(rows)], rest[: len(rows)]


def _digits(c: Column) -> Column:
    d = F.regexp_replace(c, r"[^0-9]", "")
    return F.when(F.length(d) > 0, d)


def _key(*cols: str) -> Column:
    """128 bits that stand for the columns' values."""
    return F.concat_ws(":", F.hex(F.xxhash64(*cols)), F.hex(F.xxhash64(F.lit(1), *cols)))


def _number_similarity(a: Column, b: Column) -> Column:
    """1 equal, 0.8 for a digit changed, lost or added, 0 otherwise or if one is unknown."""
    near = F.levenshtein(a, b) <= 1
    return F.when(a == b, 1.0).when(near, 0.8).otherwise(0.0)


def match_entities(records: DataFrame, entities: DataFrame, *, least: float = 0.5, reader: Reader | None = None) -> DataFrame:
    """(raw_id, company_id, confidence, settled): the entity that each record describes, if any.

    ``records``: raw_id, name, number, sido, sigungu, dong, emdong, industry,
    lot (what tells places of one name apart); ``entities``: company_id, name,
    number, sigungu, dong, industry. All may be null; a record without a
    readable name or any shared block has no match. Equal rows count once.
    ``settled`` is false where the place had not come to rest when it was left.

    Candidates share the core of the established name and one of: the address
    key, the part of it that is left, or number and district. They are formed
    per place, after records with equal attributes have been counted together.
    """
    e = entities.select("company_id", "name", _digits(F.col("number")).alias("number"), "sigungu", "dong", "industry").distinct()
    reader = reader or learn_trades(e.select("name"), records.select("name"))
    known = cut(read_names(e, ["company_id", "number", "sigungu", "dong", "industry"], "name", reader).where("core <> ''"))
    r = records.select("raw_id", "name", _digits(F.col("number")).alias("number"), "sido", "sigungu", "dong", "emdong", "industry", "lot").distinct()
    spelled = cut(read_names(r.select("name").distinct().where("name is not null"), ["name"], "name", reader).where("core <> ''"))
    to = establish(spelled.groupBy("core", "trade", "script").agg(F.count(F.lit(1)).alias("n")), known)
    named = spelled.join(to.select("core", "trade", "to_core", "to_trade"), ["core", "trade"]).select("name", F.col("to_core").alias("core"), F.col("to_trade").alias("trade"))
    r = r.join(named, "name").select("raw_id", "core", F.col("trade").alias("own_trade"), "number", "sido", "sigungu", "dong", "emdong", "industry", F.coalesce("lot", F.concat(F.lit("?"), F.col("raw_id").cast("string"))).alias("lot"))
    # a name without its line of business belongs to the only one found at its lot; sister firms may share a lot
    only = r.where("own_trade <> ''").groupBy("core", "lot").agg(F.min("own_trade").alias("a"), F.max("own_trade").alias("b")).where("a = b").select("core", "lot", F.col("a").alias("lot_trade"))
    r = r.join(only, ["core", "lot"], "left").withColumn("trade", F.when(F.col("own_trade") == "", F.coalesce("lot_trade", F.lit(""))).otherwise(F.col("own_trade"))).drop("own_trade", "lot_trade")
    facts = ["core", "trade", "number", "sido", "sigungu", "dong", "emdong", "industry", "lot"]
    r = cut(r.withColumns({"place": _key("core", "trade", "lot"), "fact": _key(*facts)}))
    f = cut(r.groupBy("place", "fact", *facts).agg(F.count(F.lit(1)).alias("n")))

    # blocks: address key; province and village where the district is missing; number and district
    keys_e = F.array_compact(F.array(F.concat_ws("|", F.lit("a"), "sigungu", "dong"), F.when(F.col("dong").isNotNull(), F.concat(F.lit("p|"), F.substring("dong", 1, 2), F.lit("|"), F.substring("dong", -5, 3))), F.when(F.col("number").isNotNull(), F.concat_ws("|", F.lit("n"), "number", "sigungu"))))
    emdong = F.coalesce("emdong", F.substring("dong", -5, 3))
    sido = F.coalesce("sido", F.substring("dong", 1, 2))
    keys_r = F.array_compact(F.array(F.when(F.col("dong").isNotNull(), F.concat_ws("|", F.lit("a"), "sigungu", "dong")), F.when(sido.isNotNull() & emdong.isNotNull(), F.concat(F.lit("p|"), sido, F.lit("|"), emdong)), F.when(F.col("number").isNotNull(), F.concat_ws("|", F.lit("n"), "number", "sigungu"))))
    ek = known.select("core", "company_id", F.explode(keys_e).alias("k"))
    fk = f.select("place", "core", F.explode(keys_r).alias("k")).distinct()
    candidates = fk.join(ek, ["core", "k"]).select("place", "company_id").distinct()

    c = known.select("company_id", F.col("core").alias("c_core"), F.col("trade").alias("c_trade"), F.col("number").alias("c_number"), F.col("sigungu").alias("c_sigungu"), F.col("dong").alias("c_dong"), F.col("industry").alias("c_industry"))
    x = f.join(candidates.join(c, "company_id"), "place")
    village = (sido == F.substring("c_dong", 1, 2)) & (emdong == F.substring("c_dong", -5, 3))
    addr = (
        F.when((F.col("sigungu") == F.col("c_sigungu")) & (F.col("dong") == F.col("c_dong")), 1.0)
        .when(F.col("sigungu").isNull() & village, 0.9)
        .when((F.col("sigungu") == F.col("c_sigungu")) & (sido == F.substring("c_dong", 1, 2)), 0.7)
        .when(F.col("sigungu").isNull() & F.col("dong").isNull() & emdong.isNull(), 0.5)
        .otherwise(0.0)
    )
    zero = lambda col: F.coalesce(col, F.lit(0.0))
    x = x.select(
        "place", "fact", "n", "company_id",
        F.when(F.col("trade") == F.col("c_trade"), 1.0).when(F.col("trade") == "", 0.8).otherwise(0.0).alias("name"),
        zero(addr).alias("addr"),
        zero(_number_similarity(F.col("number"), F.col("c_number"))).alias("number"),
        (F.col("number").isNotNull() & F.col("c_number").isNotNull()).cast("double").alias("number_known"),
        zero((F.col("industry") == F.col("c_industry")).cast("double")).alias("industry"),
        (F.col("industry").isNotNull() & F.col("c_industry").isNotNull()).cast("double").alias("industry_known"),
    )
    sims = ["name", "addr", "number", "number_known", "industry", "industry_known"]
    evidence = cut(x.groupBy("place", "fact", "n").agg(F.array_sort(F.collect_list(F.struct("company_id", *sims))).alias("e")).withColumn("kind", _key("e")))
    kinds = evidence.groupBy("place", "kind").agg(F.sum("n").alias("n"), F.first("e").alias("e"))
    problems = kinds.groupBy("place").agg(F.array_sort(F.collect_list(F.struct("kind", "n", "e"))).alias("groups"))

    def solve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            groups = pa.RecordBatch.from_arrays([b.column(1).flatten()], ["g"]).column(0)
            sizes = np.asarray(pa.compute.list_value_length(b.column(1)))
            place_of_group = np.repeat(np.arange(len(b)), sizes)
            if not len(place_of_group):
                continue
            ev = groups.field("e").flatten()
            per = np.asarray(pa.compute.list_value_length(groups.field("e")))
            group = np.repeat(np.arange(len(per)), per)
            n = np.asarray(groups.field("n")).astype(float)
            total = np.bincount(place_of_group, n)
            share = (n / total[place_of_group])[group]
            companies = ev.field("company_id")
            _, entity = np.unique(np.asarray(companies), return_inverse=True)
            truth, rest = solve_places(place_of_group[group], group, entity.reshape(-1), share, {s: np.asarray(ev.field(s)) for s in sims})
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(place_of_group[group])), groups.field("kind").take(pa.array(group)), companies, pa.array(truth), pa.array(rest)], ["place", "kind", "company_id", "truth", "settled"])

    solved = problems.select("place", "groups").mapInArrow(solve, "place string, kind string, company_id long, truth double, settled boolean")
    best = solved.groupBy("place", "kind").agg(F.max(F.struct("truth", (-F.col("company_id")).alias("c"))).alias("b"), F.bool_and("settled").alias("settled")).select("place", "kind", "settled", F.round("b.truth", 4).alias("confidence"), (-F.col("b.c")).alias("company_id")).where(F.col("confidence") >= least)
    by_fact = evidence.select("place", "fact", "kind").join(best, ["place", "kind"]).select("place", "fact", "company_id", "confidence", "settled")
    return r.select("raw_id", "place", "fact").join(by_fact, ["place", "fact"]).select("raw_id", "company_id", "confidence", "settled").distinct()
