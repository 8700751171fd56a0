"""Composite pipelines: trends, keywords, clusters, rotation, entity resolution, ranks, rollups, dictionary matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import hashing, names, text, values
from weftline.operators import pairs, relational as rel, state
from weftline.operators.lineage import cut


def post_trends(snapshots: DataFrame, key: str, ts: str, order: str, measures: dict[str, float], as_of: Column, seconds: int) -> DataFrame:
    """(key, <m>_delta..., score): last minus first of each measure in the trailing window, and their weighted sum.

    One aggregate per key; the window is a filter that reaches the scan.
    """
    rows = snapshots.where(values.since(F.col(ts).cast("timestamp"), as_of, seconds, "none"))
    fl = rel.first_last(rows, [key], [ts, order], list(measures))
    delta = {m: F.coalesce(f"last_{m}", F.lit(0)) - F.coalesce(f"first_{m}", F.lit(0)) for m in measures}
    score = values.weighted_delta([(F.col(f"first_{m}"), F.col(f"last_{m}"), w) for m, w in measures.items()])
    return fl.select(key, *[c.alias(f"{m}_delta") for m, c in delta.items()], score.alias("score"))


def keyword_trends(posts: DataFrame, words: Column, ts: str, ranges: dict[str, int], as_of: Column) -> DataFrame:
    """(range, keyword, count): posts in each trailing range that name a keyword; counted per age class first."""
    ordered = sorted(ranges.items(), key=lambda x: x[1])
    age = F.unix_timestamp(as_of) - F.unix_timestamp(F.col(ts).cast("timestamp"))
    smallest = F.coalesce(*[F.when((age >= 0) & (age <= s), F.lit(i)) for i, (_, s) in enumerate(ordered)])
    flat = posts.select(smallest.alias("class"), F.explode(F.array_distinct(words)).alias("keyword")).where("class is not null")
    per = flat.groupBy("class", "keyword").agg(F.count(F.lit(1)).alias("n"))
    wider = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(n).alias("range")) for i, (n, _) in enumerate(ordered)])
    return per.select("keyword", "n", F.explode(F.filter(wider, lambda r: r["i"] >= F.col("class"))).alias("r")).groupBy(F.col("r.range").alias("range"), "keyword").agg(F.sum("n").alias("count"))


def merge_clusters(members: DataFrame, candidates: DataFrame, similarity: Column, least: float = 0.8, top: int = 8) -> DataFrame:
    """(cluster, kept): clusters merge if three best matches reach ``least`` or the three best do so on average.

    Merges are components of the accepted pairs, so their order doesn't matter.
    """
    best = pairs.best_matches(candidates, members, similarity, top)
    mean = (F.col("best1") + F.col("best2") + F.col("best3")) / 3
    merged = best.where((F.col("best3") >= least) | (mean >= least))
    return pairs.components(merged).select(F.col("node").alias("cluster"), F.col("component").alias("kept"))


def rotate(scores: DataFrame, state_: DataFrame, as_of: Column, *, tau: float = 48.0, top: int = 20, gap: int = 1200, hits: int = 3, cooldown: int = 86400) -> DataFrame:
    """State (cluster, consecutive, last_shown, suppressed_until, score) of the clusters shown now.

    ``scores``: cluster, score, at (its latest). Percentile of the score, less
    with age; suppressed clusters are passed over.
    """
    ranked = rel.percentile_desc(scores, "score")
    age = (F.unix_timestamp(as_of) - F.unix_timestamp("at")) / 3600.0
    s = state_.select("cluster", F.col("consecutive").alias("c0"), F.col("last_shown").alias("l0"), F.col("suppressed_until").alias("u0"))
    shown = ranked.withColumn("score", values.decay(F.col("percentile"), age, tau)).join(s, "cluster", "left").where(F.col("u0").isNull() | (F.col("u0") <= as_of)).orderBy(F.desc("score"), "cluster").limit(top)
    n = F.when(F.col("l0").isNotNull() & (F.unix_timestamp(as_of) - F.unix_timestamp("l0") <= gap), F.coalesce("c0", F.lit(0)) + 1).otherwise(1)
    full = n >= hits
    return shown.select("cluster", F.when(full, 0).otherwise(n).alias("consecutive"), as_of.alias("last_shown"), F.when(full, F.timestamp_seconds(F.unix_timestamp(as_of) + cooldown)).otherwise(F.col("u0")).alias("suppressed_until"), "score")


def nested_rollup(df: DataFrame, key: list[str], items: str, item: str, measure: str, note: str, order: list[str], k: int = 20) -> DataFrame:
    """(key, top items, notes, mean and greatest measure, revision) of arrays of structs, in one pass per part.

    The revision is the md5 of what was rolled up, so unchanged keys can be
    told without comparing every column.
    """
    flat = df.select(*key, *order, F.explode(items).alias("i")).select(*key, *order, F.col(f"i.{item}").alias("item"), F.col(f"i.{measure}").alias("m"), F.col(f"i.{note}").alias("note"))
    top = rel.top_k_list(flat, key, "item", k, name="top_items")
    notes = rel.ordered_concat(flat, key, "note", [F.col(o) for o in [*order, "item"]], name="notes")
    nums = flat.groupBy(*key).agg(F.round(F.avg("m"), 3).alias("mean"), F.max("m").alias("top"))
    out = nums.join(top, key, "left").join(notes, key, "left").withColumn("top_items", F.array_join("top_items", ","))
    return out.withColumn("revision", hashing.md5_key("top_items", "notes", "mean", "top"))


def image_rollup(images: DataFrame, key: str, order: list[str], *, labels: int = 20, colors: int = 10, phrases: int = 5) -> DataFrame:
    """What is seen in a key's images, one row a key; every part is one aggregate of flattened rows.

    ``images``: key, order columns, caption, labels and ocr (arrays of
    strings), objects (array of name, count, confidence), colors (array of
    name, ratio), nsfw, violence. Result: captions and ocr joined in order,
    labels of most images, objects (name, count, mean confidence) by their
    sums, colors (name, ratio) by theirs, phrases (the most frequent ocr
    lines), means and maxima of both safety scores, and revision, the md5 of
    all that is text or count. Ties go by name. A key without images has no
    row; null and empty parts add nothing.
    """
    images = images.where(F.col(key).isNotNull())

    def top(rows: DataFrame, n: int, name: str, aggs: list[Column], weight: str) -> DataFrame:
        g = rows.where(F.col("name").isNotNull()).groupBy(key, "name").agg(*aggs)
        best = rel.before(g, [key], [F.desc(weight), F.col("name")], name="__at").where(F.col("__at") < n)
        fields = F.struct("__at", *[c for c in g.columns if c != key])
        return best.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(fields)), lambda x: x.dropFields("__at")).alias(name))

    count = F.count(F.lit(1)).alias("count")
    ocr = images.select(key, *order, F.posexplode("ocr").alias("__line", "name"))
    parts = [
        top(images.select(key, F.explode("labels").alias("name")), labels, "labels", [count], "count"),
        top(images.select(key, F.explode("objects").alias("o")).select(key, "o.*"), labels, "objects", [F.sum("count").alias("count"), F.round(F.avg("confidence"), 3).alias("confidence")], "count"),
        top(images.select(key, F.explode("colors").alias("c")).select(key, "c.*"), colors, "colors", [F.round(F.sum("ratio"), 3).alias("ratio")], "ratio"),
        top(ocr, phrases, "phrases", [count], "count"),
        rel.ordered_concat(images, [key], "caption", [F.col(o) for o in order], name="captions"),
        rel.ordered_concat(ocr, [key], "name", [*[F.col(o) for o in order], F.col("__line")], name="ocr"),
    ]
    out = images.groupBy(key).agg(count.alias("images"), *[f(c).alias(f"{c}_{n}") for c in ("nsfw", "violence") for n, f in (("mean", lambda c: F.round(F.avg(c), 3)), ("max", F.max))])
    for p in parts:
        out = out.join(p, key, "left")
    said = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["name"], x["count"].cast("string"))), ",")
    revision = hashing.md5_key("captions", "ocr", said("labels"), said("objects"), F.array_join(F.transform("colors", lambda x: x["name"]), ","))
    return out.withColumn("revision", revision)


def changed_revisions(now: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Keys whose revision is new or another than the known one: what is to be fused again."""
    k = known.select(F.col(key).alias("__k"), F.col("revision").alias("__old"))
    return now.join(k, F.col(key) == F.col("__k"), "left").where(values.changed(F.col("revision"), F.col("__old"))).select(key, "revision")


def rotation_state(old: DataFrame, shown: DataFrame) -> DataFrame:
    """State of all clusters after a round of ``rotate``: shown ones as they are now, others as they were."""
    rest = old.join(shown.select("cluster"), "cluster", "left_anti")
    return rest.select("cluster", "consecutive", "last_shown", "suppressed_until").unionByName(shown.select("cluster", "consecutive", "last_shown", "suppressed_until"))


#: Rules by which a candidate is found, the surest first.
RULES = ("NUMBER_ADDR", "ALIAS", "NAME_KNN")


def score_candidates(raw: DataFrame, dim: DataFrame, alias: DataFrame, *, k: int = 3) -> DataFrame:
    """(raw_id, company_id, rule, score): candidates by number and address, by alias, and by nearest names for the rest.

    raw: raw_id, name, number, addr_key, industry; dim: company_id, name,
    number, addr_key, industry; alias: company_id, name. Names are compared
    normalised.
    """
    r = raw.select("raw_id", names.normalize_company(F.col("name")).alias("n"), "number", "addr_key", "industry")
    d = dim.select("company_id", names.normalize_company(F.col("name")).alias("dn"), F.col("number").alias("dnum"), F.col("addr_key").alias("daddr"), F.col("industry").alias("dind"))
    exact = r.join(d, (F.col("number") == F.col("dnum")) & (F.col("addr_key") == F.col("daddr"))).select("raw_id", "company_id", F.lit("NUMBER_ADDR").alias("rule"), F.lit(0.95).alias("sim"))
    al = alias.where("company_id is not null").select("company_id", names.normalize_company(F.col("name")).alias("n")).unionByName(d.select("company_id", F.col("dn").alias("n"))).where(F.length("n") >= 3).distinct()
    by_alias = r.join(al, "n").select("raw_id", "company_id", F.lit("ALIAS").alias("rule"), F.lit(0.92).alias("sim"))
    found = cut(exact.unionByName(by_alias))
    rest = r.join(found, "raw_id", "left_anti")
    knn = pairs.knn_trigram(rest.select("n"), d.select(F.col("dn").alias("n")), "n", k)
    near = rest.join(knn, F.col("n") == F.col("l")).join(d.select("company_id", "dn"), F.col("r") == F.col("dn")).select("raw_id", "company_id", F.lit("NAME_KNN").alias("rule"), F.col("similarity").alias("sim"))
    cand = found.unionByName(near).join(r.select("raw_id", "addr_key", "industry"), "raw_id").join(d.select("company_id", "daddr", "dind"), "company_id")
    score = names.match_score(F.col("rule") == "NUMBER_ADDR", F.col("sim"), F.col("industry") == F.col("dind"), F.col("addr_key") == F.col("daddr"))
    return cand.select("raw_id", "company_id", "rule", F.round(score, 6).alias("score")).distinct()


def _ordered(scored: DataFrame) -> DataFrame:
    return scored.withColumns({"__o": -F.col("score"), "__r": F.array_position(F.array(*map(F.lit, RULES)), F.col("rule"))})


def decide(raw: DataFrame, scored: DataFrame, *, accept: float = 0.90, review: float = 0.75) -> DataFrame:
    """(raw_id, company_id, rule, score, decision) of every record by its best candidate; without one NO_CANDIDATE."""
    best = rel.keep_first(_ordered(scored), ["raw_id"], ["__o", "__r", "company_id"]).drop("__o", "__r")
    decision = F.when(F.col("score").isNull(), "NO_CANDIDATE").when(F.col("score") >= accept, "ACCEPTED").when(F.col("score") >= review, "REVIEW").otherwise("REJECTED")
    return raw.select("raw_id").distinct().join(best, "raw_id", "left").withColumn("decision", decision)


def resolve_entities(raw: DataFrame, dim: DataFrame, alias: DataFrame, *, accept: float = 0.90, review: float = 0.75, k: int = 3) -> DataFrame:
    """``decide`` on ``score_candidates``."""
    return decide(raw, score_candidates(raw, dim, alias, k=k), accept=accept, review=review)


def audit(scored: DataFrame, k: int = 3) -> DataFrame:
    """(raw_id, place, company_id, rule, score): the ``k`` best candidates of every record, for the log."""
    best = F.array_sort(F.collect_list(F.struct("__o", "__r", "company_id", "rule", "score")))
    top = _ordered(scored).groupBy("raw_id").agg(F.slice(best, 1, k).alias("c"))
    return top.select("raw_id", F.posexplode("c").alias("place", "c")).select("raw_id", (F.col("place") + 1).alias("place"), "c.company_id", "c.rule", "c.score")


def review_queue(decisions: DataFrame, queue: DataFrame) -> DataFrame:
    """Queue (raw_id, company_id, score, status) with the records to be reviewed; those it has keep their status."""
    new = decisions.where("decision = 'REVIEW'").select("raw_id", "company_id", "score", F.lit("PENDING").alias("status"))
    return state.insert_new(queue.select("raw_id", "company_id", "score", "status"), new, ["raw_id", "company_id"], ["score", "status"])


def learned_aliases(raw: DataFrame, decisions: DataFrame, alias: DataFrame) -> DataFrame:
    """(company_id, name): names of accepted records that their company isn't known by yet, in normalised form."""
    normal = names.normalize_company(F.col("name")).alias("name")
    accepted = decisions.where("decision = 'ACCEPTED'").join(raw.select("raw_id", normal), "raw_id").where(F.length("name") >= 3).select("company_id", "name").distinct()
    return accepted.join(alias.select("company_id", normal).distinct(), ["company_id", "name"], "left_anti")


def monthly_facts(raw: DataFrame, decisions: DataFrame, rollup: DataFrame, month: str, measures: list[str]) -> tuple[DataFrame, DataFrame]:
    """((company_id, month, measures, records), the same by rollup_id) of accepted records; lineage is ``decisions`` itself."""
    own = decisions.where("decision = 'ACCEPTED'").select("raw_id", "company_id").join(raw.select("raw_id", month, *measures), "raw_id")
    facts = own.groupBy("company_id", month).agg(*[F.sum(m).alias(m) for m in measures], F.count(F.lit(1)).alias("records"))
    return facts, rel.rollup_via(facts, rollup, "company_id", "rollup_id", [month], [*measures, "records"])


def rebuild_dim(raw: DataFrame, keys: list[str], month: str, name: str, industry: str) -> DataFrame:
    """(keys, name, industry, first, last): majority name and industry of each key's latest month."""
    m = raw.where(" and ".join(f"{k} is not null" for k in keys)).groupBy(*keys, month, name, industry).agg(F.count(F.lit(1)).alias("n"))
    span = m.groupBy(*keys).agg(F.min(month).alias("first"), F.max(month).alias("last"))
    latest = m.join(span.select(*keys, F.col("last").alias(month)), [*keys, month])
    top = lambda c: latest.where(F.col(c).isNotNull()).groupBy(*keys, c).agg(F.sum("n").alias("n")).groupBy(*keys).agg(F.min(F.struct((-F.col("n")).alias("a"), (-F.length(c)).alias("b"), c)).getField(c).alias(c))
    return span.join(top(name), keys, "left").join(top(industry), keys, "left")


def serve_latest(entities: DataFrame, key: str, facts: dict[str, tuple[DataFrame, list[str], list[str]]]) -> DataFrame:
    """Entities with the latest values of each fact table and their dates; one aggregate and one join per fact."""
    out = entities
    for name, (fact, order, cols) in facts.items():
        last = fact.groupBy(key).agg(F.max_by(F.struct(*cols, F.col(order[0]).alias("__at")), F.struct(*order)).alias("v"))
        out = out.join(last.select(key, *[F.col(f"v.{c}").alias(c) for c in cols], F.col("v.__at").alias(f"{name}_date")), key, "left")
    return out


def rank_changes(monthly: DataFrame, key: str, month: str, value: str) -> DataFrame:
    """(month, key, rank, prior_rank) where the rank differs from the one in the key's month before; only values above 0 are ranked."""
    ranked = rel.before(monthly.where(F.col(value) > 0), [month], [F.desc(value), F.col(key)]).withColumn("rank", (F.col("before") + 1).cast("int"))
    both = rel.asof_prior(ranked.select(key, month, "rank"), ranked.select(key, month, "rank"), [key], month, ["rank"])
    return both.where(values.changed(F.col("rank"), F.col("prior_rank"))).select(month, key, "rank", "prior_rank")


def match_dictionary(df: DataFrame, column: str, terms: dict[str, str]) -> DataFrame:
    """``df`` with ``names``: dictionary names found in the compact form of a text, longest term first."""
    return df.withColumn("names", text.match_terms(text.key_b(F.col(column)), terms))


def apply_rollup_review(queue: DataFrame, rollup: DataFrame) -> DataFrame:
    """(company_id, rollup_id) after approved reviews, each of which sends a company to another; one company has one, the least."""
    approved = queue.where("decision = 'ACCEPTED' and rollup_id is not null").groupBy("company_id").agg(F.min("rollup_id").alias("rollup_id"))
    return state.upsert(rollup.select("company_id", "rollup_id"), approved, ["company_id"]).select("company_id", "rollup_id")


def run_step(control: DataFrame, log: DataFrame, facts: DataFrame, name: str, month: str) -> tuple[DataFrame, DataFrame]:
    """(control, log) after a run over the months past the watermark: it advances, and the log takes the run's id, months and rows.

    A run's id is the md5 of its name and months, so a run that is repeated
    logs itself once.
    """
    last = control.where(F.col("name") == name).agg(F.max("last")).first()[0]
    new = facts if last is None else facts.where(F.col(month) > F.lit(last))
    run = new.agg(F.min(month).alias("first"), F.max(month).alias("last"), F.count(F.lit(1)).alias("rows")).where("rows > 0")
    run = run.select(F.md5(F.concat_ws("|", F.lit(name), "first", "last")).alias("run_id"), F.lit(name).alias("name"), "first", "last", "rows")
    return state.advance_control(control, facts, name, month), log.join(run.select("run_id"), "run_id", "left_anti").unionByName(run)


def apply_review(queue: DataFrame, alias: DataFrame) -> DataFrame:
    """Aliases after approved reviews: new (company_id, name) pairs are added once."""
    approved = queue.where("decision = 'ACCEPTED'").select("company_id", "name")
    return state.insert_new(alias.select("company_id", "name"), approved, ["company_id", "name"], ["name"])
