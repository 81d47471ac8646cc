"""Publishing against a baseline: preserving upserts, retirement, overlays and containment enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions import features as E
from tributary.functions import scalars as S
from tributary.functions.scalars import is_missing
from tributary.operators import resolve as R


def preserve(baseline: DataFrame, candidate: DataFrame, fields: list[str], reliable: str = "B") -> DataFrame:
    """K3: the baseline, enriched and extended by a candidate, with an action for every row.

    Both sides have key, sources (sorted array), bucket, features (``resolve.features_of``) and the fields. By turns:
    add (the key is new); de_enrich (the candidate has fewer sources and their retirement is proven: its row replaces the baseline's); enrich (missing
    fields filled, new sources added); alias (a row whose key the candidate lacks gets the fields of the row of several sources that is
    its mutual unique best match); retire (an absent row loses the reliable source by proof); keep. Keys must be unique on both sides.
    """
    c = candidate.select(F.col("key"), F.col("sources").alias("c_sources"), *[F.col(f).alias(f"c_{f}") for f in fields])
    aliases = alias_matches(baseline, candidate).select(F.col("a_key").alias("key"), F.col("b_key").alias("alias_key"))
    other = candidate.select(F.col("key").alias("alias_key"), F.col("sources").alias("a_sources"), *[F.col(f).alias(f"a_{f}") for f in fields])
    joined = (
        baseline.select("key", "sources", *fields, F.lit(True).alias("in_b")).join(c.withColumn("in_c", F.lit(True)), "key", "full")
        .join(proven_retired(baseline, candidate).withColumn("proven", F.lit(True)), "key", "left")
        .join(aliases.join(other, "alias_key"), "key", "left")
        .join(absent_retired(baseline, candidate, reliable).withColumn("retired", F.lit(True)), "key", "left")
    )
    gains = lambda p: F.exists(
        F.array(*[is_missing(F.col(f)) & ~is_missing(F.col(f"{p}_{f}")) for f in fields]), lambda x: x
    ) | (F.size(F.array_except(f"{p}_sources", "sources")) > 0)
    action = (
        F.when(F.col("in_b").isNull(), "add").when(F.col("proven"), "de_enrich").when(F.col("in_c") & gains("c"), "enrich")
        .when(F.col("in_c").isNull() & F.col("alias_key").isNotNull() & gains("a"), "alias").when(F.col("in_c").isNull() & F.col("retired"), "retire").otherwise("keep")
    )
    told = joined.withColumn("action", action)
    is_ = lambda *names: F.col("action").isin(*names)
    union = lambda p: F.array_sort(F.array_union("sources", f"{p}_sources"))
    sources = F.when(is_("add", "de_enrich"), F.col("c_sources")).when(is_("enrich"), union("c")).when(is_("alias"), union("a")).when(
        is_("retire"), F.array_remove("sources", reliable)
    ).otherwise(F.col("sources"))

    def value(f: str) -> Column:
        fill = F.when(is_("enrich"), F.col(f"c_{f}")).when(is_("alias"), F.col(f"a_{f}"))
        return F.when(is_("add", "de_enrich"), F.col(f"c_{f}")).when(is_missing(F.col(f)) & ~is_missing(fill), fill).otherwise(F.col(f))

    return told.select("key", "action", sources.alias("sources"), *[value(f).alias(f) for f in fields])


def action_counts(rows: DataFrame) -> DataFrame:
    """K3: how many rows each action changed."""
    return rows.groupBy("action").agg(F.count(F.lit(1)).alias("n"))


def battery_contradiction(name: Column, attrs: Column) -> Column:
    """K4: whether a battery field lacks all sizes that the name has."""
    named = F.transform(F.regexp_extract_all(F.lower(name), F.lit(E.BATTERY_NAME), 1), S.number_text)
    fields = F.transform(E._fields(attrs, E.BATTERY_FIELDS), lambda v: S.number_set(F.array(v)))
    return (F.size(named) > 0) & F.exists(fields, lambda v: (F.size(v) > 0) & ~F.arrays_overlap(v, named))


def proven_retired(baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    """K4: keys of which the candidate dropped sources with proof: the baseline row contradicts itself about its battery, or of
    every dropped source there is one row in the candidate's bucket, and its tier conflicts with the candidate's row."""
    c = candidate.select("key", "bucket", F.col("sources").alias("c_sources"), F.col("signature").alias("c_signature"))
    both = baseline.select("key", "sources", "battery_contradiction").join(c, "key")
    fewer = both.where((F.size("c_sources") > 0) & (F.size(F.array_except("c_sources", "sources")) == 0) & (F.size("c_sources") < F.size("sources")))
    dropped = fewer.select("*", F.explode(F.array_except("sources", "c_sources")).alias("source"))
    only = candidate.select("bucket", F.explode("sources").alias("source"), F.col("signature").alias("o_signature")).groupBy("bucket", "source").agg(
        F.count(F.lit(1)).alias("n"), F.first("o_signature").alias("o_signature")
    )
    conflict = E.conflict(F.col("c_signature"), F.col("o_signature"), list(E.DIMENSIONS)) == "tier_mismatch"
    proof = F.coalesce((F.col("n") == 1) & conflict, F.lit(False))
    told = dropped.join(only, ["bucket", "source"], "left").groupBy("key").agg(F.bool_and(proof).alias("proof"), F.first("battery_contradiction").alias("own"))
    return told.where("proof or own").select("key")


def absent_retired(baseline: DataFrame, candidate: DataFrame, reliable: str) -> DataFrame:
    """K4: keys that the candidate lacks, of just two sources with an id, that lose the reliable one: the row contradicts itself, or that source's only
    row in its bucket is of the basic tier and conflicts with it."""
    absent = baseline.join(candidate.select("key"), "key", "left_anti").where((F.size("sources") == 2) & F.array_contains("sources", reliable) & F.col("has_id"))
    only = candidate.where(F.array_contains("sources", reliable)).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.first("signature").alias("o_signature"))
    basic = (F.col("n") == 1) & (F.col("o_signature.tier") == F.array(F.lit("basic")))
    conflict = E.conflict(F.col("signature"), F.col("o_signature"), list(E.DIMENSIONS)) == "tier_mismatch"
    joined = absent.join(only, "bucket", "left")
    return joined.where(F.col("battery_contradiction") | F.coalesce(basic & conflict, F.lit(False))).select("key")


def alias_matches(baseline: DataFrame, candidate: DataFrame, least: float = 0.85) -> DataFrame:
    """F16: a_key, b_key, score: baseline rows of one source that the candidate lacks, matched in their bucket to candidate rows of
    several sources, each the other's only best. Scores are those of resolution."""
    compared = (*R.SCORED[1:], "bucket", "sources")
    absent = baseline.join(candidate.select("key"), "key", "left_anti").where("size(sources) = 1 and bucket is not null")
    told = lambda df: R.kinds(R.alike(df.select(F.col("key").alias("row_id"), *compared), *compared), *compared)
    a, b = (R.side(told(df), ["bucket"], p, ("row_id", *R.SCORED[1:], "sources", "n")) for df, p in ((absent, "a"), (candidate.where("size(sources) > 1"), "b")))
    free = E.conflict(F.col("a_signature"), F.col("b_signature"), list(E.DIMENSIONS)).isNull()
    pairs = a.join(b.hint("merge"), "bucket").where(free & F.array_contains("b_sources", F.col("a_sources")[0])).withColumn("score", R.score()).where(F.col("score") >= least)
    # copies tie: a kind counts as often as it has rows
    wa, wb = Window.partitionBy("a_row_id"), Window.partitionBy("b_row_id")
    best = lambda w, n: (F.col("score") == F.max("score").over(w)) & (F.sum(F.when(F.col("score") == F.col("top"), F.col(n)).otherwise(0)).over(w) == 1)
    pairs = pairs.withColumn("top", F.max("score").over(wa)).withColumn("best_a", best(wa, "b_n"))
    pairs = pairs.withColumn("top", F.max("score").over(wb)).withColumn("best_b", best(wb, "a_n"))
    return pairs.where("best_a and best_b").select(F.col("a_row_id").alias("a_key"), F.col("b_row_id").alias("b_key"), "score")


def single_source(rows: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """K7: rows of exactly that source, and one row of counts: kept, and dropped because other sources share them."""
    mine = F.array_contains("sources", source)
    alone = mine & (F.size("sources") == 1)
    return rows.where(alone), rows.agg(F.count_if(alone).alias("kept"), F.count_if(mine & ~alone).alias("cross_source"), F.count_if(~mine).alias("other"))


#: Longest pieces of text by which names and references find each other.
GRAM = 3


def grams(text: Column) -> Column:
    """All pieces of a text of up to GRAM characters, the empty one included."""

    def pieces(k: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - k + 1, F.lit(1))), lambda i: F.substring(text, i, F.lit(k)))

    every = F.flatten(F.array(*[pieces(k) for k in range(1, GRAM + 1)]))
    return F.array_distinct(F.array_append(F.filter(every, lambda g: g != ""), F.lit("")))


def containing(texts: DataFrame, others: DataFrame, by: list[str]) -> DataFrame:
    """Pairs (text, other) of a block in which the text holds the other. Both: by and s.

    A text that holds another one holds its pieces: each other is looked up by the piece of it (of GRAM characters, or all of a shorter one) that
    fewest texts and others of its block have, never by all texts of the block.
    """
    held = texts.select(*by, F.col("s").alias("text"), F.explode(grams(F.col("s"))).alias("gram"))
    own = others.select(*by, F.col("s").alias("other"), F.explode(grams(F.col("s"))).alias("gram"))
    own = own.where(F.length("gram") == F.least(F.length("other"), F.lit(GRAM)))
    uses = held.select(*by, "gram").unionByName(own.select(*by, "gram")).groupBy(*by, "gram").agg(F.count(F.lit(1)).alias("uses"))
    rarest = own.join(uses, [*by, "gram"]).groupBy(*by, "other").agg(F.min(F.struct("uses", "gram"))["gram"].alias("gram"))
    return held.join(rarest, [*by, "gram"]).where(F.contains("text", "other")).select(*by, "text", "other")


def contained(rows: DataFrame, references: DataFrame, by: list[str]) -> DataFrame:
    """references matched by class: 1 same name, 2 reference inside the name, 3 name inside the reference, 4 same group only.

    Only a row's best class counts; distinct ratios are averaged. Both sides share the blocking columns ``by``.
    rows: row_id, name; references: name, ratio. Names are judged once for all their rows, pairs come from an index of pieces
    (``containing``), and what a group's references say together is summed up once for all names of class 4.
    """
    r = references.select(*by, F.lower("name").alias("ref"), F.col("ratio").cast("decimal(18,2)").alias("ratio")).distinct()
    named = rows.select("row_id", *by, F.lower("name").alias("n"))
    names, refs = named.where("n is not null").select(*by, F.col("n").alias("s")).distinct(), r.where("ref is not null").select(*by, F.col("ref").alias("s")).distinct()
    inside = containing(names, refs, by).select(*by, F.col("text").alias("n"), F.col("other").alias("ref"))
    around = containing(refs, names, by).select(*by, F.col("other").alias("n"), F.col("text").alias("ref"))
    kind = F.when(F.col("n") == F.col("ref"), 1).when(F.contains("n", "ref"), 2).otherwise(3)
    met = inside.unionByName(around).distinct().withColumn("kind", kind)
    best = met.groupBy(*by, "n").agg(F.min("kind").alias("kind"))
    met = met.join(best, [*by, "n", "kind"]).join(r, [*by, "ref"])

    def told(pairs: DataFrame, keys: list[str]) -> DataFrame:
        once = pairs.groupBy(*keys, "ratio").agg(F.min("ref").alias("ref"))
        return once.groupBy(*keys).agg(
            F.round(F.avg("ratio"), 2).cast("double").alias("ratio"),
            F.count(F.lit(1)).alias("n_ratios"),
            F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "ref", F.col("ratio").cast("string")))), ";").alias("detail"),
        )

    close = named.join(told(met, [*by, "n", "kind"]).withColumnRenamed("kind", "best"), [*by, "n"])
    far = named.join(best.select(*by, "n"), [*by, "n"], "left_anti").join(told(r, by), by).withColumn("best", F.lit(4))
    columns = ["row_id", "best", "ratio", F.col("n_ratios").alias("n"), "detail"]
    return close.select(*columns).unionByName(far.select(*columns))


def fill_brand(rows: DataFrame, by_id: DataFrame, key: str) -> DataFrame:
    """an empty brand from the id's brand."""
    known = by_id.groupBy(key).agg(F.min("brand").alias("known"))
    return rows.join(known, key, "left").withColumn("brand", F.when(is_missing(F.col("brand")), F.col("known")).otherwise(F.col("brand"))).drop("known")


def priority_names(listed: DataFrame, gaps: DataFrame, name: str) -> DataFrame:
    """names that are listed and have a gap."""
    return listed.select(name).intersect(gaps.select(name))


def project(rows: DataFrame, aliases: dict[str, str], hidden: DataFrame, least_year: int, rules: list[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass, as sparse cells under canonical headers without hidden ones; and how many rows each reason dropped.

    rows: row_id, year, attrs and what the rules read. Old or missing years are the first reason.
    """
    from tributary.operators.headers import rename_headers
    from tributary.operators.quality import gate, sparse

    reason = gate([("year", F.col("year") >= least_year), *rules])
    marked = rows.withColumn("reason", reason)
    dropped = marked.where("reason is not null").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    kept = marked.where("reason is null").withColumn("attrs", sparse(F.col("attrs")))
    return rename_headers(kept, aliases).join(hidden.select(F.col("key").alias("name")), "name", "left_anti").select("row_id", "name", "value"), dropped
