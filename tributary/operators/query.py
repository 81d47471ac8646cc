"""Faceted queries: predicates, search, sorting, groups, summaries and pages, compiled from a QuerySpec."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions.scalars import first_number, is_missing, is_positive, mapped, natural_key, numbers
from tributary.session import materialise, scratch


@dataclass(frozen=True)
class Range:
    """Bounds on a field; mode "any" takes any number in the value, "first" only the first."""

    field: str
    low: float | None = None
    high: float | None = None
    mode: str = "any"


@dataclass(frozen=True)
class Feature:
    """Fields that must be positive, or keywords in values."""

    fields: tuple[str, ...]
    keywords: tuple[str, ...] = ()
    require_keyword: bool = False


@dataclass(frozen=True)
class SortLevel:
    """L2, L3: a field, its direction, and an order of keywords that goes before anything else."""

    field: str
    descending: bool = False
    keywords: tuple[str, ...] = ()


@dataclass(frozen=True)
class QuerySpec:
    """Everything that one query asks for."""

    search: str = ""
    equals: dict[str, str] = field(default_factory=dict)
    ranges: tuple[Range, ...] = ()
    features: tuple[Feature, ...] = ()
    columns: tuple[tuple[str, str, str], ...] = ()
    sort: tuple[SortLevel, ...] = ()
    page: int = 1
    page_size: int = 50


def in_range(value: Column, low: float | None = None, high: float | None = None, mode: str = "any") -> Column:
    """J1, J3. An active range drops values without a number in mode "first" even where it has no bounds."""
    if mode == "first":
        n = first_number(value)
        checks = [n.isNotNull()] + ([n >= low] if low is not None else []) + ([n <= high] if high is not None else [])
        return F.coalesce(reduce(lambda a, b: a & b, checks), F.lit(False))
    n = numbers(value)
    out = F.lit(True)
    if low is not None:
        out = out & F.exists(n, lambda x: x >= low)
    if high is not None:
        out = out & F.exists(n, lambda x: x <= high)
    return F.coalesce(out, F.lit(False))


def has_feature(attrs: Column, feature: Feature) -> Column:
    """An attribute with a positive value of which the name contains (or is inside) a field, or the value contains a keyword;
    where a keyword is required, only the keyword counts, in whatever attribute it stands."""
    def hit(e: Column) -> Column:
        tests = [F.contains(e["value"], F.lit(k)) for k in feature.keywords]
        if not feature.require_keyword:
            tests += [F.contains(e["key"], F.lit(f)) | F.contains(F.lit(f), e["key"]) for f in feature.fields]
        return is_positive(e["value"]) & reduce(lambda a, b: a | b, tests, F.lit(False))

    return F.coalesce(F.exists(F.map_entries(attrs), hit), F.lit(False))


def matches_text(attrs: Column, text: str) -> Column:
    """The text is inside any name or value, whatever the case."""
    t = F.lit(text.lower())
    return F.coalesce(
        F.exists(F.map_entries(attrs), lambda e: F.contains(F.lower(e["key"]), t) | F.contains(F.lower(e["value"]), t)), F.lit(False)
    )


def column_filter(value: Column, operator: str, wanted: str) -> Column:
    """Contains, gte, lte, equals; equals too needs a number in the value."""
    n = first_number(value)
    test = {
        "contains": lambda: F.contains(F.lower(value), F.lit(wanted.lower())),
        "gte": lambda: n >= float(wanted),
        "lte": lambda: n <= float(wanted),
        "equals": lambda: n.isNotNull() & (F.lower(value) == wanted.lower()),
    }[operator]
    return F.coalesce(test(), F.lit(False))


def default_rows(level: Column, brand: Column, levels: list[str], hidden: list[str]) -> Column:
    """An allowed level (or none), and no hidden text inside the brand."""
    shown = is_missing(level) | level.isin(*levels)
    return shown & ~reduce(lambda a, b: a | b, [F.contains(brand, F.lit(h)) for h in hidden], F.lit(False))


def recent(year: Column, source: Column, least: int, lenient: tuple[str, ...] = ()) -> Column:
    """The year is recent enough; a missing one passes for lenient sources only."""
    return F.when(year.isNull(), source.isin(*lenient) if lenient else F.lit(False)).otherwise(year >= least)


def keyword_rank(value: Column, keywords: tuple[str, ...]) -> Column:
    """L3: the first keyword inside the value, unmatched last."""
    out = F.lit(len(keywords))
    for i, k in reversed(list(enumerate(keywords))):
        out = F.when(F.contains(value, F.lit(k)), F.lit(i)).otherwise(out)
    return out


def sort_keys(value: Column, level: SortLevel) -> list[tuple[Column, str]]:
    """L2: keyword rank, then numbers, then text in natural order; nothing last. Each with the name of its direction."""
    ranks = [(keyword_rank(value, level.keywords), "asc")] if level.keywords else []
    how = "desc_nulls_last" if level.descending else "asc_nulls_last"
    return [*ranks, (first_number(value), how), (natural_key(value), how)]


def default_spec(conditions: list[dict]) -> QuerySpec:
    """The default state that a configuration describes: ranges with their default bounds, and all that are no ranges as
    features unless they are off."""
    number = lambda x: float(x) if x not in (None, "") else None
    ranges = [
        Range(c["field"], number(c.get("defaultMin", c.get("min"))), number(c.get("defaultMax", c.get("max"))), "first")
        for c in conditions
        if c["type"] == "range"
    ]
    features = [_feature(c) for c in conditions if c["type"] != "range" and c.get("defaultEnabled", True)]
    return QuerySpec(ranges=tuple(ranges), features=tuple(features))


def batch_spec(conditions: list[dict]) -> QuerySpec:
    """What the batch filter makes of a configuration: ranges by their own bounds only, features, and nothing that is meant for pages."""
    ranges = [Range(c["field"], c.get("min"), c.get("max")) for c in conditions if c["type"] == "range" and ("min" in c or "max" in c)]
    features = [c for c in conditions if c["type"] == "feature"]
    return QuerySpec(ranges=tuple(ranges), features=tuple(_feature(c) for c in features))


def _feature(c: dict) -> Feature:
    return Feature(tuple(c.get("fields", [c.get("field", "")])), tuple(c.get("keywords", ())), bool(c.get("requireKeyword")))


def snapshot(spec: QuerySpec) -> tuple[str, str]:
    """A query as JSON, and its signature; a changed signature starts again at the first page."""
    text = json.dumps(asdict(spec), sort_keys=True, ensure_ascii=False)
    return text, hashlib.sha256(text.encode()).hexdigest()


def restore(text: str) -> QuerySpec:
    """A query from its JSON."""
    d = json.loads(text)
    d["ranges"] = tuple(Range(**r) for r in d["ranges"])
    d["features"] = tuple(Feature(tuple(f["fields"]), tuple(f["keywords"]), f["require_keyword"]) for f in d["features"])
    d["columns"] = tuple(tuple(c) for c in d["columns"])
    d["sort"] = tuple(SortLevel(x["field"], x["descending"], tuple(x["keywords"])) for x in d["sort"])
    return QuerySpec(**d)


def run(df: DataFrame, spec: QuerySpec, attrs: str = "attrs", mode: str = "interactive") -> DataFrame:
    """Filters in the query's order, as one conjunction for the optimizer."""
    a = F.col(attrs)
    value = lambda f: F.col(f) if f in df.columns else F.element_at(a, F.lit(f))
    tests = [value(f) == v for f, v in spec.equals.items()]
    if spec.search:
        tests.append(matches_text(a, spec.search))
    tests += [in_range(value(r.field), r.low, r.high, r.mode) for r in spec.ranges]
    tests += [has_feature(a, f) for f in spec.features]
    tests += [column_filter(value(c), o, w) for c, o, w in spec.columns]
    return df.where(reduce(lambda x, y: x & y, tests)) if tests else df


def order_keys(df: DataFrame, spec: QuerySpec, attrs: str = "attrs") -> list[tuple[Column, str]]:
    """L2: what to sort by, with directions: more sources first, then the levels, then the ordinal."""
    value = lambda f: F.col(f) if f in df.columns else F.element_at(attrs, F.lit(f))
    first = [(F.col("n_sources"), "desc")] if "n_sources" in df.columns else []
    return [*first, *[k for level in spec.sort for k in sort_keys(value(level.field), level)], (F.col("ordinal"), "asc")]


def ordered(df: DataFrame, spec: QuerySpec, attrs: str = "attrs") -> list[Column]:
    """``order_keys`` as sort expressions."""
    return [getattr(key, how)() for key, how in order_keys(df, spec, attrs)]


def first_groups(df: DataFrame, spec: QuerySpec, shown: tuple[int, str] = (24, ""), step: int = 24) -> tuple[DataFrame, tuple[int, str]]:
    """The first groups of a view and its state (how many, signature). The state of the same query shows ``step`` more; a changed
    query begins again with ``step``."""
    _, signature = snapshot(spec)
    many = shown[0] + step if shown[1] == signature else step
    return df.orderBy(*ordered(df, spec)).limit(many), (many, signature)


def page(df: DataFrame, spec: QuerySpec, attrs: str = "attrs") -> DataFrame:
    """One page of the sorted result, with each row's place. Only a page's rows come together (top-k)."""
    start = (max(1, spec.page) - 1) * spec.page_size
    top = df.orderBy(*ordered(df, spec, attrs)).offset(start).limit(spec.page_size)
    place = F.row_number().over(Window.orderBy(*ordered(df, spec, attrs)))
    return top.withColumn("place", place + start)


class SortedView:
    """A sorted result, written once in sorted ranges of the order, with each row's place inside its range; a page reads its own rows.

    Sort keys are made once a row, before anything is compared. The number of rows of each range (as many as the session has shuffle partitions)
    is all that reaches the driver, so the last page costs what the first one does, whatever a range holds.
    """

    def __init__(self, df: DataFrame, spec: QuerySpec, attrs: str = "attrs"):
        self.spec, self.columns = spec, df.columns
        keys = order_keys(df, spec, attrs)
        keyed = materialise(df.withColumns({f"key{i}_": key for i, (key, _) in enumerate(keys)}), "view-keys")
        order = [getattr(F.col(f"key{i}_"), how)() for i, (_, how) in enumerate(keys)]
        path = scratch(df.sparkSession, "view")
        placed = keyed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("id_", F.monotonically_increasing_id())
        placed = placed.select(*self.columns, F.col("id_").bitwiseAND(F.lit((1 << 33) - 1)).alias("at_"), F.shiftright("id_", 33).cast("int").alias("range_"))
        placed.write.partitionBy("range_").parquet(path)
        self.rows = df.sparkSession.read.schema(placed.schema).parquet(path)
        self.counts = sorted((r["range_"], r["n"]) for r in self.rows.groupBy("range_").agg(F.count(F.lit(1)).alias("n")).collect())
        self.total = sum(n for _, n in self.counts)

    @property
    def pages(self) -> int:
        return max(1, -(-self.total // self.spec.page_size))

    def page(self, number: int) -> DataFrame:
        """A page's rows with their places; a number beyond the last page gives the last one, one below 1 the first."""
        start = (min(max(1, number), self.pages) - 1) * self.spec.page_size
        end = start + self.spec.page_size
        wanted, place, before = [], F.lit(None).cast("long"), 0
        low = high = None
        for name, n in self.counts:
            if before < end and before + n > start:
                place = F.when(F.col("range_") == name, F.col("at_") + before + 1).otherwise(place)
                low, high = (start - before, name) if not wanted else low, (end - before, name)
                wanted.append(name)
            before += n
        rows = self.rows.where(F.col("range_").isin(*wanted))
        if wanted:  # only the first and the last range are read in part
            rows = rows.where((F.col("range_") != low[1]) | (F.col("at_") >= low[0])).where((F.col("range_") != high[1]) | (F.col("at_") < high[0]))
        if len(wanted) == 1:
            rows = rows.where((F.col("at_") >= low[0]) & (F.col("at_") < high[0]))
        return rows.select(*self.columns, place.cast("int").alias("place")).orderBy("place")


def group_rows(df: DataFrame, keys: list[str], price: str | None = None, descending: bool = False) -> DataFrame:
    """M1, L4: each group's size and representative: its first row, or that of least (most) positive price."""
    if price is None:
        choice = F.min_by(F.struct("row_id", F.lit(None).cast("double").alias("price")), "ordinal")
    else:
        p = first_number(F.col(price))
        p = F.when(p > 0, p)
        order = F.struct(p.isNull(), -p if descending else p, "ordinal")
        choice = F.min_by(F.struct("row_id", p.alias("price")), order)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), choice.alias("r")).select(
        *keys, "n", F.col("r.row_id").alias("representative"), F.col("r.price").alias("price")
    )


# What energies are called on display.
LABELS = {"插电混合": "插电式混合动力", "纯电": "纯电动"}


def label_of(x: Column, names: dict[str, str] = LABELS) -> Column:
    """A value on display: without a source in front, under its usual name."""
    return mapped(F.trim(F.regexp_replace(x, "^[^:：]+[:：]", "")), names)


def summary(df: DataFrame, keys: list[str], value: str, sentinel: float = 999) -> DataFrame:
    """Per group one value as it is; several values that all begin with a number as a range of all their parts' numbers, without the
    sentinel and with the first unit that any part has; others distinct and joined. Groups of which nothing is left are left out.
    """
    v = F.trim(F.col(value))
    distinct = df.where(~is_missing(v)).groupBy(*keys, v.alias("v")).agg(F.min("ordinal").alias("at"))
    parts = distinct.select(*keys, "v", "at", F.posexplode(F.split("v", r"[|/]")).alias("pos", "part"))
    bare = F.regexp_replace("part", "^[^:：]*[:：]", "")
    n = F.regexp_extract(bare, r"(-?[\d.]+)", 1).try_cast("double")
    parts = parts.withColumn("n", F.when(n != sentinel, n)).withColumn("unit", F.regexp_replace(bare, r"^-?[\d.]+", "")).withColumn("label", label_of(F.col("part")))
    here = F.struct("at", "v", "pos")
    grouped = parts.groupBy(*keys).agg(
        (F.min("v") == F.max("v")).alias("single"), F.min("v").alias("only"), F.bool_and(F.col("v").rlike(r"^-?[\d.]+")).alias("numeric"),
        F.min("n").alias("low"), F.max("n").alias("high"),
        F.min(F.when(F.col("n").isNotNull() & (F.col("unit") != ""), F.struct(here.alias("here"), "unit")))["unit"].alias("unit"),
        F.array_sort(F.collect_list(F.when(F.col("label") != "", F.struct(here.alias("here"), "label")))).alias("labels"),
    )
    plain = lambda c: F.regexp_replace(c.cast("decimal(24,6)").cast("string"), r"\.?0+$", "")
    span = F.when(F.col("low") == F.col("high"), plain(F.col("low"))).otherwise(F.concat_ws("-", plain(F.col("low")), plain(F.col("high"))))
    text = (
        F.when(F.col("single"), label_of(F.col("only")))
        .when(F.col("numeric"), F.when(F.col("low").isNotNull(), F.concat(span, F.coalesce("unit", F.lit("")))))
        .otherwise(F.array_join(F.array_distinct(F.transform("labels", lambda x: x["label"])), "/"))
    )
    return grouped.select(*keys, text.alias("summary")).where("summary is not null")


def facet(df: DataFrame, value: str) -> DataFrame:
    """Distinct trimmed values with counts and their natural sort key."""
    x = F.trim(F.col(value))
    return df.where(~is_missing(x)).groupBy(x.alias("value")).agg(F.count(F.lit(1)).alias("n")).withColumn("sort_key", natural_key(F.col("value")))


def counters(df: DataFrame, visible: Column, sources: Column, names: list[str]) -> DataFrame:
    """Only ``visible`` follows the filters; the others describe the whole table."""
    return df.agg(
        F.count_if(visible).alias("visible"),
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.size(sources) > 1).alias("verified"),
        *[F.count_if(F.array_contains(sources, n)).alias(f"from_{n}") for n in names],
    )


def round_robin(df: DataFrame, group: str, order: list[Column], ranked: DataFrame | None = None) -> DataFrame:
    """Turn number inside the group, and the group's rank (null for unranked groups, which come after).

    Rows are dealt by ranges of group and order, so that a group of any size lies in several tasks; a row's turn is its place in its range,
    after the rows that the group has in earlier ranges. ranked: group, rank.
    """
    found = ranged(df, [F.col(group), *order])
    held = found.groupBy("part", group).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range of the group
    ahead = held.select("part", F.col(group).alias("g"), "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ahead"))
    joined = found.join(ahead, (found["part"] == ahead["part"]) & found[group].eqNullSafe(F.col("g"))).withColumn(
        "turn", (F.col("at") - F.col("first") + F.col("ahead") + 1).cast("int")
    )
    out = joined.select(*df.columns, "turn")
    return out.join(ranked, group, "left") if ranked is not None else out


def ranged(df: DataFrame, order: list[Column]) -> DataFrame:
    """Every row with ``part``, the range of the order that it lies in, and ``at``, which grows along the order; written once."""
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    return materialise(ordered, "ranged").withColumn("part", F.shiftright("at", 33))


def placed(df: DataFrame, order: list[Column]) -> DataFrame:
    """L1: every row with its place in the whole order, from 1. Rows are dealt by ranges of the order and counted per range."""
    found = ranged(df, order)
    counts = found.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # a row per range
    ahead = counts.select("part", F.coalesce(before, F.lit(0)).alias("ahead"))
    inside = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    joined = found.join(F.broadcast(ahead), "part")  # a row per writing task
    return joined.withColumn("place", F.col("ahead") + inside + 1).select(*df.columns, "place")


def top_per_group(df: DataFrame, group: list[str], order: list[Column], most: int) -> DataFrame:
    """L9."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= most)


def priority_sort(parsed: str) -> list[Column]:
    """L5: "field:asc,field:desc" as sort expressions; text is never reversed (its quirk), only numbers are."""
    out = []
    for part in parsed.split(","):
        name, _, direction = part.strip().partition(":")
        out.append(F.col(name).cast("double").desc_nulls_last() if direction == "desc" else F.col(name).asc_nulls_last())
    return out


def keep_first(df: DataFrame, key: Column, order: str = "ordinal") -> DataFrame:
    """K1, K5: the first row of each key; rows without a key all stay."""
    # the row goes along as one struct, so that no column of it can clash
    keyed = df.select(key.alias("key"), F.col(order).alias("order"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    first = keyed.where("key is not null").groupBy("key").agg(F.min_by("row", "order").alias("row"))
    return first.select("row.*").unionByName(keyed.where("key is null").select("row.*"))


def missing_from(baseline: DataFrame, candidate: DataFrame, key: list[str]) -> DataFrame:
    """K6: baseline keys that the candidate lacks; empty for a superset."""
    return baseline.select(*key).distinct().join(candidate.select(*key).distinct(), key, "left_anti")


def stable_union(stable: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """K2: stable rows, and incoming ones of other keys."""
    return stable.unionByName(incoming.join(stable.select(*key).distinct(), key, "left_anti").select(*stable.columns))


