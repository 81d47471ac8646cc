"""Queries of reports, gates, extraction and incremental work."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.functions import features as E
from tributary.functions import scalars as S
from tributary.operators import cluster as C
from tributary.operators import fuse as U
from tributary.operators import headers as H
from tributary.operators import profile as R
from tributary.operators import publish as P
from tributary.operators import quality as G
from tributary.operators import query as Q
from tributary.plans.derived import SOURCE_A, SOURCE_B, SPREAD, build, text
from tributary.plans.entities import UNITED, _united
from tributary.session import load, scratch, spread
from tributary.sources import extract as X
from tributary.streaming import frontier as N
from tributary.streaming import incremental as I

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
A, B = text(SOURCE_A), text(SOURCE_B)


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


@query("""SELECT source, n, share FROM (SELECT source, CAST(count(*) AS BIGINT) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS share FROM documents GROUP BY source) ORDER BY n DESC, source LIMIT 20""")
def source_distribution(spark, sf_dir):
    return R.source_distribution(load(spark, sf_dir, "documents"), "source").withColumn("share", F.col("share").cast("double"))


@query(f"""WITH u AS ({UNITED}), g AS (SELECT concat(brand, '|', series, '|', year) AS k, count(DISTINCT source) AS n FROM u GROUP BY 1)
SELECT CAST(count(*) AS BIGINT) AS visible, CAST(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS multi, CAST(sum(CASE WHEN n = 1 THEN 1 ELSE 0 END) AS BIGINT) AS single, round(CAST(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) * 100.0 / count(*) AS DOUBLE), 12) AS multi_rate FROM g""")
def visible_stats(spark, sf_dir):
    u = _united(spark, sf_dir).withColumn("k", S.bucket_key(F.col("brand"), F.col("series"), F.col("year")))
    return R.visible_stats(u, "k")


@query(f"""WITH u AS ({UNITED}) SELECT brand, series, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT source) AS BIGINT) AS sources, CASE WHEN count(DISTINCT source) > 1 THEN 'multi' ELSE 'single' END AS kind FROM u GROUP BY brand, series""")
def single_source_groups(spark, sf_dir):
    return R.single_source_groups(_united(spark, sf_dir), ["brand", "series"])


@query(f"""WITH u AS ({UNITED}), b AS (SELECT brand FROM u GROUP BY brand HAVING count(DISTINCT series) >= 2 AND count(*) >= 4 ORDER BY count(DISTINCT series) DESC, count(*) DESC, brand LIMIT 4)
SELECT brand, row_id, source, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY brand ORDER BY ordinal) AS INT) AS rank FROM u WHERE brand IN (SELECT brand FROM b)) WHERE rank <= 30""")
def brand_samples(spark, sf_dir):
    return R.brand_samples(_united(spark, sf_dir)).select("brand", "row_id", "source", "rank")


GAPS = "SELECT p_partkey AS row_id, p_brand AS brand, CASE WHEN p_partkey % 4 = 0 THEN concat(p_type, ' EV') WHEN p_partkey % 9 = 0 THEN concat(p_type, ' Max') ELSE p_type END AS series, CASE WHEN p_partkey % 3 = 0 THEN 'A' ELSE 'B' END AS source FROM {part}"


@query(f"""WITH g AS ({text(GAPS)}), n AS (SELECT brand, series, count(*) AS n FROM g GROUP BY brand, series HAVING count(*) >= 3)
SELECT x.brand, x.series AS short, y.series AS long, 'EV' AS suffix, CAST(x.n AS BIGINT) AS n, CAST(y.n AS BIGINT) AS long_n FROM n x JOIN n y ON x.brand = y.brand AND y.series = concat(x.series, ' EV')""")
def series_alias_gaps(spark, sf_dir):
    return R.series_alias_gaps(build(spark, sf_dir, GAPS), ("EV", "PHEV"))


@query(f"""WITH g AS ({text(GAPS)}) SELECT brand, series, CAST(count(*) AS BIGINT) AS n, CASE WHEN max(source) = 'A' THEN 'B' ELSE 'A' END AS missing FROM g GROUP BY brand, series HAVING count(*) >= 3 AND count(DISTINCT source) = 1 ORDER BY count(*) DESC, brand, series LIMIT 60""")
def series_source_gaps(spark, sf_dir):
    return R.source_gaps(build(spark, sf_dir, GAPS), ["brand", "series"], ["A", "B"], least=3)


@query("""WITH c AS (SELECT p_name AS series, p_brand AS brand, count(*) AS n FROM part GROUP BY ALL), t AS (SELECT series, arg_max(brand, (n, brand)) AS dominant, max(n) AS dominant_n FROM c GROUP BY series)
SELECT series, brand, CAST(n AS BIGINT) AS n, dominant, CAST(dominant_n AS BIGINT) AS dominant_n FROM c JOIN t USING (series) WHERE brand <> dominant AND n >= 2 AND n < dominant_n""")
def brand_alias_gaps(spark, sf_dir):
    return R.brand_alias_gaps(load(spark, sf_dir, "part").select(F.col("p_name").alias("series"), F.col("p_brand").alias("brand")))


@query(f"""WITH b AS ({B}) SELECT CAST(count(*) AS BIGINT) AS total, CAST(sum(CASE WHEN size = '-' THEN 1 ELSE 0 END) AS BIGINT) AS no_size, CAST(sum(CASE WHEN battery = '-' THEN 1 ELSE 0 END) AS BIGINT) AS no_battery FROM b""")
def quality_counts(spark, sf_dir):
    return R.quality_counts(build(spark, sf_dir, SOURCE_B), ["size", "battery"])


@query("""SELECT CAST(sum(CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS invalid_brand, CAST(sum(CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS invalid_model_name,
CAST(sum(CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS invalid_series, CAST(sum(CASE WHEN p_size > 40 THEN 1 ELSE 0 END) AS BIGINT) AS invalid_year, CAST(sum(CASE WHEN p_type <> 'SMALL' THEN 1 ELSE 0 END) AS BIGINT) AS unapproved_status FROM part""")
def identity_counts(spark, sf_dir):
    """H9."""
    k = F.col("p_partkey")
    return R.identity_counts(
        load(spark, sf_dir, "part").select(
            F.when(k % 4 == 0, "-").when(k % 2 == 0, F.col("p_brand")).otherwise("品牌").alias("brand"), F.when(k % 5 == 0, " ").otherwise(F.col("p_name")).alias("model"),
            F.when(k % 3 == 0, F.col("p_type")).otherwise(F.concat("p_type", F.lit("系"))).alias("series"), F.when(F.col("p_size") > 40, "24款").otherwise("2024").alias("year"),
            F.when(F.col("p_type") == "SMALL", " approved").alias("status"),
        )
    )


@query("""WITH h AS (SELECT o_orderpriority, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS heat FROM orders WHERE o_orderkey % 3 <> 0 AND o_totalprice > 0 GROUP BY 1)
SELECT o_orderpriority, round(heat, 2) AS heat, CAST(row_number() OVER (ORDER BY heat DESC, o_orderpriority) AS BIGINT) AS rank FROM h""")
def heat_rank(spark, sf_dir):
    """Amounts of nothing or less don't count; items of several lists count as often."""
    amount = F.when(F.col("o_orderkey") % 3 == 0, -1).otherwise(F.col("o_totalprice")).cast("decimal(18,2)")
    return R.heat(load(spark, sf_dir, "orders").withColumn("amount", amount), "o_orderpriority", "amount").withColumn("heat", F.round(F.col("heat").cast("double"), 2))


@query("""SELECT o_custkey, CAST(max(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM orders WHERE o_orderkey % 3 <> 0 AND o_totalprice > 0 GROUP BY o_custkey""")
def best_sales(spark, sf_dir):
    """H10."""
    amount = F.when(F.col("o_orderkey") % 3 == 0, -1).otherwise(F.col("o_totalprice")).cast("decimal(18,2)")
    return R.best_sales(load(spark, sf_dir, "orders").withColumn("amount", amount), "o_custkey", "amount").withColumn("amount", F.col("amount").cast("double"))


SOURCED = "SELECT p_brand, p_type, p_partkey, CASE WHEN p_brand < 'Brand#2' AND p_type < 'P' THEN 1 WHEN p_partkey % 4 = 0 THEN 2 ELSE 1 END AS k, CASE WHEN p_brand < 'Brand#2' AND p_type < 'P' THEN 'A' WHEN p_partkey % 4 = 0 THEN 'A+B' ELSE 'B' END AS s FROM part"
SOURCED_GROUPS = f"WITH r AS ({SOURCED}), g AS (SELECT p_brand, p_type, count(*) AS n, sum(CASE WHEN k = 1 THEN 1 ELSE 0 END) AS alone, CASE WHEN max(s) = 'A' OR min(s) = 'B' THEN 1 ELSE 2 END AS ns, max(s) AS source FROM r GROUP BY ALL)"


def _sourced(spark, sf_dir):
    one = (F.col("p_brand") < "Brand#2") & (F.col("p_type") < "P")
    return load(spark, sf_dir, "part").withColumn("sources", F.when(one, F.array(F.lit("A"))).when(F.col("p_partkey") % 4 == 0, F.array(F.lit("A"), F.lit("B"))).otherwise(F.array(F.lit("B"))))


@query(SOURCED_GROUPS + """ SELECT CAST(sum(CASE WHEN ns = 1 THEN n ELSE 0 END) AS BIGINT) AS single_series_rows, CAST(sum(CASE WHEN ns = 2 THEN alone ELSE 0 END) AS BIGINT) AS multi_series_single_rows, CAST(count(*) AS BIGINT) AS total_series,
CAST(sum(CASE WHEN ns = 1 THEN 1 ELSE 0 END) AS BIGINT) AS single_source_series, CAST(sum(CASE WHEN ns = 2 THEN 1 ELSE 0 END) AS BIGINT) AS multi_source_series FROM g""")
def single_source_totals(spark, sf_dir):
    """H3."""
    return R.single_source_totals(_sourced(spark, sf_dir), ["p_brand", "p_type"])


@query(SOURCED_GROUPS + " SELECT p_brand, p_type, source, CAST(n AS BIGINT) AS n FROM g WHERE ns = 1 ORDER BY n DESC, p_brand, p_type LIMIT 30")
def single_source_top(spark, sf_dir):
    """H3."""
    return R.single_source_top(_sourced(spark, sf_dir), ["p_brand", "p_type"])


@query("""SELECT p_partkey, CASE WHEN p_partkey % 5 <> 0 THEN concat(lower(p_brand), '|', p_name, '|2024') END AS car, concat(p_name, '|8gb') AS phone,
CASE p_partkey % 3 WHEN 0 THEN concat('identity:', repeat('ab', 12)) WHEN 1 THEN NULL ELSE concat(lower(p_brand), '|', p_name) END AS laptop FROM part""")
def kind_identities(spark, sf_dir):
    """H4."""
    k = F.col("p_partkey")
    spaced = F.concat(F.lit(" "), F.regexp_replace("p_name", " ", "  "))
    car = R.kind_identity("cars", {"brand": F.col("p_brand"), "model": spaced, "year": F.when(k % 5 != 0, "2024")})
    phone = R.kind_identity("phones", {"model": F.col("p_name"), "memory": F.lit("８GB"), "storage": F.lit(" ")})
    key = F.when(k % 3 == 0, F.repeat(F.lit("AB"), 12)).when(k % 3 == 1, "none")
    laptop = R.kind_identity("laptops", {"brand": F.col("p_brand"), "model": F.col("p_name"), "identity_key": key})
    return load(spark, sf_dir, "part").select("p_partkey", car.alias("car"), phone.alias("phone"), laptop.alias("laptop"))


@query("""WITH n AS (SELECT count(*) AS n, sum(CASE WHEN p_partkey % 4 = 0 THEN 1 ELSE 0 END) AS a, sum(CASE WHEN p_partkey % 4 = 1 THEN 1 ELSE 0 END) AS b FROM part)
SELECT 'x' AS key, 'attribute' AS kind, CAST(n AS BIGINT) AS n FROM n UNION ALL SELECT 'y', 'attribute', CAST(n AS BIGINT) FROM n UNION ALL SELECT 'x', 'conflict', CAST(a + b AS BIGINT) FROM n UNION ALL SELECT 'x', 'synonym', CAST(2 * a + b AS BIGINT) FROM n""")
def attribute_evidence(spark, sf_dir):
    """H5."""
    k = F.col("p_partkey") % 4
    value = F.when(k == 0, "A:标配|B: 无 ").when(k == 1, "A:有").otherwise(F.col("p_name"))
    rows = load(spark, sf_dir, "part").select(F.explode(F.array(F.struct(F.lit("x").alias("key"), value.alias("value")), F.struct(F.lit("y").alias("key"), F.col("p_type").alias("value")), F.struct(F.lit("z").alias("key"), F.lit("-").alias("value")))).alias("c")).select("c.*")
    return R.attribute_evidence(rows, ("A", "B"))


REASON = "CASE WHEN p_size < 5 THEN 'too_small' WHEN p_retailprice < 950 THEN 'too_cheap' WHEN p_partkey % 6 = 0 THEN 'no_identity' END"


def _gate():
    return G.gate([("too_small", F.col("p_size") >= 5), ("too_cheap", F.col("p_retailprice") >= 950), ("no_identity", F.col("p_partkey") % 6 != 0)])


@query(f"SELECT p_partkey, {REASON} AS reason FROM part")
def publish_gate(spark, sf_dir):
    return load(spark, sf_dir, "part").select("p_partkey", _gate().alias("reason"))


@query(f"SELECT coalesce({REASON}, 'valid') AS reason, CAST(count(*) AS BIGINT) AS n FROM part GROUP BY 1")
def invalid_reasons(spark, sf_dir):
    return R.reasons(load(spark, sf_dir, "part"), _gate())


@query("SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(CASE WHEN p_size < 3 THEN 1 ELSE 0 END) AS BIGINT) AS failed FROM part")
def row_gate(spark, sf_dir):
    return G.require_rows(load(spark, sf_dir, "part"), 50, F.col("p_size") < 3)


@query(f"""WITH x AS (SELECT concat(brand, '|', model, '|', year) AS key, * FROM ({A})), y AS (SELECT concat(brand, '|', lower(model), '|', year) AS key, brand, series, year, 'B' AS source FROM ({B}) UNION ALL SELECT key, brand, series, year, source FROM x WHERE row_id % 3 = 0)
SELECT 'missing_identity' AS kind, substr(sha256(key), 1, 16) AS key_hash, CAST(NULL AS VARCHAR) AS source FROM (SELECT DISTINCT key FROM x) WHERE key NOT IN (SELECT key FROM y)
UNION ALL SELECT 'source_regression', substr(sha256(key), 1, 16), source FROM (SELECT DISTINCT key, source, brand, series, year FROM x) d WHERE key IN (SELECT key FROM y)
AND NOT EXISTS (SELECT 1 FROM y WHERE y.key = d.key AND y.source = d.source) AND NOT EXISTS (SELECT 1 FROM y WHERE y.source = d.source AND y.brand = d.brand AND y.series = d.series AND y.year = d.year)""")
def audit_regression(spark, sf_dir):
    key = lambda m: F.concat_ws("|", "brand", m, "year")
    a = build(spark, sf_dir, SOURCE_A).withColumn("key", key(F.col("model")))
    b = build(spark, sf_dir, SOURCE_B).withColumn("key", key(F.lower("model")))
    columns = ["key", "source", "brand", "series", "year"]
    candidate = b.select(*columns).unionByName(a.where("row_id % 3 = 0").select(*columns))
    return G.audit(a.select(*columns), candidate, ["brand", "series", "year"])


@query("""WITH p AS (SELECT p_partkey AS k, p_partkey // 2 AS c FROM part)
SELECT substr(sha256(CAST(k AS VARCHAR)), 1, 16) AS key_hash, 'size' AS field, 'C' AS source FROM p WHERE k % 3 = 1
UNION ALL SELECT substr(sha256(CAST(k AS VARCHAR)), 1, 16), 'name', 'B' FROM p WHERE k % 2 = 0 AND c % 4 = 0""")
def audit_provenance(spark, sf_dir):
    """Even rows have source A, odd ones B; both stand in one component, but for each fourth pair, which has none."""
    k = F.col("p_partkey")
    name = F.when(k % 2 == 0, F.concat(F.lit("A:"), "p_name", F.lit("|B:x|16:9"))).otherwise(F.concat(F.lit("尺寸:"), "p_name"))
    size = F.when(k % 3 == 1, F.concat(F.lit("C:"), "p_size")).when(k % 3 == 0, F.concat(F.lit("16:9|"), "p_size"))
    pair = F.floor(k / 2)
    rows = load(spark, sf_dir, "part").select(
        k.cast("string").alias("key"), F.when(pair % 4 != 0, pair).alias("component"), F.array(F.when(k % 2 == 0, "A").otherwise("B")).alias("sources"), name.alias("name"), size.alias("size")
    )
    return G.provenance_contradictions(rows, ["name", "size"], ("A", "B", "C"))


@query("""SELECT CAST(count(*) AS BIGINT) AS n, CAST(CAST(sum(CAST(concat('0x', substr(sha256(p_name || '|' || p_partkey), 1, 12)) AS BIGINT)) AS HUGEINT) AS VARCHAR) AS fingerprint FROM part""")
def audit_fingerprint(spark, sf_dir):
    """N4."""
    return G.fingerprint(load(spark, sf_dir, "part").select(F.concat_ws("|", "p_name", "p_partkey").alias("key")))


@query("""SELECT substr(sha256(CAST(p_partkey AS VARCHAR)), 1, 16) AS key_hash, CASE WHEN p_partkey % 5 = 0 THEN 'x' END AS stored, CASE WHEN p_partkey % 5 = 0 THEN p_brand WHEN p_partkey % 7 = 0 THEN 'y' END AS recomputed FROM part WHERE p_partkey % 5 = 0 OR p_partkey % 7 = 0""")
def audit_annotations(spark, sf_dir):
    """Stored annotations that a recomputation doesn't give."""
    k = F.col("p_partkey")
    p = load(spark, sf_dir, "part").select(k.cast("string").alias("key"), F.when(k % 5 == 0, "x").when(k % 3 == 0, "z").alias("stored"), F.when(k % 5 == 0, F.col("p_brand")).when(k % 3 == 0, "z").when(k % 7 == 0, "y").alias("new"), k)
    p = p.where((k % 5 == 0) | (k % 7 == 0) | (k % 11 == 0)).withColumn("stored", F.when((k % 5 != 0) & (k % 7 == 0), None).otherwise(F.col("stored"))).withColumn("new", F.when((k % 5 != 0) & (k % 7 == 0), "y").otherwise(F.col("new")))
    return G.annotation_changes(p.select("key", F.col("stored").alias("component_id")), p.select("key", F.col("new").alias("component_id")))


@query("""SELECT CAST(count(*) AS BIGINT) AS rows_before, CAST(count(*) AS BIGINT) AS rows_after, CAST(sum(p_size) AS BIGINT) AS metric_before, CAST(sum(p_size + 1) AS BIGINT) AS metric_after, CAST(sum(CASE WHEN p_size >= 50 THEN 1 ELSE 0 END) AS BIGINT) AS contradictions, CAST(0 AS BIGINT) AS changed, sum(CASE WHEN p_size >= 50 THEN 1 ELSE 0 END) = 0 AS ok FROM part""")
def replay_metrics(spark, sf_dir):
    p = load(spark, sf_dir, "part")
    return G.replay(p, p.withColumn("p_size", F.col("p_size") + 1), "p_partkey", "p_size", F.col("p_size") > 50)


@query("""WITH e AS (SELECT p_name AS key, p_type AS target, max(p_size) / 50.0 AS confidence FROM part WHERE p_partkey % 20 = 0 GROUP BY ALL), m AS (SELECT *, count(*) OVER (PARTITION BY key) AS copies FROM e),
r AS (SELECT *, CASE WHEN confidence < 0.9 THEN 'low_confidence' WHEN target NOT IN ('SMALL', 'LARGE', 'PROMO') THEN 'unknown_target' WHEN copies > 1 THEN 'duplicate' END AS reason FROM m),
p AS (SELECT *, row_number() OVER (PARTITION BY reason ORDER BY confidence DESC, key) AS place FROM r) SELECT key, target, coalesce(reason, CASE WHEN place > 2 THEN 'over_cap' END) AS reason FROM p""")
def accept_edits(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    edits = part.where("p_partkey % 20 = 0").groupBy(F.col("p_name").alias("key"), F.col("p_type").alias("target")).agg((F.max("p_size") / 50).alias("confidence"))
    targets = part.where(F.col("p_type").isin("SMALL", "LARGE", "PROMO")).select(F.col("p_type").alias("target"))
    return G.accept_edits(edits, targets, 2)


LOG = "concat(event_type, ' ', CAST(CAST(floor(value) AS BIGINT) AS STRING), ' rows')"


@query(f"""SELECT event_id, CASE WHEN floor(value) >= 50 THEN 'progress' WHEN event_type = 'error' THEN 'failed' WHEN event_type IN ('view', 'click') THEN 'read' ELSE 'unknown' END AS kind, CAST(floor(value) AS DOUBLE) AS amount FROM events""")
def log_classify(spark, sf_dir):
    line = F.concat("event_type", F.lit(" "), F.floor("value").cast("string"), F.lit(" rows"))
    kind, amount = G.classify_log(line, [("failed", "error"), ("read", "view|click")], threshold=50)
    return load(spark, sf_dir, "events").select("event_id", kind.alias("kind"), amount.alias("amount"))


@query("""WITH m AS (SELECT event_id, (hour(ts) * 60 + minute(ts) + 480) % 1440 AS minutes FROM events) SELECT event_id, minutes >= 1320 OR minutes <= 120 AS inside FROM m""")
def window_membership(spark, sf_dir):
    return load(spark, sf_dir, "events").select("event_id", G.in_window(F.col("ts"), 1320, 120).alias("inside"))


@query(r"""SELECT page_id, trim(replace(replace(replace(replace(replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&')) AS title FROM pages""")
def page_titles(spark, sf_dir):
    return load(spark, sf_dir, "pages").select("page_id", X.title(F.col("html")).alias("title"))


@query(r"""WITH l AS (SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) AS root, unnest(list_distinct(regexp_extract_all(html, '(?i)<a\s[^>]*?href="([^"]*)"', 1))) AS link FROM pages)
SELECT page_id, CASE WHEN regexp_matches(link, '^[a-z]+://') THEN link WHEN starts_with(link, '/') THEN concat(root, link) ELSE concat(root, '/', link) END AS link FROM l""")
def page_links(spark, sf_dir):
    p = load(spark, sf_dir, "pages").select("page_id", "url", F.explode(X.links(F.col("html"))).alias("link"))
    return p.select("page_id", X.absolute(F.col("url"), F.col("link")).alias("link"))


# References and what they are on the page http://h{n}.org/a/b{n}/c.html?x=1#f, by RFC 3986.
REFERENCES = {
    "x": "/a/b{n}/x", "../x": "/a/x", "../../../x": "/x", "/r/../s/./t": "/s/t", "?q=2": "/a/b{n}/c.html?q=2", "#top": "/a/b{n}/c.html?x=1#top", "./": "/a/b{n}/", "..": "/a/",
    "/": "/", "g;x=1/../y": "/a/b{n}/y", "x/.": "/a/b{n}/x/", "d//e?z=/../w#/..": "/a/b{n}/d/e?z=/../w#/..",
}
OTHER_REFERENCES = {"//o.com/y": "http://o.com/y", "mailto:a@b": "mailto:a@b", "https://z/q/../r": "https://z/q/../r"}
QUOTES = ('"', "'", "")


def _resolved(n: str) -> str:
    told = [f"concat('http://h', {n}, '.org{path.replace('{n}', chr(39) + ', ' + n + ', ' + chr(39))}')" for path in REFERENCES.values()]
    return ", ".join([*told, *[f"'{u}'" for u in OTHER_REFERENCES.values()]])


@query(f"SELECT DISTINCT page_id, unnest([{_resolved('page_id % 9')}]) AS link FROM pages")
def resolved_links(spark, sf_dir):
    """Links in any quotes, resolved against the page that holds them."""
    refs = [*REFERENCES, *OTHER_REFERENCES]
    anchors = "".join(f"<p><a class=k href={q}{r}{q} id=z>t</a><A  data-x='1'\n href = {q}{r}{q}>u</A>" for r, q in ((r, QUOTES[i % 3]) for i, r in enumerate(refs)))
    n = (F.col("page_id") % 9).cast("string")
    base = F.concat(F.lit("http://h"), n, F.lit(".org/a/b"), n, F.lit("/c.html?x=1#f"))
    p = load(spark, sf_dir, "pages").select("page_id", base.alias("base"), F.explode(X.links(F.concat(F.lit(anchors), F.lit("<a name=x>no</a>")))).alias("link"))
    return p.select("page_id", X.absolute(F.col("base"), F.col("link")).alias("link"))


@query("""SELECT page_id, CASE page_id % 6 WHEN 0 THEN true WHEN 1 THEN true ELSE false END AS listed, CASE WHEN page_id % 6 IN (0, 1, 3) THEN CAST(page_id AS VARCHAR) ELSE '' END AS id FROM pages""")
def listed_pages(spark, sf_dir):
    """The wanted kind of page, and the number in its path."""
    k, i = F.col("page_id") % 6, F.col("page_id").cast("string")
    cases = ["https://cars.org/model-", "/Model-", "https://cars.org/news", "https://other.org/model-", "https://cars.org/a/model-", "https://cars.org/9model"]
    url = F.concat(F.element_at(F.array(*map(F.lit, cases)), k.cast("int") + 1), F.when(k.isin(0, 1, 3, 4), i).otherwise(""), F.when(k == 0, "/peizhi/").otherwise("?q=7"))
    p = load(spark, sf_dir, "pages").select("page_id", url.alias("url"))
    return p.select("page_id", X.listed_page(F.col("url"), "cars.org", ["news"], "peizhi").alias("listed"), X.numeric_id(F.col("url")).alias("id"))


def _nested(spark, sf_dir):
    """A customer with its orders, as JSON: objects in lists in objects; one in five has none."""
    order = F.struct(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("id"), F.col("o_orderstatus").alias("name"), F.col("o_orderpriority").alias("level"))
    orders = F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", order.alias("o")))), lambda x: x["o"])
    held = load(spark, sf_dir, "orders").groupBy("o_custkey").agg(orders.alias("orders"))
    both = held.select("o_custkey", F.struct(F.col("o_custkey").alias("no"), F.struct("orders", F.slice("orders", 1, 1).alias("again")).alias("data")).alias("d"))
    return X.walk_json(both.select("o_custkey", F.when(F.col("o_custkey") % 5 == 0, "{}").otherwise(F.to_json("d")).alias("payload")), "o_custkey", "payload")


NESTED = """WITH o AS (SELECT CAST(o_custkey AS VARCHAR) AS o_custkey, concat('o', o_orderkey) AS id, o_orderstatus AS name, o_orderpriority AS level, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS i, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders WHERE o_custkey % 5 <> 0)"""


@query(NESTED + """ SELECT o_custkey, concat('$.data.orders[', i, ']') AS path, id, name FROM o UNION ALL SELECT o_custkey, '$.data.again[0]', id, name FROM o WHERE i = 0
UNION ALL SELECT DISTINCT o_custkey, '$', NULL, NULL FROM o UNION ALL SELECT DISTINCT o_custkey, '$.data', NULL, NULL FROM o UNION ALL SELECT DISTINCT CAST(o_custkey AS VARCHAR), '$', NULL, NULL FROM orders WHERE o_custkey % 5 = 0""")
def json_walk(spark, sf_dir):
    return _nested(spark, sf_dir).select("o_custkey", "path", "id", "name")


@query(NESTED + " SELECT o_custkey, id, name, CAST(CASE WHEN i = 0 THEN 2 ELSE 1 END AS BIGINT) AS seen, level FROM o")
def json_entities(spark, sf_dir):
    """A10: objects with id and name, by id."""
    return X.entities(_nested(spark, sf_dir), "o_custkey").select("o_custkey", "id", "name", "seen", F.col("fields")["level"].alias("level"))


@query(NESTED + " SELECT o_custkey, string_agg(id, '+' ORDER BY i) AS ids, false AS empty FROM o GROUP BY 1 UNION ALL SELECT DISTINCT CAST(o_custkey AS VARCHAR), '', true FROM orders WHERE o_custkey % 5 = 0")
def json_ids(spark, sf_dir):
    """A5."""
    return X.ids_in(_nested(spark, sf_dir), "o_custkey").select("o_custkey", F.array_join("ids", "+").alias("ids"), "empty")


@query("""WITH o AS (SELECT l_orderkey, list(l_linenumber ORDER BY l_linenumber) AS ns, list(l_returnflag ORDER BY l_linenumber, l_returnflag) AS fs FROM lineitem GROUP BY 1)
SELECT l_orderkey, CAST(unnest(ns) AS VARCHAR) AS title, unnest(fs) AS value FROM o""")
def positional_zip(spark, sf_dir):
    sort = lambda c: F.transform(F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").alias("n"), F.col(c).alias("v")))), lambda x: x["v"].cast("string"))
    o = load(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(sort("l_linenumber").alias("t"), sort("l_returnflag").alias("v"))
    return o.select("l_orderkey", F.inline(X.zip_titles(F.col("t"), F.col("v")))).toDF("l_orderkey", "title", "value")


@query("""WITH x AS (SELECT l_orderkey, l_linestatus AS name, CAST(l_linenumber AS VARCHAR) AS value, row_number() OVER (PARTITION BY l_orderkey, l_linestatus ORDER BY l_linenumber) - 1 AS position FROM lineitem)
SELECT l_orderkey, name, CAST(position AS INT) AS position, value FROM x""")
def group_positions(spark, sf_dir):
    items = load(spark, sf_dir, "lineitem").groupBy("l_orderkey", F.col("l_linestatus").alias("name")).agg(F.array_sort(F.collect_list("l_linenumber")).alias("ns"))
    item = F.struct("name", F.transform("ns", lambda n: F.struct(F.when(n % 2 == 0, n.cast("string")).otherwise("").alias("value"), F.array(F.struct(n.cast("string").alias("value"))).alias("subList"))).alias("paramValues"))
    docs = items.groupBy("l_orderkey").agg(F.to_json(F.struct(F.array(F.struct(F.collect_list(item).alias("items"))).alias("data"))).alias("payload"))
    return X.groups_by_position(docs, "l_orderkey", "payload").select("l_orderkey", "name", "position", "value")


@query("""WITH x AS (SELECT l_orderkey, l_linenumber AS n, l_partkey AS p, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) - 1 AS position FROM lineitem)
SELECT l_orderkey, CAST(position AS INT) AS position, concat('m', p) AS model, CASE WHEN p % 3 = 0 THEN 'unapproved' WHEN p % 3 = 1 THEN 'approved' ELSE 'unknown' END AS status, CAST(n AS VARCHAR) AS line, concat('x', p) AS part FROM x""")
def position_records(spark, sf_dir):
    """Groups of values by position to records; the last known status counts, names come from JSON inside JSON."""
    lines = spread(load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), "l_orderkey").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("l"))
    base = lambda x: F.to_json(F.struct(F.concat(F.lit("m"), x["l_partkey"].cast("string")).alias("carName"), F.when(x["l_partkey"] % 3 == 0, "停产 预售").when(x["l_partkey"] % 3 == 1, "0").alias("status")))
    first = F.transform("l", lambda x: F.struct(x["l_linenumber"].cast("string").alias("value"), base(x).alias("baseInfo"), F.lit("").alias("saleStatusName")))
    second = F.transform("l", lambda x: F.struct(F.concat(F.lit("x"), x["l_partkey"].cast("string")).alias("value"), F.lit(None).cast("string").alias("baseInfo"), F.when(x["l_partkey"] % 3 == 1, "已上市").alias("saleStatusName")))
    items = F.array(F.struct(F.lit("line").alias("name"), first.alias("paramValues")), F.struct(F.lit("part").alias("name"), second.alias("paramValues")))
    docs = lines.select("l_orderkey", F.to_json(F.struct(F.array(F.struct(items.alias("items"))).alias("data"))).alias("payload"))
    found = X.records_by_position(docs, "l_orderkey", "payload")
    return found.select("l_orderkey", "position", "model", "status", F.col("attrs")["line"].alias("line"), F.col("attrs")["part"].alias("part"))


@query("""SELECT l_orderkey, 'flag' AS label, string_agg(l_returnflag, '|' ORDER BY n, l_returnflag) AS value FROM (SELECT l_orderkey, l_returnflag, min(l_linenumber) AS n FROM lineitem GROUP BY ALL) GROUP BY 1
UNION ALL SELECT l_orderkey, 'flag line', string_agg(CAST(l_linenumber AS VARCHAR), '|' ORDER BY l_linenumber) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) GROUP BY 1""")
def nested_properties(spark, sf_dir):
    line = F.struct(F.lit("f").alias("key"), F.col("l_returnflag").alias("text"), F.array(F.struct(F.lit("l").alias("key"), F.col("l_linenumber").cast("string").alias("text"))).alias("sub_list"))
    docs = load(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", line.alias("p")))), lambda x: x["p"])).alias("payload"))
    labels = load(spark, sf_dir, "region").where("r_regionkey < 2").select(F.when(F.col("r_regionkey") == 0, "f").otherwise("l").alias("key"), F.when(F.col("r_regionkey") == 0, "flag").otherwise("line").alias("label"))
    return X.properties(docs, "l_orderkey", "payload", labels)


@query("""SELECT c_custkey, n FROM (SELECT o_custkey AS c_custkey, CAST((count(DISTINCT o_orderkey) + 3) // 4 AS BIGINT) AS n FROM orders GROUP BY 1)""")
def id_batches(spark, sf_dir):
    ids = load(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.array_sort(F.collect_list("o_orderkey")).alias("ids"))
    return ids.select("c_custkey", F.size(X.batched(F.col("ids"), 4)).cast("long").alias("n"))


@query("""SELECT o_custkey, year, o_orderkey FROM (SELECT o_custkey, CAST(year(o_orderdate) AS INT) AS year, o_orderkey, row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderkey) AS n FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 1997) WHERE n = 1""")
def first_per_year(spark, sf_dir):
    o = load(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    return X.first_per_year(o, "o_custkey", "year", "o_orderkey", 1995, 1997).select("o_custkey", "year", "o_orderkey")


@query("""SELECT o_orderkey, concat('b', o_custkey) AS brand, o_orderstatus AS series, o_orderpriority AS model, CAST(100000 + o_orderkey % 900000 AS VARCHAR) AS price, CAST(o_orderkey % 90 AS VARCHAR) AS ratio FROM orders""")
def cells_to_record(spark, sf_dir):
    k = F.col("o_orderkey")
    cells = F.array(F.concat(F.lit("b"), F.col("o_custkey").cast("string")), F.col("o_orderstatus"), F.col("o_orderpriority"), (100000 + k % 900000).cast("string"), F.lit("12"), F.concat((k % 90).cast("string"), F.lit("%")))
    return load(spark, sf_dir, "orders").select("o_orderkey", X.cells_to_record(cells).alias("r")).select("o_orderkey", "r.*")


@query("""SELECT c_custkey FROM customer WHERE c_custkey % 4 <> 0""")
def registry_new(spark, sf_dir):
    c = load(spark, sf_dir, "customer")
    return I.unseen(c, c.where("c_custkey % 4 = 0"), "c_custkey").select("c_custkey")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'before' ELSE 'now' END AS seen_at FROM customer""")
def registry_update(spark, sf_dir):
    c = load(spark, sf_dir, "customer")
    return I.registered(c.where("c_custkey % 4 = 0").withColumn("seen_at", F.lit("before")), c.withColumn("seen_at", F.lit("now")), "c_custkey")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN upper(c_mktsegment) WHEN c_custkey % 4 = 0 THEN 'new' ELSE upper(c_mktsegment) END AS value, CASE WHEN c_custkey % 4 = 0 AND c_custkey % 3 <> 0 THEN 'refreshed' ELSE 'kept' END AS state FROM customer""")
def refresh_keeps_old(spark, sf_dir):
    c = load(spark, sf_dir, "customer").select("c_custkey", F.upper("c_mktsegment").alias("value"))
    return X.refreshed(c, c.where("c_custkey % 4 = 0 AND c_custkey % 3 <> 0").withColumn("value", F.lit("new")), "c_custkey", "value")


@query("""SELECT profile, event_id, rank FROM (SELECT concat('u', user_id) AS profile, event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS INT) AS rank FROM events) WHERE rank <= 50""")
def saved_queries(spark, sf_dir):
    e = load(spark, sf_dir, "events").withColumn("who", F.concat(F.lit("u/"), F.col("user_id").cast("string")))
    return I.saved_queries(e, "who", F.col("ts"), F.col("event_type")).select("profile", "event_id", "rank")


@query("""WITH f AS (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1) SELECT e.user_id, CAST(coalesce(n, 0) AS BIGINT) AS attempts, CASE WHEN n > 0 THEN pow(2.0, n - 1) ELSE 0.0 END AS backoff
FROM (SELECT DISTINCT user_id FROM events) e LEFT JOIN f USING (user_id) WHERE coalesce(n, 0) < 5""")
def retry_frontier(spark, sf_dir):
    e = load(spark, sf_dir, "events").select("user_id", "event_type")
    return I.frontier(e.select("user_id"), e.where("event_type = 'error'"), "user_id", 5)


@query("""WITH f AS (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1) SELECT e.user_id, CAST(coalesce(n, 0) AS BIGINT) AS attempts, CASE WHEN n > 0 THEN pow(2.0, n - 1) ELSE 0.0 END AS backoff,
CASE WHEN e.user_id % 4 = 0 THEN 'seen' WHEN coalesce(n, 0) >= 5 THEN 'exhausted' WHEN n > 0 THEN 'retry' ELSE 'waiting' END AS reason FROM (SELECT DISTINCT user_id FROM events) e LEFT JOIN f USING (user_id)""")
def frontier_states(spark, sf_dir):
    """O2."""
    e = load(spark, sf_dir, "events").select("user_id", "event_type")
    return I.frontier_states(e.select("user_id"), e.where("event_type = 'error'"), e.where("user_id % 4 = 0"), "user_id", 5)


@query("""SELECT CAST(count(*) AS BIGINT) AS items, CAST(sum(CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS done, CAST(least(20, sum(CASE WHEN c_custkey % 4 <> 0 THEN 1 ELSE 0 END)) AS BIGINT) AS next,
CASE WHEN sum(CASE WHEN c_custkey % 4 <> 0 THEN 1 ELSE 0 END) > 20 THEN 10 ELSE 0 END AS exit, true AS consistent FROM customer""")
def chunk_state(spark, sf_dir):
    """O1, O3."""
    c = load(spark, sf_dir, "customer")
    return I.chunk_state(c.where("c_custkey % 4 = 0"), c, "c_custkey", 20)


WINDOWED = """SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, event_type, CAST(count(*) AS BIGINT) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2"""


@query(WINDOWED)
def event_windows(spark, sf_dir):
    return I.windowed(load(spark, sf_dir, "events"), "ts", "1 day", "1 hour", ["event_type"], "value").withColumn("total", F.round("total", 4))


@query(WINDOWED)
def stream_incremental(spark, sf_dir):
    """The same windows after the table went through a stream, twice: the second run finds nothing new."""
    target, checkpoint = scratch(spark, "stream"), scratch(spark, "stream-state")
    schema = load(spark, sf_dir, "events").schema
    staged = scratch(spark, "stream-source")
    load(spark, sf_dir, "events").repartition(4, "event_id").write.parquet(staged)
    for _ in range(2):
        I.run_available(spark, staged, schema, target, checkpoint, lambda df: df)
    return I.windowed(spark.read.schema(schema).parquet(target), "ts", "1 day", "1 hour", ["event_type"], "value").withColumn("total", F.round("total", 4))


DAY = 86_400_000


def _slices(spark, sf_dir, rows, days=(8, 15, 22)):
    """Rows of events as files, one after another by time: what a stream reads as one micro-batch each."""
    staged, first = scratch(spark, "slices"), F.lit("2024-01-01").cast("timestamp")
    edges = [None, *[first + F.expr(f"interval {d} days") for d in days], None]
    for low, high in zip(edges[:-1], edges[1:]):
        part = rows if low is None else rows.where(F.col("ts") >= low)
        (part if high is None else part.where(F.col("ts") < high)).coalesce(1).write.mode("append").parquet(staged)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(staged)


@query(f"""WITH a AS (SELECT user_id * 8 + event_id % 8 AS item, epoch_ms(ts) AS t, event_id, event_type = 'error' AS failed FROM events WHERE event_type IN ('error', 'purchase')),
b AS (SELECT *, row_number() OVER w AS k, lag(t) OVER w AS prev, sum(CASE WHEN failed THEN 1 ELSE 0 END) OVER w AS fails FROM a WINDOW w AS (PARTITION BY item ORDER BY t, event_id)),
e AS (SELECT item, min(k) FILTER (NOT failed OR fails >= 3) AS fin FROM b GROUP BY item),
g AS (SELECT item, fin, count(*) FILTER (fin IS NULL OR k <= fin) AS attempts, count(*) FILTER (k > fin) AS repeats, max(t) AS last_at,
  count(*) FILTER (k > 1 AND (fin IS NULL OR k <= fin) AND t < prev + {2 * DAY} * pow(2, k - 2)) AS early, max(CASE WHEN k = fin AND failed THEN 1 ELSE 0 END) AS bad FROM b JOIN e USING (item) GROUP BY item, fin)
SELECT item, CAST(attempts AS INT) AS attempts, CAST(early AS INT) AS early, CAST(repeats AS INT) AS repeats, CASE WHEN fin IS NOT NULL AND bad = 1 THEN 'exhausted' WHEN fin IS NOT NULL THEN 'done'
  WHEN last_at + {2 * DAY} * pow(2, attempts - 1) < (SELECT max(t) FROM a) - 3600000 THEN 'ready' ELSE 'retry' END AS reason FROM g""")
def frontier_over_time(spark, sf_dir):
    """O2, O3: attempts stream in four micro-batches; states and ends of back-offs live from one to the next."""
    rows = load(spark, sf_dir, "events").where("event_type in ('error', 'purchase')")
    rows = rows.select("ts", "event_id", (F.col("user_id") * 8 + F.col("event_id") % 8).alias("item"), (F.col("event_type") == "error").alias("failed"))
    frontier = N.Frontier("item", "ts", "event_id", "failed", 3, 2 * DAY, 3_600_000)
    table = N.BatchTable(spark, scratch(spark, "frontier"), N.Producer("frontier", "1"))
    N.run_frontier(_slices(spark, sf_dir, rows), frontier, table, scratch(spark, "frontier-state"))
    last = table.read().groupBy("item").agg(F.max_by(F.struct("attempts", "early", "repeats", "reason"), "batch").alias("s"))
    return last.select("item", "s.*")


@query("SELECT event_type, CAST(count(*) AS BIGINT) AS n, CAST(4 AS BIGINT) AS batches FROM events GROUP BY event_type")
def resumed_batches(spark, sf_dir):
    """O3: a stream that lost its own notes brings all its batches again; the table takes each once and still is what its manifests say."""
    rows, root = load(spark, sf_dir, "events").select("ts", "event_id", "event_type"), scratch(spark, "batches")
    stream = _slices(spark, sf_dir, rows)
    for _ in range(2):
        table = N.BatchTable(spark, root, N.Producer("events", "1"))
        N.run_batches(stream, table, scratch(spark, "batches-state"), "append")
    table.verify()
    return table.read().groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).withColumn("batches", F.lit(len(list(table.log.entries()))).cast("long"))


@query("""SELECT conv_id, CAST(max(turn) AS BIGINT) AS turn, string_agg(DISTINCT role, '+' ORDER BY role) AS roles FROM conversations GROUP BY conv_id""")
def merge_progress(spark, sf_dir):
    c = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    docs = c.select(F.col("conv_id").cast("string").alias("k"), "turn", F.to_json(F.struct("turn", F.array("role").alias("roles"))).alias("d"))
    merged = U.merge_json(docs, "k", "d", "turn")
    parsed = F.from_json("d", "struct<turn: bigint, roles: array<string>>")
    return merged.select(F.col("k").cast("long").alias("conv_id"), parsed.alias("p")).select("conv_id", F.col("p.turn").alias("turn"), F.array_join(F.array_sort("p.roles"), "+").alias("roles"))


@query("""SELECT p_name AS value, CAST(count(*) AS BIGINT) AS n FROM part WHERE p_name IN (SELECT p_name FROM part WHERE p_size > 45) AND p_name IN (SELECT p_name FROM part WHERE p_size < 5) GROUP BY 1""")
def priority_names(spark, sf_dir):
    p = load(spark, sf_dir, "part")
    both = P.priority_names(p.where("p_size > 45"), p.where("p_size < 5"), "p_name")
    return p.join(both, "p_name", "left_semi").groupBy(F.col("p_name").alias("value")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH b AS (SELECT p_type, min(p_brand) AS known FROM part GROUP BY 1) SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN known ELSE p_brand END AS brand FROM part JOIN b USING (p_type)""")
def fill_brand(spark, sf_dir):
    p = load(spark, sf_dir, "part").select("p_partkey", "p_type", F.col("p_brand").alias("brand"))
    return P.fill_brand(p.withColumn("brand", F.when(F.col("p_partkey") % 3 == 0, "-").otherwise(F.col("brand"))), p, "p_type").select("p_partkey", "brand")


@query(f"""WITH s AS ({text(SPREAD)}) SELECT row_id, list_has_any(regexp_extract_all(sizes, '\\d+'), [CAST(n AS VARCHAR), '20']) AS near,
CASE WHEN n BETWEEN 20 AND 20 THEN true ELSE abs(n - 20) <= 2 OR abs(n + 7 - 20) <= 2 END AS within FROM s""")
def tolerance_overlap(spark, sf_dir):
    s = build(spark, sf_dir, SPREAD)
    return s.select("row_id", F.arrays_overlap(S.numbers(F.col("sizes")), F.array(F.col("n").cast("double"), F.lit(20.0))).alias("near"), E.overlap_within(S.numbers(F.col("sizes")), F.array(F.lit(20.0)), 2.0).alias("within"))


@query("""SELECT p_brand AS component, CAST(count(*) AS BIGINT) AS n, string_agg(DISTINCT CASE WHEN p_partkey % 3 = 0 THEN 'A' ELSE 'B' END, '+' ORDER BY CASE WHEN p_partkey % 3 = 0 THEN 'A' ELSE 'B' END) AS effective FROM part GROUP BY 1""")
def effective_sources(spark, sf_dir):
    p = load(spark, sf_dir, "part").select(F.col("p_brand").alias("component"), F.array(F.when(F.col("p_partkey") % 3 == 0, "A").otherwise("B")).alias("sources"))
    return U.effective_sources(p).groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.first(F.array_join("effective", "+")).alias("effective"))


@query("""SELECT p_brand AS component, concat('{"schema":"v1","nodes":[', string_agg(CAST(p_partkey AS VARCHAR), ',' ORDER BY p_partkey), '],"edges":[', string_agg(CASE WHEN p_partkey % 2 = 0 THEN concat('{"l":', p_partkey, ',"r":', p_partkey + 1, ',"score":1}') END, ',' ORDER BY p_partkey), ']}') AS evidence
FROM part GROUP BY 1 HAVING sum(CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END) > 0""")
def component_evidence(spark, sf_dir):
    p = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("node"), F.col("p_brand").alias("component"))
    edges = p.where("node % 2 = 0").select(F.col("node").alias("l"), (F.col("node") + 1).alias("r"), F.lit(1).alias("score"))
    return C.evidence(p.select("node", "component"), edges)


@query("""SELECT row_id, key, value FROM (SELECT p_partkey AS row_id, 'brand' AS key, p_brand AS value FROM part UNION ALL SELECT p_partkey, 'size', CAST(p_size AS VARCHAR) FROM part)""")
def hidden_columns(spark, sf_dir):
    from tributary.model import to_attrs

    p = load(spark, sf_dir, "part")
    df = p.select(F.col("p_partkey").alias("row_id"), F.col("p_brand").alias("brand"), F.col("p_size").alias("size"), F.col("p_type").alias("secret"))
    hidden = load(spark, sf_dir, "region").where("r_regionkey = 0").select(F.lit("secret").alias("key"))
    return H.without_hidden(to_attrs(df, ["brand", "size", "secret"]), hidden)


@query("""SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 2 = 0 THEN year(o_orderdate) ELSE 1985 END AS INT) AS year FROM orders""")
def two_digit_years(spark, sf_dir):
    x = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.year("o_orderdate").cast("string"), F.lit("款 x"))).otherwise(F.lit("85款"))
    return load(spark, sf_dir, "orders").select("o_orderkey", S.model_year(x).alias("year"))


@query("""SELECT DISTINCT p_type AS suffix_free FROM part""")
def stripped_series(spark, sf_dir):
    s = S.stripped_series(F.col("p_brand"), F.concat("p_brand", F.lit(" "), "p_type", F.lit(" EV")), ("PHEV", "EV"))
    return load(spark, sf_dir, "part").select(s.alias("suffix_free")).distinct()


@query("""SELECT o_orderstatus, o_orderpriority, CAST(count(*) AS BIGINT) AS n, CAST(grouping(o_orderstatus) AS INT) AS all_status FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""")
def facet_cube(spark, sf_dir):
    return load(spark, sf_dir, "orders").cube("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.grouping("o_orderstatus").cast("int").alias("all_status"))


@query("""WITH k AS (SELECT p_partkey AS row_id, p_size, p_brand, p_type FROM part WHERE 2015 + p_partkey % 10 >= 2018 AND p_size > 3)
SELECT row_id, 'size(mm)' AS name, CAST(p_size AS VARCHAR) AS value FROM k UNION ALL SELECT row_id, 'brand', p_brand FROM k""")
def publish_projection(spark, sf_dir):
    from tributary.model import to_attrs

    p = load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("row_id"), (2015 + F.col("p_partkey") % 10).alias("year"), F.col("p_size").alias("n"), F.col("p_size").alias("size[mm]"),
        F.col("p_brand").alias("品牌"), F.col("p_type").alias("secret"), F.lit("-").alias("gone"),
    )
    rows = to_attrs(p, ["size[mm]", "品牌", "secret", "gone"], drop_missing=False)
    hidden = load(spark, sf_dir, "region").where("r_regionkey = 0").select(F.lit("secret").alias("key"))
    return P.project(rows, {"品牌": "brand"}, hidden, 2018, [("small", F.col("n") > 3)])[0]


@query("""SELECT o_custkey, bool_or(o_orderstatus <> 'P' AND o_orderkey % 3 = 0) AS valid FROM orders GROUP BY 1""")
def cache_valid(spark, sf_dir):
    entry = F.struct(F.when(F.col("o_orderstatus") == "P", "-").otherwise(F.col("o_orderstatus")).alias("name"), F.year("o_orderdate").alias("year"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderkey").cast("string")).otherwise("x").alias("id"))
    return load(spark, sf_dir, "orders").groupBy("o_custkey").agg(X.valid_cache(F.collect_list(entry)).alias("valid"))
