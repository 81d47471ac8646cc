"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.session import load, scratch


def op1_repair_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tributary.llm.common import vocabulary
    from tributary.llm.repair import read, write

    path = scratch(spark, "repair")
    write(load(spark, sf_dir, "documents"), path, vocabulary("byte_bpe_50k.json"))
    return read(spark, path).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op2_fingerprint_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tributary.llm.fingerprint_index import dedup

    return dedup(load(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "utf-8"), 256).alias("kept_sha256")
    )


def op3_progressive_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tributary.llm.progressive_jpeg import load_media, store

    path = scratch(spark, "jpeg")
    store(load(spark, sf_dir, "documents")).write.option("compression", "zstd").parquet(path)
    return load_media(spark.read.parquet(path)).select(
        "doc_id",
        "n_bytes",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.expr("substring(payload, length(payload) - 31, 32)")).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        F.format_string("%dx%d:%08x", "width", "height", F.crc32("rgb")).alias("feature"),
    )


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tributary.llm.exact_dedup import groups_of_copies

    return groups_of_copies(load(spark, sf_dir, "documents"))


OP4_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, CAST(count(*) AS BIGINT) AS group_size FROM d GROUP BY text)
SELECT d.doc_id, g.keep_id, g.group_size, coalesce(d.doc_id = g.keep_id, false) AS kept, sha256(d.text) AS text_sha256
FROM d JOIN g ON d.text = g.text
"""


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tributary.llm.quality import classify

    labels = load(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return classify(load(spark, sf_dir, "documents"), labels)


def op6_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tributary.llm.url_reputation import judge

    labels = load(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), F.when(F.coalesce("toxic", F.lit(0)) == 0, F.col("quality")).otherwise(0).alias("good")
    )
    return judge(load(spark, sf_dir, "pages"), labels).drop("bound")


OP6_SQL = r"""
WITH u AS (SELECT page_id, url, strpos(url, '://') AS mark FROM pages),
h AS (SELECT page_id,
  CASE WHEN mark > 0 THEN translate(regexp_extract(substr(url, mark + 3), '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
  CASE WHEN mark > 0 THEN regexp_extract(substr(url, mark + 3), '(?s)^[^/?#]*([^?#]*)', 1) ELSE '' END AS path FROM u),
r AS (SELECT *, CASE
  WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
  WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
  WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
  WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
  WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule FROM h),
l AS (SELECT doc_id AS page_id, CASE WHEN coalesce(toxic, 0) = 0 THEN quality ELSE 0 END AS good FROM labels),
hosts AS (SELECT host, string_split(host, '.')[-1] AS suffix,
   array_to_string(string_split(host, '.')[-2:], '.') AS domain, count(good) AS n, coalesce(sum(good), 0) AS k
  FROM r LEFT JOIN l USING (page_id) GROUP BY host),
t AS (SELECT (sum(k) + 1.0) / (sum(n) + 2.0) AS p0 FROM hosts),
s0 AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY suffix),
s1 AS (SELECT coalesce(1 / least(greatest((sum(CASE WHEN n > 1 THEN n * (k / n - p0) * (k / n - p0) END) / nullif(sum(CASE WHEN n > 1 THEN p0 * (1 - p0) END), 0) - 1)
   * count(CASE WHEN n > 1 THEN 1 END) / nullif(sum(CASE WHEN n > 1 THEN n - 1 END), 0), 0.001), 0.5) - 1, 10.0) AS st FROM s0, t),
sx AS (SELECT suffix, (k + p0 * st) / (n + st) AS p1 FROM s0, t, s1),
d0 AS (SELECT h.suffix, h.domain, sum(n) AS n, sum(k) AS k, min(p1) AS p1 FROM hosts h JOIN sx USING (suffix) GROUP BY h.suffix, h.domain),
d1 AS (SELECT coalesce(1 / least(greatest((sum(CASE WHEN n > 1 THEN n * (k / n - p1) * (k / n - p1) END) / nullif(sum(CASE WHEN n > 1 THEN p1 * (1 - p1) END), 0) - 1)
   * count(CASE WHEN n > 1 THEN 1 END) / nullif(sum(CASE WHEN n > 1 THEN n - 1 END), 0), 0.001), 0.5) - 1, 10.0) AS st FROM d0),
dx AS (SELECT domain, (k + p1 * st) / (n + st) AS p2 FROM d0, d1),
h0 AS (SELECT h.*, p2 FROM hosts h JOIN dx USING (domain)),
h1 AS (SELECT coalesce(1 / least(greatest((sum(CASE WHEN n > 1 THEN n * (k / n - p2) * (k / n - p2) END) / nullif(sum(CASE WHEN n > 1 THEN p2 * (1 - p2) END), 0) - 1)
   * count(CASE WHEN n > 1 THEN 1 END) / nullif(sum(CASE WHEN n > 1 THEN n - 1 END), 0), 0.001), 0.5) - 1, 10.0) AS st FROM h0),
hx AS (SELECT host, n + st AS w, (k + p2 * st) / (n + st) AS m FROM h0, h1),
b AS (SELECT host, m - 1.64 * sqrt(m * (1 - m) / (w + 1)) AS bound FROM hx)
SELECT r.page_id, r.host, r.path, r.rule,
  CASE WHEN r.rule IN ('org/', 'com/fr/') THEN 'allow' WHEN r.rule IS NOT NULL THEN 'block' WHEN b.bound >= 0.5 THEN 'allow' ELSE 'block' END AS verdict
FROM r LEFT JOIN b USING (host)
"""


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tributary.llm.common import vocabulary
    from tributary.llm.packing import pack

    return pack(load(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op8_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tributary.llm.common import vocabulary
    from tributary.llm.tree_bpe import decode, encode

    path = vocabulary("byte_bpe_50k.tiktoken")
    pattern = public_tokenizers.PATTERN
    rows = decode(encode(load(spark, sf_dir, "documents"), path, pattern), path)
    return rows.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"),
    )


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tributary.llm.jaccard_join import classes

    return classes(load(spark, sf_dir, "documents"), n=4, threshold=0.85)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tributary.llm.warc import read, write

    path = scratch(spark, "warc")
    write(load(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), "url", F.col("html").alias("payload")), path)
    return read(spark, path).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tributary.llm.whitening import whitened

    return whitened(load(spark, sf_dir, "embeddings"))


def op12_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tributary.llm.context_mixing import model_scores

    return model_scores(load(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tributary.llm.filter_audit import audit

    return audit(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


OP13_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    (CASE WHEN len(words) < 200 THEN 'A' ELSE '' END)
    || (CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END)
    || (CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 3 * length(text) THEN 'C' ELSE '' END)
    || (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END)
    || (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END) AS failed
  FROM d LEFT JOIN l USING (doc_id)),
g AS (SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, failed),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a JOIN x b ON a.x <> b.x JOIN x c ON c.x NOT IN (a.x, b.x)
  JOIN x d ON d.x NOT IN (a.x, b.x, c.x) JOIN x e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS own, substr(filter_order, 1, step - 1) AS before FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
h AS (SELECT part, filter_order, step, own, n, good, toxic, failed = own AS alone, contains(failed, own) AS hit,
    before <> '' AND regexp_matches(failed, '[' || before || '~]') AS gone FROM g, s),
r AS (SELECT part, filter_order, step, own,
    sum(CASE WHEN NOT gone AND NOT hit THEN n ELSE 0 END) AS kept, sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN hit AND gone THEN n ELSE 0 END) AS redundant, sum(CASE WHEN alone THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN hit AND NOT gone THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN hit AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
  FROM h GROUP BY part, filter_order, step, own)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM r
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {"op4_exact_dedup": OP4_SQL, "op6_url_reputation": OP6_SQL, "op13_filter_audit": OP13_SQL}
