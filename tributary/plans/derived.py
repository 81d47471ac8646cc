"""Inputs derived from the driver tables by SQL that Spark and DuckDB both read, so that oracles can build them too."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tributary.session import load

#: What a model's name ends with, by a number.
ENDING = (
    "CASE {n} % 8 WHEN 0 THEN ' Pro' WHEN 1 THEN ' 五座' WHEN 2 THEN ' 四驱' WHEN 3 THEN ' 75kWh' WHEN 4 THEN ' 长续航' WHEN 5 THEN ' 旗舰版'"
    " WHEN 7 THEN ' 128线激光雷达' ELSE '' END"
)
KEYS = """p_partkey AS row_id, p_partkey AS ordinal, p_brand AS brand, p_type AS series, CAST(2015 + p_partkey % 10 AS INT) AS year,
  CAST(p_size % 5 AS STRING) AS level, CAST(p_size AS STRING) AS size"""

SOURCE_A = f"""
SELECT {KEYS}, 'A' AS source, concat(p_name, {ENDING.format(n="p_size")}) AS model, CASE WHEN p_size % 2 = 0 THEN '汽油' ELSE '纯电' END AS energy,
  CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS STRING) AS price,
  CASE WHEN p_partkey % 9 = 0 THEN '5座' WHEN p_partkey % 9 = 1 THEN ' 7 ' ELSE '-' END AS seats, CASE WHEN p_partkey % 4 = 0 THEN '75.0' ELSE '-' END AS battery,
  p_name AS word, p_size % 8 AS ending, '' AS extra
FROM {{part}} WHERE p_partkey % 10 <> 0"""

B_ENDING = "(p_size + CASE WHEN p_partkey % 6 = 0 THEN 1 ELSE 0 END)"
B_ENDED = ENDING.format(n=B_ENDING)
SOURCE_B = f"""
SELECT {KEYS.replace("CAST(p_size AS STRING) AS size", "CASE WHEN p_partkey % 13 = 0 THEN '-' ELSE CAST(p_size AS STRING) END AS size")}, 'B' AS source,
  CASE WHEN p_partkey % 5 = 0 THEN concat(CAST(2015 + p_partkey % 10 AS STRING), '款 ', upper(p_name), {B_ENDED})
    WHEN p_partkey % 5 = 1 THEN concat(upper(p_name), {B_ENDED}, ' neo') WHEN p_partkey % 4 = 0 THEN concat(p_name, {B_ENDED}) ELSE concat(upper(p_name), {B_ENDED}) END AS model,
  CASE WHEN p_size % 2 = 0 THEN '汽油' ELSE '纯电' END AS energy,
  CAST(CAST(p_retailprice + CASE WHEN p_partkey % 11 = 0 THEN 5 ELSE 0 END AS DECIMAL(12,2)) AS STRING) AS price,
  CASE WHEN p_partkey % 9 = 0 THEN '5' ELSE '-' END AS seats, CASE WHEN p_partkey % 8 = 0 THEN '75' ELSE '-' END AS battery,
  p_name AS word, {B_ENDING} % 8 AS ending, CASE WHEN p_partkey % 5 = 1 THEN 'neo' ELSE '' END AS extra
FROM {{part}} WHERE p_partkey % 7 <> 0"""

#: The third source: some energies are missing, ambiguous or others, some levels differ, some names are longer.
SOURCE_C = f"""
SELECT {KEYS.replace("CAST(p_size % 5 AS STRING)", "CAST((p_size + CASE WHEN p_partkey % 23 = 0 THEN 1 ELSE 0 END) % 5 AS STRING)")}, 'C' AS source,
  CASE WHEN p_partkey % 4 = 0 THEN concat(upper(p_name), {ENDING.format(n="p_size")}) WHEN p_partkey % 4 = 1 THEN concat(p_name, ' Plus', {ENDING.format(n="p_size")})
    ELSE concat(p_name, {ENDING.format(n="p_size")}) END AS model,
  CASE WHEN p_partkey % 17 = 0 THEN 'C:纯电|汽油' WHEN p_partkey % 19 = 0 THEN '' WHEN p_partkey % 29 = 0 THEN '柴油' WHEN p_size % 2 = 0 THEN '汽油车' ELSE 'A:EV' END AS energy,
  CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS STRING) AS price, '-' AS seats, '-' AS battery, p_name AS word, p_size % 8 AS ending,
  CASE WHEN p_partkey % 4 = 1 THEN 'plus' ELSE '' END AS extra
FROM {{part}} WHERE p_partkey % 3 = 0"""

#: Two price observations a part, in one text.
SPREAD = """
SELECT p_partkey AS row_id, p_partkey AS ordinal, p_brand AS brand, p_type AS series, p_name AS model,
  CAST(p_size AS INT) AS n, concat(CAST(p_size AS STRING), '|', CAST(p_size + 7 AS STRING)) AS sizes,
  CASE WHEN p_partkey % 9 = 0 THEN '-' WHEN p_partkey % 4 = 0 THEN '无' ELSE concat(CAST(p_size AS STRING), 'mm') END AS width
FROM {part}"""


def build(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return spark.sql(sql, part=load(spark, sf_dir, "part"))


def text(sql: str) -> str:
    """The same input for the oracle."""
    return sql.replace("{part}", "part").replace("AS STRING)", "AS VARCHAR)")
