"""Linkage records over the star-schema and document tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.functions.columns import ID_SPAN, country_label, tokens


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def part_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as a record of one of three sources, by its key: a quarter is source 1, the rest are sources 2 and 3 in turn."""
    key = F.col("p_partkey")
    source = F.when(key % 4 == 0, 1).otherwise(2 + key % 2)
    name = F.lower("p_name")
    phon = F.regexp_replace(name, "[aeiou]", "")
    second = F.split_part(name, F.lit(" "), F.lit(2))
    kind = F.lower("p_type")
    return table(spark, sf_dir, "part").select(
        source.alias("source"),
        (key + F.when(source == 1, 0).otherwise(source) * F.lit(ID_SPAN)).alias("id"),
        country_label(F.col("p_brand")).alias("country"),
        F.when(key % 7 == 0, "").otherwise(kind).alias("state"),
        name.alias("name_lc"),
        name.alias("core"),
        F.regexp_replace(name, " ", "").alias("name_key"),
        F.array(F.regexp_replace(name, " ", "")).alias("keys"),
        phon.alias("phon_key"),
        tokens(phon).alias("phon_tokens"),
        tokens(name).alias("name_tokens"),
        F.array_distinct(F.array(kind, second)).alias("addr_tokens"),
        F.col("p_size").cast("string").alias("hn"),
        F.split_part(name, F.lit(" "), F.lit(1)).alias("street"),
        F.array_distinct(F.array(second, kind)).alias("places"),
        F.array_distinct(F.array(F.col("p_size").cast("string"), (key % 10).cast("string"))).alias("numbers"),
        (key % 11 == 0).alias("name_indic"),
        (key % 7 == 0).alias("addr_missing"),
    )


def parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(query records, target records): source 1 against the others."""
    records = part_records(spark, sf_dir)
    return records.where("source = 1").drop("source"), records.where("source <> 1").drop("source")


#: The same records in SQL; the targets' and queries' parts follow by id.
PARTS = """
rec AS (
  SELECT p_partkey AS pk, CASE WHEN p_partkey % 4 = 0 THEN 1 ELSE 2 + p_partkey % 2 END AS source, p_partkey + CASE WHEN p_partkey % 4 = 0 THEN 0 ELSE (2 + p_partkey % 2) * 1000000000 END AS id,
    lower(trim(coalesce(p_brand, ''))) AS country, CASE WHEN p_partkey % 7 = 0 THEN '' ELSE lower(p_type) END AS state,
    lower(p_name) AS name_lc, replace(lower(p_name), ' ', '') AS name_key, regexp_replace(lower(p_name), '[aeiou]', '', 'g') AS phon, list_distinct([lower(p_type), split_part(lower(p_name), ' ', 2)]) AS addr,
    CAST(p_size AS VARCHAR) AS hn, split_part(lower(p_name), ' ', 1) AS street, list_distinct([split_part(lower(p_name), ' ', 2), lower(p_type)]) AS places,
    list_distinct([CAST(p_size AS VARCHAR), CAST(p_partkey % 10 AS VARCHAR)]) AS numbers, lower(concat_ws(' ', p_name, p_brand, p_type, CAST(p_size AS VARCHAR))) AS line FROM part),
q AS (SELECT * FROM rec WHERE source = 1),
t AS (SELECT * FROM rec WHERE source <> 1)"""


def part_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, line): all that a part's record says, as one text."""
    line = F.lower(F.concat_ws(" ", "p_name", "p_brand", "p_type", F.col("p_size").cast("string")))
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select((key + F.when(key % 4 == 0, 0).otherwise(2 + key % 2) * F.lit(ID_SPAN)).alias("id"), line.alias("line"))


#: What true pairs have alike.
TRUE_BY = ("country", "name_lc", "hn")


def part_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ground truth (s1, t): parts of the two sides with one brand, name and size."""
    q, t = parts(spark, sf_dir)
    by = list(TRUE_BY)
    return q.select(F.col("id").alias("s1"), *by).join(t.select(F.col("id").alias("t"), *by), by).select("s1", "t")


def truth_label() -> Column:
    """1 for a true pair, else 0, from the columns of its records, a_ and b_."""
    met = F.lit(True)
    for c in TRUE_BY:
        met &= F.coalesce(F.col(f"a_{c}") == F.col(f"b_{c}"), F.lit(False))
    return met.cast("int")


TRUTH = """
truth AS (SELECT q.id AS s1, t.id AS t FROM q JOIN t USING (country, name_lc, hn)),
universe AS (SELECT id AS s1 FROM q)"""


def entity_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, id, name): all names of customers, suppliers and parts, and the hosts of pages."""
    host = F.regexp_extract("url", r"^[a-z]+://([^/?#:]+)", 1)
    rows = [("customer", "c_custkey", F.col("c_name")), ("supplier", "s_suppkey", F.col("s_name")), ("part", "p_partkey", F.col("p_name")), ("pages", "page_id", host)]
    found = None
    for name, key, value in rows:
        one = table(spark, sf_dir, name).select(F.lit(name).alias("source"), F.col(key).cast("long").alias("id"), value.alias("name"))
        found = one if found is None else found.unionByName(one)
    return found
