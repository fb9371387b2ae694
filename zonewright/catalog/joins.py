"""Lookup and enrichment joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from zonewright.catalog.registry import query, table
from zonewright.functions import scalars as S
from zonewright.operators.enrich import dictionary_lookup, lookup_join, override_join


@query(
    "enrich_left",
    """
    SELECT doc_id, source, lang, quality::DOUBLE AS quality, toxic::DOUBLE AS toxic
    FROM documents LEFT JOIN labels USING (doc_id)
    """,
)
def enrich_left(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "source", "lang")
    labels = table(spark, folder, "labels")
    return lookup_join(documents, labels, ["doc_id"]).withColumns(
        {name: F.col(name).cast("double") for name in ("quality", "toxic")}
    )


@query(
    "enrich_left_project",
    """
    SELECT l_orderkey, l_linenumber, l_extendedprice, s_name, s_nationkey
    FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
    """,
)
def enrich_left_project(spark: SparkSession, folder: str) -> DataFrame:
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_nationkey"
    )
    rows = lookup_join(table(spark, folder, "lineitem"), suppliers, ["l_suppkey"])
    return rows.select("l_orderkey", "l_linenumber", "l_extendedprice", "s_name", "s_nationkey")


@query(
    "lookup_inner",
    """
    SELECT o_orderkey, o_custkey AS customer_id, c_name AS name, c_nationkey AS nation
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE o_orderstatus <> 'P' AND c_mktsegment <> 'MACHINERY'
    """,
)
def lookup_inner(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with a usable customer id, looked up in customer responses whose ids
    come as a nested struct; responses without an id are no match."""
    responses = table(spark, folder, "customer").select(
        F.struct(
            F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_custkey")).alias("customer"),
            F.col("c_nationkey").alias("nation"),
        ).alias("ids"),
        F.col("c_name").alias("name"),
    )
    flat = responses.select(
        F.col("ids.customer").alias("customer_id"), "name", F.col("ids.nation").alias("nation")
    )
    wanted = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("customer_id"),
    )
    rows = lookup_join(wanted.dropna(subset=["customer_id"]), flat, ["customer_id"], "inner")
    return rows.select("o_orderkey", "customer_id", "name", "nation")


@query(
    "lookup_fallback",
    """
    WITH asked AS (
      SELECT page_id, coalesce(nullif(regexp_extract(url, '[?&]ref=([^&#]+)', 1), ''),
                               nullif(regexp_extract(url, '[?&]page=([^&#]+)', 1), ''),
                               page_id::VARCHAR) AS asked_id
      FROM pages)
    SELECT page_id, asked_id, 'https://www.youtube.com/watch?v=' || asked_id AS link,
           lang, source
    FROM asked LEFT JOIN documents ON asked_id = doc_id::VARCHAR
    """,
)
def lookup_fallback(spark: SparkSession, folder: str) -> DataFrame:
    url = F.col("url")
    asked = table(spark, folder, "pages").select(
        "page_id",
        F.coalesce(
            S.url_parameter(url, "ref"),
            S.url_parameter(url, "page"),
            F.col("page_id").cast("string"),
        ).alias("asked_id"),
    )
    documents = table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("asked_id"), "lang", "source"
    )
    return lookup_join(asked, documents, ["asked_id"]).select(
        "page_id", "asked_id", S.video_url(F.col("asked_id")).alias("link"), "lang", "source"
    )


@query(
    "enrich_override",
    """
    SELECT c_custkey, c_mktsegment, s_nationkey::DOUBLE AS nation,
           CASE WHEN s_suppkey IS NOT NULL THEN nullif(s_name, 'Supplier#000000003') ELSE c_name END
             AS name,
           CASE WHEN s_suppkey IS NOT NULL THEN CASE WHEN s_acctbal > 0 THEN s_acctbal END
                ELSE c_acctbal END AS balance
    FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey
    """,
)
def enrich_override(spark: SparkSession, folder: str) -> DataFrame:
    base = table(spark, folder, "customer").select(
        "c_custkey", F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), "c_mktsegment"
    )
    detail = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("c_custkey"),
        F.nullif(F.col("s_name"), F.lit("Supplier#000000003")).alias("name"),
        F.when(F.col("s_acctbal") > 0, F.col("s_acctbal")).alias("balance"),
        F.col("s_nationkey").cast("double").alias("nation"),
    )
    return override_join(base, detail, ["c_custkey"]).select(
        "c_custkey", "name", "balance", "c_mktsegment", "nation"
    )


_NATIONS_SQL = """
    SELECT c_custkey, coalesce((SELECT string_agg(n_name, '|' ORDER BY n_nationkey) FROM nation
      WHERE n_nationkey IN (c_nationkey, c_custkey % 40)), '') AS nations
    FROM customer
"""


@query("dictionary_lookup", _NATIONS_SQL)
def dictionary_lookup_query(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select(
        "c_custkey",
        F.array("c_nationkey", (F.col("c_custkey") % 40).cast("int")).alias("nation_ids"),
    )
    nations = table(spark, folder, "nation")
    named = dictionary_lookup(
        customers, "nation_ids", nations, "n_nationkey", "n_name", "names", row_key=["c_custkey"]
    )
    return named.select("c_custkey", F.array_join("names", "|").alias("nations"))


@query(
    "dictionary_lookup_joined",
    """
    SELECT CASE WHEN o_orderkey <> 14 THEN o_orderkey END::DOUBLE AS k,
           coalesce((SELECT string_agg(p_name, '|' ORDER BY p_partkey) FROM part
             WHERE p_partkey IN (o_custkey, o_orderkey % 3000)), '') AS parts
    FROM orders
    """,
)
def dictionary_lookup_joined(spark: SparkSession, folder: str) -> DataFrame:
    """A larger dictionary, and one row whose key is null."""
    asked = table(spark, folder, "orders").select(
        F.when(F.col("o_orderkey") != 14, F.col("o_orderkey")).alias("k"),
        F.array("o_custkey", F.col("o_orderkey") % 3000).alias("part_ids"),
    )
    named = dictionary_lookup(
        asked, "part_ids", table(spark, folder, "part"), "p_partkey", "p_name", "names", row_key=["k"]
    )
    return named.select(
        F.col("k").cast("double").alias("k"), F.array_join("names", "|").alias("parts")
    )
