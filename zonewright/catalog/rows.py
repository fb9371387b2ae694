"""Row-wise cleaning, typing, filtering and formatting. None of these shuffles,
but for the final sort of ``filter_range_sorted``.

Here and in the other modules, whole numbers that may be null leave a query as
doubles, so that both engines' result frames hold them in the same form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from zonewright.catalog.registry import query, table
from zonewright.functions import collections as C, scalars as S
from zonewright.operators.clean import (
    clean_entity,
    in_range,
    require_elements,
    require_filled,
    require_pattern,
    select_optional,
    tag_rejects,
)
from zonewright.operators.dedup import distinct_rows, keep_one
from zonewright.operators.export import export_rows
from zonewright.operators.metrics import quality_counts


@query(
    "clean_typed",
    """
    WITH raw AS (
      SELECT CASE WHEN p_size = 7 THEN 'x' || p_partkey ELSE p_partkey::VARCHAR END AS k,
             CASE WHEN p_brand = 'Brand#4' THEN '' ELSE p_name END AS p_name, p_type,
             CASE WHEN p_size = 9 THEN 'N/A' ELSE p_retailprice::VARCHAR END AS price
      FROM part)
    SELECT try_cast(k AS BIGINT) AS p_partkey, p_name, p_type,
           try_cast(price AS DOUBLE) AS p_retailprice
    FROM raw WHERE try_cast(k AS BIGINT) IS NOT NULL AND p_name <> ''
    """,
)
def clean_typed(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "part").select(
        F.when(F.col("p_size") == 7, F.concat(F.lit("x"), F.col("p_partkey").cast("string")))
        .otherwise(F.col("p_partkey").cast("string"))
        .alias("p_partkey"),
        F.when(F.col("p_brand") == "Brand#4", F.lit("")).otherwise(F.col("p_name")).alias("p_name"),
        "p_type",
        F.when(F.col("p_size") == 9, F.lit("N/A"))
        .otherwise(F.col("p_retailprice").cast("string"))
        .alias("p_retailprice"),
    )
    return clean_entity(
        raw,
        key="p_partkey",
        key_type="bigint",
        required_text=["p_name"],
        text=["p_type"],
        numbers=["p_retailprice"],
    )


@query(
    "clean_required_text",
    """
    SELECT o_orderkey, o_orderpriority AS priority, strftime(o_orderdate, '%Y-%m-%d') AS order_date
    FROM orders
    WHERE o_orderpriority <> '5-LOW'
      AND regexp_matches(
        CASE o_orderstatus WHEN 'P' THEN strftime(o_orderdate, '%Y/%m/%d')
                           ELSE strftime(o_orderdate, '%Y-%m-%d') END,
        '^\\d{4}-\\d{2}-\\d{2}$')
    """,
)
def clean_required_text(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(""))
        .otherwise(F.col("o_orderpriority"))
        .alias("priority"),
        F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yyyy/MM/dd"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("order_date"),
    )
    return require_pattern(require_filled(raw, ["priority"]), "order_date", S.ISO_DATE_SHAPE)


@query(
    "validate_url_or_null",
    """
    WITH raw AS (
      SELECT page_id, CASE WHEN contains(url, '/fr/') THEN regexp_replace(url, '^https?://', '')
                           ELSE url END AS url
      FROM pages)
    SELECT page_id,
           CASE WHEN regexp_matches(url, '^(https?|ftp)://[^\\s/$.?#].[^\\s]*$') THEN url END AS url
    FROM raw
    """,
)
def validate_url_or_null(spark: SparkSession, folder: str) -> DataFrame:
    url = F.when(
        F.col("url").contains("/fr/"), F.regexp_replace("url", "^https?://", "")
    ).otherwise(F.col("url"))
    return table(spark, folder, "pages").select("page_id", S.url_or_null(url).alias("url"))


@query(
    "quarantine_split",
    """
    SELECT o_orderkey, o_custkey, o_totalprice,
           CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'no status'
                WHEN o_totalprice < 1000 THEN 'price too low'
                WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'no priority' END AS reject_reason
    FROM orders
    """,
)
def quarantine_split(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "orders").withColumns(
        {
            "o_orderstatus": F.when(
                (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW"), F.lit("")
            ).otherwise(F.col("o_orderstatus")),
            "o_orderpriority": F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")),
        }
    )
    tagged = tag_rejects(
        raw,
        {
            "no status": ~S.is_filled(F.col("o_orderstatus")),
            "price too low": F.col("o_totalprice") < 1000,
            "no priority": F.col("o_orderpriority").isNull(),
        },
    )
    return tagged.select("o_orderkey", "o_custkey", "o_totalprice", "reject_reason")


@query(
    "project_optional",
    """
    SELECT c_custkey AS customer_id, c_name AS name, c_mktsegment AS segment,
           NULL::VARCHAR AS phone, NULL::DOUBLE AS loyalty
    FROM customer
    """,
)
def project_optional(spark: SparkSession, folder: str) -> DataFrame:
    return select_optional(
        table(spark, folder, "customer"),
        {
            "c_custkey": "bigint",
            "c_name": "string",
            "c_mktsegment": "string",
            "c_phone": "string",
            "c_loyalty": "double",
        },
        rename={
            "c_custkey": "customer_id",
            "c_name": "name",
            "c_mktsegment": "segment",
            "c_phone": "phone",
            "c_loyalty": "loyalty",
        },
        strict=True,
    )


@query(
    "filter_range_sorted",
    """
    SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
    WHERE o_orderdate BETWEEN DATE '1998-08-02' - 7 AND DATE '1998-08-02' AND o_orderstatus = 'O'
    ORDER BY o_totalprice DESC, o_orderkey
    """,
)
def filter_range_sorted(spark: SparkSession, folder: str) -> DataFrame:
    as_of = "1998-08-02"
    window = in_range(
        table(spark, folder, "orders"),
        "o_orderdate",
        S.window_start(as_of).cast("timestamp_ntz"),
        F.lit(as_of).cast("timestamp_ntz"),
        {"o_orderstatus": "O"},
    )
    return window.select("o_orderkey", "o_orderdate", "o_totalprice").orderBy(
        F.desc("o_totalprice"), "o_orderkey"
    )


@query(
    "skip_empty_lists",
    """
    WITH found AS (
      SELECT doc_id, [x FOR x IN string_split(text, chr(10)) IF contains(x, '@')] AS hits
      FROM documents)
    SELECT doc_id, len(hits)::BIGINT AS n_hits FROM found WHERE len(hits) > 0
    """,
)
def skip_empty_lists(spark: SparkSession, folder: str) -> DataFrame:
    hits = F.filter(F.split("text", "\n", -1), lambda line: line.contains("@"))
    found = table(spark, folder, "documents").select(
        "doc_id", C.or_empty(hits, "array<string>").alias("hits")
    )
    return require_elements(found, "hits").select(
        "doc_id", F.size("hits").cast("bigint").alias("n_hits")
    )


@query(
    "dedup_latest",
    """
    SELECT * FROM lineitem QUALIFY row_number() OVER (
      PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
               l_tax, l_returnflag, l_linestatus) = 1
    """,
)
def dedup_latest(spark: SparkSession, folder: str) -> DataFrame:
    return keep_one(
        table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], [F.desc("l_shipdate")]
    )


@query("dedup_distinct", "SELECT DISTINCT p_brand, p_type, p_size FROM part")
def dedup_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return distinct_rows(table(spark, folder, "part"), ["p_brand", "p_type", "p_size"])


@query(
    "quality_counts",
    """
    SELECT 'rows_read' AS metric, count(*) AS n FROM documents
    UNION ALL SELECT 'rows_kept', count(*) FROM documents WHERE lang = 'en' AND n_chars > 200
    UNION ALL SELECT 'lines_extracted', sum(len(string_split(text, chr(10))))::BIGINT
              FROM documents WHERE lang = 'en' AND n_chars > 200
    """,
)
def quality_counts_query(spark: SparkSession, folder: str) -> DataFrame:
    kept = (F.col("lang") == "en") & (F.col("n_chars") > 200)
    return quality_counts(
        table(spark, folder, "documents"),
        {
            "rows_read": F.count(F.lit(1)),
            "rows_kept": F.count_if(kept),
            "lines_extracted": F.sum(F.when(kept, F.size(F.split("text", "\n", -1)))),
        },
    )


@query(
    "format_amount",
    "SELECT o_orderkey, format('{:,.2f}', o_totalprice) AS amount FROM orders",
)
def format_amount(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        "o_orderkey", S.amount_text(F.col("o_totalprice")).alias("amount")
    )


@query(
    "parse_number_text",
    """
    WITH raw AS (
      SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'N/A'
        ELSE format('{:,}', (round(o_totalprice * 100)::BIGINT) * 1000) END AS votes
      FROM orders)
    SELECT o_orderkey, try_cast(replace(votes, ',', '') AS BIGINT)::DOUBLE AS votes FROM raw
    """,
)
def parse_number_text(spark: SparkSession, folder: str) -> DataFrame:
    amount = F.round(F.col("o_totalprice") * 100).cast("bigint") * 1000
    text = F.when(F.col("o_orderstatus") == "P", F.lit("N/A")).otherwise(F.format_number(amount, 0))
    return table(spark, folder, "orders").select(
        "o_orderkey", S.grouped_number(text).cast("double").alias("votes")
    )


@query(
    "export_shape",
    """
    SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id,
           CASE WHEN event_type <> 'error' THEN value END AS value
    FROM events
    """,
)
def export_shape(spark: SparkSession, folder: str) -> DataFrame:
    measured = table(spark, folder, "events").withColumn(
        "value",
        F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value")),
    )
    return export_rows(
        measured, ["event_id", "ts", "user_id", "value"], "yyyy-MM-dd HH:mm:ss.SSSSSS"
    )


@query(
    "item_text",
    """
    SELECT p_partkey::VARCHAR AS id,
           concat_ws(' - ', p_name, CASE WHEN p_size <> 7 THEN p_type END) AS text
    FROM part
    """,
)
def item_text_query(spark: SparkSession, folder: str) -> DataFrame:
    overview = F.when(F.col("p_size") != 7, F.col("p_type"))
    return table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        S.item_text(F.col("p_name"), overview).alias("text"),
    )
