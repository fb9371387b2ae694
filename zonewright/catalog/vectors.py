"""Vector search and text embedding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from zonewright.catalog.registry import query, table
from zonewright.functions.embedding import FeatureHashing
from zonewright.operators.dedup import keep_one
from zonewright.operators.vectors import embed_texts, top_k_of
from zonewright.plans.serving import metadata_hash, refresh_vectors as refresh, text_hash
from zonewright.session import work_folder
from zonewright.sources.store import TableStore


@query(
    "vector_topk",
    """
    WITH q AS (SELECT embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id = 0)
    SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], q.v), 6) AS score
    FROM embeddings, q ORDER BY score DESC, vec_id LIMIT 10
    """,
)
def vector_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    asked = vectors.filter("vec_id = 0")
    best = top_k_of(vectors, asked, 10, id_column="vec_id", score_digits=6)
    return best.select("vec_id", "score").orderBy(F.desc("score"), "vec_id")


@query(
    "vector_first_matches",
    """
    WITH q AS (SELECT embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id = 0),
    best AS (
      SELECT vec_id, label, round(list_cosine_similarity(embedding::DOUBLE[], q.v), 6) AS score
      FROM embeddings, q ORDER BY score DESC, vec_id LIMIT 10)
    SELECT vec_id, label FROM best ORDER BY score DESC, vec_id LIMIT 3
    """,
)
def vector_first_matches(spark: SparkSession, folder: str) -> DataFrame:
    """Metadata of the first three of the ten nearest."""
    vectors = table(spark, folder, "embeddings")
    asked = vectors.filter("vec_id = 0")
    first = top_k_of(vectors, asked, 10, id_column="vec_id", score_digits=6).filter("rank <= 3")
    return vectors.select("vec_id", "label").join(first, "vec_id").select(
        "vec_id", "label"
    )


@query(
    "vector_topk_batch",
    """
    WITH q AS (SELECT label AS query_id, embedding::DOUBLE[] AS v FROM embeddings
               QUALIFY row_number() OVER (PARTITION BY label ORDER BY vec_id) = 1),
    s AS (SELECT query_id, vec_id, round(list_cosine_similarity(embedding::DOUBLE[], q.v), 6) AS score
          FROM embeddings, q)
    SELECT query_id, vec_id, score,
           row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
    FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10
    """,
)
def vector_topk_batch(spark: SparkSession, folder: str) -> DataFrame:
    """The first vector of every label is a query."""
    vectors = table(spark, folder, "embeddings")
    leaders = keep_one(vectors, ["label"], [F.asc("vec_id")], total_order=False)
    return top_k_of(vectors, leaders, 10, id_column="vec_id", query_id="label", score_digits=6)


@query(
    "vector_topk_grid",
    """
    WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, round(list_cosine_similarity(q.v, c.v), 6) AS score
          FROM v q JOIN v c ON q.vec_id % 10 = 0)
    SELECT query_id, vec_id, score,
           row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
    FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
    """,
)
def vector_topk_grid(spark: SparkSession, folder: str) -> DataFrame:
    """Every tenth vector is a query; blocks of 16 queries meet parts of all vectors in a grid."""
    vectors = table(spark, folder, "embeddings")
    asked = vectors.filter("vec_id % 10 = 0")
    return top_k_of(vectors, asked, 5, id_column="vec_id", score_digits=6, query_rows=16)


def _crc32_sql(text: str) -> str:
    """The unsigned crc32 of a text's UTF-8 in SQL that has no such function: four bits a step."""
    table = []
    for value in range(16):
        for _ in range(4):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    digits = f"hex(encode({text}))"
    steps = (
        f"list_transform(range(length({digits})), lambda i: "
        f"instr('0123456789ABCDEF', substr({digits}, (i // 2 * 2 + 2 - i % 2)::BIGINT, 1))::BIGINT - 1)"
    )
    step = f"xor(c >> 4, ({table}::BIGINT[])[(xor(c, x) & 15) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}), lambda c, x: {step}), 4294967295)"


def _slots_sql(texts: str, seed: int = 0) -> str:
    """The slots of ``(key, text)`` rows that are not zero, by the same hash."""
    return f"""
    SELECT key, slot, (v / sqrt(sum(v * v) OVER (PARTITION BY key)))::FLOAT::DOUBLE AS weight FROM (
      SELECT key, ((code >> 1) % 64)::INTEGER AS slot, sum(((code & 1) * 2 - 1) * n)::DOUBLE AS v
      FROM (SELECT word, {_crc32_sql(f"'{seed}:' || word")} AS code FROM (SELECT DISTINCT word FROM ({_words_sql(texts)})))
      JOIN (SELECT key, word, count(*) AS n FROM ({_words_sql(texts)}) GROUP BY ALL) USING (word)
      GROUP BY ALL)
    WHERE v <> 0
    """


def _words_sql(texts: str) -> str:
    return f"""
    SELECT * FROM (SELECT key, unnest(string_split(translate(text,
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ' ')) AS word FROM {texts}) WHERE word <> ''
    """


def _slots(df: DataFrame, key: str) -> DataFrame:
    each = df.select(F.col(key).alias("key"), F.posexplode("embedding").alias("slot", "value"))
    return each.filter("value <> 0").select("key", "slot", F.col("value").cast("double").alias("weight"))


@query("embed_texts", _slots_sql("(SELECT doc_id AS key, coalesce(text, '') AS text FROM documents)"))
def embed_texts_query(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return _slots(embed_texts(documents, "doc_id", "text", FeatureHashing(64)), "doc_id")


@query(
    "refresh_vectors",
    f"""
    SELECT slots.*, p_retailprice AS price
    FROM ({_slots_sql("(SELECT p_partkey AS key, p_name || ' ' || p_type AS text FROM part WHERE p_size < 10)", 1)}
          UNION ALL {_slots_sql("(SELECT p_partkey AS key, p_name AS text FROM part WHERE p_size >= 10)")}) slots
    JOIN part ON key = p_partkey
    """,
)
def refresh_vectors_query(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as items, twice: the second time some have another text and all another price. The second
    embedder hashes otherwise, so that the vectors tell which texts it was given."""
    store = TableStore(spark, work_folder(spark, "refresh"))
    parts = table(spark, folder, "part")

    def items(text: Column, price: Column) -> DataFrame:
        found = parts.select(
            F.col("p_partkey").alias("id"), text.alias("text"), F.struct(price.alias("price")).alias("metadata")
        )
        return found.select("*", text_hash(F.col("text")), metadata_hash(F.col("metadata")))

    name, price = F.col("p_name"), F.col("p_retailprice")
    refresh(items(name, price - 1), store, FeatureHashing(64), "parts")
    renamed = F.when(F.col("p_size") < 10, F.concat_ws(" ", "p_name", "p_type")).otherwise(name)
    refresh(items(renamed, price), store, FeatureHashing(64, seed=1), "parts")
    found = store.read("parts")
    return _slots(found, "id").join(found.select(F.col("id").alias("key"), F.col("metadata.price").alias("price")), "key")
