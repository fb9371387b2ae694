"""The corpus operators over the test tables, as named queries of ``(spark, folder)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonewright.llm.common import read_table, ship_package
from zonewright.llm.extract import extract_main_text
from zonewright.llm.lines import deduplicated_lines
from zonewright.llm.mixing import mix_documents
from zonewright.llm.neardup import near_duplicates
from zonewright.llm.neighbours import nearest_by_inner_product
from zonewright.llm.packing import packed_documents
from zonewright.llm.pii import find_personal_data
from zonewright.llm.prefixes import prefix_trie
from zonewright.llm.sharding import shard_documents
from zonewright.llm.spelling import spelling_groups
from zonewright.llm.topk import exact_top_k
from zonewright.llm.toxicity import score_documents
from zonewright.llm.warc import archive

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(run):
        def shipped(spark: SparkSession, folder: str) -> DataFrame:
            ship_package(spark)
            return run(spark, folder)

        QUERIES[name] = shipped
        if oracle:
            ORACLES[name] = oracle
        return run

    return register


def vocabulary() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def crc32_sql(text: str) -> str:
    """DuckDB SQL for the unsigned crc32 of a text's UTF-8, which it lacks: four bits a step."""

    def four(value: int) -> int:
        for _ in range(4):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        return value

    table = [four(i) for i in range(16)]
    digits = f"hex(encode({text}))"
    # Low digits first; the register starts with all bits set.
    steps = (
        f"list_transform(range(length({digits})), lambda i: "
        f"instr('0123456789ABCDEF', substr({digits}, (i // 2 * 2 + 2 - i % 2)::BIGINT, 1))::BIGINT - 1)"
    )
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}), lambda c, x: xor(c >> 4, ({table}::BIGINT[])[(xor(c, x) & 15) + 1])), 4294967295)"


@query(
    "op2_warc",
    """
    SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes,
           array_to_string(list_transform(range(32), lambda i:
             substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                    ((('0x' || substr(d || '00', ((5 * i) // 4 + 1)::BIGINT, 3))::INTEGER
                      >> (7 - (5 * i) % 4)::INTEGER) & 31) + 1, 1)), '') AS payload_digest,
           CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first THEN first END AS refers_to
    FROM (SELECT page_id, h, sha1(h) AS d, min(page_id) OVER (PARTITION BY h) AS first
          FROM (SELECT page_id, coalesce(html, '') AS h FROM pages))
    """,
)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return archive(read_table(spark, folder, "pages"))[1].drop("url")


@query("op3_sharding")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return shard_documents(read_table(spark, folder, "documents"))


@query("op5_packing")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return packed_documents(read_table(spark, folder, "documents"), vocabulary())


@query(
    "op6_exact_topk",
    """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
      WHERE len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
          FROM v AS q JOIN v AS c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
    SELECT query_id, row_number() OVER w::INTEGER AS rank, vec_id, score FROM s
    WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
    QUALIFY row_number() OVER w <= 5
    """,
)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return exact_top_k(read_table(spark, folder, "embeddings"))


@query("op10_neighbours")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return nearest_by_inner_product(read_table(spark, folder, "embeddings"))


@query("op4_toxicity")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return score_documents(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


@query("op7_pii")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return find_personal_data(read_table(spark, folder, "documents"))


@query("op8_mixing")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return mix_documents(read_table(spark, folder, "documents"))


@query("op9_neardup")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(read_table(spark, folder, "documents"))


@query("op1_main_text")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return extract_main_text(read_table(spark, folder, "pages"))


@query(
    "op11_lines",
    r"""
    WITH l AS (
      SELECT doc_id, unnest(s) AS line, unnest(range(len(s))) AS pos
      FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents)),
    k AS (
      SELECT doc_id, pos, line,
             translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
    r AS (
      SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10
      GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
    j AS (SELECT k.*, coalesce(k.doc_id > r.first, false) AS gone FROM k LEFT JOIN r USING (key))
    SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
    FROM j GROUP BY doc_id
    """,
)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = deduplicated_lines(read_table(spark, folder, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


@query(
    "op12_prefixes",
    f"""
    WITH own AS (
      SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
      FROM conversations WHERE conv_id IS NOT NULL),
    convs AS (SELECT conv_id, ({crc32_sql("conv_id::VARCHAR")}) % 6 AS h FROM (SELECT DISTINCT conv_id FROM own)),
    taken AS (
      SELECT c.conv_id, 0 AS part, p, role, text FROM convs c JOIN own o ON o.conv_id = c.conv_id - c.conv_id % 100 WHERE p <= h
      UNION ALL SELECT c.conv_id, 1, p, role, text FROM convs c JOIN own o USING (conv_id) WHERE p > h),
    steps AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY part, p) AS depth FROM taken),
    told AS (
      SELECT conv_id, depth, length(text) AS chars,
             md5(string_agg(md5(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY depth)) AS node
      FROM steps
      UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
    nodes AS (
      SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(chars) AS saved
      FROM told GROUP BY node, depth),
    over AS (SELECT DISTINCT a.node, b.node AS parent FROM told a JOIN told b ON a.conv_id = b.conv_id AND a.depth = b.depth + 1),
    children AS (SELECT parent AS node, count(*) AS n_children FROM over GROUP BY parent),
    totals AS (
      SELECT t.node, count(*) FILTER (c.node IS NULL) AS n_leaves, sum(n.saved) AS saved_tokens
      FROM nodes n JOIN told t ON t.conv_id = n.conv_id AND t.depth <= n.depth LEFT JOIN children c ON c.node = n.node
      GROUP BY t.node),
    ends AS (
      SELECT node, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS sha
      FROM (SELECT node, conv_id FROM told QUALIFY depth = max(depth) OVER (PARTITION BY conv_id)) GROUP BY node)
    SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0)::BIGINT AS n_children,
           n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, coalesce(sha, sha256('')) AS ends_sha256
    FROM nodes n LEFT JOIN over USING (node) LEFT JOIN nodes p ON p.node = over.parent
    LEFT JOIN children c ON c.node = n.node JOIN totals t ON t.node = n.node LEFT JOIN ends e ON e.node = n.node
    """,
)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(read_table(spark, folder, "conversations"), opening=(100, 6))


@query(
    "op13_spelling",
    f"""
    WITH RECURSIVE runs AS (
      SELECT doc_id, w, count(*) AS c FROM (
        SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents)
      GROUP BY ALL),
    hashed AS (SELECT *, {crc32_sql("doc_id::VARCHAR || ':' || w")} AS h FROM runs),
    words AS (
      SELECT word, sum(c)::BIGINT AS n FROM (
        SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, (h % length(w))::BIGINT) || substr(w, (h % length(w) + 2)::BIGINT)
               ELSE w END AS word, c FROM hashed)
      WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
    less AS (
      SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS v
      FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
    near AS (
      SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM less a JOIN less b USING (v, i) WHERE a.word <> b.word
      UNION SELECT a.word, a.n, b.word, b.n FROM less a JOIN words b ON a.v = b.word
      UNION SELECT b.word, b.n, a.word, a.n FROM less a JOIN words b ON a.v = b.word),
    best AS (
      SELECT word, count(*) OVER (PARTITION BY word) AS n_near, near, near_n FROM near
      QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) = 1),
    forms AS (
      SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= 5 * n THEN near END AS form,
             CASE WHEN near_n >= 5 * n THEN near_n END AS form_n
      FROM words LEFT JOIN best USING (word)),
    walk AS (
      SELECT word, word AS reached, form AS next FROM forms
      UNION ALL SELECT k.word, f.word, f.form FROM walk k JOIN forms f ON k.next = f.word)
    SELECT word, form, reached AS root, n, n_near, form_n
    FROM forms JOIN (SELECT word, reached FROM walk WHERE next IS NULL) USING (word)
    """,
)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_groups(read_table(spark, folder, "documents"))
