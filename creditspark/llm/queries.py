"""The corpus queries by name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditspark.llm import (
    html_text,
    language,
    line_dedup,
    lm_score,
    mixing,
    packing,
    prefix_trie,
    quality,
    secret_scan,
    simhash,
    spelling,
    token_counts,
    top_k,
)
from creditspark.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn

    return register


@_query("op9_simhash_near_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@_query("op1_token_counts")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"), limits=(1024,))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"), "fit_1024")


@_query("op2_best_fit_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@_query("op4_source_mixing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), repeat_limit=2.0)


@_query("op10_quality_rules")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


@_query("op8_html_extraction")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@_query("op7_line_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.remove_repeats(table(spark, sf_dir, "documents"), report=True)


@_query(
    "op3_exact_top_k",
    """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
      FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), s AS (
      SELECT q.vec_id AS query_id, c.vec_id,
             CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
      WHERE q.vec_id % 100 = 0
    ), r AS (
      SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
    )
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
    """,
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k.top_k(vectors, vectors.where("vec_id % 100 = 0"))


@_query("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@_query("op5_lm_scoring")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target is what the labels call good."""
    good = table(spark, sf_dir, "labels").where("quality = 1")
    return lm_score.cross_entropy_difference(table(spark, sf_dir, "documents"), good)


@_query("op11_spelling_variants")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


@_query(
    "op12_prefix_trie",
    """
    WITH t AS (
      SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
             md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS m,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS k
      FROM conversations WHERE conv_id IS NOT NULL
    ), bytes AS (
      SELECT DISTINCT c, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)) AS b FROM t
    ), convs AS (
      SELECT c, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda a, x: list_reduce(
               list_prepend(xor(a, x), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda y, z: xor(y >> 1, (y & 1) * 3988292384::BIGINT))), 4294967295::BIGINT) % 6 AS h
      FROM bytes
    ), rebuilt AS (
      SELECT convs.c, 0 AS own, k, m, length(text) AS size FROM convs JOIN t ON t.c = convs.c - convs.c % 100 AND k <= h
      UNION ALL SELECT convs.c, 1, k, m, length(text) FROM convs JOIN t ON t.c = convs.c AND k > h
    ), members AS (
      SELECT c, row_number() OVER w AS d, string_agg(m, '') OVER w AS p, size FROM rebuilt WINDOW w AS (PARTITION BY c ORDER BY own, k ROWS UNBOUNDED PRECEDING)
      UNION ALL SELECT c, 0, '', 0 FROM convs
    ), ending AS (
      SELECT c, max(d) AS d FROM members GROUP BY c
    ), nodes AS (
      SELECT p, d, min(c) AS conv_id, count(*) AS n, max(size) AS size, string_agg(CAST(CASE WHEN d = e THEN c END AS VARCHAR), ',' ORDER BY c) AS ends
      FROM (SELECT members.*, ending.d AS e FROM members JOIN ending USING (c)) GROUP BY p, d
    ), children AS (
      SELECT substr(p, 1, 32 * (d - 1)) AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1
    ), above AS (
      SELECT nodes.*, unnest(range(d + 1)) AS up FROM nodes
    ), below AS (
      SELECT substr(a.p, 1, 32 * a.up) AS p, count(*) FILTER (WHERE c.n IS NULL) AS leaves, sum((a.n - 1) * a.size) AS saved
      FROM above a LEFT JOIN children c ON c.p = a.p GROUP BY 1
    )
    SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(c.n, 0) AS n_children, CAST(b.leaves AS BIGINT) AS n_leaves,
           CAST(b.saved AS BIGINT) AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
    FROM nodes n JOIN below b ON b.p = n.p LEFT JOIN children c ON c.p = n.p LEFT JOIN nodes u ON n.d > 0 AND u.p = substr(n.p, 1, 32 * (n.d - 1))
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(prefix_trie.rebuilt(table(spark, sf_dir, "conversations")))


@_query("op13_secret_scans")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(table(spark, sf_dir, "documents"))
