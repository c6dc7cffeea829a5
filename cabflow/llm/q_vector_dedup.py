"""op10_vector_dedup: near-duplicate embeddings at a cosine of 0.95.

The SQL compares all pairs, which only small tables bear; ``tests/llm`` also
compares with brute force."""

from pyspark.sql import DataFrame, SparkSession

from cabflow.llm.common import table
from cabflow.llm.vector_dedup import near_duplicates


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), least=0.95)


ORACLE_SQL = """WITH RECURSIVE vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.vec_id < b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (
  SELECT a, b FROM links
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
found AS (SELECT a, min(b) AS m FROM reach GROUP BY a),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id,
       vec_id <= coalesce(m, vec_id) AS kept
FROM embeddings e LEFT JOIN found f ON f.a = e.vec_id LEFT JOIN counted c ON c.a = e.vec_id"""
