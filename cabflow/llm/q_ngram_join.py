"""op5_ngram_join: components of documents linked by 4-word shingles at a
Jaccard similarity of 0.85.

The SQL joins all shingles with each other, which only small tables bear;
``tests/llm`` also compares with brute force."""

import string

from pyspark.sql import DataFrame, SparkSession

from cabflow.llm.common import table
from cabflow.llm.ngram_join import ngram_components


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents").select("doc_id", "text"), words=4, percent=85)


ORACLE_SQL = rf"""WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 4
      THEN list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS shingles
  FROM worded),
sized AS (SELECT doc_id, shingles, len(shingles) AS n FROM sets),
long AS (SELECT doc_id, n, unnest(shingles) AS s FROM sized),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM long a JOIN long b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (
  SELECT a, b FROM links
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id
FROM sized LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) r ON r.a = sized.doc_id"""
