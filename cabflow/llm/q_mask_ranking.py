"""op13_mask_ranking: the ten best documents of every benchmark item."""

from pyspark.sql import DataFrame, SparkSession

from cabflow.llm.common import table
from cabflow.llm.mask_ranking import rank_documents


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


_TERMS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

ORACLE_SQL = f"""
WITH asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
texts AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents),
counted AS (SELECT r, doc_id, CAST(len(terms) AS BIGINT) AS n, terms FROM texts WHERE len(terms) > 0),
whole AS (SELECT CAST(count(*) AS BIGINT) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM counted),
held AS (SELECT r, term, CAST(count(*) AS BIGINT) AS tf
         FROM (SELECT r, unnest(terms) AS term FROM counted)
         WHERE term IN (SELECT term FROM asked) GROUP BY r, term),
weighted AS (SELECT term, CAST(floor(1000 * ln((2 * nn + 2) / (2 * df + 1))) AS BIGINT) AS w
             FROM (SELECT term, count(*) AS df FROM held GROUP BY term), whole),
scored AS (SELECT a.item_id, h.r, any_value(c.doc_id) AS doc_id,
                  CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * nn) // ll))))) AS BIGINT) AS score
           FROM asked a JOIN held h USING (term) JOIN weighted USING (term) JOIN counted c ON c.r = h.r, whole
           GROUP BY a.item_id, h.r),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
                  doc_id, score FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
