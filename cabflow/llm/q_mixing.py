"""op8_mixing: documents sampled so that tokens per source, language and topic
approach their targets."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.llm.common import table
from cabflow.llm.mixing import DIMS, POWERS, ROUNDS, mix

SEED = 8


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mix(docs, seed=SEED).select("doc_id", "topic", "n_tokens", F.round("probability", 9).alias("probability"), "kept")


def _oracle() -> str:
    parts = [f"""WITH marked AS (
  SELECT doc_id, coalesce('=' || source, '') AS source, coalesce('=' || lang, '') AS lang,
    CASE WHEN contains(text, 'icense') THEN 'legal'
         WHEN contains(text, '@') OR contains(text, '://') THEN 'contact'
         WHEN contains(text, ' | ') THEN 'table' ELSE 'prose' END AS topic,
    CAST(coalesce(ceil(strlen(text) / 4.0), 0) AS BIGINT) AS n_tokens,
    CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) / 4294967296.0 AS draw
  FROM documents),
w0 AS MATERIALIZED (
  SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS tokens, CAST(sum(n_tokens) AS DOUBLE) AS weight
  FROM marked GROUP BY ALL)"""]
    for d in DIMS:
        parts.append(f"""t_{d} AS MATERIALIZED (
  SELECT {d}, pow(sum(tokens), {POWERS[d]}) / sum(pow(sum(tokens), {POWERS[d]})) OVER () AS share FROM w0 GROUP BY {d})""")
    step = 0
    for _ in range(ROUNDS):
        for d in DIMS:
            parts.append(f"""w{step + 1} AS MATERIALIZED (
  SELECT w.source, w.lang, w.topic, w.tokens,
    CASE WHEN m.now > 0 THEN w.weight * (t.share / m.now) ELSE 0 END AS weight
  FROM w{step} w JOIN (SELECT {d}, sum(weight) AS now FROM w{step} GROUP BY {d}) m USING ({d}) JOIN t_{d} t USING ({d}))""")
            step += 1
    parts.append(f"""rates AS MATERIALIZED (
  SELECT source, lang, topic, CASE WHEN tokens > 0 THEN weight / tokens ELSE 0 END AS ratio FROM w{step}),
scaled AS (
  SELECT source, lang, topic, CASE WHEN max(ratio) OVER () > 0 THEN ratio / max(ratio) OVER () ELSE 1 END AS p FROM rates)
SELECT doc_id, topic, n_tokens, round(p, 9) AS probability, draw < p AS kept
FROM marked JOIN scaled USING (source, lang, topic)""")
    return ",\n".join(parts)


ORACLE_SQL = _oracle()
