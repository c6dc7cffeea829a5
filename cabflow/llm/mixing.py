"""Mixing to target weights by iterative proportional fitting (raking).

Documents fall into cells by source, language and topic.  The cells' token
weights are scaled, one margin after the other and round after round, until
the shares of sources, languages and topics are the wanted ones.  A document
is then kept with its cell's calibrated probability.  DataFrame operations
only: one aggregate over the documents, raking over the cells, one join back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabflow.llm.common import fresh, written

DIMS = ("source", "lang", "topic")
#: Rounds over the three margins.
ROUNDS = 8
#: Default targets: the share of a value is its token share to this power,
#: scaled to sum 1 (1: the share it has; 0: all values alike).
POWERS = {"source": 0.85, "lang": 0.85, "topic": 1.0}
#: Cells per partition while raking; few cells need no shuffle at all.
CELLS_PER_PARTITION = 250_000


def topic_of(text: Column) -> Column:
    """A coarse topic by what a text contains; the first that holds."""
    return (F.when(text.contains("icense"), "legal")
            .when(text.contains("@") | text.contains("://"), "contact")
            .when(text.contains(" | "), "table")
            .otherwise("prose"))


def token_weight(text: Column) -> Column:
    """Estimated tokens: a quarter of the UTF-8 bytes, rounded up (null: 0)."""
    return F.coalesce(F.ceil(F.octet_length(text) / 4), F.lit(0)).cast("long")


def draw_of(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on doc_id and seed alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def tempered_targets(cells: DataFrame, powers: dict[str, float]) -> DataFrame:
    """Cells plus share_<dim>: the token share of the cell's value in that
    dimension, raised to a power and scaled so that the values' shares sum 1."""
    out = cells
    for dim in DIMS:
        t = cells.groupBy(F.col(dim).alias("value")).agg(F.pow(F.sum("tokens").cast("double"), F.lit(powers[dim])).alias("x"))
        total = t.agg(F.sum("x")).first()[0] or 0.0  # one number
        share = t.select("value", (F.col("x") / F.lit(total) if total > 0 else F.lit(0.0)).alias(f"share_{dim}"))
        out = out.join(share, F.col(dim) == F.col("value")).drop("value")
    return out


def given_targets(cells: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """The same from tables (value, share) per dimension; values without a
    target have share 0."""
    out = cells
    for dim in DIMS:
        t = targets[dim].select(F.col("value"), F.col("share").cast("double").alias(f"share_{dim}"))
        out = out.join(t, F.col(dim) == F.col("value"), "left").drop("value").fillna(0.0, [f"share_{dim}"])
    return out


def rake(cells: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Cells (source, lang, topic, tokens, share_<dim>...) plus weight: token
    weights scaled so that the shares of each margin approach the targets.

    Cells without tokens and values with a target of 0 get weight 0; targets
    of values that have no cell count for nothing.  There are as many cells as
    combinations that occur, whatever the number of documents.
    """
    n = cells.count()
    c = cells.coalesce(max(1, -(-n // CELLS_PER_PARTITION))).withColumn("weight", F.col("tokens").cast("double"))
    for _ in range(rounds):
        for dim in DIMS:
            now = F.sum("weight").over(Window.partitionBy(dim))
            c = c.withColumn("weight", F.when(now > 0, F.col("weight") * (F.col(f"share_{dim}") / now)).otherwise(F.lit(0.0)))
    return c


def probabilities(cells: DataFrame) -> DataFrame:
    """Cells plus probability: weight per token, scaled so that the largest is
    1; the expected mix of the kept tokens is then the raked one."""
    ratio = cells.withColumn("ratio", F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(F.lit(0.0)))
    top = ratio.agg(F.max("ratio")).first()[0] or 0.0  # one number
    return ratio.select(*DIMS, (F.col("ratio") / F.lit(top) if top > 0 else F.lit(1.0)).alias("probability"))


def mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None, powers: dict[str, float] | None = None,
        seed: int = 8, names: tuple[str, ...] = ("topic", "n_tokens", "probability", "kept")) -> DataFrame:
    """All columns of docs (doc_id, text, lang, source) plus its topic, token
    weight, calibrated probability and whether it is kept.

    Defined cases: a null source or lang is a value of its own; documents
    without text weigh nothing and get probability 0, unless no document has
    any text: then all get 1; repeated rows share one fate, as the draw hangs
    on doc_id alone; an empty table gives an empty result; the names of the
    new columns must be new.
    """
    topic, tokens, prob, kept = names
    keys = {d: fresh(docs, f"mix_{d}_") for d in DIMS}
    marked = docs.withColumns({
        keys["source"]: F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")),
        keys["lang"]: F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")),
        keys["topic"]: F.coalesce(topic_of(F.col("text")), F.lit("prose")),
        tokens: token_weight(F.col("text")),
    })
    cells = written(marked.groupBy(*[F.col(keys[d]).alias(d) for d in DIMS])
                    .agg(F.sum(F.col(tokens)).alias("tokens")), "cells")
    wanted = tempered_targets(cells, POWERS if powers is None else powers) if targets is None \
        else given_targets(cells, targets)
    raked = written(rake(written(wanted, "wanted")), "raked")
    found = written(probabilities(raked).select(
        *[F.col(d).alias(keys[d]) for d in DIMS], F.col("probability").alias(prob)), "rates")
    return (marked.join(found, [keys[d] for d in DIMS], "left")
            .withColumn(topic, F.col(keys["topic"]))
            .withColumn(kept, draw_of(F.col("doc_id"), seed) < F.col(prob))
            .drop(*keys.values()))


def sample(docs: DataFrame, **how) -> DataFrame:
    """The documents the mix keeps; same columns in the same order."""
    names = tuple(fresh(docs, f"mix_{c}_out_") for c in ("topic", "tokens", "rate", "kept"))
    return mix(docs, names=names, **how).where(F.col(names[3])).select(*docs.columns)
