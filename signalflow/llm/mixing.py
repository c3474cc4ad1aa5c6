"""Mixing sources to target weights by budgets that flow down a tree.

A token budget is split at every node of the tree domain - language - source by the children's
weights. A child that holds less than its share gives what it has, and the rest goes to its siblings
by their weights; only what a whole subtree lacks rises to the next level. A leaf then delivers its
documents in the order of seeded epochs until its budget is used: whole passes first, then a prefix
of the next pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalflow.llm.common import WORD, whole_rows
from signalflow.session import written

LEVELS = ("domain", "lang", "source")
# Targets of the registered query: relative weights, whole numbers up to 1,000; anything not named weighs 1.
WEIGHTS = {"domain": {"web": 4, "books": 3, "code": 2, "talk": 1}, "lang": {"en": 5, "de": 2, "fr": 2, "es": 1}, "source": {}}
# Sources src0-4, 5-9, 10-14 and 15-19 of the test tables.
DOMAIN_SQL = (
    "CASE CAST(floor(try_cast(regexp_extract(source, '([0-9]+)$', 1) AS int) / 5) AS int) "
    "WHEN 0 THEN 'web' WHEN 1 THEN 'books' WHEN 2 THEN 'code' WHEN 3 THEN 'talk' ELSE 'other' END"
)
SEED = 11
# Hex digits of the order hash that make a bin of a leaf.
BIN_DIGITS = 3


def _weight(level: str, weights: Mapping[str, Mapping[str, int]]) -> Column:
    out = F.lit(1).cast("long")
    for name, weight in weights.get(level, {}).items():
        out = F.when(F.col(level) == name, F.lit(weight).cast("long")).otherwise(out)
    return out


def budgets(leaves: DataFrame, total: int, epochs: int, levels: Sequence[str], weights: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """``leaves`` (the levels and ``supply``, tokens) with the leaf's ``budget``.

    Going down, each level's children are ordered by capacity per weight; those that can't fill their
    share are full, the others split what is left. Shares are rounded down, so a split may leave up
    to one token per child. A weight of 0 takes nothing. One row per leaf, never one per document.
    """
    current = leaves.withColumn("capacity", F.col("supply") * epochs).withColumn("budget", F.lit(total).cast("long"))
    for depth, level in enumerate(levels):
        parent = list(levels[:depth])
        children = current.groupBy(*parent, level).agg(F.sum("capacity").alias("cap"), F.first("budget").alias("given"))
        children = children.withColumn("w", _weight(level, weights)).withColumn("cap", F.when(F.col("w") > 0, F.col("cap")).otherwise(F.lit(0).cast("long")))
        order = Window.partitionBy(*(parent or [F.lit(0)])).orderBy(F.col("w") == 0, F.col("cap") / F.greatest("w", F.lit(1)), level)
        children = children.withColumn("before", F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap"))
        children = children.withColumn("w_rest", F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)))
        children = children.withColumn("full", F.col("cap") * F.col("w_rest") <= (F.col("given") - F.col("before")) * F.col("w"))
        group = Window.partitionBy(*(parent or [F.lit(0)]))
        left = F.col("given") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(group)
        open_weight = F.sum(F.when(F.col("full"), 0).otherwise(F.col("w"))).over(group)
        share = F.when(F.col("full"), F.col("cap")).otherwise(F.expr("(left_over * w) div greatest(open_weight, 1)"))
        children = children.withColumn("left_over", left).withColumn("open_weight", open_weight).withColumn("share", share)
        current = current.drop("budget").join(children.select(*parent, level, F.col("share").alias("budget")), [*parent, level])
    return current.drop("capacity")


def mix(
    rows: DataFrame, share: float, epochs: int, levels: Sequence[str] = LEVELS, weights: Mapping[str, Mapping[str, int]] = WEIGHTS, seed: int = SEED
) -> DataFrame:
    """``rows`` with ``copies``, how often the document is delivered (0: not at all).

    ``rows`` holds ``id``, ``content`` (a hash of the text), ``tokens`` and the levels, and is read
    several times. The budget is ``share`` of all tokens, ``epochs`` the most passes over a leaf. The
    order of a pass is a hash of seed, pass, id and content. To cut a leaf without sorting it, its
    tokens are summed by bins of that order; only the documents of the one bin in which the budget ends
    are sorted. No document is dropped or capped to get there; whatever a leaf's share of the rows, it
    is summed before it is shuffled.
    """
    keys = list(levels)
    leaves = rows.groupBy(*keys).agg(F.sum("tokens").alias("supply"))
    leaves = written(leaves, "mix-leaves")
    total = int((leaves.agg(F.sum("supply")).first()[0] or 0) * share)
    plan = budgets(leaves, total, epochs, levels, weights)
    plan = plan.withColumn("passes", F.when(F.col("supply") > 0, F.expr("budget div greatest(supply, 1)")).otherwise(F.lit(0).cast("long")))
    plan = plan.withColumn("rest", F.col("budget") - F.col("passes") * F.col("supply")).select(*keys, "passes", "rest")
    plan = written(plan, "mix-plan")
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("passes").cast("string"), F.col("id").cast("string"), F.col("content")).cast("binary"))
    placed = rows.join(plan, keys).withColumn("order", order).withColumn("bin", F.substring("order", 1, BIN_DIGITS))
    placed = written(placed, "mix-order")
    bins = placed.groupBy(*keys, "bin").agg(F.sum("tokens").alias("in_bin"), F.first("rest").alias("rest"))
    so_far = F.sum("in_bin").over(Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    bins = bins.withColumn("so_far", so_far)
    # the first bin of a leaf that goes beyond what is left
    cuts = bins.filter("so_far > rest").groupBy(*keys).agg(F.min(F.struct("bin", (F.col("so_far") - F.col("in_bin")).alias("before"))).alias("cut"))
    cuts = written(cuts.select(*keys, "cut.bin", "cut.before").withColumnRenamed("bin", "cut_bin"), "mix-cuts")
    marked = placed.join(cuts, keys, "left")
    whole = marked.filter("cut_bin IS NULL OR bin <> cut_bin")
    whole = whole.withColumn("taken", F.coalesce(F.col("bin") < F.col("cut_bin"), F.lit(True)))
    edge = marked.filter("bin = cut_bin")
    running = F.sum("tokens").over(Window.partitionBy(*keys).orderBy("order", "id", "tokens").rowsBetween(Window.unboundedPreceding, 0))
    edge = edge.withColumn("taken", F.col("before") + running <= F.col("rest"))
    both = whole.unionByName(edge)
    return both.withColumn("copies", (F.col("passes") + F.col("taken").cast("long")).cast("long")).select(*rows.columns, "copies")


def narrow_rows(docs: DataFrame, tokens: Column | None = None) -> DataFrame:
    """What :func:`mix` reads of ``documents``; a NULL language or source is the leaf of that name without letters.

    ``tokens`` defaults to the number of words. A NULL text has none.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    counted = F.regexp_count(text, F.lit(WORD)) if tokens is None else tokens
    return docs.select(
        F.col("doc_id").alias("id"),
        F.md5(text.cast("binary")).alias("content"),
        counted.cast("long").alias("tokens"),
        F.expr(DOMAIN_SQL).alias("domain"),
        F.coalesce("lang", F.lit("")).alias("lang"),
        F.coalesce("source", F.lit("")).alias("source"),
    )


def mixed_documents(docs: DataFrame, share: float, epochs: int) -> DataFrame:
    """Leaf, tokens and copies of every document."""
    mixed = mix(written(narrow_rows(docs), "mix-rows"), share, epochs)
    return mixed.select(F.col("id").alias("doc_id"), "domain", "lang", "source", F.col("tokens").alias("n_tokens"), "copies")


def deliver(docs: DataFrame, share: float, epochs: int) -> DataFrame:
    """The documents of the mixture with their own columns, each as often as it is delivered."""
    mixed = mix(written(narrow_rows(docs), "mix-rows"), share, epochs).filter("copies > 0")
    # equal rows of one id and text are told apart by nothing: their copies are added up
    chosen = mixed.groupBy("id", "content").agg(F.sum("copies").alias("copies")).withColumnsRenamed({"id": "chosen_id", "content": "chosen_content"})
    rows = docs.select(whole_rows(docs), F.col("doc_id").alias("id"), F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("content"))
    if not docs.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        rows = rows.groupBy("id", "content").agg(F.min("row").alias("row"))
    hit = rows.join(chosen, F.col("id").eqNullSafe(F.col("chosen_id")) & (F.col("content") == F.col("chosen_content")))
    return hit.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")).select("row.*")


def _level_sql(source: str, parent: str, level: str, name: str) -> str:
    """One level of :func:`budgets` over the table ``source``."""
    keys = [k for k in parent.split(",") if k]
    by = f"PARTITION BY {parent}" if keys else ""
    out = ", ".join([*keys, level])
    weight = "CASE " + " ".join(f"WHEN {level} = '{n}' THEN {w}" for n, w in WEIGHTS[level].items()) + " ELSE 1 END" if WEIGHTS[level] else "1"
    return f"""
    {name}_a AS (SELECT {out}, CAST(sum(capacity) AS BIGINT) AS cap, any_value(budget) AS given, {weight} AS w FROM {source} GROUP BY {out}),
    {name}_b AS (SELECT *, sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - cap AS before,
                 sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_rest
                 FROM {name}_a WINDOW o AS ({by} ORDER BY cap / w, {level})),
    {name}_c AS (SELECT *, cap * w_rest <= (given - before) * w AS isfull FROM {name}_b),
    {name}_d AS (SELECT *, given - sum(CASE WHEN isfull THEN cap ELSE 0 END) OVER g AS left_over,
                 sum(CASE WHEN isfull THEN 0 ELSE w END) OVER g AS open_weight FROM {name}_c WINDOW g AS ({by})),
    {name}_s AS (SELECT {out}, CASE WHEN isfull THEN cap ELSE (left_over * w) // greatest(open_weight, 1) END AS budget FROM {name}_d),
    {name} AS (SELECT p.* EXCLUDE (budget), CAST(s.budget AS BIGINT) AS budget FROM {source} p JOIN {name}_s s USING ({out}))"""


def oracle(share: float, epochs: int) -> str:
    return f"""
    WITH t AS (SELECT doc_id, md5(coalesce(text, '')) AS content, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS n_tokens,
               {DOMAIN_SQL} AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
    l0 AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS supply, CAST(sum(n_tokens) AS BIGINT) * {epochs} AS capacity,
           (SELECT CAST(floor(sum(n_tokens) * {share}) AS BIGINT) FROM t) AS budget FROM t GROUP BY ALL),
    {_level_sql("l0", "", "domain", "l1")},
    {_level_sql("l1", "domain", "lang", "l2")},
    {_level_sql("l2", "domain,lang", "source", "l3")},
    p AS (SELECT domain, lang, source, CASE WHEN supply > 0 THEN budget // supply ELSE 0 END AS passes, budget, supply FROM l3),
    r AS (SELECT t.*, passes, budget - passes * supply AS rest,
          md5(concat_ws(':', '{SEED}', CAST(passes AS VARCHAR), CAST(doc_id AS VARCHAR), content)) AS ord
          FROM t JOIN p USING (domain, lang, source)),
    c AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY ord, doc_id, n_tokens ROWS UNBOUNDED PRECEDING) AS cum FROM r)
    SELECT doc_id, domain, lang, source, n_tokens, CAST(passes + CASE WHEN cum <= rest THEN 1 ELSE 0 END AS BIGINT) AS copies FROM c
    """
