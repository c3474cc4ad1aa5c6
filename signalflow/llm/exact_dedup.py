"""Exact duplicates by progressive refinement: length, then hash of a prefix, then hash of the whole text."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalflow.llm.common import whole_rows
from signalflow.session import written

PREFIX_CHARS = 256
# Fixed size of the table of (length, prefix) hashes that occur more than once; one bit each.
TABLE_BITS = 1 << 18
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z in lower case and everything else as it is; NULL counts as empty."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def _length(text: str) -> Column:
    return F.octet_length(F.coalesce(F.col(text), F.lit("")))


def _prefix(text: str) -> Column:
    return F.xxhash64(F.translate(F.substring(F.coalesce(F.col(text), F.lit("")), 1, PREFIX_CHARS), _UPPER, _LOWER))


def _shared_slots(docs: DataFrame, text: str) -> Column:
    """Bit table of the slots of all (length, prefix) pairs that two rows or more have.

    Both refinements are exact sums over narrow rows with map-side combine: lengths that occur once
    are dropped, then prefixes that occur once within their length. Only the outcome is folded into a
    table of fixed size, which lets the next scan leave out full hashes without a shuffle of texts.
    Groups that happen to share a slot cost hashes that were not needed and change no result.
    """
    sums = docs.select(_length(text).alias("length"), _prefix(text).alias("prefix")).groupBy("length", "prefix").agg(F.count("*").alias("n"))
    slot = F.pmod(F.xxhash64("length", "prefix"), F.lit(TABLE_BITS))
    shared = sums.filter("n > 1").select(slot.alias("slot"))
    words = shared.groupBy(F.expr("slot div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("bits"))
    table = [0] * (TABLE_BITS // 64)
    for word, bits in words.collect():  # at most TABLE_BITS / 64 rows, whatever the input
        table[word] = bits
    return F.from_json(F.lit(json.dumps(table)), "array<bigint>")


def refine(docs: DataFrame, id_col: str = "doc_id", text: str = "text", carry: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``keep_id``, ``group_size``, ``kept`` and the ``carry`` columns.

    Two texts are equal when they are identical after lower-casing A-Z; NULL counts as empty. The row
    with the largest id stays, of rows with the same id and text exactly one; a NULL id is below all
    others. The full content is hashed only where length and prefix hash have a partner. Rows are
    narrow from the scan on; a group of any size is summed before it is shuffled.
    """
    slot = F.pmod(F.xxhash64(_length(text), _prefix(text)), F.lit(TABLE_BITS))
    word = F.element_at(_shared_slots(docs, text), (F.floor(slot / 64) + 1).cast("int"))
    alike = F.getbit(word, F.pmod(slot, F.lit(64)).cast("int")) == 1
    extra = {f"carry_{n}": c for n, c in (carry or {}).items()}
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.when(alike, F.sha2(lower_ascii(F.col(text)), 256)).alias("digest"),
        _length(text).alias("length"),
        *[c.alias(n) for n, c in extra.items()],
    )
    rows = written(rows, "exact")
    out = ["id", "keep_id", "group_size", "kept", *[F.col(n).alias(n.removeprefix("carry_")) for n in extra]]
    alone = rows.filter("digest IS NULL").withColumns({"keep_id": F.col("id"), "group_size": F.lit(1).cast("long"), "kept": F.lit(True)})
    again = rows.filter("digest IS NOT NULL")
    groups = again.groupBy("digest", "length").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
    each = again.join(groups, ["digest", "length"])
    heads = F.col("id").eqNullSafe(F.col("keep_id"))
    others = each.filter(~heads).withColumn("kept", F.lit(False))
    # rows that have the kept id: one of them stays
    head = each.filter(heads).groupBy("digest", "id", "keep_id", "group_size", *extra).agg(F.count("*").alias("copies"))
    head = head.withColumn("kept", F.explode(F.transform(F.sequence(F.lit(1), F.col("copies").cast("int")), lambda i: i == 1)))
    return alone.select(*out).union(others.select(*out)).union(head.select(*out))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever their names; the rules are those of :func:`refine`.

    Only rows whose length and prefix have a partner are hashed whole and shuffled, by id and hash; the others
    pass through the scan. Of rows with the same id and text the least by all columns stays.
    """
    slot = F.pmod(F.xxhash64(_length(text), _prefix(text)), F.lit(TABLE_BITS))
    word = F.element_at(_shared_slots(docs, text), (F.floor(slot / 64) + 1).cast("int"))
    alike = F.getbit(word, F.pmod(slot, F.lit(64)).cast("int")) == 1
    rows = docs.select(whole_rows(docs), F.col(f"`{id_col}`").alias("id"), F.when(alike, F.sha2(lower_ascii(F.col(f"`{text}`")), 256)).alias("digest"))
    again = rows.filter("digest IS NOT NULL")
    known = written(again.select("id", "digest"), "exact-known")
    groups = known.groupBy("digest").agg(F.max("id").alias("keep_id"), F.count("*").alias("n")).filter("n > 1")
    each = written(known.join(groups, "digest").groupBy("id", "digest", "keep_id").agg(F.count("*").alias("copies")), "exact-each")
    heads = F.col("id").eqNullSafe(F.col("keep_id"))
    gone = each.filter(~heads).select(F.col("id").alias("gone_id"), F.col("digest").alias("gone_digest"))
    same = F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("digest") == F.col("gone_digest"))
    stay = again.join(gone, same, "left_anti")
    alone = rows.filter("digest IS NULL").select("row.*")
    repeated = each.filter(heads & (F.col("copies") > 1)).select(F.col("id").alias("gone_id"), F.col("digest").alias("gone_digest"))
    if repeated.isEmpty():
        return alone.union(stay.select("row.*"))
    one = stay.join(repeated, same, "left_semi").groupBy("id", "digest").agg(F.min("row").alias("row"))
    return alone.union(stay.join(repeated, same, "left_anti").select("row.*")).union(one.select("row.*"))


def exact_classes(docs: DataFrame) -> DataFrame:
    """The digest form of :func:`refine` for ``documents``."""
    rows = refine(docs, carry={"text_sha256": F.sha2(lower_ascii(F.col("text")), 256)})
    return rows.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


SQL = """
    WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
    FROM t WINDOW w AS (PARTITION BY text_sha256)
"""
