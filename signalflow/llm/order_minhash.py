"""Near-duplicate documents by Order MinHash, verified by banded alignment.

Each text is a sequence of word shingles; equal shingles are told apart by how often they came before.
A sketch takes the few shingles with the smallest hashes and keeps them in text order, so two texts
share it with a probability that follows their edit similarity. Texts that share a sketch are
candidates. A candidate pair is a link when an alignment of the two shingle sequences matches enough:
matched / (all of both - matched) >= 0.8.

Equal texts are one node. The members of a bucket are compared with a pivot, the member whose sketches
are shared most: in a family of copies that is the text they were made from, or a copy close to it. In
further rounds the buckets whose members don't all lie in one component get their next pivots, as long as
that pays: until fewer than one in 200 of the pairs of a round are links. The work of a round is linear in
the members, however large a family is. Of the pairs that are left then those that can't be links are
excluded exactly, by the shingles that both texts hold, and all others are aligned.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, LongType, StructField

from signalflow.llm.common import components, map_batches, whole_rows
from signalflow.session import written

SHINGLE = 5
SIMILARITY = 0.8
# Sketches per text, and shingles in each. Texts at the threshold share a sketch with a probability of
# about 0.5, so that 16 sketches miss one such pair in 65,000.
SKETCHES, PICKED = 16, 3
# Rounds of pivots go on while at least this share of the pairs they compare are links, then the rest of the pairs is
# taken at once. Exclusions of texts go on while they drop at least this share of them. Neither changes the outcome.
LEAST_YIELD = 0.005
LEAST_DROP = 0.05
SEED = 0x5EED

_WORD = re.compile(r"\w+")
# Word hashes a worker keeps while it works on a partition, of words up to so many characters: some 20 MB.
_KEPT_WORDS, _KEPT_LENGTH = 150_000, 40
_word_hash: dict[str, int] = {}


def _forget() -> None:
    _word_hash.clear()


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters, digits and underscores."""
    return _WORD.findall(text.lower()) if text else []


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (the SplitMix64 constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(words: list[str]) -> np.ndarray:
    """64-bit hashes of the word shingles in text order; a shorter text is one shingle."""
    if not words:
        return np.zeros(0, np.uint64)
    hashes = []
    for w in words:
        h = _word_hash.get(w)
        if h is None:
            h = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
            if len(w) <= _KEPT_LENGTH:
                if len(_word_hash) >= _KEPT_WORDS:
                    _word_hash.clear()
                _word_hash[w] = h
        hashes.append(h)
    w = np.array(hashes, np.uint64)
    size = min(SHINGLE, len(w))
    out = np.zeros(len(w) - size + 1, np.uint64)
    for i in range(size):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + w[i : len(w) - size + 1 + i])
    return out


def _labelled(s: np.ndarray) -> np.ndarray:
    """Hashes in which equal shingles differ by the number of earlier ones."""
    order = np.argsort(s, kind="stable")
    ranked = s[order]
    new = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    if new.all():
        return s
    index = np.arange(len(s))
    earlier = np.empty(len(s), np.uint64)
    earlier[order] = index - np.maximum.accumulate(np.where(new, index, 0))
    # the first of equal shingles is labelled as in a text that holds it once
    return np.where(earlier == 0, s, _mix(s + earlier * np.uint64(0xD6E8FEB86659FD93)))


_SEEDS = _mix(np.arange(1, SKETCHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(SEED))


def sketch(words: list[str]) -> list[int]:
    """Signed 64-bit values of the sketches; none for a text without words."""
    s = shingles(words)
    if not len(s):
        return []
    s = _labelled(s)
    hashed = _mix(s[None, :] ^ _SEEDS[:, None])
    if len(s) > PICKED:
        picked = np.sort(np.argpartition(hashed, PICKED - 1, axis=1)[:, :PICKED], axis=1)
    else:
        picked = np.tile(np.arange(len(s)), (SKETCHES, 1))
    out = _SEEDS.copy()
    for i in range(picked.shape[1]):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + s[picked[:, i]])
    return out.view(np.int64).tolist()


def aligned(x: np.ndarray, y: np.ndarray, band: int) -> int:
    """Matches in the best alignment of two sequences that stays within ``band`` of the diagonal.

    Common ends are matched first. Between them the row of the alignment matrix is kept as the bits of
    one integer, zero where the number of matches rises, and moved on with an addition per element.
    """
    low = min(len(x), len(y))
    differ = np.flatnonzero(x[:low] != y[:low])
    head = int(differ[0]) if len(differ) else low
    low -= head
    differ = np.flatnonzero(x[len(x) - low :][::-1] != y[len(y) - low :][::-1])
    tail = int(differ[0]) if len(differ) else low
    x, y = x[head : len(x) - tail].tolist(), y[head : len(y) - tail].tolist()
    if not x or not y:
        return head + tail
    places: dict[int, list[int]] = {}
    for j, value in enumerate(y):
        places.setdefault(value, []).append(j)
    row = full = (1 << len(y)) - 1
    for i, value in enumerate(x):
        found = [j for j in places.get(value, ()) if -band <= j - i <= band]
        if found:
            bits = 0
            for j in found:
                bits |= 1 << j
            hit = row & bits
            row = ((row + hit) | (row - hit)) & full
    return head + tail + len(y) - row.bit_count()


def similar(a: str, b: str, threshold: float = SIMILARITY) -> bool:
    """Whether the shingle sequences of two texts align to at least the threshold."""
    x, y = shingles(words_of(a)), shingles(words_of(b))
    total = len(x) + len(y)
    # of sequences that reach the threshold at most this many elements stay unmatched, so no match is further off
    band = int(total * (1 - threshold) / (1 + threshold) + 1e-9)
    if not total or abs(len(x) - len(y)) > band:
        return False
    matched = aligned(x, y, band)
    return matched >= threshold * (total - matched) - 1e-9


def sketches(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """``(id, content, node, size, sketches)``: content is a hash of the text, node one of its words (NULL: none)."""

    def compute(batch):
        out = {"node": [], "size": [], "sketches": []}
        for text in batch.column("text").to_pylist():
            words = words_of(text)
            out["node"].append(xxhash.xxh128_digest(" ".join(words).encode()) if words else None)
            out["size"].append(max(len(words) - SHINGLE + 1, min(len(words), 1)))
            out["sketches"].append(sketch(words))
        return out

    fields = [StructField("node", BinaryType()), StructField("size", LongType()), StructField("sketches", ArrayType(LongType()))]
    return map_batches(_rows(docs, id_col, text), compute, fields, _forget).drop("text")


def _rows(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    content = F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    return docs.select(F.col(id_col).alias("id"), content.alias("content"), F.col(text).alias("text"))


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """``pairs`` with ``linked``; ``texts`` has the text of every node."""
    a, b = (texts.select(F.col("node").alias(n), F.col("text").alias(f"text_{n}")) for n in ("a", "b"))
    rows = pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b")

    def compute(batch):
        columns = batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()
        return {"linked": [similar(x, y, threshold) for x, y in zip(*columns)]}

    return map_batches(rows, compute, [StructField("linked", BooleanType())], _forget).select("a", "b", "linked")


def linked_nodes(docs: DataFrame, table: DataFrame, id_col: str, text: str, threshold: float) -> DataFrame:
    """``(node, component)`` of all nodes with a link; ``table`` is the written outcome of :func:`sketches`."""
    nodes = table.filter("node IS NOT NULL").groupBy("node").agg(F.min("size").alias("size"), F.min("sketches").alias("sketches"))
    entries = nodes.select("node", "size", F.explode("sketches").alias("bucket"))
    crowded = entries.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1")
    entries = written(entries.join(crowded, "bucket"), "near-entries")
    # the text that others were copied from has its sketches in the fullest buckets
    popular = entries.groupBy("node").agg(F.sum("members").alias("popular"))
    entries = written(entries.join(popular, "node").select("bucket", "node", "size", "popular"), "near-buckets")
    # the text of one row of each node that has a candidate: equal words align alike
    one = F.min(F.struct("id", "content")).alias("one")
    wanted = table.join(entries.select("node").distinct(), "node", "left_semi").groupBy("node").agg(one).select("node", "one.*")
    rows = _rows(docs, id_col, text)
    same = (rows["content"] == wanted["content"]) & rows["id"].eqNullSafe(wanted["id"])
    texts = written(rows.join(wanted, same).select("node", "text"), "near-texts")

    live, used, tested, found = entries.withColumn("component", F.col("node")), None, None, None
    while True:
        pivots = live if used is None else live.join(used, ["bucket", "node"], "left_anti")
        first = F.max(F.struct("popular", "node", "size", "component")).alias("pivot")
        pivots = written(pivots.groupBy("bucket").agg(first).select("bucket", "pivot"), "near-pivots")
        pairs = _pairs(live, pivots, threshold)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        outcome = written(_verified(pairs, texts, threshold), "near-pairs")
        compared = outcome.agg(F.count("*").alias("pairs"), F.count_if("linked").alias("links")).first()
        tested = outcome if tested is None else tested.union(outcome)
        if compared.links or found is None:
            found = written(components(tested.filter("linked"), "near"), "near-components")
        live = written(_mixed(entries.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))), "near-live")
        if compared.links <= LEAST_YIELD * compared.pairs:
            break
        spent = pivots.select("bucket", F.col("pivot.node").alias("node"))
        used = spent if used is None else used.union(spent)
    rest = _rest(live, texts, threshold)
    if rest is None:
        return found
    outcome = written(_verified(rest.join(tested, ["a", "b"], "left_anti"), texts, threshold), "near-rest")
    if outcome.filter("linked").isEmpty():
        return found
    return written(components(tested.union(outcome).filter("linked"), "near"), "near-components")


def _mixed(live: DataFrame) -> DataFrame:
    """The rows of buckets whose members aren't all in one component."""
    mixed = live.groupBy("bucket").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    return live.join(mixed.filter("least < most").select("bucket"), "bucket", "left_semi")


def _rest(live: DataFrame, texts: DataFrame, threshold: float) -> DataFrame | None:
    """Distinct pairs of ``live`` nodes of one bucket and two components, without those that can't be links.

    Both texts of a link hold at least the threshold's share of their shingles in common, equal ones counted.
    So a text of which fewer occur in any other component has no link to one, and drops out; then others
    may follow. Of the texts that stay, the members of a bucket's largest component meet only its other
    members, and a pair is made if the shingles both hold are enough for a link in any order.
    """

    def compute(batch):
        return {"shingles": [_labelled(shingles(words_of(t))).view(np.int64).tolist() for t in batch.column("text").to_pylist()]}

    bags = texts.join(live.select("node").distinct(), "node", "left_semi")
    bags = written(map_batches(bags, compute, [StructField("shingles", ArrayType(LongType()))], _forget).select("node", "shingles"), "near-bags")
    least = F.ceil(F.col("size") * threshold - 1e-9)
    while True:
        nodes = written(live.select("node", "size", "component").distinct(), "near-left")
        each = bags.join(nodes, "node").withColumn("shingle", F.explode("shingles")).drop("shingles")
        held = each.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        shared = each.join(held.filter("low < high").select("shingle"), "shingle")
        shared = shared.groupBy("node", "size").agg(F.collect_list("shingle").alias("shared"))
        shared = written(shared.filter(F.size("shared") >= least).drop("size"), "near-shared")
        before, after = nodes.count(), shared.count()
        if not after:
            return None
        if before - after < LEAST_DROP * before:
            break
        live = written(_mixed(live.join(shared.select("node"), "node", "left_semi")), "near-live")
    live = live.select("bucket", "node", "size", "component").join(shared, "node")
    parts = live.groupBy("bucket", "component").agg(F.count("*").alias("members"))
    largest = parts.groupBy("bucket").agg(F.max(F.struct("members", "component"))["component"].alias("largest"))
    one, two = (live.select("bucket", *[F.col(c).alias(f"{c}_{n}") for c in live.columns if c != "bucket"]) for n in ("a", "b"))
    both = one.join(largest, "bucket").filter("component_a <> largest").join(two, "bucket").filter("component_a <> component_b")
    both = both.filter((F.col("component_b") == F.col("largest")) | (F.col("node_a") < F.col("node_b")))
    near_size = F.least("size_a", "size_b") >= F.greatest("size_a", "size_b") * threshold - 1e-9
    # matched / (all - matched) reaches the threshold from so many matches on
    needed = ((F.col("size_a") + F.col("size_b")) * threshold - 1e-6) / (1 + threshold)
    both = both.filter(near_size & (F.least(F.size("shared_a"), F.size("shared_b")) >= needed))
    both = both.filter(F.size(F.array_intersect("shared_a", "shared_b")) >= needed)
    return both.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def _pairs(live: DataFrame, pivots: DataFrame, threshold: float) -> DataFrame:
    """Distinct pairs of a bucket's pivot and its members that aren't known to belong to it."""
    near_size = F.least(F.col("size"), F.col("pivot.size")) >= F.greatest(F.col("size"), F.col("pivot.size")) * threshold - 1e-9
    both = live.join(pivots, "bucket").filter((F.col("component") != F.col("pivot.component")) & near_size)
    return both.select(F.least(F.col("node"), F.col("pivot.node")).alias("a"), F.greatest(F.col("node"), F.col("pivot.node")).alias("b")).distinct()


def classes(docs: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``content``, ``class_id``, ``class_size`` and ``kept``.

    A class holds all texts that a chain of links joins; its id is its smallest document id, and that
    document is kept, exactly one of rows that repeat it. Texts without words (also NULL) are their own
    class each. Rows with a NULL id belong to a class but are kept only if it has no other.
    """
    table = written(sketches(docs, id_col, text), "near-sketches")
    found = linked_nodes(docs, table, id_col, text, threshold)
    alone = table.filter("node IS NULL").select("id", "content", F.col("id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("kept"))
    rows = table.filter("node IS NOT NULL").select("id", "content", "node")
    rows = written(rows.join(found, "node", "left").withColumn("component", F.coalesce("component", "node")).drop("node"), "near-classes")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "content")).alias("first")
    heads = rows.groupBy("component").agg(first, F.count("*").alias("class_size"))
    each = rows.join(heads, "component").select("id", "content", F.col("first.id").alias("class_id"), "class_size", "first")
    is_head = F.col("id").eqNullSafe(F.col("class_id")) & (F.col("content") == F.col("first.content"))
    others = each.filter(~is_head).select("id", "content", "class_id", "class_size", F.lit(False).alias("kept"))
    # rows that repeat the head: one of them stays
    head = each.filter(is_head).groupBy("id", "content", "class_id", "class_size").agg(F.count("*").alias("copies"))
    head = head.withColumn("kept", F.explode(F.transform(F.sequence(F.lit(1), F.col("copies").cast("int")), lambda i: i == 1))).drop("copies")
    return others.unionByName(head).unionByName(alone)


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    verdict = classes(docs, id_col, text).filter("kept").select(F.col("id").alias("kept_id"), F.col("content").alias("kept_content"))
    rows = docs.select(whole_rows(docs), F.col(f"`{id_col}`").alias("id"), F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")).alias("content"))
    stay = rows.join(verdict, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("content") == F.col("kept_content")), "left_semi")
    if docs.groupBy(id_col).agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        return stay.select("row.*")
    # rows with the same id and text: the least of them by all columns
    return stay.groupBy("id", "content").agg(F.min("row").alias("row")).select("row.*")


def near_classes(docs: DataFrame) -> DataFrame:
    """Class of every document."""
    return classes(docs).select(F.col("id").alias("doc_id"), "class_id", "class_size", "kept")
