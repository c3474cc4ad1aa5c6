"""Near-duplicate lines by an exact set-similarity join.

A line is the set of its words. Two lines match when the Jaccard similarity of their sets is at least
4/5. Words are put in one global order, rare ones first; sets that match must then share a word
among their first few (prefix filter), at places from which enough words can still follow (positional
filter), and have similar sizes (length filter). A signature of 128 bits, each the parity of the words
that hash to it, bounds from below how many words two sets don't share, so most of the other candidates
end in the join itself. What passes is verified on the whole sets, of which one line each is fetched by its hash. Equal sets are one node and are
joined as one; only nodes that differ form pairs.

Families of near copies are not joined pair by pair. Two sets match when at most a ninth of their sizes' sum are words
that only one of them has. That distance obeys the triangle inequality, so with the distance to any common centre known, the
slack ``size - 9 * distance`` says most: sets of a centre whose slacks add up to 0 or more match, and are counted from
the slacks of the centre's sets. Of the others those match that differ from the centre by enough words in common, 18
for each of them. Only pairs of different centres or none are candidates. Which centres there are changes no
link; they are the majorities of sets that have their first, middle or last few hashed words in common.

The order is a table of fixed size: words are counted by slots of their hash. Any global order gives
the same links; a better one only gives fewer candidates. Sets are named by 128 bits of hash, and verified on their words.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalflow.llm.common import whole_rows
from signalflow.session import written

# The similarity as a fraction, so that all bounds are whole numbers.
NUM, DEN = 4, 5
# Slots of the table of word counts, and steps per doubling of a count.
SLOTS = 1 << 16
STEPS = 4
# Fewer words than this can only match an equal set.
LEAST = 4
# Fewer words than this match a set that has another word instead of one of theirs only if they are equal.
CLOSE = 9
# Hashed words that sets of a family have in common, and different sets (by six bits of hash) that make a family.
SHARED, FAMILY = 4, 12
# Sets of a family, the first by hash, whose majority is its centre.
SEEDS = 64
# More than the words of any line; a text of Spark holds fewer.
MOST = 1 << 31
# Bits of the table of lines that have a candidate.
TABLE_BITS = 1 << 20
WHITE = r"[\x20\x09-\x0D]+"


def _split(line: Column) -> Column:
    """The words of a line, and empty strings; a split at spaces alone is faster and does for most lines."""
    others = reduce(or_, [F.contains(line, F.lit(c)) for c in "\t\x0b\x0c\r"])
    return F.when(others, F.split(line, WHITE)).otherwise(F.split(line, " "))


def _words(line: Column) -> Column:
    """Hashes of the distinct words of a line, in ascending order."""
    # functions that take a lambda evaluate all below them row by row, so only the split is below one
    hashes = F.transform(_split(line), lambda w: F.xxhash64(w))
    return F.sort_array(F.array_distinct(F.array_remove(hashes, F.xxhash64(F.lit("")))))


def _texts(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(whole).alias("content"), F.posexplode(F.split(whole, "\n")).alias("line", "value"))


def word_order(docs: DataFrame, text: str) -> list[int]:
    """Per slot a step of its words' count in all texts: ``STEPS`` times the binary logarithm.

    Words between spaces and line ends will do, since any order gives the same links.
    """
    words = docs.select(F.explode(F.split(F.replace(F.col(text), F.lit("\n"), F.lit(" ")), " ")).alias("word"))
    counts = words.groupBy(F.xxhash64("word").bitwiseAND(F.lit(SLOTS - 1)).cast("int").alias("slot")).agg(F.count("*").alias("n"))
    table = [0] * SLOTS
    for slot, step in counts.select("slot", F.least(F.lit(127), F.floor(F.log2("n") * STEPS)).cast("int")).collect():  # SLOTS rows at most
        table[slot] = step
    return table


def _ranks(words: Column, table: list[int]) -> Column:
    """Places of words in the global order, ascending: count step, then 56 bits of hash, in one number."""
    steps = F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>")

    def rank(word: Column) -> Column:
        step = F.get(steps, word.bitwiseAND(F.lit(SLOTS - 1)).cast("int"))
        return F.shiftleft(F.coalesce(step, F.lit(0)), 56).bitwiseOR(F.shiftrightunsigned(word, 8))

    return F.sort_array(F.transform(words, rank))


def _negatives(words: Column) -> Column:
    """How many of the words, which are in ascending order, are below zero."""
    zero = F.lit(0).cast("long")
    return (F.array_position(F.sort_array(F.array_append(words, zero)), zero) - 1).cast("int")


def _signature(words: Column, negatives: Column) -> tuple[Column, Column]:
    """A bit per sign and value of the last six bits of a word: whether an odd number of words have it. The words are in ascending order."""

    def parities(some: Column) -> Column:
        one = F.lit(1).cast("long")
        return F.aggregate(some, F.lit(0).cast("long"), lambda bits, w: bits.bitwiseXOR(F.call_function("shiftleft", one, w.bitwiseAND(F.lit(63)).cast("int"))))

    return parities(F.slice(words, 1, negatives)), parities(F.slice(words, negatives + 1, F.size(words)))


def _families(words: Column, negatives: Column) -> list[Column]:
    """32 bits each that name the first, the last and the middle few words in order of their hashes."""
    starts = F.lit(1), F.size(words) - (SHARED - 1), negatives + 1
    return [F.hash(F.lit(i), F.slice(words, start, SHARED)).alias(f"family_{i}") for i, start in enumerate(starts)]


def _keys(ranks: Column) -> Column:
    """The ranks' last 32 bits: enough to bring sets together, and half the bytes to carry."""
    return F.transform(ranks, lambda r: (F.pmod(r, F.lit(1 << 32)) - (1 << 31)).cast("int"))


def _prefix_size(size: Column) -> Column:
    """Words of which a matching set must share one: size - ceil(size * 4/5) + 1."""
    return size - F.ceil(size * NUM / DEN).cast("int") + 1


def _name(words: Column) -> Column:
    """128 bits that name a set of words."""
    return F.struct(F.xxhash64(words).alias("h1"), F.xxhash64(F.lit(1), words).alias("h2"))


def _entries(sets: DataFrame) -> DataFrame:
    """One row per set and prefix word: ``(word, node, place, low, high, centre)``, the node the hash of the set's line.

    ``place`` packs the set's size and the word's position in it, so that the rows that are shuffled
    hold five numbers, and one more for sets that have a centre.
    """
    rows = sets.select(F.col("raw").alias("node"), "size", "low", "high", "centre", F.posexplode("prefix").alias("at", "word"))
    return rows.select("word", "node", (F.col("size") * MOST + F.col("at")).cast("long").alias("place"), "low", "high", "centre")


def candidates(entries: DataFrame) -> DataFrame:
    """Distinct pairs ``(a, b)`` of sets that pass the prefix, positional, length and signature filters.

    Pairs of one centre are left out, see ``_within`` and ``_by_slack``.
    """
    left, right = (entries.select("word", *[F.col(c).alias(f"{c}_{side}") for c in ("node", "place", "low", "high", "centre")]) for side in ("a", "b"))
    # places are packed by MOST, a power of two
    (size_a, at_a), (size_b, at_b) = ((F.shiftright(f"place_{s}", 31), F.col(f"place_{s}").bitwiseAND(F.lit(MOST - 1))) for s in ("a", "b"))
    follow = F.least(size_a - at_a, size_b - at_b)
    shared = (NUM + DEN) * follow >= NUM * (size_a + size_b)
    lengths = DEN * F.least(size_a, size_b) >= NUM * F.greatest(size_a, size_b)
    # every bit that differs stands for a word of its own that only one of both sets has
    apart = F.bit_count(F.col("low_a").bitwiseXOR(F.col("low_b"))) + F.bit_count(F.col("high_a").bitwiseXOR(F.col("high_b")))
    alike = (NUM + DEN) * (size_a + size_b - apart) >= 2 * NUM * (size_a + size_b)
    near = F.coalesce(F.col("centre_a") == F.col("centre_b"), F.lit(False))
    pairs = left.join(right, "word").filter((F.col("node_a") < F.col("node_b")) & alike & lengths & shared & ~near)
    return pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def verify(pairs: DataFrame, values: DataFrame) -> DataFrame:
    """The pairs of sets that match, by their names; ``values`` is ``(raw, value)``, a line of each set by its hash.

    Lines travel as text, which shrinks in the shuffle; hashes of their words don't.
    """
    words = values.select("raw", "value", _words(F.col("value")).alias("words"))
    sets = words.select("raw", "value", _name(F.col("words")).alias("node"), F.size("words").alias("size"))
    a, b = (sets.select(F.col("raw").alias(n), *[F.col(c).alias(f"{c}_{n}") for c in ("node", "size", "value")]) for n in ("a", "b"))
    both = pairs.join(a, "a").join(b, "b")
    common = F.size(F.array_remove(F.array_intersect(_split(F.col("value_a")), _split(F.col("value_b"))), ""))
    matching = both.filter((NUM + DEN) * common >= NUM * (F.col("size_a") + F.col("size_b")))
    return matching.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))


def _marked(values: DataFrame) -> Callable[[Column], Column]:
    """A test that holds for all numbers of the only column of ``values`` and for few others, by a bit table of fixed size."""

    def place(number: Column) -> tuple[Column, Column]:
        slot = F.pmod(number, F.lit(TABLE_BITS))
        # seven bits of each byte, so that it is an ASCII character
        return F.floor(slot / 7).cast("int"), F.call_function("shiftleft", F.lit(1), (slot % 7).cast("int"))

    byte, bit = place(F.col(values.columns[0]))
    marks = bytearray(TABLE_BITS // 7 + 1)
    for at, found in values.groupBy(byte.alias("place")).agg(F.bit_or(bit)).collect():  # at most as many rows as the table has bytes
        marks[at] = found

    def test(number: Column) -> Column:
        byte, bit = place(number)
        return F.ascii(F.substring(F.lit(bytes(marks)), byte + 1, F.lit(1)).cast("string")).bitwiseAND(bit) != 0

    return test


def _values(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(raw, value)`` of all lines whose hashes are in ``wanted``, and of few others: the join to them is exact."""
    rows = texts.select(F.xxhash64("value").alias("raw"), "value").filter(_marked(wanted)(F.col("raw")))
    return rows.groupBy("raw").agg(F.first("value").alias("value"))


def centred(placed: DataFrame, texts: DataFrame) -> DataFrame:
    """``(node, centre, slack, apart)`` of sets that are near the centre of a family.

    ``apart`` has the words that only one of set and centre has, ``slack`` is the set's size less nine times their
    number. Where families share a centre they are one.
    """
    keys, large = [F.col(f"family_{i}") for i in range(3)], placed.filter(F.col("size") >= CLOSE)
    # different lines of a family set different bits, copies don't
    bits = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("raw").bitwiseAND(F.lit(63)).cast("int")))
    families = large.select("raw", F.explode(F.array(*keys)).alias("family")).groupBy("family").agg(bits.alias("bits"))
    families = written(families.filter(F.bit_count("bits") >= FAMILY).select("family"), "line-families")
    known = _marked(families)
    some = large.filter(F.exists(F.array(*keys), known))
    sets = some.groupBy("node", "size", *keys).agg(F.min("raw").alias("raw"))
    members = sets.select("node", "size", "raw", F.explode(F.array_distinct(F.array(*keys))).alias("family")).join(families, "family")
    members = written(members, "line-members")
    # texts are shuffled, not their words
    rows = written(members.join(_values(texts, members.select("raw")), "raw"), "line-texts")
    words = F.array_distinct(F.array_remove(_split(F.col("value")), ""))
    nr = F.row_number().over(Window.partitionBy("family").orderBy("raw"))
    seeds = rows.select("family", "raw", "value").select("family", "value", nr.alias("nr")).filter(F.col("nr") <= SEEDS)
    counts = seeds.select("family", F.explode(words).alias("word")).groupBy("family", "word").agg(F.count("*").alias("n"))
    number = members.groupBy("family").agg(F.count("*").alias("sets"))
    most = counts.join(number, "family").filter(2 * F.col("n") > F.least("sets", F.lit(SEEDS)))
    centres = most.groupBy("family", "sets").agg(F.sort_array(F.collect_list("word")).alias("common"))
    centres = written(centres.select("family", "sets", "common", F.xxhash64("common").alias("centre")), "line-centres")
    weights = centres.groupBy("centre").agg(F.first("common").alias("common"), F.sum("sets").alias("weight"))
    # a family whose own centre is a variant of a larger one is measured from that as well
    hashes = F.sort_array(F.transform("common", lambda w: F.xxhash64(w)))
    other = F.explode(F.array(*_families(F.col("hashes"), _negatives(F.col("hashes"))))).alias("other")
    variants = centres.select("family", hashes.alias("hashes")).filter(F.size("hashes") >= CLOSE).select("family", other)
    larger = centres.join(weights.select("centre", "weight"), "centre").select(F.col("family").alias("other"), F.struct("weight", "centre").alias("larger"))
    larger = variants.join(larger, "other").groupBy("family").agg(F.max("larger").alias("larger")).select("family", "larger.centre")
    reach = centres.select("family", "centre").union(larger).distinct().join(weights, "centre")
    near = rows.join(reach, "family").select("node", "size", "centre", "weight", "common", words.alias("words"))
    apart = F.concat(F.array_except("words", "common"), F.array_except("common", "words"))
    near = near.select("node", "size", "centre", "weight", apart.alias("apart"))
    near = near.select("*", (F.col("size") - (NUM + DEN) * F.size("apart")).alias("slack")).filter(F.col("slack") >= -F.col("size"))
    best = near.groupBy("node").agg(F.max(F.struct("weight", "slack", "centre", "apart")).alias("best"))
    return written(best.select("node", "best.centre", "best.slack", "best.apart"), "line-classes")


def _within(classes: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between sets of one centre that slack alone doesn't show: they differ from it by the same words."""
    rows = classes.select("*", F.explode("apart").alias("word"))
    a, b = (rows.select("centre", "word", *[F.col(c).alias(n if c == "node" else f"{c}_{n}") for c in ("node", "slack", "apart")]) for n in ("a", "b"))
    slack, both = F.col("slack_a") + F.col("slack_b"), F.array_intersect("apart_a", "apart_b")
    # each pair is made by one of the words
    matching = (F.col("a") < F.col("b")) & (slack < 0) & (slack + 2 * (NUM + DEN) * F.size(both) >= 0) & (F.array_min(both) == F.col("word"))
    return a.join(b, ["centre", "word"]).filter(matching).select("a", "b")


def similar_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Lines ``(id, content, line, node, size)``, links ``(a, b)`` between the nodes of different sets, and classes.

    The classes are those of ``centred``: two of their nodes that have one centre and slacks that add up to 0 or more
    are linked too, and are not among the links.
    """
    id_col, text = f"`{id_col}`", f"`{text}`"
    texts, table = _texts(docs, id_col, text), word_order(docs, text)
    # a column of its own each, so that no step is computed twice
    lines = texts.select("id", "content", "line", F.xxhash64("value").alias("raw"), _words(F.col("value")).alias("words"))
    lines = lines.select("*", _negatives(F.col("words")).alias("negatives"))
    words, size, large = F.col("words"), F.size("words"), F.size("words") >= LEAST
    prefix = F.when(large, _keys(F.slice(_ranks(words, table), 1, _prefix_size(size))))
    low, high = (F.when(large, bits) for bits in _signature(words, F.col("negatives")))
    rows = lines.select(
        "id", "content", "line", "raw", _name(words).alias("node"), size.alias("size"), prefix.alias("prefix"), low.alias("low"), high.alias("high"),
        *[F.when(size >= CLOSE, k).alias(f"family_{i}") for i, k in enumerate(_families(words, F.col("negatives")))],
    )
    # the texts' words are split once for all that follows but the centres and the verification
    placed = written(rows, "line-sets")
    classes = centred(placed, texts)
    sets = placed.filter(F.col("size") >= LEAST).groupBy("node").agg(F.min("raw").alias("raw"), *[F.first(c).alias(c) for c in ("size", "prefix", "low", "high")])
    pairs = written(candidates(_entries(sets.join(classes, "node", "left"))), "line-pairs")
    # the lines of the sets that have a candidate
    values = _values(texts, pairs.select(F.col("a").alias("raw")).union(pairs.select("b")))
    links = written(verify(pairs, values).union(_within(classes)), "line-links")
    return placed.select("id", "content", "line", "node", "size"), links, classes


def _by_slack(members: DataFrame) -> DataFrame:
    """Per ``(centre, slack)`` the members whose slack makes up for it: ``matches``, their ``earliest`` and ``least_id``.

    ``members`` is ``(centre, slack, first, low_id)``. A set of slack 0 or more is among its own matches.
    """
    steps = members.groupBy("centre", "slack").agg(F.count("*").alias("n"), F.min("first").alias("first"), F.min("low_id").alias("low_id"))
    # the members by slack, the largest first, and each slack's question behind those that make up for it
    given = steps.select("centre", F.col("slack").alias("at"), F.lit(0).alias("asks"), "slack", "n", "first", "low_id")
    nothing = [F.lit(None).cast(steps.schema[c].dataType).alias(c) for c in ("n", "first", "low_id")]
    asked = steps.select("centre", (-F.col("slack")).alias("at"), F.lit(1).alias("asks"), "slack", *nothing)
    so_far = Window.partitionBy("centre").orderBy(F.col("at").desc(), "asks").rowsBetween(Window.unboundedPreceding, 0)
    sums = F.sum("n").over(so_far).alias("matches"), F.min("first").over(so_far).alias("earliest"), F.min("low_id").over(so_far).alias("least_id")
    return given.union(asked).select("centre", "slack", "asks", *sums).filter("asks = 1").drop("asks")


def judged_lines(lines: DataFrame, links: DataFrame, classes: DataFrame) -> DataFrame:
    """Lines with ``removed``, ``links`` (of their set) and ``origin``, the smallest id with an equal or matching line.

    Lines are ordered by document id, content and number. A line is removed when any earlier line
    matches it. Lines without words stay.
    """
    worded = lines.filter("size > 0")
    firsts = worded.groupBy("node").agg(F.min(F.struct("id", "content", "line")).alias("first"), F.min("id").alias("low_id"), F.count("*").alias("n"))
    # a set that occurs once and has no link decides nothing about other lines
    linked = links.select(F.col("a").alias("node")).union(links.select("b")).union(classes.select("node")).distinct().withColumn("linked", F.lit(True))
    firsts = written(firsts.join(linked, "node", "left").filter("n > 1 OR linked").select("node", "first", "low_id"), "line-firsts")
    theirs = firsts.select(F.col("node").alias("b"), F.col("first").alias("earliest"), F.col("low_id").alias("least_id"))
    other = links.union(links.select("b", "a")).join(theirs, "b").groupBy(F.col("a").alias("node"))
    other = other.agg(F.min("earliest").alias("earliest"), F.min("least_id").alias("least_id"), F.count("*").alias("links"))
    members = classes.join(firsts, "node")
    near = members.select("node", "centre", "slack").join(_by_slack(members.select("centre", "slack", "first", "low_id")), ["centre", "slack"])
    near = near.select("node", "earliest", "least_id", (F.coalesce("matches", F.lit(0)) - F.when(F.col("slack") >= 0, 1).otherwise(0)).alias("links"))
    earlier = other.union(near).groupBy("node").agg(F.min("earliest").alias("earliest"), F.min("least_id").alias("least_id"), F.sum("links").alias("links"))
    known = firsts.join(earlier, "node", "left")
    own = F.struct("id", "content", "line")
    judged = lines.join(known, "node", "left").select(
        "id", "content", "line", "size",
        ((F.col("size") > 0) & (F.coalesce(F.col("first") < own, F.lit(False)) | F.coalesce(F.col("earliest") < own, F.lit(False)))).alias("removed"),
        F.when(F.col("size") > 0, F.coalesce("links", F.lit(0))).otherwise(0).cast("long").alias("links"),
        # a line of an unknown set has no earlier one; an id may be NULL, which is no smallest id
        F.when(F.col("first").isNull(), F.when(F.col("size") > 0, F.col("id"))).otherwise(F.least("low_id", "least_id")).alias("origin"),
    )
    return judged


def line_verdicts(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its lines with words, those removed, their links to other sets, and its class.

    ``class_id`` is the smallest document id that has a line equal to or matching one of its lines, or
    its own. ``removed_lines`` lists the numbers of the removed lines. Rows with the same id and text
    are one document, returned as often as it is there; a NULL text has no lines.
    """
    judged = judged_lines(*similar_lines(docs, id_col, text))
    # copies of a document have the same lines, verdicts and links
    each = judged.groupBy("id", "content").agg(
        F.count_if(F.col("line") == 0).alias("copies"),
        F.count_if(F.col("size") > 0).alias("n_lines"),
        F.count_if("removed").alias("n_removed"),
        F.sum("links").alias("n_links"),
        F.coalesce(F.min("origin"), F.first("id")).alias("class_id"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("removed"), F.col("line")))).cast("array<string>"), ",").alias("removed_lines"),
    )
    each = each.withColumns({c: F.expr(f"{c} div copies") for c in ("n_lines", "n_removed", "n_links")})
    each = each.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return each.select(F.col("id").alias("doc_id"), "n_lines", "n_removed", "n_links", "class_id", "removed_lines")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the removed lines cut out of ``text``; the other columns as they are."""
    gone = judged_lines(*similar_lines(docs, id_col, text)).filter("removed").groupBy("id", "content").agg(F.collect_set("line").alias("gone"))
    gone = gone.withColumnsRenamed({"id": "gone_id", "content": "gone_content"})
    rows = docs.select(whole_rows(docs), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"), F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("content"))
    rows = rows.join(gone, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("content") == F.col("gone_content")), "left")
    numbered = F.transform(F.split("text", "\n"), lambda v, i: F.struct(v.alias("v"), i.alias("i")))
    stay = F.filter(numbered, lambda p: ~F.array_contains("gone", p["i"]))
    clean = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(stay, lambda p: p["v"]), "\n"))
    return rows.select(*[clean.alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns])
