"""Prefix trie of conversations, packed into double arrays shard by shard.

A node is a distinct sequence of first turns; the conversations that begin with it are its members. Equal
conversations are added up first. The others are dealt into shards by a prefix: the shortest one that
not more than ``limit`` distinct conversations share, so a first turn that a third of all have in common
is cut further down, and each node at or below its shard's prefix lies in one task whole. A task
packs its shards into a double-array trie over dense turn ids: the child of a node ``s`` by turn ``c`` is the
slot ``BASE[s] + c``, if ``CHECK`` of that slot is ``s``. It walks all conversations through the arrays and adds up from the leaves. Nodes
above the shards' prefixes occur in many tasks; their sums are merged globally, with what several tasks
have counted for the same node taken off its ancestors again.

Only turn keys of 16 bytes and numbers of words are shuffled, never texts. A conversation's keys are one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType

from signalflow.llm.common import WORD
from signalflow.session import written

# Contract of the registered query: turns are taken over from the first conversation of each family of so many.
FAMILY = 20
MOST_TAKEN = 4
KEY = 16
# Distinct conversations that may share a shard's prefix, and the most prefixes above the shards: at so
# many turns in all that more than the second would be possible, the first is raised.
SHARD_CONVERSATIONS = 256
UPPER_NODES = 400_000
# Turns that are packed into one pair of arrays; shards are never cut by it.
PACKED_TURNS = 50_000
# Free slots that are tried for a node's children before they are put behind the end.
TRIES = 32
# Members are listed by blocks of so many (a power of two) conversation numbers.
BLOCK_BITS = 16


class DoubleArray:
    """``base`` and ``check`` over slots; turn ids are given out densely, in the order in which nodes are packed."""

    def __init__(self) -> None:
        self.ids: dict[bytes, int] = {}
        self.base = [0]
        self.check = [-1]
        self._holes: list[int] = []

    def _grow(self, size: int, leave: set[int]) -> None:
        old = len(self.check)
        self.base += [0] * (size - old)
        self.check += [-2] * (size - old)
        self._holes += [i for i in range(old, size) if i not in leave]

    def _fits(self, base: int, codes: list[int]) -> bool:
        check, n = self.check, len(self.check)
        return base >= 0 and all(base + c >= n or check[base + c] == -2 for c in codes)

    def add(self, node: int, turns: list[bytes]) -> list[int]:
        """Give ``node`` its children, all at once; returns their slots."""
        codes = [self.ids.setdefault(t, len(self.ids)) for t in turns]
        least = min(codes)
        holes, base = self._holes, None
        for k in range(len(holes) - 1, max(len(holes) - TRIES, 0) - 1, -1):
            if self.check[holes[k]] != -2:
                holes[k] = holes[-1]
                holes.pop()
            elif self._fits(holes[k] - least, codes):
                base = holes[k] - least
                break
        if base is None:
            # every id was given out with a slot, so the end lies behind the least of these codes
            base = max(len(self.check) - least, 0)
            while not self._fits(base, codes):
                base += 1
        slots = [base + c for c in codes]
        if max(slots) >= len(self.check):
            self._grow(max(slots) + 1, set(slots))
        self.base[node] = base
        for s in slots:
            self.check[s] = node
        return slots

    def child(self, node: int, turn: bytes) -> int | None:
        code = self.ids.get(turn)
        if code is None:
            return None
        slot = self.base[node] + code
        return slot if slot < len(self.check) and self.check[slot] == node else None


def pack(sequences: list[list[bytes]]) -> DoubleArray:
    """Double array of distinct sequences of turns in order, level by level."""
    trie = DoubleArray()
    level = [(0, 0, len(sequences))]
    depth = 0
    while level:
        below = []
        for node, low, high in level:
            while low < high and len(sequences[low]) == depth:
                low += 1
            turns, starts = [], []
            for i in range(low, high):
                turn = sequences[i][depth]
                if not turns or turn != turns[-1]:
                    turns.append(turn)
                    starts.append(i)
            if turns:
                slots = trie.add(node, turns)
                below += zip(slots, starts, [*starts[1:], high])
        level, depth = below, depth + 1
    return trie


_NODES = (
    "upper boolean, key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, words long, ends string"
)


def nodes_of(rows: list[dict]) -> list[dict]:
    """All nodes of some shards: ``rows`` are distinct conversations with ``keys``, ``words``, ``prefixes``, ``n``, ``least``, ``ends``, ``cut``.

    Nodes less deep than a row's ``cut`` are its upper nodes: what they count holds for these shards alone.
    """
    rows = sorted(rows, key=lambda r: r["keys"])
    turns = [[r["keys"][i : i + KEY] for i in range(0, len(r["keys"]), KEY)] for r in rows]
    trie = pack(turns)
    size = len(trie.check)
    members, least, depths = [0] * size, [None] * size, [0] * size
    words, ends, keys, upper = [0] * size, [None] * size, [b""] * size, [False] * size
    order, seen = [0], {0}
    upper[0] = True
    for r, sequence in zip(rows, turns):
        slot = 0
        for depth in range(len(sequence) + 1):
            if depth:
                slot = trie.child(slot, sequence[depth - 1])
                if slot not in seen:
                    seen.add(slot)
                    order.append(slot)
                    depths[slot], words[slot], upper[slot] = depth, r["words"][depth - 1], depth < r["cut"]
                    keys[slot] = r["prefixes"][(depth - 1) * KEY : depth * KEY]
            members[slot] += r["n"]
            least[slot] = r["least"] if least[slot] is None else min(least[slot], r["least"])
        ends[slot] = r["ends"]
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    for slot in sorted(order, key=depths.__getitem__, reverse=True):
        leaves[slot] += not children[slot]
        saved[slot] += (members[slot] - 1) * words[slot]
        if slot:
            parent = trie.check[slot]
            children[parent] += 1
            leaves[parent] += leaves[slot]
            saved[parent] += saved[slot]
    out = []
    for slot in order:
        parent = trie.check[slot] if slot else None
        below_upper = parent is not None and upper[parent]
        out.append({
            "upper": upper[slot], "key": keys[slot] if upper[slot] else None, "parent_key": keys[parent] if below_upper else None, "conv_id": least[slot],
            "depth": depths[slot], "parent_conv_id": None if parent is None or below_upper else least[parent], "n_convs": members[slot],
            "n_children": children[slot], "n_leaves": leaves[slot], "saved_tokens": saved[slot], "words": words[slot], "ends": ends[slot],
        })
    return out


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for r in rows:
        held.append(r)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _map_rows(df: DataFrame, make, ddl: str) -> DataFrame:
    """``make`` turns the rows of a partition into others, both as iterators of dicts."""

    schema = to_arrow_schema(DataType.fromDDL(ddl))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for start in range(0, batch.num_rows, 1024) for r in batch.slice(start, 1024).to_pylist())
        yield from _batches(make(rows), schema)

    return df.mapInArrow(apply, ddl)


def rebuilt(turns: DataFrame) -> DataFrame:
    """``(conv_id, keys, words)`` of every conversation of ``conv_id, turn, role, text``, with the turns it takes over.

    Turns are in order of ``turn`` (NULL first), those of one number by role and text; NULL roles and texts
    are empty. A conversation begins with the first ``crc32(id) % 4`` turns of the first one of its family,
    then come its own turns behind as many. Rows without a ``conv_id`` belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    own = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"), text.alias("text")).filter("conv_id IS NOT NULL")
    # the length tells role and text apart
    key = F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))
    words = F.regexp_count("text", F.lit(WORD))
    # equal turn numbers are told apart by a bounded part of the text, then by the key
    one = F.struct("turn", "role", F.substring("text", 1, 64).alias("begin"), key.alias("key"), words.cast("int").alias("words"))
    listed = own.select((F.col("conv_id") - F.col("conv_id") % FAMILY).alias("family"), "conv_id", one.alias("one")).repartition("family")
    convs = listed.groupBy("family", "conv_id").agg(F.sort_array(F.collect_list("one")).alias("own"))
    convs = convs.select("family", "conv_id", F.transform("own", lambda t: F.struct(t["key"].alias("key"), t["words"].alias("words"))).alias("own"))
    heads = convs.filter("conv_id = family").select("family", F.slice("own", 1, MOST_TAKEN - 1).alias("head"))
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_TAKEN
    joined = convs.join(heads, "family", "left").withColumn("taken", taken.cast("int"))
    head = F.coalesce(F.expr("slice(head, 1, taken)"), F.expr("slice(own, 1, 0)"))
    whole = F.concat(head, F.expr("slice(own, taken + 1, size(own))"))
    joined = joined.select("conv_id", whole.alias("whole"))
    keys = F.unhex(F.array_join(F.transform("whole", lambda t: F.hex(t["key"])), ""))
    return joined.select("conv_id", keys.alias("keys"), F.transform("whole", lambda t: t["words"]).alias("words"))


_DISTINCT = "keys binary, words array<int>, prefixes binary, n long, least long, ends string"


def _listed(rows: Iterator[dict]) -> Iterator[dict]:
    """From the sorted blocks of members of each sequence: the sequence with the digest of all their numbers."""
    current, state = None, None

    def close() -> dict:
        keys, prefix, chain = current["keys"], b"", []
        for i in range(0, len(keys), KEY):
            prefix = hashlib.md5(prefix + keys[i : i + KEY]).digest()
            chain.append(prefix)
        return {"keys": keys, "words": current["words"], "prefixes": b"".join(chain), "n": current["n"], "least": current["least"], "ends": state.hexdigest()}

    for r in rows:
        if current is None or r["sequence"] != current["sequence"]:
            if current is not None:
                yield close()
            current, state = r, hashlib.sha256(r["members"].encode())
        else:
            state.update(b"," + r["members"].encode())
            current["n"] += r["n"]
            current["least"] = min(current["least"], r["least"])
    if current is not None:
        yield close()


def distinct(conversations: DataFrame) -> DataFrame:
    """Every distinct sequence of turns once, with its number of members, the least one and the digest of their list.

    Members are sorted within blocks of numbers, each of bounded size, and the blocks of a sequence stream
    through one task in order: the digest of a list can't be taken in parts.
    """
    sequence = F.md5("keys")
    rows = conversations.select(sequence.alias("sequence"), F.shiftright("conv_id", BLOCK_BITS).alias("block"), "conv_id", "keys", "words")
    members = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    blocks = rows.groupBy("sequence", "block", "keys", "words").agg(members.alias("members"), F.count("*").alias("n"), F.min("conv_id").alias("least"))
    return _map_rows(blocks.repartition("sequence").sortWithinPartitions("sequence", "block"), _listed, _DISTINCT)


def _cut(frequent: frozenset[bytes]):
    def make(rows: Iterator[dict]) -> Iterator[dict]:
        for r in rows:
            chain = [r["prefixes"][i : i + KEY] for i in range(0, len(r["prefixes"]), KEY)]
            depth = next((d for d, p in enumerate(chain, 1) if p not in frequent), None)
            # a conversation all of whose prefixes are frequent consists of upper nodes only
            yield r | ({"cut": len(chain) + 1, "shard": chain[-1] if chain else b""} if depth is None else {"cut": depth, "shard": chain[depth - 1]})

    return make


def _packed(rows: Iterator[dict]) -> Iterator[dict]:
    """The nodes of the shards of a partition, which come in order of their prefixes."""
    held: list[dict] = []
    size = 0
    for r in rows:
        if size >= PACKED_TURNS and r["shard"] != held[-1]["shard"]:
            yield from nodes_of(held)
            held, size = [], 0
        held.append(r)
        size += len(r["words"]) + 1
    if held:
        yield from nodes_of(held)


def trie(turns: DataFrame, limit: int | None = None) -> DataFrame:
    """Every node of the trie of the :func:`rebuilt` conversations of ``turns``, as the contract lists it.

    ``conv_id`` (least member), ``depth``, ``parent_conv_id`` (parent's; root: NULL), ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``. A table without conversations has no nodes, not even a root.
    """
    spark = turns.sparkSession
    known = written(distinct(rebuilt(turns)), "trie-distinct")
    total = known.agg(F.sum(F.size("words"))).first()[0] or 0
    # a prefix shared by more than the limit has more than so many turns at its depth, so there are at most UPPER_NODES
    limit = limit or max(SHARD_CONVERSATIONS, -(-total // UPPER_NODES))
    prefix = F.explode(F.transform(F.sequence(F.lit(0), F.size("words") - 1), lambda d: F.substring("prefixes", d * KEY + 1, F.lit(KEY))))
    counts = known.filter(F.size("words") > 0).select(prefix.alias("prefix")).groupBy("prefix").agg(F.count("*").alias("n")).filter(F.col("n") > limit)
    frequent = frozenset(bytes(r.prefix) for r in counts.select("prefix").collect())
    dealt = _map_rows(known, _cut(frequent), f"{_DISTINCT}, cut long, shard binary")
    nodes = written(_map_rows(dealt.repartition("shard").sortWithinPartitions("shard"), _packed, _NODES), "trie-nodes")

    sums = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    upper = nodes.filter("upper").groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent_key").alias("parent_key"), F.max("words").alias("words"),
        F.max("ends").alias("ends"), F.count("*").alias("times"), F.max(F.col("n_children") == 0).alias("childless"), *[F.sum(c).alias(c) for c in sums],
    )
    upper = written(upper, "trie-upper")
    # a node that several tasks have counted: once too often as a child, in the words saved, and as a leaf where one of them saw no child
    shared = upper.filter("times > 1").select("conv_id", "depth", "words", "times", "childless")
    lines = known.join(F.broadcast(shared.withColumnRenamed("conv_id", "least").withColumnRenamed("words", "own")), "least")
    depth = F.explode(F.sequence(F.lit(0).cast("long"), F.col("depth")))
    lines = lines.select("prefixes", "depth", "own", "times", "childless", depth.alias("at"))
    zero = F.lit(0).cast("long")
    above = lines.select(
        F.when(F.col("at") > 0, F.expr(f"substring(prefixes, cast((at - 1) * {KEY} + 1 as int), {KEY})")).otherwise(F.lit(b"")).alias("key"),
        F.when(F.col("at") == F.col("depth") - 1, 1 - F.col("times")).otherwise(zero).alias("more_children"),
        F.when(F.col("childless"), F.lit(-1).cast("long")).otherwise(zero).alias("more_leaves"),
        ((F.col("times") - 1) * F.col("own")).alias("more_saved"),
    )
    above = above.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("more_children", "more_leaves", "more_saved")])
    upper = upper.join(above, "key", "left").withColumns({
        "n_children": F.col("n_children") + F.coalesce("more_children", zero),
        "n_leaves": F.col("n_leaves") + F.coalesce("more_leaves", zero),
        "saved_tokens": F.col("saved_tokens") + F.coalesce("more_saved", zero),
    })
    out = ("conv_id", "depth", "parent_conv_id", *sums, "ends")
    # upper nodes are the frequent prefixes and the root: few enough to be sent to every task
    parents = F.broadcast(upper.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above_id")))
    parent = F.coalesce("parent_conv_id", "above_id").alias("parent_conv_id")
    columns = ("conv_id", "depth", parent, *sums, "ends")
    lower = nodes.filter("NOT upper").join(parents, "parent_key", "left").select(*columns)
    upper = upper.withColumn("parent_conv_id", F.lit(None).cast("long")).join(parents, "parent_key", "left").select(*columns)
    none = hashlib.sha256(b"").hexdigest()
    return lower.unionByName(upper).select(*out[:-1], F.coalesce("ends", F.lit(none)).alias("ends_sha256"))


_CRC = (
    "list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({c}) + 1), lambda i: ord(substr({c}, i, 1))::BIGINT)), "
    "lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))"
)
SQL = f"""
    WITH own AS (SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
                 FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1),
    taken AS (SELECT conv_id, turns, xor({_CRC.format(c="conv_id::VARCHAR")}, 4294967295) % {MOST_TAKEN} AS h FROM own),
    whole AS (SELECT a.conv_id, list_concat(coalesce(b.turns, [])[1:a.h], a.turns[a.h + 1:]) AS turns FROM taken a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % {FAMILY}),
    lines AS (SELECT conv_id, len(turns) AS size, d AS depth, turns[1:d] AS seq, CASE WHEN d > 0 THEN turns[1:d - 1] END AS up
              FROM whole, unnest(range(0, len(turns) + 1)) u(d)),
    nodes AS (SELECT seq, depth, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs,
                     sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = depth), '')) AS ends_sha256
              FROM lines GROUP BY seq, depth),
    counted AS (SELECT n.*, (SELECT count(*) FROM nodes c WHERE c.up = n.seq) AS n_children,
                       (n_convs - 1) * CASE WHEN depth > 0 THEN len(regexp_extract_all(seq[depth].t, '{WORD}')) ELSE 0 END AS own_saved FROM nodes n),
    above AS (SELECT seq[1:d] AS seq, sum(own_saved) AS saved, count(*) FILTER (n_children = 0) AS leaves FROM counted, unnest(range(0, depth + 1)) u(d) GROUP BY 1)
    SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs, n.n_children::BIGINT AS n_children,
           a.leaves::BIGINT AS n_leaves, a.saved::BIGINT AS saved_tokens, n.ends_sha256
    FROM counted n JOIN above a ON a.seq = n.seq LEFT JOIN nodes p ON p.seq = n.up
"""
