"""The prefix trie of conversations against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from signalflow.llm import prefix_trie

TURNS = "conv_id long, turn long, role string, text string, family long, keys string"


def brute(turns):
    own = defaultdict(list)
    for c, t, r, x in turns:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(own.get(c - c % 20, [])[:h] + mine[h:])
    members = defaultdict(list)
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = defaultdict(set)
    for seq in members:
        if seq:
            children[seq[:-1]].add(seq)
    leaves, saved = defaultdict(int), defaultdict(int)
    for seq in members:
        for d in range(len(seq) + 1):
            leaves[seq[:d]] += not children[seq]
            saved[seq[:d]] += (len(members[seq]) - 1) * (len(re.findall(r"[^\x20\x09-\x0D]+", seq[-1][1])) if seq else 0)
    out = []
    for seq, cs in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in cs if len(whole[c]) == len(seq)))
        parent = min(members[seq[:-1]]) if seq else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(cs), len(seq), parent, len(cs), len(children[seq]), leaves[seq], saved[seq], digest))
    return sorted(out, key=str)


def got(df):
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def conversations(rng, n=260):
    rows = [(None, 0, "user", "nobody's turn"), (5, None, None, None), (5, None, "user", ""), (7, 3, "user", "x" * 20000)]
    for c in range(0, n):
        if c % 20 == 0 and rng.random() < 0.3:
            continue
        size = rng.randrange(1, 7)
        if c % 7 == 0:
            rows += [(c, t, "user", f"same {t} words here") for t in range(5)]
        else:
            rows += [(c, t, rng.choice(["user", "tool"]), rng.choice(["hello", "hello there", "a b c", f"own words of {c}"])) for t in range(size)]
    # repeated rows and numbers of turns
    rows += [rows[20], (9, 1, "user", "b"), (9, 1, "user", "a")]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "clash") for r in rows], TURNS)


@pytest.mark.parametrize("limit", [1, 3, 1000])
def test_nodes_equal_brute_force_however_shards_are_cut(spark, monkeypatch, limit):
    monkeypatch.setattr(prefix_trie, "PACKED_TURNS", 40)
    monkeypatch.setattr(prefix_trie, "BLOCK_BITS", 3)
    rows = conversations(random.Random(limit))
    assert got(prefix_trie.trie(frame(spark, rows), limit)) == brute(rows)


def test_long_common_beginning_is_cut_below(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PACKED_TURNS", 10)
    rows = [(c, t, "user", f"line {t}") for c in range(20, 60) for t in range(12)] + [(c, 12, "user", f"tail {c % 9} of it") for c in range(20, 50)]
    assert got(prefix_trie.trie(frame(spark, rows), 2)) == brute(rows)


def test_empty_table(spark):
    assert prefix_trie.trie(frame(spark, [])).count() == 0


def test_double_array_has_just_the_sequences_packed():
    rng = random.Random(2)
    for _ in range(60):
        sequences = sorted({tuple(bytes([rng.randrange(9)]) for _ in range(rng.randrange(6))) for _ in range(rng.randrange(1, 90))})
        trie = prefix_trie.pack([list(s) for s in sequences])
        prefixes = {s[:d] for s in sequences for d in range(len(s) + 1)}
        slots = {}
        for p in prefixes:
            slot = 0
            for turn in p:
                slot = trie.child(slot, turn)
                assert slot is not None
            slots[p] = slot
            assert all((trie.child(slot, bytes([k])) is not None) == ((*p, bytes([k])) in prefixes) for k in range(10))
        assert len(set(slots.values())) == len(prefixes)
        assert sum(c >= 0 for c in trie.check) == len(prefixes) - 1
