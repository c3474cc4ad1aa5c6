"""Duplicates, similar lines, mixing, shards and the pipeline against brute force."""

import os
import random
import zlib
from collections import Counter, defaultdict

import pytest

import check
import corpus_pipeline
from signalflow.llm import exact_dedup, line_join, mixing, order_minhash, sharding
from signalflow.llm.common import components
from signalflow.llm.queries import ORACLES, QUERIES

SF = f"{check.DATA}/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "src1", 0) for i, t in rows], DOCS)


MIXED = [(1, "Abc"), (2, "aBC"), (3, "É"), (4, "é"), (5, None), (6, ""), (7, "long " * 5000), (8, "LONG " * 5000), (2, "aBC"), (None, "abc"), (None, None)]


def test_components(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5), (None, 3)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            ra, rb = root(a), root(b)
            parent[max(ra, rb)] = min(ra, rb)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_exact_groups(spark):
    got = exact_dedup.exact_classes(frame(spark, MIXED)).collect()
    assert len(got) == len(MIXED)
    kept = sorted((str(r.doc_id), r.keep_id, r.group_size) for r in got if r.kept)
    assert kept == [("2", 2, 4), ("3", 3, 1), ("4", 4, 1), ("6", 6, 3), ("8", 8, 2)]
    assert exact_dedup.exact_classes(frame(spark, [])).count() == 0


def test_exact_rows_keep_their_columns(spark):
    docs = frame(spark, MIXED).withColumnRenamed("source", "kept").withColumnRenamed("lang", "digest")
    out = exact_dedup.drop_duplicates(docs)
    assert out.columns == docs.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == ["2", "3", "4", "6", "8"]


# names that the stages use for columns of their own
CLASHING = ("same", "row_sha", "row_content", "copy", "kept_id", "row", "id", "digest", "content", "kept", "gone", "chosen_id", "gone_id")


def test_stages_leave_columns_of_any_name_alone(spark):
    from pyspark.sql import functions as F

    words = " ".join(f"word{i}" for i in range(80))
    rows = [(1, words), (2, words.upper()), (2, words.upper()), (3, words + " and more"), (None, words + " x y"), (4, "other " + " ".join(f"term{i}" for i in range(90)))]
    docs = frame(spark, rows).withColumns({c: F.concat(F.lit(c), F.lit(":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for c in CLASHING})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        found = out.collect()
        assert found, name
        for r in found:
            own = "none" if r.doc_id is None else str(r.doc_id)
            assert all(r[c] == f"{c}:{own}" for c in CLASHING), name
    out = line_join.without_repeats(docs)
    assert out.columns == docs.columns
    assert all(r[c].startswith(f"{c}:") for r in out.collect() for c in CLASHING)


def test_of_repeated_rows_one_stays(spark):
    docs = frame(spark, [(1, "x"), (2, "X"), (2, "X"), (2, "x"), (3, "alone"), (None, None), (None, "")])
    out = [(r.doc_id, r.text) for r in exact_dedup.drop_duplicates(docs).collect()]
    assert len(out) == 3 and {i for i, _ in out} == {2, 3, None}


def copies(rng, base, edits):
    words = base.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_near_classes_by_brute_force(spark):
    rng = random.Random(13)
    rows = []
    for family in range(12):
        base = " ".join(f"w{family}x{rng.randrange(5000)}" for _ in range(rng.choice([30, 120, 400])))
        rows += [copies(rng, base, rng.choice([0, 1, 1, 2, 4, 30])) for _ in range(9)]
    rows += [None, "", "?!", "?!", "short one", "Short, one!", "another"]
    rows = list(enumerate(rows))
    links = defaultdict(set)
    for i, a in rows:
        for j, b in rows:
            if i < j and a and b and (order_minhash.words_of(a) == order_minhash.words_of(b) != [] or order_minhash.similar(a, b)):
                links[i].add(j)
                links[j].add(i)
    want = {}
    for i, _ in rows:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        want[i] = min(seen)
    got = {r.doc_id: r for r in order_minhash.near_classes(frame(spark, rows)).collect()}
    assert {i: r.class_id for i, r in got.items()} == want
    assert all(r.kept == (i == r.class_id) for i, r in got.items())
    sizes = Counter(want.values())
    assert all(r.class_size == sizes[r.class_id] for r in got.values())


def test_pairs_beyond_the_pivots_are_found_exactly(spark, monkeypatch):
    """A large family whose members are unlike beside chains of which only neighbours are alike, with one round of pivots."""
    monkeypatch.setattr(order_minhash, "LEAST_YIELD", 1.0)
    rng = random.Random(23)
    core = [f"c{i}" for i in range(70)]
    rows = [" ".join(core + [f"own{m}x{i}" for i in range(60)]) for m in range(220)]
    for chain in range(3):
        line = [f"l{chain}x{i}" for i in range(400)]
        # each text moves on by a step, so that the ends of a chain share too little
        rows += [" ".join(core[:20] + line[step * 12 : step * 12 + 150]) for step in range(12)]
    rng.shuffle(rows)
    hashes = [order_minhash.shingles(order_minhash.words_of(t)) for t in rows]
    held = [set(h.tolist()) for h in hashes]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = 0
    for a in range(len(rows)):
        for b in range(a):
            if len(held[a] & held[b]) >= 0.6 * min(len(held[a]), len(held[b])) and order_minhash.similar(rows[a], rows[b]):
                links += 1
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    assert links > 30
    rest = []
    exact = order_minhash._rest
    monkeypatch.setattr(order_minhash, "_rest", lambda *a: rest.append(exact(*a)) or rest[-1])
    got = {r.doc_id: r.class_id for r in order_minhash.near_classes(frame(spark, list(enumerate(rows)))).collect()}
    assert got == {i: root(i) for i in range(len(rows))}
    assert rest and rest[0] is not None and rest[0].count() > 0


def test_near_rows_nulls_and_repeats(spark):
    base = " ".join(f"w{i}" for i in range(60))
    docs = frame(spark, [(3, base), (3, base), (None, base + " more"), (4, None), (4, None), (5, base.upper())])
    out = order_minhash.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [3, 4]
    assert order_minhash.near_classes(frame(spark, [])).count() == 0


def test_sketches_of_a_text_with_and_without_a_repeat():
    words = [f"w{i}" for i in range(100)]
    assert set(order_minhash.sketch(words)) & set(order_minhash.sketch(words + words[50:57]))


def test_alignment_by_dynamic_programming():
    import numpy as np

    rng = random.Random(17)
    for _ in range(200):
        x, y = ([rng.randrange(5) for _ in range(rng.randrange(25))] for _ in "xy")
        best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i in range(len(x)):
            for j in range(len(y)):
                best[i + 1][j + 1] = best[i][j] + 1 if x[i] == y[j] else max(best[i][j + 1], best[i + 1][j])
        assert order_minhash.aligned(np.array(x, np.uint64), np.array(y, np.uint64), 50) == best[-1][-1]


def brute_lines(rows):
    first, lines = {}, []
    for i, text in sorted(rows):
        for k, line in enumerate((text or "").split("\n")):
            words = frozenset(w for w in line.replace("\t", " ").split(" ") if w)
            lines.append((i, k, words))
            if words:
                first.setdefault(words, (i, k))
    links = {a: [b for b in first if a != b and 9 * len(a & b) >= 4 * (len(a) + len(b))] for a in first}
    out = {i: [0, 0, 0, [], i] for i, _ in rows}
    for i, k, words in lines:
        if words:
            earliest = min([first[words]] + [first[b] for b in links[words]])
            out[i][0] += 1
            out[i][2] += len(links[words])
            out[i][4] = min(out[i][4], earliest[0])
            if earliest < (i, k):
                out[i][1] += 1
                out[i][3].append(k)
    return {i: (a, b, c, ",".join(map(str, d)), e) for i, (a, b, c, d, e) in out.items()}


def test_similar_lines_by_brute_force(spark):
    rng = random.Random(19)
    pool = [[rng.choice(["the", "of", "and"] + [f"v{x}" for x in range(60)]) for _ in range(rng.choice([1, 3, 4, 5, 6, 12, 25]))] for _ in range(30)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randrange(7)):
            line = list(rng.choice(pool))
            for _ in range(rng.choice([0, 0, 1, 2])):
                line[rng.randrange(len(line))] = f"v{rng.randrange(60)}"
            lines.append(" ".join(line))
        rows.append((i, "\n".join(lines)))
    rows += [(60, None), (61, ""), (62, " \t\n\n")]
    got = {r.doc_id: (r.n_lines, r.n_removed, r.n_links, r.removed_lines, r.class_id) for r in line_join.line_verdicts(frame(spark, rows)).collect()}
    want = brute_lines(rows)
    assert got == want
    clean = {r.doc_id: r.text for r in line_join.without_repeats(frame(spark, rows)).collect()}
    for i, text in rows:
        gone = {int(k) for k in want[i][3].split(",") if k}
        assert clean[i] == (None if text is None else "\n".join(v for k, v in enumerate(text.split("\n")) if k not in gone))


def test_lines_of_repeated_rows_and_none(spark):
    got = line_join.line_verdicts(frame(spark, [(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e f")])).collect()
    # a row without id comes first; the rows with one id and text are one document
    assert sorted((str(r.doc_id), r.n_removed) for r in got) == [("1", 1), ("1", 1), ("None", 0)]
    assert line_join.line_verdicts(frame(spark, [])).count() == 0


def test_unlike_lines_end_in_the_candidate_join(spark, monkeypatch):
    seen, verify = [], line_join.verify
    monkeypatch.setattr(line_join, "verify", lambda pairs, values: (seen.append(pairs.count()), verify(pairs, values))[1])
    # 60 lines of 100 words, of which each has 10 of its own and two share about 81; a match needs 89
    words = [[f"w{j}" if (j * 7 + i * 13) % 100 >= 10 else f"own{i}-{j}" for j in range(100)] for i in range(60)]
    rows = [(i, " ".join(w)) for i, w in enumerate(words)] + [(100, "\t".join(words[0][:99] + ["other"]) + "\x0b \r")]
    got = {r.doc_id: r.n_links for r in line_join.line_verdicts(frame(spark, rows)).collect()}
    sets = {i: set(t.split()) for i, t in rows}
    assert got == {i: sum(9 * len(a & b) >= 4 * (len(a) + len(b)) for j, b in sets.items() if j != i) for i, a in sets.items()}
    assert seen[0] < sum(got.values()) / 2 + 300  # of 1,830 pairs


def test_links_of_near_copies_are_counted_not_made(spark, monkeypatch):
    rng = random.Random(23)
    bases = [[f"b{j}" for j in range(60)], [f"b{j}" for j in range(52)] + [f"c{j}" for j in range(8)], [f"d{j}" for j in range(12)]]
    lines = []
    for base, copies in zip(bases, (90, 50, 40)):
        for _ in range(copies):
            line = list(base)
            for _ in range(rng.randrange(len(base) // 5)):
                # some edits are shared
                line[rng.randrange(len(line))] = rng.choice(["", f"x{rng.randrange(4)}", f"y{rng.randrange(10**6)}"])
            lines.append(" ".join(line))
    rng.shuffle(lines)
    rows = [(i, "\n".join(lines[i::30])) for i in range(30)] + [(30, lines[0])]
    want = brute_lines(rows)
    sets = {frozenset(line.split()) for line in lines}
    links = sum(9 * len(a & b) >= 4 * (len(a) + len(b)) for a in sets for b in sets if a != b) // 2
    assert links > 4000
    for family in (line_join.FAMILY, 2):
        monkeypatch.setattr(line_join, "FAMILY", family)
        got = {r.doc_id: (r.n_lines, r.n_removed, r.n_links, r.removed_lines, r.class_id) for r in line_join.line_verdicts(frame(spark, rows)).collect()}
        assert got == want
        made = line_join.similar_lines(frame(spark, rows))[1]
        assert made.count() == made.distinct().count() < links / 3


def test_budgets_go_to_siblings_before_ancestors(spark):
    leaves = spark.createDataFrame(
        [("a", "x", "1", 10), ("a", "x", "2", 1000), ("a", "y", "3", 5), ("b", "x", "4", 1000), ("c", "x", "5", 0)],
        "domain string, lang string, source string, supply long",
    )
    weights = {"domain": {"a": 1, "b": 1}, "lang": {}, "source": {}}
    got = {r.source: r.budget for r in mixing.budgets(leaves, 900, 1, mixing.LEVELS, weights).collect()}
    # c has nothing, so a and b share 450 each; y gives its 5, x the rest of a; source 1 its 10 and source 2 the rest of x
    assert got == {"1": 10, "2": 435, "3": 5, "4": 450, "5": 0}
    off = {r.source: r.budget for r in mixing.budgets(leaves, 900, 1, mixing.LEVELS, weights | {"domain": {"a": 0}}).collect()}
    assert off == {"1": 0, "2": 0, "3": 0, "4": 900, "5": 0}


def test_mixing_edge_rows(spark):
    rows = [(i, "w " * (i % 5), "en" if i % 2 else None, f"src{i % 20}" if i % 3 else None, 0) for i in range(80)] + [(None, None, None, None, None)] * 3
    docs = spark.createDataFrame(rows + rows[:5], DOCS)
    got = mixing.mixed_documents(docs, 0.5, 2).collect()
    assert len(got) == len(rows) + 5
    total = sum(r.n_tokens for r in got)
    taken = sum(r.n_tokens * r.copies for r in got)
    assert taken <= total * 0.5 and max(r.copies for r in got) <= 2
    assert mixing.mixed_documents(docs.limit(0), 0.5, 2).count() == 0
    out = mixing.deliver(docs, 0.5, 2)
    assert out.columns == docs.columns and out.count() == sum(r.copies for r in got)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 40, 41, 997])
def test_shards(spark, n):
    rows = [(i // 2 if i % 7 else None, None if i % 5 == 0 else f"tëxt {i}") for i in range(n)]
    got = sharding.shard_documents(frame(spark, rows)).collect()
    assert len(got) == n
    sizes = Counter(r.shard for r in got)
    if n:
        assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(40)) <= 1
        assert sorted((r.shard, r.slot) for r in got) == sorted((s, k) for s in sizes for k in range(sizes[s]))
    texts = Counter((str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((str(r.doc_id), r.size, r.text_crc32) for r in got) == texts
    again = sharding.shard_documents(frame(spark, rows[::-1])).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not there")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    assert check.differences(QUERIES[name](spark, SF).toPandas(), check.connect(SF).sql(ORACLES[name]).df()) is None


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not there")
def test_pipeline_by_brute_force(spark):
    from pyspark.sql import functions as F

    from signalflow.llm import quality

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clash = docs.withColumn("kept", F.lit("x"))
    rows = [r.asDict() for r in docs.collect()]
    good = {r["doc_id"]: r for r, k in zip(rows, quality._measure([r["text"] for r in rows])["kept"]) if k}
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    by_text = {}
    for i in sorted(good):
        by_text[good[i]["text"].translate(lower)] = i
    single = {i: good[i] for i in by_text.values()}
    parent = {i: i for i in single}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    shingled = {i: set(order_minhash.shingles(order_minhash.words_of(r["text"])).tolist()) for i, r in single.items()}
    for a in single:
        for b in single:
            if a < b and len(shingled[a] & shingled[b]) >= 0.7 * min(len(shingled[a]), len(shingled[b])):
                if order_minhash.similar(single[a]["text"], single[b]["text"]):
                    ra, rb = root(a), root(b)
                    parent[max(ra, rb)] = min(ra, rb)
    distinct = {i for i in single if root(i) == i}

    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, frames[-1], SF)
        frames.append(spark.createDataFrame(made.collect(), made.schema))
    ids = [sorted(r.doc_id for r in f.select("doc_id").collect()) for f in frames]
    assert ids[1] == sorted(good) and ids[2] == sorted(single) and ids[3] == sorted(distinct)
    assert set(ids[4]) < set(ids[3]) and len(set(ids[4])) == len(ids[4])
    assert all(f.columns == docs.columns for f in frames[:5])
    last = frames[5].collect()
    assert sorted(r.doc_id for r in last) == ids[4] and all(r.round_trip for r in last)
    assert corpus_pipeline.STAGES[0][1](spark, clash, SF).columns == clash.columns


def test_pipeline_of_nothing(spark):
    docs = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
