"""Exact and near copies against brute force."""

import hashlib
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from changeflow.llm import common, exact, neighbours, simhash


def groups(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_loops(spark):
    links = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    found = common.components(spark.createDataFrame(links, "a long, b long"))
    expected = groups({n for p in links for n in p}, links)
    assert {r.node: r.root for r in found.collect()} == expected
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("largest", [True, False])
def test_exact_groups(docs, largest):
    random.seed(4)
    texts = [None, "", "a", "b", "long " * 5000, "\x01", "ä" * 100]
    rows = [(i, random.choice(texts)) for i in range(60)] + [(None, "b"), (None, "only"), (7, "twice"), (7, "twice")]
    found = exact.exact_groups(docs(rows), largest=largest).collect()
    assert len(found) == len(rows)
    best = max if largest else min
    for r in found:
        same = [(i, t) for i, t in rows if hashlib.sha256((t or "").encode()).hexdigest() == r.sha]
        ids = [i for i, _ in same if i is not None]
        assert r.group_size == len(same)
        assert r.keep_id == (best(ids) if ids else None)
    for sha in {r.sha for r in found}:
        kept = [r for r in found if r.sha == sha and r.kept]
        assert len(kept) == 1 and kept[0].id == kept[0].keep_id


def test_exact_runs_over_many_ranges(spark):
    # One text holds most rows: it must fill several ranges and stay one group.
    rows = spark.range(5000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("text")
    )
    found = exact.exact_groups(rows)
    assert found.where("group_size > 1").select("keep_id", "group_size").distinct().collect() == [(1, 3333)]
    assert found.where("kept").count() == 5000 - 3333 + 1


def test_exact_dedup_keeps_columns(docs):
    table = docs([(3, "x"), (1, "x"), (2, None), (4, "")])
    kept = exact.exact_dedup(table)
    assert kept.columns == table.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2]
    assert exact.exact_dedup(table.where("false")).count() == 0


def test_no_python_in_exact_dedup(docs):
    plan = exact.exact_groups(docs([(1, "x")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_fingerprint_rule():
    assert simhash.fingerprint(None) == simhash.fingerprint(" \t\n") == 0
    assert simhash.fingerprint("One TWO") == simhash.fingerprint("one two")
    assert simhash.fingerprint("a b c") == int(__import__("xxhash").xxh64_intdigest(b"a b c", 42))


def test_simhash_groups(docs):
    random.seed(5)
    words = ["w%d" % k for k in range(30)]
    base = [[random.choice(words) for _ in range(200)] for _ in range(10)]
    rows = []
    for i in range(120):
        t = list(random.choice(base))
        for _ in range(random.randint(0, 2)):
            t[random.randrange(len(t))] = random.choice(words)
        rows.append((i, " ".join(t)))
    rows += [(500, None), (501, ""), (502, " "), (503, "one"), (503, "one"), (504, "x y " * 30000)]
    codes = [simhash.fingerprint(t) for _, t in rows]
    links = [
        (a, b) for a, b in itertools.combinations(range(len(rows)), 2) if (codes[a] ^ codes[b]).bit_count() <= 3
    ]
    root = groups(range(len(rows)), links)
    low = {r: min(rows[k][0] for k in root if root[k] == r) for r in root.values()}
    expected = sorted((rows[k][0], format(codes[k], "016x"), low[root[k]]) for k in root)
    found = simhash.simhash_groups(docs(rows)).select("id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, found)) == expected
    kept = simhash.simhash_dedup(docs(rows))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(low.values()))


def test_near_dedup_by_similarity(docs):
    random.seed(6)
    words = ["w%d" % k for k in range(4000)]
    rows, copies = [], set()
    for k in range(40):
        text = [random.choice(words) for _ in range(300)]
        rows.append((10 * k, " ".join(text)))
        for n in (1, 2):
            near = list(text)
            for _ in range(4):
                near[random.randrange(300)] = "new"
            rows.append((10 * k + n, " ".join(near)))
            copies.add(10 * k + n)
        far = list(text)
        for at in range(0, 300, 8):
            far[at] = "other"
        rows.append((10 * k + 5, " ".join(far)))
    rows += [(1000, None), (1001, ""), (None, "alone without an id")]
    table = docs(rows)
    kept = simhash.near_dedup(table)
    assert kept.columns == table.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows} - copies - {1001}
    assert simhash.near_dedup(table.where("false")).count() == 0


def similar(sets, similarity=0.8):
    return [
        (a, b) for a, b in itertools.combinations(sorted(sets), 2)
        if len(sets[a] & sets[b]) >= similarity * max(len(sets[a] | sets[b]), 1)
    ]


def test_crowd_links_connect_all_similar_sets(spark):
    """Crowds around common shingles, sizes that differ, pairs at the very similarity, subsets."""
    random.seed(31)
    sets, own = {}, itertools.count(1000)
    for base, least in ((range(40), 0), (range(100, 190), 4), (range(100, 150), 0)):
        for _ in range(60):
            chosen = set(base)
            for s in random.sample(sorted(base), least + random.randrange(len(base) // 5)):
                chosen.discard(s)
                if random.random() < 0.7:
                    chosen.add(next(own) if random.random() < 0.7 else random.randrange(200, 230))
            sets[len(sets)] = chosen
    sets |= {1000: set(), 1001: set(range(500, 504)), 1002: set(range(500, 505)), 1003: {7}, 1004: set(range(600, 609)), 1005: set(range(601, 610))}
    expected = groups(sets, similar(sets))
    table = spark.createDataFrame([(k, sorted(v)) for k, v in sets.items()], "node long, set array<long>").repartition(4)
    for given in (similar(sets)[::7], []):
        links = spark.createDataFrame(given, "a long, b long")
        found = [tuple(r) for r in simhash.crowd_links(table, links, 0.8).collect()]
        assert set(found) <= set(similar(sets))
        assert groups(sets, found + given) == expected


def test_a_crowd_below_the_similarity_is_not_compared_in_pairs(docs, monkeypatch):
    """Texts with words of their own around one text that is not among them."""
    random.seed(32)
    base, rows = [f"w{k}" for k in range(150)], []
    for k in range(600):
        text = list(base)
        for at in random.sample(range(150), random.choice([1, 2, 4, 5, 6])):
            text[at] = f"own{k}x{at}"
        rows.append((k, " ".join(text)))
    compared = []

    def counted(df, purpose):
        out = common.settled(df, purpose)
        if purpose in ("near", "met"):
            compared.append(out.count())
        return out

    monkeypatch.setattr(simhash, "settled", counted)
    low = groups(range(600), similar({k: set(simhash.shingle_hashes(t).tolist()) for k, t in rows}))
    assert {r.doc_id for r in simhash.near_dedup(docs(rows)).collect()} == set(low.values())
    assert sum(compared) <= 30 * len(rows)


def cosine_links(rows, threshold=0.9):
    usable = {
        k: np.array(v, dtype=float)
        for k, (_, v) in enumerate(rows)
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    }
    return [
        (a, b) for a, b in itertools.combinations(usable, 2)
        if len(usable[a]) == len(usable[b])
        and usable[a] @ usable[b] / np.sqrt((usable[a] @ usable[a]) * (usable[b] @ usable[b])) >= threshold
    ]


def test_near_vectors(spark):
    rng = np.random.default_rng(7)
    rows = [(k, rng.standard_normal(16).astype(np.float32).tolist()) for k in range(150)]
    for k in range(60):  # a crowd that fills any list
        rows.append((1000 + k, (np.array(rows[0][1]) + 0.05 * rng.standard_normal(16)).astype(np.float32).tolist()))
    for k in range(40):
        rows.append((2000 + k, (np.array(rows[k + 1][1]) + 0.1 * rng.standard_normal(16)).astype(np.float32).tolist()))
    rows += [(3000 + k, rows[5][1]) for k in range(3)]
    rows += [(4000, None), (4001, []), (4002, [0.0] * 16), (4003, [float("nan")] * 16), (4004, [None] + [1.0] * 15), (4005, [1.0, 2.0]), (4006, [2.0, 4.0])]
    links = cosine_links(rows)
    root = groups(range(len(rows)), links)
    degree = [0] * len(rows)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    found = {r.id: (r.n_links, r.component_id, r.kept) for r in neighbours.near_vectors(table).collect()}
    expected = {i: (degree[k], rows[root[k]][0], rows[root[k]][0] == i) for k, (i, _) in enumerate(rows)}
    right = sum(found[i] == expected[i] for i in expected)
    assert len(found) == len(rows) and right >= 0.98 * len(rows)
    assert neighbours.near_vectors(table.where("false")).count() == 0


def test_near_vectors_links_crowds_that_fill_their_lists(spark):
    rng = np.random.default_rng(8)
    # Three crowds in a chain: 0.92 between neighbours, so the outer two do not link.
    turn = np.arccos(0.92)
    rows = [(k, rng.standard_normal(32).astype(np.float32).tolist()) for k in range(1000, 1200)]
    for c in range(3):
        centre = np.zeros(32)
        centre[:2] = np.cos(c * turn), np.sin(c * turn)
        rows += [(100 * c + k, (centre + 0.005 * rng.standard_normal(32)).astype(np.float32).tolist()) for k in range(50)]
    links = cosine_links(rows)
    degree = {i: 0 for i, _ in rows}
    for a, b in links:
        degree[rows[a][0]] += 1
        degree[rows[b][0]] += 1
    assert degree[0] == 99 and degree[100] == 149
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    found = {r.id: (r.n_links, r.component_id) for r in neighbours.near_vectors(table).collect()}
    assert found == {i: (degree[i], 0 if i < 1000 else i) for i, _ in rows}


def test_audit_counts_links_and_not_roots(spark):
    # Of a vector's links those in the table count, though all its neighbours share a root.
    rows = [(k, [1.0, k / 1000]) for k in range(40)]
    vectors = neighbours.distinct_vectors(spark.createDataFrame(rows, "id long, vector array<float>"))
    nodes = [r.node for r in vectors.orderBy("low").collect()]
    links = spark.createDataFrame([(min(p), max(p)) for p in zip(nodes, nodes[1:])], "a long, b long")
    roots = spark.createDataFrame([(n, min(nodes)) for n in nodes], "node long, root long")
    lists = spark.createDataFrame([], neighbours._edges_schema())
    assert neighbours.audit(vectors, lists, links, roots, 0.9, 12) < 0.06
