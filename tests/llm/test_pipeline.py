import collections
from pathlib import Path

import __spark_entry__ as registered
import corpus_pipeline
import pytest

from changeflow.llm import simhash

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, docs.count()
    ids = {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.settled(stage(spark, docs, SF_DIR), name)
        assert docs.columns == columns
        left = {r.doc_id for r in docs.collect()}
        assert left <= ids and docs.count() <= before
        ids, before = left, docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert {r.doc_id for r in packed} == ids
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).select("doc_id", "piece", "length", "ids_crc32").collect())) == sorted(
        (r.doc_id, r.piece, r.length, r.ids_crc32) for r in packed
    )


@pytest.mark.parametrize("number", range(1, 14))
def test_every_operator_is_registered_and_runs(spark, number):
    name = next(n for n in registered.queries() if n.startswith(f"op{number}_"))
    found = registered.queries()[name](spark, SF_DIR)
    source = {4: "pages", 6: "embeddings", 11: "embeddings"}.get(number, "documents")
    assert found.count() >= spark.read.parquet(f"{SF_DIR}/{source}.parquet").count()


def near_components(texts, similarity=0.8, size=5):
    """id -> smallest id of its group, by comparing all shingle sets that share a shingle."""
    sets = {}
    for key, text in texts.items():
        words = (text or "").encode().lower().split()
        sets[key] = {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()
    root = {key: key for key in texts}

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    holding = collections.defaultdict(list)
    for key in sorted(sets):
        own = sets[key]
        common = collections.Counter(other for s in own for other in holding[s])
        if not own:
            common = {other: 0 for other in holding[None]}
        for other, n in common.items():
            if not own or n >= similarity * (len(own) + len(sets[other]) - n):
                a, b = find(key), find(other)
                root[max(a, b)] = min(a, b)
        for s in own or {None}:
            holding[s].append(key)
    return {key: find(key) for key in texts}


def test_near_copies_of_the_documents(spark):
    """The stage against all pairs: nothing goes that has no near copy, and few copies stay."""
    table = spark.read.parquet(SF_DIR.replace("0.001", "0.01") + "/documents.parquet")
    texts = {r.doc_id: r.text for r in table.collect()}
    low = near_components(texts)
    left = {r.doc_id for r in simhash.near_dedup(table).collect()}
    expected = {k for k in texts if low[k] == k}
    assert expected <= left
    assert len(left - expected) <= 0.02 * (len(texts) - len(expected))


def test_stages_against_plain_python(spark):
    """Exact copies, near copies just above and below the similarity, short and empty texts."""
    import random

    random.seed(21)
    words = [f"word{k}" for k in range(3000)]
    rows, at = [], 0
    for _ in range(60):
        text = [random.choice(words) for _ in range(random.choice([120, 200, 400]))]
        for changed in (0, 0, 0.010, 0.020, 0.06, 0.12):
            near = list(text)
            for k in random.sample(range(len(near)), int(changed * len(near))):
                near[k] = "other"
            rows.append((at, " ".join(near)))
            at += 1
    rows += [(at + k, t) for k, t in enumerate([None, "", " ", "one", "one", "Two words", "two  WORDS", "a b c d e", "a b c d e f"])]
    rows = [(k, t, "en", "s", len(t or "")) for k, t in rows]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    exact = corpus_pipeline.settled(corpus_pipeline.exact_stage(spark, table, SF_DIR), "exact")
    firsts = {}
    for k, t, *_ in rows:
        firsts.setdefault(t or "", k)
    assert {r.doc_id for r in exact.collect()} == set(firsts.values())
    left = {r.doc_id for r in corpus_pipeline.simhash_stage(spark, exact, SF_DIR).collect()}
    low = near_components({k: t for t, k in firsts.items()})
    expected = {k for k in low if low[k] == k}
    assert expected <= left and len(left - expected) <= 0.02 * (len(low) - len(expected)) + 1
