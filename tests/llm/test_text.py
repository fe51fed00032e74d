"""Tokens, packing, archives, personal data, toxicity and repeats against brute force."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from changeflow.llm import bpe, packing, pii, repeats, tokens, toxicity, warc

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
SIGNS = [
    "'s", "re", "'ll", " ", "  ", "\n", "\t", "a", "1", "!", "é", "É", "中", "😀", "\0", "<|endoftext|>", "\x1c", "́",
    "Σ", "İ", "͸", "²", "_", "aaaa", "​", "\x85", "ß", "THE", "the,", "The.", "'",
]


def texts(n=1500, seed=1):
    random.seed(seed)
    return ["".join(random.choice(SIGNS) for _ in range(random.randint(0, 30))) for _ in range(n)] + [
        "a" * 20000, "ab" * 9000, " " * 5000, "'" * 3000, "the" * 7000, "\n \n" * 3000, "",
    ]


def test_counts_and_codec_equal_the_library():
    library = Tokenizer.from_file(BYTE)
    all_ = texts()
    expected = [e.ids for e in library.encode_batch(all_, add_special_tokens=False)]
    assert tokens.count_texts(BYTE, all_).tolist() == [len(e) for e in expected]
    found = [ids.tolist() for ids in tokens.encode_texts(BYTE, all_)]
    assert found == expected
    assert [tokens.decode_ids(BYTE, np.array(i, dtype=np.int64)) for i in found] == all_


def test_whole_tokens_are_proved():
    model = bpe.byte_bpe(BYTE)
    assert all(model.merged(t.encode()) == [i] for t, i in list(model.whole.items())[::97])


def test_word_pieces_equal_the_library():
    library = Tokenizer.from_file(WORD)
    all_ = texts(seed=2)
    assert [i.tolist() for i in packing.encode_texts(WORD, all_)] == [
        e.ids for e in library.encode_batch(all_, add_special_tokens=False)
    ]


def test_runs_of_signs_after_words(monkeypatch):
    """As the library has them, from its model alone: each run once, not with each word."""
    library, rnd = Tokenizer.from_file(WORD), random.Random(6)
    signs = [chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum()] + ["'"] * 20
    made = [
        " ".join("".join(rnd.choices("abczstremvldABÄÉß", k=rnd.randint(1, 6)) + rnd.choices(signs, k=rnd.randint(0, 5))) for _ in range(40))
        for _ in range(200)
    ]
    expected = [e.ids for e in library.encode_batch(made, add_special_tokens=False)]
    monkeypatch.setattr(packing, "_library", lambda path: type("Model", (), {"model": library.model}))
    packing.remembered("words", WORD).clear()
    assert [i.tolist() for i in packing.encode_texts(WORD, made)] == expected


def test_token_queries(docs):
    table = docs([(1, "hello world"), (2, None), (2, None), (None, "é")])
    library = Tokenizer.from_file(BYTE)
    found = sorted(map(tuple, tokens.token_counts(table, BYTE).collect()), key=str)
    assert found == sorted([(1, 11, 2), (2, 0, 0), (2, 0, 0), (None, 2, len(library.encode("é").ids))], key=str)
    row = tokens.encoded_texts(table.where("doc_id = 1"), BYTE).first()
    joined = ",".join(map(str, library.encode("hello world").ids))
    assert row.ids_sha256 == hashlib.sha256(joined.encode()).hexdigest() and row.decoded == "hello world"
    assert tokens.token_counts(table.where("false"), BYTE).count() == 0


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_plan_packs_everything_within_capacity(seed):
    rng = np.random.default_rng(seed)
    counts = np.zeros(65, dtype=np.int64)
    counts[1:] = rng.integers(0, 40, 64) * (rng.random(64) < 0.4)
    made = packing.plan(counts, 64, rounds=40)
    packed = np.zeros(65, dtype=np.int64)
    for pattern, times in zip(made.patterns, made.times):
        assert sum(pattern) <= 64
        for length in pattern:
            packed[length] += times
    assert (packed == counts).all()
    # Best fit alone, one piece at a time, is no better.
    bins = []
    for length in sorted(np.repeat(np.arange(65), counts).tolist(), reverse=True):
        free = [b for b in bins if b[0] >= length]
        best = min(free) if free else [64]
        if not free:
            bins.append(best)
        best[0] -= length
    assert made.lower_bound <= made.sequences <= len(bins) + 1


def test_pack_documents(docs):
    random.seed(3)
    rows = [(k, " ".join(random.choice(["the", "cat", "sat."]) for _ in range(random.randint(0, 60)))) for k in range(80)]
    rows += [(200, None), (200, None), (201, ""), (None, "x"), (202, "word " * 700)]
    placed = packing.pack_documents(docs(rows), WORD, capacity=64)
    got = placed.collect()
    library = Tokenizer.from_file(WORD)
    by_doc = collections.defaultdict(list)
    for r in got:
        by_doc[r.id].append(r)
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
    for i, t in dict(rows).items():
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        own = sorted(by_doc[i], key=lambda r: r.piece)
        if i != 200:
            assert [x for r in own for x in r.ids] == ids and [r.start for r in own] == list(range(0, len(ids), 64))
    held = collections.defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    whole = {r.sequence_id: r.ids for r in packing.sequences(placed).collect()}
    assert {s: len(i) for s, i in whole.items()} == {s: sum(n for _, n in p) for s, p in held.items()}
    assert packing.pack_documents(docs(rows).where("false"), WORD).count() == 0


FAKE = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:999>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


@pytest.mark.parametrize("block", ["128m", "1500"])
def test_archives(spark, tmp_path, block):
    rows = [
        (1, "u", f"<p>{FAKE}</p>"), (2, "u", "WARC/1.0"), (3, "u", None), (4, "u", ""), (5, "u", "x" * 200), (6, "u", "x" * 200),
        (7, "u", "x" * 99), (8, "u", "x" * 99), (9, "u\r\nX: y", "WARC/1." * 50), (10, "u", FAKE * 30), (11, None, FAKE),
        (12, "u", "WWARC/1.0WARC/1"), (13, "u", FAKE * 30), (14, "u", "é" * 70), (15, "u", f"\r\n\r\n{FAKE}WARC/"),
        (None, "u", "n" * 150), (16, "u", "n" * 150), (5, "u", "x" * 200),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    folder = str(tmp_path / "archives")
    try:
        warc.write_archives(pages, folder)
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        found = warc.read_archives(spark, folder, with_payload=True).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    first = {}
    for i, _, h in rows:
        if len((h or "").encode()) >= 100 and i is not None:
            first[h] = min(i, first.get(h, i))
    expected = []
    for i, _, h in rows:
        b = (h or "").encode()
        again = h in first and first[h] != i
        expected.append((
            "revisit" if again else "response", None if i is None else str(i), str(first[h]) if again else None, len(b),
            hashlib.sha256(b).hexdigest(), None if again else b,
        ))
    got = [
        (r.type, r.id, r.refers_to, r.payload_bytes, r.payload_digest, None if r.payload is None else bytes(r.payload))
        for r in found
    ]
    assert sorted(got, key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("block", ["128m", "300"])
def test_archives_with_the_magic_in_urls(spark, tmp_path, block):
    urls = ["u", "http://x/WARC/1.", "http://x/WARC/1.0", "WARC/1.a:WARC/1.0 " * 20, "WARC/1.", f"u {FAKE}", "é", None]
    rows = [(k, urls[k % len(urls)], f"{k} {FAKE if k % 3 else 'WARC/1.0'} {'y' * (k * 7 % 200)}") for k in range(64)]
    rows += [(100 + k, "a WARC/1.0", "z" * 150) for k in range(3)]
    folder = str(tmp_path / "archives")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), folder)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        found = warc.read_archives(spark, folder, with_payload=True).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    got = {int(r.id): (r.target, None if r.payload is None else bytes(r.payload).decode()) for r in found}
    assert len(found) == len(rows)
    assert got == {
        i: (re.sub(r"[\r\n]+", " ", u).strip() if u else None, h if i < 101 else None) for i, u, h in rows
    }


def test_archives_cut_short_are_refused(spark, tmp_path):
    folder = tmp_path / "archives"
    rows = [(k, "u", f"page {k}") for k in range(5)]
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), str(folder))
    part = next(folder.glob("part-*"))
    whole = part.read_bytes()
    (tmp_path / "cut").mkdir()
    (tmp_path / "cut" / "part-0.txt").write_bytes(whole[:-30])
    with pytest.raises(ValueError, match="not whole"):
        warc.read_archives(spark, str(tmp_path / "cut"))
    assert warc.read_archives(spark, str(folder)).count() == 5


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(int(c) if k % 2 == 0 else sum(map(int, str(2 * int(c)))) for k, c in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    out = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if (
                kind == "email"
                or kind == "ip" and all(int(x) <= 255 for x in m.group().split("."))
                or kind == "card" and 14 <= len(digits) <= 19 and luhn(digits)
                or kind == "phone" and 10 <= len(digits) <= 15
            ):
                out.append((m.start(), order, m.end(), kind))
    return sorted(out)


def test_pii(docs):
    random.seed(8)
    parts = [
        "@", ".", "a", "b.c", "1", "23", "255", "256", " ", "-", "+", "(", ")", "é", "😀", "..", "%", "4111 1111 1111 1111",
        "+1 (017) 555-7713", "x@y.z", "10.0.0.1", "(212) 555-1234", " bob (at) mail (dot) com ", "4111 1111 1111 1112 ",
    ]
    rows = [(k, "".join(random.choice(parts) for _ in range(random.randint(0, 25)))) for k in range(800)]
    rows += [(9000, None), (9001, ""), (9002, "1.1.1.1 " * 3000), (9003, "a" * 50000), (9004, "a@" + "b." * 20000 + "c"), (None, "x@y.z"), (1, rows[1][1])]
    table = docs(rows)
    found = pii.find_pii(table, carry=True).withColumn("clean", pii.redacted(F.col("row.text"), F.col("spans"))).collect()
    assert len(found) == len(rows)
    for r in found:
        text = r.row.text or ""
        assert [(s.start, s.order, s.end, s.kind) for s in r.spans if s.base] == base_spans(text)
        out, at = "", 0
        for s in sorted(r.spans):
            if s.start >= at:
                out += text[at : s.start] + f"[{s.kind.upper()}]"
            at = max(at, s.end)
        if not any(b.start < a.end for a, b in zip(sorted(r.spans), sorted(r.spans)[1:])):
            assert (r.clean or "") == out + text[at:]
    loose = [s for r in found for s in r.spans if not s.base and s.kind == "email"]
    assert loose, "the looser form of an address is added"
    cleaned = pii.redact_pii(table)
    assert cleaned.columns == table.columns
    assert cleaned.where("text IS NOT NULL AND n_chars != length(text)").count() == 0
    assert pii.redact_pii(table.where("false")).count() == 0
    assert "Python" not in pii.find_pii(table)._jdf.queryExecution().toString()


def test_reliabilities_tell_good_labelers_from_bad():
    random.seed(9)
    counts = collections.Counter()
    for _ in range(4000):
        y = random.random() < 0.6
        votes = tuple((1 if (random.random() < p) == y else -1) for p in (0.95, 0.9, 0.85, 0.5))
        counts[votes] += 1
    share, table = pii.reliabilities(counts)
    assert abs(share - 0.6) < 0.05
    assert table[0][1][1] > 0.9 and abs(table[3][1][1] - table[3][1][0]) < 0.15


def nearest_by_brute_force(model, ids, counts):
    q = np.zeros(len(model.idf))
    q[ids] = model.unit(ids, counts)
    sims = np.round(model.vectors @ q, 12)
    return np.lexsort((np.arange(len(sims)), -sims))[: toxicity.NEIGHBOURS], sims


def test_block_search_is_exact():
    rng = np.random.default_rng(10)
    rows = []
    for k in range(600):
        ids = sorted(rng.choice(40, rng.integers(1, 6), replace=False).tolist())
        rows.append({"id": k, "toxic": int(rng.random() < 0.3), "ids": ids, "counts": rng.integers(1, 5, len(ids)).tolist()})
    model = toxicity.fit(rows, {0: 500, 1: 100}, [f"t{k}" for k in range(40)], rng.integers(1, 300, 40).astype(float), 1000)
    for r in rows[:150]:
        ids, counts = np.array(r["ids"]), np.array(r["counts"])
        at, sims = model.nearest(ids, model.unit(ids, counts))
        best, all_ = nearest_by_brute_force(model, ids, counts)
        best = [k for k in best if all_[k] > 0]
        assert at.tolist() == best and np.allclose(sims, all_[best])


def test_toxicity_learns_from_usable_labels_only(spark, docs):
    random.seed(11)
    words = ["w%d" % k for k in range(300)]
    rows, labels = [], []
    for k in range(400):
        text = [random.choice(words) for _ in range(60)]
        bad = k % 4 == 0
        if bad:
            text[random.randrange(60)] = random.choice(["idiot", "moron", "scum"])
        rows.append((k, " ".join(text)))
        labels.append((k, int(bad)))
    rows += [(1000, None), (1001, ""), (1002, "idiot " * 30000), (None, "moron")]
    marked = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int")
    usable = ~toxicity.held_out(F.col("id"))
    found = toxicity.toxicity(docs(rows), marked, usable, carry=True).collect()
    assert len(found) == len(rows) and found[0].row.lang == "en"
    right = sum(r.predicted == int(r.id % 4 == 0) for r in found if r.id is not None and r.id < 400)
    assert right >= 0.97 * 400
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    assert {r.id: r.predicted for r in found}[1000] == 0
    flipped = marked.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.toxicity(docs(rows), flipped, usable).collect()
    assert {r.id: r.score for r in again} == {r.id: r.score for r in found}
    none = toxicity.toxicity(docs(rows), marked.where("false"), usable)
    assert none.where("predicted = 1").count() == 0
    assert toxicity.toxicity(docs(rows).where("false"), marked, usable).count() == 0


def test_toxicity_keeps_faint_and_many_terms(spark, docs):
    # "drat" is twice as frequent in toxic examples, and 1300 other words tell as well.
    many = " ".join(f"a{k}" for k in range(100, 1400))
    rows = [(f"{many if k < 60 else ''} {'drat' if k % 2 else ''}", 1) for k in range(400)]
    rows += [("drat" if k % 4 == 0 else "other", 0) for k in range(400)]
    found = toxicity._select_terms(spark.createDataFrame(rows, "text string, toxic int"), 400, 400)
    assert {"drat", *many.split()} <= set(found)
    # Equal texts are one example.
    texts = [(k, f"{'drat' if k % 3 else 'fine'} {k}", int(k % 3 > 0)) for k in range(150)]
    texts += [(k, f"drat fine {k}", 0) for k in range(150, 180)]
    labels = spark.createDataFrame([(i, t) for i, _, t in texts], "doc_id long, toxic int")
    scored = toxicity.toxicity(docs([(i, t) for i, t, _ in texts]), labels, F.lit(True)).collect()
    score = {r.id: (r.score, len(r.evidence)) for r in scored}
    assert score[1][1] > 0 and score[1][0] > score[0][0]


def removed_by_brute_force(rows, least=200):
    starts = collections.Counter()
    for _, t in rows:
        b = (t or "").encode()
        starts.update(b[k : k + least] for k in range(len(b) - least + 1))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - least + 1):
            if starts[b[k : k + least]] > 1:
                gone[k : k + least] = b"\1" * least
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("together", [1024, 3])
def test_repeats(docs, monkeypatch, together):
    monkeypatch.setattr(repeats, "TOGETHER", together)
    random.seed(12)
    base = ["".join(random.choice("abcdefgh ") for _ in range(random.randint(100, 900))) for _ in range(12)]
    rows = []
    for k in range(120):
        parts = [
            random.choice([random.choice(base)[random.randint(0, 300) : random.randint(200, 900)], "xyz"[k % 3] * random.randint(0, 150)])
            for _ in range(random.randint(0, 4))
        ]
        rows.append((k, "".join(parts)))
    rows += [
        (900, "a" * 2000), (901, "ab" * 700), (902, None), (903, ""), (904, "é" * 100), (905, "é" * 100), (906, "q" * 199),
        (907, "r" * 200), (None, base[0]), (None, base[0] + "tail"), (910, base[1]), (910, base[1]), (911, "other " + base[2]),
    ]
    table = docs(rows)
    found = repeats.without_repeats(table, with_kept=True)
    assert sorted((tuple(r)[:5] for r in found.collect()), key=str) == removed_by_brute_force(rows)
    assert repeats.without_repeats(table.where("false")).count() == 0


def test_suffix_array_lists_all_occurrences():
    part = bytes(random.Random(13).randbytes(260))
    segments = [b"L" + part + b"1", b"M" + part + b"2", b"N" + part[:230] + b"3", part[5:250] + b"4"]
    found = {}
    for length, at in repeats.SuffixArray(segments, 200).maximal_repeats():
        segment, place = repeats.SuffixArray(segments, 200).places(at)
        found[length] = sorted(zip(segment.tolist(), place.tolist()))
    assert found[260] == [(0, 1), (1, 1)]
    assert found[230] == [(0, 1), (1, 1), (2, 1)]
    assert found[245] == [(0, 6), (1, 6), (3, 0)]
    assert found[225] == [(0, 6), (1, 6), (2, 6), (3, 0)]


def test_texts_that_a_plain_hash_takes_for_equal(docs):
    """Two words alternated as in a Thue-Morse sequence: polynomial hashes modulo 2**64 agree."""
    random.seed(8)
    start = "".join(random.choice("abcdefgh ") for _ in range(348))
    order = [bin(k).count("1") % 2 for k in range(2048)]
    words = ("CpGn", "ODpu")
    rows = [(k, start + "".join(words[o ^ k] for o in order[:138])) for k in (0, 1)]
    rows += [(2 + k, start[:40] + "".join(words[o ^ k] for o in order)) for k in (0, 1)]
    found = repeats.without_repeats(docs(rows))
    assert sorted(map(tuple, found.collect()), key=str) == removed_by_brute_force(rows)


def test_many_equal_pages_and_one_that_ends_otherwise(docs):
    random.seed(9)
    page = "".join(random.choice("abcdefgh ") for _ in range(900))
    rows = [(k, page) for k in range(300)] + [(300, page[:700] + "another end" * 30)]
    found = repeats.without_repeats(docs(rows))
    assert sorted(map(tuple, found.collect()), key=str) == removed_by_brute_force(rows)


def test_the_tree_holds_each_place_once(docs):
    """Nested repeats: as many rows as places, and all occurrences when asked for."""
    random.seed(10)
    long = [bytes(random.Random(k).choices(b"abcdefgh ", k=320)).decode() for k in range(3)]
    texts_ = [f"{k}{long[k % 3][: 210 + 3 * k]}{chr(65 + k)}" for k in range(30)]
    table = docs(list(enumerate(texts_)))
    found = repeats.repeats(table)
    members = found.where("doc IS NOT NULL")
    keys = {r.doc: r.doc_id for r in table.select("doc_id", F.xxhash64("doc_id", "text").alias("doc")).collect()}
    array = repeats.SuffixArray([t.encode() for t in texts_])
    assert len(array.tree()[2]) == len(set(array.tree()[2].tolist()))
    starts = collections.defaultdict(set)
    for k, t in enumerate(texts_):
        for n in {r.length for r in found.collect()}:
            for at in range(len(t) - n + 1):
                starts[t[at : at + n]].add((k, at))
    groups = collections.defaultdict(set)
    for r in repeats.all_occurrences(found).collect():
        k = keys[r.doc]
        groups[texts_[k][r.start : r.start + r.length]].add((k, r.start))
    assert groups and all(starts[t] == found_ for t, found_ in groups.items())
    # A start may come once for each neighbourhood it lies in, but not for every nested repeat.
    assert members.count() < sum(map(len, groups.values())) / 2
