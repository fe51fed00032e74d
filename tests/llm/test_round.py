"""Whitening, power-of-two packing and token alignment against brute force."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

import __spark_entry__ as registered
from changeflow.llm import alignment, pow2, spectrum, whitening

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")
SIGNS = [
    "'s", " ", " ", "  ", "\n", "\t", "a", "12", "!", "é", "中", "😀", "\0", "<|endoftext|>", "<s>", "<0x41>", "\x1c", "\x85", "　",
    "ﬁ", "İ", "naturally", "the,", "The.", "pseudocode", "ＡＢ",
]


# -- whitening -------------------------------------------------------------------------


@pytest.mark.parametrize(
    "values", [[9, 7, 5, 3, 2, 1], [4, 4, 4, 1, 1, 0], [5, 5 * (1 - 1e-13), 1, 0, 0, 0], [1] * 6, [1e-8, 1e-9, 0, 0, 0, 0], [0] * 6]
)
def test_slices_find_the_leading_pairs(values):
    q, _ = np.linalg.qr(np.random.default_rng(3).standard_normal((6, 6)))
    matrix = (q * values) @ q.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = spectrum.leading(matrix, 4)
    expected = [v for v in values if v > 0][:4]
    assert np.allclose(found, expected, rtol=1e-12)
    assert np.allclose(vectors.T @ vectors, np.eye(len(found)), atol=1e-14)
    assert np.allclose(matrix @ vectors, vectors * found, atol=1e-13 * max(values + [1e-300]))


def test_counts_of_eigenvalues():
    rng = np.random.default_rng(4)
    for d in (1, 2, 3, 17):
        half = rng.standard_normal((d, d))
        matrix = half + half.T
        values = np.linalg.eigvalsh(matrix)
        shifts = np.concatenate([[values[0] - 1, values[-1] + 1], (values[1:] + values[:-1]) / 2])
        assert [spectrum.above(matrix, s) for s in shifts] == [int((values > s).sum()) for s in shifts]
    # zero diagonal: only blocks of order 2 are sound
    assert spectrum.above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1


def brute_whitened(vectors, components=8):
    x = np.array([[math.floor(1024 * float(np.float64(c))) + 100000 for c in v] for v in vectors], dtype=object)
    n, total = len(x), x.sum(axis=0)
    mean = np.array([s / n for s in total])
    centred = x.astype(float) - mean
    covariance = centred.T @ centred / n
    values, rotation = np.linalg.eigh(covariance)
    values, rotation = values[::-1][:components], rotation[:, ::-1][:, :components]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, total)) for row in x]
    return deviation, centred @ rotation / np.sqrt(values), values / np.trace(covariance)


def test_whitening_equals_brute_force(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    kept = sorted((r.vec_id, r.embedding) for r in table.collect())
    deviation, projected, share = brute_whitened([v for _, v in kept])
    found = collections.defaultdict(dict)
    for r in registered.queries()["op11_spectral_whitening"](spark, "/root/testdata/sf0.01").collect():
        found[r.vec_id][r.component] = r
    assert len(found) == len(kept) and all(sorted(f) == list(range(1, 9)) for f in found.values())
    signs = np.sign([found[kept[0][0]][k].whitened * projected[0][k - 1] for k in range(1, 9)])
    for (key, _), d, row in zip(kept, deviation, projected, strict=True):
        for k, r in found[key].items():
            assert r.n == len(kept) and r.deviation == d and abs(r.identity_error) < 1e-9
            assert abs(r.whitened * signs[k - 1] - row[k - 1]) < 1e-7
            assert abs(r.explained / share[k - 1] - 1) < 1e-9


def test_whitening_of_odd_rows(spark):
    schema = "vec_id long, embedding array<float>, id string, x int, whitened double"
    nan, inf = float("nan"), float("inf")
    good = [(k, [0.1 * k, 1.0 - k * k, -0.5]) for k in range(6)] + [(2, [0.2, -3.0, -0.5]), (None, [7.0, 1.0, 2.0])]
    bad = [(90, None), (91, []), (92, [1.0, None, 2.0]), (93, [nan, 1.0, 1.0]), (94, [inf, 1.0, 1.0]), (95, [1.0, 2.0]), (96, [1e30, 1.0, 1.0])]
    table = spark.createDataFrame([(k, v, "i", 1, 2.0) for k, v in good + bad], schema).repartition(3)
    found = whitening.whitened(table).collect()
    deviation, _, share = brute_whitened([[float(np.float32(c)) for c in v] for _, v in good], 3)
    assert collections.Counter(r.component for r in found) == {k: len(good) for k in (1, 2, 3)}
    assert {r.n for r in found} == {len(good)}
    assert sorted(r.deviation for r in found if r.component == 1) == sorted(deviation)
    assert np.allclose(sorted({r.explained for r in found}, reverse=True), share)
    assert max(r.identity_error for r in found) < 1e-9
    for rows in ([], bad[:5], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert whitening.whitened(spark.createDataFrame([(k, v, "i", 1, 2.0) for k, v in rows], schema)).collect() == []


def test_deviation_beyond_a_long(spark):
    rows = [(k, [float(v), 0.0]) for k, v in enumerate([-(2**40), 2**40, 0, 1])]
    found = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    deviation, _, _ = brute_whitened([v for _, v in rows], 1)
    expected = {k: d if d < 2**63 else None for k, d in enumerate(deviation)}
    assert {r.id: r.deviation for r in found.where("component = 1").collect()} == expected
    assert None in expected.values()


# -- powers of two ---------------------------------------------------------------------


def test_binary_lengths():
    for n in (0, 1, 2, 3, 4095, 4096, 4097, 12345):
        found = list(pow2.binary_lengths(n, 4096))
        assert sum(found) == n and found == sorted(found, reverse=True)
        assert all(k & (k - 1) == 0 and k <= 4096 for k in found)
        assert max(collections.Counter(k for k in found if k < 4096).values(), default=0) <= 1


def checked_pieces(found, rows):
    """Every id of every document lies in one piece; sequences hold one piece each."""
    library = Tokenizer.from_file(WORD)
    wanted = collections.Counter()
    for key, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        at = 0
        for n in pow2.binary_lengths(len(ids), 4096):
            wanted[key, at, n, zlib.crc32(np.array(ids[at : at + n], dtype="<u4").tobytes()), len(ids), 0] += 1
            at += n
        assert at == len(ids)
    assert wanted == collections.Counter((r[0], r.start, r.length, r.ids_crc32, r.doc_tokens, r.offset) for r in found)
    assert len({r.sequence_id for r in found}) == len(found)


def test_pieces_of_odd_rows(docs, tmp_path):
    rows = [(1, None), (2, ""), (3, "one two three"), (3, "one two three"), (None, "é 中 <|endoftext|>"), (4, "word " * 9000)]
    pieces = pow2.decomposed(docs(rows), WORD)
    found = pieces.collect()
    checked_pieces(found, rows)
    assert all(1 << r.bucket == r.length == len(r.ids) for r in found)
    by_number = [r.length for r in sorted(found, key=lambda r: r.sequence_id)]
    assert by_number == sorted(by_number)
    assert pow2.decomposed(docs([]), WORD).collect() == []
    with pytest.raises(ValueError):
        pow2.decomposed(docs(rows), WORD, capacity=1000)
    pow2.write_buckets(pieces, str(tmp_path / "buckets"))
    back = docs([]).sparkSession.read.parquet(str(tmp_path / "buckets"))
    assert sorted((r.bucket, tuple(r.ids)) for r in back.collect()) == sorted((r.bucket, tuple(r.ids)) for r in found)


def test_pieces_of_documents(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = registered.queries()["op12_pow2_packing"](spark, "/root/testdata/sf0.001").collect()
    checked_pieces(found, [(r.doc_id, r.text) for r in table.collect()])


# -- alignment ---------------------------------------------------------------------------


def brute_alignment(rows):
    """Every row by the libraries on whole texts, links by comparing ranges."""
    first, second = Tokenizer.from_file(BYTE), SentencePieceProcessor(model_file=PIECE)
    first.encode_special_tokens = True
    signs = {chr(b): b for b in [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]}
    signs |= {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(signs.values())))}

    def of_b(i):
        piece = second.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()

    def spans(data):
        ends = np.cumsum([len(d) for d in data]).tolist()
        return list(zip([0, *ends], ends))

    done, holding = [], collections.Counter()
    for key, text in rows:
        encoded = first.encode(f" {text}", add_special_tokens=False)
        a, b = encoded.ids, second.encode(text or "")
        data_a, data_b = [bytes(signs[c] for c in first.id_to_token(i)) for i in a], [of_b(i) for i in b]
        whole = f" {text}".encode()
        if not text or b"".join(data_a) != whole or b"".join(data_b) != whole:
            done.append((key, [], [], [], ""))
            continue
        at_a, at_b = spans(data_a), spans(data_b)
        links, low = [], 0
        for i, (s, e) in enumerate(at_a):
            while at_b[low][1] <= s:
                low += 1
            j = low
            while j < len(b) and at_b[j][0] < e:
                links.append((a[i], b[j]))
                j += 1
        common = {e for _, e in at_a} & {e for _, e in at_b}
        cells = [[[]], [[]]]
        for cell, ids, at in zip(cells, (a, b), (at_a, at_b), strict=True):
            for i, (_, e) in zip(ids, at, strict=True):
                cell[-1].append(str(i))
                if e in common:
                    cell.append([])
        groups = [f"{','.join(x)}|{','.join(y)}" for x, y in zip(*cells, strict=True) if x]
        done.append((key, a, b, links, ";".join(groups)))
        holding.update(set(links))
    highest = collections.Counter()
    for (i, _), n in holding.items():
        highest[i] = max(highest[i], n)
    return sorted(
        (
            str(key), len(a), len(b), groups.count(";") + bool(groups), len(links),
            sum(holding[p] == highest[p[0]] for p in links), sum(holding[p] for p in links),
            hashlib.sha256(groups.encode()).hexdigest() if groups else "",
        )
        for key, a, b, links, groups in done
    )


def as_rows(found):
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted((str(r[0]), *(r[n] for n in names)) for r in found.collect())


def test_alignment_of_odd_texts(docs):
    random.seed(5)
    rows = [(k, "".join(random.choice(SIGNS) for _ in range(random.randint(0, 25)))) for k in range(300)]
    rows += [(900, None), (901, ""), (902, " "), (903, "a▁b"), (904, "▁"), (905, " x"), (906, "x "), (907, "a" * 3000), (908, "the same"), (908, "the same"), (None, "the same")]
    found = alignment.align(docs(rows), BYTE, PIECE)
    assert as_rows(found) == brute_alignment(rows)
    assert alignment.align(docs([]), BYTE, PIECE).collect() == []
    assert as_rows(alignment.align(docs([(1, None)]), BYTE, PIECE)) == [("1", 0, 0, 0, 0, 0, 0, "")]
    with_groups = alignment.align(docs(rows), BYTE, PIECE, with_groups=True).collect()
    assert all(hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256 for r in with_groups if r.groups)


def test_counts_meet_across_chunks(docs, monkeypatch):
    rows = [(k, f"the word {k % 7} and pseudocode number {k}") for k in range(200)]
    tables, texts = alignment.aligner(BYTE, PIECE), [t for _, t in rows]
    monkeypatch.setattr(alignment, "CHUNK", 100)
    assert len(list(alignment._chunks(texts))) > 20
    whole = [alignment.align_text(tables, t).figures for t in texts]
    assert whole == [d.figures for d in alignment.align_texts(tables, texts).texts]
    assert as_rows(alignment.align(docs(rows).repartition(40), BYTE, PIECE)) == brute_alignment(rows)


def test_alignment_of_documents(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = registered.queries()["op13_token_alignment"](spark, "/root/testdata/sf0.001")
    assert as_rows(found) == brute_alignment([(r.doc_id, r.text) for r in table.collect()])
