"""Two tokenizers' ids of one text, aligned where tokens of both end at one byte."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, cached_property
from operator import itemgetter

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from changeflow.llm.bpe import byte_bpe
from changeflow.llm.common import settled
from changeflow.llm.pretokens import gathered, unknown_points

_BYTE = re.compile("<0x([0-9A-F]{2})>")
#: Characters of a chunk of documents; a longer text makes a chunk of its own.
CHUNK = 1 << 20
#: Bits of the second id in the number of a pair of ids, and of a chunk's number in its task.
_B_BITS, _CHUNK_BITS = 32, 32


def common_slices(ends_a: list[int], ends_b: list[int]) -> tuple[list[int], list[int]]:
    """Where two lists of cumulative ends, each strictly rising, agree: for every common end,
    in order, how many tokens of each side lie before it."""
    index_a = dict(zip(ends_a, range(1, len(ends_a) + 1)))
    index_b = dict(zip(ends_b, range(1, len(ends_b) + 1)))
    common = sorted(index_a.keys() & index_b.keys())
    if len(common) < 2:
        return [index_a[e] for e in common], [index_b[e] for e in common]
    pick = itemgetter(*common)
    return list(pick(index_a)), list(pick(index_b))


class Vocabulary:
    """The bytes of all tokens in a row, and the start and length of each."""

    def __init__(self, tokens: list[bytes]):
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def joined(self, ids: np.ndarray) -> bytes:
        return self.data[gathered(self.starts[ids], self.lengths[ids])].tobytes()


class Aligner:
    """Tables of one byte-level vocabulary (A) and one piece vocabulary (B)."""

    def __init__(self, path_a: str, path_b: str):
        self.path_a = path_a
        self.library = Tokenizer.from_file(path_a)
        self.library.encode_special_tokens = True
        self.pieces = SentencePieceProcessor(model_file=path_b)

    @cached_property
    def a(self) -> Vocabulary:
        return Vocabulary(byte_bpe(self.path_a).token)

    @cached_property
    def b(self) -> Vocabulary:
        pieces = self.pieces
        names = [pieces.id_to_piece(i) for i in range(pieces.get_piece_size())]
        return Vocabulary(
            [
                bytes([int(_BYTE.fullmatch(n).group(1), 16)]) if pieces.is_byte(i) else n.replace("▁", " ").encode()
                for i, n in enumerate(names)
            ]
        )

    @cached_property
    def by_rank(self) -> tiktoken.Encoding | None:
        """The same encoder for vocabularies whose merged tokens are numbered in the order of
        their merges: there the id is the rank.  None for others."""
        model = byte_bpe(self.path_a)
        merged = sorted((rank, made) for rank, made in model.merges.values())
        if [made for _, made in merged] != sorted({made for _, made in merged}):
            return None
        return tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=model.id_of, special_tokens={}
        )

    def ids_a(self, text: str) -> np.ndarray:
        if self.by_rank is None or unknown_points(text):  # its tables may know other letters
            return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.int64)
        return self.by_rank.encode_to_numpy(text, disallowed_special=()).astype(np.int64)

    @cached_property
    def decimals(self) -> list[str]:
        """Each id with what follows it in the listed groups: a comma, a bar or a semicolon."""
        top = max(len(self.a.lengths), len(self.b.lengths))
        return [f"{i}{sign}" for i in range(top) for sign in ",|;"]


@cache
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


@dataclass
class Aligned:
    """One text: the ids of both, tokens of each up to each group's end, and the ids of each
    pair of tokens whose bytes overlap."""

    a: np.ndarray
    b: np.ndarray
    upto_a: np.ndarray
    upto_b: np.ndarray
    pairs: np.ndarray

    @property
    def figures(self) -> tuple[int, int, int, int]:
        return len(self.a), len(self.b), len(self.upto_a), len(self.pairs)


_NONE = np.zeros(0, dtype=np.int64)


def align_text(tables: Aligner, text: str | None) -> Aligned:
    """Groups and links of a text; none if either side's bytes are not a space and the text."""
    nothing = Aligned(_NONE, _NONE, _NONE, _NONE, _NONE)
    if not text:
        return nothing
    a = tables.ids_a(f" {text}")
    b = np.array(tables.pieces.encode(text), dtype=np.int64)
    whole = f" {text}".encode()
    if tables.a.joined(a) != whole or tables.b.joined(b) != whole:
        return nothing
    ends_a, ends_b = np.cumsum(tables.a.lengths[a]), np.cumsum(tables.b.lengths[b])
    upto_a, upto_b = (np.array(u, dtype=np.int64) for u in common_slices(ends_a.tolist(), ends_b.tolist()))
    # Within a slice no inner ends agree, so each end of either side closes one more link:
    # that of the tokens which hold the byte before it.
    ends = np.sort(np.concatenate([ends_a, np.delete(ends_b, upto_b - 1)]))
    pairs = a[np.searchsorted(ends_a, ends)] << _B_BITS | b[np.searchsorted(ends_b, ends)]
    return Aligned(a, b, upto_a, upto_b, pairs)


def listed(tables: Aligner, done: Aligned) -> str:
    """The groups as text: ids of A by commas, a bar, ids of B; groups by semicolons."""
    n = len(done.a) + len(done.b)
    if not n:
        return ""
    before_a, before_b = (np.concatenate([[0], u[:-1]]) for u in (done.upto_a, done.upto_b))
    codes = np.empty(n, dtype=np.int64)
    group_a = np.repeat(before_b, done.upto_a - before_a)
    codes[np.arange(len(done.a)) + group_a] = 3 * done.a
    codes[np.arange(len(done.b)) + np.repeat(done.upto_a, done.upto_b - before_b)] = 3 * done.b
    codes[done.upto_a + before_b - 1] += 1
    codes[done.upto_a + done.upto_b - 1] += 2
    sign = tables.decimals
    return "".join([sign[c] for c in codes.tolist()])[:-1]


@dataclass
class Chunk:
    """Some documents aligned: the distinct ``pairs`` of all with the number of documents that
    hold each; for each document the places of its distinct pairs in ``pairs`` and how often
    it has each."""

    texts: list[Aligned]
    pairs: np.ndarray
    holding: np.ndarray
    places: list[np.ndarray]
    times: list[np.ndarray]


def align_texts(tables: Aligner, texts: list[str | None]) -> Chunk:
    done = [align_text(tables, t) for t in texts]
    links = [d.pairs for d in done]
    pairs, at = np.unique(np.concatenate([*links, _NONE]), return_inverse=True)
    document = np.repeat(np.arange(len(done)), [len(p) for p in links])
    keys, times = np.unique(document * max(1, len(pairs)) + at, return_counts=True)
    document, place = np.divmod(keys, max(1, len(pairs)))
    cuts = np.searchsorted(document, np.arange(1, len(done)))
    holding = np.bincount(place, minlength=len(pairs))
    return Chunk(done, pairs, holding, np.split(place, cuts), np.split(times, cuts))


def _chunks(texts: list[str | None]) -> Iterator[slice]:
    begin = size = 0
    for k, t in enumerate(texts):
        if size and size + len(t or "") > CHUNK:
            yield slice(begin, k)
            begin, size = k, 0
        size += len(t or "") + 1
    if begin < len(texts):
        yield slice(begin, len(texts))


def align(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", with_groups: bool = False
) -> DataFrame:
    """One row per input row: ``id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256`` and, ``with_groups``, ``groups`` as the digest reads them.

    A text is encoded by A with a space before it and by B, which adds one; special strings
    are plain text.  Groups end where tokens of both end; links are the pairs of tokens whose
    bytes overlap.  A pair's count is the number of rows that hold it linked; ``n_best`` are the
    links whose count is the highest of their A id, ties included.  NULL and empty texts, and those that either
    tokenizer does not give back byte by byte, have zeros and an empty digest.  Repeated rows
    count each; ids may repeat or be NULL.

    Documents are worked on in chunks.  A chunk sends its distinct pairs with their counts,
    not its links, to be summed, and gets back the sums of these pairs alone.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    id_field = rows.schema["id"]
    long_names = ("n_a", "n_b", "n_groups", "n_links")
    digest = [T.StructField("groups_sha256", T.StringType())]
    if with_groups:
        digest.append(T.StructField("groups", T.StringType()))
    # A row for each chunk holds its pairs; the others are documents.
    schema = T.StructType(
        [
            T.StructField("chunk", T.LongType()), id_field, *(T.StructField(n, T.LongType()) for n in long_names), *digest,
            T.StructField("places", T.BinaryType()), T.StructField("times", T.BinaryType()),
            T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("holding", T.ArrayType(T.LongType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = aligner(path_a, path_b)
        number = TaskContext.get().partitionId() << _CHUNK_BITS
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for part in _chunks(texts):
                done = align_texts(tables, texts[part])
                groups = [listed(tables, d) for d in done.texts]
                figures = [d.figures for d in done.texts]
                n = part.stop - part.start
                columns = {
                    "chunk": pa.array([number] * (n + 1), pa.int64()),
                    "id": pa.concat_arrays([pa.nulls(1, batch.column("id").type), batch.column("id").slice(part.start, n)]),
                    **{c: pa.array([None, *(f[k] for f in figures)], pa.int64()) for k, c in enumerate(long_names)},
                    "groups_sha256": pa.array([None, *(hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups)], pa.string()),
                    "places": pa.array([None, *(p.astype("<i4").tobytes() for p in done.places)], pa.binary()),
                    "times": pa.array([None, *(t.astype("<i4").tobytes() for t in done.times)], pa.binary()),
                    "pairs": pa.array([done.pairs, *[None] * n], pa.list_(pa.int64())),
                    "holding": pa.array([done.holding, *[None] * n], pa.list_(pa.int64())),
                }
                if with_groups:
                    columns["groups"] = pa.array([None, *groups], pa.string())
                yield pa.RecordBatch.from_arrays([columns[f.name] for f in schema.fields], names=schema.fieldNames())
                number += 1

    chunks = settled(rows.mapInArrow(run, schema), "aligned")
    held = chunks.where("pairs IS NOT NULL").select("chunk", F.explode(F.arrays_zip("pairs", "holding")).alias("p"))
    held = held.select("chunk", F.col("p.pairs").alias("pair"), F.col("p.holding").alias("holding"))
    counts = settled(held.groupBy("pair").agg(F.sum("holding").alias("count")), "counts")
    first = F.shiftrightunsigned("pair", _B_BITS)
    highest = counts.groupBy(first.alias("first")).agg(F.max("count").alias("highest"))
    best = counts.withColumn("first", first).join(highest, "first").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    asked = held.select(F.col("chunk").alias("asking"), "pair").join(best, "pair")
    documents = chunks.where("pairs IS NULL").drop("pairs", "holding")
    result = T.StructType(
        [id_field, *(T.StructField(n, T.LongType()) for n in (*long_names, "n_best", "count_sum")), *digest]
    )

    def summed(own: pa.Table, found: pa.Table) -> pa.Table:
        """The figures of one chunk's documents; ``found`` has its pairs, in the order of places."""
        found = found.sort_by("pair")
        count = found.column("count").to_numpy()
        best = found.column("best").to_numpy(zero_copy_only=False)
        n_best, count_sum = [], []
        for places, times in zip(own.column("places").to_pylist(), own.column("times").to_pylist(), strict=True):
            at, often = np.frombuffer(places, "<i4"), np.frombuffer(times, "<i4").astype(np.int64)
            n_best.append(int(often[best[at]].sum()))
            count_sum.append(int((often * count[at]).sum()))
        columns = {"n_best": pa.chunked_array([pa.array(n_best, pa.int64())]), "count_sum": pa.chunked_array([pa.array(count_sum, pa.int64())])}
        return pa.table({f.name: columns[f.name] if f.name in columns else own.column(f.name) for f in result.fields})

    return documents.groupBy("chunk").cogroup(asked.groupBy("asking")).applyInArrow(summed, result)
