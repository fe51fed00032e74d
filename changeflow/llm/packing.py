"""Best-fit packing of token sequences: a configuration linear program over lengths."""

from __future__ import annotations

import bisect
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from changeflow.llm.bpe import _bytes_of_signs, remembered
from changeflow.llm.common import handed_back, settled, shuffle_width
from changeflow.llm.pretokens import chunked, cut_blanks, gathered

CAPACITY = 4096
END_ID = 1
#: Rounds of the multiplicative weights method.
ROUNDS = 120

# -- tokens ------------------------------------------------------------------------


@cache
def _library(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


#: Words of Latin-1 letters: normal forms and cases are the same in every Unicode version.
#: A run of ASCII signs after them is a pre-token of its own.
_SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")


@cache
def _signs() -> dict[int, str]:
    return {b: s for s, b in _bytes_of_signs().items()}


def encode_texts(path: str, texts: list[str]) -> Iterator[np.ndarray]:
    """The ids of each text, from the library, word by word.

    White space only separates for this tokenizer, so the ids of a text are those of
    its words in a row; words met before are not encoded again.
    """
    library = _library(path)
    words = remembered("words", path)

    def model(word: str) -> bytes:
        signs = word.encode().decode("latin-1").translate(_signs())
        return np.array([t.id for t in library.model.tokenize(signs)], dtype=np.uint32).tobytes()

    def encoded(part: str) -> bytes:
        simple = _SIMPLE.fullmatch(part)
        if simple:
            word, sign = simple.groups()
            return b"".join(words.of([word.lower(), sign] if sign else [word.lower()], model))
        return np.array(library.encode(part, add_special_tokens=False).ids, dtype=np.uint32).tobytes()

    for chunk in chunked(texts):
        cut = cut_blanks(texts[chunk])
        found = [encoded(part) for part in cut.words]
        flat = np.frombuffer(b"".join(found), dtype="<u4")
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        used = lengths[cut.codes]
        ids = flat[gathered((np.cumsum(lengths) - lengths)[cut.codes], used)]
        ends = np.concatenate([[0], np.cumsum(used)])[np.concatenate([[0], cut.ends])]
        for k in range(len(ends) - 1):
            yield ids[ends[k] : ends[k + 1]]


def pieces(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
    id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True,
) -> DataFrame:
    """Each document's ids and the end id, cut where they pass the capacity:
    ``id, piece, start, length, ids_crc32`` and, ``with_ids``, ``ids``."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    fields = [
        rows.schema["id"],
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            place, piece, start, length, crc, kept = [], [], [], [], [], []
            for k, ids in enumerate(encode_texts(path, batch.column("text").to_pylist())):
                ids = np.concatenate([ids, end])
                for n, at in enumerate(range(0, len(ids), capacity)):
                    own = ids[at : at + capacity]
                    place.append(k)
                    piece.append(n)
                    start.append(at)
                    length.append(len(own))
                    crc.append(zlib.crc32(own))
                    if with_ids:
                        kept.append(own.astype(np.int32))
            columns = [
                batch.column("id").take(pa.array(place, type=pa.int64())),
                pa.array(piece, type=pa.int32()),
                *(pa.array(c, type=pa.int64()) for c in (start, length, crc)),
            ]
            if with_ids:
                columns.append(pa.array(kept, type=pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return rows.mapInArrow(handed_back(run), schema)


# -- the plan ------------------------------------------------------------------------


def _best_pattern(price: np.ndarray, stock: np.ndarray, capacity: int) -> np.ndarray:
    """The multiset of lengths of the greatest total price within the capacity, by dynamic
    programming over filled capacities.  Returns counts by length, no more than in stock."""
    worth = np.zeros(capacity + 1)
    last = np.zeros(capacity + 1, dtype=np.int64)
    for c in range(1, capacity + 1):
        # A pattern that fills c ends with length 1..c; length 0 stands for a free token.
        total = worth[c - 1 :: -1][:c] + price[1 : c + 1]
        k = int(total.argmax())
        if total[k] > worth[c - 1]:
            worth[c], last[c] = total[k], k + 1
        else:
            worth[c] = worth[c - 1]
    pattern = np.zeros(capacity + 1, dtype=np.int64)
    c = capacity
    while c > 0:
        if last[c]:
            pattern[last[c]] += 1
            c -= last[c]
        else:
            c -= 1
    return np.minimum(pattern, stock)


@dataclass
class Plan:
    """Patterns with the number of sequences of each.  ``patterns[i]`` lists lengths."""

    patterns: list[tuple[int, ...]]
    times: list[int]
    lower_bound: int

    @property
    def sequences(self) -> int:
        return sum(self.times)


def _best_fit(left: np.ndarray, capacity: int, put) -> None:
    """Best-fit decreasing on counts by length: equal sequences are handled together, so
    the work grows with the number of lengths and not of pieces."""
    room: dict[int, list[list]] = {}  # free tokens -> [pattern, times]
    order: list[int] = []

    def add(free: int, pattern: tuple[int, ...], times: int) -> None:
        if times:
            if free not in room:
                room[free] = []
                bisect.insort(order, free)
            room[free].append([pattern, times])

    for length in range(capacity, 0, -1):
        n = int(left[length])
        while n:
            at = bisect.bisect_left(order, length)
            if at == len(order):
                each = capacity // length
                add(capacity - each * length, (length,) * each, n // each)
                add(capacity - n % each * length, (length,) * (n % each), 1 if n % each else 0)
                break
            free = order[at]
            pattern, times = room[free][-1]
            used = min(n, times)
            if used == times:
                room[free].pop()
                if not room[free]:
                    del room[free]
                    order.pop(at)
            else:
                room[free][-1][1] -= used
            add(free - length, (*pattern, length), used)
            n -= used
    for held in room.values():
        for pattern, times in held:
            put(pattern, times)


def plan(counts: np.ndarray, capacity: int = CAPACITY, rounds: int = ROUNDS) -> Plan:
    """As few sequences as possible for ``counts[length]`` pieces of each length.

    The configuration program asks for numbers x of patterns with, for each length, at
    least its count covered.  Multiplicative weights: each round prices the lengths by
    their weights, finds the best pattern, uses it for a share of what its scarcest length
    still needs, and lowers the weights of what it covers.  The numbers are rounded down
    and best-fit decreasing packs what is left; patterns that leave room are rounded too
    if they leave little.  How little is tried out; none at all counts only where that needs
    strictly fewer sequences.
    """
    counts = counts.astype(np.int64)
    full = np.arange(capacity + 1)
    bound = -(-int((full * counts).sum()) // capacity)
    used = _fractional(counts, capacity, rounds)
    tried = [_rounded(counts, capacity, used, waste) for waste in (*(int(capacity * w) for w in (0.0, 0.005, 0.02, 0.05)), -1)]
    best = min(tried, key=lambda t: sum(t[1]))
    return Plan(*best, bound)


def _fractional(counts: np.ndarray, capacity: int, rounds: int) -> list[tuple[np.ndarray, float]]:
    """Patterns and how often each is used, not yet whole numbers; those used most first."""
    present = counts > 0
    if not present.any():
        return []
    full = np.arange(capacity + 1)
    need = np.maximum(counts, 1).astype(float)
    # Long pieces fit in fewer places: a little dearer by the token.
    weight = np.where(present, full * (1 + 0.2 * full / capacity), 0.0)
    used: dict[bytes, float] = {}
    covered = np.zeros(capacity + 1)
    for _ in range(rounds):
        # A length that has been covered in full asks for no more.
        pattern = _best_pattern(np.where(covered < counts, weight, 0.0), counts, capacity)
        if not pattern.any():
            break
        at = pattern > 0
        step = 0.5 * float((np.maximum(need - covered, 1.0)[at] / pattern[at]).min())
        used[pattern.tobytes()] = used.get(pattern.tobytes(), 0.0) + step
        covered += pattern * step
        weight[at] *= np.exp(-0.1 * pattern[at] * step / need[at])
    return sorted(((np.frombuffer(k, dtype=np.int64), x) for k, x in used.items()), key=lambda e: (-e[1], e[0].tobytes()))


def _rounded(counts: np.ndarray, capacity: int, used: list, waste: int) -> tuple[list[tuple[int, ...]], list[int]]:
    """Patterns and numbers for all pieces; of ``used`` those that leave ``waste`` free at most."""
    left, full = counts.copy(), np.arange(capacity + 1)
    patterns: list[tuple[int, ...]] = []
    times: list[int] = []

    def put(lengths: tuple[int, ...], n: int) -> None:
        patterns.append(lengths)
        times.append(n)

    for pattern, x in used:
        if capacity - int(full @ pattern) > waste:
            continue
        at = pattern > 0
        n = min(int(x), int((left[at] // pattern[at]).min()))
        if n:
            left -= n * pattern
            put(tuple(int(k) for k in np.repeat(full[at], pattern[at])[::-1]), n)
    _best_fit(left, capacity, put)
    return patterns, times


def _slots(made: Plan, capacity: int) -> list[tuple[np.ndarray, ...]]:
    """For each length the runs of its places: number of the first piece, first sequence,
    offset in the sequence."""
    runs: list[list[tuple[int, int, int]]] = [[] for _ in range(capacity + 1)]
    taken = [0] * (capacity + 1)
    base = 0
    for pattern, times in zip(made.patterns, made.times, strict=True):
        offset = 0
        for length in pattern:
            runs[length].append((taken[length], base, offset))
            taken[length] += times
            offset += length
        base += times
    return [np.array(r, dtype=np.int64).reshape(-1, 3) for r in runs]


def packed(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``: all columns of ``pieces``, gapless
    from 0 within a sequence.  Sequences are numbered from 0.

    The histogram, at most ``capacity`` numbers, and the plan made from it are all that
    passes the driver.  Pieces of one length are numbered in hashed groups, so that a
    length that a third of all pieces have is spread over all tasks.  No pieces, no rows.
    """
    cut = settled(cut, "pieces")
    counts = np.zeros(capacity + 1, dtype=np.int64)
    width = shuffle_width(cut.sparkSession)
    # pieces of equal id and number (repeated rows) are told apart by their order only
    grouped = cut.withColumn("part", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(width)).cast("int"))
    sizes = grouped.groupBy("part", "length").count()
    for r in sizes.groupBy("length").agg(F.sum("count").alias("n")).collect():
        counts[r["length"]] = r["n"]
    slots = _slots(plan(counts, capacity), capacity)
    # How many pieces of a length the groups before this one have.
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    own = Window.partitionBy("part", "length").orderBy("id", "piece", "ids_crc32")
    ranked = grouped.repartition(width, "part").withColumn("rank", F.row_number().over(own) - 1)
    numbered = ranked.join(bases, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("base"))
    numbered = numbered.select(*cut.columns, "rank")
    columns = cut.columns
    schema = T.StructType([*cut.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), dtype=np.int64), np.zeros(len(rank), dtype=np.int64)
            for size in np.unique(length):
                at = length == size
                places = slots[size]
                k = np.searchsorted(places[:, 0], rank[at], side="right") - 1
                sequence[at] = places[k, 1] + rank[at] - places[k, 0]
                offset[at] = places[k, 2]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(sequence), pa.array(offset)], names=schema.fieldNames()
            )

    return numbered.mapInArrow(run, schema)


def pack_documents(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
    id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True,
) -> DataFrame:
    """One row per piece: ``id, piece, start, length, ids_crc32[, ids], sequence_id, offset``.

    Only documents longer than the capacity are cut; the last piece may be shorter.  NULL
    text counts as empty: one piece that holds the end id.  Repeated rows are packed as
    often as they come.
    """
    return packed(pieces(docs, path, capacity, end_id, id_col, text_col, with_ids), capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences: ``sequence_id, ids``.  A group has at most ``capacity`` ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(
        F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids")
    )
