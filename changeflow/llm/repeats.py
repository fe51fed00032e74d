"""Repeated passages: maximal repeats from enhanced suffix arrays, removed from texts.

A window of ``least`` bytes is anchored at the piece of GRAM bytes in it whose hash is
smallest, so equal windows have equal anchors at equal places.  Neighbouring windows with
one anchor make a neighbourhood; anchors that occur once cannot lie in a repeat.  Equal
neighbourhoods are repeats as they stand, counted before they meet.  What is left, the
ends of repeats, goes to suffix arrays, one for each set of anchors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.llm.common import handed_back, settled
from changeflow.llm.neighbours import _bounds, _grouped

LEAST = 200
GRAM = 48
#: Different neighbourhoods of one anchor that share a suffix array; those of anchors with more
#: are compared by halves, which is exact for any number.
TOGETHER = 1024
#: Bytes in one suffix array.
ARRAY_BYTES = 1 << 20
_MULTIPLIER = 0x9E3779B97F4A7C15


# -- anchors -------------------------------------------------------------------------


@cache
def _byte_values() -> np.ndarray:
    return np.random.default_rng(5).integers(0, 2**64, 256, dtype=np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _window_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours: running minima of blocks from both sides."""
    n = len(values)
    padded = np.concatenate([values, np.full(-n % width, 2**64 - 1, dtype=np.uint64)]).reshape(-1, width)
    forth = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], forth[width - 1 : n])


def _gram(least: int) -> int:
    """Bytes of an anchor.  At most 256 windows share one, so that a place needs one byte for
    how many."""
    return min(max(GRAM, least - 255), least)


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Of data[a:b] it is (sums[b] - sums[a]) / base**a, modulo 2**64."""
    n = len(data)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_byte_values()[data] * _powers(_MULTIPLIER, n), out=sums[1:])
    inverse = _powers(pow(_MULTIPLIER, -1, 2**64), n)
    return _mixed((sums[gram:] - sums[:-gram]) * inverse[: n - gram + 1])


def neighbourhoods(data: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, ...]:
    """``first, last`` window of each neighbourhood and the hash of its anchor."""
    gram = _gram(least)
    if len(data) < least:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    grams = _gram_hashes(data, gram)
    least_of = _window_min(grams, least - gram + 1)
    # A new anchor: another value, or the old one has just left the window.
    new = np.empty(len(least_of), dtype=bool)
    new[0] = True
    new[1:] = (least_of[1:] != least_of[:-1]) | (grams[: len(least_of) - 1] == least_of[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(least_of)) - 1
    return first, last, least_of[first].view(np.int64)


def digests(data: bytes, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Two longs, 128 bits of a cryptographic digest, that stand for the bytes of each range:
    no input makes different bytes equal."""
    whole, new = memoryview(data), hashlib.blake2b
    found = [new(whole[a:b], digest_size=16).digest() for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
    return np.frombuffer(b"".join(found), dtype="<i8").reshape(-1, 2)


# -- suffix arrays ----------------------------------------------------------------------


class SuffixArray:
    """Sorted suffixes of some segments, from their possible window starts, with the length
    that neighbours share and the byte before each.

    ``ranks[k]`` numbers all positions by their next ``8 << k`` bytes, in order.  Every
    segment ends in a sign of its own, so no common prefix runs past it.
    """

    def __init__(self, segments: list[bytes], least: int = LEAST):
        lengths = np.array([len(s) for s in segments], dtype=np.int64)
        self.begin = np.cumsum(lengths + 1) - lengths - 1
        data = np.frombuffer(b"\0".join(segments) + b"\0", dtype=np.uint8)
        sign = data.astype(np.int64) + 1
        sign[self.begin + lengths] = 257 + np.arange(len(segments))
        self.sign, self.least = sign, least
        self.segment = np.repeat(np.arange(len(segments)), lengths + 1)
        longest = int(lengths.max()) if len(lengths) else 0
        ranks = [np.unique(sign, return_inverse=True)[1]]
        width = 1
        while width < longest:
            here = ranks[-1]
            after = np.zeros_like(here)
            after[:-width] = here[width:] + 1
            ranks.append(np.unique(here << 32 | after, return_inverse=True)[1])
            width *= 2
        self.ranks = ranks
        starts = [b + np.arange(n - least + 1) for b, n in zip(self.begin, lengths, strict=True) if n >= least]
        starts = np.concatenate(starts) if starts else np.zeros(0, dtype=np.int64)
        self.order = starts[np.argsort(ranks[-1][starts], kind="stable")]
        self.shared = self._shared(self.order[:-1], self.order[1:])
        before = np.where(self.order > 0, sign[self.order - 1], -1)
        # Nothing is known of the byte before a segment: its start counts as different.
        first = self.order == self.begin[self.segment[self.order]]
        self.differs = (before[1:] != before[:-1]) | first[1:] | first[:-1]

    def _shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the common prefixes, from the widest ranks down."""
        out = np.zeros(len(a), dtype=np.int64)
        end = len(self.sign) - 1
        for k in range(len(self.ranks) - 1, -1, -1):
            rank = self.ranks[k]
            same = rank[np.minimum(a + out, end)] == rank[np.minimum(b + out, end)]
            out += same.astype(np.int64) << k
        return out

    def tree(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The maximal repeats as a tree of intervals of ``order``: length and parent (-1: none)
        of each, the places in ``order`` that lie in one, and the deepest one of each.

        One scan with a stack closes the intervals of the common-prefix tree, inner ones
        first.  An interval is a maximal repeat if its occurrences do not all follow the
        same byte; otherwise the repeat one byte further left has it covered, and its places go to
        the interval around it.  Its occurrences are the places in it and in all below it, so
        the tree holds them once each.  Parts of the array without such a difference are
        passed over.
        """
        long = self.shared >= self.least
        edge = np.flatnonzero(np.diff(np.concatenate([[False], long, [False]]).astype(np.int8)))
        differing = np.concatenate([[0], np.cumsum(self.differs)])
        lengths: list[int] = []
        parents: list[int] = []
        places: list[int] = []
        groups: list[int] = []
        for begin, end in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if differing[end] == differing[begin]:
                continue
            stack: list[list] = []  # length, first place, places and repeats not yet in one
            for k, shared in enumerate([*self.shared[begin:end].tolist(), 0], start=begin):
                left, loose, below = k, [k], []
                while stack and stack[-1][0] > shared:
                    length, left, own, inner = stack.pop()
                    loose, below = _joined(own, loose), _joined(inner, below)
                    if differing[k] > differing[left]:
                        group = len(lengths)
                        lengths.append(length)
                        parents.append(-1)
                        for g in below:
                            parents[g] = group
                        places += loose
                        groups += [group] * len(loose)
                        loose, below = [], [group]
                if not shared:
                    continue
                if stack and stack[-1][0] == shared:
                    stack[-1][2], stack[-1][3] = _joined(stack[-1][2], loose), _joined(stack[-1][3], below)
                else:
                    stack.append([shared, left, loose, below])
        return tuple(np.array(x, dtype=np.int64) for x in (lengths, parents, places, groups))

    def maximal_repeats(self) -> Iterator[tuple[int, np.ndarray]]:
        """Length and all positions of each maximal repeat of ``least`` bytes or more."""
        lengths, parents, places, groups = self.tree()
        inside: list[list[int]] = [[] for _ in lengths]
        for place, group in zip(places.tolist(), groups.tolist(), strict=True):
            while group >= 0:
                inside[group].append(place)
                group = int(parents[group])
        for length, own in zip(lengths.tolist(), inside, strict=True):
            yield length, self.order[np.sort(np.array(own, dtype=np.int64))]

    def places(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Segment and place in it of positions."""
        segment = self.segment[at]
        return segment, at - self.begin[segment]


def _joined(a: list, b: list) -> list:
    """Both lists in one, the shorter moved."""
    if len(a) < len(b):
        a, b = b, a
    a.extend(b)
    return a


# -- the operator -------------------------------------------------------------------------


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc, data``: a 64-bit digest of id and text stands for a row.  Rows that repeat both
    have the same passages."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.xxhash64(F.col(f"`{id_col}`"), text).alias("doc"), text.cast("binary").alias("data"), F.col(f"`{id_col}`").alias("id"))


@F.arrow_udf(T.BinaryType())
def _packed(data: pa.Array) -> pa.Array:
    """Texts compressed for the way to another task."""
    packer = zstandard.ZstdCompressor(level=3)
    return pa.array([packer.compress(d.as_buffer()) for d in data], type=pa.binary())


def _unpacked(data: pa.Array) -> Iterator[bytes]:
    unpacker = zstandard.ZstdDecompressor()
    for d in data:
        yield unpacker.decompress(d.as_buffer())


def _long(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.LongType()) for n in names])


def _anchors(rows: DataFrame, least: int, whole: bool) -> DataFrame:
    """``h`` of every neighbourhood, the hash of its anchor, and with ``whole`` also ``u, v,
    doc, place``: the digest of all its bytes and its first window times 256, and how many more
    it has."""
    schema = _long("h", "u", "v", "doc", "place") if whole else _long("h")

    def anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list[np.ndarray]] = [[] for _ in schema.fields]
            for doc, value in zip(batch.column("doc").to_numpy().tolist(), batch.column("data"), strict=True):
                data = value.as_buffer()
                first, last, h = neighbourhoods(np.frombuffer(data, dtype=np.uint8), least)
                own = [h]
                if whole:
                    uv = digests(data, first, last + least)
                    own += [uv[:, 0], uv[:, 1], np.full(len(h), doc), first * 256 + (last - first)]
                for column, values in zip(columns, own, strict=True):
                    column.append(values)
            if columns[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], names=schema.fieldNames())

    return rows.select("doc", "data").mapInArrow(handed_back(anchored), schema)


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """Maximal repeats, each occurrence once: ``group, parent, doc, start, length``.

    Rows with ``doc`` say that a repeat starts there, the longest of those that do; ``doc`` is a
    digest of id and text, places are bytes.  Rows without ``doc`` say that whatever lies in
    ``group`` also lies in the shorter repeat ``parent``, of this ``length``;
    ``all_occurrences`` follows them.  A repeat that goes on over several neighbourhoods comes as
    overlapping parts; of neighbourhoods that are equal as a whole one takes part in the tree.
    """
    rows = _rows(docs, id_col, text_col)
    nobody = F.lit(None).cast("long")
    # Anchors are worked out twice, which is cheaper than to keep those that occur once.
    shared = settled(_anchors(rows, least, False).groupBy("h").count().where("count > 1").select("h"), "shared")
    kept = settled(_anchors(rows, least, True).join(shared, "h"), "kept")
    kinds = settled(
        kept.groupBy("h", "u", "v").agg(F.count("*").alias("n"), F.min(F.struct("doc", "place")).alias("first")), "kinds"
    )
    start = F.shiftright("place", 8)
    equal = kept.join(kinds.where("n > 1").select("h", "u", "v"), ["h", "u", "v"]).select(
        F.xxhash64("h", "u", "v").alias("group"), nobody.alias("parent"), "doc", start.alias("start"),
        (F.col("place").bitwiseAND(F.lit(255)) + least).cast("long").alias("length"),
    )
    # Where some kind has no equal, one of each kind meets the others.
    mixed = settled(
        kinds.groupBy("h").agg(F.count("*").alias("kinds"), F.sum((F.col("n") == 1).cast("int")).alias("single"))
        .where("kinds > 1 AND single > 0").select("h", (F.col("kinds") > TOGETHER).alias("crowded")),
        "mixed",
    )
    asked = kinds.join(mixed, "h").groupBy(F.col("first.doc").alias("doc")).agg(
        F.collect_list(F.struct(F.col("first.place").alias("place"), "h", "crowded")).alias("asked")
    )
    segment_schema = T.StructType(
        [*_long("doc", "lo", "h").fields, T.StructField("crowded", T.BooleanType()), T.StructField("bytes", T.BinaryType())]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, lo, h, crowded, parts = [], [], [], [], []
            wanted_of = zip(batch.column("doc").to_pylist(), _unpacked(batch.column("data")), batch.column("asked").to_pylist(), strict=True)
            for key, data, wanted in wanted_of:
                for a in wanted:
                    first, more = divmod(a["place"], 256)
                    doc.append(key)
                    lo.append(first)
                    h.append(a["h"])
                    crowded.append(a["crowded"])
                    parts.append(data[first : first + more + least])
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array(c, type=pa.int64()) for c in (doc, lo, h)),
                    pa.array(crowded, type=pa.bool_()), pa.array(parts, type=pa.binary()),
                ],
                names=segment_schema.fieldNames(),
            )

    moved = rows.select("doc", _packed("data").alias("data"))
    segments = settled(moved.join(asked, "doc").select("doc", "data", "asked").mapInArrow(cut, segment_schema), "segments")
    span_schema = _long("group", "parent", "doc", "start", "length")

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _grouped(batches, "h"):
            h = part["h"].to_numpy()
            sizes = np.concatenate([[0], np.cumsum(np.array([len(b) for b in part["bytes"].to_pylist()], dtype=np.int64))])
            edge = _bounds(h)
            begin = 0
            for k in range(1, len(edge)):
                if k == len(edge) - 1 or sizes[edge[k + 1]] - sizes[edge[begin]] > ARRAY_BYTES:
                    yield from _spans(part.slice(edge[begin], edge[k] - edge[begin]))
                    begin = k

    def _spans(part: pa.Table) -> Iterator[pa.RecordBatch]:
        lo = part["lo"].to_numpy()
        array = SuffixArray(part["bytes"].to_pylist(), least)
        doc = part["doc"].to_numpy()
        lengths, parents, places, groups = array.tree()
        if not len(lengths):
            return
        where = array.order[places]
        # A repeat is named by its bytes, read at any of its occurrences.
        at = np.zeros(len(lengths), dtype=np.int64)
        at[groups] = where
        for k, parent in enumerate(parents.tolist()):  # inner ones come first
            if parent >= 0:
                at[parent] = at[k]
        names = np.array(
            [
                xxhash.xxh3_64_intdigest(array.sign[p : p + n].tobytes()) - (1 << 63)
                for p, n in zip(at.tolist(), lengths.tolist(), strict=True)
            ],
            dtype=np.int64,
        )
        segment, place = array.places(where)
        n, inner = len(where), np.flatnonzero(parents >= 0)
        none = pa.nulls(n, pa.int64())
        missing = pa.nulls(len(inner), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names[groups]), none, pa.array(doc[segment]), pa.array(lo[segment] + place), pa.array(lengths[groups])],
            names=span_schema.fieldNames(),
        )
        yield pa.RecordBatch.from_arrays(
            [pa.array(names[inner]), pa.array(names[parents[inner]]), missing, missing, pa.array(lengths[parents[inner]])],
            names=span_schema.fieldNames(),
        )

    narrow = segments.where("NOT crowded").repartition("h").sortWithinPartitions("h")
    found = equal.unionByName(narrow.mapInArrow(scanned, span_schema))
    if mixed.where("crowded").isEmpty():
        return found
    return found.unionByName(_crowded(segments.where("crowded").drop("crowded"), least, span_schema))


_ITEM = _long("doc", "h", "anchor", "low", "high", "base")


def _placed(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """The windows of each segment by the leftmost anchor in them: ``low`` to ``high`` bytes
    before ``anchor``, which is a place in the text like ``base``, where ``bytes`` begin."""
    gram = _gram(least)
    for batch in batches:
        rows = []
        columns = (batch.column(c).to_pylist() for c in ("doc", "h", "lo", "bytes"))
        for doc, h, lo, data in zip(*columns, strict=True):
            at = np.flatnonzero(_gram_hashes(np.frombuffer(data, dtype=np.uint8), gram).view(np.int64) == h)
            first, last = np.maximum(at - (least - gram), 0), np.minimum(at, len(data) - least)
            first[1:] = np.maximum(first[1:], at[:-1] + 1)
            for p, i, j in zip(at.tolist(), first.tolist(), last.tolist(), strict=True):
                if i <= j:
                    rows.append((doc, h, lo + p, p - j, p - i, lo, data))
        if rows:
            *numbers, data = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in numbers), pa.array(data, pa.binary())], names=[*_ITEM.names, "bytes"]
            )


def _crowded(segments: DataFrame, least: int, schema: T.StructType) -> DataFrame:
    """Repeats among any number of neighbourhoods of one anchor, as rows of ``schema``.

    The windows of a neighbourhood differ in how many bytes they have before the anchor.  That range
    is halved step by step.  All windows of a part share the bytes in their middle: where these
    occur once, no window of the part repeats, and it is dropped.  Where a part has an
    equal as a whole, all its windows repeat: it is a result, and one of the equals goes on as
    a partner for others.  So what goes on are the parts around the ends of repeats.
    """
    columns = [*_ITEM.fields, T.StructField("bytes", T.BinaryType())]
    placed = segments.mapInArrow(lambda batches: _placed(batches, least), T.StructType(columns))
    top = least - _gram(least)
    parts = placed.select("*", F.lit(True).alias("asks"), F.lit(0).cast("long").alias("r"), F.lit(top).cast("long").alias("s"))
    marked = T.StructType([*parts.schema.fields, *_long("cu", "cv", "u", "v").fields])

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {c: batch.column(c).to_numpy() for c in ("anchor", "base", "low", "high", "r", "s")}
            place = at["anchor"] - at["base"]
            ranges = np.stack([place - at["r"], place - at["s"] + least, place - at["high"], place - at["low"] + least], axis=1)
            new, found = hashlib.blake2b, []
            for data, (a, b, c, d) in zip(batch.column("bytes"), ranges.tolist(), strict=True):
                whole = memoryview(data.as_buffer())
                found.append(new(whole[a:b], digest_size=16).digest() + new(whole[c:d], digest_size=16).digest())
            four = np.frombuffer(b"".join(found), dtype="<i8").reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(four[:, k]) for k in range(4))], names=marked.names)

    out = None
    while True:
        here = settled(parts.mapInArrow(digested, marked), "parts")
        core, span = ["h", "r", "cu", "cv"], ["h", "r", "low", "high", "u", "v"]
        often = here.groupBy(*core).agg(F.count("*").alias("n")).where("n > 1").drop("n")
        alive = settled(here.join(often, core, "left_semi"), "alive")
        equal = settled(
            alive.groupBy(*span).agg(F.count("*").alias("n"), F.min(F.struct("doc", "anchor")).alias("one")).where("n > 1"), "equal"
        )
        results = alive.where("asks").join(equal.select(*span), span, "left_semi").select(
            F.xxhash64("h", "u", "v").alias("group"), F.lit(None).cast("long").alias("parent"), "doc",
            (F.col("anchor") - F.col("high")).alias("start"), (F.col("high") - F.col("low") + least).alias("length"),
        )
        out = results if out is None else out.unionByName(results)
        if here.where("r < s").isEmpty():
            return out.select(*schema.names)
        with_equal = alive.join(equal.select(*span, "one"), span, "left")
        on = with_equal.where("one IS NULL OR one = struct(doc, anchor)").withColumn("asks", F.col("asks") & F.col("one").isNull())
        middle = F.floor((F.col("r") + F.col("s")) / 2)
        halves = F.array(F.struct(F.col("r"), middle.alias("s")), F.struct((middle + 1).alias("r"), F.col("s")))
        split = on.where("r < s").withColumn("half", F.explode(halves))
        clipped = split.select(
            "doc", "h", "anchor", F.greatest("low", "half.r").alias("low"), F.least("high", "half.s").alias("high"), "base", "bytes",
            "asks", F.col("half.r").alias("r"), F.col("half.s").alias("s"),
        )
        parts = clipped.where("low <= high")


def all_occurrences(found: DataFrame) -> DataFrame:
    """``group, doc, start, length`` for every occurrence of every repeat in the result of
    ``repeats``: nested repeats list theirs again, so this can be much longer."""
    rows = settled(found.where("doc IS NOT NULL").select("group", "doc", "start", "length"), "deepest")
    parents = settled(found.where("doc IS NULL").select("group", "parent", F.col("length").alias("shorter")).distinct(), "parents")
    out = level = rows
    while not level.isEmpty():
        up = level.join(parents, "group").select(F.col("parent").alias("group"), "doc", "start", F.col("shorter").alias("length"))
        level = settled(up.distinct(), "level")
        out = out.unionByName(level)
    return out.distinct()


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, with_kept: bool = False
) -> DataFrame:
    """One row per input row: ``id, n_bytes, n_removed, n_spans, kept_sha256`` and, if asked
    for, ``kept``, the bytes that are left (they may be cut within a character).

    A byte goes if a string of ``least`` bytes that covers it also starts anywhere else in
    the input, the same text included; overlaps count, and so do equal rows.  Matches do
    not cross texts.  NULL counts as empty text.  A text shorter than ``least`` bytes stays.
    """
    spans = repeats(docs, id_col, text_col, least).where("doc IS NOT NULL").groupBy("doc").agg(
        F.collect_set(F.struct("start", "length")).alias("spans")
    )
    moved = _rows(docs, id_col, text_col).select("id", "doc", _packed("data").alias("data"))
    rows = moved.join(spans, "doc", "left")
    fields = [
        T.StructField("id", docs.schema[id_col].dataType),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("n_spans", T.LongType()),
        T.StructField("kept_sha256", T.StringType()),
    ]
    if with_kept:
        fields.append(T.StructField("kept", T.BinaryType()))
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in fields[1:]]
            for data, found in zip(_unpacked(batch.column("data")), batch.column("spans"), strict=True):
                found = found.as_py() or []
                runs: list[list[int]] = []
                for s in sorted((s["start"], s["start"] + s["length"]) for s in found):
                    if runs and s[0] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], s[1])
                    else:
                        runs.append(list(s))
                kept, at = [], 0
                for a, b in runs:
                    kept.append(data[at:a])
                    at = b
                left = b"".join([*kept, data[at:]])
                row = [len(data), len(data) - len(left), len(runs), hashlib.sha256(left).hexdigest(), left]
                for column, value in zip(columns, row, strict=False):
                    column.append(value)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array(c, type=t) for c, t in zip(columns, types, strict=False))], names=schema.fieldNames()
            )

    return rows.select("id", "data", "spans").mapInArrow(run, schema)
