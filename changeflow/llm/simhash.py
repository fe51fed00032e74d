"""Near duplicates by SimHash fingerprints and multi-index hashing."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.llm.common import components, handed_back, settled, shuffle_width, whole_rows

SEED = 42


def fingerprint(text: str | None, words_in_shingle: int = 3) -> int:
    """64-bit SimHash of word shingles, repeats included.

    Words lie between ASCII white space, with A-Z in lower case.  Fewer words than a
    shingle has: all of them are the one shingle.  No words: zero.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < words_in_shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(words_in_shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], dtype="<u8")
    total = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)]
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * total > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text_col: str = "text", words_in_shingle: int = 3, carry: bool = True, id_col: str = "doc_id") -> DataFrame:
    """``id, code`` (the fingerprint as a signed long) and, with ``carry``, the input row as ``row``."""
    rows = whole_rows(docs, id=F.col(f"`{id_col}`"), text=F.col(f"`{text_col}`").cast("string"))
    if not carry:
        rows = rows.drop("row")
    kept = [f for f in rows.schema.fields if f.name != "text"]
    schema = T.StructType([*kept, T.StructField("code", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.array(
                [fingerprint(t, words_in_shingle) for t in batch.column("text").to_pylist()], dtype="<u8"
            ).astype("<i8")
            columns = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(codes)], names=[*(f.name for f in kept), "code"])

    return rows.mapInArrow(run, schema)


def _half(code, k: int):
    """Segment k of a code: its upper or lower 32 bits."""
    return F.shiftrightunsigned(code, 32) if k else code.bitwiseAND(F.lit((1 << 32) - 1))


def hamming_links(codes: DataFrame, code_col: str = "code") -> DataFrame:
    """All pairs (a, b) of different codes that differ in three bits or fewer.

    Of three differing bits at most one lies in one of the two halves.  Each code is
    stored under both halves.  A half with an even number of ones looks up the ball of
    radius one around it, 33 keys, an odd one only itself: halves one bit apart differ
    in parity, so each such pair is met once.  Matches are verified on all 64 bits.
    """
    code = F.col(code_col)
    known = codes.select(code.alias("b"), F.explode(F.array(F.lit(0), F.lit(1))).alias("k")).select(
        "b", F.when(F.col("k") == 1, _half(F.col("b"), 1)).otherwise(_half(F.col("b"), 0)).alias("half"), "k"
    ).select("b", F.col("half").bitwiseOR(F.shiftleft(F.col("k").cast("long"), 32)).alias("key"))
    asked = codes.select(code.alias("a"), F.explode(F.array(F.lit(0), F.lit(1))).alias("k")).select(
        "a", "k", F.when(F.col("k") == 1, _half(F.col("a"), 1)).otherwise(_half(F.col("a"), 0)).alias("half")
    )
    ball = F.when(
        F.bit_count("half") % 2 == 0,
        F.concat(F.array(F.lit(0).cast("long")), F.array(*(F.lit(1 << i).cast("long") for i in range(32)))),
    ).otherwise(F.array(F.lit(0).cast("long")))
    asked = asked.select("a", "k", "half", F.explode(ball).alias("flip")).select(
        "a",
        "flip",
        F.col("half").bitwiseXOR(F.col("flip")).bitwiseOR(F.shiftleft(F.col("k").cast("long"), 32)).alias("key"),
    )
    found = asked.join(known, "key").where(
        "(flip != 0 OR a < b) AND a != b AND bit_count(a ^ b) <= 3"
    )
    return found.select("a", "b")


def _classes(marked: DataFrame) -> DataFrame:
    """code -> component_id, the smallest id reachable."""
    codes = settled(marked.groupBy("code").agg(F.min("id").alias("low")), "codes")
    roots = components(hamming_links(codes))
    rooted = codes.join(roots, codes["code"] == roots["node"], "left").select(
        "code", "low", F.coalesce("root", "code").alias("root")
    )
    rooted = settled(rooted, "roots")
    lowest = settled(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "lowest")
    return settled(rooted.join(lowest, "root").select("code", "component_id"), "classes")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_in_shingle: int = 3) -> DataFrame:
    """One row per input row: ``id, code, fingerprint`` (16 hex digits), ``component_id``.

    Documents whose fingerprints differ in three bits or fewer are linked;
    ``component_id`` is the smallest id that links lead to.  Rows with one fingerprint
    are one node, so copies are never paired.  NULL text counts as empty; the empty
    text's fingerprint is zero, and it links like any other.  A NULL id is never the
    smallest unless a component has no other.
    """
    marked = settled(with_fingerprints(docs, text_col, words_in_shingle, carry=False, id_col=id_col), "marked")
    return marked.join(_classes(marked), "code").select(
        "id", "code", F.lpad(F.lower(F.hex("code")), 16, "0").alias("fingerprint"), "component_id"
    )


# -- near copies by similarity ---------------------------------------------------------

#: Fewest bits of a wide fingerprint; more where the number of texts asks for more segments.
WIDE_BITS = 512
#: Standard deviations by which the number of differing bits may exceed what the similarity
#: leads to expect.
DEVIATIONS = 4
#: Share of pairs at the similarity that no segment may bring together, at any number of texts.
MISSED = 0.01
#: Codes in a bucket beyond which they are compared by their rarest shingles and not by buckets.
CROWD = 32


def shingle_hashes(text: str | None, words_in_shingle: int = 5) -> np.ndarray:
    """The distinct hashes of a text's shingles, ascending.  Shingles as in ``fingerprint``."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, dtype="<u8")
    if len(words) < words_in_shingle:
        shingles = {b" ".join(words)}
    else:
        shingles = set(map(b" ".join, zip(*(words[k:] for k in range(words_in_shingle)))))
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(s, SEED) for s in shingles], dtype="<u8"))


def wide_fingerprint(hashes: np.ndarray, bits: int = WIDE_BITS) -> bytes:
    """SimHash of this many bits, a multiple of 64; each hash is stretched by mixing it with
    the number of the word.  No hashes: zero."""
    step = np.arange(1, bits // 64 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    total = np.zeros(bits, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 12):
        mixed = hashes[at : at + (1 << 12), None] + step
        mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        mixed ^= mixed >> np.uint64(31)
        ones = np.unpackbits(np.ascontiguousarray(mixed).view(np.uint8), axis=1, bitorder="little")
        total += ones.sum(axis=0, dtype=np.int64)
    return np.packbits(2 * total > len(hashes), bitorder="little").tobytes()


def expected_share(similarity: float) -> float:
    """Share of differing bits of two equally large shingle sets of this Jaccard similarity."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def segments_for(codes: int, similarity: float) -> tuple[int, int]:
    """Bits of a segment and how many segments: buckets as many as codes, and enough of
    them that few pairs at the similarity differ in two bits or more of each."""
    width = max(12, math.ceil(math.log2(max(codes, 2))))
    far = expected_share(similarity)
    meet = (1 - far) ** width + width * far * (1 - far) ** (width - 1)
    return width, math.ceil(math.log(MISSED) / math.log(1 - meet))


def bits_for(codes: int, similarity: float) -> int:
    """Bits of the wide fingerprint that have room for the segments."""
    width, count = segments_for(codes, similarity)
    return max(WIDE_BITS, -(-width * count // 64) * 64)


def _farthest(bits: int, similarity: float) -> int:
    """Differing bits that a pair of the similarity has at most, but for chance."""
    far = expected_share(similarity)
    return int(bits * far + DEVIATIONS * math.sqrt(bits * far * (1 - far)))


def _keys(width: int, count: int, bits: int, ball: bool):
    """The segments' keys of a code; with ``ball``, of even segments also those one bit away."""

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def keys(codes: pa.Array) -> pa.Array:
        rows = np.frombuffer(b"".join(codes.to_pylist()), dtype=np.uint8).reshape(-1, bits // 8)
        ones = np.unpackbits(rows, axis=1, bitorder="little")[:, : width * count].reshape(len(rows), count, width)
        value = ones.astype(np.int64) @ (1 << np.arange(width))
        number = np.arange(count, dtype=np.int64) << width
        if not ball:
            return pa.array(list(value | number), type=pa.list_(pa.int64()))
        flipped = value[:, :, None] ^ (1 << np.arange(width))
        even = ones.sum(axis=2) % 2 == 0
        out = [
            np.concatenate([v | number, (f[e] | number[e, None]).ravel()])
            for v, f, e in zip(value, flipped, even, strict=True)
        ]
        return pa.array(out, type=pa.list_(pa.int64()))

    return keys


@F.arrow_udf(T.LongType())
def _first_word(codes: pa.Array) -> pa.Array:
    return pa.array([int.from_bytes(c[:8], "little", signed=True) for c in codes.to_pylist()], type=pa.int64())


def _distance(bits: int):
    @F.arrow_udf(T.IntegerType())
    def distance(a: pa.Array, b: pa.Array) -> pa.Array:
        x, y = (np.frombuffer(b"".join(c.to_pylist()), dtype="<u8").reshape(-1, bits // 64) for c in (a, b))
        return pa.array(np.bitwise_count(x ^ y).sum(axis=1).astype(np.int32))

    return distance


def _jaccard(a: str, b: str) -> Column:
    """Of two columns with distinct hashes."""
    common = F.size(F.array_intersect(a, b))
    return common / F.greatest(F.size(a) + F.size(b) - common, F.lit(1))


def _rarest(sets: DataFrame, similarity: float) -> DataFrame:
    """``node, size, place, shingle``: of each set (``node, set``) the shingles that one of its
    partners of the similarity must share, by their place among the set's shingles from the
    rarest on.  Shingles of one set alone take a place, but have no row."""
    # Their files are few and small, but make a row for each shingle.
    spread = sets.repartition(shuffle_width(sets.sparkSession), "node")
    each = spread.select("node", F.size("set").alias("size"), F.explode("set").alias("shingle"))
    counted = each.withColumn("held", F.count("*").over(Window.partitionBy("shingle")))
    placed = counted.withColumn("place", F.row_number().over(Window.partitionBy("node").orderBy("held", "shingle")))
    return placed.where(f"held > 1 AND place <= size - ceil({similarity} * size - 1e-9) + 1").select(
        "node", "size", "place", "shingle"
    )


def crowd_links(sets: DataFrame, links: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of nodes that, with ``links``, connect all sets (``node, set``) of at least
    this Jaccard similarity.  Exact.

    Two such sets share so many shingles that the rarest shared one has an early place in
    both.  In a crowd around one text the rarest are what each has of its own, and a text
    that has too much of its own meets no other.  Those that meet by the common text
    are first compared with the one of them that has least before that shingle.  Then those
    outside the largest group of a shingle are compared with all that have it.
    """
    rows = settled(_rarest(sets, similarity), "rarest")
    need = f"ceil({similarity / (1 + similarity)!r} * (size + size_b) - 1e-9)"
    reach = f"place <= size - {need} + 1 AND place_b <= size_b - {need} + 1"
    a = sets.select(F.col("node").alias("a"), F.col("set").alias("set_a"))
    b = sets.select(F.col("node").alias("b"), F.col("set").alias("set_b"))

    def rooted(links: DataFrame) -> DataFrame:
        return rows.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))

    def verified(met: DataFrame) -> DataFrame:
        pairs = settled(met.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct(), "met")
        return settled(pairs.join(a, "a").join(b, "b").where(_jaccard("set_a", "set_b") >= similarity).select("a", "b"), "links")

    least = rows.groupBy("shingle").agg(F.min(F.struct("place", "node", "size")).alias("least")).select(
        "shingle", F.col("least.place").alias("place_b"), F.col("least.node").alias("b"), F.col("least.size").alias("size_b")
    )
    first = verified(rows.join(least, "shingle").where(f"node != b AND {reach}"))
    known = settled(rooted(links.unionByName(first)), "known")
    largest = known.groupBy("shingle", "root").count().groupBy("shingle").agg(
        F.max_by("root", F.struct("count", "root")).alias("most")
    )
    others = known.join(largest, "shingle").where("root != most").drop("most")
    every = known.select(
        "shingle", F.col("node").alias("b"), F.col("size").alias("size_b"), F.col("place").alias("place_b"), F.col("root").alias("root_b")
    )
    return first.unionByName(verified(others.join(every, "shingle").where(f"root != root_b AND {reach}")))


def similar_links(codes: DataFrame, texts: DataFrame, similarity: float, words_in_shingle: int, rows: int, bits: int) -> DataFrame:
    """Pairs (a, b) of nodes that connect all texts of at least this Jaccard similarity.
    ``codes`` has ``node, code``, each once, ``texts`` the text of each node, ``rows`` of them;
    ``bits`` is the width of the codes.

    Candidates that pass the distance on all bits are verified on their shingle sets.
    First each code is compared with the smallest node of its buckets, which joins most of
    a large group along stars.  Codes that have more than ``CROWD`` in a bucket are compared
    with each other by their rarest shingles.  Then the balls are looked up, and the other pairs
    that the stars have not joined are compared: a bucket with more codes is asked by no more
    than its neighbours hold.  So a dense group is not written out as all its pairs.
    """
    width, count = segments_for(rows, similarity)
    rough = _farthest(64, similarity)
    sketched = settled(codes.withColumn("word", _first_word("code")), "sketched")

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def shingles(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        def listed(found: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in found:
                yield pa.array(
                    [shingle_hashes(t.as_py(), words_in_shingle).view("<i8") for t in texts], type=pa.list_(pa.int64())
                )

        yield from handed_back(listed)(batches)

    def sets_of(nodes: DataFrame) -> DataFrame:
        return settled(texts.join(nodes, "node").select("node", shingles("text").alias("set")), "sets")

    def verified(pairs: DataFrame) -> DataFrame:
        a = sketched.select(F.col("node").alias("a"), F.col("code").alias("code_a"))
        b = sketched.select(F.col("node").alias("b"), F.col("code").alias("code_b"))
        near = pairs.distinct().join(a, "a").join(b, "b")
        near = settled(near.where(_distance(bits)("code_a", "code_b") <= _farthest(bits, similarity)), "near")
        # Their numbers alone: as long as there are few, Spark sends these to the texts.
        asked = settled(near.select(F.col("a").alias("node")).union(near.select("b")).distinct(), "asked")
        sets = sets_of(asked)
        both = near.join(sets.select(F.col("node").alias("a"), F.col("set").alias("set_a")), "a").join(
            sets.select(F.col("node").alias("b"), F.col("set").alias("set_b")), "b"
        )
        return settled(both.where(_jaccard("set_a", "set_b") >= similarity).select("a", "b"), "links")

    placed = settled(
        sketched.select("node", "word", F.explode(_keys(width, count, bits, False)("code")).alias("key")), "placed"
    )
    lead = settled(
        placed.groupBy("key").agg(F.min(F.struct("node", "word")).alias("lead"), F.count("*").alias("n"))
        .where("n > 1").select("key", "n", F.col("lead.node").alias("b"), F.col("lead.word").alias("word_b")),
        "lead",
    )
    stars = verified(
        placed.join(lead, "key").where(f"node != b AND bit_count(word ^ word_b) <= {rough}").select(F.col("node").alias("a"), "b")
    )
    links = stars
    crowd = settled(
        placed.join(lead.where(f"n > {CROWD}").select("key"), "key").select("node", F.lit(True).alias("crowded")).distinct(),
        "crowd",
    )
    if not crowd.isEmpty():
        links = links.unionByName(crowd_links(sets_of(crowd.select("node")), stars, similarity))
    roots = settled(components(links).join(crowd, "node", "full"), "roots")

    def rooted(rows: DataFrame) -> DataFrame:
        return rows.join(roots, "node", "left").withColumns(
            {"root": F.coalesce("root", "node"), "crowded": F.coalesce("crowded", F.lit(False))}
        )

    known = settled(rooted(placed), "known").select(
        "key", F.col("node").alias("b"), F.col("word").alias("word_b"), F.col("root").alias("root_b"), F.col("crowded").alias("crowded_b")
    )
    asked = rooted(sketched).select(
        F.col("node").alias("a"), "word", "root", "crowded", F.explode(_keys(width, count, bits, True)("code")).alias("key")
    )
    balls = verified(
        asked.join(known, "key")
        .where(f"a != b AND root != root_b AND NOT (crowded AND crowded_b) AND bit_count(word ^ word_b) <= {rough}")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    )
    return links.unionByName(balls)


def near_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_in_shingle: int = 5, similarity: float = 0.8
) -> DataFrame:
    """The input rows, all columns, of which one for each group of near copies stays: the
    one with the smallest id.

    Near copies have shingle sets of this Jaccard similarity or more, found by their wide
    fingerprints, which about ``MISSED`` of the pairs at the similarity may escape (more of
    texts with few shingles); groups are connected by such pairs.  NULL and empty texts are copies of
    each other.  A group without ids keeps one row.
    """
    rows = whole_rows(docs, id=F.col(f"`{id_col}`"), text=F.col(f"`{text_col}`").cast("string"))

    n = docs.count()
    bits = bits_for(n, similarity)

    @F.arrow_udf(T.BinaryType())
    def code(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        def coded(found: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in found:
                yield pa.array(
                    [wide_fingerprint(shingle_hashes(t.as_py(), words_in_shingle), bits) for t in texts], type=pa.binary()
                )

        yield from handed_back(coded)(batches)

    # Numbered once and for all, as it is written.  From here on only numbers and codes move.
    marked = settled(
        rows.select("row", "id", code("text").alias("code"), F.monotonically_increasing_id().alias("uid")), "marked"
    )
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "uid"))
    codes = settled(marked.groupBy("code").agg(first.alias("first")).select("code", "first", F.col("first.uid").alias("node")), "codes")
    links = similar_links(
        codes.select("node", "code"), marked.select(F.col("uid").alias("node"), F.col("row")[text_col].alias("text")),
        similarity, words_in_shingle, n, bits,
    )
    rooted = codes.join(components(links), "node", "left").select(F.coalesce("root", "node").alias("root"), "first")
    stays = settled(rooted.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.uid").alias("uid")), "stays")
    goes = settled(marked.select("uid").join(stays, "uid", "left_anti"), "goes")
    return marked.join(goes, "uid", "left_anti").select("row.*")


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_in_shingle: int = 3) -> DataFrame:
    """The input rows, all columns, of which one for each component stays: the one with
    the smallest id (of rows that repeat id and text, one)."""
    marked = settled(with_fingerprints(docs, text_col, words_in_shingle, carry=True, id_col=id_col), "marked")
    classes = _classes(marked)
    first = marked.join(classes, "code").where(F.col("id").eqNullSafe(F.col("component_id")))
    return first.dropDuplicates(["id"]).select("row.*")
