"""Near-duplicate vectors by NN-descent."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.llm.common import components, settled

#: Neighbours in a list at first; random partitions that the first lists come from, and
#: how many vectors meet in a leaf.
NEIGHBOURS = 12
TREES = 4
LEAF = 192
#: New neighbours that a pivot may propose to each member in one round.
PROPOSALS = 4
ROUNDS = 8
#: Rounds end when fewer than this share of all list entries change.
SETTLED_SHARE = 0.002
#: Vectors whose links are checked against all others, recall asked for, and tries with
#: lists of twice the length, after which the search fails.
AUDIT = 256
LEAST_RECALL = 0.98
TRIES = 5
#: How far a cosine of half-precision vectors may lie below the true one.
HALF = 0.004
BLOCK = 512


def _edges_schema() -> T.StructType:
    return T.StructType(
        [T.StructField("src", T.LongType()), T.StructField("dst", T.LongType()), T.StructField("sim", T.FloatType())]
    )


def _half(vectors: list) -> list[bytes]:
    out = []
    for v in vectors:
        x = np.asarray(v, dtype=np.float64)
        out.append((x / np.sqrt(x @ x)).astype(np.float16).tobytes())
    return out


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """``node, vector, unit, n, low`` of the usable vectors of ``id, vector``: equal vectors
    once, with their number and smallest id."""

    @F.arrow_udf(T.BinaryType())
    def unit(vectors: pa.Array) -> pa.Array:
        return pa.array(_half(vectors.to_pylist()), type=pa.binary())

    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = rows.where(F.col("vector").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
    grouped = usable.groupBy("vector").agg(F.count("*").alias("n"), F.min("id").alias("low"))
    return settled(
        settled(grouped, "vectors").select(
            F.monotonically_increasing_id().alias("node"), "vector", unit("vector").alias("unit"), "n", "low"
        ),
        "vectors",
    )


def _best(edges: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("src").orderBy(F.desc("sim"), "dst")
    return edges.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("rank")


def _grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Whole groups of rows that arrive sorted by ``key``, many at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key)
        last = keys[-1]
        if held and held[0].column(key)[0] == last:
            held.append(batch)
            continue
        cut = int(np.flatnonzero(keys.to_numpy(zero_copy_only=False) != last.as_py())[-1]) + 1 if keys[0] != last else 0
        if held or cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)


def _bounds(keys: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])


def _matrix(units: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(units), dtype=np.float16).reshape(len(units), -1).astype(np.float32)


def _first_lists(vectors: DataFrame, count: int, k: int, seed: int) -> DataFrame:
    """Lists from random partitions: vectors with the same signs on random directions meet
    in a leaf.  A crowded sign pattern is cut into leaves by a hash.  Vectors of one ``root``
    are no neighbours."""
    bits = max(0, round(math.log2(max(count, 1) / (LEAF / 2))))

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def signs(units: pa.Array) -> pa.Array:
        out = []
        for u in units.to_pylist():
            x = np.frombuffer(u, dtype=np.float16).astype(np.float32)
            if len(x) not in planes:
                planes[len(x)] = np.random.default_rng([seed, len(x)]).standard_normal((TREES * max(bits, 1), len(x)))
            side = (planes[len(x)] @ x > 0).reshape(TREES, -1)[:, :bits].astype(np.int64)
            # The dimension is part of the pattern: only equally long vectors meet.
            out.append((side << np.arange(bits)).sum(axis=1) + (len(x) << 40))
        return pa.array(out, type=pa.list_(pa.int64()))

    planes: dict[int, np.ndarray] = {}
    placed = settled(vectors.select("node", "root", "unit", F.posexplode(signs("unit")).alias("tree", "code")), "placed")
    crowded = placed.groupBy("tree", "code").count().where(F.col("count") > LEAF)
    leaves = placed.join(crowded, ["tree", "code"], "left").select(
        F.xxhash64(
            "tree", "code", F.pmod(F.xxhash64("node", "tree"), F.ceil(F.coalesce("count", F.lit(1)) / LEAF))
        ).alias("leaf"),
        "node",
        "root",
        "unit",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _grouped(batches, "leaf"):
            leaf, node, units = part["leaf"].to_numpy(), part["node"].to_numpy(), part["unit"].to_pylist()
            root = part["root"].to_numpy()
            edge = _bounds(leaf)
            src, dst, sim = [], [], []
            for a, b in zip(edge[:-1], edge[1:], strict=True):
                if b - a < 2:
                    continue
                x = _matrix(units[a:b])
                s = x @ x.T
                s[root[a:b, None] == root[None, a:b]] = -2
                own = min(k, b - a - 1)
                best = np.argpartition(-s, own - 1, axis=1)[:, :own]
                value = np.take_along_axis(s, best, axis=1)
                row, column = np.nonzero(value > -2)
                src.append(node[a:b][row])
                dst.append(node[a:b][best[row, column]])
                sim.append(value[row, column])
            if src:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(src)), pa.array(np.concatenate(dst)), pa.array(np.concatenate(sim))],
                    names=["src", "dst", "sim"],
                )

    found = leaves.repartition("leaf").sortWithinPartitions("leaf").mapInArrow(run, _edges_schema())
    return settled(_best(found.groupBy("src", "dst").agg(F.max("sim").alias("sim")), k), "lists")


def _refined(lists: DataFrame, vectors: DataFrame, k: int, inner: DataFrame | None = None) -> DataFrame:
    """One round: the neighbours of each vector, forth and back, are compared with each
    other, and those that beat the end of a list enter it.  Neighbours of one ``root`` as
    the vector, in ``inner``, take part in its comparisons without being in its list."""
    back = Window.partitionBy("pivot").orderBy(F.xxhash64("member"), "member")
    reverse = (
        lists.select(F.col("dst").alias("pivot"), F.col("src").alias("member"))
        .withColumn("rank", F.row_number().over(back)).where(F.col("rank") <= k).drop("rank")
    )
    members = lists.select(F.col("src").alias("pivot"), F.col("dst").alias("member")).unionByName(reverse)
    members = members.unionByName(lists.select(F.col("src").alias("pivot"), F.col("src").alias("member")))
    if inner is not None:
        near = inner.select(F.col("src").alias("pivot"), F.col("dst").alias("member"))
        members = members.unionByName(near.join(members.select("pivot").distinct(), "pivot", "left_semi"))
    members = members.distinct()
    ends = lists.groupBy("src").agg(F.min("sim").alias("end"), F.count("*").alias("held"))
    known = vectors.join(ends, vectors["node"] == ends["src"], "left").select(
        F.col("node").alias("member"), "root", "unit", F.when(F.col("held") >= k, F.col("end")).otherwise(F.lit(-2.0)).cast("float").alias("end")
    )
    known = settled(known, "known")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _grouped(batches, "pivot"):
            node, units = part["member"].to_numpy(), part["unit"].to_pylist()
            ends_, root = part["end"].to_numpy(), part["root"].to_numpy()
            edge = _bounds(part["pivot"].to_numpy())
            src, dst, sim = [], [], []
            for a, b in zip(edge[:-1], edge[1:], strict=True):
                x = _matrix(units[a:b])
                s = x @ x.T
                s[root[a:b, None] == root[None, a:b]] = -2
                own = min(PROPOSALS, b - a)
                best = np.argpartition(-s, own - 1, axis=1)[:, :own]
                value = np.take_along_axis(s, best, axis=1)
                row, column = np.nonzero(value > ends_[a:b, None])
                src.append(node[a:b][row])
                dst.append(node[a:b][best[row, column]])
                sim.append(value[row, column])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(src)), pa.array(np.concatenate(dst)), pa.array(np.concatenate(sim))],
                names=["src", "dst", "sim"],
            )

    met = members.join(known, "member").repartition("pivot").sortWithinPartitions("pivot")
    proposed = met.mapInArrow(run, _edges_schema())
    both = lists.unionByName(proposed).groupBy("src", "dst").agg(F.max("sim").alias("sim"))
    return settled(_best(both, k), "lists")


@F.arrow_udf(T.DoubleType())
def cosine(a: pa.Array, b: pa.Array) -> pa.Array:
    """Cosines of vectors in double precision."""
    out = []
    for x, y in zip(a, b, strict=True):
        x, y = (v.values.to_numpy(zero_copy_only=False).astype(np.float64) for v in (x, y))
        out.append(float(x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y))))
    return pa.array(out, type=pa.float64())


def _close(lists: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b), a < b, whose cosine reaches the threshold, in double precision."""
    pairs = lists.where(F.col("sim") >= threshold - HALF).select(
        F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")
    ).distinct()
    a = vectors.select(F.col("node").alias("a"), F.col("vector").alias("va"))
    b = vectors.select(F.col("node").alias("b"), F.col("vector").alias("vb"))
    return settled(
        pairs.join(a, "a").join(b, "b").where(cosine("va", "vb") >= threshold).select("a", "b"), "links"
    )


def _searched(vectors: DataFrame, count: int, k: int, seed: int, inner: DataFrame | None = None) -> DataFrame:
    """The lists of ``node, root, unit`` after as many rounds as they need to settle."""
    lists = _first_lists(vectors, count, k, seed)
    for _ in range(ROUNDS):
        better = _refined(lists, vectors, k, inner)
        changed = better.join(lists, ["src", "dst"], "left_anti").count()
        lists = better
        if changed <= SETTLED_SHARE * max(1, count * k):
            break
    return lists


def _saturated(lists: DataFrame, threshold: float, k: int) -> DataFrame:
    """``node`` of the lists whose last entry is still close: others may have found no room."""
    near = lists.where(F.col("sim") >= threshold - HALF)
    return near.groupBy("src").count().where(F.col("count") >= k).select(F.col("src").alias("node"))


def _bridged(
    lists: DataFrame, links: DataFrame, vectors: DataFrame, threshold: float, k: int, seed: int
) -> tuple[DataFrame, DataFrame]:
    """The links and their components, with links between components of saturated lists.

    Those lists hold their own group alone.  Saturated vectors are searched again for
    neighbours outside their component; as components that are linked become one, each
    search looks past what the ones before it found, until one finds no link.
    """
    full = settled(_saturated(lists, threshold, k), "full")
    among = lists.join(full.select(F.col("node").alias("src")), "src", "left_semi")
    inner = settled(among.join(full.select(F.col("node").alias("dst")), "dst", "left_semi").select("src", "dst"), "inner")
    while True:
        roots = settled(components(links), "roots")
        apart = settled(vectors.select("node", "unit").join(full, "node").join(roots, "node"), "apart")
        if apart.select("root").distinct().limit(2).count() < 2:
            return links, roots
        seed += 1
        new = _close(_searched(apart, apart.count(), k, seed, inner), vectors, threshold)
        if new.isEmpty():
            return links, roots
        links = settled(links.unionByName(new), "links")


def _link_counts(lists: DataFrame, links: DataFrame, roots: DataFrame, vectors: DataFrame, threshold: float, k: int) -> DataFrame:
    """``node, links``: how many other vectors each is linked to, equal ones included once
    for each row.

    A list whose last entry is still close is saturated: it is enlarged to all vectors that
    its links lead to, in blocks of a bounded size; the counts of the blocks add up.
    """
    full = _saturated(lists, threshold, k)
    weights = vectors.select("node", "n")
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        links.select(F.col("b").alias("node"), F.col("a").alias("other"))
    )
    counted = (
        both.join(full, "node", "left_anti")
        .join(weights.select(F.col("node").alias("other"), "n"), "other")
        .groupBy("node").agg(F.sum("n").alias("links"))
    )
    # Members of a component in numbered blocks; rows are saturated, columns are all.
    wide = settled(roots.join(full, "node").select("root").distinct(), "wide")
    member = roots.join(wide, "root", "left_semi").join(full.withColumn("full", F.lit(True)), "node", "left")
    sizes = member.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    member = settled(
        member.join(sizes, "root").join(vectors.select("node", "vector", "n"), "node")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")),
        "members",
    )
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = member.where("full").select("root", F.col("block").alias("i"), every.alias("j"), F.lit(True).alias("asks"), "node", "vector", "n")
    right = member.select("root", every.alias("i"), F.col("block").alias("j"), F.lit(False).alias("asks"), "node", "vector", "n")
    cells = left.unionByName(right).select(F.xxhash64("root", "i", "j").alias("cell"), "asks", "node", "vector", "n")
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("links", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _grouped(batches, "cell"):
            edge = _bounds(part["cell"].to_numpy())
            asks, node, n = part["asks"].to_numpy(), part["node"].to_numpy(), part["n"].to_numpy()
            vectors_ = part["vector"].to_pylist()
            out_node, out_links = [], []
            for a, b in zip(edge[:-1], edge[1:], strict=True):
                x = np.array(vectors_[a:b], dtype=np.float64)
                x /= np.sqrt((x * x).sum(axis=1))[:, None]
                q, all_ = asks[a:b], ~asks[a:b]
                if not q.any() or not all_.any():
                    continue
                close = (x[q] @ x[all_].T >= threshold) & (node[a:b][q][:, None] != node[a:b][all_])
                out_node.append(node[a:b][q])
                out_links.append(close @ n[a:b][all_])
            if out_node:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(out_node)), pa.array(np.concatenate(out_links).astype(np.int64))],
                    names=["node", "links"],
                )

    enlarged = cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, schema)
    return counted.unionByName(enlarged.groupBy("node").agg(F.sum("links").alias("links")))


def audit(
    vectors: DataFrame, lists: DataFrame, links: DataFrame, roots: DataFrame, threshold: float, k: int, size: int = AUDIT
) -> float:
    """Share of the true links of a vector that are counted, on average over ``size`` linked
    vectors, of as many components as there are, and ``size`` others that have any: each is
    compared with all vectors.  The links of a saturated vector are counted within its
    component, those of others one by one."""
    place = Window.partitionBy("root").orderBy(F.xxhash64("node"))
    linked = roots.withColumn("place", F.row_number().over(place)).where(F.col("place") <= size)
    chosen = linked.orderBy("place", F.xxhash64("node")).limit(size).select("node").unionByName(
        vectors.select("node").join(roots.select("node"), "node", "left_anti").orderBy(F.xxhash64("node")).limit(size)
    )
    drawn = vectors.select("node", "vector").join(settled(chosen, "drawn"), "node").collect()
    by_length: dict[int, list] = {}
    for r in drawn:
        by_length.setdefault(len(r["vector"]), []).append(r)
    known = {}
    for length, rows in by_length.items():
        x = np.array([r["vector"] for r in rows], dtype=np.float64)
        known[length] = np.array([r["node"] for r in rows]), x / np.sqrt((x * x).sum(axis=1))[:, None]
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for node, v in zip(batch.column("node").to_pylist(), batch.column("vector"), strict=True):
                v = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if len(v) not in known:
                    continue
                ids, x = known[len(v)]
                hit = ids[(x @ v / np.sqrt(v @ v) >= threshold) & (ids != node)]
                a.extend(hit.tolist())
                b.extend([node] * len(hit))
            yield pa.RecordBatch.from_arrays([pa.array(a, type=pa.int64()), pa.array(b, type=pa.int64())], names=["a", "b"])

    true = vectors.select("node", "vector").mapInArrow(run, schema)
    rooted = true.join(roots.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a", "left").join(
        roots.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b", "left"
    )
    direct = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    told = rooted.join(direct.withColumn("direct", F.lit(True)), ["a", "b"], "left").join(
        _saturated(lists, threshold, k).select(F.col("node").alias("a"), F.lit(True).alias("full")), "a", "left"
    )
    found = F.when(F.col("full"), F.col("ra").eqNullSafe(F.col("rb"))).otherwise(F.coalesce("direct", F.lit(False)))
    shares = told.groupBy("a").agg(F.avg(found.cast("int")).alias("share"))
    return shares.agg(F.coalesce(F.avg("share"), F.lit(1.0)).alias("recall")).first()["recall"]


def near_vectors(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9, k: int = NEIGHBOURS
) -> DataFrame:
    """One row per input row: ``id, n_links`` (other rows linked directly), ``component_id``
    (smallest id that links lead to), ``kept`` (id = component_id).

    Vectors link when their cosine, in double precision, is at least ``threshold``.  NULL,
    zero and empty vectors, and those with NULL or non-finite components, link with nothing;
    nor do vectors of different lengths.  Equal vectors are one node, so copies are never
    paired.  Lists are made anew with twice the length while the audit finds a recall below
    LEAST_RECALL, and after TRIES times RuntimeError is raised; the search is otherwise
    approximate: no pair below the threshold is linked, a few above it may be missed.
    """
    all_ = rows.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast("array<float>").alias("vector"))
    vectors = distinct_vectors(all_)
    count = vectors.count()
    alone = settled(vectors.select("node", F.col("node").alias("root"), "unit"), "alone")
    for attempt in range(TRIES):
        lists = _searched(alone, count, k, seed=11 + attempt)
        links, roots = _bridged(lists, _close(lists, vectors, threshold), vectors, threshold, k, seed=1000 * (attempt + 1))
        recall = audit(vectors, lists, links, roots, threshold, k)
        if recall >= LEAST_RECALL:
            break
        if attempt == TRIES - 1:
            raise RuntimeError(f"near vectors: recall of {recall:.4f} with lists of {k}")
        k *= 2
    counts = _link_counts(lists, links, roots, vectors, threshold, k)
    done = vectors.select("node", "vector", "n", "low").join(roots, "node", "left").join(counts, "node", "left")
    done = settled(
        done.select(
            "vector", F.coalesce("root", "node").alias("root"), "low",
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        ),
        "done",
    )
    lowest = done.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = settled(done.join(lowest, "root").select("vector", "n_links", "component_id"), "classes")
    # Floats are compared by value, so unusable vectors meet no class; NULL never matches.
    usable = all_.join(classes.withColumn("found", F.lit(True)), "vector", "left")
    return usable.select(
        "id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("found"), F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
        F.when(F.col("found"), F.col("id").eqNullSafe(F.col("component_id"))).otherwise(F.lit(True)).alias("kept"),
    )
