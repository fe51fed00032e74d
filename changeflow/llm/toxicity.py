"""Toxicity scores from the nearest labelled examples by TF-IDF cosine."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.llm.bpe import Remembered
from changeflow.llm.common import handed_back, settled, shuffle_width, whole_rows
from changeflow.llm.pretokens import chunked, cut_blanks

#: Labelled rows of each class that may serve as examples: those of smallest hashed id.
EXAMPLES = 4000
#: The least association with the label (chi-square, one degree of freedom) and number of
#: examples that a term must have.
LEAST_CHI2 = 20.0
LEAST_EXAMPLES = 3
#: Lengths of the word beginnings that are terms beside the whole words.
BEGINNINGS = (4, 5, 6, 7, 8)
#: Mark of the term that stands for a second occurrence: repetition tells more than presence.
AGAIN = "\u00d72"
NEIGHBOURS = 20
BLOCK = 64


def terms_of(word: str) -> list[str]:
    """The terms a word stands for: itself and its beginnings."""
    word = word.lower()
    return [word[:40], *(f"{word[:n]}*" for n in BEGINNINGS if len(word) > n)]


def _counted(texts: list[str], vocabulary: dict[str, int], known: Remembered) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Terms of the vocabulary in each text, ascending, and how often each occurs."""
    ids, counts = [], []
    nothing = ()
    again = {t.removesuffix(AGAIN): k for t, k in vocabulary.items() if t.endswith(AGAIN)}

    def look(word: str):
        found = tuple(t for t in terms_of(word) if t in vocabulary or t in again)
        return found or nothing

    for part in chunked(texts):
        cut = cut_blanks(texts[part])
        found = known.of(cut.words, look)
        hit = np.fromiter((bool(f) for f in found), dtype=bool, count=len(found))
        where = np.flatnonzero(hit[cut.codes]) if len(found) else np.zeros(0, dtype=np.int64)
        text_of = np.searchsorted(cut.ends, where, side="right")
        per_text: dict[int, dict[str, int]] = {}
        for k, code in zip(text_of.tolist(), cut.codes[where].tolist(), strict=True):
            own = per_text.setdefault(k, {})
            for t in found[code]:
                own[t] = own.get(t, 0) + 1
        for k in range(len(cut.ends)):
            seen = per_text.get(k, {})
            own = sorted(
                [(vocabulary[t], n) for t, n in seen.items() if t in vocabulary]
                + [(again[t], n - 1) for t, n in seen.items() if n > 1 and t in again]
            )
            ids.append(np.array([t for t, _ in own], dtype=np.int32))
            counts.append(np.array([n for _, n in own], dtype=np.int32))
    return ids, counts


_TERMS = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("counts", T.ArrayType(T.IntegerType()))])


def _term_counts(text: Column, vocabulary: list[str]) -> Column:
    kind = pa.list_(pa.int32())

    @F.arrow_udf(_TERMS)
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        def of(found: Iterator[pa.Array]) -> Iterator[pa.Array]:
            position, known = {t: k for k, t in enumerate(vocabulary)}, Remembered()
            for texts in found:
                ids, counts = _counted(texts.to_pylist(), position, known)
                yield pa.StructArray.from_arrays([pa.array(ids, type=kind), pa.array(counts, type=kind)], ["ids", "counts"])

        yield from handed_back(of)(batches)

    return counted(text)


def _frequencies(ids: DataFrame, n: int) -> DataFrame:
    """``t, n``: how many rows hold each of ``n`` terms.  A task adds up one array and sends
    its terms once."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n, dtype=np.int64)
        for batch in batches:
            total += np.bincount(batch.column("ids").flatten().to_numpy(), minlength=n)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["t", "n"])

    return ids.mapInArrow(added, "t int, n long").groupBy("t").agg(F.sum("n").alias("n"))


# -- examples and terms ----------------------------------------------------------------


def examples(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, usable: Column, per_class: int) -> DataFrame:
    """``id, text, toxic``: labelled documents for training, ``per_class`` of each class at
    most.  A document that is labelled twice counts as toxic if one label says so; of
    equal texts one is taken."""
    marked = (
        labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").alias("id"))
        .agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
        .where(usable)
    )
    ids = docs.select(F.col(f"`{id_col}`").alias("id")).distinct()
    there = marked.join(ids, "id", "left_semi")
    drawn = there.where("toxic = 1").orderBy(F.xxhash64("id"), "id").limit(per_class).unionByName(
        there.where("toxic = 0").orderBy(F.xxhash64("id"), "id").limit(per_class)
    )
    chosen = settled(drawn, "chosen")
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    # At most 2 * per_class rows of two numbers.
    return texts.join(F.broadcast(chosen), "id").groupBy("text").agg(F.min("id").alias("id"), F.max("toxic").alias("toxic"))


def _select_terms(taught: DataFrame, n_toxic: int, n_clean: int) -> list[str]:
    """All terms that toxic examples have more often than clean ones, by chi-square."""
    kinds = T.ArrayType(T.StringType())

    @F.arrow_udf(kinds)
    def distinct_terms(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            seen: dict[str, int] = {}
            for w in text.split():
                for t in terms_of(w):
                    seen[t] = seen.get(t, 0) + 1
            out.append([*seen, *(t + AGAIN for t, n in seen.items() if n > 1)])
        return pa.array(out, type=pa.list_(pa.string()))

    seen = taught.select("toxic", F.explode(distinct_terms("text")).alias("term"))
    held = seen.groupBy("term").agg(
        F.sum("toxic").cast("double").alias("a"), F.sum(1 - F.col("toxic")).cast("double").alias("b")
    )
    total = float(n_toxic + n_clean)
    a, b = F.col("a"), F.col("b")
    c, d = F.lit(float(n_toxic)) - a, F.lit(float(n_clean)) - b
    scored = held.where((a >= LEAST_EXAMPLES) & (a * n_clean > b * n_toxic)).select(
        "term", (F.lit(total) * (a * d - b * c) ** 2 / F.nullif((a + b) * (c + d) * n_toxic * n_clean, F.lit(0.0))).alias("chi2")
    )
    best = scored.where(F.col("chi2") >= LEAST_CHI2).orderBy(F.desc("chi2"), "term")
    return [r["term"] for r in best.collect()]


# -- the model ------------------------------------------------------------------------------


class Rows:
    """Sparse rows, none of them empty: the terms and weights of each."""

    def __init__(self, ids: list[np.ndarray], weights: list[np.ndarray], width: int):
        self.starts = np.concatenate([[0], np.cumsum([len(i) for i in ids], dtype=np.int64)]).astype(np.int64)
        self.ids = np.concatenate([np.zeros(0, dtype=np.int64), *ids]).astype(np.int64)
        self.weights = np.concatenate([np.zeros(0), *weights])
        self.width = width

    def __len__(self) -> int:
        return len(self.starts) - 1

    def __matmul__(self, other: np.ndarray) -> np.ndarray:
        return self.times(other, 0, len(self))

    def times(self, other: np.ndarray, first: int, last: int) -> np.ndarray:
        """The products of rows ``first`` to ``last`` with a dense vector."""
        at = self.starts[first : last + 1]
        if last <= first:
            return np.zeros(0)
        return np.add.reduceat(self.weights[at[0] : at[-1]] * other[self.ids[at[0] : at[-1]]], at[:-1] - at[0])


@dataclass
class Model:
    """Example vectors with their votes, in blocks; all of bounded size."""

    vocabulary: list[str]
    idf: np.ndarray
    vectors: Rows  # distinct unit vectors
    votes: np.ndarray  # weight of toxic and of clean examples of each vector
    ids: np.ndarray  # an example of each vector
    prior: float
    bare: float  # share of toxic ones among examples without any term
    slope: float = 1.0
    offset: float = 0.0
    _memo: dict = field(default_factory=dict)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("block_max", "postings", "_memo")} | {"_memo": {}}

    @cached_property
    def postings(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows and weights by term, and where each term begins."""
        rows = np.repeat(np.arange(len(self.vectors)), np.diff(self.vectors.starts))
        order = np.argsort(self.vectors.ids, kind="stable")
        begins = np.searchsorted(self.vectors.ids[order], np.arange(len(self.idf) + 1))
        return rows[order], self.vectors.weights[order], begins

    @cached_property
    def block_max(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Blocks and the greatest weight in each by term, and where each term begins."""
        rows, weights, begins = self.postings
        key = np.repeat(np.arange(len(self.idf)), np.diff(begins)) * (len(self.vectors) // BLOCK + 1) + rows // BLOCK
        cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=np.int64)
        most = np.maximum.reduceat(weights, cut) if len(cut) else np.zeros(0)
        return rows[cut] // BLOCK, most, np.searchsorted(cut, begins)

    @staticmethod
    def _added(listed: tuple[np.ndarray, np.ndarray, np.ndarray], ids: np.ndarray, weights: np.ndarray, size: int) -> np.ndarray:
        """For each place in the lists of the terms, the sum of its weights times theirs."""
        places, values, begins = listed
        parts = [slice(begins[t], begins[t + 1]) for t in ids]
        if not parts:
            return np.zeros(size)
        return np.bincount(
            np.concatenate([places[p] for p in parts]),
            np.concatenate([values[p] * w for p, w in zip(parts, weights, strict=True)]), size,
        )

    def unit(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        weights = (1.0 + np.log(counts)) * self.idf[ids]
        norm = math.sqrt(float(weights @ weights))
        return weights / norm if norm else weights

    def nearest(self, ids: np.ndarray, weights: np.ndarray, leave: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The most similar vectors and their cosines, exactly; ties go to the smaller position.

        The blocks that can reach most are read first.  What the last of their neighbours has
        decides which of the other blocks are read at all.
        """
        size = len(self.vectors)
        bound = self._added(self.block_max, ids, weights, -(-size // BLOCK))
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        at, found = np.zeros(0, dtype=np.int64), np.zeros(0)
        first = -(-NEIGHBOURS // BLOCK) + 1
        for step in (order[:first], order[first:]):
            if len(at) >= NEIGHBOURS:
                step = step[bound[step] >= found[-1] - 1e-11]
            if not len(step):
                continue
            rows = (step[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            rows = rows[rows < size]
            starts, begins = self.vectors.starts, self.postings[2]
            held = sum(starts[min((k + 1) * BLOCK, size)] - starts[k * BLOCK] for k in step)
            if held < (begins[ids + 1] - begins[ids]).sum():
                asked = np.zeros(len(self.idf))
                asked[ids] = weights
                sims = np.concatenate([self.vectors.times(asked, k * BLOCK, min((k + 1) * BLOCK, size)) for k in step])
            else:
                sims = self._added(self.postings, ids, weights, size)[rows]
            use = (sims > 0) & (rows != leave)
            at, found = np.concatenate([at, rows[use]]), np.concatenate([found, sims[use]])
            if len(found) > NEIGHBOURS:
                use = found >= np.partition(found, -NEIGHBOURS)[-NEIGHBOURS] - 1e-11
                at, found = at[use], found[use]
            best = np.lexsort((at, -np.round(found, 12)))[:NEIGHBOURS]
            at, found = at[best], found[best]
        return at, found

    def vote(self, ids: np.ndarray, counts: np.ndarray, leave: int = -1) -> tuple[float, np.ndarray, np.ndarray]:
        """Share of the toxic votes, weighted by similarity; one vote for the prior."""
        if not len(ids):
            return self.bare, np.zeros(0, dtype=np.int64), np.zeros(0)
        at, sims = self.nearest(ids, self.unit(ids, counts), leave)
        toxic, clean = (self.votes[at] * sims[:, None] ** 2).sum(axis=0)
        near = 0.5 * float(sims.max()) if len(sims) else 0.0
        anchor = max(0.05, 1.0 - 2.0 * near) if len(sims) else 1.0
        return (toxic + anchor * self.prior) / (toxic + clean + anchor), at, sims

    def score(self, ids: np.ndarray, counts: np.ndarray, with_evidence: bool = True) -> tuple:
        """Score, and with evidence the neighbours and their cosines."""
        key = ids.tobytes() + counts.tobytes()
        found = self._memo.get(key)
        if found is None:
            share, at, sims = self.vote(ids, counts)
            found = (self.calibrated(share) if len(ids) else share, *((at, sims) if with_evidence else (None, None)))
            if len(self._memo) < 50_000:
                self._memo[key] = found
        return found

    def calibrated(self, share: float) -> float:
        share = min(max(share, 1e-6), 1 - 1e-6)
        z = self.slope * math.log(share / (1 - share)) + self.offset
        return 1 / (1 + math.exp(-max(min(z, 50.0), -50.0)))

    def calibrate(self, shares: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> None:
        """Logistic regression of the labels on the left-out votes, by Newton steps."""
        if len(shares) < 2 or toxic.min() == toxic.max():
            return
        clipped = np.clip(shares, 1e-6, 1 - 1e-6)
        x = np.column_stack([np.log(clipped / (1 - clipped)), np.ones(len(shares))])
        beta, pull = np.array([1.0, 0.0]), np.array([1.0, 0.1])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -50, 50)))
            slope = x.T @ (weight * (toxic - p)) - pull * (beta - [1.0, 0.0])
            curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(pull)
            step = np.linalg.solve(curve, slope)
            beta = beta + np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-8:
                break
        self.slope, self.offset = (float(b) for b in beta) if beta[0] > 0.05 else (1.0, 0.0)


def fit(rows: list, class_sizes: dict[int, int], vocabulary: list[str], df: np.ndarray, documents: int) -> Model:
    """From examples (id, toxic, ids, counts).  Votes weigh as many rows as each example
    stands for, so that shares are shares of all labelled documents."""
    drawn = {c: max(1, sum(1 for r in rows if r["toxic"] == c)) for c in (0, 1)}
    per = {c: class_sizes.get(c, 0) / drawn[c] for c in (0, 1)}
    prior = (class_sizes.get(1, 0) + 0.5) / (sum(class_sizes.values()) + 2.0)
    idf = np.log((1.0 + documents) / (1.0 + df)) + 1.0
    model = Model(vocabulary, idf, Rows([], [], len(idf)), np.zeros((0, 2)), np.zeros(0, dtype=np.int64), prior, prior)
    bare = [r for r in rows if not r["ids"]]
    held = sum(per[r["toxic"]] for r in bare)
    model.bare = (sum(per[1] for r in bare if r["toxic"]) + prior) / (held + 1.0)
    merged: dict[bytes, list] = {}
    for r in sorted((r for r in rows if r["ids"]), key=lambda r: (r["ids"], r["counts"], r["id"])):
        ids, counts = np.array(r["ids"]), np.array(r["counts"])
        weights = model.unit(ids, counts)
        own = merged.setdefault(ids.tobytes() + weights.tobytes(), [weights, 0.0, 0.0, r["id"], ids, counts, 0, 0])
        own[1 if r["toxic"] else 2] += per[r["toxic"]]
        own[6 if r["toxic"] else 7] += 1
    entries = list(merged.values())
    if entries:
        model.vectors = Rows([e[4] for e in entries], [e[0] for e in entries], len(idf))
        model.votes = np.array([[e[1], e[2]] for e in entries])
        model.ids = np.array([e[3] for e in entries])
        shares = np.array([model.vote(e[4], e[5], leave=k)[0] for k, e in enumerate(entries)])
        labels = np.repeat([1.0, 0.0], len(entries))
        weights = np.concatenate([model.votes[:, 0], model.votes[:, 1]])
        model.calibrate(np.tile(shares, 2), labels, weights)
    return model


# -- the operator -----------------------------------------------------------------------------


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: bool = False,
    per_class: int = EXAMPLES,
    with_evidence: bool = True,
) -> DataFrame:
    """One row per input row: ``id, score, predicted``, ``with_evidence`` also ``evidence``
    and, with ``carry``, the input row as ``row``.

    ``labels`` has ``doc_id, toxic``; ``usable`` says, of its column ``id``, which may be
    learned from.  Examples are a bounded sample; document frequencies cover all rows.
    ``evidence`` lists an example id, its cosine and share of toxic votes for each
    neighbour.  NULL counts as empty text.  A text without any term gets the share of
    toxic ones among such examples, and without labels every text 0.25.
    """
    taught = settled(examples(docs, labels, id_col, text_col, usable, per_class), "examples")
    drawn = {r["toxic"]: r["n"] for r in taught.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    sizes = {
        r["toxic"]: r["n"]
        for r in labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL")
        .select(F.col("doc_id").alias("id"), (F.col("toxic") == 1).cast("int").alias("toxic"))
        .where(usable).groupBy("toxic").agg(F.count("*").alias("n")).collect()
    }
    vocabulary = _select_terms(taught, drawn[1], drawn[0]) if len(drawn) == 2 else []

    rows = whole_rows(docs, id=F.col(f"`{id_col}`"), text=F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    counted = settled(rows.select("id", _term_counts(F.col("text"), vocabulary).alias("terms")), "terms")
    df = np.zeros(len(vocabulary))
    for r in _frequencies(counted.select("terms.ids"), len(vocabulary)).collect():
        df[r["t"]] = r["n"]
    learned = taught.select("id", "toxic", _term_counts(F.col("text"), vocabulary).alias("terms"))
    model = fit(
        learned.select("id", "toxic", "terms.ids", "terms.counts").collect(), sizes, vocabulary, df, counted.count()
    )
    neighbour = T.StructType(
        [T.StructField("id", T.LongType()), T.StructField("cosine", T.DoubleType()), T.StructField("toxic", T.DoubleType())]
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # Whole rows are not written with their terms: those are counted once more, in the same
    # Python worker that scores them.  Terms alone are little, and spread over all tasks.
    source = rows if carry else counted.repartition(shuffle_width(docs.sparkSession))
    kept = [f for f in rows.schema.fields if f.name == "id" or (carry and f.name == "row")]
    fields = [*kept, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    if with_evidence:
        fields.append(T.StructField("evidence", T.ArrayType(neighbour)))
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        position, words = {t: k for k, t in enumerate(known.vocabulary)}, Remembered()
        member = pa.struct([("id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.float64())])
        for batch in batches:
            if carry:
                texts = pc.struct_field(batch.column("row"), text_col) if inside else batch.column("text")
                found = zip(*_counted([t or "" for t in texts.to_pylist()], position, words), strict=True)
            else:
                ids, counts = (_split(batch.column("terms").field(k)) for k in (0, 1))
                found = zip(ids, counts, strict=True)
            scores, evidence = [], []
            for own, often in found:
                score, at, sims = known.score(own.astype(np.int64), often.astype(np.int64), with_evidence)
                scores.append(score)
                if with_evidence:
                    evidence.append(
                        [
                            {"id": int(known.ids[k]), "cosine": float(c), "toxic": float(known.votes[k, 0] / known.votes[k].sum())}
                            for k, c in zip(at, sims, strict=True)
                        ]
                    )
            columns = [*(batch.column(f.name) for f in kept), pa.array(scores, pa.float64())]
            columns.append(pa.array([int(x >= 0.5) for x in scores], pa.int32()))
            if with_evidence:
                columns.append(pa.array(evidence, type=pa.list_(member)))
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    # The row has the text already.
    inside = carry and isinstance(docs.schema[text_col].dataType, T.StringType)
    wanted = [f.name for f in kept] + ([] if inside else ["text"] if carry else ["terms"])
    done = source.select(*wanted).mapInArrow(handed_back(run), schema)
    order = [*(["row"] if carry else []), "id", "score", "predicted", *(["evidence"] if with_evidence else [])]
    return done.select(*order)


def _split(lists: pa.Array) -> list[np.ndarray]:
    return [np.asarray(x) for x in np.split(lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())[:-1])]


def held_out(id_: Column, folds: int = 5) -> Column:
    """Whether a document is kept from training: the CRC-32 of its id as text, modulo."""
    return F.coalesce(F.crc32(id_.cast("string")) % folds == 0, F.lit(False))
