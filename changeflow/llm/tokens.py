"""Token counts and exact encoding of whole texts with a byte-level BPE vocabulary."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.llm.bpe import ByteBPE, byte_bpe, remembered
from changeflow.llm.pretokens import chunked, cut_signs, gathered


def _split_odd(model: ByteBPE, texts: list[str]) -> tuple[list[str], dict[int, str]]:
    """Texts for the fast cutter, and by position those that the library must cut."""
    odd = {k: t for k, t in enumerate(texts) if model.is_odd(t)}
    return ["" if k in odd else t for k, t in enumerate(texts)], odd


def count_texts(path: str, texts: list[str]) -> np.ndarray:
    """How many tokens each text has.

    Pre-tokens that are proved to encode as one token count one each; only the others
    are merged.
    """
    model = byte_bpe(path)
    whole, known = model.whole, remembered("counts", path)
    out = np.zeros(len(texts), dtype=np.int64)

    def merged(word: str) -> int:
        return len(model.merged(word.encode()))

    for part in chunked(texts):
        plain, odd = _split_odd(model, texts[part])
        cut = cut_signs(plain)
        rest = [w for w in cut.words if w not in whole]
        sizes = np.ones(len(cut.words), dtype=np.int64)
        sizes[[k for k, w in enumerate(cut.words) if w not in whole]] = known.of(rest, merged)
        total = np.concatenate([[0], np.cumsum(sizes[cut.codes])])
        out[part] = np.diff(total[np.concatenate([[0], cut.ends])])
        for k, text in odd.items():
            words = model.odd_words(text)
            out[part.start + k] = sum(1 if isinstance(w, int) else len(model.merged(w)) for w in words)
    return out


def encode_texts(path: str, texts: list[str]) -> Iterator[np.ndarray]:
    """The ids of each text, by the backtracking encoder."""
    model = byte_bpe(path)
    known = remembered("ids", path)

    def encoded(word: str) -> np.ndarray:
        return np.array(model.encode_word(word.encode()), dtype=np.uint32).tobytes()

    for part in chunked(texts):
        plain, odd = _split_odd(model, texts[part])
        cut = cut_signs(plain)
        found = known.of(cut.words, encoded)
        flat = np.frombuffer(b"".join(found), dtype=np.uint32)
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        starts = np.cumsum(lengths) - lengths
        used = lengths[cut.codes]
        ids = flat[gathered(starts[cut.codes], used)]
        ends = np.concatenate([[0], np.cumsum(used)])[np.concatenate([[0], cut.ends])]
        for k in range(len(plain)):
            if k in odd:
                words = model.odd_words(odd[k])
                yield np.array(
                    [i for w in words for i in ([w] if isinstance(w, int) else model.encode_word(w))], dtype=np.uint32
                )
            else:
                yield ids[ends[k] : ends[k + 1]]


def decode_ids(path: str, ids: np.ndarray) -> str:
    """The text of ids: each token's bytes from the offset table."""
    data, starts, lengths = byte_bpe(path).offsets
    return data[gathered(starts[ids], lengths[ids])].tobytes().decode("utf-8", "replace")


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id, n_bytes, n_tokens``.  NULL text counts as empty, which
    has no tokens.  Special strings inside a text are one token each."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    schema = T.StructType([rows.schema["id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            sizes = pa.array([len(t) if t.isascii() else len(t.encode()) for t in texts], type=pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), sizes, pa.array(count_texts(path, texts), type=pa.int64())],
                names=schema.fieldNames(),
            )

    return rows.mapInArrow(run, schema)


def encoded_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", full: bool = True) -> DataFrame:
    """One row per input row: ``id, n_tokens, ids_sha256, decoded_sha256`` and, with
    ``full``, ``ids`` and ``decoded``.

    The digests are of the decimal ids joined by commas and of the decoded text.  NULL
    text counts as empty: no ids.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    fields = [
        rows.schema["id"],
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
    if full:
        fields += [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    schema = T.StructType(fields)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decimal = list(map(str, range(len(byte_bpe(path).token))))
        for batch in batches:
            rows: list[list] = [[] for _ in fields[1:]]
            for ids in encode_texts(path, batch.column("text").to_pylist()):
                decoded = decode_ids(path, ids)
                joined = ",".join([decimal[i] for i in ids.tolist()])
                row = [len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()]
                for column, value in zip(rows, [*row, ids.astype(np.int32), decoded], strict=False):
                    column.append(value)
            types = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array(c, type=t) for c, t in zip(rows, types, strict=False))],
                names=schema.fieldNames(),
            )

    return rows.mapInArrow(run, schema)
