"""WARC archives: written with revisits for repeated payloads, read back by verified boundaries."""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.llm.common import settled

#: Fixed values of the format: what every record starts with and ends on.
MAGIC = b"WARC/1."
RECORD_END = "\r\n\r\n"
LEAST_REVISIT = 100
RECORDS_IN_FILE = 4096
URN = "urn:x-page:"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


# -- writing -------------------------------------------------------------------------


def _revisits(pages: DataFrame, least: int) -> DataFrame:
    """``id, digest, refers_to`` of rows that repeat the payload of a smaller id."""
    long = settled(pages.where(F.col("payload_bytes") >= least).select("id", "digest"), "digests")
    # Counted before rows meet: a payload of a third of all pages is one row here.
    firsts = settled(
        long.groupBy("digest").agg(F.min("id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n"),
        "firsts",
    )
    found = long.join(firsts, "digest").where(~F.col("id").eqNullSafe(F.col("refers_to")))
    return settled(found.select("id", "digest", "refers_to").distinct(), "revisits")


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    least_revisit: int = LEAST_REVISIT, date: str = "1970-01-01T00:00:00Z",
) -> None:
    """One record per row, in uncompressed archives under ``folder``.

    Of rows with equal payloads of at least ``least_revisit`` bytes those with the smallest
    id are responses, others revisit it.  NULL payloads count as empty; a row without id
    revisits if another row of its payload has one.  The payload is moved once, and only
    if there are too many revisits to broadcast.
    """
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit(""))
    url = F.col(f"`{url_col}`").cast("string") if url_col in pages.columns else F.lit(None).cast("string")
    rows = pages.select(
        F.col(f"`{id_col}`").alias("id"),
        F.regexp_replace(F.coalesce(url, F.lit("")), r"[\r\n]+", " ").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).alias("payload_bytes"),
        F.sha2(payload, 256).alias("digest"),
    )
    revisits = _revisits(rows, least_revisit)
    marked = rows.join(
        revisits.select(F.col("id").alias("rid"), F.col("digest").alias("rdigest"), "refers_to"),
        F.col("id").eqNullSafe(F.col("rid")) & (F.col("digest") == F.col("rdigest")),
        "left",
    )
    again = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit("\r\n\r\n"),
    )
    block = F.when(again, http).otherwise(F.concat(http, "payload"))
    header = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.0"),
        F.concat(F.lit("WARC-Type: "), F.when(again, "revisit").otherwise("response")),
        F.concat(F.lit(f"WARC-Record-ID: <{URN}"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(">")),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), "url"),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), "digest"),
        F.when(again, F.concat(F.lit(f"WARC-Refers-To: <{URN}"), F.col("refers_to").cast("string"), F.lit(">"))),
        F.when(again, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    )
    record = F.concat(header, F.lit("\r\n\r\n"), block)
    # The text writer ends each row with the line separator, as each record must end.
    marked.select(record.alias("value")).write.option("lineSep", RECORD_END).option(
        "maxRecordsPerFile", RECORDS_IN_FILE
    ).text(folder)


# -- reading -----------------------------------------------------------------------------

_RECORD = [
    T.StructField("type", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("refers_to", T.StringType()),
    T.StructField("target", T.StringType()),
    T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()),
    T.StructField("payload", T.BinaryType()),
]
_RECORD_TYPES = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]


def _headers(part: bytes) -> tuple[dict[bytes, bytes], int] | None:
    """The named fields of a record that starts with ``part`` after the magic, and where its
    block begins; None if these are not the headers of a record."""
    end = part.find(b"\r\n\r\n")
    if end < 0:
        return None
    first, *lines = part[:end].split(b"\r\n")
    if not first.isdigit():
        return None
    fields = {}
    for line in lines:
        name, sign, value = line.partition(b":")
        if not sign:
            return None
        fields[name.strip().lower()] = value.strip()
    if not fields.get(b"content-length", b"").isdigit() or b"warc-type" not in fields:
        return None
    return fields, end + 4


def _unfinished(part: bytes) -> bool:
    """Whether ``part`` may be headers that a magic cut before their end: all whole lines fit."""
    first, *lines = part.split(b"\r\n")
    return bool(lines) and b"\r\n\r\n" not in part and first.isdigit() and all(b":" in line for line in lines[:-1])


def _reaches(parts: list[bytes], opens: list[bool]) -> list[int | None]:
    """For pieces in a row, of which only the last has a blank line: where the successor of
    each that opens headers begins, from its magic on; None if these are no headers.

    The lines are read once, from the last to the first, for all openings together.
    """
    text = MAGIC.join(parts)
    end = text.find(b"\r\n\r\n", len(text) - len(parts[-1]))
    starts, fits, at = [], [], end
    good, kind, length = True, False, None
    while (cut := text.rfind(b"\r\n", 0, at)) >= 0:
        name, sign, value = text[cut + 2 : at].partition(b":")
        name = name.strip().lower()
        good, kind = good and bool(sign), kind or name == b"warc-type"
        if name == b"content-length" and length is None:
            length = value.strip()
        starts.append(cut)
        fits.append(int(length) if good and kind and length is not None and length.isdigit() else None)
        at = cut
    starts.reverse()
    fits.reverse()
    out, place = [], 0
    for part, asks in zip(parts, opens, strict=True):
        line = bisect_right(starts, place)
        size = fits[line] if asks and line < len(starts) else None
        out.append(None if size is None else len(MAGIC) + end + 4 - place + size + len(RECORD_END))
        place += len(part) + len(MAGIC)
    return out


def _record(part: bytes, with_payload: bool) -> tuple:
    """What a complete record says; its payload is measured and digested."""
    fields, begin = _headers(part)
    block = part[begin : begin + int(fields[b"content-length"])]
    http, sign, payload = block.partition(b"\r\n\r\n")
    if not (sign and http.startswith(b"HTTP/")):
        http, payload = b"", block
    kind = fields[b"warc-type"].decode()
    if kind == "revisit":
        size = next((v for n, _, v in (h.partition(b":") for h in http.split(b"\r\n")) if n.lower() == b"content-length"), b"0")
        size, digest, payload = int(size), fields.get(b"warc-payload-digest", b"").removeprefix(b"sha256:").decode(), None
    else:
        size, digest = len(payload), hashlib.sha256(payload).hexdigest()

    def named(field: bytes) -> str | None:
        value = fields.get(field, b"").decode("utf-8", "replace").strip("<>").removeprefix(URN)
        return value or None

    return (
        kind, named(b"warc-record-id"), named(b"warc-refers-to"), named(b"warc-target-uri"), size, digest,
        payload if with_payload else None,
    )


def _fragments(spark: SparkSession, folder: str, with_payload: bool) -> DataFrame:
    """The archives cut at every magic, also at those inside payloads, one row a piece:
    ``file, block, rel`` (bytes since the block's first piece), ``size`` (with the magic that
    ends it), ``head`` (no magic before it), ``reach`` (bytes from the magic to the
    successor, if these are headers), ``opens`` (headers that go on in the next piece),
    ``blank`` (has a blank line), the record if all of it is here, else ``raw``.

    Long files are read in blocks.  Pieces come in order, so their places within a block
    are sums; the blocks' own places follow from the sums of the blocks.
    """
    lines = spark.read.option("lineSep", MAGIC.decode()).text(folder).select(
        F.col("value").cast("binary").alias("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    schema = T.StructType(
        [
            T.StructField("file", T.StringType()),
            T.StructField("block", T.LongType()),
            T.StructField("rel", T.LongType()),
            T.StructField("size", T.LongType()),
            T.StructField("head", T.BooleanType()),
            T.StructField("reach", T.LongType()),
            T.StructField("opens", T.BooleanType()),
            T.StructField("blank", T.BooleanType()),
            T.StructField("raw", T.BinaryType()),
            *_RECORD,
        ]
    )
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary(), *_RECORD_TYPES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, rel = None, 0
        for batch in batches:
            rows = []
            for value, file, block in zip(
                batch.column("value"), batch.column("file").to_pylist(), batch.column("block").to_pylist(), strict=True
            ):
                value = value.as_py()
                if here != (file, block):
                    here, rel = (file, block), 0
                head = block == 0 and rel == 0
                found = None if head else _headers(value)
                reach = raw = None
                record = (None,) * len(_RECORD)
                if found:
                    reach = len(MAGIC) + found[1] + int(found[0][b"content-length"]) + len(RECORD_END)
                if found and reach == len(MAGIC) + len(value):
                    record = _record(value, with_payload)
                else:
                    raw = value
                opens = not head and not found and _unfinished(value)
                blank = bool(found) or b"\r\n\r\n" in value
                rows.append((file, block, rel, len(value) + len(MAGIC), head, reach, opens, blank, raw, *record))
                rel += len(value) + len(MAGIC)
            columns = zip(*rows, strict=True) if rows else [[] for _ in types]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(columns, types, strict=True)], names=schema.fieldNames()
            )

    return lines.mapInArrow(run, schema)


def _stitched(spark: SparkSession, folder: str, placed: DataFrame, blocks: DataFrame) -> DataFrame:
    """``file, start, late`` of pieces whose headers hold a magic: ``late`` is their reach, read
    from the piece and those after it up to the first blank line, also in later blocks."""
    # From the end of the file on: the next piece with a blank line.
    after = Window.partitionBy("file").orderBy(F.desc("start")).rowsBetween(Window.unboundedPreceding, 0)
    runs = placed.where("NOT head").select(
        "file", "start", "opens", F.last(F.when(F.col("blank"), F.col("start")), ignorenulls=True).over(after).alias("run")
    )
    runs = settled(runs.where("run IS NOT NULL"), "runs")
    asked = runs.where("opens").groupBy("file", "run").agg(F.min("start").alias("since"))
    members = runs.join(asked, ["file", "run"]).where("start >= since").drop("since")

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def reaches(runs_: pa.Array) -> pa.Array:
        return pa.array(
            [_reaches([p["value"] for p in parts], [p["opens"] for p in parts]) for parts in runs_.to_pylist()],
            type=pa.list_(pa.int64()),
        )

    grouped = members.join(_placed_bytes(spark, folder, blocks), ["file", "start"]).groupBy("file", "run").agg(
        F.sort_array(F.collect_list(F.struct("start", "opens", "value"))).alias("parts")
    )
    found = grouped.select("file", F.col("parts.start").alias("start"), reaches("parts").alias("late"))
    each = found.select("file", F.explode(F.arrays_zip("start", "late")).alias("p")).select("file", "p.start", "p.late")
    return settled(each.where("late IS NOT NULL"), "stitched")


def _reachable(candidates: DataFrame) -> DataFrame:
    """The candidates (file, start, next) on the chain from the start of their file.

    Pointer jumping: each round doubles how far every pointer leads, and marks what the
    marked ones lead to, so a file of n records takes log2(n) rounds.
    """
    now = settled(
        candidates.select("file", "start", F.col("next").alias("to"), (F.col("start") == 0).alias("on")), "chain"
    )
    marked = -1
    while (n := now.where("on").count()) != marked:
        marked = n
        far = now.select("file", F.col("start").alias("to"), F.col("to").alias("beyond"))
        hit = now.where("on").select("file", F.col("to").alias("start"), F.lit(True).alias("hit")).distinct()
        now = settled(
            now.join(far, ["file", "to"], "left").join(hit, ["file", "start"], "left").select(
                "file", "start", F.coalesce("beyond", "to").alias("to"),
                (F.col("on") | F.coalesce("hit", F.lit(False))).alias("on"),
            ),
            "chain",
        )
    return now.where("on").select("file", "start")


def read_archives(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """One row per record: ``file, start, type, id, refers_to, target, payload_bytes,
    payload_digest`` and, if asked for, ``payload``.

    A piece of text that looks like a record inside a payload is never returned: only
    records on the chain of lengths from the start of their file are.  A file whose chain
    breaks before its end raises ValueError.  The digest is worked out from the bytes of a
    response and taken from the header of a revisit.  No archives, no rows.
    """
    pieces = settled(_fragments(spark, folder, with_payload), "pieces")
    order = Window.partitionBy("file").orderBy("block")
    blocks = pieces.groupBy("file", "block").agg(F.sum("size").alias("bytes")).select(
        "file", "block",
        (F.sum("bytes").over(order) - F.col("bytes")).alias("base"),
    )
    # Blocks are as many as read tasks.
    placed = pieces.join(blocks, ["file", "block"]).withColumn("start", F.col("base") + F.col("rel") - len(MAGIC))
    if not placed.where("opens").isEmpty():
        late = _stitched(spark, folder, placed, blocks)
        placed = placed.join(late, ["file", "start"], "left").withColumn("reach", F.coalesce("reach", "late")).drop("late")
    candidates = placed.where("reach IS NOT NULL").select("file", "start", (F.col("start") + F.col("reach")).alias("next"))
    good = _reachable(candidates)
    # The last piece has no magic behind it, the one before the first magic is empty.
    lengths = pieces.groupBy("file").agg((F.sum("size") - len(MAGIC)).alias("bytes"))
    ends = candidates.join(good, ["file", "start"]).groupBy("file").agg(F.max("next").alias("end"))
    broken = lengths.join(ends, "file", "left").where("NOT end <=> bytes").select("file", "end", "bytes").limit(3).collect()
    if broken:
        raise ValueError("archives that are not whole: " + "; ".join(f"{r.file} ends at {r.end} of {r.bytes}" for r in broken))
    names = [f.name for f in _RECORD if with_payload or f.name != "payload"]
    whole = placed.where("raw IS NULL AND NOT head").join(good, ["file", "start"]).select("file", "start", *names)

    # Records cut by a magic inside their payload: their pieces, put together again.
    long = placed.where("raw IS NOT NULL AND reach IS NOT NULL").join(good, ["file", "start"]).select(
        "file", F.col("start").alias("record"), (F.col("start") + F.col("reach")).alias("next")
    )
    long = settled(long, "long")
    if long.isEmpty():
        return whole
    # The last chain record at or before each piece owns it.
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    owned = (
        placed.where("NOT head").select("file", "start")
        .join(long.select("file", F.col("record").alias("start"), F.lit(True).alias("opens"), "next"), ["file", "start"], "left")
        .select(
            "file", "start",
            F.last(F.when(F.col("opens"), F.col("start")), ignorenulls=True).over(before).alias("record"),
            F.last(F.when(F.col("opens"), F.col("next")), ignorenulls=True).over(before).alias("until"),
        )
        .where("start < until")
    )
    # Complete look-alikes inside a payload have no raw bytes; those are read again.
    bytes_ = _placed_bytes(spark, folder, blocks)
    kind = T.StructType(_RECORD)

    @F.arrow_udf(kind)
    def assembled(values: pa.Array) -> pa.Array:
        found = [_record(MAGIC.join(p["value"] for p in parts), with_payload) for parts in values.to_pylist()]
        columns = zip(*found, strict=True) if found else [[] for _ in _RECORD]
        return pa.StructArray.from_arrays(
            [pa.array(c, type=t) for c, t in zip(columns, _RECORD_TYPES, strict=True)], [f.name for f in _RECORD]
        )

    joined = (
        owned.join(bytes_, ["file", "start"]).groupBy("file", "record")
        .agg(F.sort_array(F.collect_list(F.struct("start", "value"))).alias("parts"))
        .select("file", F.col("record").alias("start"), assembled("parts").alias("r"))
    )
    return whole.unionByName(joined.select("file", "start", *(F.col(f"r.{n}").alias(n) for n in names)))


def _placed_bytes(spark: SparkSession, folder: str, blocks: DataFrame) -> DataFrame:
    """``file, start, value`` of every piece."""
    return _fragment_bytes(spark, folder).join(blocks, ["file", "block"]).select(
        "file", (F.col("base") + F.col("rel") - len(MAGIC)).alias("start"), "value"
    )


def _fragment_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """``file, block, rel, value`` of every piece."""
    lines = spark.read.option("lineSep", MAGIC.decode()).text(folder).select(
        F.col("value").cast("binary").alias("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    schema = T.StructType(
        [
            T.StructField("file", T.StringType()),
            T.StructField("block", T.LongType()),
            T.StructField("rel", T.LongType()),
            T.StructField("value", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, at = None, 0
        for batch in batches:
            rel = []
            for value, file, block in zip(
                batch.column("value"), batch.column("file").to_pylist(), batch.column("block").to_pylist(), strict=True
            ):
                if here != (file, block):
                    here, at = (file, block), 0
                rel.append(at)
                at += len(value.as_buffer()) + len(MAGIC)
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("block"), pa.array(rel, type=pa.int64()), batch.column("value")],
                names=schema.fieldNames(),
            )

    return lines.mapInArrow(run, schema)
