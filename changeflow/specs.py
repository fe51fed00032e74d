"""The captured tables: what is on the wire and what is stored.

A change event is one flat JSON object.  Each payload field has a *kind* that
fixes its wire type, its stored type and the value stored for a NULL.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T


@dataclass(frozen=True)
class Kind:
    wire: T.DataType
    stored: T.DataType
    decode: str  # SQL: wire column {c} -> stored value, never NULL

    def stored_expr(self, column: str | None) -> str:
        """SQL of the stored value; ``None`` for a column that is not there."""
        wire = self.wire.simpleString()
        return self.decode.format(c=f"`{column}`" if column else f"cast(NULL AS {wire})")


TEXT = Kind(T.StringType(), T.StringType(), "coalesce({c}, '')")
INT = Kind(T.IntegerType(), T.IntegerType(), "coalesce({c}, 0)")
LONG = Kind(T.LongType(), T.LongType(), "coalesce({c}, 0L)")
FLAG = Kind(T.ByteType(), T.IntegerType(), "coalesce(cast({c} AS int), 0)")
MONEY = Kind(T.DoubleType(), T.DoubleType(), "coalesce({c}, 0D)")
# days since 1970-01-01
DAY = Kind(T.IntegerType(), T.DateType(), "date_from_unix_date(coalesce({c}, 0))")
# ms since 1970-01-01 UTC
INSTANT = Kind(T.LongType(), T.TimestampType(), "timestamp_millis(coalesce({c}, 0L))")
TIME_OF_DAY = INT  # ms since midnight


@dataclass(frozen=True)
class Field:
    wire: str
    kind: Kind
    stored: str | None  # None: parsed, not stored


# Change metadata on every event.  __seq is the arrival order inside the source:
# the Kafka offset, or a number carried by files.  It breaks ties of __ts_ms.
META_WIRE = (
    T.StructField("__op", T.StringType()),
    T.StructField("__ts_ms", T.LongType()),
    T.StructField("__source_ts_ms", T.LongType()),
    T.StructField("__deleted", T.StringType()),
)
SEQ_WIRE = "__seq"
META_STORED = (
    T.StructField("_op", T.StringType()),
    T.StructField("_ts_ms", T.LongType()),
    T.StructField("_source_ts_ms", T.LongType()),
    T.StructField("_is_deleted", T.IntegerType()),
    T.StructField("_seq", T.LongType()),
)


@dataclass(frozen=True)
class TableSpec:
    name: str
    source: str  # table name in the operational database, last part of the topic
    fields: tuple[Field, ...]
    key: tuple[str, ...]  # stored names; one current row per key
    event_time: str  # stored name of the business time column
    block_rows: int  # upper bound of events per micro-batch and trigger
    nullable_key: tuple[str, ...] = ()  # key fields that may be NULL at the source

    @property
    def stored_fields(self) -> tuple[Field, ...]:
        return tuple(f for f in self.fields if f.stored)

    @property
    def columns(self) -> list[str]:
        return [f.stored for f in self.stored_fields]

    @property
    def wire_key(self) -> list[str]:
        return [f.wire for f in self.fields if f.stored in self.key]

    @property
    def needed_key(self) -> list[str]:
        """Key fields without which a message is unusable; the others get their default."""
        return [f.wire for f in self.fields if f.stored in self.key and f.stored not in self.nullable_key]

    def payload_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.wire, f.kind.wire) for f in self.fields])

    def wire_schema(self) -> T.StructType:
        return T.StructType([*self.payload_schema().fields, *META_WIRE])

    def stored_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.stored, f.kind.stored) for f in self.stored_fields])

    def history_schema(self) -> T.StructType:
        return T.StructType([*self.stored_schema().fields, *META_STORED])

    def with_key(self, *key: str) -> "TableSpec":
        return replace(self, key=tuple(key))


def _fields(*triples: tuple) -> tuple[Field, ...]:
    return tuple(Field(wire, kind, stored) for wire, kind, stored in triples)


# Names of the tables, of the fields on the wire and of the stored columns.

AGENT_LOGIN_STATUS = TableSpec(
    "agent_login_status",
    "tblAgentLoginStatus",
    _fields(
        ("markedBy", TEXT, "marked_by"),
        ("state", TEXT, "state"),
        ("datestamp", DAY, "login_date"),
        ("timestamp", TIME_OF_DAY, "login_time"),
        ("extension", TEXT, "extension"),
        ("ipAddress", TEXT, "ip_address"),
    ),
    key=("marked_by",),
    event_time="login_date",
    block_rows=1000,
)

# The state key is narrower than the source key, which also has the channel:
# legs of one call share a row.  Use CDR.with_key(...) to keep them apart.
CDR = TableSpec(
    "cdr",
    "tblCallDataRecords",
    _fields(
        ("uniqueid", TEXT, "uniqueid"),
        ("calldate", INSTANT, "calldate"),
        ("clid", TEXT, None),
        ("src", TEXT, "src"),
        ("dst", TEXT, "dst"),
        ("dcontext", TEXT, None),
        ("channel", TEXT, None),
        ("dstchannel", TEXT, "dstchannel"),
        ("lastapp", TEXT, None),
        ("lastdata", TEXT, None),
        ("duration", INT, "duration"),
        ("billsec", INT, "billsec"),
        ("disposition", TEXT, "disposition"),
        ("amaflags", INT, None),
        ("accountcode", TEXT, "accountcode"),
        ("uniqueidOri", TEXT, None),
        ("userfield", TEXT, None),
        ("contractNo", TEXT, "contract_no"),
        ("customerNo", TEXT, "customer_no"),
        ("phoneNumber", TEXT, "phone_number"),
        ("username", TEXT, "username"),
        ("kodeCabang", TEXT, "kode_cabang"),
    ),
    key=("uniqueid", "calldate"),
    event_time="calldate",
    block_rows=5000,
    nullable_key=("calldate",),
)

COLLECTION_RESULT = TableSpec(
    "collection_result",
    "tblCollectionResult",
    _fields(
        ("uniqueId", LONG, "unique_id"),
        ("noKontrak", TEXT, "no_kontrak"),
        ("callId", TEXT, "call_id"),
        ("agentId", TEXT, "agent_id"),
        ("classification", TEXT, "classification"),
        ("subClassification", TEXT, "sub_classification"),
        ("ptpAmount", MONEY, "ptp_amount"),
        ("ptpDate", DAY, "ptp_date"),
        ("notes", TEXT, "notes"),
        ("createdTimeStamp", INSTANT, "created_ts"),
        ("updatedTimeStamp", INSTANT, "updated_ts"),
        ("kodeCabang", TEXT, "kode_cabang"),
    ),
    key=("unique_id",),
    event_time="created_ts",
    block_rows=1000,
)

COLLECTIONS = TableSpec(
    "collections",
    "tblCollections",
    _fields(
        ("collections_id", LONG, "collections_id"),
        ("noKontrak", TEXT, "no_kontrak"),
        ("agentId", TEXT, "agent_id"),
        ("callDate", INSTANT, "call_date"),
        ("classification", TEXT, "classification"),
        ("subClassification", TEXT, "sub_classification"),
        ("ptpAmount", MONEY, "ptp_amount"),
        ("ptpDate", DAY, "ptp_date"),
        ("callStatus", TEXT, "call_status"),
        ("notes", TEXT, "notes"),
        ("createdTimeStamp", INSTANT, "created_ts"),
        ("updatedTimeStamp", INSTANT, "updated_ts"),
        ("kodeCabang", TEXT, "kode_cabang"),
        ("overdue", INT, "overdue"),
    ),
    key=("collections_id",),
    event_time="created_ts",
    block_rows=1000,
)

COLLECTION_TASK = TableSpec(
    "collection_task",
    "tblCollectionTask",
    _fields(
        ("id", LONG, "id"),
        ("uniqueId", TEXT, "unique_id"),
        ("noKontrak", TEXT, "no_kontrak"),
        ("customerName", TEXT, "customer_name"),
        ("phoneNumber", TEXT, "phone_number"),
        ("overdue", INT, "overdue"),
        ("overdueAmount", MONEY, "overdue_amount"),
        ("outStdPkk", MONEY, "out_std_pkk"),
        ("angsuran", MONEY, "angsuran"),
        ("vehicleType", TEXT, "vehicle_type"),
        ("vehiclePlate", TEXT, "vehicle_plate"),
        ("taskType", TEXT, "task_type"),
        ("priority", INT, "priority"),
        ("status", TEXT, "status"),
        ("assignedAgent", TEXT, "assigned_agent"),
        ("kodeCabang", TEXT, "kode_cabang"),
        ("createdTimestamp", INSTANT, "created_ts"),
        ("updatedTimestamp", INSTANT, "updated_ts"),
    ),
    key=("id",),
    event_time="created_ts",
    block_rows=1000,
)

CUSTOMER_ID = TableSpec(
    "customer_id",
    "tblCustomerId",
    _fields(
        ("id", LONG, "id"),
        ("noKontrak", TEXT, "no_kontrak"),
        ("customerName", TEXT, "customer_name"),
        ("phoneNumber", TEXT, "phone_number"),
        ("altPhoneNumber", TEXT, "alt_phone"),
        ("callStatus", TEXT, "call_status"),
        ("priority", INT, "priority"),
        ("overdue", INT, "overdue"),
        ("outStdPkk", MONEY, "out_std_pkk"),
        ("isPaid", FLAG, "is_paid"),
        ("paymentDate", DAY, "payment_date"),
        ("markedBy", TEXT, "marked_by"),
        ("kodeCabang", TEXT, "kode_cabang"),
        ("createdTimestamp", INSTANT, "created_ts"),
        ("markedTimestamp", INSTANT, "marked_ts"),
    ),
    key=("id",),
    event_time="created_ts",
    block_rows=5000,
)

USER_LOGS = TableSpec(
    "user_logs",
    "tblUserLogs",
    _fields(
        ("id", LONG, "id"),
        ("username", TEXT, "username"),
        ("ipAddress", TEXT, "ip_address"),
        ("extension", TEXT, "extension"),
        ("inTimeStamp", INSTANT, "in_ts"),
        ("outTimeStamp", INSTANT, "out_ts"),  # NULL or 0 (still open) becomes the epoch
        ("duration", INT, "duration"),
        ("kodeCabang", TEXT, "kode_cabang"),
    ),
    key=("id",),
    event_time="in_ts",
    block_rows=1000,
)

USER_RELEASES = TableSpec(
    "user_releases",
    "tblUserReleases",
    _fields(
        ("id", LONG, "id"),
        ("hash", TEXT, "hash"),
        ("username", TEXT, "username"),
        ("releaseDate", DAY, "release_date"),
        ("totalTask", INT, "total_task"),
        ("totalCalled", INT, "total_called"),
        ("totalAnswered", INT, "total_answered"),
        ("totalPTP", INT, "total_ptp"),
        ("talkTimeSec", INT, "talk_time_sec"),
        ("status", TEXT, "status"),
        ("kodeCabang", TEXT, "kode_cabang"),
        ("createdTimestamp", INSTANT, "created_ts"),
        ("updatedTimestamp", INSTANT, "updated_ts"),
    ),
    key=("id", "hash"),
    event_time="release_date",
    block_rows=1000,
)

SPECS: dict[str, TableSpec] = {
    s.name: s
    for s in (
        AGENT_LOGIN_STATUS,
        CDR,
        COLLECTION_RESULT,
        COLLECTIONS,
        COLLECTION_TASK,
        CUSTOMER_ID,
        USER_LOGS,
        USER_RELEASES,
    )
}
