"""RAW payloads to CLEAN events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clinical import event_category, validation_status
from ..functions.nulls import blank_to_null
from ..operators.dedup import latest_per_key
from ..operators.merge import merge_upsert
from ..operators.variant import flatten_lines, variant_project
from ..schemas import CLEAN_EVENTS, conform

# Payload paths of an event, default currency, version stamp.
EVENT_PATHS = {
    "event_uuid": ("uuid", "string"),
    "event_time": ("event_time", "timestamp"),
    "event_type": ("type", "string"),
    "amount": ("amount", "decimal(38,2)"),
    "currency": ("currency", "string"),
    "patient_id": ("patient_id", "string"),
    "provider_id": ("provider_id", "string"),
    "department_id": ("department_id", "string"),
}
DEFAULT_CURRENCY = "KES"
ETL_VERSION = "1.0"
MERGE_KEYS = ["event_id", "facility_id"]
UPDATED = [
    "event_uuid", "event_time", "event_date", "event_type", "event_category", "amount", "currency",
    "patient_id", "provider_id", "department_id", "payload", "ingested_at", "validation_status",
]


def label_events(events: DataFrame) -> DataFrame:
    """Currency default, category and validation status of typed events."""
    return events.withColumns(
        {
            "currency": F.coalesce("currency", F.lit(DEFAULT_CURRENCY)),
            "event_category": event_category("event_type"),
            "validation_status": validation_status("amount", "event_time"),
        }
    )


def clean_source(raw: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The newest version of each event in RAW, typed and labelled.

    An event without id and uuid is dropped. ``keys`` are the identity; the default
    is facility and id. Only the identity is read before the shuffle; the payload
    travels once and its other paths are read from the rows that remain.
    """
    identity = F.coalesce(*[F.try_variant_get("payload", f"$.{p}", "string") for p in ("id", "uuid")])
    kept = [k for k in (keys or MERGE_KEYS) if k not in MERGE_KEYS]
    named = raw.select("facility_id", "ingested_at", "row_hash", "payload", *kept, identity.alias("event_id"))
    newest = latest_per_key(
        named.filter(F.col("event_id").isNotNull()), keys or MERGE_KEYS, "ingested_at", ["row_hash"]
    )
    typed = variant_project(newest, EVENT_PATHS, keep=["facility_id", "event_id", "ingested_at", "payload", *kept])
    return (
        label_events(in_utc(typed))
        .withColumn("event_date", F.col("event_time").cast("date"))
        .withColumn("_etl_version", F.lit(ETL_VERSION))
    )


def in_utc(events: DataFrame) -> DataFrame:
    """Event times as UTC wall clock: an offset in the text has fixed the instant before (sessions run in UTC)."""
    return events.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


def merge_clean(target: DataFrame, source: DataFrame, processed_at: Column, keys: list[str] | None = None) -> DataFrame:
    """CLEAN after the merge: a version not newer than the stored one changes nothing.

    ``keys`` are those that ``clean_source`` was given.
    """
    keys = keys or MERGE_KEYS
    stamp = {"processed_at": processed_at}
    return merge_upsert(
        target,
        source,
        keys,
        update_cols=UPDATED,
        insert_cols=[*dict.fromkeys([*MERGE_KEYS, *keys]), *UPDATED, "_etl_version"],
        when=lambda t, s: t("ingested_at") < s("ingested_at"),
        on_update=stamp,
        on_insert=stamp | {"is_duplicate": F.lit(False)},
    )


def empty_clean(spark) -> DataFrame:
    return conform(spark.createDataFrame([], "event_id string"), CLEAN_EVENTS)


FLAT_PATHS = {
    "event_id": ("id", "string"),
    "event_time": ("event_time", "timestamp"),
    "event_type": ("type", "string"),
    "amount": ("amount", "decimal(38,2)"),
}
FLAT_KEYS = ["facility_id", "source_table", "event_id"]


def flat_source(raw: DataFrame, keys: list[str] | None = None, strict_numbers: bool = False) -> DataFrame:
    """The newest version of each record in landed lines that hold arrays or single records.

    ``strict_numbers`` rounds amounts half-up to whole numbers, as the source's type did.
    """
    paths = FLAT_PATHS | {"amount": ("amount", "decimal(38,0)")} if strict_numbers else FLAT_PATHS
    records = flatten_lines(raw.select("facility_id", "source_table", "ingested_at", "payload"))
    typed = variant_project(
        records, paths, payload="value", keep=["facility_id", "source_table", "ingested_at", F.col("value").alias("payload")]
    ).filter(blank_to_null("event_id").isNotNull())
    hashed = in_utc(typed).withColumn("_hash", F.md5(F.to_json("payload")))
    return latest_per_key(hashed, keys or FLAT_KEYS, "ingested_at", ["_hash"]).drop("_hash")


def merge_clean_flat(target: DataFrame, source: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Unconditional upsert of the flat form; the facility is inserted as well."""
    return merge_upsert(
        target,
        source,
        keys or FLAT_KEYS,
        update_cols=["event_time", "event_type", "amount", "payload", "ingested_at"],
    )
