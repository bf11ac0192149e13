"""The nineteen tracking tables as data: columns, types, feeds and loading rule."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from rosterlake.functions.clean import BIGINT, BOOL, TEXT, TIME
from rosterlake.schema import columns

# ---- Fixed values: column names, their order, keys and feeds of the tracking tables.

INTEGER_COLUMNS = ("client_id", "send_id", "list_id", "batch_id", "smtp_code", "de_client_id")
TIME_COLUMNS = ("event_date", "date_joined", "date_unsubscribed", "date_created", "date_held",
                "date_changed", "sched_time", "sent_time")
BOOL_COLUMNS = ("is_unique", "is_unique_for_url", "is_multipart")

SUBSCRIBER = ("subscriber_key", "email_address", "subscriber_id")
EVENT = ("client_id", "send_id", *SUBSCRIBER, "list_id", "event_date", "event_type")
BATCH = ("batch_id", "triggered_send_external_key")
LINK = ("send_urlid", "urlid", "url", "alias")
VISITOR = ("ip_address", "country", "region", "city", "latitude", "longitude", "metro_code",
           "area_code", "browser", "email_client", "operating_system", "device")

TWO_FEEDS = ("level2", "pilots")
ALL_FEEDS = ("all_bu", "level2", "pilots")

APPEND, NEW_ONLY, NEW_OR_CHANGED = "append", "new_only", "new_or_changed"


def column_type(name: str) -> str:
    if name in INTEGER_COLUMNS:
        return BIGINT
    if name in TIME_COLUMNS:
        return TIME
    return BOOL if name in BOOL_COLUMNS else TEXT


@dataclass(frozen=True)
class Entity:
    name: str
    columns: tuple[str, ...]
    feeds: tuple[str, ...] = TWO_FEEDS
    rule: str = APPEND
    keys: tuple[str, ...] = ()
    # Keys whose incoming text is compared as it came: padded text matches no stored key.
    raw_keys: tuple[str, ...] = ()
    compare: tuple[str, ...] = ()
    # Whether a row is set against the latest stored version of its key alone, so that one that is in already stays out.
    latest_only: bool = False
    enriched: bool = True

    @property
    def file_stem(self) -> str:
        """Landing tables and files are named without underscores."""
        return self.name.replace("_", "")

    @property
    def types(self) -> dict[str, str]:
        return {c: column_type(c) for c in self.columns}

    def schema(self, audit: bool = True) -> T.StructType:
        listed = [f"{c} {t}" for c, t in self.types.items()]
        if audit:
            listed = ["load_id string", *listed, "load_ts timestamp"]
        return columns(", ".join(listed))


_ENTITIES = (
    Entity("attributes", ("client_id", *SUBSCRIBER), rule=NEW_ONLY,
           keys=("subscriber_key", "subscriber_id"), raw_keys=("subscriber_key", "subscriber_id")),
    Entity("bounces", (*EVENT, "bounce_category", "smtp_code", "bounce_reason", *BATCH)),
    Entity("click_impression", (*EVENT, *LINK, *BATCH, "impression_region_name")),
    Entity("clicks", (*EVENT, *LINK, *BATCH, "is_unique", "is_unique_for_url", *VISITOR)),
    Entity("complaints", (*EVENT, *BATCH, "domain")),
    Entity("conversions", (*EVENT, "referring_url", "link_alias", "conversion_data", *BATCH, "urlid")),
    Entity("list_membership",
           ("client_id", *SUBSCRIBER, "list_id", "list_name", "date_joined", "join_type",
            "date_unsubscribed", "unsubscribe_reason"),
           feeds=ALL_FEEDS, rule=NEW_OR_CHANGED,
           keys=("subscriber_id", "subscriber_key", "list_id", "client_id"),
           compare=("date_joined", "date_unsubscribed", "join_type", "unsubscribe_reason")),
    Entity("lists",
           ("client_id", "list_id", "name", "description", "date_created", "status", "list_type"),
           feeds=ALL_FEEDS, rule=NEW_ONLY, keys=("list_id", "client_id"), enriched=False),
    Entity("multiple_data_extension_send_lists",
           ("client_id", "send_id", "list_id", "data_extension_name", "status", "date_created",
            "de_client_id"),
           feeds=ALL_FEEDS, rule=NEW_ONLY, keys=("send_id", "list_id", "client_id"), enriched=False),
    Entity("not_sent", (*EVENT, *BATCH, "reason")),
    Entity("opens", (*EVENT, *BATCH, "is_unique", *VISITOR)),
    Entity("send_impression", (*EVENT, *BATCH, "impression_region_name")),
    Entity("send_job_impression",
           ("client_id", "send_id", "impression_region_id", "impression_region_name",
            "fixedcontent", "event_date"), enriched=False),
    Entity("send_jobs",
           ("client_id", "send_id", "from_name", "from_email", "sched_time", "sent_time", "subject",
            "email_name", "triggered_send_external_key", "send_definition_external_key",
            "job_status", "preview_url", "is_multipart", "additional"),
           feeds=ALL_FEEDS, rule=NEW_ONLY, keys=("send_id", "client_id"), enriched=False),
    Entity("sent", (*EVENT, *BATCH, "campaign_id")),
    Entity("status_change",
           ("client_id", *SUBSCRIBER, "old_status", "new_status", "date_changed"), feeds=ALL_FEEDS),
    Entity("subscribers",
           ("client_id", *SUBSCRIBER, "status", "date_held", "date_created", "date_unsubscribed"),
           rule=NEW_ONLY, keys=("subscriber_key", "subscriber_id", "client_id"),
           raw_keys=("subscriber_key", "subscriber_id")),
    Entity("surveys", (*EVENT, "question", "answer", *BATCH)),
    Entity("unsubs", (*EVENT, *BATCH, "unsub_reason")),
)

ENTITIES: dict[str, Entity] = {e.name: e for e in _ENTITIES}
