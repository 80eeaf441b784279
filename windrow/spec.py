"""A report described as data: columns, types, keys, window and limits."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

# A window is one report; its four columns are directory names in
# the landing zone.
WINDOW_COLS = ("app_id", "attribution_type", "start_date", "end_date")

# The two report types a run loads for every app.
ATTRIBUTION_TYPES = ("non_organic", "retargeting")

# Raw export header -> table column, in table order.  Real exports
# carry the vendor's name in the device id header; see ``with_raw_names``.
EVENT_COLUMNS = {
    "Event Time": "event_time",
    "Install Time": "install_time",
    "Attributed Touch Time": "attributed_touch_time",
    "Event Name": "event_name",
    "Event Revenue": "event_revenue",
    "Media Source": "media_source",
    "Channel": "channel",
    "Campaign": "campaign",
    "Campaign ID": "campaign_id",
    "Adset": "adset",
    "Adset ID": "adset_id",
    "Ad": "ad",
    "Ad ID": "ad_id",
    "Device ID": "device_id",
    "Customer User ID": "customer_user_id",
}

# The table's 17 data columns and their Spark types, in order.
TABLE_COLUMNS = {
    "event_time": "timestamp_ntz",
    "install_time": "timestamp_ntz",
    "attributed_touch_time": "timestamp_ntz",
    "event_name": "string",
    "event_revenue": "decimal(18,4)",
    "media_source": "string",
    "channel": "string",
    "campaign": "string",
    "campaign_id": "string",
    "adset": "string",
    "adset_id": "string",
    "ad": "string",
    "ad_id": "string",
    "device_id": "string",
    "customer_user_id": "string",
    "attribution_type": "string",
    "app_id": "string",
}

# A row's place in load order: the load that brought it, the window within the load, and
# the place in the window's report.
LOAD_ORDER = ("load_seq", "window_seq", "row_ord")

# Retention and call span in days, and the row count at which a
# report is taken to be truncated.
EVENTS_RETENTION_DAYS = 90
INSTALLS_RETENTION_DAYS = 60
MAX_CHUNK_DAYS = 31
REPORT_ROW_CAP = 1_000_000


@dataclass(frozen=True)
class ReportSpec:
    """Everything the operators need to know about one kind of report.

    ``columns`` maps raw headers to table columns; ``None`` keeps every column of
    the report under its normalised name ("Install Time" -> ``install_time``); then
    ``known_columns``, where given, are the only names a report may bring.
    """

    name: str
    columns: Mapping[str, str] | None
    timestamps: tuple[str, ...]
    decimals: tuple[str, ...]
    required: tuple[str, ...]
    key: tuple[str, ...]
    window_column: str
    rank_column: str = "install_time"
    retention_days: int = EVENTS_RETENTION_DAYS
    max_chunk_days: int = MAX_CHUNK_DAYS
    row_cap: int = REPORT_ROW_CAP
    clamp_to_retention: bool = False
    raw_names: Mapping[str, str] = field(default_factory=dict)
    known_columns: tuple[str, ...] | None = None

    def with_raw_names(self, **raw_by_target: str) -> ReportSpec:
        """Use other raw headers: ``spec.with_raw_names(device_id="Vendor ID")``."""
        if self.columns is None:
            return replace(self, raw_names={**self.raw_names, **raw_by_target})
        unknown = sorted(set(raw_by_target) - set(self.columns.values()))
        if unknown:
            raise ValueError(f"not a column of {self.name}: {unknown}")
        renamed = {raw_by_target.get(to, raw): to for raw, to in self.columns.items()}
        return replace(self, columns=renamed)

    def with_key(self, *extra: str) -> ReportSpec:
        """Add columns to the dedup key, for streams where seconds do not separate events."""
        return replace(self, key=self.key + extra)

    @property
    def required_headers(self) -> tuple[str, ...]:
        if self.columns is not None:
            return tuple(self.columns)
        needed = (*self.required, *self.timestamps, *self.key, "media_source")
        return tuple(self.raw_name(c) for c in dict.fromkeys(needed))

    def raw_name(self, target: str) -> str:
        """The raw header that feeds ``target``."""
        if self.columns is not None:
            return next(raw for raw, to in self.columns.items() if to == target)
        fallback = next((raw for raw, to in EVENT_COLUMNS.items() if to == target), None)
        return self.raw_names.get(target) or fallback or target


EVENTS = ReportSpec(
    name="in_app_events",
    columns=EVENT_COLUMNS,
    timestamps=("event_time", "install_time", "attributed_touch_time"),
    decimals=("event_revenue",),
    required=("event_time", "event_name", "device_id"),
    key=("event_time", "event_name", "device_id"),
    window_column="event_time",
)

# The installs family keeps every column and owns windows of install_time; its
# windows are clamped to retention, because a report from before it is validly
# empty and would wipe loaded rows.
INSTALLS = ReportSpec(
    name="installs",
    columns=None,
    timestamps=("install_time", "event_time", "attributed_touch_time"),
    decimals=("event_revenue",),
    required=("install_time", "device_id"),
    key=("install_time", "event_name", "device_id"),
    window_column="install_time",
    retention_days=INSTALLS_RETENTION_DAYS,
    clamp_to_retention=True,
)

# The append path takes files that already have the table's columns.
APPEND_TIMESTAMPS = EVENTS.timestamps
APPEND_ID_COLUMNS = ("campaign_id", "adset_id", "ad_id")
APPEND_REQUIRED = ("event_time", "event_name", "device_id", "attribution_type", "app_id")
