"""Plain descriptions of what to move: tables, topics, progress and policies."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

# Defaults, names and formats that existing users of the wire
# format and of the settings rely on.
KEY_MODES = ("default", "round_robin", "field_based")
PRECISIONS = ("micros", "second")
PLACEMENTS = ("as_read", "colocated", "contiguous")
WIRE_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
WIRE_TS_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z"
DEFAULT_BATCH_SIZE = 20
DEFAULT_FAST_INTERVAL = "500 milliseconds"
DEFAULT_SLOW_INTERVAL = "30 seconds"
DEFAULT_INITIAL_HOURS = -1
DEFAULT_RECORDS_PER_TRIGGER = 1_000_000
DEFAULT_FILES_PER_TRIGGER = 1000
DEFAULT_WRITE_PARALLELISM = 5
DEFAULT_ID_FIELD = "sys_id"
DEFAULT_HEADER = "source_table"
LATENCY_BOUNDS = (0.05, 0.1, 0.25, 0.5, 1, 2.5, 5, 10, 30)
POLL_DURATION_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1, 2.5, 5, 10)
LAG_ALERT_SECONDS = 300
ERROR_RATE_ALERT_PERCENT = 1
RAW_EXCERPT_CHARS = 200


@dataclass(frozen=True)
class TableSpec:
    """A source table with the two columns that order its changes.

    ``(ts_col, id_col)`` must identify a row: it is the position a pull resumes
    from.  ``partition_col`` names a date column the table is partitioned by,
    derived from ``ts_col``; a bounded pull then skips older directories.
    """

    name: str
    ts_col: str
    id_col: str
    fields: tuple[str, ...] = ()
    topic: str = ""
    key_mode: str = "default"
    key_fields: tuple[str, ...] = ()
    precision: str = "micros"
    partition_col: str | None = None

    def __post_init__(self):
        object.__setattr__(self, "fields", tuple(self.fields))
        object.__setattr__(self, "key_fields", tuple(self.key_fields))
        for attr in ("name", "ts_col", "id_col"):
            if not getattr(self, attr):
                raise ValueError(f"TableSpec.{attr} is required")
        if self.key_mode not in KEY_MODES:
            raise ValueError(f"key_mode must be one of {KEY_MODES}, got {self.key_mode!r}")
        if self.key_mode == "field_based" and not self.key_fields:
            raise ValueError("key_fields is required when key_mode is 'field_based'")
        if self.precision not in PRECISIONS:
            raise ValueError(f"precision must be one of {PRECISIONS}, got {self.precision!r}")


@dataclass(frozen=True)
class Progress:
    """Position of the last published row; the empty value means "never pulled"."""

    ts: datetime | None = None
    last_identifier: str = ""

    @property
    def is_zero(self) -> bool:
        return self.ts is None and not self.last_identifier


@dataclass(frozen=True)
class PullSettings:
    """How far back, how close to now and how much one pull reads.

    ``placement`` is how rows are spread over the tasks that publish them:
    ``as_read`` needs no shuffle; ``colocated`` has one task write all messages
    of a key in processing order; ``contiguous`` does so too but cuts a key that
    is too large for one task into consecutive ranges.
    """

    topic_prefix: str = ""
    batch_size: int | None = None
    initial_hours: int = DEFAULT_INITIAL_HOURS
    delay_seconds: int = 0
    header: str = DEFAULT_HEADER
    progress_mode: str = "atomic"
    placement: str = "as_read"

    def __post_init__(self):
        if self.placement not in PLACEMENTS:
            raise ValueError(f"placement must be one of {PLACEMENTS}, got {self.placement!r}")


@dataclass(frozen=True)
class TopicRoute:
    """Messages of ``topic`` are applied to ``table``."""

    topic: str
    table: str


@dataclass(frozen=True)
class ApplySpec:
    """How a log is applied to one target table.

    ``fields`` names the fields that most patches set and makes folding cheaper;
    other fields are folded too, by the general way.
    """

    table: str
    id_field: str = DEFAULT_ID_FIELD
    fields: tuple[str, ...] = ()
    commit_on_partial_failure: bool = True

    def __post_init__(self):
        object.__setattr__(self, "fields", tuple(self.fields))
        if not self.table or not self.id_field:
            raise ValueError("ApplySpec needs a table and an id_field")
