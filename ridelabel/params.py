"""All tunable parameters of the matcher in one place."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class MatchParams:
    # The defaults the matching results depend on.
    session_gap_seconds: int = 300
    idle_flush_seconds: int = 30
    detection_gap_seconds: int = 60
    watermark_ms: int = 300
    partition_idle_seconds: int = 60
    run_tile_chars: int = 8
    stop_tile_chars: int = 7
    bucket_minutes: int = 5
    zone: str = "Europe/Berlin"
    first_stop_votes: int = 2
    other_stop_votes: int = 1
    single_min_votes: int = 2
    winning_margin: int = 2

    # "session": votes never cross a session; "vehicle": they may.
    scope: str = "session"

    # A stream forgets what it last handed on of a vehicle that sent nothing for so long.
    forget_seconds: int = 86_400

    # Physical sizing. They change how the work is cut, never the result.
    # A vehicle with more rows than this is cut into time chunks of about as many.
    hot_vehicle_rows: int = 5_000_000
    # Stretches of a hot vehicle's vote are folded at once and repeated at most so often.
    vote_rounds: int = 4
    # Timetable tables are broadcast, the smallest first, only up to this many bytes together.
    broadcast_bytes: int = 64 << 20
    # Others are shuffled; where Spark does not split popular keys, each is spread over this many salts.
    join_salts: int = 16

    def __post_init__(self) -> None:
        if self.scope not in ("session", "vehicle"):
            raise ValueError(f"scope must be 'session' or 'vehicle', not {self.scope!r}")
        if (24 * 60) % self.bucket_minutes:
            raise ValueError("bucket_minutes must divide a day")

    @property
    def buckets_per_day(self) -> int:
        return 24 * 60 // self.bucket_minutes

    def with_(self, **changes) -> "MatchParams":
        return replace(self, **changes)
