"""Pipeline parameters.

Everything that a deployment may want to change lives in ``PipelineConfig``;
the defaults reproduce the reference pipeline's behaviour.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class PipelineConfig:
    # Zone of the wall-clock trip timestamps and of the loader's clock.
    trip_zone: str = "America/New_York"
    load_clock_zone: str = "America/Guayaquil"
    # Half-open validity window applied to pickup/dropoff/load times (UTC and local).
    window_start: str = "2015-01-01 00:00:00"
    window_end: str = "2026-01-01 00:00:00"
    # Months the backfill covers, inclusive.
    first_month: tuple[int, int] = (2015, 1)
    last_month: tuple[int, int] = (2025, 7)
    services: tuple[str, ...] = ("yellow", "green")
    # Rows per ingest batch (the ``lote`` counter of the raw tables).
    batch_rows: int = 1_000_000
    # Fact filter: trips faster than this are dropped from gold.
    max_fact_speed_mph: float = 100.0
    # Clustering of the fact table.
    cluster_keys: tuple[str, ...] = field(
        default_factory=lambda: ("pickup_date_sk", "pickup_zone_sk", "service_type_sk")
    )
    # Order in which the keys give the bits of the curve index, coarse to fine: four
    # zone groups, then 64 stretches of days, then both in turn down to single values.
    cluster_curve: tuple[str, ...] = field(
        default_factory=lambda: (
            *["pickup_zone_sk"] * 2, *["pickup_date_sk"] * 6, *["pickup_zone_sk"] * 2, *["pickup_date_sk"] * 3,
            *["pickup_zone_sk"] * 4, *["pickup_date_sk"] * 3, "service_type_sk")
    )


DEFAULT = PipelineConfig()
