"""Declared schemas: the trip files' eras, the dimensions' column variants, the facts and the rollup."""

from __future__ import annotations

from dataclasses import dataclass

from monthmill.fixed_values import DRIFT_COLUMNS, ERA_RANGES, STABLE_COLUMNS

PARTITIONS = ["year", "month"]
PARTITION_DDL = "year int, month int"

NARROW_DDL = f"{STABLE_COLUMNS}, {PARTITION_DDL}"

ZONES_DDL = "locationid string, borough string, zone string, service_zone string"


@dataclass(frozen=True)
class Era:
    """A year x month rectangle of files that store the drift columns as one type."""

    name: str
    years: tuple[int, int | None]
    months: tuple[int, int]
    drift_type: str

    @property
    def ddl(self) -> str:
        drift = ", ".join(f"{name} {self.drift_type}" for name in DRIFT_COLUMNS)
        return f"{STABLE_COLUMNS}, {drift}, {PARTITION_DDL}"

    def covers(self, year: int, month: int) -> bool:
        first, last = self.years
        return (
            first <= year
            and (last is None or year <= last)
            and self.months[0] <= month <= self.months[1]
        )


TRIP_ERAS = [Era(*row) for row in ERA_RANGES]

# Column names that differ between the lakehouse dimensions and the notebook's.
PAYMENT_TEXT = {"lakehouse": "payment_desc", "notebook": "payment_description"}
RATE_CODE_TEXT = {"lakehouse": "rate_code_desc", "notebook": "rate_code_description"}

ROLLUP_KEYS = ["pickup_date_key", "pickup_location_id", "payment_type"]
ROLLUP_MEASURES = [
    "trips",
    "tipped_trips",
    "total_fare",
    "total_tip",
    "total_revenue",
    "total_distance",
]
