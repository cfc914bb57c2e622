"""Column names of the five sources and of the entity-day table.

Every composite operator takes a ``Names`` so that the same plan runs on any
set of sources with the same roles.
"""

from __future__ import annotations

from dataclasses import dataclass

# Lineage columns added at ingest and the severities counted as severe.
LINEAGE = ("source_system", "ingest_batch_id", "record_hash")
SEVERE = ("Severe", "Fatal")
UNKNOWN = "Unknown"
LOW_VISIBILITY = 4.0


@dataclass(frozen=True)
class Names:
    entity: str = "entity_id"
    ts: str = "ts"
    day: str = "date"
    region: str = "region"
    city: str = "city"
    kind: str = "kind"
    measures: tuple[str, ...] = ("capacity",)
    # measure source
    sensor: str = "sensor_id"
    volume: str = "volume"
    speed: str = "speed"
    # typed events
    typed_id: str = "typed_id"
    event_type: str = "event_type"
    amount: str = "amount"
    typed_extra: tuple[str, ...] = ()
    types: tuple[str, ...] | None = ("click", "error", "purchase", "signup", "view")
    # incidents
    incident: str = "incident_id"
    vehicles: str = "vehicles"
    injuries: str = "injuries"
    fatalities: str = "fatalities"
    severity: str = "severity"
    lighting: str = "lighting"
    # hourly context; context_order makes "first row per key" well defined
    mode: str = "mode"
    visibility: str = "visibility"
    precip: str = "precip"
    temp: str = "temp"
    context_order: tuple[str, ...] = ("context_id",)
    registry_order: tuple[str, ...] = ()

    @property
    def attrs(self) -> tuple[str, ...]:
        """Registry attributes that describe an entity."""
        return (self.region, self.city, self.kind, *self.measures)

    @property
    def context_attrs(self) -> tuple[str, ...]:
        return (self.mode, self.visibility, self.precip, self.temp)

    @property
    def grain(self) -> list[str]:
        return [self.entity, self.day]


#: The roles that the columns of each source have.
SOURCE_ROLES = {
    "registry": ("entity", "region", "city", "kind"),
    "measure": ("sensor", "ts", "entity", "volume", "speed"),
    "typed": ("typed_id", "ts", "entity", "event_type", "amount"),
    "incident": ("incident", "ts", "entity", "vehicles", "injuries", "fatalities", "severity", "lighting"),
    "context": ("ts", "region", "city", "mode", "visibility", "precip", "temp"),
}

GENERIC = Names()

# The column names and event types of the five road-safety CSV files.
ROADS = Names(
    entity="road_id",
    ts="date_time",
    kind="road_type",
    measures=("speed_limit", "lanes"),
    speed="avg_speed",
    typed_id="violation_id",
    event_type="violation_type",
    amount="fine_amount",
    typed_extra=("driver_age_band",),
    types=("PhoneUse", "RedLight", "Seatbelt", "Speeding", "UnsafeLaneChange"),
    vehicles="vehicles_involved",
    mode="weather",
    visibility="visibility_km",
    precip="precip_mm",
    temp="temp_c",
    context_order=("weather", "visibility_km", "precip_mm", "temp_c"),
    registry_order=("region", "city", "road_type", "speed_limit", "lanes"),
)
