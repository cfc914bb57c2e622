"""Declared schemas of the five road-safety CSV sources (no inference on read)."""

from __future__ import annotations

from dataclasses import dataclass

# File names, source system names and column types of the five sources.
REGISTRY = "road_id string, region string, city string, road_type string, speed_limit int, lanes int"
CONTEXT = (
    "date_time timestamp, region string, city string, weather string, "
    "visibility_km double, precip_mm double, temp_c double"
)
MEASURE = "sensor_id int, date_time timestamp, road_id string, volume int, avg_speed double"
TYPED = (
    "violation_id string, date_time timestamp, road_id string, violation_type string, "
    "fine_amount int, driver_age_band string"
)
INCIDENT = (
    "incident_id string, date_time timestamp, road_id string, vehicles_involved int, "
    "injuries int, fatalities int, lighting string, severity string"
)


@dataclass(frozen=True)
class Source:
    file: str
    system: str
    schema: str


ROAD_SOURCES = {
    "registry": Source("road_segments", "roads_registry", REGISTRY),
    "context": Source("weather_hourly", "meteo_service", CONTEXT),
    "measure": Source("speed_sensors", "speed_sensors", MEASURE),
    "incident": Source("accidents", "accident_reports", INCIDENT),
    "typed": Source("violations", "violation_system", TYPED),
}
