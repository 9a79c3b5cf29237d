from touchstone.sources.landing import (
    LandingError,
    LandingResult,
    destination,
    file_checksums,
    land,
    land_all,
    read_landed,
    scan_csv,
    source_checksum,
)
from touchstone.sources.sinks import write_accepted, write_findings, write_quarantine
from touchstone.sources.weather_json import WeatherReadError, read_weather

__all__ = [
    "LandingError",
    "LandingResult",
    "WeatherReadError",
    "destination",
    "file_checksums",
    "land",
    "land_all",
    "read_landed",
    "read_weather",
    "scan_csv",
    "source_checksum",
    "write_accepted",
    "write_findings",
    "write_quarantine",
]
