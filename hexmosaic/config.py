"""Parameters of a run, in one small immutable record."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field
from datetime import date

# Bounding box of the default country (degrees) and its country codes.
DEFAULT_BBOX = {"xmin": 102.3, "xmax": 107.7, "ymin": 9.9, "ymax": 14.7}
DEFAULT_ISO2 = "KH"
DEFAULT_ISO3 = "KHM"


@dataclass(frozen=True)
class Params:
    """Everything that changes results. Resolutions are deduplicated and sorted."""

    reference_date: date = date(2026, 9, 23)
    country_iso2: str = DEFAULT_ISO2
    country_iso3: str = DEFAULT_ISO3
    bbox: dict = field(default_factory=lambda: dict(DEFAULT_BBOX))
    max_source_lag_days: int = 45
    resolutions: tuple[int, ...] = (8,)
    poi_index_res: int = 11
    containment: str = "overlap"
    buffer_m: float = 0.0
    min_confidence: float = 0.6
    use: tuple[str, ...] = ("osm",)
    neighborhood_k: tuple[int, ...] = (1, 2)
    coverage_flag_min_pop: float = 200.0
    utm_zone: int = 48
    population_year: int | None = None

    def __post_init__(self):
        res = tuple(sorted(set(self.resolutions)))
        if not res or res[0] < 0 or res[-1] > 15 or not 0 <= self.poi_index_res <= 15:
            raise ValueError("hexagon resolutions must be in 0..15")
        if self.containment not in ("center", "overlap"):
            raise ValueError("containment must be 'center' or 'overlap'")
        if not 0 <= self.min_confidence <= 1:
            raise ValueError("min_confidence must be in 0..1")
        unknown = set(self.use) - {"osm", "overture", "fsq"}
        if unknown:
            raise ValueError(f"unknown POI sources: {sorted(unknown)}")
        object.__setattr__(self, "resolutions", res)

    @property
    def index_resolutions(self) -> list[int]:
        """Resolutions stored on every POI."""
        return sorted({*self.resolutions, self.poi_index_res})

    @property
    def year(self) -> int:
        """Year of the population estimate: pinned, else the year of the reference date."""
        return self.population_year or self.reference_date.year

    def hash(self) -> str:
        """Short stable hash of the effective parameters."""
        text = json.dumps(asdict(self), sort_keys=True, default=str)
        return hashlib.sha256(text.encode()).hexdigest()[:12]
