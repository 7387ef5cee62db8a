"""Run configuration: dataclasses, defaults, YAML files and validation."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field, fields
from typing import Any


@dataclass(frozen=True)
class Limits:
    """Value limits of a variable. A side that is None, or equal to the no-data value, is unbounded."""

    ceiling: float | None = 100.0
    floor: float | None = -100.0
    offset: float = 0.0
    z: float = 2.58
    absolute_zero: float = -273.15
    ndv: float = -9999.0

    def __post_init__(self) -> None:
        for side in ("ceiling", "floor"):
            if getattr(self, side) == self.ndv:
                object.__setattr__(self, side, None)


# Default limits by variable name.
DEFAULT_LIMITS = {
    "LST": Limits(),
    "EVI": Limits(1.0, 0.0, 0.0, 2.58, 0.0),
    "TCW": Limits(2.0, -1.0, 0.0, 2.58, 0.0),
    "TCB": Limits(2.0, -1.0, 0.0, 2.58, 0.0),
}


# The default searches and thresholds of the three steps.
@dataclass(frozen=True)
class Despeckle:
    search: int = 3142
    min_used: int = 320
    max_used: int = 640
    extreme_z: float = 2.58
    speckle_z: float = 1.64
    tolerance: float = 0.2


@dataclass(frozen=True)
class A1:
    search: int = 3142
    min_used: int = 480
    max_used: int = 960
    ratio: bool = False
    max_ratio: float = 0.0
    trim: bool = True


@dataclass(frozen=True)
class A2:
    search: int = 8
    ratio: bool = False
    max_ratio: float = 0.0
    average: str = "mean"


@dataclass(frozen=True)
class Job:
    """days: days of year to fill, none or a 0 for all. start_year: the first year to fill; earlier years give values.
    a2_years: years that A2 is run for, none for all. tile: cells of a tile's side; with memory, the bytes that a task has,
    as large a one as fits. geotiff: images are written as mosaics of GeoTIFF files."""

    days: tuple[int, ...] = ()
    start_year: int | None = None
    north: float | None = None
    south: float | None = None
    west: float | None = None
    east: float | None = None
    run_a2: bool = True
    a2_years: tuple[int, ...] = ()
    clip: bool = True
    tile: int = 256
    memory: int = 0
    geotiff: bool = False

    @property
    def all_days(self) -> bool:
        return not self.days or 0 in self.days


@dataclass(frozen=True)
class Paths:
    """data, stats (mean and sd), mask (land): parquet tables or, but for stats, rasters; mean and sd: rasters in place of stats."""

    data: str = ""
    stats: str = ""
    mask: str = ""
    output: str = ""
    variable: str = ""
    mean: str = ""
    sd: str = ""


@dataclass(frozen=True)
class Config:
    paths: Paths = field(default_factory=Paths)
    limits: Limits = field(default_factory=Limits)
    job: Job = field(default_factory=Job)
    despeckle: Despeckle = field(default_factory=Despeckle)
    a1: A1 = field(default_factory=A1)
    a2: A2 = field(default_factory=A2)

    def __post_init__(self) -> None:
        for part in (self.a1, self.a2):
            if part.ratio and part.max_ratio < 1:
                raise ValueError("max_ratio must be 1 or more when values are filled by ratios")
        if self.a2.search != 8:
            raise ValueError("A2 smears over the 8 cells around a cell: search must be 8")
        if self.a2.average.lower() not in ("mean", "median"):
            raise ValueError("average must be mean or median")
        if not 0 < self.a1.min_used <= self.a1.max_used or not 0 < self.despeckle.min_used <= self.despeckle.max_used:
            raise ValueError("0 < min_used <= max_used is needed")


PARTS: dict[str, type] = {"paths": Paths, "limits": Limits, "job": Job, "despeckle": Despeckle, "a1": A1, "a2": A2}


def limits_for(name: str, limits: dict[str, Limits] = DEFAULT_LIMITS) -> Limits:
    """The limits whose key is the only one contained in the name, in either case; else KeyError."""
    found = [k for k in limits if k.upper() in name.upper()]
    if len(found) != 1:
        raise KeyError(f"{name!r} holds {len(found)} of the names {sorted(limits)}")
    return limits[found[0]]


def from_dict(sections: dict[str, dict[str, Any] | None]) -> Config:
    """A Config; paths and job must be given, other sections fall back to their defaults (limits by the data's name)."""
    for needed in ("paths", "job"):
        if not sections.get(needed):
            raise ValueError(f"section {needed} is missing")
    if unknown := set(sections) - set(PARTS):
        raise ValueError(f"unknown sections: {sorted(unknown)}")
    made = {}
    for name, kind in PARTS.items():
        given = dict(sections.get(name) or {})
        if unknown := set(given) - {f.name for f in fields(kind)}:
            raise ValueError(f"unknown settings in {name}: {sorted(unknown)}")
        for key in ("days", "a2_years") if name == "job" else ():
            if isinstance(given.get(key), list | int):
                given[key] = tuple(given[key]) if isinstance(given[key], list) else (given[key],)
        made[name] = kind(**given)
    if not sections.get("limits"):
        paths = made["paths"]
        made["limits"] = limits_for(paths.variable or paths.data.rstrip("/").rsplit("/", 1)[-1])
    return Config(**made)


def load_sections(*files: str) -> dict[str, Any]:
    """Sections of YAML files; those of later files replace those of earlier ones."""
    import yaml

    sections: dict[str, Any] = {}
    for file in files:
        with open(file, encoding="utf-8") as f:
            sections |= yaml.safe_load(f) or {}
    return sections


def load(*files: str) -> Config:
    """A Config of one or more YAML files."""
    return from_dict(load_sections(*files))


def sample(parts: tuple[str, ...] = tuple(PARTS)) -> str:
    """Editable YAML of the defaults of some sections."""
    import yaml

    plain = {name: {k: list(v) if isinstance(v, tuple) else v for k, v in asdict(PARTS[name]()).items()} for name in parts}
    return yaml.safe_dump(plain, sort_keys=False)
