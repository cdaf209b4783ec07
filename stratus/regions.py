"""Constant tables: regions, state codes, scenarios, models and their variables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Region:
    """A box in 0..360 longitudes; include or exclude lists two-character state codes."""

    key: str
    name: str
    lon_min: float
    lon_max: float
    lat_min: float
    lat_max: float
    states: tuple[str, ...] = ()
    excluded: tuple[str, ...] = ()
    counties: int = 0


# Extraction boxes, state codes and expected county counts.
REGIONS = {
    r.key: r
    for r in (
        Region("CONUS", "Continental United States", 234.0, 294.0, 24.0, 50.0, (), ("02", "15", "72", "78", "66", "69"), 3114),
        Region("AK", "Alaska", 170.0, 235.0, 50.0, 72.0, ("02",), (), 30),
        Region("HI", "Hawaii", 181.63, 205.20, 18.92, 28.45, ("15",), (), 5),
        Region("PRVI", "Puerto Rico and Virgin Islands", 292.03, 295.49, 17.62, 18.57, ("72", "78"), (), 81),
        Region("GU", "Guam and Northern Mariana Islands", 144.58, 146.12, 13.18, 20.61, ("66", "69"), (), 5),
    )
}

# Scenario year ranges; a year's scenario is the first range that holds it.
SCENARIOS = {"historical": (1850, 2014), "ssp245": (2015, 2100), "ssp585": (2015, 2100)}

# Variables with their long names, units and metric units.
VARIABLES = {
    "pr": ("precipitation", "kg m-2 s-1", "mm"),
    "tas": ("near-surface air temperature", "K", "degC"),
    "tasmax": ("daily maximum near-surface air temperature", "K", "degC"),
    "tasmin": ("daily minimum near-surface air temperature", "K", "degC"),
}


@dataclass(frozen=True)
class Model:
    """A model's scenarios with year ranges, ensemble and grid, and the pattern of its file names."""

    key: str
    scenarios: dict[str, tuple[int, int]]
    ensemble: str
    grid: str

    @property
    def pattern(self) -> str:
        return rf"^(?<variable>[a-z]+)_(?<frequency>day)_(?<model>{self.key})_(?<scenario>[a-z0-9]+)_(?<ensemble>r\d+i\d+p\d+f\d+)_(?<grid>g[a-z0-9]+)_(?<year>\d{{4}})(?:_v(?<version>[\d.]+))?\.nc$"

    def file_name(self, variable: str, scenario: str, year: int, version: str | None = None) -> str:
        """The file of a variable, scenario and year."""
        if scenario not in self.scenarios:
            raise KeyError(f"{self.key} has no scenario {scenario}")
        return "_".join([variable, "day", self.key, scenario, self.ensemble, self.grid, str(year)]) + (f"_v{version}" if version else "") + ".nc"


def _future(*names: str) -> dict[str, tuple[int, int]]:
    return {"historical": (1850, 2014)} | {n: (2015, 2100) for n in names}


MODELS: dict[str, Model] = {
    "NorESM2-LM": Model("NorESM2-LM", _future("ssp126", "ssp245", "ssp370", "ssp585"), "r1i1p1f1", "gn"),
    "GFDL-ESM4": Model("GFDL-ESM4", _future("ssp119", "ssp126", "ssp245", "ssp370", "ssp460", "ssp585"), "r1i1p1f1", "gr1"),
}
ALIASES = {"noresm2": "NorESM2-LM", "noresm2-lm": "NorESM2-LM", "gfdl": "GFDL-ESM4", "gfdl-esm4": "GFDL-ESM4"}


def model(name: str) -> Model:
    """A registered model by id or alias; an unknown one is an error."""
    key = ALIASES.get(name.lower(), name)
    if key not in MODELS:
        raise KeyError(f"unknown model {name}; known: {sorted(MODELS)}")
    return MODELS[key]


def register(m: Model, *aliases: str) -> None:
    """Add a model."""
    MODELS[m.key] = m
    ALIASES.update({a.lower(): m.key for a in aliases})


def region(key: str) -> Region:
    """A region by key; an unknown one is an error."""
    if key not in REGIONS:
        raise KeyError(f"unknown region {key}; known: {sorted(REGIONS)}")
    return REGIONS[key]


def is_valid(r: Region) -> bool:
    """Bounds in range and in order; lon_min over lon_max is allowed for boxes across the date line."""
    return -90 <= r.lat_min < r.lat_max <= 90 and 0 <= r.lon_min <= 360 and 0 <= r.lon_max <= 360 and r.lon_min != r.lon_max


def regions_frame(spark: SparkSession) -> DataFrame:
    """One row a region."""
    return spark.createDataFrame([(r.key, r.name, r.lon_min, r.lon_max, r.lat_min, r.lat_max) for r in REGIONS.values()], "region string, name string, lon_min double, lon_max double, lat_min double, lat_max double")


def scenarios_frame(spark: SparkSession, name: str | None = None) -> DataFrame:
    """scenario, first_year, last_year: of a model, or the general table; rank orders overlapping ranges."""
    rows = (model(name).scenarios if name else SCENARIOS).items()
    return spark.createDataFrame([(s, a, b, i) for i, (s, (a, b)) in enumerate(rows)], "scenario string, first_year int, last_year int, rank int")


def variables_frame(spark: SparkSession) -> DataFrame:
    """One row a variable."""
    return spark.createDataFrame([(k, *v) for k, v in VARIABLES.items()], "variable string, long_name string, units string, metric_units string")


def valid_pairs(spark: SparkSession) -> DataFrame:
    """Every region with every variable; both tables are constants of a few rows."""
    return regions_frame(spark).select("region").crossJoin(variables_frame(spark).select("variable"))
