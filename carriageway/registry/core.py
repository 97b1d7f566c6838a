"""Query registry: a name, a Spark function and, where SQL can say it, a check query."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from carriageway.functions.cells import hex_cell
from carriageway.functions.rules import rounded_total
from carriageway.plans import geo, gold, modelled, silver
from carriageway.session import pin_utc
from carriageway.sources.domain import VIEWS

# Day at which work zones count as open: the incidents of the test data end in January 2024.
WORK_ZONE_DAY = date(2023, 12, 31)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Inputs:
    """Tables, domain views and marts of one data folder, each built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = pin_utc(spark), sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.dir}/{name}.parquet"

    def stream_path(self, name: str) -> str:
        """The table as a glob: a stream then takes a single file as well as a folder of files."""
        return f"{self.dir}/{name[:-1]}[{name[-1]}].parquet"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def fx(self, name: str) -> DataFrame:
        base, columns = VIEWS[f"fx_{name}"]
        return self.table(base).selectExpr(*[f"{expr} AS {col}" for col, expr in columns.items()])

    @cached_property
    def incidents(self) -> DataFrame:
        return silver.silver_incidents(self.fx("incidents"), stamp=False)

    @cached_property
    def bridges(self) -> DataFrame:
        return silver.silver_bridges(self.fx("bridges"), stamp=False)

    @cached_property
    def vehicles(self) -> DataFrame:
        return silver.silver_vehicles(self.fx("vehicles"), stamp=False)

    @cached_property
    def pavement(self) -> DataFrame:
        return silver.silver_pavement(self.fx("pavement"), stamp=False)

    @cached_property
    def summary(self) -> DataFrame:
        return gold.incident_summary(self.incidents, stamp=False)

    @cached_property
    def corridors(self) -> DataFrame:
        return gold.high_risk_corridors(self.incidents, stamp=False)

    @cached_property
    def health(self) -> DataFrame:
        return gold.bridge_health(self.bridges, stamp=False)

    @cached_property
    def fleet(self) -> DataFrame:
        return gold.fleet_snapshot(self.vehicles, stamp=False)

    @cached_property
    def needs(self) -> DataFrame:
        return gold.pavement_needs(self.pavement, stamp=False)

    @cached_property
    def scorecard(self) -> DataFrame:
        return gold.executive_scorecard(self.incidents, self.bridges, self.pavement, self.vehicles, stamp=False)

    @cached_property
    def located(self) -> DataFrame:
        return geo.enriched_incidents(self.incidents)

    @cached_property
    def cells(self) -> DataFrame:
        return geo.cell_density(self.located, stamp=False)

    @cached_property
    def spots(self) -> DataFrame:
        return geo.hotspots(self.cells, stamp=False)

    @cached_property
    def segments(self) -> DataFrame:
        return geo.located_segments(self.fx("roads"))

    @cached_property
    def rates(self) -> DataFrame:
        return geo.corridor_safety(self.located, self.segments, stamp=False)

    @cached_property
    def placed_bridges(self) -> DataFrame:
        return geo.bridges_with_zone(self.bridges, self.fx("zones"), stamp=False)

    @cached_property
    def work_zones(self) -> DataFrame:
        return self.fx("work_zones").withColumns({
            "h3_index_r8": hex_cell("centroid_lat", "centroid_lon", 8), "status": geo.work_zone_status(WORK_ZONE_DAY),
        })

    @cached_property
    def conflicts(self) -> DataFrame:
        return geo.work_zone_conflicts(self.located, self.work_zones, stamp=False)

    @cached_property
    def model_incidents(self) -> DataFrame:
        return modelled.model_incidents(self.fx("incidents"), stamp=False)

    @cached_property
    def model_bridges(self) -> DataFrame:
        return modelled.model_bridges(self.fx("bridges"), stamp=False)


def query(name: str, sql: str | None = None):
    """Register a function of ``Inputs`` under a name, with its check query."""

    def wrap(fn: Callable[[Inputs], DataFrame]):
        add(name, fn, sql)
        return fn

    return wrap


def add(name: str, fn: Callable[[Inputs], DataFrame], sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name} registered twice")
    QUERIES[name] = lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
    if sql is not None:
        ORACLES[name] = sql


def steady(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded to ``digits``: sums of doubles depend on the order of rows."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: rounded_total(c, digits) for c in doubles}) if doubles else df
