"""Declared schemas: nothing is inferred from data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


_TS, _S, _D, _B, _L = T.TimestampType(), T.StringType(), T.DoubleType(), T.BooleanType(), T.LongType()

LOAD = _struct(
    ("time", _TS, False),
    ("zone", _S, False),
    ("source", _S, False),
    ("demand_mw", _D, False),
    ("demand_forecast_mw", _D, True),
    ("net_generation_mw", _D, True),
    ("total_interchange_mw", _D, True),
    ("is_verified", _B, True),
)

LMP = _struct(
    ("time", _TS, False),
    ("pnode_id", _S, False),
    ("pnode_name", _S, True),
    ("zone", _S, False),
    ("lmp", _D, False),
    ("congestion_price", _D, True),
    ("marginal_loss_price", _D, True),
)

WEATHER = _struct(
    ("time", _TS, False),
    ("zone", _S, False),
    ("temperature", _D, False),
    ("precipitation", _D, False),
    ("wind_speed", _D, False),
    ("cloud_cover", _D, False),
)

STATION_SEED = _struct(
    ("zone_id", _S, True),
    ("zone_name", _S, True),
    ("city", _S, True),
    ("lat", _D, True),
    ("lon", _D, True),
)

FACILITY_TEXT = [
    "facility_name",
    "address",
    "city",
    "state",
    "zip",
    "county",
    "location_confidence",
    "status",
    "expected_date_online",
    "mw",
    "sizerank",
    "operator_name",
    "facility_size_sqft",
    "property_size_acres",
    "project_cost",
]
FACILITY_COORDS = ["lat", "long"]
FACILITY_DATES = ["date_created", "date_updated"]

MESSAGE = _struct(("key", _S, True), ("value", _S, True), ("offset", _L, False))

REGISTRY = _struct(
    ("name", _S, False),
    ("version", T.IntegerType(), False),
    ("stage", _S, False),
    ("rmse", _D, False),
    ("model_path", _S, True),
    ("registered_at", _TS, True),
)

# The 20 zones in scope. RTO is the footprint total and is not modelled.
ZONES = [
    "AE", "AEP", "AP", "ATSI", "BC", "CE", "DAY", "DEOK", "DOM", "DPL",
    "DUQ", "EKPC", "JC", "ME", "PE", "PEP", "PL", "PN", "PS", "RECO",
]
TOTAL_ZONE = "RTO"
SYSTEM_ZONE = "PJM"
SOURCES = ["pjm", "eia"]

# Zone id -> location short name of the price feed.
ZONE_LOCATION = {
    "AE": "AECO", "AEP": "AEP", "AP": "APS", "ATSI": "ATSI", "BC": "BGE",
    "CE": "COMED", "DAY": "DAY", "DEOK": "DEOK", "DOM": "DOM", "DPL": "DPL",
    "DUQ": "DUQ", "EKPC": "EKPC", "JC": "JCPL", "ME": "METED", "PE": "PECO",
    "PEP": "PEPCO", "PL": "PPL", "PN": "PENELEC", "PS": "PSEG", "RECO": "RECO",
}

HORIZONS = (1, 24, 72)
WEATHER_COLS = ["temperature", "precipitation", "wind_speed", "cloud_cover"]
PRICE_COLS = ["lmp_total", "congestion_price", "marginal_loss_price"]


@dataclass(frozen=True)
class Contract:
    """A keyed message topic: its table schema and the key that a later message replaces."""

    topic: str
    schema: T.StructType
    keys: tuple[str, ...] | None

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


CONTRACTS = {
    "load": Contract("load", LOAD, ("time", "zone", "source")),
    "lmp": Contract("lmp", LMP, ("time", "pnode_id")),
    "weather": Contract("weather", WEATHER, None),
}
