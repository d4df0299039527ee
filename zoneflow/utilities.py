"""Utilities whose service territories make up the zones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Names as the territory source writes them, by the zone they belong to.
ZONE_UTILITIES = {
    "AE": ["ATLANTIC CITY ELECTRIC CO"],
    "AEP": [
        "APPALACHIAN POWER CO",
        "OHIO POWER CO",
        "KENTUCKY POWER CO",
        "INDIANA MICHIGAN POWER CO",
        "WHEELING POWER CO",
    ],
    "AP": ["MONONGAHELA POWER CO", "THE POTOMAC EDISON COMPANY", "WEST PENN POWER COMPANY"],
    "ATSI": ["OHIO EDISON CO", "CLEVELAND ELECTRIC ILLUM CO", "THE TOLEDO EDISON CO", "PENNSYLVANIA POWER CO"],
    "BC": ["BALTIMORE GAS & ELECTRIC CO"],
    "CE": ["COMMONWEALTH EDISON CO"],
    "DAY": ["DAYTON POWER & LIGHT CO"],
    "DEOK": ["DUKE ENERGY OHIO INC", "DUKE ENERGY KENTUCKY"],
    "DOM": [
        "VIRGINIA ELECTRIC & POWER CO",
        "MECKLENBURG ELECTRIC COOPERATIVE",
        "SOUTHSIDE ELECTRIC COOP, INC",
        "RAPPAHANNOCK ELECTRIC COOP",
        "SHENANDOAH VALLEY ELEC COOP",
        "CRAIG-BOTETOURT ELECTRIC COOP",
        "CENTRAL VIRGINIA ELECTRIC COOP",
        "COMMUNITY ELECTRIC COOP",
        "BARC ELECTRIC COOP INC",
        "PRINCE GEORGE ELECTRIC COOP",
        "NORTHERN NECK ELEC COOP, INC",
        "A & N ELECTRIC COOP",
        "NORTHERN VIRGINIA ELEC COOP",
        "SOUTHERN MARYLAND ELEC COOP INC",
    ],
    "DPL": ["CHOPTANK ELECTRIC COOPERATIVE, INC", "DELMARVA POWER"],
    "DUQ": ["DUQUESNE LIGHT CO"],
    "JC": ["JERSEY CENTRAL POWER & LT CO"],
    "ME": ["METROPOLITAN EDISON CO"],
    "PE": ["PECO ENERGY CO"],
    "PEP": ["POTOMAC ELECTRIC POWER CO"],
    "PL": ["PPL ELECTRIC UTILITIES CORP"],
    "PN": ["PENNSYLVANIA ELECTRIC CO"],
    "PS": ["PUBLIC SERVICE ELEC & GAS CO"],
    "RECO": ["ROCKLAND ELECTRIC CO"],
    "EKPC": [
        "BIG SANDY RURAL ELEC COOP CORP",
        "BLUE GRASS ENERGY COOP CORP",
        "CLARK ENERGY COOP INC - (KY)",
        "CUMBERLAND VALLEY ELECTRIC, INC.",
        "FARMERS RURAL ELECTRIC COOP CORP - (KY)",
        "FLEMING-MASON ENERGY COOP INC",
        "GRAYSON RURAL ELECTRIC COOP CORP",
        "INTER COUNTY ENERGY COOP CORP",
        "JACKSON ENERGY COOP CORP - (KY)",
        "LICKING VALLEY RURAL E C C",
        "NOLIN RURAL ELECTRIC COOP CORP",
        "OWEN ELECTRIC COOP INC",
        "SALT RIVER ELECTRIC COOP CORP",
        "SHELBY ENERGY CO-OP, INC",
        "SOUTH KENTUCKY RURAL E C C",
        "TAYLOR COUNTY RURAL E C C",
    ],
}


def utility_lookup(spark: SparkSession) -> DataFrame:
    """(name, zone_id), for `territory.assign_territories`."""
    rows = [(name, zone) for zone, names in ZONE_UTILITIES.items() for name in names]
    return spark.createDataFrame(rows, "name string, zone_id string")
