"""The seven derived tables, full or incremental, in dependency order."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow import session

from zoneflow.functions.clock import minus_days
from zoneflow.operators.series import day_index
from zoneflow.plans import features as feats
from zoneflow.plans import staging
from zoneflow.schemas import LMP, LOAD, WEATHER, WEATHER_COLS
from zoneflow.sources import tables


#: The source whose load the features are made of.
METERED = "pjm"
DAY_US = 86_400_000_000
_EPOCH = date(1970, 1, 1).toordinal()


def _day(text: str) -> int:
    return date.fromisoformat(text).toordinal() - _EPOCH


def _shifted(dates: set[str], days: int) -> set[str]:
    return {str(date.fromordinal(_EPOCH + _day(d) + days)) for d in dates}


@dataclass(frozen=True)
class Lookback:
    """Days before the newest row of the target that an incremental run covers.

    The defaults are those of the original tables. They do not line up: a revision of day 4
    to 8 reaches load_features but not features. `consistent()` lines them up.
    """

    stg_load: int = 4
    stg_lmp: int = 2
    stg_weather: int = 1
    load_features_read: int = 15
    load_features: int = 8
    lmp_features: int = 3
    weather_features: int = 1
    features: int = 3

    @staticmethod
    def consistent(poll_days: int = 7) -> Lookback:
        return Lookback(poll_days, poll_days, 1, poll_days + 11, poll_days + 4, poll_days, 1, poll_days + 4)


def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in cols])


_D = T.DoubleType()
_KEY = [("time", T.TimestampType()), ("zone", T.StringType())]
_DEMAND = ["demand_mw", "demand_lag_72h", "demand_lag_168h", "demand_roll_6h", "demand_roll_24h"]
_PRICES = [f"{c}_lag_48h" for c in feats.PRICE_COLS]

SCHEMAS = {
    "stg_load": T.StructType([T.StructField(f.name, f.dataType) for f in LOAD.fields]),
    "stg_lmp": T.StructType(
        [T.StructField({"lmp": "lmp_total"}.get(f.name, f.name), f.dataType) for f in LMP.fields]
    ),
    "stg_weather": T.StructType([T.StructField(f.name, f.dataType) for f in WEATHER.fields]),
    "load_features": _schema(*_KEY, *[(c, _D) for c in _DEMAND]),
    "lmp_features": _schema(*_KEY, *[(c, _D) for c in feats.PRICE_COLS]),
    "weather_features": _schema(*_KEY, *[(c, _D) for c in WEATHER_COLS], ("observation_count", T.LongType())),
    "features": _schema(
        *_KEY, *[(c, _D) for c in [*_DEMAND, *_PRICES, *WEATHER_COLS]], ("observation_count", T.LongType())
    ),
}
KEYS = {
    "stg_load": ["time", "zone", "source"],
    "stg_lmp": ["time", "pnode_id"],
    "stg_weather": ["time", "zone"],
    "load_features": ["time", "zone"],
    "lmp_features": ["time", "zone"],
    "weather_features": ["time", "zone"],
    "features": ["time", "zone"],
}


@dataclass
class Warehouse:
    """Raw frames in, derived tables under `root`."""

    spark: SparkSession
    root: str
    zones: list[str]
    lookback: Lookback = field(default_factory=Lookback)
    lag_mode: str = "row"
    #: Dates of each table that the last refresh made anew.
    remade: dict[str, set[str]] = field(default_factory=dict)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str) -> DataFrame:
        return tables.read_table(self.spark, self.path(name), SCHEMAS[name])

    def read(self, name: str) -> DataFrame:
        return self.table(name).drop(tables.DATE)

    def _refresh(self, name: str, model: Callable[[Column | None], DataFrame], full: bool) -> None:
        """Run one model: in full, or from the high-water mark of its own table."""
        newest = None if full else tables.high_water(self.spark, self.path(name))
        if newest is None:
            tables.write_table(model(None).select(*SCHEMAS[name].names), self.path(name))
        else:
            new = model(newest).select(*SCHEMAS[name].names)
            tables.merge_table(self.spark, self.path(name), SCHEMAS[name], new, KEYS[name])

    def _counts(self) -> dict[str, dict[str, int]]:
        """Rows of each zone and date that load features are made of, from the index of staged load."""
        path = self.path("stg_load")
        counts: dict[str, dict[str, int]] = {z: {} for z in self.zones}
        for e in tables.entries(self.spark, path, tables.state(self.spark, path).parts):
            if e.source == METERED and e.zone in counts:
                counts[e.zone][e.date] = counts[e.zone].get(e.date, 0) + e.n
        return counts

    def _history(self, firsts: set[str], since_day: int | None = None, until: set[str] | None = None) -> DataFrame:
        """Staged load that the features of dates need: theirs, and before each the rows and hours that windows reach.

        `firsts` begin a run of dates each; it ends with the table, or with `until`. Of each zone the
        index names the date that holds the row so many rows back.
        """
        rows_back = max(feats.LAGS_H) if self.lag_mode == "row" else 0
        hours_back = max([h for h, _ in feats.ROLLS_H.values()] + ([] if rows_back else [max(feats.LAGS_H)]))
        reach: dict[str, set[str]] = {}
        for zone, counts in self._counts().items():
            dates, need = sorted(counts), set()
            for first in sorted(firsts):
                at, total = bisect_left(dates, first), 0
                low = min(since_day if since_day is not None else _day(first), _day(first) - -(-hours_back // 24))
                while at and (total < rows_back or _day(dates[at - 1]) >= low):
                    at -= 1
                    total += counts[dates[at]]
                need.update(d for d in dates[at:] if until is None or d in until or d < first)
            reach[zone] = need
        path, schema = self.path("stg_load"), SCHEMAS["stg_load"]
        parts = [p for p in tables.state(self.spark, path).parts if any(p[0] in need for need in reach.values())]
        return tables.read_parts(self.spark, path, schema, parts, lambda e: e.zone in reach and e.date in reach[e.zone])

    def _reached(self, dates: set[str]) -> set[str]:
        """Dates of load features that a change of `dates` of staged load can reach."""
        rows_ahead = max(feats.LAGS_H) if self.lag_mode == "row" else 0
        hours = max([h for h, _ in feats.ROLLS_H.values()] + ([] if rows_ahead else [max(feats.LAGS_H)]))
        out = set(dates)
        for counts in self._counts().values():
            days = sorted(counts)
            for d in dates:
                at, total = bisect_right(days, d), 0
                while at < len(days) and (total < rows_ahead or _day(days[at]) <= _day(d) + -(-hours // 24)):
                    out.add(days[at])
                    total += counts[days[at]]
                    at += 1
        return out

    def _follow(self, name: str, sources: dict[str, str], reach: Callable[[dict[str, set[str]]], set[str]], rows: Callable[[set[str]], DataFrame]) -> None:
        """Make the dates of a table anew that changes of its sources since its last refresh can reach."""
        now = tables.state(self.spark, self.path(name))
        new = {s: tables.changed(self.spark, path, now.seen.get(s)) for s, path in sources.items()}
        dates = reach({s: d for s, (_, d) in new.items()})
        if any(s not in now.seen for s in sources):
            dates |= set(now.dates())  # what an earlier build has written goes too
        self.remade[name] = dates
        seen = {s: n for s, (n, _) in new.items()}
        if dates or seen != {s: now.seen.get(s) for s in sources}:
            df = rows(dates).select(*SCHEMAS[name].names) if dates else self.spark.createDataFrame([], SCHEMAS[name])
            tables.replace_dates(self.spark, self.path(name), df, dates, seen)

    def refresh(self, load: str, lmp: str, weather: str) -> None:
        """Bring all tables up to what the raw tables at these paths hold now, however far back it changed.

        Each table remembers the commits of its sources that it has taken in; the commits after them
        say which dates were rewritten. Those, and the dates that windows and offsets carry them to,
        are made anew whole; no other date is read or written but for the history that lags need.
        """
        raw = {"load": (load, LOAD), "lmp": (lmp, LMP), "weather": (weather, WEATHER)}

        def of(name: str, dates: set[str]) -> DataFrame:
            path, schema = raw.get(name) or (self.path(name), SCHEMAS[name])
            return tables.read_dates(self.spark, path, schema, dates)

        def only(df: DataFrame, dates: set[str]) -> DataFrame:
            return df.filter(F.to_date("time").isin([date.fromisoformat(d) for d in sorted(dates)]))

        def load_features(dates: set[str]) -> DataFrame:
            # runs of dates without one that needs nothing between them share their history
            source = session.materialize(self._history(dates, until=dates).drop(tables.DATE), "history")
            days = session.materialize(day_index(feats.modelled_load(source, self.zones), "zone"), "days")
            return only(feats.load_features(source, self.zones, lag_mode=self.lag_mode, index=days), dates)

        price_days = feats.PRICE_LAG_H // 24
        self._follow("stg_load", {"load": load}, lambda c: c["load"], lambda d: staging.stg_load(of("load", d)))
        self._follow("stg_lmp", {"lmp": lmp}, lambda c: c["lmp"], lambda d: staging.stg_lmp(of("lmp", d), self.zones))
        self._follow("stg_weather", {"weather": weather}, lambda c: c["weather"], lambda d: staging.stg_weather(of("weather", d), self.zones))
        paths = {n: self.path(n) for n in SCHEMAS}
        self._follow("load_features", {"stg_load": paths["stg_load"]}, lambda c: self._reached(c["stg_load"]), load_features)
        self._follow("lmp_features", {"stg_lmp": paths["stg_lmp"]}, lambda c: c["stg_lmp"], lambda d: feats.lmp_features(of("stg_lmp", d)))
        # the last hour of a day is labelled with the next day
        self._follow(
            "weather_features", {"stg_weather": paths["stg_weather"]}, lambda c: c["stg_weather"] | _shifted(c["stg_weather"], 1),
            lambda d: only(feats.weather_features(of("stg_weather", d | _shifted(d, -1))), d),
        )
        inputs = {n: paths[n] for n in ("load_features", "lmp_features", "weather_features")}
        self._follow(
            "features", inputs, lambda c: c["load_features"] | _shifted(c["lmp_features"], price_days) | c["weather_features"],
            lambda d: feats.features(*[of(n, days).drop(tables.DATE) for n, days in zip(inputs, (d, _shifted(d, -price_days), d))]),
        )

    def latest(self, zone: str | None = None) -> DataFrame:
        """Newest features of each zone, from the dates that hold them."""
        rows = tables.read_newest(self.spark, self.path("features"), SCHEMAS["features"], None if zone is None else [zone])
        return staging.last_per_key(rows.drop(tables.DATE), ["zone"], "time")

    def build(self, load: DataFrame, lmp: DataFrame, weather: DataFrame, full_refresh: bool = False) -> None:
        back = self.lookback

        def cut(newest: Column | None, days: int) -> Column | None:
            return None if newest is None else minus_days(newest, days)

        def sliced(name: str, newest: Column | None, days: int) -> DataFrame:
            return tables.since(self.table(name), cut(newest, days))

        def load_features(newest: Column | None) -> DataFrame:
            source = sliced("stg_load", newest, back.load_features_read)
            if newest is not None:
                # on series with gaps the rows that lags count reach further back than the days read
                at = tables.newest_micros(self.spark, self.path("load_features")) // DAY_US
                source = self._history({str(date.fromordinal(_EPOCH + at - back.load_features))}, at - back.load_features_read)
            # written, so that Spark knows its size when it plans the join with the series
            days = session.materialize(day_index(feats.modelled_load(source, self.zones), "zone"), "days")
            return feats.load_features(
                source,
                self.zones,
                write_since=cut(newest, back.load_features),
                lag_mode=self.lag_mode,
                index=days,
            )

        def features(newest: Column | None) -> DataFrame:
            # the joined sides are cut with the slack their offsets need
            return feats.features(
                sliced("load_features", newest, back.features),
                sliced("lmp_features", newest, back.features + 2),
                sliced("weather_features", newest, back.features),
            )

        models = {
            "stg_load": lambda t: staging.stg_load(tables.since(load, cut(t, back.stg_load))),
            "stg_lmp": lambda t: staging.stg_lmp(tables.since(lmp, cut(t, back.stg_lmp)), self.zones),
            "stg_weather": lambda t: staging.stg_weather(
                tables.since(weather, cut(t, back.stg_weather)), self.zones
            ),
            "load_features": load_features,
            "lmp_features": lambda t: feats.lmp_features(sliced("stg_lmp", t, back.lmp_features)),
            "weather_features": lambda t: feats.weather_features(
                sliced("stg_weather", t, back.weather_features)
            ),
            "features": features,
        }
        for name, model in models.items():
            self._refresh(name, model, full_refresh)
