"""The dashboard query (entry C) as one set of lazy DataFrames.

Parameters of the interactive page become arguments: date range, pollutant,
radius and the selected zone. Without a range the page opens on the first and
last date of the air measurements, without a pollutant on the first one; both
are looked up by a small aggregate when first needed. Each view is a lazy
DataFrame the caller writes or shows.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.functions.time import resample_rule
from zonecast.operators import clean, metrics, partials, stats, timeseries
from zonecast.sources import tables
from zonecast.sources.parquet import read_layer


@dataclass(frozen=True)
class Params:
    start: dt.date | None = None   # None: the first date of the air measurements
    end: dt.date | None = None     # None: their last date
    pollutant: str | None = None   # None: the first in the list
    radius_km: float = 15.0
    zone: str | None = None        # None: all zones; the one-zone views need one
    temp_max: float | None = None  # optional TEMP ceiling (C); off, as in the model


class Dashboard:
    def __init__(self, zones, air_raw, weather_raw, params: Params = Params(),
                 observations=None, station_names=None):
        """Inputs are DataFrames or zero-argument callables returning one;
        every layer is built on first use, so a view only plans what it reads.

        ``observations`` + ``station_names`` optionally give the weather as
        a star (observations without NAME, names by station id); the zone
        metrics then aggregate before meeting the names."""
        self.p = params
        self._inputs = {"zones": zones, "air_raw": air_raw, "weather_raw": weather_raw,
                        "observations": observations, "station_names": station_names}
        # optional narrower sources for in-range views (partition-pruned reads)
        self._air_range_src: DataFrame | None = None
        self._weather_range_src: DataFrame | None = None
        self._raw: Dashboard | None = None      # of a daily dashboard: the one that has the rows

    def _input(self, name: str) -> DataFrame | None:
        value = self._inputs[name]
        if value is not None and not isinstance(value, DataFrame):
            value = self._inputs[name] = value()
        return value

    @classmethod
    def from_tables(cls, spark: SparkSession, sf_dir: str, params: Params = Params()) -> "Dashboard":
        return cls(lambda: tables.zones(spark, sf_dir), lambda: tables.air_raw(spark, sf_dir),
                   lambda: tables.weather_raw(spark, sf_dir), params,
                   observations=lambda: tables.weather_observations(spark, sf_dir),
                   station_names=lambda: tables.station_names(spark, sf_dir))

    # --- inputs and cleaned layers (built on first use) ------------------
    @cached_property
    def zones(self) -> DataFrame:
        return self._input("zones")

    @cached_property
    def air_clean(self) -> DataFrame:
        return clean.clean_air(self._input("air_raw"))

    @cached_property
    def weather(self) -> DataFrame:
        return clean.clean_weather(self._input("weather_raw"), self.p.temp_max)

    @cached_property
    def observations(self) -> DataFrame | None:
        obs = self._input("observations")
        return None if obs is None else clean.clean_weather(obs, self.p.temp_max)

    @cached_property
    def station_names(self) -> DataFrame | None:
        return self._input("station_names")

    @classmethod
    def from_extracts(cls, spark: SparkSession, air_extract: str, weather_extract: str,
                      zones: DataFrame, params: Params = Params()) -> "Dashboard":
        """Serve from the ETL's parquet extracts (partitioned by year, so the
        date range prunes whole directories). The air extract is typed,
        cleaned and carries its zone's columns already."""
        weather, air = read_layer(spark, weather_extract), read_layer(spark, air_extract)
        dash = cls(zones, None, weather.drop("YEAR"), params)
        dash.air_clean = dash.air = air.drop("YEAR")
        # in-range views read only the range's year directories; the station
        # dimension and the date bounds still see every date
        start, end = dash.range
        years = F.col("YEAR").between(start.year, end.year) if start else F.lit(True)
        dash._air_range_src = air.where(years).drop("YEAR")
        dash._weather_range_src = clean.clean_weather(
            weather.where(years).drop("YEAR"), params.temp_max)
        return dash

    # --- widget values that default to the data's own ----------------------
    @cached_property
    def range(self) -> tuple[dt.date | None, dt.date | None]:
        """The date range; open ends are the bounds of the air measurements
        (one aggregate; None when there is no dated measurement)."""
        start, end = self.p.start, self.p.end
        if start is None or end is None:
            low, high = metrics.date_bounds(self.air).first()
            start, end = start or low, end or high
        return start, end

    @cached_property
    def rule(self) -> str:
        start, end = self.range
        return resample_rule(start, end) if start and end else "D"

    @cached_property
    def pollutant(self) -> str:
        if self.p.pollutant is not None:
            return self.p.pollutant
        return self.require_pollutants().first()[0]

    def require_pollutants(self) -> DataFrame:
        """The pollutants of the range; the page stops where there is none."""
        found = self.pollutant_list()
        if found.isEmpty():
            raise LookupError(f"no pollutant was measured between {self.range[0]} and {self.range[1]}")
        return found

    @property
    def zone(self) -> str:
        if self.p.zone is None:
            raise ValueError("this view needs a zone")
        return self.p.zone

    # --- layers kept across interactions -----------------------------------
    def _layers(self) -> tuple[str, ...]:
        return ("air_clean", "observations") if self.observations is not None else ("air", "weather")

    def persist(self) -> "Dashboard":
        """Keep each cleaned fact once across interactions (the page cache of
        the model): every view then starts from the cleaned rows."""
        from pyspark import StorageLevel
        self._air_range_src = self._weather_range_src = None     # views filter the kept rows
        if self.observations is None:
            self.air_clean = self.air
        for name in self._layers():
            setattr(self, name, getattr(self, name).persist(StorageLevel.MEMORY_AND_DISK))
        if self.observations is None:
            self.air_clean = self.air
        return self

    def daily(self) -> "Dashboard":
        """The same page on daily sums and counts: a row a station position
        and day, and a zone, pollutant and day. Its means, lists and series
        read no row of the facts; once persisted, every widget state is
        answered from it. Views of single rows (box statistics, the weather
        of one zone) still go to the facts."""
        other = self.with_params(self.p)
        other._raw, other._air_range_src, other._weather_range_src = self, None, None
        if self.observations is not None:
            other.observations = partials.daily(self.observations, metrics.WEATHER_VARS)
            other.air_clean = partials.daily(self.air_clean, ("VALEUR",))
        else:
            other.weather = partials.daily(self.weather, metrics.WEATHER_VARS)
            other.air = other.air_clean = partials.daily(self.air, ("VALEUR",))
        return other

    def unpersist(self) -> "Dashboard":
        """Release the layers kept by :meth:`persist` (the caller ends the session)."""
        for name in self._layers():
            getattr(self, name).unpersist()
        return self

    def with_params(self, params: Params) -> "Dashboard":
        """The same (possibly persisted) layers under new widget values: one
        interaction of the page. Cleaned weather is shared only when the
        cleaning parameters are unchanged (daily sums are made anew else)."""
        if self._raw is not None and params.temp_max != self.p.temp_max:
            return self._raw.with_params(params).daily()
        other = object.__new__(Dashboard)
        keep = ["_air_range_src", "_weather_range_src", "zones", "air_clean", "station_names"]
        if self.observations is None:
            keep.append("air")
        if params.temp_max == self.p.temp_max:
            keep += ["weather", "observations"]
        other.__dict__.update({k: v for k, v in self.__dict__.items() if k in keep})
        other._inputs = dict(self._inputs)
        other._raw = None if self._raw is None else self._raw.with_params(params)
        other.p = params
        return other

    def views(self) -> dict[str, DataFrame]:
        """Every view of one page refresh."""
        display = self.display()
        return {"display": display, "kpi": metrics.kpi_formatted(metrics.kpi_global(display)),
                "pollutants": self.pollutant_list(), "air_series": self.resample_air(),
                "weather_series": self.resample_weather(), "paired": self.paired_series()}

    # --- cleaned layers -------------------------------------------------
    @cached_property
    def air(self) -> DataFrame:
        """Air measurements joined to their zone (the serving extract)."""
        return clean.air_zone_join(self.air_clean, self.zones)

    @cached_property
    def air_in_range(self) -> DataFrame:
        src = self.air if self._air_range_src is None else self._air_range_src
        return clean.date_range_filter(src, "DATE_OBSERVATION", *self.range)

    @cached_property
    def weather_in_range(self) -> DataFrame:
        src = self.weather if self._weather_range_src is None else self._weather_range_src
        return clean.date_range_filter(src, "DATE", *self.range)

    @property
    def _star(self) -> bool:
        """Observations without names + a name dimension are available: the
        station aggregates then run before meeting the names."""
        return (self._weather_range_src is None and self.observations is not None
                and self.station_names is not None)

    @cached_property
    def stations(self) -> DataFrame:
        if self._star:
            return clean.station_dim(self.observations, names=self.station_names)
        return clean.station_dim(self.weather)

    # --- zone map ------------------------------------------------------
    def station_means(self) -> DataFrame:
        if self._star:
            named = self.station_names.select("ID_STATION").distinct()
            return metrics.station_means(self._observations_in_range()).join(named, "ID_STATION", "left_semi")
        return metrics.station_means(self.weather_in_range)

    def stations_with_means(self) -> DataFrame:
        if self.observations is not None and self.station_names is not None:
            return metrics.stations_with_means(self.observations, *self.range, names=self.station_names)
        return metrics.stations_with_means(self.weather, *self.range)

    def zone_weather(self) -> DataFrame:
        return metrics.zone_weather_idw(self.zones, self.stations_with_means(), self.p.radius_km)

    def radius_join(self) -> DataFrame:
        return metrics.radius_join(self.zones, self.stations_with_means(), self.p.radius_km)

    def pollutant_means(self) -> DataFrame:
        src = self.air_clean if self._air_range_src is None else self._air_range_src
        return metrics.pollutant_zone_mean(src, self.zones, self.pollutant, *self.range)

    def display(self, keep_position: bool = False) -> DataFrame:
        return metrics.zone_display(self.zones, self.pollutant_means(), self.zone_weather(),
                                    keep_position=keep_position)

    # --- indicators ----------------------------------------------------
    def kpi_global(self) -> DataFrame:
        return metrics.kpi_global(self.display())

    def kpi_formatted(self) -> DataFrame:
        return metrics.kpi_formatted(self.kpi_global())

    def zone_detail(self) -> DataFrame:
        return metrics.zone_detail(self.display(), self.zone)

    def active_stations(self) -> DataFrame:
        return metrics.active_stations(self.stations_with_means())

    def stations_near_center(self) -> DataFrame:
        centre = metrics.centre_row(self.zones)
        near = metrics.stations_near(centre, self.active_stations(), self.p.radius_km)
        at = ["LATITUDE_CENTER", "LONGITUDE_CENTER"]
        counted = near.groupBy(*at).agg(F.count(F.lit(1)).cast("int").alias("NB_VISIBLE"))
        return centre.join(counted, at, "left").select(*at, F.coalesce("NB_VISIBLE", F.lit(0)).alias("NB_VISIBLE"))

    def stations_near_zone(self) -> DataFrame:
        counted = metrics.count_near(metrics.zone_row(self.zones, self.zone), self.active_stations(), self.p.radius_km)
        return counted.select(F.lit(self.zone).alias("GEOCODE"), "NB_VISIBLE")

    def local_weather(self) -> DataFrame:
        if self._raw is not None:
            return self._raw.local_weather()
        return metrics.local_weather(self.weather_in_range, self.stations, metrics.zone_row(self.zones, self.zone),
                                     self.p.radius_km)

    def pollutant_list(self) -> DataFrame:
        return metrics.pollutant_list(self.air_in_range)

    # --- time series ---------------------------------------------------
    def air_series_source(self) -> DataFrame:
        return self.air_in_range.where(F.col("NOM_POLLUANT") == self.pollutant)

    def _observations_in_range(self) -> DataFrame:
        return clean.date_range_filter(self.observations, "DATE", *self.range)

    def _weather_series_input(self) -> tuple[DataFrame, DataFrame | None]:
        """(rows, keep_keys): in the star layout the observations are summed
        per station and bucket before those sums meet the station names."""
        if self._star:
            return self._observations_in_range(), self.station_names
        return self.weather_in_range, None

    def resample_weather(self, rule: str | None = None) -> DataFrame:
        rows, keys = self._weather_series_input()
        return timeseries.resample_mean(rows, "DATE", metrics.WEATHER_VARS, rule or self.rule, keep_keys=keys)

    def resample_air(self, rule: str | None = None) -> DataFrame:
        return timeseries.resample_mean(self.air_series_source(), "DATE_OBSERVATION", "VALEUR", rule or self.rule)

    def paired_series(self, rule: str | None = None) -> DataFrame:
        rows, keys = self._weather_series_input()
        return timeseries.paired_series(self.air_series_source(), rows, rule or self.rule, weather_keys=keys)

    def box_stats(self) -> DataFrame:
        if self._raw is not None:
            return self._raw.box_stats()
        if self._star:          # observations of named stations, without their names
            named = self.station_names.select("ID_STATION").distinct()
            rows = self._observations_in_range().join(named, "ID_STATION", "left_semi")
        else:
            rows = self.weather_in_range
        return stats.box_stats(rows, metrics.WEATHER_VARS)

    # --- one-zone view: the same charts over the selected zone -----------
    def local_air_source(self) -> DataFrame:
        return self.air_series_source().where(F.col("GEOJOIN_ID") == self.zone)

    def _local_rows(self) -> DataFrame:
        """Weather rows of the stations near the selected zone, for views that
        need no station name: with the star layout the observations are
        filtered directly (the nearby ids come from the named dimension)."""
        if not self._star:
            return self.local_weather()
        return metrics.local_weather(self._observations_in_range(), self.stations,
                                     metrics.zone_row(self.zones, self.zone), self.p.radius_km)

    def local_paired_series(self, rule: str | None = None) -> DataFrame:
        """The observations are summed per station and bucket before those sums meet the nearby ids."""
        rows = self._observations_in_range() if self._star else self.weather_in_range
        near = metrics.local_ids(self.stations, metrics.zone_row(self.zones, self.zone), self.p.radius_km)
        return timeseries.paired_series(self.local_air_source(), rows, rule or self.rule, weather_keys=near)

    def local_box_stats(self) -> DataFrame:
        if self._raw is not None:
            return self._raw.local_box_stats()
        return stats.box_stats(self._local_rows(), metrics.WEATHER_VARS)
