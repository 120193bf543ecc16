"""zonecast: spatio-temporal weather x air-quality analytics as Spark jobs.

Stations report daily weather; zones report air-quality measurements.
The package matches stations to zones by great-circle distance, computes
inverse-distance-weighted zone weather, per-zone pollutant means, city
indicators and calendar-complete time series — all as lazy DataFrame
plans that Catalyst optimises and the cluster executes.
"""

__version__ = "0.1.0"
