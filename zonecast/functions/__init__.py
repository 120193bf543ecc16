"""Column-level building blocks (pure JVM expressions, no Python UDFs)."""

from zonecast.functions.geo import haversine_km, idw_weight
from zonecast.functions.numeric import nan_to_null, round_half_even
from zonecast.functions.time import bucket_label, resample_rule, resample_rule_for_span

__all__ = [
    "haversine_km", "idw_weight", "nan_to_null", "round_half_even",
    "bucket_label", "resample_rule", "resample_rule_for_span",
]
