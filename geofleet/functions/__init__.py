"""Column-level building blocks (all JVM-side, inside whole-stage codegen)."""

from geofleet.functions.geo import hex_channel, in_wgs84_bounds, severity  # noqa: F401
from geofleet.functions.time import (  # noqa: F401
    epoch_millis_to_ntz,
    floor_ntz,
    instant_to_ntz,
    iso_text,
    minute_boundaries_between,
    ntz_epoch_micros,
    ntz_epoch_millis,
    ntz_literal,
    reading_time_to_millis,
)
from geofleet.functions.topics import topic_filter_regex  # noqa: F401
