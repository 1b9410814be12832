"""geofleet: device-event analytics on Spark.

Raw GPS readings are routed, normalised and enveloped; change-data-capture
messages are unwrapped into a bronze table; bronze is refined into a typed
staging view, a severity-tagged silver table and a per-device daily gold
table. Fleet queries, a keyed serving table, an hourly archive and
declarative data-quality checks are built on top.

Every operator is a function ``DataFrame -> DataFrame``; "now" is always a
parameter (``as_of``), so the same code runs in batch and in Structured
Streaming micro-batches.
"""

__version__ = "0.1.0"
