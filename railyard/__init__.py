"""railyard: fare-tap ridership analytics as Spark DataFrame jobs.

Layers (each a module of ``DataFrame -> DataFrame`` functions):

* ``sources``    – table readers, the tap binding, bronze sources and sinks
* ``functions``  – ``Column`` helpers (calendar keys, distances, curves, ratios)
* ``operators``  – silver, gold, marts, dims, loads, quality, semantic
                   measures, governance, geo, forecast, observability
* ``streaming``  – Structured Streaming versions of ingest, dedup and hourly facts
* ``plans``      – the registered query catalogue and its SQL oracle
"""

__version__ = "0.1.0"
