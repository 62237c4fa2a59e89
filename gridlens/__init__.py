"""gridlens: Spark-native labelled-telemetry, transaction and order-line analytics.

Every operator is a ``DataFrame -> DataFrame`` function built from the
DataFrame / SQL / Structured Streaming API, so Catalyst and AQE choose the
physical plan.  Modules:

* ``gridlens.sources``    scans, catalogue, manifest, sinks
* ``gridlens.functions``  column expressions (keyed draws, angles, severity, ...)
* ``gridlens.operators``  table jobs (fault labelling, profiling, windows,
                          detectors, scoring, sampling, overlays)
* ``gridlens.plans``      the registered queries and their SQL oracles
* ``gridlens.streaming``  Structured Streaming twins of the batch detectors
"""

from gridlens.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
