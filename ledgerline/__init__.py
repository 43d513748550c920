"""ledgerline: Spark-native panel analytics.

Daily (or hourly) price panels keyed by instrument, leakage-safe feature
preparation, long/cash backtests, classification metrics and report shaping,
all expressed as DataFrame plans.

Subpackages:

- ``sources``   scans of the input tables, panel builders, sinks
- ``plans``     time-blocked series machinery (ordinal, halo windows, prefix scans)
- ``functions`` column-level helpers (safe ratios, labels, constants)
- ``operators`` features, preparation, backtests, metrics, reports, ML jobs
- ``llm`` operators of a training-data pipeline (optional: nothing else imports it)
"""

from ledgerline.session import ensure_checkpoint_dir, get_session

__all__ = ["get_session", "ensure_checkpoint_dir"]
