"""tideline: event-stream analytics on Spark DataFrames and Structured Streaming.

Subpackages:

* ``sources``   - table loaders, literal fixtures, event generators, file/Kafka/JDBC readers
* ``functions`` - scalar column helpers (signal rule, whitespace split, JSON codec, UDTF)
* ``operators`` - batch operators: ordered per-key scans, price signals, windows, dedup,
                  watermark traces, word count
* ``streaming`` - Structured Streaming forms, including ``transformWithState`` processors
* ``sinks``     - console / memory / Kafka / JDBC writers and the two-sink side output
* ``plans``     - the registered queries and their SQL oracles
"""

from tideline.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]
