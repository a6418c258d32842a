"""carelake: a Spark-native hospital lakehouse library.

Layers: ``sources`` (bronze readers), ``operators`` (silver conditioning, gold
dimensions/facts/summaries, KPIs, profiling), ``quality`` (check compiler and
validation suites), ``sinks`` (publication), ``plans`` (layered batch runs and the
query catalogue) and ``streaming`` (incremental ingestion of landed files).
Every operator takes and returns DataFrames; nothing is collected except
one-row results whose size does not depend on the data.
"""

__version__ = "0.1.0"
