"""signalbox: Spark-native rail disruption analytics.

Operators take and return DataFrames and hold no session state. Sources read
captured documents and tables, functions are Column expressions, operators
are DataFrame transformations, plans wire operators into jobs, streaming
holds the incident stream and sinks the writers.
"""

__version__ = "0.1.0"
