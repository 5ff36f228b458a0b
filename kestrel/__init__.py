"""kestrel — a PySpark-native analytics library.

Parameterised DataFrame / SQL / Structured Streaming functions for the
window analytics, nested data and JSON, versioned tables, stream windows
and state, vectorised user functions, and composed jobs (market data,
web logs, entity resolution, recommendation, anomaly detection).
"""

__version__ = "0.1.0"
