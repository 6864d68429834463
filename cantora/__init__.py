"""cantora: a Spark-native commercial-analytics engine.

Layers (all lazy DataFrame transformations on built-in expressions):

* ``sources``   – table access, the star-schema bridge over the driver tables,
                  raw landing, file round-trips, catalog profiles.
* ``functions`` – Column -> Column helpers (cleaning, dates, guarded math).
* ``operators`` – reusable relational building blocks (star joins, series
                  windows, KPIs, forecasting, data quality, fault injection).
* ``plans``     – named analyses (marts, staging, registered queries and their
                  SQL oracles).
* ``streaming`` – incremental landing of raw batch files.
"""

__all__ = ["session"]
