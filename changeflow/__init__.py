"""changeflow: analytics over change-data-capture streams, on PySpark.

Layers, bottom up:

* ``specs``      the eight captured tables: wire payload, stored columns, keys
* ``sources``    change topics, snapshots, CSV back-fill, decoding, batch tables
* ``functions``  column expressions: rates, time windows, aging buckets
* ``operators``  history -> state, as-of, pre-aggregates, funnel, quantiles, joins
* ``plans``      normalised views, serving views and the end-user queries
* ``streaming``  Structured Streaming jobs that feed history, state, aggregates

All functions take and return DataFrames and take the reference time ``as_of``
as an argument.  Instants are ``TIMESTAMP`` read in a UTC session (see
``session.pin_utc``).
"""
