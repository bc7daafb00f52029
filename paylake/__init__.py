"""paylake: a Spark-native payments lakehouse.

Delimited feeds of transactions, users and merchants are ingested with
Structured Streaming, cleaned with native column expressions, checked against
named rules, routed to valid / quarantine tables, kept as SCD type 1 / 2
tables, projected into a star schema with a risk score, masked by role, and
observed through a queryable run log.

Layout
------
functions/  column-level building blocks (parsers, keys, masks)
operators/  DataFrame -> DataFrame operators (clean, rules, CDC, joins, masking)
plans/      compositions: gold projection, marts, run-log views, refresh
sources/    driver tables, feed readers, fixture views, table sinks
streaming/  file ingest, foreachBatch routing and SCD upkeep, run-log listener
"""

__version__ = "0.1.0"
