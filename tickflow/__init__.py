"""tickflow: price bars, moving-average crossovers, news sentiment and combined
trading signals as plain Spark DataFrame operators.

Every operator takes and returns DataFrames and is built from built-in Spark
expressions, so Catalyst sees the whole plan. Sub-packages:

* ``sources``   – message schemas, topic envelopes (Kafka or file-backed), tables
* ``functions`` – column-level helpers (text cleaning, ISO formatting), joins with side tables
* ``operators`` – bars, indicators, signals, news, sentiment, serving, incremental
* ``plans``     – end-to-end batch jobs and the test-table derivations
* ``streaming`` – Structured Streaming versions of the signal jobs
"""

__version__ = "0.1.0"
