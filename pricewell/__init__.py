"""pricewell: a Spark-native market-data warehouse.

Raw daily price rows are read as text, typed and checked by data-quality rules, de-duplicated,
enriched with rolling window metrics and loaded into a Parquet star schema with a load-run ledger.
Every step is a DataFrame / Spark SQL plan; nothing is pulled to the driver except ledger-sized
totals.

Layout:

* ``sources``   - raw feeds (CSV files, the test-table "tape"), the Parquet warehouse store
* ``functions`` - column expressions (safe parses, normalisation, calendar parts)
* ``operators`` - data-quality rules, rolling metrics, star-schema building, measures
* ``plans``     - BI views and analytical queries, the end-to-end load job
* ``streaming`` - intentionally empty; the reference has no streaming part
"""

__version__ = "0.1.0"
