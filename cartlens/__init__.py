"""cartlens: retail customer-behaviour analytics as lazy Spark DataFrame operators.

Sub-packages:

- ``sources``   explicit-schema readers, report writer/reader, test-table adapters
- ``functions`` column-expression building blocks (bands, money, dates)
- ``operators`` report, view, basket, cleaning and value-model operators
- ``streaming`` spool-directory ingestion with Structured Streaming
- ``plans``     multi-report jobs and the query catalogue used by the checks
"""

__version__ = "0.1.0"
