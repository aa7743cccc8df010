"""chainsight: supply-chain delay and risk analytics as Spark DataFrame plans.

Layout
------
sources/    readers for raw files and tables, and the test-table adapter
sinks/      writers (overwrite, partitioned, schema-guarded, run log)
functions/  row-level Column expressions (features, encodings, defaults)
operators/  DataFrame -> DataFrame operators (joins, aggregates, windows,
            top-k, set ops, quality reports, ML)
plans/      the bronze / silver / gold jobs and the query catalogue
"""

__version__ = "0.1.0"
PIPELINE_VERSION = "1.0"
