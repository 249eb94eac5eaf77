"""chartlens: chart analytics as Spark DataFrame operators.

Subpackages
-----------
sources    chart readers and report writers; chart rows from test tables
functions  column expressions (release typing, genre rule, hash buckets)
operators  DataFrame -> DataFrame operators, one module per topic
plans      the questions composed from operators, the query registry and
           its independent SQL
streaming  incremental reading of chart shards
"""

__version__ = "0.1.0"
