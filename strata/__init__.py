"""strata: a layered commerce warehouse (ODS -> DIM/DWD -> DWS -> labels) on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from the DataFrame
API; the same function runs on a batch DataFrame and on a streaming one.
"""

__version__ = "0.1.0"
