"""zonecast: geo-temporal risk analytics on Spark DataFrames.

Every operator is a function ``DataFrame -> DataFrame`` (or ``-> Column``)
built from Spark SQL expressions, window functions, Spark ML and
Structured Streaming.  Column names are parameters; the defaults follow the
zone x date panel vocabulary.
"""

__version__ = "0.1.0"
