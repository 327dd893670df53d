"""fundcast: campaign-outcome and document analytics on PySpark.

Every operator takes and returns DataFrames (or fitted ``pyspark.ml`` models)
and runs as ordinary Spark jobs; see README.md for the module map.
"""

__version__ = "0.1.0"
