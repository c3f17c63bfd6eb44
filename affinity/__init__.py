"""affinity: a PySpark library for ratings and catalogue analytics.

Every operator takes DataFrames (or a SparkSession and a table folder) and
returns a lazy DataFrame; nothing is collected to the driver inside an
operator.
"""

__version__ = "0.1.0"
