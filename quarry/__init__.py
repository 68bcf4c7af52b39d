"""quarry: corpus curation, evaluation analytics and serving-log analytics on Spark.

Every public operator is a plain function ``DataFrame -> DataFrame`` (or a
``Column`` expression) built from the DataFrame API and Spark SQL functions.
"""

__version__ = "0.1.0"
