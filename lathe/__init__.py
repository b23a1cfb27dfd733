"""lathe: Spark-native feature, profiling and scoring operators for entity tables.

Every operator is a ``DataFrame -> DataFrame`` function (or a ``Column``
expression) with the column names as parameters. Nothing on the data path
is a Python UDF; fitted state is kept as small Spark tables.
"""

__version__ = "0.1.0"
