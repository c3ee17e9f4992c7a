"""arrivo: a PySpark engine that takes delimited or Parquet trip tables from
raw rows to a cross-validated regression model for arrival delay.

Every step is a DataFrame function or a fit/transform pair built from Spark
SQL expressions, joins, aggregations and MLlib, with column names supplied
through a :class:`arrivo.layout.Layout`.
"""

from arrivo.layout import FLIGHTS, TRIPS, Layout  # noqa: F401
