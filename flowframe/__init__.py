"""flowframe: a PySpark-native toolkit for table preparation, profiling, time-series
features, modelling and batch forecasting.

Every operator is a plain function ``DataFrame -> DataFrame`` (or a small object
holding fitted parameters as DataFrames).  Order-dependent operators take explicit
``keys`` (series identity) and ``order`` (row order) because Spark rows have no
order; see :mod:`flowframe.operators.order` for how they stay distributed when a
series is empty-keyed or one key is very large.
"""

__version__ = "0.1.0"
