"""quarry: reusable analytics operators on Spark DataFrames.

Every public operator is a plain function ``DataFrame -> DataFrame`` (or
``DataFrame -> Column``) built from Spark SQL expressions, windows, joins
and aggregates, so Catalyst plans it and Tungsten runs it JVM-side.
"""

import sys as _sys

__version__ = "0.1.0"

# The few functions that run inside Python workers (prefix-scan pass, Elo
# replay, streaming state update) are shipped by value, so executors do
# not need the package installed.
try:
    from pyspark import cloudpickle as _cp
    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass
