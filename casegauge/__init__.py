"""casegauge: record-quality screening, scoring and reporting on Spark DataFrames."""

import sys as _sys

__version__ = "0.1.0"

# The few Python functions that run inside tasks (Arrow UDF fallbacks, the pluggable
# evaluator wrapper) are shipped by value, so executors need no installed copy of this
# package -- the same job runs from a notebook, spark-submit or a test runner.
try:
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle: fall back to importable package
    pass
