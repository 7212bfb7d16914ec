"""corpuslake: language-model corpus work expressed as Spark DataFrame jobs."""

import sys as _sys

__version__ = "0.1.0"

# Python code run inside tasks (mapInArrow, pandas UDFs) is shipped by value,
# so executors need no installed copy of this package.
try:
    from pyspark import cloudpickle as _cp
    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - pyspark missing or an older cloudpickle
    pass
