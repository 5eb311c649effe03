"""factloom: news-to-facts analytics as Spark DataFrame plans.

Functions of this package that run inside Spark tasks (pandas UDFs, the
``mapInPandas`` responder driver) are shipped to the executors by value,
so the executors need no copy of the package on their Python path.
"""

import sys

try:  # pragma: no cover - depends on the installed pyspark
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
