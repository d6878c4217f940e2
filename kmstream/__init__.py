"""kmstream: clustering and anomaly analysis of tables and streams on Spark.

Everything is expressed with DataFrame expressions, ``pyspark.ml`` and
Structured Streaming ``foreachBatch``. Feature vectors are carried as plain
double columns wherever possible so that scaling, distances and cluster
assignment stay inside whole-stage codegen; ``VectorUDT`` columns are used
only where a ``pyspark.ml`` estimator needs them.
"""

import sys as _sys

# Python workers do not need kmstream installed: functions of this package
# that run inside tasks (mapInPandas / pandas UDF bodies) travel by value.
try:  # pragma: no cover - depends on the pyspark build
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass

from kmstream.session import get_spark, scratch_dir  # noqa: E402

__all__ = ["get_spark", "scratch_dir"]
