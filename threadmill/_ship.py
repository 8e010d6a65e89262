"""Send a module's functions to Python workers by value.

Spark pickles Python task code with cloudpickle, which refers to functions of
importable modules by name; a worker then has to import the module itself.
Registering a module for pickling by value embeds its code in the task
instead, so `mapInPandas` / Pandas-UDF bodies work on workers that do not
have this package on their path.
"""

from __future__ import annotations

import sys


def ship_by_value(module_name: str) -> None:
    try:
        from pyspark import cloudpickle
    except ImportError:  # pragma: no cover - very old PySpark
        return
    register = getattr(cloudpickle, "register_pickle_by_value", None)
    if register is not None:
        register(sys.modules[module_name])
