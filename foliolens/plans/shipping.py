"""Functions that travel to Python workers with their code."""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def by_value(function):
    """Ship the code of the function's module with the task, so that workers need not have this package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[function.__module__])
    return function
