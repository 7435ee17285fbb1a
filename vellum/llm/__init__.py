"""Operators of a training-data pipeline (see the README's section on ``llm``).

Nothing else in the library imports this subpackage. Each operator module has
a general function; :mod:`vellum.llm.queries` has the thin registered queries.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the task: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
