"""Operators of a training-data pipeline, one module each.

Functions that run inside tasks are pickled with their code, so executors need no copy of the
package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
