"""Operators for training corpora: near copies, contamination, packing, scoring.

The Python code of tasks travels with the job, so that executors need no copy
of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
