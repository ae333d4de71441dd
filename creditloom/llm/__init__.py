"""Operations for large-scale training-data pipelines. Nothing else in the library imports this."""

import sys

from pyspark import cloudpickle

# Task code travels with the job, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
