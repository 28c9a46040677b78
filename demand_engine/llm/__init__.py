"""Operations of a training-data pipeline over tables of documents, pages and conversations."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors as code, which need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
