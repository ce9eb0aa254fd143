"""Operators for large training corpora, each a ``DataFrame -> DataFrame`` job.

Nothing else in the library imports this subpackage. Functions that run inside
Python workers are shipped with the job (pickled by value), so executors need
numpy and pyarrow but no installed copy of this package.
"""
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
