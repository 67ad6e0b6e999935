"""Operators of a training-data pipeline, each a Spark job over whole tables.

Nothing else in the library imports this subpackage. Functions that run inside
tasks are shipped by value, so executors need numpy, pyarrow and the tokenizer
libraries, but not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
