"""Operators of a training-data pipeline: de-duplication, tokens, packing, search, language and model scores.

Functions that run in Python tasks travel with the job by value, so executors need the libraries these modules import
(numpy, pyarrow, tokenizers, xxhash), but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
