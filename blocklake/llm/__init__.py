"""Operators of a training-data pipeline over documents, pages and embeddings (nothing else imports this)."""

import sys

from pyspark import cloudpickle

# The functions that run inside tasks travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
