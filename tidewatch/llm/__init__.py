"""Operators for building training corpora."""

from pyspark import cloudpickle

import tidewatch

# Functions of this package travel with the job: workers elsewhere need no copy of it.
cloudpickle.register_pickle_by_value(tidewatch)
