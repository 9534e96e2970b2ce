"""Operations of a training-data pipeline: near-duplicate joins, sharding,
tokenizing, language, toxicity, fingerprints, packing and URL rules.

Nothing else in the library imports this package. Its Python kernels travel
to the workers by value, so executors need only the libraries they use.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
