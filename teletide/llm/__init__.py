"""Operations of a training-data pipeline over documents, conversations and embeddings."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers carry what they use of this package, so that executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
