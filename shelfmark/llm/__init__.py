"""Training-data operators: filtering, deduplication, scoring, archives and mixing."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the workers with their code, so that these need not
# have the library installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
