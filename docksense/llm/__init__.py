"""Operators of a training-data pipeline: mixing, deduplication, extraction, search, packing, filtering, alignment.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""

import sys

from pyspark import cloudpickle

# workers need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
