"""Operators for preparing training text: packing, language ID, pseudonyms,
near-duplicates, URL rules, edit fingerprints, sharding, chat formatting,
benchmark decontamination and licence scans.

Nothing else in the library imports this subpackage.  Functions that run in
Python workers travel with the job (pickled by value), so executors need only
Python, numpy and pyarrow, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
