"""Operators on training text: mixing, near copies, packing, search, licences, quality, secrets, chat, personal data, fingerprints.

Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Executors need not have this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
