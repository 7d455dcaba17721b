"""Operators of a training-data pipeline over ``documents`` and ``pages``.

Nothing else in the library imports this package; its queries are in
``queries.py`` and are registered by ``__spark_entry__.py`` when it can be
imported.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with them: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
