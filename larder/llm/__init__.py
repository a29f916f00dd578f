"""Operators for preparing training text; nothing else in the package imports this one.

Tasks run functions of these modules.  They are pickled by value, so that an
executor needs numpy and pyarrow but no installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
