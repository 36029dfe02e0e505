"""Operators for preparing training data; nothing outside this package imports it.

Their Python functions are sent to the workers by value, so that executors need no copy of the
package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
