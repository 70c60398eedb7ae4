"""Operators for training data.

Functions that run inside tasks are sent to the executors by value, so that the
package need not be installed there.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
