"""Operators for training-data pipelines over document and embedding tables.

Functions that run on workers travel there by value, so executors need this
package's dependencies but not the package itself.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
