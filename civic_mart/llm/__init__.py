"""Training-data pipeline operators.  Nothing else in the library imports this subpackage.

Functions of this subpackage travel to the Python workers by value, so a job runs the
same whether or not the package is installed on the executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
