"""Case supervision analytics as DataFrame-to-DataFrame functions on Spark."""

import sys

from pyspark import cloudpickle

# The few Python functions that run inside tasks travel with the plan, so executors need
# pandas and NumPy but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
