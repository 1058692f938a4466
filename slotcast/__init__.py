"""Slot-grain demand analytics on Spark.

Every operator takes and returns DataFrames. No event or forecast row is collected to the driver;
what it gets are single rows of counts, partition names, labels and configuration files. Actions
live in ``sources``, ``plans``, ``operators.model`` and ``session``.
"""

import sys

from pyspark import cloudpickle

# Executors need not have this package: the functions they run travel with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
