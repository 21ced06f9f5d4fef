"""encore: customer-history features, scoring and model selection on Spark.

Every operator is a DataFrame transformation (or a ``pyspark.ml`` job); the
library never pulls a table through the driver. Sub-packages:

* ``sources``   – scans, the driver-table binding, sinks
* ``functions`` – column expressions (cell repair, row statistics, snapping)
* ``operators`` – reshape, aggregate, feature assembly, geography, splits,
                  prediction adjustments, evaluation
* ``models``    – design matrix and ``pyspark.ml`` model families
* ``search``    – cross-validation, grid and random search
* ``plans``     – the registered queries and their SQL oracles

Its functions reach the executors by value, so that these need not have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
