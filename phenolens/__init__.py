"""phenolens: cohort labelling, feature construction, clustering and purity on PySpark.

Sub-packages: ``sources`` (scans and loaders), ``functions`` (rule and array
expressions), ``operators`` (DataFrame -> DataFrame operators), ``plans``
(composite evaluations and the registered queries), ``streaming``
(streaming k-means on Structured Streaming). Functions travel to the executors
by value, so these need not have the package installed.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"
cloudpickle.register_pickle_by_value(sys.modules[__name__])
