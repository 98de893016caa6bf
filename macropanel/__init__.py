"""macropanel: panel preparation (outliers, stationarity transforms, EM-PCA imputation,
data card, validation, contracts, sinks) as Spark DataFrame jobs."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# ship this package's task code by value, so Python workers need not import it
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
