"""moodframe: DataFrame operators for rated, ordered text on Spark.

Every operator takes DataFrames (and column names as parameters) and returns
DataFrames; nothing is collected to the driver except fixed-size results such
as the k x k Gram matrix of a least-squares fit.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run on executors travel with the job instead of being imported
# there, so the workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
