"""Land-parcel crop analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# The few Python helpers that run inside tasks travel with the job, so a cluster needs no --py-files.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
