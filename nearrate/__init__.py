"""nearrate: rating prediction and k-nearest-neighbour recommendation on Spark.

Every operator takes and returns DataFrames. Recommendation checkpoints its item
index when its plan is built; all else runs when the result is read.
"""

import sys as _sys

# The pandas functions run by applyInPandas are defined in this package. Ship
# them by value, so that executors need no copy of the package on their path.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle: ship the package instead
    pass

from nearrate.session import get_session, checkpoint_dir  # noqa: E402

__all__ = ["get_session", "checkpoint_dir"]
