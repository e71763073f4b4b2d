"""tidelink: multi-source time-series linkage operators on Spark DataFrames.

Every public operator is a ``DataFrame -> DataFrame`` function whose column
names are parameters, so the same code runs on study-shaped tables and on
the benchmark tables in ``/root/testdata``.
"""

from tidelink.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
