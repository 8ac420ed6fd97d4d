"""cartwheel — engagement analytics and product recommendation on Spark.

Every public operator is a function ``DataFrame -> DataFrame`` whose data stays
on the executors; the driver sees scalars and fitted weights of bounded size.
Column names are parameters with snake_case defaults.
"""

from cartwheel.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
