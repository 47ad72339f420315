"""errlens: supervised classification and error analysis on Spark.

DataFrame in, DataFrame out.  Every operator is expressed with the
DataFrame API and MLlib so Catalyst plans it and executors run it;
nothing whole is collected to the driver except tables whose size is
bounded by the number of classes, features, models or grid points.
"""

from errlens.session import get_session, scratch_path, ensure_checkpoint_dir

__all__ = ["get_session", "scratch_path", "ensure_checkpoint_dir"]
