"""Intermediate tables of the operators, in this application's folder of ``spark.checkpoint.dir``."""

from linkloom.sources.storage import local_path, materialize, new_path, release, run_dir, shared_dir

__all__ = ["local_path", "materialize", "new_path", "release", "run_dir", "shared_dir"]
