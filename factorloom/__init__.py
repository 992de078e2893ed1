"""factorloom: equity factor screening on Spark DataFrames.

Layers of a run: land (``sources``, ``streaming``) -> clean (``operators``) -> score
(``plans``) -> serve (``plans.serving``).  Every operator takes and returns lazy
DataFrames; only sinks, lineage cuts and size checks start a job.
"""

from factorloom.context import RunContext
from factorloom.session import build_session, cut_lineage, scratch_path, shared_dir

__all__ = ["RunContext", "build_session", "cut_lineage", "scratch_path", "shared_dir"]
