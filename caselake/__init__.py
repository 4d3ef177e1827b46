"""caselake: court-opinion and statute text pipelines as lazy Spark DataFrame operators.

Every public operator takes DataFrames (or Columns) and returns a DataFrame
(or Column) without triggering an action, so Catalyst sees one plan per query
and can push filters into scans, prune columns and choose join strategies.
"""

from caselake.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]
