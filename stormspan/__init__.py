"""Rainfall, storm, overflow, flood-call and radar analytics on Spark DataFrames.

Every public function takes DataFrames or Columns and returns DataFrames or
Columns.  Nothing here triggers a job except the sinks in ``sources.writers``.
"""

__version__ = "0.1.0"
