"""Spark-native analytics for the outcomes of code changes made by coding agents.

Every public function takes and returns DataFrames (or Columns); nothing here starts a
session, collects data or keeps state between calls.
"""

__version__ = "0.1.0"

CENSUS_METHOD = "census-spark-1"
"""Version tag of the census row semantics; stamped on every row and used as a partition key."""

PANEL_METHOD = "panel-spark-1"
"""Version tag of the panel row semantics."""
