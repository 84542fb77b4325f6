"""tidings: a news-intelligence engine built on Spark DataFrames.

Every public function takes and returns DataFrames (or Columns); none keeps a
global session.  ``tidings.plans`` wires the operators into named queries.
"""
