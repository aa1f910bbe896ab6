"""Analytics over the operational records of a fleet of database servers.

Every public function takes DataFrames plus plain parameters and returns a
DataFrame (or a small tuple of them), so Catalyst sees one declarative plan.
"""
