"""Spark-native analytics over captured web material.

Every public function takes and returns DataFrames or Column expressions; none runs an action.
"""
