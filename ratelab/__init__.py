"""Directed-triangle counting and rating prediction as plain Spark jobs.

Every public function takes and returns DataFrames and stays lazy unless its
docstring says otherwise (model fitting, sinks, and size checks run jobs).
"""
