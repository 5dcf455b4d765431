"""siteloom: variant-site analytics as lazy PySpark DataFrame operators.

Every operator takes a DataFrame (and parameters) and returns a DataFrame, so pipelines are
written with ``DataFrame.transform`` and planned as a whole by Catalyst.
"""
