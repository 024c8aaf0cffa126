"""Hierarchical feature engineering and ensembling on Spark.

Data come in three nested levels (event, jet, particle).  The package holds
column functions, DataFrame operators, the feature plans built from them and
the MLlib jobs that train on the result.
"""
