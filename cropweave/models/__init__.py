"""Splits, scaling, regressors, metrics and reports on Spark ML."""
