"""Whole data sets, from scan to feature matrix."""
