"""Panel feature engineering and regression over regional daily measurements.

Every operator is a lazy ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function built from the public DataFrame, SQL and ML APIs, so that Catalyst sees
the whole plan.
"""
