"""valuetide: customer value and churn analytics as Spark DataFrame operators.

Three input tables (``users``, ``events``, ``transactions``) flow through
``operators``; every operator is a function from DataFrames to DataFrames and
leaves physical planning to Catalyst and AQE.  Only ``sources`` and
``plans.job`` touch paths.
"""

__version__ = "0.1.0"
