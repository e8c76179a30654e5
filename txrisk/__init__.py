"""Risk scoring of payment transactions on PySpark.

Operators take DataFrames and return DataFrames, so they compose into Catalyst
plans.  Nothing runs at import time.
"""

from txrisk import schema, sources
from txrisk import streaming as stream
from txrisk.operators import evaluate, features, mlprep, quality, sampling
from txrisk.plans import jobs, train

__all__ = [
    "evaluate",
    "features",
    "jobs",
    "mlprep",
    "quality",
    "sampling",
    "schema",
    "sources",
    "stream",
    "train",
]
