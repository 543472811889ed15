"""paritas: compare two tables at scale and explain how they differ.

Everything is expressed as lazy DataFrame plans (joins, windows, aggregates)
that Catalyst and AQE optimise; no row data is collected to the driver and no
Python UDF sits on the data path.
"""

from .plans.validate import Reconciliation, reconcile
from .spec import ColumnResolutionError, ReconSpec, Resolved

__all__ = ["ColumnResolutionError", "ReconSpec", "Reconciliation", "Resolved", "reconcile"]
