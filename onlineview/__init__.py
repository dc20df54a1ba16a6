"""onlineview: latest-version online views of append-only feature histories, on Spark."""

from .contract import Contract, ContractError
from .operators.reconcile import ReconciliationError
from .operators.snapshot import changes_since, latest, latest_by_max_by, snapshot_as_of, snapshot_counts
from .sources.history import EmptySource, load_contract, read_history

__all__ = [
    "Contract", "ContractError", "EmptySource", "ReconciliationError", "changes_since", "latest",
    "latest_by_max_by", "load_contract", "read_history", "snapshot_as_of", "snapshot_counts",
]
