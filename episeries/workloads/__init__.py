"""Every operator as a query over the driver tables, each beside its SQL."""

from episeries.workloads import bulletins, dated, health, kept_up, tabular, wording  # noqa: F401
from episeries.workloads.registry import WORKLOADS  # noqa: F401
