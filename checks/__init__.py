"""Every operator bound to the driver tables, with its SQL counterpart."""

from checks import queries  # noqa: F401
from checks.registry import QUERIES, SQL  # noqa: F401
