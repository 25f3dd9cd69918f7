"""All named queries; importing the modules registers them."""

from bibweave.plans import (  # noqa: F401
    queries_checks,
    queries_functions,
    queries_identity,
    queries_records,
    queries_relational,
    queries_sources,
    queries_streams,
)
from bibweave.plans.registry import ORACLES, QUERIES  # noqa: F401
