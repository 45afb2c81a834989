"""All registered queries, gathered from the query modules."""

from riskloom.plans import (  # noqa: F401
    queries_cleaning,
    queries_evaluation,
    queries_gates,
    queries_learning,
    queries_portfolio,
    queries_sources,
    queries_streaming,
)
from riskloom.plans.registry import ORACLES, QUERIES, callables  # noqa: F401
