"""One query per operator over the supplied test tables, each with the SQL of its expected result."""

from . import (  # noqa: F401  (importing registers the queries)
    q_aggregates,
    q_filters,
    q_functions,
    q_generators,
    q_joins,
    q_json,
    q_model,
    q_reports,
    q_sinks,
    q_windows,
)
from .registry import EXPECTED, QUERIES  # noqa: F401
