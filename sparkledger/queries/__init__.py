"""Queries of the engine over the test tables."""

from . import aggregates, constraints, envelopes, evidence, extraction, joins, layers, markers, migrations, networks, repairs, reports, rules, streams, verdicts, views, workflows
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "aggregates", "constraints", "envelopes", "evidence", "extraction", "joins", "layers", "markers", "migrations", "networks", "repairs", "reports", "rules", "streams", "verdicts", "views", "workflows"]
