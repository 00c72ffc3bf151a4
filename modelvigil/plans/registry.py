"""All registered queries and the SQL each must agree with."""

from __future__ import annotations

from modelvigil.plans import examples, judging, live, records, rolling, searching

_MODULES = (rolling, records, judging, examples, searching, live)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
