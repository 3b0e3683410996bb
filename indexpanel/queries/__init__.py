"""Every registered query beside the SQL that checks it."""

from indexpanel.queries.base import REGISTRY
from indexpanel.queries import facts, grids, loads, quality, scalars, snapshots, trends  # noqa: F401

QUERIES = {name: fn for name, (fn, _) in REGISTRY.items()}
ORACLES = {name: sql for name, (_, sql) in REGISTRY.items() if sql}
