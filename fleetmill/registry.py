"""The queries of the reliability library and their SQL."""

from fleetmill.plans.oracle import SQL
from fleetmill.plans.queries import QUERIES

ORACLE_SQL = {name: SQL[name] for name in QUERIES if name in SQL}
