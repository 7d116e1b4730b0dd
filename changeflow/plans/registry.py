"""All registered queries and their DuckDB oracles.

Every query first pins the session settings it relies on (UTC time zone,
AQE), so results do not depend on how the caller built the session.
"""

from __future__ import annotations

import functools

from changeflow.plans import cdc, observability, streams
from changeflow.session import prepare


def _prepared(fn):
    @functools.wraps(fn)
    def run(spark, sf_dir):
        prepare(spark)
        return fn(spark, sf_dir.rstrip("/"))
    return run


QUERIES = {k: _prepared(v) for k, v in {**cdc.QUERIES, **observability.QUERIES, **streams.QUERIES}.items()}
ORACLE = {**cdc.ORACLE, **observability.ORACLE, **streams.ORACLE}
