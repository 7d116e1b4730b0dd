"""Spark-native change-data tables and pipeline metrics.

Every public function takes and returns DataFrames; nothing is collected to the
driver except small table metadata (commit markers and version numbers).
"""

from changeflow.functions.series import and_series, combine, firing, increase, instant, range_at_grid
from changeflow.operators.alerts import RULES, evaluate
from changeflow.operators.latest import precombine
from changeflow.operators.panels import PANELS, panel
from changeflow.operators.routing import dead_letters, point_lookup, project_rows, route
from changeflow.operators.table import (
    TableSpec, apply_changes, clean, compact, expired_versions, read_optimized_view, register_table,
    snapshot_view,
)
from changeflow.sources.messages import MessageSource, parse_messages, read_messages
from changeflow.streaming.apply import Outputs, finish_apply, start_apply

__version__ = "0.1.0"

__all__ = [
    "MessageSource", "Outputs", "PANELS", "RULES", "TableSpec", "and_series", "apply_changes", "clean",
    "combine", "compact", "dead_letters", "evaluate", "expired_versions", "finish_apply", "firing", "increase",
    "instant", "panel", "parse_messages", "point_lookup", "precombine", "project_rows", "range_at_grid",
    "read_messages", "read_optimized_view", "register_table", "route", "snapshot_view", "start_apply",
]
