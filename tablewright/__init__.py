"""Keep analytical tables up to date, and check them, with Spark."""

from .assets import materialize, run_python, run_query, run_rollup, run_seed
from .operators.checks import CheckFailed, Watch, require_passed, run_checks
from .operators.funnels import funnels
from .operators.gates import NotReady, gate_query, gate_table, require_ready
from .operators.rollup import Measure, cube, grouping_sets, rollup
from .operators.sketches import Sketch, estimates, merge_sketches, sketch
from .operators.strategies import MissingTarget, next_state, plan_change
from .operators.temporal import asof_join, overlap_join
from .plans.change import Change
from .plans.sizing import Limits
from .sources.seed import SeedError, read_seed
from .sources.store import PublishError, TableStore
from .sources.transform import TransformError
from .spec import Check, ColumnSpec, CustomCheck, RunWindow, SpecError, TableSpec

__all__ = [
    "Change",
    "Check",
    "CheckFailed",
    "ColumnSpec",
    "CustomCheck",
    "Limits",
    "Measure",
    "MissingTarget",
    "NotReady",
    "PublishError",
    "RunWindow",
    "SeedError",
    "Sketch",
    "SpecError",
    "TableSpec",
    "TableStore",
    "TransformError",
    "Watch",
    "asof_join",
    "cube",
    "estimates",
    "funnels",
    "gate_query",
    "gate_table",
    "grouping_sets",
    "materialize",
    "merge_sketches",
    "next_state",
    "overlap_join",
    "plan_change",
    "read_seed",
    "require_passed",
    "require_ready",
    "rollup",
    "run_checks",
    "run_python",
    "run_query",
    "run_rollup",
    "run_seed",
    "sketch",
]
