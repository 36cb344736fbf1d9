"""strata: a Spark data-vault load — sources, vault, checks, marts, versions, file forensics.

The most used entry points, importable from the package root::

    from strata import get_session, build_vault, build_marts, run_checks, run_load
"""

from strata.operators.checks import run_checks
from strata.operators.marts import build_marts
from strata.operators.vault import build_vault
from strata.plans.flow import inputs_from_dir, run_from_dir, run_load
from strata.session import get_session
from strata.sinks.versions import publish, read_as_of

__all__ = [
    "build_marts", "build_vault", "get_session", "inputs_from_dir", "publish", "read_as_of",
    "run_checks", "run_from_dir", "run_load",
]
