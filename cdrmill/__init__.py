"""cdrmill: call-record mediation and enrichment on Spark.

The user-facing API, imported lazily::

    from cdrmill import get_session, JobConfig, MasterPaths, run_med, run_ict
    from cdrmill import run_hold_reprocess, Clock
"""

from __future__ import annotations

import importlib

_API = {
    "get_session": "cdrmill.session",
    "Clock": "cdrmill.operators.mapping",
    "JobConfig": "cdrmill.plans.jobs",
    "MasterPaths": "cdrmill.plans.jobs",
    "run_med": "cdrmill.plans.jobs",
    "run_ict": "cdrmill.plans.jobs",
    "run_hold_reprocess": "cdrmill.plans.jobs",
    "IncrementalConfig": "cdrmill.streaming.incremental",
    "run_med_incremental": "cdrmill.streaming.incremental",
    "start_med_stream": "cdrmill.streaming.incremental",
}

__all__ = sorted(_API)


def __getattr__(name: str):
    if name in _API:
        return getattr(importlib.import_module(_API[name]), name)
    raise AttributeError(name)
