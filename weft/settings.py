"""Settings: the environment beats a module, a module the defaults."""

from __future__ import annotations

import importlib
import os
from collections.abc import Mapping

#: Default settings and the types that they are read as.
DEFAULTS: dict[str, tuple[type, object]] = {
    "WORKFLOW_DEFAULT_TASK_LIST": (str, "default"),
    "WORKFLOW_DEFAULT_VERSION": (str, "default"),
    "WORKFLOW_DEFAULT_EXECUTION_TIME": (str, "3600"),
    "WORKFLOW_DEFAULT_DECISION_TASK_TIMEOUT": (str, "300"),
    "ACTIVITY_DEFAULT_TASK_LIST": (str, "default"),
    "ACTIVITY_DEFAULT_VERSION": (str, "default"),
    "ACTIVITY_START_TO_CLOSE_TIMEOUT": (str, "300"),
    "ACTIVITY_SCHEDULE_TO_CLOSE_TIMEOUT": (str, "300"),
    "ACTIVITY_SCHEDULE_TO_START_TIMEOUT": (str, "300"),
    "ACTIVITY_HEARTBEAT_TIMEOUT": (str, "300"),
    "STEP_BUCKET": (str, "step_bucket"),
    "METROLOGY_BUCKET": (str, "metrology_bucket"),
}


def load(module: str | Mapping | None = None, env: Mapping[str, str] | None = None, defaults: Mapping = DEFAULTS) -> dict[str, object]:
    """All settings, in order of their names, each cast to its type.

    ``module`` is a mapping or the import path of a module with upper-case names.
    """
    env = os.environ if env is None else env
    own = vars(importlib.import_module(module)) if isinstance(module, str) else module or {}
    return {name: kind(env[name] if name in env else own.get(name, value)) for name, (kind, value) in sorted(defaults.items())}
