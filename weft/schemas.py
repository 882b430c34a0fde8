"""Fixed vocabulary of the event model: types, states, legal transitions, limits."""

from __future__ import annotations

#: Event types in the order in which a name is tried for them.
EVENT_TYPES = ["ActivityTask", "DecisionTask", "ChildWorkflowExecution", "Marker", "Timer", "ExternalWorkflow", "WorkflowExecution"]

#: All event names of a history.
EVENT_NAMES = [
    "WorkflowExecutionStarted", "WorkflowExecutionCompleted", "WorkflowExecutionFailed", "WorkflowExecutionTimedOut",
    "WorkflowExecutionTerminated", "WorkflowExecutionSignaled", "WorkflowExecutionCancelRequested",
    "WorkflowExecutionContinuedAsNew", "WorkflowExecutionCanceled", "CancelWorkflowExecutionFailed",
    "ActivityTaskScheduled", "ActivityTaskStarted", "ActivityTaskCompleted", "ActivityTaskFailed", "ActivityTaskTimedOut",
    "ActivityTaskCancelRequested", "ActivityTaskCanceled", "ScheduleActivityTaskFailed", "RequestCancelActivityTaskFailed",
    "DecisionTaskScheduled", "DecisionTaskStarted", "DecisionTaskCompleted", "DecisionTaskTimedOut",
    "StartChildWorkflowExecutionInitiated", "StartChildWorkflowExecutionFailed", "ChildWorkflowExecutionStarted",
    "ChildWorkflowExecutionCompleted", "ChildWorkflowExecutionFailed", "ChildWorkflowExecutionTimedOut",
    "ChildWorkflowExecutionCanceled", "ChildWorkflowExecutionTerminated", "SignalExternalWorkflowExecutionInitiated",
    "SignalExternalWorkflowExecutionFailed", "ExternalWorkflowExecutionSignaled",
    "RequestCancelExternalWorkflowExecutionInitiated", "RequestCancelExternalWorkflowExecutionFailed",
    "ExternalWorkflowExecutionCancelRequested", "MarkerRecorded", "RecordMarkerFailed", "TimerStarted", "TimerFired",
    "TimerCanceled", "StartTimerFailed", "CancelTimerFailed",
]

#: First state of each type.
INITIAL = {
    "WorkflowExecution": "started", "ChildWorkflowExecution": "start_initiated", "ExternalWorkflowExecution": "signal_execution_initiated",
    "ActivityTask": "scheduled", "DecisionTask": "scheduled", "Timer": "started", "Marker": "recorded",
}

#: Legal transitions, type -> from -> to.
TRANSITIONS = {
    "WorkflowExecution": {
        "started": ["signaled", "failed", "timed_out", "canceled", "terminated", "continued_as_new", "completed"],
        "signaled": ["signaled", "started", "continued_as_new"],
        "cancel_requested": ["canceled"],
    },
    "ChildWorkflowExecution": {
        "start_initiated": ["start_failed", "started"],
        "start_failed": ["failed"],
        "started": ["canceled", "failed", "timed_out", "terminated"],
    },
    "ExternalWorkflowExecution": {
        "signal_execution_initiated": ["signal_execution_failed", "execution_signaled"],
        "request_cancel_execution_initiated": ["request_cancel_execution_failed"],
        "execution_cancel_requested": ["request_cancel_execution_failed"],
    },
    "ActivityTask": {
        "scheduled": ["schedule_failed", "canceled", "timed_out", "started"],
        "schedule_failed": ["scheduled", "timed_out"],
        "started": ["canceled", "failed", "timed_out", "completed"],
        "failed": ["scheduled", "timed_out"],
        "timed_out": ["scheduled"],
        "canceled": ["scheduled", "timed_out"],
        "cancel_requested": ["canceled", "request_cancel_failed", "timed_out"],
        "request_cancel_failed": ["scheduled", "timed_out"],
    },
    "DecisionTask": {"scheduled": ["started"], "started": ["timed_out", "completed"], "timed_out": ["scheduled"]},
    "Timer": {"started": ["canceled", "fired"], "start_failed": ["canceled"], "fired": ["canceled"], "canceled": ["cancel_failed", "fired"]},
    "Marker": {},
}

#: Characters that fit a field; longer values are kept outside.
LIMITS = {"reason": 256, "details": 32768, "execution_context": 32768, "input": 32768, "result": 32768, "control": 32768, "heartbeat": 2048, "identity": 256}
#: Characters that can be kept outside.
MAX_EXTERNAL = 5_000_000
#: Prefix of the reference that stands for a value that is kept outside.
EXTERNAL_PREFIX = "weft+blob:"
#: Batch limits of a decision response.
MAX_DECISIONS, MAX_REQUEST, REQUEST_MARGIN, MAX_OPEN = 100, 1_000_000, 37_000, 1000
#: Default look-back of a catalogue query, in days.
LOOK_BACK_DAYS = 457

#: Future state and exception for each kind and event state.
FUTURES = {
    "activity": {"scheduled": ("PENDING", None), "started": ("RUNNING", None), "completed": ("FINISHED", None), "failed": ("FINISHED", "TaskFailed"), "timed_out": ("FINISHED", "TimeoutError"), "canceled": ("CANCELLED", None), "schedule_failed": (None, None)},
    "child": {"start_initiated": ("PENDING", None), "started": ("RUNNING", None), "completed": ("FINISHED", None), "failed": ("FINISHED", "TaskFailed"), "timed_out": ("FINISHED", "TimeoutError"), "canceled": ("FINISHED", "TaskCanceled"), "terminated": ("FINISHED", "TaskTerminated"), "start_failed": ("FINISHED", "TaskFailed")},
    "marker": {"recorded": ("FINISHED", None), "record_failed": ("FINISHED", "TaskFailed")},
    "signal": {"signaled": ("FINISHED", None)},
    "external": {"signal_execution_initiated": ("RUNNING", None), "execution_signaled": ("FINISHED", None), "signal_execution_failed": ("FINISHED", "TaskFailed")},
    "timer": {"started": ("RUNNING", None), "fired": ("FINISHED", None), "canceled": ("CANCELLED", None), "start_failed": ("FINISHED", "TaskFailed"), "cancel_failed": ("FINISHED", "TaskFailed")},
}
