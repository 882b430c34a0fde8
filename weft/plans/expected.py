"""What the plans of :mod:`weft.plans.cases` give, as JSON: worked out from the rules of composition, by hand."""

CASES: list[tuple[str, str]] = [
    ('chains', '[[3, 6], [null, 2], [2, "FINISHED"], "ValueError: send_result needs break_on_failure", [1, [0, 1]]]'),
    ('child workflows', '["completed", [3, 3, "w-bad: Workflow execution failed: on purpose"]]'),
    ('continue as new', '["completed", 4]'),
    ('dispatch', '[12, "plan.add", "DispatchError", 3, 4, "DispatchError: cannot dispatch \'y.add\'", "plan.counted", "LookupError: no task \'plan.counted\'"]'),
    ('dry run', '[["task", "plan.fail"], ["task", "plan.fail"], ["task", "plan.flaky"], ["task", "plan.add"], ["task", "plan.add"]]'),
    ('failures', '["completed", [["CANCELLED", "CANCELLED"], "third time", [3, 7]]]'),
    ('futures', '["CANCELLED", "FINISHED", true, false, [true, false], "Blocked: PENDING", [1, 2]]'),
    ('groups', '[[3, [3], 4], "TaskFailed: plan.fail: ZeroDivisionError: no", ["TaskFailed", "TaskFailed"], "AggregateException: TaskFailed: plan.fail: ZeroDivisionError: no; AggregateException: TaskFailed: plan.fail: ZeroDivisionError: no", []]'),
    ('hooks', '[[["completed", "ok"], ["before_replay", "on_completed", "after_replay", "after_closed"]], [["failed", "Cannot replay the workflow: KeyError(\'broken\')"], ["before_replay", "on_failure Cannot replay the workflow: KeyError(\'broken\')", "after_replay", "after_closed"]], [["failed", "Workflow execution error in plan.fail: \\"ZeroDivisionError: no\\""], ["before_replay", "on_failure Workflow execution error in plan.fail: \\"ZeroDivisionError: no\\"", "after_replay", "after_closed"]], [["canceled", null], ["before_replay", "on_canceled", "after_replay", "after_closed"]]]'),
    ('interpreter', '[5, true, "ProgramError: ZeroDivisionError: division by zero", "ProgramError: no result after 0.5 s"]'),
    ('markers', '["completed", [[["m", 2]], [["m", 1], ["m", 2]], 2, null]]'),
    ('middleware', '[10, [["plan.counted", 4], ["after", 4]], ["completed", ["w", "plan.context"]]]'),
    ('program', '["a-1", "TypeError: missing a required argument: \'template\'", "ProgramError: status 1: "]'),
    ('signals', '[["completed", ["PENDING", [7], [7]]], ["open", null]]'),
    ('steps', '[[{"forced": false, "reasons": [], "status": "scheduled", "step": "a.new"}, {"forced": false, "reasons": [], "status": "completed", "step": "a.new"}, {"forced": false, "reasons": ["Step was already played"], "status": "skipped", "step": "a.done"}, {"forced": true, "reasons": ["not today"], "status": "skipped", "step": "b.x"}, {"forced": true, "reasons": ["asked for"], "status": "scheduled", "step": "b.c"}, {"forced": true, "reasons": ["asked for"], "status": "completed", "step": "b.c"}, {"forced": true, "reasons": ["Dep of a.new"], "status": "scheduled", "step": "d.e"}, {"forced": true, "reasons": ["Dep of a.new"], "status": "completed", "step": "d.e"}, {"forced": false, "reasons": [], "status": "scheduled", "step": "a.bad"}], ["step.a.new"], ["a.done", "a.new", "b.c", "d.e"]]'),
    ('submit', '["failed", "Cannot replay the workflow: TypeError(can\'t submit int)"]'),
    ('tags', '[[["t1", "t2"], "main", "w"], [["own"], "own list", "w"], [["own"], "given", "w"]]'),
    ('timers', '["completed", ["FINISHED", "CANCELLED", "FINISHED", "a: TIMER_ID_UNKNOWN"]]'),
]
