"""Streaming queries, run as micro-batches over the events table until it is read."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.queries import query
from weft.queries.history import FOLD
from weft.sources import adapter as A
from weft.streaming import live


TIMES = ", ".join(f"{s}_us" for s in live.STATES)


@query(f"with {FOLD} select u, id, last_state, {TIMES}, retry from fold")
def stream_fold(spark, sf):
    return live.fold_activities(live.event_stream(spark, sf)).select("u", "id", "last_state", *[f"{s}_us" for s in live.STATES], "retry")


@query(f"""with {A.EV}, s as (select *, sum(new) over (partition by u order by us, e) as sess from (select *, case when us - lag(us) over (partition by u order by us, e) < 6 * 3600 * 1000000::bigint then 0 else 1 end as new from ev))
select u, min(us) as start_us, max(us) + 6 * 3600 * 1000000::bigint as end_us, count(*) as n from s group by u, sess""")
def stream_session(spark, sf):
    return live.sessions(live.event_stream(spark, sf), live.event_columns(A.table(spark, sf, "events")), "6 hours")


@query(f"with {A.EV} select u, et as name, max(e) as event_id, count(*) as n from ev group by u, et")
def stream_signals(spark, sf):
    return live.signals(live.event_stream(spark, sf))


@query(f"""with {A.EV}, s as (select u, k % 7 as id, e as start_id, us + (k % 24) * 3600000000 as due from ev where et = 'signup'),
f as (select s.u, s.id, start_id, min(ev.e) filter (where ev.us >= due) as fired, min(ev.e) filter (where ev.et = 'click' and ev.k % 7 = s.id) as gone from s left join ev on ev.u = s.u and ev.e > start_id group by s.u, s.id, start_id)
select u, id, start_id, case when fired is null and gone is null then 'started' when gone is null or fired <= gone then 'fired' else 'canceled' end as state, coalesce(least(fired, gone), start_id) as at_id from f""")
def stream_timers(spark, sf):
    return live.timers(live.event_stream(spark, sf))


@query(f"""with {A.EV}, b as (select u, k % 5 as id, e as beat_id, us + 12 * 3600000000::bigint as deadline_us from ev where et = 'view'),
n as (select b.u, b.id, beat_id, deadline_us, min(ev.e) filter (where ev.us > deadline_us) as found_id, min(ev.e) filter (where ev.et in ('view', 'purchase') and ev.k % 5 = b.id) as next_id from b left join ev on ev.u = b.u and ev.e > beat_id group by all)
select u, id, beat_id, deadline_us, found_id from n where found_id is not null and (next_id is null or found_id <= next_id)""")
def stream_heartbeats(spark, sf):
    return live.heartbeats(live.event_stream(spark, sf))


@query(f"""with {A.EV}, x as (select u, k % 5 as id, e, us, et, count(*) filter (where et = 'purchase') over (partition by u, k % 5 order by e) as run from ev where et in ('error', 'purchase')),
y as (select *, row_number() over (partition by u, id, run order by e) as attempt from x where et = 'error')
select u, id, e, attempt, case when attempt <= 3 then us + cast(pow(2, attempt) as bigint) * 1000000 end as retry_us from y""")
def stream_retry(spark, sf):
    return live.retries(live.event_stream(spark, sf))


@query(f"with {A.EV} select u, k % 5 as id, u || '-' || e as task_token, props as input from ev where et = 'signup' and (k // 5) % 4 <> 3 and u % 3 = 1")
def stream_activity_polls(spark, sf):
    return live.activity_polls(live.event_stream(spark, sf), "list-1")


@query(f"with {A.EV} select * from (select u, max(e) filter (where et = 'purchase') as previous_decision_id, max(e) as last_event_id, count(*) as n_events from ev group by u) where last_event_id > coalesce(previous_decision_id, -1)")
def stream_decision_polls(spark, sf):
    return live.decision_polls(live.event_stream(spark, sf))


@query(f"""with {A.EV} select u, e as scheduled_id, case et when 'purchase' then 'ActivityTaskCompleted' when 'error' then 'ActivityTaskFailed' when 'click' then 'ActivityTaskCanceled' else 'DecisionTaskCompleted' end as event,
  '{{"' || case et when 'purchase' then 'result' when 'error' then 'reason' else 'details' end || '":' || to_json(props) || '}}' as attrs from ev where et <> 'view'""")
def stream_sink(spark, sf):
    """Responses of workers, one of which is a heartbeat, appended as events."""
    op = A.mapped(F.col("et"), {"purchase": "complete", "error": "fail", "click": "cancel", "signup": "decide", "view": "heartbeat"})
    return live.sink(live.event_stream(spark, sf).select("u", "e", op.alias("op"), F.col("props").alias("payload")))
