"""DuckDB oracle SQL for every registered query that SQL can express.

The views ``events`` etc. are the driver's parquet tables. ``SILVER_SQL``
is the heartbeat mapping of ``sources.fixtures`` written as plain SQL; the
RAW layout is its nesting, so RAW-level queries are checked on the flat form
(``flatten(nest(x)) == x``).
"""

from __future__ import annotations

SILVER_SQL = """
select
 case when event_id % 97 = 0 then null else concat('cust-', cast(user_id % 40 as varchar)) end as customerId,
 case when event_id % 89 = 0 then null else concat('content-', cast(event_id % 7 as varchar)) end as contentId,
 case when event_id % 83 = 0 then null else concat('client-', cast(user_id as varchar)) end as clientId,
 cast(ts as date) as eventDate,
 1704067200000 + event_id * 1000 as serverTimestamp,
 1704067200000 + event_id * 1000 - (event_id % 500) as agentTimestamp,
 case when event_id % 31 = 0 then null else cast(event_id % 7 - 1 as int) end as bufferings,
 cast((event_id * 37) % 5000 - 100 as int) as bufferingTime,
 cast(event_id % 9 as int) as src_requests,
 case when event_id % 29 = 0 then null else cast(event_id % 5 as double) / 2 end as src_responses,
 (event_id * 131) % 100000 as src_requestedData,
 case when event_id % 11 = 0 then 0 else (event_id * 131) % 100000 end as src_receivedData,
 cast(event_id % 6 as int) as p2p_requests,
 cast(event_id % 4 as double) as p2p_responses,
 (event_id * 173) % 80000 as p2p_requestedData,
 case when event_id % 13 = 0 then null when event_id % 11 = 0 then 0
      else (event_id * 173) % 80000 end as p2p_receivedData,
 case when event_id % 2 = 0 then event_id % 10 end as quality_240p,
 case when event_id % 3 = 0 then event_id % 10 end as quality_360p,
 case when event_id % 5 = 0 then event_id % 10 end as quality_480p,
 case when event_id % 7 = 0 then event_id % 10 end as quality_720p,
 case when event_id % 4 = 1 then event_id % 10 end as quality_1080p
from events
"""

SILVER_COLS = (
    "customerId, contentId, clientId, eventDate, serverTimestamp, agentTimestamp, "
    "bufferings, bufferingTime, src_requests, src_responses, src_requestedData, "
    "src_receivedData, p2p_requests, p2p_responses, p2p_requestedData, p2p_receivedData, "
    "quality_240p, quality_360p, quality_480p, quality_720p, quality_1080p"
)

TIE_COLS = ", ".join(f"{c.strip()} asc nulls first" for c in SILVER_COLS.split(",")[4:])

IDS_OK = "customerId is not null and contentId is not null and clientId is not null"

REQUIRED_FAILED = (
    "(customerId is null or contentId is null or clientId is null or eventDate is null)"
)
BUFFERINGS_FAILED = "(bufferings < 0)"
RESPONSES_FAILED = "(src_responses < 0 or src_responses > 1)"
VALID = (
    "(customerId is not null and contentId is not null and clientId is not null "
    "and eventDate is not null and bufferings >= 0 and src_responses between 0 and 1)"
)

KEYS = "customerId, contentId, clientId, eventDate"


def dedupe_first(src: str) -> str:
    return f"""
select {SILVER_COLS} from (
  select *, row_number() over (
    partition by {KEYS}
    order by serverTimestamp asc nulls first, agentTimestamp asc nulls first) as rn
  from {src}) where rn = 1
"""


TOTAL = "(coalesce(src_receivedData, 0) + coalesce(p2p_receivedData, 0))"

QOS = f"""
select *,
  {TOTAL} as total_received_data,
  case when {TOTAL} > 0 then bufferingTime / {TOTAL} else 0.0 end as buffering_ratio,
  case when {TOTAL} > 0 then p2p_receivedData / {TOTAL} else 0.0 end as p2p_share,
  greatest(
    case when quality_1080p is not null then '1080p' end,
    case when quality_720p is not null then '720p' end,
    case when quality_480p is not null then '480p' end,
    case when quality_360p is not null then '360p' end,
    case when quality_240p is not null then '240p' end) as dominant_quality
from {{src}}
"""


def gold(src: str, key: str) -> str:
    return f"""
select {key}, eventDate,
  cast(sum(bufferingTime) as bigint) as total_buffering_time,
  cast(sum(bufferings) as bigint) as total_bufferings,
  cast(sum(total_received_data) as bigint) as total_received_data,
  round(avg(buffering_ratio), 9) as avg_buffering_ratio,
  round(avg(p2p_share), 9) as avg_p2p_share,
  count(*) as event_count,
  max(dominant_quality) as max_quality,
  round(case when sum(total_received_data) > 0
             then sum(bufferingTime) / sum(total_received_data) else 0.0 end, 9) as buffering_ratio
from ({QOS.format(src=src)}) as q group by {key}, eventDate
"""


def dq(src: str) -> str:
    return f"""
, c as (
  select count(*) as total,
    count(*) filter (where {REQUIRED_FAILED}) as f1,
    count(*) filter (where {BUFFERINGS_FAILED}) as f2,
    count(*) filter (where {RESPONSES_FAILED}) as f3
  from {src})
select 'schema_validation' as rule_name, cast(1 as bigint) as passed_count,
       cast(0 as bigint) as failed_count, '[]' as missing_cols, '[]' as wrong_type_cols,
       '[]' as unexpected_cols from c
union all select 'required_fields_not_null', total - f1, f1, null, null, null from c
union all select 'bufferings_non_negative', total - f2, f2, null, null, null from c
union all select 'responses_between_0_and_1', total - f3, f3, null, null, null from c
"""


CLAMPED = """
select * replace (
  case when bufferings < 0 then 0 else bufferings end as bufferings,
  case when bufferingTime < 0 then 0 else bufferingTime end as bufferingTime)
from {src}
"""

S = f"s as ({SILVER_SQL})"
BRONZE = f"b as ({dedupe_first(f'(select * from s where {IDS_OK})')})"
VALID_B = f"v as (select * from b where {VALID})"
SILVER_E2E = f"sv as ({dedupe_first('(' + CLAMPED.format(src='v') + ')')})"

MS = "(epoch_us(ts) // 1000)"

TELEMETRY_SQL = f"""
select event_id as seq,
  case event_type when 'click' then 'buffering_start' when 'view' then 'buffering_end'
    when 'purchase' then 'quality_change' when 'signup' then 'playback_start'
    when 'error' then 'error' end as event_type,
  value as playback_position,
  case when event_type = 'purchase' then cast(event_id % 4 as int) end as level_index,
  case when event_type = 'purchase' then [240, 360, 480, 720][event_id % 4 + 1] end as height,
  case when event_type = 'purchase'
    then cast([320000, 578000, 1000000, 1900000][event_id % 4 + 1] as bigint) end as bitrate,
  case when event_type = 'view' then {MS} - event_id % 5000 end as started_at,
  case when event_type = 'view' then {MS} end as ended_at,
  case when event_type = 'view' then event_id % 5000 end as duration_ms,
  'sess-' || cast(user_id as varchar) as sessionId,
  'user-' || cast(user_id % 40 as varchar) as viewerId,
  'evt-' || cast(event_id as varchar) as eventId,
  {MS} as "timestamp"
from events
"""

# JSON lines built and checked with DuckDB's own JSON functions, with the
# same injected faults as ``sources.fixtures.telemetry_json_from_events``.
TELEMETRY_LINES = f"""
t as ({TELEMETRY_SQL}),
j as (
  select seq, json_object(
    'event_type', event_type, 'playback_position', playback_position,
    'quality', case when level_index is not null then
        json_object('level_index', level_index, 'height', height,
          'bitrate', case when seq % 3 = 0 and seq % 61 <> 0 then bitrate + 0.75e0 else bitrate end,
          'codec', 'avc1') end,
    'buffering', case when ended_at is not null then
        json_object('started_at', started_at, 'ended_at', ended_at, 'duration_ms', duration_ms)
      when seq % 61 = 0 then to_json('n/a') end,
    'sessionId', case when seq % 53 <> 0 then sessionId end,
    'viewerId', viewerId, 'eventId', eventId,
    'timestamp', case when seq % 47 = 0 then to_json('n/a') else to_json("timestamp") end,
    'agent', 'web')::varchar as line
  from t),
l as (select seq, case when seq % 101 = 0 then left(line, 40) else line end as line from j),
c as (
  select seq, line,
    case when not json_valid(line) then 'malformed'
      when line->>'event_type' is null then 'missing:event_type'
      when line->>'sessionId' is null then 'missing:sessionId'
      when line->>'viewerId' is null then 'missing:viewerId'
      when line->>'eventId' is null then 'missing:eventId'
      when line->>'timestamp' is null then 'missing:timestamp'
      when try_cast(line->>'timestamp' as bigint) is null then 'bad_type:timestamp'
      when json_type(line, '$.buffering') not in ('OBJECT', 'NULL') then 'bad_type:payload'
    end as reason
  from l)
"""



def intervals(ms: str) -> str:
    return f"""
with m as (
  select 'sess-' || cast(user_id as varchar) as sessionId, {ms} as ms, event_id, event_type
  from events where event_type in ('click', 'view')),
o as (
  select *, lag(event_type) over w as prev_type, lag(ms) over w as prev_ms from m
  window w as (partition by sessionId order by ms, event_id))
select sessionId, prev_ms as started_at, ms as ended_at, ms - prev_ms as duration_ms
from o where event_type = 'view' and prev_type = 'click'
"""


ORACLE_SQL = {
    "viewer_qos": f"with {S} {gold('s', 'customerId')}",
    "content_qos": f"with {S} {gold('s', 'contentId')}",
    "qos_fields": f"""
with {S}, q as ({QOS.format(src='s')})
select serverTimestamp, customerId, total_received_data,
  buffering_ratio, p2p_share from q
""",
    "qos_dominant_quality": f"""
with {S}, q as ({QOS.format(src='s')}) select serverTimestamp, dominant_quality from q
""",
    "silver_clamp": f"""
with {S}, c as ({CLAMPED.format(src='s')})
select serverTimestamp, bufferings, bufferingTime from c
""",
    "silver_quality_tiers": f"""
with {S} select serverTimestamp, quality_240p, quality_360p, quality_480p, quality_720p,
  quality_1080p from s
""",
    "silver_flatten": f"with {S} select {SILVER_COLS} from s",
    "silver_dedupe_first": f"with {S} {dedupe_first('s')}",
    "gold_both": f"""
with {S} select 'customerId' as level, g.* rename (customerId as key) from ({gold('s', 'customerId')}) g
union all select 'contentId' as level, g.* rename (contentId as key) from ({gold('s', 'contentId')}) g
""",
    "silver_dedupe_ties": f"""
with {S}, same as (select * replace (1704067200000 as serverTimestamp, 1704067200000 as agentTimestamp) from s)
select {SILVER_COLS} from (
  select *, row_number() over (partition by {KEYS} order by {TIE_COLS}) as rn from same) where rn = 1
""",
    "dq_results_schema_drift": f"""
with {S} {dq('s')}""".replace(
        "cast(1 as bigint) as passed_count,\n       cast(0 as bigint) as failed_count, "
        "'[]' as missing_cols, '[]' as wrong_type_cols,\n       '[]' as unexpected_cols",
        "cast(0 as bigint) as passed_count, cast(2 as bigint) as failed_count, "
        "'[''timestampInfo'']' as missing_cols, '[''eventDate'']' as wrong_type_cols, "
        "'[''newField'']' as unexpected_cols"),
    "silver_dedupe_keys": f"with {S} select distinct {KEYS} from s where {VALID}",
    "silver_layer": f"""
with {S}, v as (select * from s where {VALID})
{dedupe_first('(' + CLAMPED.format(src='v') + ')')}
""",
    "bronze_minimal_validation": f"with {S} select {SILVER_COLS} from s where {IDS_OK}",
    "bronze_dedupe_keys": f"with {S} select distinct {KEYS} from s where {IDS_OK}",
    "bronze_layer": f"with {S}, {BRONZE} select {SILVER_COLS} from b",
    "dq_results": f"with {S} {dq('s')}",
    "valid_rows": f"with {S} select {SILVER_COLS} from s where {VALID}",
    "dq_silent_drops": f"""
with {S}
select count(*) as total_rows,
  count(*) filter (where coalesce({VALID}, false)) as valid_rows,
  count(*) filter (where coalesce({REQUIRED_FAILED} or {BUFFERINGS_FAILED} or {RESPONSES_FAILED}, false))
    as rule_failed_rows,
  count(*) filter (where not coalesce({REQUIRED_FAILED} or {BUFFERINGS_FAILED} or {RESPONSES_FAILED}, false)
                     and not coalesce({VALID}, false)) as silent_drops
from s
""",
    "viewer_qos_end_to_end": f"with {S}, {BRONZE}, {VALID_B}, {SILVER_E2E} {gold('sv', 'customerId')}",
    "content_qos_end_to_end": f"with {S}, {BRONZE}, {VALID_B}, {SILVER_E2E} {gold('sv', 'contentId')}",
    "dq_results_end_to_end": f"with {S}, {BRONZE} {dq('b')}",
    "telemetry_flat": TELEMETRY_SQL,
    "telemetry_contract": f"""
with {TELEMETRY_LINES}
select seq, line->>'event_type' as event_type,
  cast(line->>'playback_position' as double) as playback_position,
  cast(line->'quality'->>'level_index' as int) as level_index,
  cast(line->'quality'->>'height' as int) as height,
  cast(trunc(cast(line->'quality'->>'bitrate' as double)) as bigint) as bitrate,
  cast(line->'buffering'->>'started_at' as bigint) as started_at,
  cast(line->'buffering'->>'ended_at' as bigint) as ended_at,
  cast(line->'buffering'->>'duration_ms' as bigint) as duration_ms,
  line->>'sessionId' as sessionId, line->>'viewerId' as viewerId, line->>'eventId' as eventId,
  cast(line->>'timestamp' as bigint) as "timestamp"
from c where reason is null
""",
    "telemetry_quarantine": f"""
with {TELEMETRY_LINES}
select reason, count(*) as n from c where reason is not null group by reason
""",
    "buffering_intervals": intervals(MS),
    "buffering_intervals_ties": intervals(f"({MS} // 86400000 * 86400000)"),
}
# the same lines, but out of logs that grow between the runs of a stream
ORACLE_SQL["telemetry_tail"] = f"select * exclude (seq) from ({ORACLE_SQL['telemetry_contract']})"
ORACLE_SQL["buffering_intervals_stream"] = ORACLE_SQL["buffering_intervals"]
ORACLE_SQL["dq_results_dotted_names"] = ORACLE_SQL["dq_results_end_to_end"].replace(
    "'[]' as unexpected_cols", "'[''player.extra'', ''odd.struct'']' as unexpected_cols")
ORACLE_SQL["viewer_qos_incremental"] = ORACLE_SQL["viewer_qos_end_to_end"]
ORACLE_SQL["content_qos_incremental"] = ORACLE_SQL["content_qos_end_to_end"]
