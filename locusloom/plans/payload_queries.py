"""Registered queries over stored JSON payloads of changing shape."""

from __future__ import annotations

from pyspark.sql import functions as F

from locusloom.functions.payload import payload_fields, with_state
from locusloom.plans.oracles import ORACLES
from locusloom.plans.queries import query
from locusloom.plans.views import view

#: Payloads as several writers leave them: cut off, a list, nested, of other types, absent. Reads alike in both engines.
PAYLOAD = """case event_id % 7
  when 0 then substr(props, 1, length(props) - 1)
  when 1 then '[' || props || ']'
  when 2 then '{"stage": "' || event_type || '", "state": ' || props || ', "done": ' || event_id || '}'
  when 3 then '{"k": "' || event_type || '", "done": null, "ok": true}'
  when 4 then null
  else props
end"""

FIELDS = {"k": ("$.k", "bigint"), "inner_k": ("$.state.k", "bigint"), "stage": ("$.stage", "string"), "done": ("$.done", "bigint")}


def _payloads(spark, sf):
    return view(spark, sf, "events").select("event_id", F.expr(PAYLOAD).alias("payload"))


@query
def payload_states(spark, sf):
    return with_state(_payloads(spark, sf), "payload", FIELDS).drop("payload")


@query
def payload_field_counts(spark, sf):
    return payload_fields(_payloads(spark, sf), "payload")


_PARSED = f"""with payloads as (select event_id, {PAYLOAD} as payload from events),
read as (select event_id, payload, case when json_valid(payload) then payload::json end as j from payloads),
whole as (select *, case when json_type(j) = 'OBJECT' then j end as o from read)
"""

ORACLES["payload_states"] = (
    _PARSED
    + """select event_id,
  case when payload is null then null when j is null then 'broken' when o is null then 'shape' else 'object' end as state,
  try_cast(o->>'$.k' as bigint) as k, try_cast(o->>'$.state.k' as bigint) as inner_k, o->>'$.stage' as stage,
  try_cast(o->>'$.done' as bigint) as done
from whole"""
)

ORACLES["payload_field_counts"] = (
    _PARSED
    + """, fields as (select o, unnest(json_keys(o)) as field from whole where o is not null),
kinds as (select field, json_type(json_extract(o, field)) as t from fields)
select field, case t when 'OBJECT' then 'object' when 'ARRAY' then 'array' when 'VARCHAR' then 'text'
  when 'BOOLEAN' then 'boolean' when 'NULL' then 'null' else 'number' end as kind, count(*) as n
from kinds group by all"""
)
