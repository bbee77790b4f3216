"""Fixture views: the reference's input tables, derived from the driver's
``events``, ``customer`` and ``nation`` tables (see FIXTURES.md §2).

Each text runs unchanged in Spark SQL and DuckDB, so the Spark queries and the
DuckDB oracle read identical inputs.
"""

from __future__ import annotations

GAMELOGS_SQL = """
select user_id as oidaccount, ts as time,
 case when event_type='view' then 'Login'
  when event_type='purchase' then 'Shop:Buy'
  when event_type='click' then 'ArenaEnd'
  when event_type='signup' then case when event_id%2=0 then 'MonsterRating' else 'SkillRating' end
  else case event_id%5 when 0 then 'Transfer' when 1 then 'Cube:Make' when 2 then 'Jewel:Gain'
   when 3 then 'Jewel:Spend' else 'Arena:HardMatch' end end as command,
 concat('{"mysticorblevel":',k%5,
  ',"paytype":"',case k%3 when 0 then 'Cash' when 1 then 'Jewel' else 'Gold' end,
  '","productid":',1000+k%10,',"price":',100+m%900,
  case when event_id%17=0 then '' when k%4=0 then ',"isaiarena":true' else ',"isaiarena":false' end,
  ',"iswin":',case when m%2=0 then 'true' else 'false' end,
  ',"matchtype":"',case when k%5<3 then 'ELO' else 'FRIENDLY' end,
  '","arenalevel":',k%7,',"matchedtier":',k%6,
  ',"turncount":',1+k%20,',"totalplaytime":',30+m%300,
  ',"monsterid":',1+k%12,',"skillid":',1+k%12,
  ',"cubegrade":"G',k%4,'","useJewel":',case when m%3=0 then 'true' else 'false' end,
  ',"reason":"r',k%3,'","delta":',m%50,
  ',"difficulttype":"d',k%3,'","hitbonuscount":',k%4,
  ',"myinfo":{"arenalevel":',k%7,',"cardweight":',60+m%40,',"arenapoint":',1800+m%900,
  '},"opinfo":{"cardweight":',60+m%37,',"arenapoint":',1800+m%700,'}}') as payload
from (
 select event_id, user_id, ts, event_type, (event_id*7919)%10007 as m,
  cast(regexp_extract(props,'([0-9]+)',1) as int) as k
 from (
  select event_id, user_id, cast(ts as timestamp) as ts, event_type, props from events
  union all
  select 10000000+event_id, user_id, timestamp '2024-01-17 00:00:00', event_type, props
  from events where event_id<40
 ) e0
) e1
"""

RDS_FOOTPRINT_SQL = """
select u as oidaccount,
 timestamp '2024-01-01 00:00:00' + interval '1' day * cast(u%30 as int)
  + interval '1' second * cast((u*7919)%10007%2*3600 as int) as created
from (select distinct user_id as u from events) x
"""

RDS_STATICACCOUNT_SQL = """
select c_custkey as oidaccount, case when c_custkey%5=0 then null else n_name end as country
from customer join nation on c_nationkey=n_nationkey
where c_custkey%13<>0
"""

CRM_CCU_SQL = """
select date_trunc('minute', cast(ts as timestamp)) as time,
 cast(sum(cast(regexp_extract(props,'([0-9]+)',1) as int)) as int) as ccu
from events group by date_trunc('minute', cast(ts as timestamp))
union all
select timestamp '2024-01-17 00:00:00' as time, 5000 as ccu
"""

SERVER_STATUS_SQL = """
select concat('ServerDesc:',user_id%20) as hashkey,
 timestamp '2024-01-16 12:00:00' + interval '1' second * cast(sum(event_id)%400 - 200 as int) as dtmUpdated,
 max_by(cast(regexp_extract(props,'([0-9]+)',1) as int), event_id) as numCCU
from events group by user_id%20
"""

REPLAY_SQL = """
select concat('r',event_id) as uniqueKey,
 concat(replace(replace(substr(cast(cast(ts as timestamp) as string),1,13),'-',''),' ',''),'00') as dateHour,
 cast(regexp_extract(props,'([0-9]+)',1) as int)%7 as arena,
 cast(1000+(event_id*7919)%1000 as int) as score
from events
"""

# Heartbeats as a stream of status updates: every event is a heartbeat of
# server ``user_id % 20`` (same servers as ``server_status``).
SERVER_HEARTBEATS_SQL = """
select concat('ServerDesc:',user_id%20) as hashkey, cast(ts as timestamp) as dtmUpdated,
 cast(regexp_extract(props,'([0-9]+)',1) as int) as numCCU
from events
"""

# Status hashes as the store keeps them: field and text value, with an unknown
# field, stamps in two forms and values that do not parse.
TEXT_FIELDS = ("UUID", "HostName", "IP", "Revision", "ResourceRev", "MatchmakerVersion", "MatchmakerRevision",
               "MatchmakerResourceRevision", "MatchmakerIP", "PublicIP", "PublicUrl")
STATUS_HASHES_SQL = """
select concat('ServerDesc:',s) as hashkey, field, value from (
 select s, 'numCCU' as field, case when s=7 then 'many' else cast(n as string) end as value from servers
 union all select s, 'dtmUpdated', case when s=3 then 'rubbish'
   when s%2=0 then '1/16/2024 11:59:58 AM' else '2024-01-16 11:58:00' end from servers
 union all select s, 'IsActive', case when s%3=0 then 'True' else 'false' end from servers where s<>5
 union all select s, 'numPort', cast(7000+s as string) from servers
 union all select s, 'Version', concat('1.',s) from servers
 union all select s, 'dtmStarted', case when s=11 then '' when s%3=0 then '1/5/2024 1:02:03 PM' else '2024-01-05 13:02:03' end from servers
 union all select s, 'numMaxUser', case when s=9 then '9e' when s%4=0 then ' 500 ' else '1000' end from servers
 union all select s, 'MatchmakerPort', case when s=2 then '99999999999' else cast(8000+s as string) end from servers
""" + "\n".join(f" union all select s, '{f}', concat('{f.lower()}-',s) from servers" for f in TEXT_FIELDS) + """
 union all select s, 'Colour', 'blue' from servers) f
"""
SERVERS_SQL = "select user_id%20 as s, count(*) as n from events group by user_id%20"

# Views in dependency order (all read only the driver's base tables).
VIEWS: dict[str, str] = {
    "gamelogs": GAMELOGS_SQL,
    "rds_footprint": RDS_FOOTPRINT_SQL,
    "rds_staticaccount": RDS_STATICACCOUNT_SQL,
    "crm_ccu": CRM_CCU_SQL,
    "server_status": SERVER_STATUS_SQL,
    "replay": REPLAY_SQL,
    "server_heartbeats": SERVER_HEARTBEATS_SQL,
    "servers": SERVERS_SQL,
    "status_hashes": STATUS_HASHES_SQL,
}

BASE_TABLES = ("events", "customer", "nation")


def with_views(*names: str) -> str:
    """``WITH`` prefix defining the named fixture views, for oracle SQL."""
    parts = [f"{n} AS ({VIEWS[n].strip()})" for n in names]
    return "WITH " + ",\n".join(parts) + "\n"
