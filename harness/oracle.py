"""The expected results in DuckDB SQL, over the same tables and adapter rules."""

from __future__ import annotations

from trailmeter import constants as C


def _list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _with(*parts: str) -> str:
    return "with " + ",\n".join(parts) + "\n"


# --- adapters ----------------------------------------------------------------

CLICKS = f"""clicks as (
  select strftime(date_trunc('month', l_shipdate), '%Y-%m-%d') as dt,
    (['99', '237', '315', '122', '1', null])[l_suppkey % 6 + 1] as att,
    cast(l_linenumber as varchar) as grp,
    if(l_partkey % 3 = 0, '8', '5') as campaign,
    if(l_returnflag = 'A', '', cast(l_partkey as varchar)) as placement,
    case when l_partkey % 5 = 0 then '0' when l_partkey % 7 = 0 then ''
      else cast(l_linenumber as varchar) end as last_pos,
    if(l_linestatus = 'F', '2', '3') as loc,
    case when l_partkey % 4 = 0 then '1' when l_partkey % 9 = 0 then ''
      when l_partkey % 11 = 0 then null when l_partkey % 13 = 0 then '01' else '0' end as billed_flag,
    if(l_suppkey % 9 = 0, '', cast(l_linenumber as varchar)) as event_type,
    cast(l_orderkey as varchar) as sid, l_extendedprice as price,
    (['RTB_all', 'rtbnc', 'GDT'])[l_orderkey % 3 + 1] as part,
    if(l_linestatus = 'F', 'CPC', 'cpm') as billing,
    if(l_partkey % 6 = 0, '', l_orderkey || '-' || l_linenumber) as click_id,
    if(l_partkey % 2 = 0, cast(l_partkey as varchar), cast(l_suppkey as varchar)) as item,
    l_returnflag as flag
  from lineitem)"""

PLAY = f"""case
    when grp in ({_list(C.OWN_GROUPS)}) and not (att in ({_list(C.SHARED_TYPES)}))
      then '{C.PLAY_OWN}'
    when att in ({_list(C.SHARED_TYPES)})
      or (att in ({_list(C.MIXED_TYPES)}) and campaign in ({_list(C.MIXED_CAMPAIGNS)}))
      then '{C.PLAY_SHARED}'
    else '{C.PLAY_MEDIA}' end"""

# The key columns as every check names them, and two row tests.
KEY = "dt, att as ad_traffic_type, mode as combine_play_type"
# Counts read the flag as a number, the match reads it as text.
BILLED = "part = 'RTB_all' and try_cast(billed_flag as int) <> 1"
CLIENT = "event_type in ('0', '1', '3', '4')"

C_ROWS = f"c as (select *, {PLAY} as mode from clicks)"
W_ROWS = f"""w as (
  select dt, att, mode, placement, flag, billing, count(*) as clicks,
    cast(sum(cast(price as decimal(18,2)) * if(att = '1', -1, 1)) as decimal(18,2)) as money
  from c group by all)"""
CLICK_ROWS = _with(CLICKS, C_ROWS, W_ROWS)

M1 = f"""select {KEY}, count(*) as all_clicks,
  count(*) filter (placement = '') as placementid_isnull_clicks
from c where loc = '2' group by all"""
M2 = f"""select {KEY}, cast(sum(money) as double) as consumption,
  cast(sum(if(placement = '', money, 0)) as double) as placementid_isnull_consumption
from w group by all"""
M3 = f"""select {KEY}, count(*) as repage_finance_clicks,
  count(*) filter (last_pos in ('', '0')) as repage_last_placementid_isnull_finance_clicks
from c where {BILLED} and loc = '3' group by all"""
M4 = f"""select {KEY}, count(*) as finance_clicks,
  count(*) filter (click_id = '') as clickid_isnull_finance_clicks
from c where {BILLED} and loc = '2' group by all"""
M5A = f"""select {KEY}, cast(sum(clicks) as bigint) as summary_finance_clicks
from w where flag <> 'R' and flag <> 'N' and mode = '{C.PLAY_MEDIA}' group by all"""
M5B = f"""select {KEY}, count(*) as detail_finance_clicks
from c where part in ('RTB_all', 'GDT') and try_cast(billed_flag as int) <> 1 and loc = '2'
  and mode = '{C.PLAY_MEDIA}' group by all"""


def _match(drop_empty: bool = False) -> str:
    """Off-site client-side clicks with a billed click of the same day, session and item."""
    session = "if(coalesce(a.att, '') in ('99', '122', '251'), a.click_id, a.sid)"
    other = session.replace("a.", "b.")
    keys = "('0', '')" if drop_empty else "('0')"
    return f"""select {KEY}, count(*) as detail_rtb_join_c2s_clicks
from c a where loc = '2' and {CLIENT} and exists (
  select 1 from c b where b.loc = '2' and b.part = 'RTB_all' and b.billed_flag <> '1'
    and b.dt = a.dt and {other} = {session} and b.item = a.item
    and {other} not in {keys} and b.item not in {keys})
group by all"""


M6A = _match()
M6B = f"""select {KEY}, count(*) as detail_rtb_clicks
from c where {BILLED} and loc = '2' group by all"""
M7 = f"""select {KEY},
  count(*) filter (try_cast(event_type as int) not in (0, 1, 3, 4)) as detail_s2s_clicks,
  count(*) filter (try_cast(event_type as int) in (0, 1, 3, 4)) as detail_c2s_clicks
from c where part in ('RTB_all', 'rtbnc') and loc = '2' group by all"""
M8A = f"""select {KEY}, cast(sum(money) as double) as summary_cpc_consumption
from w where lower(billing) = 'cpc' and flag <> 'R' and flag <> 'N' group by all"""
M8B = f"""select {KEY}, cast(sum(cast(price as decimal(18,2))) as double) as detail_cpc_consumption
from c where lower(billing) = 'cpc' and (({BILLED}) or part = 'GDT') and loc = '2' group by all"""


def _union(*queries: str) -> str:
    return "\nunion all by name\n".join(f"({q})" for q in queries)


MERGED = (
    "select dt, ad_traffic_type, combine_play_type,\n  "
    + ",\n  ".join(
        f"cast(max(coalesce({m}, 0)) as double) as {m}" for m in C.MONITOR_MEASURES
    )
    + f"\nfrom ({_union(M1, M2, M3, M4, M5A, M5B, M6A, M6B, M7, M8A, M8B)}) group by 1, 2, 3"
)

RATIOS = f"""select dt, ad_traffic_type, combine_play_type,
  round(repage_last_placementid_isnull_finance_clicks / nullif(repage_finance_clicks, 0), 6)
    as repage_last_placementid_isnull_ratio,
  round(clickid_isnull_finance_clicks / nullif(finance_clicks, 0), 6) as clickid_isnull_ratio,
  round(detail_rtb_join_c2s_clicks / nullif(detail_rtb_clicks, 0), 6) as rtb_join_c2s_ratio,
  round(summary_finance_clicks - detail_finance_clicks, 6) as finance_clicks_diff,
  round(detail_s2s_clicks - detail_c2s_clicks, 6) as s2s_c2s_clicks_diff,
  round(summary_cpc_consumption - detail_cpc_consumption, 6) as cpc_consumption_diff
from ({MERGED})"""

PLAY_MODE = """select att as ad_traffic_type, grp as ad_traffic_group, campaign as campaign_type,
  mode as combine_play_type, count(*) as n from c group by all"""

PV = """select strftime(date '2024-01-01' + cast(doc_id % 30 as int), '%Y-%m-%d') as dt,
  lang as pv_chan_first_cate_cd, source as pv_chan_second_cate_cd,
  cast(doc_id % 4 as varchar) as pv_chan_third_cate_cd,
  if(n_chars > 1000, 'true', 'false') as pv_chan_fourth_cate_cd,
  cast(count(*) as double) as pv,
  cast(count(*) filter (doc_id % 3 = 0) as double) as join_click_pv,
  cast(count(*) filter (doc_id % 10 = 0) as double) as jdv_click_id_macro_replace_faild
from documents group by 1, 2, 3, 4, 5"""


# --- labels ------------------------------------------------------------------

def _freq(n: str) -> str:
    return f"""case when coalesce({n}, 0) < 7 then coalesce({n}, 0) || '{C.TIMES}'
      when {n} < 11 then '{C.FREQ_7_TO_10}' else '{C.FREQ_OVER_10}' end"""


def _collapse(number: str, label: str, other: str) -> str:
    return f"case when {number} = 0 then '' when {number} between 1 and 4 then {label} else '{other}' end"


USER_DAYS = """days as (
  select user_id, strftime(ts, '%Y-%m-%d') as dt, count(*) as n,
    cast(count(distinct event_type) as int) as kinds from events group by 1, 2)"""

FREQ = f"""{_with(USER_DAYS)}select user_id, dt, n, {_freq('t')} as freq
from (select *, if(n > 1, n * 2 - 4, null) as t from days)"""
CHAN_COUNT = f"""{_with(USER_DAYS)}select user_id, dt, kinds,
  case kinds - 1 when 0 then '' when 1 then '1' when 2 then '2' when 3 then '3' else '>=4' end
    as label from days"""
CHAN_COLLAPSE = f"""{_with(USER_DAYS)}select user_id, dt, n,
  {_collapse('k', "'set' || n", C.OTHER_CHANNELS)} as label,
  {_collapse('k', "'set' || n", C.OTHER_CHANNELS_SNAPSHOT)} as snapshot_label
from (select *, if(n <> 3, n - 1, null) as k from days)"""


def _lifecycle(account: str, status: str, value: str) -> str:
    return f"""case when {account} is null or {status} = '0' then '{C.NO_ACCOUNT}'
    when {account} <> '' and coalesce({value}, '-1') = '-1' then '{C.UNKNOWN_LIFECYCLE}'
    else {value} end"""


LIFECYCLE = f"""select c_custkey, {_lifecycle('account', 'status', 'life')} as label from (
  select c_custkey,
    case when c_custkey % 7 = 0 then null when c_custkey % 11 = 0 then '' else c_name end as account,
    case when c_nationkey % 10 = 0 then '0' when c_nationkey % 10 < 8 then '1' end as status,
    case c_mktsegment when 'MACHINERY' then '-1' when 'FURNITURE' then null
      else c_mktsegment end as life
  from customer)"""


# --- order facts ---------------------------------------------------------------

ORDER_LINES = """lines as (
  select o_orderdate as tm, o_orderkey as ok, o_custkey as ck, o_orderstatus as status,
    l_partkey % 3 as sku, l_suppkey % 2 as sub, l_returnflag as flag,
    cast(l_extendedprice as decimal(18,2)) as price
  from orders join lineitem on o_orderkey = l_orderkey)"""

SETTLED = f"""{_with(ORDER_LINES)}select strftime(tm, '%Y-%m-%d') as dt,
  'm' || ck % 500 as unif_user_log_acct, 'c' || ck as user_log_acct,
  if(status <> 'P', cast(ok as varchar), '') as parent_sale_ord_id,
  strftime(tm, '%Y-%m-%d %H:%M:%S') as event_time,
  cast(sum(if(status <> 'P', best, 0)) as double) as after_prefr_amount_1
from (select tm, ok, ck, status, sku, sub, max(price) as best from lines
      where ok % 10 <> 0 and ok % 13 <> 0 group by all)
group by 1, 2, 3, 4, 5"""

SNAPSHOT_LINES = """best as (
  select tm, ok, ck, sku, sub, max(price) as best from lines
  where ok % 10 <> 0 and ok % 13 <> 0 and ok % 7 <> 0 group by all),
consumer as (select distinct tm, ok, sku, sub from lines where flag <> 'R')"""
SNAPSHOT = f"""{_with(ORDER_LINES, SNAPSHOT_LINES)}select strftime(tm, '%Y-%m-%d') as dt,
  if(ck % 5 = 0 or not exists (select 1 from customer where c_custkey = ck),
     'c' || ck, 'm' || ck // 3) as unif_user_log_acct,
  'c' || ck as user_log_acct,
  if(hit, cast(ok as varchar), '') as parent_sale_ord_id,
  strftime(tm, '%Y-%m-%d %H:%M:%S') as event_time,
  cast(sum(if(hit, best, 0)) as double) as after_prefr_amount_1
from (select b.*, c.ok is not null as hit from best b left join consumer c
      on b.tm = c.tm and b.ok = c.ok and b.sku = c.sku and b.sub = c.sub)
group by 1, 2, 3, 4, 5"""

QUARTERS = f"""{_with(ORDER_LINES)}select strftime(date_trunc('quarter', tm), '%Y-%m-%d') as dt,
  count(*) as n, strftime(min(tm), '%Y-%m-%d') as first_day, strftime(max(tm), '%Y-%m-%d') as last_day
from lines group by 1"""


# --- visit paths ---------------------------------------------------------------

CHANNEL_NAMES = _list(C.CHANNELS)
ACCOUNT = (
    "case when user_id % 7 = 0 then null when user_id % 11 = 0 then '' "
    "else 'u' || user_id end"
)
# The snapshot takes the account from the login's name, or the login itself.
NAMED = "if(user_id % 7 = 0 or user_id % 11 = 0, 'l', 'u') || user_id"

VISITS = f"""visits as (
  select strftime(ts, '%Y-%m-%d') as dt, {ACCOUNT} as acct, 'l' || user_id as login,
    if(user_id % 13 = 0, null, 'd' || user_id || '-' || event_id % 2) as device,
    ([{CHANNEL_NAMES}, 'unlisted', null])[event_id % 11 + 1] as chan,
    if(event_id % 19 = 0, null, 's' || user_id || '-' || hour(ts) // 6) as pv,
    ts as tm, event_id % 17 <> 0 as app
  from events where event_type <> 'purchase')"""


def _deals(account: str) -> str:
    consumer = "event_id % 5 <> 0"
    return f"""deals as (
  select strftime(ts, '%Y-%m-%d') as dt, {account} as acct, 'l' || user_id as login,
    if({consumer}, 'p' || event_id, '') as parent, date_trunc('second', ts) as tm,
    cast(sum(if({consumer}, cast(value as decimal(18,2)), 0)) as decimal(18,2)) as amount
  from events where event_type = 'purchase' and event_id % 17 <> 0 and event_id % 23 <> 0
  group by 1, 2, 3, 4, 5)"""


EVENTS = """ev as (
  select dt, acct, login, device, chan, pv, '' as parent, tm,
    cast(0 as decimal(18,2)) as amount, 0 as o, coalesce(nullif(acct, ''), device) as uid
  from visits where app
  union all
  select dt, acct, login, null, null, null, parent, tm, amount, 1, nullif(acct, '') from deals)"""
# The empty account as an account like any other.
LITERAL_EVENTS = EVENTS.replace("coalesce(nullif(acct, ''), device) as uid", "coalesce(acct, device) as uid")
LITERAL_EVENTS = LITERAL_EVENTS.replace("amount, 1, nullif(acct, '') from", "amount, 1, acct from")
STABLE_DEALS = _deals(ACCOUNT)
SNAPSHOT_DEALS = _deals(NAMED)

RANK = f"list_position([{CHANNEL_NAMES}], chan)"

# A label lists the distinct known channels by their position.
SUMMARY = f"""us as (
  select dt, uid, if(max(o) = 1, 'order', 'visit') as attr, count(distinct pv) as times,
    list_sort(coalesce(list(distinct {RANK}) filter ({RANK} > 0), [])) as ranks,
    cast(sum(o) as bigint) as orders
  from ev where uid is not null group by dt, uid),
usum as (
  select dt, uid, attr, times, orders, cast(len(ranks) as int) as num,
    array_to_string([([{CHANNEL_NAMES}])[r] for r in ranks], '+') as label from us)"""


def _paths(source: str, keys: str, order: str, chan: str, ord_id: str, amount: str,
           pv: str | None = None, cumulative: bool = False) -> str:
    """CTEs ending in ``pth``: one row per segment, from ``source`` with an order flag ``o``."""
    k = [name.strip() for name in keys.split(",")]

    def on(a, b):
        return " and ".join(f"{a}.{n} = {b}.{n}" for n in k)

    # A visit id counts at its first event of the segment (of the day if cumulative).
    scope = keys if cumulative else f"{keys}, seg"
    once = (
        f"if(o = 0 and {pv} is not null and row_number() over "
        f"(partition by {scope}, o, {pv} order by {order}) = 1, 1, 0)"
        if pv
        else "1 - o"
    )
    reach = "<=" if cumulative else "="
    same = " and ".join(f"v.{n} = s.{n}" for n in k)
    return f"""sg as (
  select *, cast(coalesce(sum(o) over (partition by {keys} order by {order}
    rows between unbounded preceding and 1 preceding), 0) as bigint) as seg from {source}),
sv as (select *, {once} as v from sg),
segs as (
  select {keys}, seg, coalesce(max(if(o = 1, {ord_id}, null)), '') as ord,
    cast(coalesce(sum(if(o = 1, {amount}, 0)), 0) as double) as amt, sum(v) as own, max(o) as ho
  from sv group by all),
steps as (
  select {", ".join("s." + n for n in k)}, s.seg, coalesce(v.{chan}, '') as ch,
    sum(v.v) as n, min(v.tm) as ft
  from segs s join sv v on {same} and v.seg {reach} s.seg and v.v = 1 group by all),
txt as (
  select {keys}, seg, string_agg(ch || '|' || n, '>' order by ft, ch, n) as path,
    sum(n) as all_times from steps group by all),
pth as (
  select segs.*, coalesce(txt.path, '') as path,
    cast(coalesce(txt.all_times, 0) as bigint) as all_times,
    cast(coalesce(f.own, 0) as bigint) as bfo
  from segs left join txt on {on('segs', 'txt')} and segs.seg = txt.seg
  left join segs f on {on('segs', 'f')} and f.seg = 0 and f.ho = 1)"""


RAW = """raw as (
  select *, cast(ts as date) as day, ts as tm, if(event_type = 'purchase', 1, 0) as o,
    cast(value as decimal(18,2)) as money,
    if(event_id % 9 <> 0, hour(ts) // 12, null) as visit_id from events)"""


def _raw_paths(**options) -> str:
    ctes = _paths(
        "raw", "user_id, day", "ts, event_id", "event_type", "cast(event_id as varchar)", "money",
        **options,
    )
    return f"""{_with(RAW, ctes)}select user_id, strftime(day, '%Y-%m-%d') as day, seg, ord, amt,
  path, all_times, bfo from pth"""


EVENT_PATHS = _paths(
    "(select * from ev where uid is not null)", "dt, uid", "tm, o, parent, login", "chan",
    "parent", "amount",
)
USER = "dt, uid as user_id"

TAGS = """cust as (
  select 'u' || c_custkey as a, 'd' || c_custkey || '-0' as d,
    if(c_mktsegment = 'MACHINERY', '-1', c_mktsegment) as life,
    if(c_nationkey % 10 = 0, '0', '1') as status,
    if(c_nationkey % 5 = 0, null, 'v' || c_nationkey % 4) as av,
    if(c_nationkey % 4 = 0, null, 'b' || c_nationkey % 3) as ab,
    'dv' || c_nationkey % 4 as dv, 'db' || c_nationkey % 3 as db
  from customer)"""


def _detail_cte(version: str) -> str:
    other = C.OTHER_CHANNELS_SNAPSHOT if version == C.SNAPSHOT else C.OTHER_CHANNELS
    return f"""detail as (
  select '{C.APP}' as platform, i.acct as unif_user_log_acct, i.login as user_log_acct,
    i.device as browser_uniq_id, u.attr,
    {_lifecycle('i.acct', 't.status', 't.life')} as user_life_cycle_type,
    p.ord as parent_sale_ord_id,
    {_collapse('u.num', 'u.label', other)} as tc_visit_chan, u.num as tc_visit_chan_num,
    p.path as visit_chan_cate2_cds_with_times,
    if(u.uid is null, null, {_freq('u.times')}) as user_visit_freq, u.times as tc_visit_times,
    cast(p.bfo as int) as tc_user_visits_before_deal, p.amt as tc_deal_after_prefr_amount_1,
    {_freq('p.all_times')} as path_user_visit_freq,
    coalesce(t.av, g.dv, '{C.NO_VISIT_CYCLE}') as user_visitcycle,
    coalesce(t.ab, g.db, '{C.NO_BUY_CYCLE}') as user_buycycle,
    i.dt, 'day' as tp, '{version}' as dp
  from (select distinct dt, acct, login, device, uid from ev) i
  left join usum u on i.dt = u.dt and i.uid = u.uid
  left join pth p on i.dt = p.dt and i.uid = p.uid
  left join cust t on nullif(i.acct, '') = t.a
  left join cust g on i.device = g.d)"""


def _detail_with(version: str = C.STABLE, events: str = EVENTS) -> str:
    deals = SNAPSHOT_DEALS if version == C.SNAPSHOT else STABLE_DEALS
    return _with(VISITS, deals, events, SUMMARY, EVENT_PATHS, TAGS, _detail_cte(version))


def _detail(version: str = C.STABLE) -> str:
    return f"{_detail_with(version)}select * from detail"


MEMBER_COLUMNS = """platform, unif_user_log_acct, user_log_acct, browser_uniq_id, attr,
  user_life_cycle_type, tc_visit_chan, tc_visit_chan_num, user_visit_freq, tc_visit_times,
  user_visitcycle, user_buycycle"""
FACTORED = f"""{_detail_with(events=LITERAL_EVENTS)}, people as (
  select distinct {MEMBER_COLUMNS}, coalesce(unif_user_log_acct, browser_uniq_id) as user_id,
    dt, tp, dp, 'member' as side
  from detail)
select * from people
union all by name
select uid as user_id, ord as parent_sale_ord_id, path as visit_chan_cate2_cds_with_times,
  cast(bfo as int) as tc_user_visits_before_deal, amt as tc_deal_after_prefr_amount_1,
  {_freq('all_times')} as path_user_visit_freq, dt, 'day' as tp, 'stable' as dp, 'path' as side
from pth"""


# --- rollup ----------------------------------------------------------------------

MULTI = """case when max(tc_visit_chan_num) >= 4 then '>=4'
      when max(tc_visit_chan_num) >= 1 then cast(max(tc_visit_chan_num) as varchar) else '' end"""


def _facets(by_path: bool, account: str = "nullif(unif_user_log_acct, '')") -> str:
    path = ", path_user_visit_freq, visit_chan_cate2_cds_with_times" if by_path else ""
    dims = f"""{MULTI} as is_visit_multi_chan, max(tc_visit_chan) as tc_visit_chan,
    max(user_visit_freq) as user_visit_freq, max(user_life_cycle_type) as user_life_cycle_type,
    max(user_visitcycle) as user_visitcycle, max(user_buycycle) as user_buycycle{path}"""
    return f"""d as (select *, coalesce({account}, browser_uniq_id) as uid from detail),
facets as (
  select dt, {dims}, null as device, if(min(attr) = 'order', uid, null) as buyer,
    nullif(parent_sale_ord_id, '') as deal, 0 as visits,
    max(tc_user_visits_before_deal) as before, max(tc_deal_after_prefr_amount_1) as amount
  from d group by dt, uid, parent_sale_ord_id{path}
  union all
  select dt, {dims}, browser_uniq_id, null, null, 0, 0, 0
  from d where browser_uniq_id <> '' group by dt, browser_uniq_id{path}
  union all
  select dt, {dims}, null, null, null, max(tc_visit_times), 0, 0 from d group by dt, uid{path})"""


def _rollup_columns(version: str, lvl: str, dims: dict[str, str]) -> str:
    on, off = ("t1", "t2") if version == C.SNAPSHOT else ("t2", "t1")
    names = [*C.ROLLUP_DIMENSIONS, "path_user_visit_freq", "visit_chan_cate2_cds_with_times"]
    columns = [f"{dims.get(n, 'cast(null as varchar)')} as {n}" for n in names]
    return f"""select '{C.APP}' as platform, {lvl} as lvl, {", ".join(columns)},
  count(distinct device) as uv, cast(sum(visits) as bigint) as tc_user_visits,
  cast(sum(before) as bigint) as tc_user_visits_before_deal_{on},
  count(distinct buyer) as deal_user_num_toc_{on}, count(distinct deal) as deal_order_num_toc_{on},
  cast(sum(cast(amount as decimal(18,2))) as double) as deal_after_prefr_amount_1_toc_{on},
  cast(0 as bigint) as tc_user_visits_before_deal_{off}, cast(0 as bigint) as deal_user_num_toc_{off},
  cast(0 as bigint) as deal_order_num_toc_{off},
  cast(0 as double) as deal_after_prefr_amount_1_toc_{off},
  dt, 'day' as tp, '{version}' as dp"""


def _levels_select(version: str) -> str:
    same = {n: n for n in C.ROLLUP_DIMENSIONS}
    bits = "lpad(format('{:b}', grouping(" + ", ".join(C.ROLLUP_DIMENSIONS) + ")), 8, '0')"
    codes = {
        "0": "00111111", "1": "00011111", "2": "00101111", "3": "00001111",
        "4": "00110111", "5": "00110011", "7": "00000000",
    }
    lvl = f"case {bits} " + " ".join(f"when '{b}' then '{v}'" for v, b in codes.items()) + " end"
    sets = ", ".join(f"({', '.join(['dt', *kept])})" for kept in C.ROLLUP_LEVELS.values())
    return f"{_rollup_columns(version, lvl, same)}\nfrom facets group by grouping sets ({sets})"


def _paths_select(version: str) -> str:
    names = [
        "is_visit_multi_chan", "user_life_cycle_type", "user_visitcycle", "user_buycycle",
        "path_user_visit_freq", "visit_chan_cate2_cds_with_times",
    ]
    columns = _rollup_columns(version, "'6'", {n: n for n in names})
    return f"{columns}\nfrom facets group by dt, {', '.join(names)}"


def _levels(version: str = C.STABLE) -> str:
    return f"{_detail_with(version)}, {_facets(False)}\n{_levels_select(version)}"


def _path_level(version: str = C.STABLE) -> str:
    return f"{_detail_with(version)}, {_facets(True)}\n{_paths_select(version)}"


LITERAL_ROLLUP = _union(
    *[
        f"{_detail_with(events=LITERAL_EVENTS)}, {_facets(by_path, 'unif_user_log_acct')}\n{select(C.STABLE)}"
        for by_path, select in ((False, _levels_select), (True, _paths_select))
    ]
)
MERGED_ROLLUP = _union(
    *[part(version) for version in (C.STABLE, C.SNAPSHOT) for part in (_levels, _path_level)]
)


# --- keys and export -------------------------------------------------------------

def _shard(columns: list[str]) -> str:
    text = " || '|' || ".join(f"coalesce(cast({c} as varchar), '')" for c in columns)
    return f"cast(cast('0x' || md5({text})[1:8] as bigint) % {C.SHARDS} + 1 as int)"


SHARD_COLUMNS = [
    "dt", "dp", *C.EXPORT_SORT,
    *[n for n in C.ROLLUP_DIMENSIONS if n not in C.EXPORT_SORT], "path_user_visit_freq",
]


def _export(pattern: str) -> str:
    text = [
        "platform", "lvl", *C.ROLLUP_DIMENSIONS, "path_user_visit_freq",
        "visit_chan_cate2_cds_with_times",
    ]
    numbers = [
        f"{n}_{side}" for side in ("t1", "t2") for n in (
            "tc_user_visits_before_deal", "deal_user_num_toc", "deal_order_num_toc",
            "deal_after_prefr_amount_1_toc")
    ]
    masked = [
        f"if(dp = 'stable', 0, {n})" if pattern == "normal" else n for n in ("uv", "tc_user_visits")
    ]
    return f"""select dt, dp, {", ".join(f"coalesce({n}, '') as {n}" for n in text)},
  cast(coalesce({masked[0]}, 0) as bigint) as uv,
  cast(coalesce({masked[1]}, 0) as bigint) as tc_user_visits,
  {", ".join(f"coalesce({n}, 0) as {n}" for n in numbers)},
  {_shard(SHARD_COLUMNS)} as hash_key_for_shard
from ({MERGED_ROLLUP})"""


EXPORT_FILES = f"""select dt, count(*) as n, cast(sum({_shard(SHARD_COLUMNS)}) as bigint) as shards
  from ({_levels()}) group by dt"""

SHARD_FILES = f"""select dt, cast(sum(1) as bigint) as n, min({_shard(SHARD_COLUMNS)}) as first,
  max({_shard(SHARD_COLUMNS)}) as last, cast(0 as bigint) as overlaps
  from ({_levels()}) group by dt"""

OVERWRITE = """with rows as (
  select event_id, strftime(ts, '%Y-%m-%d') as dt, 'day' as tp, day(ts) % 2 as odd from events)
select event_id, 1::int as run, dt, tp, 'stable' as dp from rows
union all
select event_id, if(odd = 1, 2, 1)::int, dt, tp, 'snapshot' from rows
where odd = 0 or event_id % 2 = 0"""

ORACLE: dict[str, str] = {
    "pv_monitor": PV,
    "monitor_m1": CLICK_ROWS + M1,
    "monitor_m2": CLICK_ROWS + M2,
    "monitor_m3": CLICK_ROWS + M3,
    "monitor_m4": CLICK_ROWS + M4,
    "monitor_m5": CLICK_ROWS + _union(M5A, M5B),
    "monitor_m6": CLICK_ROWS + _union(M6A, M6B),
    "monitor_m7": CLICK_ROWS + M7,
    "monitor_m8": CLICK_ROWS + _union(M8A, M8B),
    "monitor_merge": CLICK_ROWS + MERGED,
    "monitor_merge_fused": CLICK_ROWS + MERGED,
    "monitor_ratios": CLICK_ROWS + RATIOS,
    "play_mode": CLICK_ROWS + PLAY_MODE,
    "semi_match": CLICK_ROWS + M6A,
    "semi_match_drop_empty": CLICK_ROWS + _match(drop_empty=True),
    "freq_label": FREQ,
    "chan_count_label": CHAN_COUNT,
    "chan_collapse": CHAN_COLLAPSE,
    "lifecycle_label": LIFECYCLE,
    "order_facts_stable": SETTLED,
    "order_facts_history": SETTLED,
    "order_facts_snapshot": SNAPSHOT,
    "quarter_scan": QUARTERS,
    "unified_events": f"""{_with(VISITS, STABLE_DEALS, EVENTS)}select dt,
  acct as unif_user_log_acct, login as user_log_acct, device as browser_uniq_id,
  chan as chan_second_cate_desc_bel, pv as pv_id, parent as parent_sale_ord_id,
  strftime(tm, '%Y-%m-%d %H:%M:%S.%f') as event_time,
  cast(amount as double) as after_prefr_amount_1, if(o = 1, 'order', 'visit') as attr,
  uid as user_id, o = 1 as is_order,
  if({RANK} > 0, {RANK} || '-' || chan, null) as ranked_channel from ev""",
    "event_sequence": f"""{_with(VISITS, STABLE_DEALS, EVENTS, EVENT_PATHS)}select {USER}, seg,
  if(o = 1, 'order', 'visit') as attr, count(*) as n,
  strftime(min(tm), '%Y-%m-%d %H:%M:%S.%f') as first_time,
  strftime(max(tm), '%Y-%m-%d %H:%M:%S.%f') as last_time
from sg group by all""",
    "user_summary": f"""{_with(VISITS, STABLE_DEALS, EVENTS, SUMMARY)}select {USER}, attr,
  times as tc_visit_times, label, num as tc_visit_chan_num, orders,
  {_freq('times')} as user_visit_freq
from usum""",
    "channel_label": f"""{_with(VISITS)}select dt, user_log_acct,
  array_to_string([([{CHANNEL_NAMES}])[r] for r in ranks], '+') as label
from (select dt, login as user_log_acct,
        list_sort(coalesce(list(distinct {RANK}) filter ({RANK} > 0), [])) as ranks
      from visits group by dt, login)""",
    "conversion_path": _raw_paths(),
    "conversion_path_distinct": _raw_paths(pv="visit_id"),
    "conversion_path_cumulative": _raw_paths(cumulative=True),
    "conversion_path_distinct_cumulative": _raw_paths(pv="visit_id", cumulative=True),
    "null_skip_join": """with e as (
  select event_id, case when user_id % 7 = 0 then null when user_id % 11 = 0 then ''
    else 'u' || user_id end as account from events),
r as (select if(c_custkey = 1, '', 'u' || c_custkey) as k, max(c_mktsegment) as segment
  from customer group by 1)
select event_id, account, segment from e left join r on nullif(account, '') = k""",
    "user_detail": _detail(),
    "user_detail_history": _detail(),
    "user_detail_snapshot": _detail(C.SNAPSHOT),
    "user_detail_empty_as_missing": _detail(),
    "user_detail_empty_as_account": FACTORED,
    "rollup_empty_as_account": LITERAL_ROLLUP,
    "rollup_levels": _levels(),
    "rollup_levels_plain": _levels(),
    "rollup_path_level": _path_level(),
    "rollup_path_level_plain": _path_level(),
    "rollup_merged": MERGED_ROLLUP,
    "grouping_codes": """select l_returnflag, l_linestatus, l_linenumber,
  lpad(format('{:b}', grouping(l_returnflag, l_linestatus, l_linenumber)), 8, '0') as bits,
  count(*) as n from lineitem group by cube (l_returnflag, l_linestatus, l_linenumber)""",
    "json_field": """select event_id, json_extract_string(props, '$.k') as k,
  try_cast(json_extract_string(props, '$.k') as int) as k_int from events""",
    "shard_key": f"""select o_orderkey,
  {_shard(['o_orderkey', 'o_custkey', 'o_orderstatus'])} as shard from orders""",
    "export_normal": _export("normal"),
    "export_history": _export("history"),
    "export_files": EXPORT_FILES,
    "export_shard_files": SHARD_FILES,
    "overwrite_roundtrip": OVERWRITE,
}
