"""The registered queries in DuckDB SQL, written from the definitions and not from the Spark code.

``PARTS`` are named table expressions; ``sql`` puts the ones a statement needs in
front of it. Ratios of exact amounts are rounded half up in integer arithmetic,
because double division rounds some halves down.
"""

from __future__ import annotations

import re


def half_up(n: str, d: str, scale: int) -> str:
    """n / d rounded half away from zero, for integer expressions n and d."""
    p = 10**scale
    n, d = f"({n})::hugeint", f"({d})::hugeint"
    return f"(case when {d} = 0 then null else sign({n}) * ((2 * abs({n}) * {p} + abs({d})) // (2 * abs({d}))) / {p}.0::double end)"


def cents(x: str) -> str:
    return f"(({x}) * 100)::hugeint"


def money_ratio(num: str, den: str, scale: int = 2) -> str:
    """money / count."""
    return half_up(cents(num), f"({den}) * 100", scale)


def growth(cur: str, prev: str, scale: int = 2) -> str:
    """(cur - prev) / prev * 100 for money."""
    c, p = cents(cur), cents(prev)
    return half_up(f"({c} - {p}) * 100", p, scale)


def dec(x: str, scale: int = 2) -> str:
    return f"cast({x} as decimal(20,{scale}))"


VALID = "not is_cancelled and not is_return"
VALID_SUM = f"cast(sum(case when {VALID} then line_total else 0 end) as decimal(20,2))"

PARTS: dict[str, str] = {}

PARTS["raw"] = """
select case when o_orderkey % 50 = 0 then 'C' else '' end || cast(o_orderkey as varchar(20)) as invoice_no,
       cast(p_partkey as varchar(20)) as stock_code,
       case when p_partkey % 100 = 0 then '  ' else p_name end as description,
       cast(case when l_linenumber = 7 and l_orderkey % 100 = 3 then 0
                 when o_orderkey % 50 = 0 or (l_returnflag = 'R' and l_linenumber = 7) then -l_quantity
                 else l_quantity end as int) as quantity,
       case when l_linenumber = 6 and l_orderkey % 100 = 1 then null else o_orderdate end as invoice_date,
       cast(case when p_partkey % 250 = 7 then 0 else p_retailprice end as decimal(10,2)) as unit_price,
       case when o_orderkey % 4 = 1 then '' else cast(o_custkey as varchar(20)) end as customer_id,
       case when c_custkey % 500 = 0 then '' else n_name end as country
from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
     join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
"""

PARTS["stg"] = """
select invoice_no, stock_code, coalesce(nullif(trim(description), ''), 'Unknown') as description, quantity, invoice_date,
       unit_price, cast(nullif(customer_id, '') as bigint) as customer_id,
       coalesce(nullif(trim(country), ''), 'Unknown') as country,
       cast(quantity * unit_price as decimal(18,2)) as line_total,
       invoice_no like 'C%' as is_cancelled, quantity < 0 as is_return
from raw
where invoice_no is not null and stock_code is not null and invoice_date is not null and unit_price > 0 and quantity <> 0
"""

PARTS["fact"] = """
select cast(strftime(invoice_date, '%Y%m%d') as int) as date_key, customer_id, stock_code, country as country_name, invoice_no,
       quantity, unit_price, line_total, is_cancelled, is_return, invoice_date::date as full_date
from stg
"""

PARTS["dim_country"] = f"""
select country as country_name, count(distinct customer_id) as total_customers, count(distinct invoice_no) as total_orders,
       {VALID_SUM} as total_revenue
from stg group by country
"""

PARTS["dim_product"] = f"""
select a.*, b.description from (
    select stock_code, {dec(money_ratio('sum(unit_price)', 'count(*)'))} as avg_unit_price,
           sum(case when {VALID} then quantity else 0 end)::bigint as total_quantity_sold, {VALID_SUM} as total_revenue,
           min(invoice_date)::date as first_sold_date, max(invoice_date)::date as last_sold_date
    from stg group by stock_code) a
join (select stock_code, description from stg
      qualify row_number() over (partition by stock_code order by invoice_date desc, description desc) = 1) b using (stock_code)
"""

PARTS["dim_customer"] = f"""
select *, {dec("case when total_orders > 0 then " + money_ratio('total_revenue', 'total_orders') + " else 0 end")} as avg_order_value
from (select customer_id, min(invoice_date)::date as first_purchase_date, max(invoice_date)::date as last_purchase_date,
             count(distinct invoice_no) as total_orders, {VALID_SUM} as total_revenue
      from stg where customer_id is not null group by customer_id)
"""

PARTS["kpis"] = f"""
select date_key, full_date, total_revenue, total_orders, total_items_sold, unique_customers,
       {dec("coalesce(" + money_ratio('total_revenue', 'total_orders') + ", 0)")} as avg_order_value,
       cancelled_orders, cancelled_revenue, return_orders, return_revenue,
       {dec("coalesce(" + half_up('cancelled_orders', 'invoices', 4) + ", 0)", 4)} as cancellation_rate,
       {dec("coalesce(" + half_up('return_orders', 'invoices', 4) + ", 0)", 4)} as return_rate,
       coalesce(n, 0) as new_customers, greatest(unique_customers - coalesce(n, 0), 0) as repeat_customers
from (select date_key, full_date, {VALID_SUM} as total_revenue,
             count(distinct case when not is_cancelled then invoice_no end) as total_orders,
             sum(case when {VALID} then quantity else 0 end)::bigint as total_items_sold,
             count(distinct customer_id) as unique_customers,
             count(distinct case when is_cancelled then invoice_no end) as cancelled_orders,
             abs(sum(case when is_cancelled then line_total else 0 end)) as cancelled_revenue,
             count(distinct case when is_return then invoice_no end) as return_orders,
             abs(sum(case when is_return then line_total else 0 end)) as return_revenue,
             count(distinct invoice_no) as invoices
      from fact group by date_key, full_date)
left join (select first_purchase_date, count(*) as n from dim_customer group by first_purchase_date) on full_date = first_purchase_date
"""

PARTS["invoices"] = "select distinct full_date, invoice_no, country_name, customer_id from fact"

PARTS["today"] = "select max(full_date) as today from kpis"

PARTS["rfm_metrics"] = f"""
select customer_id, date_diff('day', max(full_date), (select today from today)) as recency_days,
       count(distinct invoice_no) as frequency, {VALID_SUM} as monetary
from fact where customer_id is not null and not is_cancelled group by customer_id
"""

PARTS["rfm_scored"] = """
select *, ntile(5) over (order by recency_days desc, customer_id)::int as r_score,
          ntile(5) over (order by frequency, customer_id)::int as f_score,
          ntile(5) over (order by monetary, customer_id)::int as m_score
from rfm_metrics where monetary > 0
"""

# Segment names and texts.
SEGMENTS = [
    ("r_score >= 4 and f_score >= 4 and m_score >= 4", "Champions", "Best customers, high value and engagement"),
    ("r_score >= 4 and f_score >= 3 and m_score >= 3", "Loyal Customers", "Consistent buyers, respond to promotions"),
    ("r_score >= 4 and f_score <= 2", "Recent Customers", "New buyers, need nurturing"),
    ("r_score >= 3 and f_score >= 3 and m_score >= 3", "Potential Loyalists", "Recent with potential, offer membership"),
    ("r_score >= 3 and f_score >= 1 and m_score >= 2", "Promising", "Recent but low frequency, engage more"),
    ("r_score between 2 and 3 and f_score <= 2 and m_score <= 2", "Needs Attention", "Above average but declining"),
    ("r_score <= 2 and f_score >= 3", "At Risk", "Used to be active, reactivation needed"),
    ("r_score <= 2 and f_score >= 4 and m_score >= 4", "Cant Lose Them", "High value at risk, urgent action"),
    ("r_score <= 2 and f_score <= 2", "Hibernating", "Low activity, may be lost"),
]


def case(branches: list[tuple[str, str]], other: str) -> str:
    return "case " + " ".join(f"when {c} then '{v}'" for c, v in branches) + f" else '{other}' end"


def segment(i: int, order: list = SEGMENTS) -> str:
    return case([(b[0], b[i]) for b in order], "Others" if i == 1 else "Requires further analysis")


PARTS["rfm"] = f"""
select customer_id, recency_days, frequency, monetary, r_score, f_score, m_score,
       r_score::varchar || f_score::varchar || m_score::varchar as rfm_score,
       {segment(1)} as rfm_segment, {segment(2)} as segment_description
from rfm_scored
"""

PARTS["country_mart"] = f"""
select country_name, total_revenue, total_orders, total_customers,
       {dec("coalesce(" + money_ratio('total_revenue', 'total_orders') + ", 0)")} as avg_order_value,
       {dec("coalesce(" + half_up(cents('total_revenue') + ' * 100', cents('all_revenue'), 2) + ", 0)")} as revenue_share_pct,
       {dec("coalesce(" + half_up('total_orders * 100', 'all_orders', 2) + ", 0)")} as orders_share_pct
from (select country_name, {VALID_SUM} as total_revenue,
             count(distinct case when not is_cancelled then invoice_no end) as total_orders, count(distinct customer_id) as total_customers
      from fact group by country_name),
     (select {VALID_SUM} as all_revenue, count(distinct case when not is_cancelled then invoice_no end) as all_orders from fact)
"""

PARTS["product_mart"] = f"""
select stock_code, d.description, s.total_revenue, total_quantity, total_orders, s.avg_unit_price,
       rank() over (order by s.total_revenue desc) as revenue_rank, rank() over (order by total_quantity desc) as quantity_rank
from (select stock_code, {VALID_SUM} as total_revenue, sum(case when {VALID} then quantity else 0 end)::bigint as total_quantity,
             count(distinct case when not is_cancelled then invoice_no end) as total_orders,
             {dec(money_ratio('sum(unit_price)', 'count(*)'))} as avg_unit_price
      from fact group by stock_code) s
join dim_product d using (stock_code)
"""

PARTS["monthly"] = f"""
select year_month, left(year_month, 4)::int as year, right(year_month, 2)::int as month, total_revenue, total_orders, total_customers,
       avg_order_value, {dec(money_ratio('total_revenue', 'total_orders'))} as aov_weighted,
       {growth('total_revenue', 'lag(total_revenue) over (order by year_month)', 4)} as revenue_mom_growth,
       {growth('total_orders', 'lag(total_orders) over (order by year_month)', 4)} as orders_mom_growth
from (select strftime(full_date, '%Y-%m') as year_month, cast(sum(total_revenue) as decimal(20,2)) as total_revenue,
             sum(total_orders)::bigint as total_orders, sum(unique_customers)::bigint as total_customers,
             {dec(money_ratio('sum(avg_order_value)', 'count(*)'))} as avg_order_value
      from kpis group by 1)
"""

PARTS["calendar"] = """
select d::date as full_date from (select unnest(generate_series((select min(invoice_date)::date from stg)::timestamp,
       (select max(invoice_date)::date from stg)::timestamp, interval 1 day)) as d)
"""

# --- series -----------------------------------------------------------------------------

PARTS["series"] = " union all ".join(
    f"select '{m}' as metric_name, full_date as ds, {m}::double as value from kpis"
    for m in ("total_revenue", "total_orders", "unique_customers", "avg_order_value", "total_items_sold")
)
PARTS["series2"] = "select * from series where metric_name in ('total_revenue', 'total_orders')"
PARTS["filled"] = """
select m.metric_name, c.ds, coalesce(s.value, 0) as value
from (select metric_name, min(ds) as lo, max(ds) as hi from series group by 1) m
join (select full_date as ds from calendar) c on c.ds between m.lo and m.hi
left join series s on s.metric_name = m.metric_name and s.ds = c.ds
"""


def naive(source: str, horizon: int, prefix: str, keys: str = "metric_name") -> None:
    """Parts ``{prefix}`` with the naive weekly forecast of the part ``source``."""
    PARTS[f"{prefix}_back"] = (
        f"select *, row_number() over (partition by {keys} order by ds desc) as back, "
        f"value - lead(value, 7) over (partition by {keys} order by ds desc) as diff from {source}"
    )
    PARTS[f"{prefix}_stats"] = (
        f"select {keys}, max(ds) as last, count(*) as n, avg(value) as mean, coalesce(stddev_samp(diff), 0) as sd from {prefix}_back group by {keys}"
    )
    predicted = "case when n < 7 then mean else value end"
    PARTS[prefix] = f"""
select s.{keys}, (last + step::int)::date as ds, step::int as step, round(greatest({predicted}, 0), 2) as predicted,
       round(greatest({predicted} - 1.96 * sd, 0), 2) as lower_bound, round(greatest({predicted} + 1.96 * sd, 0), 2) as upper_bound
from (select *, unnest(range(1, {horizon + 1})) as step from {prefix}_stats) s
left join (select {keys}, back, value from {prefix}_back where back <= 7) b
     on b.{keys} = s.{keys} and b.back = 7 - (step - 1) % 7
"""


def native(source: str, horizon: int, prefix: str, keys: str = "metric_name") -> None:
    """Parts ``{prefix}_weekday_mean`` and ``{prefix}_smoothing`` over the part ``source``, ``{prefix}_naive``, and all of them in ``prefix``."""
    naive(source, horizon, f"{prefix}_naive", keys)
    PARTS[f"{prefix}_wd"] = f"select *, isodow(ds) - 1 as wd, row_number() over (partition by {keys}, isodow(ds) order by ds desc) as wd_back from {source}"
    PARTS[f"{prefix}_wm_level"] = (
        f"select {keys}, wd, max(ds) as last, avg(value) as level, stddev_pop(value) as sd, count(*) as n from {prefix}_wd where wd_back <= 8 group by all"
    )
    # The fold of the level, with the sum of the squared errors beside it.
    PARTS[f"{prefix}_sm_fold"] = f"""
select {keys}, wd, max(ds) as last, count(*) as n,
       list_reduce(list({{'l': value::double, 's': 0::double}} order by ds),
                   lambda a, b: {{'l': 0.3::double * b.l + 0.7::double * a.l, 's': a.s + (b.l - a.l) * (b.l - a.l)}}) as f
from {prefix}_wd group by {keys}, wd"""
    PARTS[f"{prefix}_sm_level"] = f"select {keys}, wd, last, f.l as level, sqrt(f.s / greatest(n - 1, 1)) as sd, n from {prefix}_sm_fold"
    for model, levels in (("weekday_mean", "wm_level"), ("smoothing", "sm_level")):
        cents6 = lambda x: f"round(greatest({x}, 0)::decimal(24,6), 2)::double"
        PARTS[f"{prefix}_{model}"] = f"""
select {keys}, ds, step, {cents6('lev')} as predicted, {cents6('lev - 1.96 * dev')} as lower_bound, {cents6('lev + 1.96 * dev')} as upper_bound
from (select e.{keys}, (fin + step::int)::date as ds, step::int as step, coalesce(l.level, e.mean) as lev, coalesce(l.sd, 0) as dev
      from (select *, unnest(range(1, {horizon + 1})) as step from (
                select {keys}, max(last) as fin, sum(level * n) / sum(n) as mean from {prefix}_{levels} group by {keys})) e
      left join {prefix}_{levels} l on l.{keys} = e.{keys} and l.wd = isodow((fin + step::int)::date) - 1)
"""
    PARTS[prefix] = " union all ".join(
        f"select '{m}' as model_type, {keys}, ds, step, predicted, lower_bound, upper_bound from {prefix}_{m}" for m in ("naive", "weekday_mean", "smoothing")
    )


def rolling(source: str, prefix: str, key: str = "metric_name") -> None:
    """Parts of a back-test over three origins of 14 days: ``{prefix}_days``, ``{prefix}_scores``, ``{prefix}_best``."""
    PARTS[f"{prefix}_placed"] = f"select {key}, ds, value, row_number() over (partition by {key} order by ds desc) as back, count(*) over (partition by {key}) as n from {source}"
    PARTS[f"{prefix}_rolled"] = f"""
select {key}, o as origin, {key} || '#' || o as skey, ds, value, back <= (o + 1) * 14 as is_test from {prefix}_placed, (select unnest([0, 1, 2]) as o)
where n >= (o + 1) * 14 + 30 and back > o * 14"""
    PARTS[f"{prefix}_train"] = f"select skey, ds, value from {prefix}_rolled where not is_test"
    native(f"{prefix}_train", 14, f"{prefix}_fc", "skey")
    PARTS[f"{prefix}_days"] = f"""
select r.{key}, r.origin, f.model_type, r.ds, f.predicted, f.lower_bound, f.upper_bound, r.value as actual, b.predicted as baseline
from {prefix}_rolled r join {prefix}_fc f on f.skey = r.skey and f.ds = r.ds join {prefix}_fc_naive b on b.skey = r.skey and b.ds = r.ds where r.is_test"""
    mape = lambda p: f"round(coalesce(avg(case when actual <> 0 then abs((actual - {p}) / actual) end) * 100, 0), 2)"
    smape = "round(coalesce(avg(case when abs(actual) + abs(predicted) <> 0 then abs(actual - predicted) / ((abs(actual) + abs(predicted)) / 2) end) * 100, 0), 2)"
    rmse = lambda p: f"round(sqrt(avg((actual - {p}) * (actual - {p}))), 2)"
    PARTS[f"{prefix}_scores"] = f"""
select *, case when baseline_mape > 0 then (baseline_mape - mape) / baseline_mape * 100 end as improvement from (
    select {key}, model_type, {mape('predicted')} as mape, {smape} as smape, {rmse('predicted')} as rmse, round(avg(abs(actual - predicted)), 2) as mae,
           {mape('baseline')} as baseline_mape, {rmse('baseline')} as baseline_rmse, {mape('baseline').replace(', 2)', ', 12)')} as raw_base, {mape('predicted').replace(', 2)', ', 12)')} as raw_mape, count(*) as test_samples
    from {prefix}_days group by {key}, model_type)"""
    PARTS[f"{prefix}_best"] = f"select {key}, model_type, mape from {prefix}_scores qualify row_number() over (partition by {key} order by mape, model_type) = 1"


PARTS["filled2"] = "select * from filled where metric_name in ('total_revenue', 'total_orders')"
native("filled2", 365, "fc_models")
rolling("filled2", "bt")
naive("filled", 28, "fc28")
PARTS["split"] = """
select *, row_number() over (partition by metric_name order by ds desc) <= 14 as is_test from filled
where (select count(*) from calendar) >= 44
"""
PARTS["train"] = "select metric_name, ds, value from split where not is_test"
naive("train", 14, "fc_train")
PARTS["pairs"] = """
select metric_name, ds, value as actual, predicted from split join fc_train using (metric_name, ds) where is_test
"""
PARTS["errors"] = """
select metric_name,
       coalesce(avg(case when actual <> 0 then abs((actual - predicted) / actual) end) * 100, 0) as mape,
       coalesce(avg(case when abs(actual) + abs(predicted) <> 0 then abs(actual - predicted) / ((abs(actual) + abs(predicted)) / 2) end) * 100, 0) as smape,
       sqrt(avg((actual - predicted) * (actual - predicted))) as rmse, avg(abs(actual - predicted)) as mae, count(*) as test_samples
from pairs group by 1
"""
PARTS["forecast"] = """
select ds as forecast_date, metric_name, cast(predicted as decimal(20,2)) as predicted_value,
       cast(lower_bound as decimal(20,2)) as lower_bound, cast(upper_bound as decimal(20,2)) as upper_bound,
       case model_type when 'naive' then 'Naive weekly' when 'weekday_mean' then 'Weekday mean' else 'Exponential smoothing' end as model_name
from fc_models join bt_best using (metric_name, model_type)
"""
native("filled", 28, "fc28_models")
PARTS["country_days"] = f"select country_name, full_date as ds, sum(line_total)::double as value from fact where {VALID} group by 1, 2"
PARTS["country_filled"] = """
select k.country_name, c.full_date as ds, coalesce(value, 0) as value
from (select country_name, min(ds) as lo, max(ds) as hi from country_days group by 1) k join calendar c on c.full_date between k.lo and k.hi
left join country_days s on s.country_name = k.country_name and s.ds = c.full_date"""
rolling("country_filled", "bc", "country_name")
PARTS["series4"] = """
select * from series where metric_name in ('total_revenue', 'total_orders', 'unique_customers', 'avg_order_value') and ds >= (select max(ds) from series) - 90
"""
PARTS["product_series"] = f"select stock_code, full_date as ds, sum(line_total)::double as value from fact where {VALID} group by 1, 2"
naive("product_series", 14, "fc_products", "stock_code")

def rolled_days(source: str, prefix: str) -> None:
    """``{prefix}_roll``: rolling mean and deviation of each day among the last four of its type."""
    w4 = "over (partition by metric_name, is_weekend order by ds rows between 3 preceding and current row)"
    PARTS[f"{prefix}_typed"] = f"select *, isodow(ds) - 1 as day_of_week, isodow(ds) >= 6 as is_weekend from {source}"
    PARTS[f"{prefix}_roll"] = f"""
select *, case when count(*) {w4} >= 2 then avg(value) {w4} end as rolling_mean,
          case when count(*) {w4} >= 2 then stddev_samp(value) {w4} end as rolling_std,
          avg(value) over (partition by metric_name, is_weekend) as baseline,
          stddev_samp(value) over (partition by metric_name) as all_std, count(*) over (partition by metric_name) as days_n
from {prefix}_typed
"""


def zscores(source: str, prefix: str) -> None:
    rolled_days(source, prefix)
    PARTS[f"{prefix}_z"] = f"""
select metric_name, ds, value, day_of_week, is_weekend, expected, std, (value - expected) / case when std = 0 then 1 else std end as z_score,
       round((value - expected) / case when expected = 0 then 1 else expected end * 100, 2) as deviation_pct
from (select *, coalesce(rolling_mean, baseline) as expected, coalesce(rolling_std, all_std) as std from {prefix}_roll where days_n >= 14)
"""
    PARTS[f"{prefix}_centre"] = f"select metric_name, is_weekend, median(value) as centre from {prefix}_z group by 1, 2"
    PARTS[f"{prefix}_spread"] = f"select metric_name, is_weekend, centre, median(abs(value - centre)) * 1.4826::double as spread from {prefix}_z join {prefix}_centre using (metric_name, is_weekend) group by 1, 2, 3"
    PARTS[f"{prefix}_robust"] = f"""
select *, (value - centre) / case when spread > 0 then spread when abs(centre) / 100 > 0 then abs(centre) / 100 else 1 end as robust_z
from {prefix}_z join {prefix}_spread using (metric_name, is_weekend)
"""


def detected(prefix: str, z: str = "2.5", robust: bool = True) -> str:
    """The anomalous days of the parts of :func:`zscores`, with type, severity and texts."""
    if not robust:
        found = f"select * from {prefix}_z where abs(z_score) > {z}"
    else:
        found = f"""
select metric_name, ds, value, day_of_week, is_weekend, case when m then centre else expected end as expected,
       case when m then robust_z else z_score end as z_score,
       case when m then round((value - centre) / case when centre = 0 then 1 else centre end * 100, 2) else deviation_pct end as deviation_pct
from (select *, abs(z_score) <= {z} and abs(robust_z) > 3.5 as m from {prefix}_robust) where m or abs(z_score) > {z}"""
    return explained(found)


zscores("series2", "two")
zscores("series4", "recent")
rolled_days("series", "five")
# Day names and message texts.
_DAY = "['Mon','Tue','Wed','Thu','Fri','Sat','Sun'][day_of_week + 1]"


def explained(found: str) -> str:
    return f"""
select ds as anomaly_date, metric_name, round(value::decimal(22,6), 2)::double as actual_value, round(expected::decimal(22,6), 2)::double as expected_value, deviation_pct, z_score,
       anomaly_type, severity, is_weekend, day_of_week,
       case when anomaly_type = 'spike' and is_weekend then 'Unusual weekend spike on ' || {_DAY} || '. Possible promotion effect or special event.'
            when anomaly_type = 'spike' then 'Unexpected high ' || replace(metric_name, '_', ' ') || ' on ' || {_DAY} || '. Review for campaign impact.'
            when is_weekend then 'Weekend drop on ' || {_DAY} || ' below normal patterns. Check for site issues.'
            else 'Weekday underperformance on ' || {_DAY} || '. Investigate operational issues.' end as business_interpretation,
       case when severity in ('critical', 'high') and anomaly_type = 'drop'
                 then 'URGENT: Check website uptime, payment systems, and inventory availability.'
            when severity in ('critical', 'high') then 'Review: Identify cause of spike for replication or concern.'
            else 'Monitor: Track if pattern continues over next few days.' end as recommended_action,
       case severity when 'critical' then 1 when 'high' then 2 when 'medium' then 3 else 4 end as priority
from (select *, case when value > expected then 'spike' when value < expected then 'drop' end as anomaly_type,
             case when abs(z_score) > 4 or abs(deviation_pct) > 50 then 'critical' when abs(z_score) > 3 or abs(deviation_pct) > 30 then 'high'
                  when abs(z_score) > 2 or abs(deviation_pct) > 15 then 'medium' else 'low' end as severity
      from ({found}))
"""


PARTS["anomalies"] = detected("two")

PARTS["model_runs"] = """
select 'train-' || strftime(run_day, '%Y-%m-%d') || '-1-' || s.model_type || '-' || s.metric_name as run_id, run_day::timestamp as run_timestamp,
       'forecast_' || s.model_type as model_type, s.metric_name as target_metric, lo as train_start_date, hi as train_end_date,
       (date_diff('day', lo, hi) + 1)::int as train_samples, s.mape, smape, rmse, mae, baseline_mape, round(improvement, 4) as improvement,
       case when b.metric_name is null then 'rejected' else 'completed' end as status, null::varchar as notes
from bt_scores s join (select metric_name, min(ds) as lo, max(ds) as hi from series2 group by 1) using (metric_name)
left join bt_best b on b.metric_name = s.metric_name and b.model_type = s.model_type, (select today as run_day from today)
union all
select 'train-' || strftime(run_day, '%Y-%m-%d') || '-1-anomaly-' || metric_name, run_day::timestamp, 'anomaly_robust', metric_name, lo, hi,
       (date_diff('day', lo, hi) + 1)::int, null, null, null, null, null, null, 'completed', n::varchar || ' days found'
from (select metric_name, count(*) as n from anomalies group by 1) join (select metric_name, min(ds) as lo, max(ds) as hi from series2 group by 1) using (metric_name), (select today as run_day from today)
"""

PARTS["alert_day"] = "select max(anomaly_date) as today from anomalies where severity in ('critical', 'high')"

# Every part once more over the lines before a day, under its name and "_e": what a first load saw.
_FIRST = re.compile(r"((?:from|join|,)\s*\(?\s*)(" + "|".join(sorted(PARTS, key=len, reverse=True)) + r")\b")
for _n, _text in list(PARTS.items()):
    PARTS[f"{_n}_e"] = _FIRST.sub(r"\1\2_e", _text)
PARTS["raw_e"] = "select * from raw where invoice_date < timestamp '2000-06-01'"
PARTS["all_runs"] = "select * from model_runs union all select * from model_runs_e"
# What the first training foresaw stays where the later one says nothing.
PARTS["forecast_kept"] = """
select forecast_date, metric_name, predicted_value, lower_bound, upper_bound from forecast
union all select forecast_date, metric_name, predicted_value, lower_bound, upper_bound from forecast_e where forecast_date not in (select forecast_date from forecast)
"""

_NAME = re.compile(r"\b(" + "|".join(sorted(PARTS, key=len, reverse=True)) + r")\b")
# Names that are both a part and a column or table word must follow "from" or "join" or a comma to count as a part.
_USE = re.compile(r"(?:from|join|,)\s*\(?\s*(" + "|".join(sorted(PARTS, key=len, reverse=True)) + r")\b")


def needed(text: str, seen: list[str]) -> list[str]:
    for name in _USE.findall(text):
        if name not in seen:
            needed(PARTS[name], seen)
            if name not in seen:
                seen.append(name)
    return seen


def sql(text: str) -> str:
    parts = needed(text, [])
    head = ", ".join(f"{p} as materialized ({PARTS[p].strip()})" for p in parts)
    text = text.strip()
    if head and text.startswith("with "):
        return f"with {head}, {text[5:]}"
    return (f"with {head} " if head else "") + text


ORACLE: dict[str, str] = {}


def add(name: str, text: str) -> None:
    ORACLE[name] = sql(text)


def dbl(*cols: str) -> str:
    return ", ".join(f"{c}::double as {c}" for c in cols)


# --- parsing ------------------------------------------------------------------------------

_Q = "l_quantity::int::varchar"
_NUM_TEXT = f"""
select l_orderkey, l_linenumber,
       case l_linenumber % 7 when 0 then '' when 1 then {_Q} || '.0' when 2 then ' ' || {_Q} || ' ' when 3 then 'x' || {_Q}
            when 4 then '-' || {_Q} || '.9' when 5 then {_Q} || 'e2' else {_Q} end as text
from lineitem
"""
add("parse_int_lenient", f"select *, trunc(try_cast(text as double))::int as parsed from ({_NUM_TEXT})")
add("parse_float_lenient", f"select *, try_cast(text as double) as parsed from ({_NUM_TEXT})")
_DAY_TEXT = "month(l_shipdate)::varchar || '/' || day(l_shipdate)::varchar || '/' || year(l_shipdate)::varchar"
_CLOCK = "((l_linenumber * 5) % 24)::varchar || ':0' || l_linenumber::varchar"
add(
    "parse_invoice_date",
    f"""select *, try_strptime(text, ['%m/%d/%Y %H:%M', '%m/%d/%Y %H:%M:%S']) as parsed from (
    select l_orderkey, l_linenumber,
           case l_linenumber % 5 when 0 then {_DAY_TEXT} || ' ' || {_CLOCK} || ':30'
                when 1 then year(l_shipdate)::varchar || '-' || month(l_shipdate)::varchar
                when 2 then '' else {_DAY_TEXT} || ' ' || {_CLOCK} end as text
    from lineitem)""",
)
add(
    "strip_excel_eq",
    """select l_orderkey, l_linenumber, text, case when s = '' or lower(s) = 'nan' then null else s end as stripped
    from (select *, trim(regexp_replace(trim(text), '^=', '')) as s from (
        select l_orderkey, l_linenumber, case l_linenumber % 5 when 0 then '=' || l_partkey::varchar when 1 then ' = ' || l_partkey::varchar
               when 2 then 'NaN' when 3 then ' = ' else l_partkey::varchar end as text from lineitem))""",
)
_RAW = "invoice_no, stock_code, description, quantity, invoice_date, unit_price::double as unit_price"
for _n in ("rename_by_name", "rename_by_position", "read_transactions_json", "load_raw"):
    add(_n, f"select {_RAW}, customer_id, country from raw")
# In a CSV file an empty field is a missing value.
for _n in ("read_transactions_csv", "stream_transactions"):
    add(_n, f"select {_RAW}, nullif(customer_id, '') as customer_id, nullif(country, '') as country from raw")
add(
    "read_transactions_csv_headers",
    f"select * replace (description || chr(10) || ', second line' as description) from ({ORACLE['read_transactions_csv'].split(') select ', 1)[0]}) select {_RAW}, nullif(customer_id, '') as customer_id, nullif(country, '') as country from raw)",
)

# --- cleaning, dimensions, fact -----------------------------------------------------------------

_STG = "invoice_no, stock_code, description, quantity, invoice_date, unit_price::double as unit_price, customer_id, country, line_total::double as line_total, is_cancelled, is_return"
add("clean_transactions", f"select {_STG} from stg")
add(
    "quarantine_rejects",
    f"""select {_RAW}, customer_id, country, case when invoice_date is null then 'filter_null_invoice_date' when unit_price <= 0 then 'filter_invalid_price' else 'filter_zero_quantity' end as reject_reason
    from raw where unit_price <= 0 or quantity = 0 or invoice_date is null""",
)
# Rule names, targets, types.
_RULES = [
    ("cancel_flag_invoice", "is_cancelled", "flag", "invoice_no like 'C%'"),
    ("return_flag_quantity", "is_return", "flag", "quantity < 0"),
    ("filter_zero_quantity", "quantity", "filter", "quantity = 0"),
    ("null_customer_impute", "customer_id", "impute", "customer_id = ''"),
    ("null_description_impute", "description", "impute", "trim(description) = ''"),
    ("null_country_impute", "country", "impute", "trim(country) = ''"),
    ("filter_invalid_price", "unit_price", "filter", "unit_price <= 0"),
    ("derive_line_total", "line_total", "derive", "unit_price > 0 and quantity <> 0 and invoice_date is not null"),
    ("filter_null_invoice_date", "invoice_date", "filter", "invoice_date is null"),
]
add(
    "cleaning_rules_catalog",
    " union all ".join(
        f"select '{n}' as rule_name, '{t}' as target_column, '{k}' as rule_type, count(*) filter (where {c}) as affected, "
        f"{half_up(f'count(*) filter (where {c}) * 100', 'count(*)', 2)} as records_affected_pct from raw"
        for n, t, k, c in _RULES
    ),
)
for _n, _, _, _c in _RULES:
    add(f"rule_{_n}", f"select invoice_no, stock_code, quantity, unit_price::double as unit_price from raw where {_c}")
add(
    "dim_date",
    """select strftime(full_date, '%Y%m%d')::int as date_key, full_date, year(full_date)::int as year, quarter(full_date)::int as quarter,
    month(full_date)::int as month, monthname(full_date) as month_name, weekofyear(full_date)::int as week_of_year,
    day(full_date)::int as day_of_month, dayofweek(full_date)::int as day_of_week, dayname(full_date) as day_name,
    dayofweek(full_date) in (0, 6) as is_weekend, year(full_date)::int as fiscal_year, quarter(full_date)::int as fiscal_quarter from calendar""",
)
add("dim_country", "select country_name, total_customers, total_orders, total_revenue::double as total_revenue from dim_country")
add(
    "dim_product",
    f"select stock_code, description, {dbl('avg_unit_price', 'total_revenue')}, total_quantity_sold, first_sold_date, last_sold_date from dim_product",
)
add(
    "dim_customer",
    f"select customer_id, first_purchase_date, last_purchase_date, total_orders, {dbl('total_revenue', 'avg_order_value')} from dim_customer",
)
for _n in ("fact_sales", "fact_sales_lookup"):
    add(
        _n,
        f"select date_key, customer_id, stock_code, country_name, invoice_no, quantity, {dbl('unit_price', 'line_total')}, is_cancelled, is_return from fact",
    )
add(
    "predicate_forms",
    """select invoice_no, stock_code, country, quantity from stg where invoice_no like '1_0%' and not coalesce(is_return, false)
    and country in ('FRANCE', 'GERMANY', 'JAPAN', 'Unknown') and quantity between 5 and 40""",
)
add("dashboard_filter", "select full_date, total_revenue::double as total_revenue, total_orders from kpis, today where full_date between today - 90 and today")
add("dashboard_filter_sets", "select customer_id, rfm_segment, frequency from rfm where rfm_segment in ('Champions', 'At Risk') and frequency >= 3")
add("severity_order", "select anomaly_date, metric_name, severity, priority from anomalies")

# --- keyed writes ------------------------------------------------------------------------------

_LATEST = """select l_partkey as part, round(l_extendedprice, 2) as price, l_orderkey * 10 + l_linenumber as version from lineitem
qualify row_number() over (partition by l_partkey order by l_orderkey * 10 + l_linenumber desc, round(l_extendedprice, 2) desc) = 1"""
add("latest_per_key", _LATEST)
add(
    "upsert_keyed",
    """with u as (select user_id as customer, value as amount, event_id as version from events qualify row_number() over (partition by user_id order by event_id desc) = 1)
    select * from u union all select c_custkey, round(c_acctbal, 2), -1 from customer where c_custkey not in (select customer from u)""",
)
add(
    "insert_if_absent",
    """select p_partkey as part, case when p_partkey % 3 <> 0 then round(p_retailprice, 2) else -1.0 end::double as price,
    (p_partkey % 3 = 0)::bigint as version from part""",
)
add(
    "acknowledge_anomaly",
    """select anomaly_date, metric_name, hit as acknowledged, case when hit then 'analyst' end as acknowledged_by
    from (select *, metric_name = 'total_revenue' and anomaly_date = max(anomaly_date) filter (where metric_name = 'total_revenue') over () as hit from anomalies)""",
)
add("upsert_buckets", ORACLE["upsert_keyed"])
add("load_raw_append", "select o_orderkey, o_custkey, year(o_orderdate)::int as year from orders")
add("read_table", "select s_suppkey, s_nationkey from supplier")
add("new_dim_members", "select customer_id from dim_customer where first_purchase_date >= date '1996-01-01'")
add(
    "scd1_aggregate_update",
    f"""select customer_id, first_purchase_date, last_purchase_date, d.total_orders, {dbl('d.total_revenue', 'd.avg_order_value').replace('as d.', 'as ')},
    r_score as rfm_recency_score, f_score as rfm_frequency_score, m_score as rfm_monetary_score, rfm_segment
    from dim_customer d left join rfm using (customer_id)""",
)
add(
    "merge_dimension",
    f"""with n as (select stock_code, sum(case when {VALID} then quantity else 0 end)::bigint as total_quantity_sold, {VALID_SUM} as total_revenue,
        min(invoice_date)::date as first_sold_date, max(invoice_date)::date as last_sold_date, invoice_date < timestamp '1997-01-01' as early from stg group by stock_code, early)
    select stock_code, coalesce(b.total_quantity_sold, a.total_quantity_sold) as total_quantity_sold,
           coalesce(b.total_revenue, a.total_revenue)::double as total_revenue, coalesce(b.first_sold_date, a.first_sold_date) as first_sold_date,
           coalesce(b.last_sold_date, a.last_sold_date) as last_sold_date
    from (from n where early) a full join (from n where not early) b using (stock_code)""",
)
add("kpi_new_customers_join", "select full_date, unique_customers, new_customers from kpis")
add("fact_date_orphans", "select count(*) as orphans from fact where full_date < date '1996-01-01' or full_date > date '1998-12-31'")
add("semi_join", "select stock_code, count(*) as lines from fact where customer_id in (select customer_id from rfm where rfm_segment = 'Champions') group by 1")
add(
    "star_drill",
    f"""select year(full_date)::int as year, country_name, dayname(full_date) as day_name, sum(quantity)::bigint as quantity, sum(line_total)::double as revenue
    from fact where {VALID} group by 1, 2, 3""",
)
add("scalar_cross", "select (select count(*) from kpis) as kpi_days, (select count(*) from rfm) as rfm_customers")

# --- marts -------------------------------------------------------------------------------------

_KPIS = f"""select date_key, full_date, {dbl('total_revenue')}, total_orders, total_items_sold, unique_customers,
{dbl('avg_order_value', 'cancelled_revenue', 'return_revenue', 'cancellation_rate', 'return_rate')}, cancelled_orders, return_orders,
new_customers, repeat_customers from kpis"""
add("mart_daily_kpis", _KPIS)
for _n in ("stream_refresh", "stream_refresh_after_source"):
    add(_n, _KPIS)
add("stream_keeps_raw", "select 'raw_transactions' as table_name, count(*) as row_count from raw union all select 'stg_transactions_clean', count(*) from stg union all select 'fact_sales', count(*) from fact")
add(
    "stream_dq_checks",
    """select unnest(['customer_id_null_rate', 'date_range_check', 'fact_date_integrity', 'mart_daily_kpis_populated', 'raw_row_count', 'staging_retention_rate']) as check_name, 3::bigint as batches,
    unnest([null, null, null, null, (select count(*) from raw), null]) as raw_rows""",
)
add("stream_run_log", "select 'etl_incremental' as run_type, 3::bigint as batches, 3::bigint as lines, count(*) as rows_read from raw")
add(
    "stream_daily_kpis",
    f"""select full_date, {VALID_SUM}::double as total_revenue, sum(case when {VALID} then quantity else 0 end)::bigint as total_items_sold,
    count(*) as lines from fact group by 1""",
)
add(
    "stream_event_days",
    "select ts::date as ds, count(*) as purchases, sum(value::decimal(18,2))::double as amount from events where event_type = 'purchase' group by 1",
)
add("rfm_metrics", "select customer_id, recency_days::int as recency_days, frequency, monetary::double as monetary from rfm_metrics")
add("rfm_scores", "select customer_id, r_score, f_score, m_score from rfm")
add("mart_rfm", "select * replace (monetary::double as monetary, recency_days::int as recency_days) from rfm")
_SWAPPED = SEGMENTS[:6] + [SEGMENTS[7], SEGMENTS[6]] + SEGMENTS[8:]
add("rfm_segment_corrected", f"select customer_id, {segment(1, _SWAPPED)} as rfm_segment, {segment(2, _SWAPPED)} as segment_description from rfm")
add(
    "mart_country_performance",
    f"select country_name, total_orders, total_customers, {dbl('total_revenue', 'avg_order_value', 'revenue_share_pct', 'orders_share_pct')} from country_mart",
)
add(
    "mart_product_performance",
    f"select stock_code, description, {dbl('total_revenue', 'avg_unit_price')}, total_quantity, total_orders, revenue_rank, quantity_rank from product_mart",
)
add("product_ranks", "select stock_code, revenue_rank, quantity_rank from product_mart")
add(
    "product_days",
    f"""select full_date, stock_code, description, prices::double as prices, priced_lines, valid_lines, quantity, revenue::double as revenue
    from (select invoice_date::date as full_date, stock_code, sum(unit_price) as prices, count(unit_price) as priced_lines, count(*) filter (where {VALID}) as valid_lines,
                 sum(case when {VALID} then quantity else 0 end)::bigint as quantity, {VALID_SUM} as revenue from stg group by 1, 2)
    join (select invoice_date::date as full_date, stock_code, description from stg
          qualify row_number() over (partition by invoice_date::date, stock_code order by invoice_date desc, description desc) = 1) using (full_date, stock_code)""",
)
add(
    "country_totals",
    """select c.country_name, c.total_revenue::double as total_revenue, d.total_orders, c.total_orders as live_orders, coalesce(counted_orders, 0) as counted_orders, c.total_customers
    from country_mart c join dim_country d using (country_name)
    left join (select country_name, count(*) as counted_orders from (select invoice_no, min(country_name) as country_name from fact where not is_cancelled group by 1) group by 1) using (country_name)""",
)
add("mart_monthly_trends", f"select * replace ({dbl('total_revenue', 'avg_order_value', 'aov_weighted')}) from monthly")
add("mom_growth", "select year_month, revenue_mom_growth, orders_mom_growth from monthly")
add(
    "yoy_growth",
    f"""select m.year_month, m.total_revenue::double as total_revenue, p.total_revenue::double as prev_year_revenue,
    {growth('m.total_revenue', 'p.total_revenue')} as revenue_yoy_pct, m.total_orders, p.total_orders as prev_year_orders,
    {growth('m.total_orders', 'p.total_orders')} as orders_yoy_pct
    from monthly m left join monthly p on p.year = m.year - 1 and p.month = m.month""",
)
add("duplicate_invoice_lines", "select invoice_no, stock_code, quantity, count(*) as copies from stg group by 1, 2, 3 having count(*) > 1")
_NULLS = "count(*) filter (where customer_id is null)"
_NULL_PCT = half_up(f"{_NULLS} * 100", "count(*)", 2)
add("null_rate", f"select count(*) as total_rows, {_NULLS} as null_rows, {_NULL_PCT} as null_pct from stg")
_KEPT = half_up("(select count(*) from stg) * 100", "(select count(*) from raw)", 2)
add("retention_rate", f"select (select count(*) from raw) as raw_rows, (select count(*) from stg) as staging_rows, {_KEPT} as retention_pct")
_RANGE = "strftime(min(full_date), '%Y-%m-%d') || ' to ' || strftime(max(full_date), '%Y-%m-%d')"
add("date_range", f"select min(full_date) as first_day, max(full_date) as last_day, {_RANGE} as date_range from kpis")
add(
    "metric_pivot_sum",
    """select year(forecast_date)::int as year, sum(predicted_value) filter (where metric_name = 'total_revenue')::double as total_revenue,
    sum(predicted_value) filter (where metric_name = 'total_orders')::double as total_orders from forecast group by 1""",
)


def profile(c: str, numeric: bool) -> str:
    mean = f"round(avg({c}::double), 4)" if numeric else "null::double"
    return f"""select 'stg_transactions_clean' as table_name, '{c}' as column_name, count(*) as total_rows, count(*) - count({c}) as null_count,
    {half_up(f'(count(*) - count({c})) * 100', 'count(*)', 2)} as null_pct, count(distinct {c}) as distinct_count,
    min({c})::varchar as min_value, max({c})::varchar as max_value, {mean} as mean_value from stg"""


add(
    "profile_columns",
    " union all ".join(
        profile(c, c in ("quantity", "unit_price", "customer_id", "line_total"))
        for c in ("invoice_no", "stock_code", "description", "quantity", "unit_price", "customer_id", "country", "line_total")
    ),
)
add(
    "profile_by_month",
    " union all ".join(
        f"select column_name, total_rows, null_count, null_pct, min_value, max_value, {f'round(avg({c}::double), 2)' if n else 'null::double'} as mean_value from ({profile(c, n)}), (select {c} from stg) group by all"
        for c, n in [(c, c in ("quantity", "unit_price", "customer_id", "line_total")) for c in ("invoice_no", "stock_code", "description", "quantity", "unit_price", "customer_id", "country", "line_total")]
    ),
)
add("distinct_values", "select country, count(customer_id) as customers, count(*) as pairs from (select distinct country, customer_id from stg) group by 1")
_COUNTED = {
    "raw_transactions": "raw", "stg_transactions_clean": "stg", "dim_customer": "dim_customer", "dim_product": "dim_product",
    "dim_country": "dim_country", "fact_sales": "fact", "mart_daily_kpis": "kpis", "mart_rfm": "rfm",
}
add("table_counts", " union all ".join(f"select '{n}' as table_name, count(*) as row_count from {p}" for n, p in _COUNTED.items()))
_BUILT = {
    **_COUNTED, "agg_invoices": "invoices", "dim_date": "calendar", "dim_customer_rfm": "dim_customer",
    "mart_country_performance": "country_mart", "mart_product_performance": "product_mart", "mart_monthly_trends": "monthly",
    "agg_countries": "country_mart", "agg_product_days": "(select distinct full_date, stock_code from fact)",
}
add("run_etl", " union all ".join(f"select '{n}' as step_name, count(*) as rows_affected from {p}" for n, p in _BUILT.items()))
add("run_etl_twice", _KPIS)
add(
    "run_etl_twice_log",
    """select 'mart_daily_kpis' as table_name, count(*) as row_count from kpis union all select 'mart_rfm', count(*) from rfm
    union all select 'mart_product_performance', count(*) from product_mart union all select 'ml_forecast_daily', count(*) from forecast_kept
    union all select 'ml_model_runs', count(*) from all_runs""",
)
add(
    "top_k",
    "select invoice_no, sum(line_total)::double as amount from fact group by 1 order by sum(line_total) desc, invoice_no limit 28",
)
add("order_by_case", "select anomaly_date, metric_name, severity from anomalies order by priority, anomaly_date desc, metric_name limit 50")

# --- dashboards ---------------------------------------------------------------------------------

add("revenue_orders_trend", "select full_date as date, total_revenue::double as revenue, total_orders as orders from kpis")
add(
    "revenue_by_country_top10",
    f"select country_name as country, total_revenue::double as revenue, {dbl('revenue_share_pct')} from country_mart order by total_revenue desc, country_name limit 10",
)
add(
    "monthly_summary",
    f"select year_month as month, total_revenue::double as revenue, total_orders as orders, total_customers as customers, {dbl('avg_order_value')} from monthly",
)
add("monthly_distinct_customers", "select strftime(full_date, '%Y-%m') as month, count(distinct customer_id) as customers_distinct from fact group by 1 having count(customer_id) > 0")
add("kpi_total_revenue", "select sum(total_revenue)::double as total_revenue from kpis")
add("kpi_total_orders", "select sum(total_orders)::bigint as total_orders from kpis")
add("kpi_total_customers", "select count(distinct customer_id) as total_customers from dim_customer")
add("kpi_avg_order_value", f"select {money_ratio('sum(avg_order_value)', 'count(*)')} as average_order_value from kpis where avg_order_value > 0")
_PERIODS = f"""select sum(total_revenue) filter (where cur) as cr, sum(total_revenue) filter (where not cur) as pr,
    sum(total_orders) filter (where cur)::decimal(20,2) as co, sum(total_orders) filter (where not cur)::decimal(20,2) as po,
    {dec(money_ratio('sum(aov) filter (where cur)', 'count(aov) filter (where cur)'))} as ca,
    {dec(money_ratio('sum(aov) filter (where not cur)', 'count(aov) filter (where not cur)'))} as pa,
    sum(unique_customers) filter (where cur)::decimal(20,2) as cc, sum(unique_customers) filter (where not cur)::decimal(20,2) as pc
  from (select *, full_date > today - 28 as cur, nullif(avg_order_value, 0) as aov from kpis, today where full_date > today - 56)"""
add(
    "kpi_scorecard_28d",
    f"""with p as ({_PERIODS})
    select 'Revenue' as metric, round(cr, 0)::double as current, round(pr, 0)::double as previous, {growth('cr', 'pr')} as change_pct from p
    union all select 'Orders', co::double, po::double, {growth('co', 'po')} from p
    union all select 'Avg Order Value', ca::double, pa::double, {growth('ca', 'pa')} from p
    union all select 'Unique Customers', cc::double, pc::double, {growth('cc', 'pc')} from p""",
)
add(
    "period_cross",
    """select sum(total_revenue) filter (where full_date > today - 30)::double as current_revenue, sum(total_orders) filter (where full_date > today - 30)::bigint as current_orders,
    sum(total_revenue) filter (where full_date <= today - 30)::double as previous_revenue, sum(total_orders) filter (where full_date <= today - 30)::bigint as previous_orders
    from kpis, today where full_date > today - 60""",
)
add(
    "cancel_return_rates",
    "select full_date as date, round(cancellation_rate * 100, 2)::double as cancellation_rate_pct, round(return_rate * 100, 2)::double as return_rate_pct from kpis",
)
add("new_vs_repeat", "select full_date as date, new_customers, repeat_customers, unique_customers as total_customers from kpis")
_RATE = "((sum({0}) * 10000)::hugeint * 100)"
add(
    "executive_summary",
    f"""select min(full_date) as start_date, max(full_date) as end_date, round(sum(total_revenue), 0)::double as total_revenue,
    sum(total_orders)::bigint as total_orders, sum(unique_customers)::bigint as unique_customers,
    {money_ratio('sum(avg_order_value)', 'count(nullif(avg_order_value, 0))')} as avg_order_value,
    {half_up(_RATE.format('cancellation_rate'), 'count(*) * 10000', 2)} as cancellation_rate_pct,
    {half_up(_RATE.format('return_rate'), 'count(*) * 10000', 2)} as return_rate_pct from kpis""",
)
add(
    "country_top10",
    """select country_name, round(total_revenue, 0)::double as total_revenue, total_orders, total_customers, avg_order_value::double as avg_order_value
    from country_mart c order by c.total_revenue desc, country_name limit 10""",
)
add("rfm_segment_distribution", "select rfm_segment as segment, count(*) as customer_count, sum(monetary)::double as total_revenue from rfm group by 1")
add(
    "rfm_segment_details",
    f"""select rfm_segment as segment, segment_description as description, count(*) as customers, {half_up('sum(recency_days)', 'count(*)', 0)} as avg_recency_days,
    {half_up('sum(frequency)', 'count(*)', 1)} as avg_frequency, {money_ratio('sum(monetary)', 'count(*)')} as avg_monetary from rfm group by 1, 2""",
)
add("rfm_heatmap", "select r_score, f_score, count(*) as customer_count from rfm group by 1, 2")
for _n, _s in (("champions", "Champions"), ("loyal", "Loyal Customers"), ("at_risk", "At Risk"), ("lost", "Hibernating")):
    add(f"rfm_segment_count_{_n}", f"select count(*) as customers from rfm where rfm_segment = '{_s}'")
add(
    "top_customers",
    """select customer_id, rfm_segment as segment, recency_days::int as days_since_last_purchase, frequency as purchase_frequency, monetary::double as total_spend
    from rfm order by monetary desc, customer_id limit 20""",
)
add(
    "high_value_at_risk",
    """select customer_id, monetary::double as lifetime_value, recency_days::int as days_since_purchase, rfm_segment as current_segment,
    'Send re-engagement offer' as recommended_action from rfm where rfm_segment in ('At Risk', 'Cant Lose Them')
    and monetary * (select count(*) from rfm) > (select sum(monetary) * 2 from rfm) order by monetary desc, customer_id limit 20""",
)
_PRODUCT = "stock_code as sku, left(description, 50) as product, total_revenue::double as revenue, total_quantity as quantity_sold"
add("top_products_revenue", f"select {_PRODUCT} from product_mart order by total_revenue desc, stock_code limit 20")
add("top_products_quantity", f"select {_PRODUCT} from product_mart order by total_quantity desc, stock_code limit 20")
_TIER = case([("revenue_rank <= 10", "Top 10"), ("revenue_rank <= 50", "Top 11-50"), ("revenue_rank <= 100", "Top 51-100")], "Others")
add("product_tiers", f"select {_TIER} as tier, count(*) as product_count, sum(total_revenue)::double as total_revenue from product_mart group by 1")
add(
    "revenue_concentration",
    f"select {half_up(cents('sum(total_revenue) filter (where revenue_rank <= 10)') + ' * 100', cents('sum(total_revenue)'), 4)} as top_share_pct from product_mart",
)


def delta(key: str) -> str:
    return f"""select {key}, coalesce(sum(line_total) filter (where full_date > today - 30 and full_date <= today), 0) as c,
        coalesce(sum(line_total) filter (where full_date > today - 60 and full_date <= today - 30), 0) as p from fact, today where {VALID} group by 1"""


_DELTA = f"round(c, 0)::double as current_30d_revenue, round(p, 0)::double as previous_30d_revenue, round(c - p, 0)::double as delta, {growth('c', 'p')} as delta_pct"
add(
    "product_delta_30d",
    f"select stock_code as sku, left(description, 50) as product, {_DELTA} from ({delta('stock_code')}) join dim_product using (stock_code) order by round(c - p, 0) desc, sku limit 20",
)
add("country_delta_30d", f"select country_name as country, {_DELTA} from ({delta('country_name')}) order by round(c - p, 0) desc, country limit 10")
add("daily_product_trend", f"select full_date as date, stock_code as sku, sum(quantity)::bigint as quantity, sum(line_total)::double as revenue from fact where {VALID} group by 1, 2")
add(
    "growing_countries",
    """select country_name as country, round(total_revenue, 0)::double as revenue, total_orders as orders, total_customers as customers, avg_order_value::double as aov,
    'Consider market expansion' as opportunity from country_mart where total_customers > 10 order by total_revenue desc, country_name limit 10""",
)
add(
    "products_needing_attention",
    """select stock_code as sku, left(description, 40) as product, total_orders as orders, round(total_revenue, 0)::double as revenue, avg_unit_price::double as avg_price,
    'Review pricing/promotion' as action from product_mart where revenue_rank between 50 and 200 and total_orders > 10 order by total_revenue desc, stock_code limit 15""",
)
_SEVEN = "over (order by full_date rows between 6 preceding and current row)"
add(
    "moving_avg_7d",
    f"select full_date as date, total_revenue::double as daily_revenue, {half_up(cents('s'), 'n * 100', 4)} as avg_7d from (select *, sum(total_revenue) {_SEVEN} as s, count(*) {_SEVEN} as n from kpis)",
)
add(
    "wow_growth",
    f"""select week, revenue::double as revenue, orders, prev::double as previous_week_revenue, {growth('revenue', 'prev')} as wow_growth_pct
    from (select *, lag(revenue) over (order by week) as prev from (
        select date_trunc('week', full_date)::date as week, sum(total_revenue) as revenue, sum(total_orders)::bigint as orders from kpis group by 1))""",
)
_FC = "f.predicted_value::double as predicted, f.lower_bound::double as lower_bound, f.upper_bound::double as upper_bound"
for _m, _n in (("total_revenue", "revenue"), ("total_orders", "orders")):
    _a = f"{_m}::double as actual" if _m == "total_revenue" else f"{_m} as actual"
    add(
        f"forecast_vs_actual_{_n}",
        f"select coalesce(full_date, forecast_date) as date, {_a}, {_FC} from kpis full join (from forecast_kept where metric_name = '{_m}') f on full_date = forecast_date",
    )
    add(
        f"forecast_14d_{_n}",
        f"""select round(sum(predicted_value), 0)::double as forecasted_{_n}, round(sum(lower_bound), 0)::double as conservative_estimate,
        round(sum(upper_bound), 0)::double as optimistic_estimate from forecast, today
        where metric_name = '{_m}' and forecast_date between today + 1 and today + 14""",
    )
add(
    "forecast_vs_actual_full",
    f"""select coalesce(full_date, forecast_date) as date, total_revenue::double as actual, {_FC}
    from kpis full join forecast_kept f on full_date = forecast_date and metric_name = 'total_revenue'""",
)


def error_pct(actual: str, predicted: str) -> str:
    a, p = cents(actual), cents(predicted)
    return f"case when {actual} > 0 and {predicted} is not null then {half_up(f'abs({a} - {p}) * 100', a, 2)} end"


def combined(day: str, extra: str) -> str:
    return f"""select full_date as {day}, total_revenue::double as actual_revenue, total_orders as actual_orders,
    r.predicted_value::double as forecast_revenue, r.lower_bound::double as revenue_lower, r.upper_bound::double as revenue_upper,
    o.predicted_value::double as forecast_orders, o.lower_bound::double as orders_lower, o.upper_bound::double as orders_upper,
    {error_pct('total_revenue', 'r.predicted_value')} as revenue_error_pct, {error_pct('total_orders', 'o.predicted_value')} as orders_error_pct{extra}
    from kpis left join forecast r on full_date = r.forecast_date and r.metric_name = 'total_revenue'
    left join forecast o on full_date = o.forecast_date and o.metric_name = 'total_orders'"""


add("v_forecast_vs_actual", combined("full_date", ", true as data_freshness").replace("join forecast ", "join forecast_kept "))
add("forecast_vs_actual_combined", combined("date", ""))
add("forecast_kept_vs_actual", combined("date", "").replace("join forecast ", "join forecast_kept "))
add(
    "future_forecasts",
    """select forecast_date as date, metric_name as metric, predicted_value::double as predicted, lower_bound::double as lower_bound, upper_bound::double as upper_bound
    from forecast, today where forecast_date between today + 1 and today + 14 order by metric_name, forecast_date""",
)
add(
    "latest_forecasts",
    f"select forecast_date, metric_name, {dbl('predicted_value', 'lower_bound', 'upper_bound')}, model_name from forecast, today where forecast_date > today",
)
for _n, _back in (("yearly_outlook", 365), ("yearly_outlook_exact_365", 364)):
    add(
        _n,
        f"""with f as (select sum(predicted_value) filter (where metric_name = 'total_revenue') as fr, sum(predicted_value) filter (where metric_name = 'total_orders') as fo
            from forecast, today where forecast_date between today + 1 and today + 365),
        a as (select sum(total_revenue) as ar, sum(total_orders)::decimal(20,2) as ao from kpis, today where full_date >= today - {_back})
        select round(fr, 0)::double as forecast_revenue_365d, round(ar, 0)::double as last_365d_revenue, round(fr - ar, 0)::double as delta_revenue, {growth('fr', 'ar')} as delta_revenue_pct,
        round(fo, 0)::double as forecast_orders_365d, round(ao, 0)::double as last_365d_orders, round(fo - ao, 0)::double as delta_orders, {growth('fo', 'ao')} as delta_orders_pct from f, a""",
    )
add(
    "actual_vs_forecast_30d",
    """select full_date as date, total_revenue::double as value, 'Actual' as type from kpis, today where full_date >= today - 30
    union all select forecast_date, predicted_value::double, 'Forecast' from forecast, today where metric_name = 'total_revenue' and forecast_date > today""",
)
add(
    "anomaly_table",
    "select anomaly_date as date, metric_name as metric, actual_value as actual, expected_value as expected, round(cast(deviation_pct as decimal(12,4)), 1)::double as deviation_pct, anomaly_type as type, severity from anomalies",
)
add("anomaly_by_severity", "select severity, count(*) as count from anomalies group by 1")
_NEWEST = "order by anomaly_date desc, priority, metric_name"
add(
    "latest_anomalies",
    f"select anomaly_date, metric_name, actual_value, expected_value, deviation_pct, anomaly_type, severity, business_interpretation from anomalies {_NEWEST} limit 15",
)
add(
    "latest_anomalies_50",
    f"""select anomaly_date, metric_name, actual_value, expected_value, deviation_pct, anomaly_type, severity, business_interpretation, recommended_action,
    is_weekend, false as acknowledged from anomalies {_NEWEST} limit 50""",
)
add(
    "recent_anomalies_7d",
    "select anomaly_date, metric_name, severity, anomaly_type, deviation_pct from anomalies, alert_day where anomaly_date >= today - 7 order by anomaly_date desc, metric_name limit 10",
)
_SERIOUS = "from anomalies, alert_day where anomaly_date >= today - 7 and severity in ('critical', 'high')"
add("serious_anomalies_7d", f"select anomaly_date, metric_name, severity, anomaly_type, deviation_pct {_SERIOUS}")
add(
    "active_alerts_7d",
    """select anomaly_date, metric_name, actual_value, expected_value, deviation_pct, severity, anomaly_type, null::varchar as probable_cause, business_interpretation,
    recommended_action, priority as priority_order from anomalies, alert_day where anomaly_date >= today - 7""",
)
add(
    "active_alerts_14d",
    """select anomaly_date as date, metric_name as metric, round(actual_value::decimal(20,2), 0)::double as actual, round(expected_value::decimal(20,2), 0)::double as expected,
    round(deviation_pct::decimal(12,4), 1)::decimal(12,1)::varchar || '%' as deviation, upper(anomaly_type) as type, upper(severity) as severity,
    coalesce(business_interpretation, 'Requires investigation') as what_happened, recommended_action from anomalies, alert_day where anomaly_date >= today - 14""",
)
add("critical_alert_count", "select count(*) as critical_alerts from anomalies where severity = 'critical'")
add(
    "alert_summary",
    f"""select severity, count(*) as alerts, string_agg(strftime(anomaly_date, '%Y-%m-%d') || ' | ' || metric_name || ' | ' || anomaly_type, '; '
    order by strftime(anomaly_date, '%Y-%m-%d') || ' | ' || metric_name || ' | ' || anomaly_type) as details {_SERIOUS} group by 1""",
)


def pct_text(x: str) -> str:
    return f"round({x}::decimal(12,4), 1)::decimal(12,1)::varchar || '%'"


_DONE = "from all_runs where status = 'completed'"
_TRAINED = f"{_DONE} and model_type like 'forecast_%'"
add(
    "model_performance_latest",
    f"""select target_metric as metric, model_type as model, {pct_text('mape')} as model_mape, {pct_text('baseline_mape')} as baseline_mape, {pct_text('improvement')} as improvement,
    train_samples::varchar || ' days' as training_data, strftime(run_timestamp, '%Y-%m-%d %H:%M') as last_trained {_TRAINED} order by run_timestamp desc, target_metric, model_type limit 4""",
)
add(
    "model_comparison",
    f"""select target_metric as metric, model_type as model, round(avg(mape), 2) as avg_mape, round(avg(baseline_mape), 2) as avg_baseline_mape,
    round(avg(improvement), 2) as avg_improvement_pct {_TRAINED} group by 1, 2""",
)
_PERFORMANCE = f"""select model_type, target_metric, count(*) as total_runs, round(avg(mape), 4) as avg_mape, min(mape) as best_mape, round(avg(improvement), 4) as avg_improvement_pct,
    max(run_timestamp) as last_run {_DONE} group by 1, 2"""
add("v_model_performance", _PERFORMANCE)
_RUNS = "model_type, target_metric, train_start_date, train_end_date, train_samples, mape, smape, baseline_mape, improvement as improvement_vs_baseline_pct"
add("model_runs_latest", f"select {_RUNS}, '1' as model_version, '1' as code_version, run_timestamp, status from all_runs order by run_timestamp desc, run_id limit 20")
add("record_model_runs", f"select run_id, {_RUNS}, rmse, mae, status, notes from all_runs")
add("chart_model_performance", f"select target_metric, model_type, round(avg(avg_mape), 4) as avg_mape, min(best_mape) as best_mape from ({_PERFORMANCE}) group by 1, 2")
# Tables the second run refreshed, those of the training too.
_LOGGED = {**_BUILT, "backtest_days": "bt_days", "ml_backtest_results": "(select * from bt_days union all select * from bt_days_e)", "ml_forecast_daily": "forecast_kept", "ml_model_runs": "all_runs",
           "ml_anomalies_daily": "(select anomaly_date, metric_name from anomalies union select anomaly_date, metric_name from anomalies_e)"}
_LOG = " union all ".join(f"select '{n}' as table_name, count(*) as row_count from {p}" for n, p in _LOGGED.items())
add("log_table_refresh", f"select table_name, 'second' as refresh_run_id, row_count, 'full' as refresh_type from ({_LOG})")
add("v_dashboard_freshness", f"select table_name, row_count, 'outdated' as freshness_status from ({_LOG})")
add("data_freshness", f"select table_name as data_source, row_count as records, 'Stale' as status from ({_LOG}) where table_name in ('mart_daily_kpis', 'mart_rfm', 'ml_forecast_daily')")
add("last_data_date", "select max(full_date) as last_data_date, count(*) as total_records from kpis")

# --- charts --------------------------------------------------------------------------------------

add("chart_total_revenue", "select sum(total_revenue)::double as sum_total_revenue from kpis")
add("chart_total_orders", "select sum(total_orders)::bigint as sum_total_orders from kpis")
add("chart_avg_order_value", "select round(avg(avg_order_value::double), 4) as avg_order_value from kpis")
add("chart_revenue_trend", "select full_date, total_revenue::double as sum_total_revenue from kpis order by full_date")
add("chart_revenue_trend_monthly", "select date_trunc('month', full_date)::date as full_date, sum(total_revenue)::double as sum_total_revenue from kpis group by 1")
add("chart_revenue_by_country", "select country_name, total_revenue::double as sum_total_revenue from country_mart")
add("chart_monthly_performance", f"select year_month, {dbl('total_revenue')}, total_orders, {dbl('avg_order_value')} from monthly")
add("chart_total_customers", "select count(distinct customer_id) as customers from rfm")
add("chart_segment_distribution", "select rfm_segment, count(customer_id) as customers from rfm group by 1")
add(
    "chart_segment_performance",
    """select rfm_segment, count(customer_id) as customers, round(avg(recency_days::double), 4) as avg_recency, round(avg(frequency::double), 4) as avg_frequency,
    round(avg(monetary::double), 4) as avg_monetary from rfm group by 1""",
)
add(
    "chart_revenue_forecast",
    """select forecast_date, round(predicted_value::double, 4) as predicted, round(lower_bound::double, 4) as lower, round(upper_bound::double, 4) as upper
    from forecast where metric_name = 'total_revenue'""",
)
add("chart_active_alerts", "select anomaly_date, metric_name, severity, anomaly_type, count(*) as alerts from anomalies, alert_day where anomaly_date >= today - 7 group by 1, 2, 3, 4")

# --- data quality -----------------------------------------------------------------------------------

_DUPES = "(select count(*) from (select 1 from stg group by invoice_no, stock_code, quantity having count(*) > 1))"
_PCT2 = "::decimal(18,2)::varchar || '%'"
# Name, type, table, column, expected, actual, threshold, passed, declared, severity when failed, message
_CHECKS = [
    ("raw_row_count", "row_count", "raw_transactions", None, ">0", "(select count(*) from raw)::varchar", None, "(select count(*) from raw) > 0", "critical", "critical", "case when ok then 'Raw table has ' || a || ' rows' else 'CRITICAL: Raw table is empty!' end"),
    ("staging_retention_rate", "row_count", "stg_transactions_clean", None, ">=85%", _KEPT + _PCT2, 85, f"{_KEPT} >= 85", "warning", "warning", "'Staging retains ' || a || ' of raw records'"),
    ("customer_id_null_rate", "null_rate", "stg_transactions_clean", "customer_id", "15-35%", f"(select {_NULL_PCT} from stg){_PCT2}", None, f"(select {_NULL_PCT} from stg) between 15 and 35", "info", "warning", "'CustomerID null rate: ' || a || ' (anonymous purchases)'"),
    ("duplicate_invoice_lines", "duplicate", "stg_transactions_clean", None, "<1000", f"{_DUPES}::varchar", None, f"{_DUPES} < 1000", "warning", "warning", "'Found ' || a || ' potential duplicate line groups'"),
    ("mart_daily_kpis_populated", "row_count", "mart_daily_kpis", None, ">0", "(select count(*) from kpis)::varchar", None, "(select count(*) from kpis) > 0", "critical", "critical", "case when ok then 'Daily KPIs mart has ' || a || ' days' else 'CRITICAL: Daily KPIs mart is empty!' end"),
    ("mart_rfm_populated", "row_count", "mart_rfm", None, ">0", "(select count(*) from rfm)::varchar", None, "(select count(*) from rfm) > 0", "critical", "critical", "case when ok then 'RFM mart has ' || a || ' customers' else 'CRITICAL: RFM mart is empty!' end"),
    ("date_range_check", "range", "mart_daily_kpis", "full_date", None, f"(select {_RANGE} from kpis)", None, f"(select {_RANGE} from kpis) is not null", "info", "info", "'Data spans: ' || a"),
    ("fact_date_integrity", "referential", "fact_sales", "", "0", "(select count(*) from fact where full_date not in (from calendar))::varchar", None, "(select count(*) from fact where full_date not in (from calendar)) = 0", "critical", "critical", "a || ' fact rows have missing date dimension references'"),
]


def _text(v) -> str:
    return f"'{v}'" if v else "null::varchar"


for _name, _type, _table, _col, _exp, _actual, _thr, _ok, _decl, _fail, _msg in _CHECKS:
    _one = f"""select '{_name}' as check_name, '{_type}' as check_type, '{_table}' as table_name, {_text(_col)} as column_name, {_text(_exp)} as expected_value,
        a as actual_value, {_thr or 'null'}::double as threshold, ok as passed, '{_decl}' as declared_severity, case when ok then 'info' else '{_fail}' end as severity, {_msg} as message
        from (select {_actual} as a, {_ok} as ok)"""
    _CHECKS[_CHECKS.index(next(c for c in _CHECKS if c[0] == _name))] = (_name, _one)
    add("dq_" + _name.removesuffix("_check"), f"select check_name, actual_value, passed, severity from ({_one})")
add("run_dq_checks", " union all ".join(c[1] for c in _CHECKS))
_FIRST_CHECKS = [(n, _FIRST.sub(r"\1\2_e", text)) for n, text in _CHECKS]
_BOTH = " union all ".join([*(f"select 'second' as run_id, passed, severity from ({text})" for _, text in _CHECKS), *(f"select 'first', passed, severity from ({text})" for _, text in _FIRST_CHECKS)])
_STATUSES = f"""select run_id, case when count(*) filter (where not passed and severity = 'critical') > 0 then 'failed'
    when count(*) filter (where not passed and severity = 'warning') > 0 then 'warning' else 'success' end as status,
    count(*) filter (where passed) as checks_passed, count(*) filter (where not passed) as checks_failed,
    count(*) filter (where not passed and severity = 'critical') as critical_failures from ({_BOTH}) group by 1"""
add("v_dq_summary", f"select run_id, 'etl_full' as run_type, status, checks_passed, checks_failed, critical_failures from ({_STATUSES})")
add("run_status_exists", f"select run_id, status from ({_STATUSES})")
add(
    "etl_run_log",
    f"""select run_id, 'etl_full' as run_type, status, run_id as source_file, rows_read, rows_written, rows_read - rows_written as rows_rejected from ({_STATUSES})
    join (select 'second' as run_id, (select count(*) from raw) as rows_read, (select count(*) from stg) as rows_written
          union all select 'first', (select count(*) from raw_e), (select count(*) from stg_e)) using (run_id)""",
)

# --- time series -------------------------------------------------------------------------------------

add("unpivot_metrics", "select metric_name, ds, value from series")
add(
    "fill_daily_gaps",
    f"""with sales as (select country_name, full_date as ds, sum(line_total)::double as value from fact where {VALID} group by 1, 2)
    select k.country_name, c.full_date as ds, coalesce(value, 0) as value
    from (select country_name, min(ds) as lo, max(ds) as hi from sales group by 1) k join calendar c on c.full_date between lo and hi
    left join sales s on s.country_name = k.country_name and s.ds = c.full_date""",
)
add("naive_weekly_forecast", "select metric_name, ds, step, predicted, lower_bound, upper_bound from fc28")
add("naive_weekly_forecast_many", "select stock_code, step, predicted from fc_products")
add("train_test_split_tail", "select metric_name, ds, value from split where is_test")
add("forecast_errors", "select metric_name, round(mape, 4) as mape, round(smape, 4) as smape, round(rmse, 4) as rmse, round(mae, 4) as mae, test_samples from errors")
for _e in ("mape", "smape", "rmse", "mae"):
    add(f"eval_{_e}", f"select metric_name, round({_e}, 4) as {_e} from errors")
add("improvement_pct", "select metric_name, model_type, round(improvement, 4) as improvement_pct from bt_scores")
add(
    "backtest_native",
    """select metric_name, model_type, mape, smape, rmse, mae, baseline_mape, baseline_rmse, test_samples,
    round(coalesce(case when raw_base > 0 then (raw_base - raw_mape) / raw_base * 100 end, 0), 2) as improvement_pct from bt_scores""",
)
add("select_best_model", "select country_name, model_type, mape from bc_best")
add("weekday_mean_forecast", "select metric_name, ds, step, predicted, lower_bound, upper_bound from fc28_models_weekday_mean")
add("smoothing_forecast", "select metric_name, ds, step, predicted, lower_bound, upper_bound from fc28_models_smoothing")
add("daytype_rolling_stats", "select metric_name, ds, round(rolling_mean, 4) as rolling_mean, round(rolling_std, 4) as rolling_std from five_roll")
add("daytype_baseline", "select metric_name, ds, is_weekend, round(baseline, 4) as baseline from five_roll")
add(
    "anomaly_zscore",
    "select metric_name, ds, day_of_week::int as day_of_week, is_weekend, round(expected, 4) as expected, round(std, 4) as std, round(z_score, 4) as z_score, deviation_pct from two_z",
)
_SHOWN = "anomaly_date, metric_name, actual_value, expected_value, deviation_pct, anomaly_type, severity, is_weekend, day_of_week::int as day_of_week, business_interpretation, recommended_action"
add("detect_anomalies", f"select {_SHOWN} from anomalies")
add("detect_anomalies_zscore", f"select {_SHOWN} from ({detected('two', '1.45', robust=False)})")
add("detect_anomalies_lookback", f"select {_SHOWN} from ({detected('recent')})")
add("lookback_filter", "select metric_name, ds, value from series, today where ds >= today - 30")
add(
    "ml_backtest_results",
    """select metric_name, model_type, origin::int as origin, ds as prediction_date, round(actual, 2) as actual_value, predicted as predicted_value,
    round(abs(actual - predicted), 2) as absolute_error, round(case when actual <> 0 then abs(actual - predicted) / abs(actual) * 100 end, 4) as percentage_error
    from bt_days""",
)
add("ml_forecast_daily", "select forecast_date, metric_name, predicted_value::double as predicted_value, model_name from forecast")
