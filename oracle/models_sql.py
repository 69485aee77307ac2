"""DuckDB SQL twins of the Spark jobs, used only as an independent correctness oracle.

Each builder returns CTE text over the driver's pre-registered views (orders, customer, lineitem,
...). ``sfx`` keeps CTE names apart when one statement needs the models at two points in time.
"""

from __future__ import annotations

AS_OF = "2001-07-01 00:00:00"
PREV = "2001-06-01 00:00:00"   # the earlier run used by incremental, history and compare queries


def ts(t: str) -> str:
    return f"TIMESTAMP '{t}'"


def bronze(sfx: str = "", cutoff: str | None = None) -> str:
    cut = f"where _ingestion_timestamp <= {ts(cutoff)}" if cutoff else ""
    return f"""
raw_orders{sfx} as (select * from (
  select o_orderkey as order_id, o_custkey as customer_id,
    case when o_orderkey % 20 = 13 then 'test' when o_orderkey % 20 = 17 then 'Refunded'
         when o_orderkey % 7 = 0 then ' pending' when o_orderkey % 7 = 1 then 'Confirmed'
         when o_orderkey % 7 = 2 then 'shipped ' when o_orderkey % 7 = 3 then 'cancelled' else 'DELIVERED' end as order_status,
    cast(cast(cast(floor(round(o_totalprice * 100) / case o_orderkey % 4 when 0 then 20000 when 1 then 1000 when 2 then 100 else 1 end) as bigint) as decimal(18,2)) * cast(0.01 as decimal(3,2)) as decimal(22,4)) as order_amount_eur,
    cast(o_orderdate as timestamp) as order_timestamp, cast(o_orderdate as timestamp) + interval 1 day as _ingestion_timestamp,
    'orders/v1' as _source_file
  from orders
  union all
  select o_orderkey, o_custkey, 'delivered',
    cast(cast(cast(round(o_totalprice * 100) as bigint) as decimal(18,2)) * cast(0.01 as decimal(3,2)) as decimal(22,4)),
    cast(o_orderdate as timestamp), cast(o_orderdate as timestamp) + interval 5 day, 'orders/v2'
  from orders where o_orderkey % 10 = 0) r {cut}),
raw_customers{sfx} as (select * from (
  select c_custkey as customer_id, concat(' ', lower(c_mktsegment)) as first_name, concat(upper(c_name), ' ') as last_name,
    concat(' User', cast(c_custkey as varchar), '@Example.COM ') as email,
    case c_nationkey % 5 when 0 then 'de ' when 1 then 'FR' when 2 then ' nl' when 3 then 'Be' else 'es' end as country_code,
    case c_mktsegment when 'BUILDING' then 'PREMIUM ' when 'FURNITURE' then 'wholesale' when 'HOUSEHOLD' then 'Internal' else ' standard' end as customer_segment,
    timestamp '1994-01-01 00:00:00' as created_at, timestamp '1994-06-01 00:00:00' as updated_at, timestamp '1994-06-02 00:00:00' as _ingestion_timestamp
  from customer
  union all
  select c_custkey, 'anna', 'novak', concat('anna', cast(c_custkey as varchar), '@example.org'), 'nl', 'premium',
    timestamp '1994-01-01 00:00:00', timestamp '1999-06-01 00:00:00', timestamp '1999-06-02 00:00:00'
  from customer where c_custkey % 15 = 0
  union all
  select c_custkey + 10000000, 'new', 'buyer', concat('new', cast(c_custkey as varchar), '@example.org'), 'fr', 'standard',
    timestamp '2001-01-01 00:00:00', timestamp '2001-01-01 00:00:00', timestamp '2001-01-02 00:00:00'
  from customer where c_custkey % 50 = 0) r {cut}),
raw_transactions{sfx} as (select * from (
  select l_orderkey * 10 + l_linenumber as transaction_id, l_orderkey as order_id,
    case l_linenumber when 1 then 'card' when 2 then ' Bank_Transfer' when 3 then 'APPLE_PAY' when 4 then 'google_pay ' when 5 then 'voucher' else 'CRYPTO' end as payment_method,
    case when l_partkey % 40 = 0 then cast(0 as decimal(18,2)) else cast(l_extendedprice as decimal(18,2)) end as transaction_amount_eur,
    case when l_suppkey % 50 = 0 then 'chargeback' when l_suppkey % 50 = 1 then ' failed' when l_returnflag = 'R' and l_linestatus = 'F' then 'Refunded'
         when l_returnflag = 'N' and l_linestatus = 'O' then 'pending' else 'completed' end as transaction_status,
    cast(l_shipdate as timestamp) as transaction_timestamp, cast(l_shipdate as timestamp) + interval 1 hour as _ingestion_timestamp
  from lineitem) r {cut})"""


def initcap(x: str) -> str:
    """One-word title case (the fixtures hold single words)."""
    return f"(upper(left(trim({x}), 1)) || lower(substr(trim({x}), 2)))"


def _latest(table: str, key: str, newest_first: str) -> str:
    """The winning version of each key."""
    return f"(select * from {table} qualify row_number() over (partition by {key} order by {newest_first}) = 1)"


def _clean(x: str) -> str:
    return f"upper(trim({x}))"


def _eur(x: str) -> str:
    return f"cast({x} as decimal(18,2))"


def silver(sfx: str = "", as_of: str = AS_OF) -> str:
    """Blueprint 2.2 and 2.3: the newest version of a key is judged, and older ones never come back."""
    now = ts(as_of)
    orders = _latest(f"raw_orders{sfx}", "order_id", "_ingestion_timestamp desc nulls last, _source_file desc nulls last")
    people = _latest(f"raw_customers{sfx}", "customer_id", "updated_at desc nulls last, _ingestion_timestamp desc nulls last")
    payments = _latest(f"raw_transactions{sfx}", "transaction_id",
                       "_ingestion_timestamp desc nulls last, transaction_amount_eur desc nulls last, "
                       "payment_method asc nulls first, transaction_status asc nulls first")
    steps = " + ".join(f"cast({_eur('order_amount_eur')} >= {limit} as int)" for limit in (50, 500, 5000))
    return f"""
stg_orders{sfx} as (
  select order_id::varchar as order_id, customer_id::varchar as customer_id, {_eur('order_amount_eur')} as order_amount_eur,
    {_clean('order_status')} as order_status, order_timestamp, order_timestamp::date as order_date,
    coalesce(['small', 'medium', 'large', 'enterprise'][1 + {steps}], 'enterprise') as order_size_band,
    _ingestion_timestamp, _source_file, {now} as _dbt_loaded_at
  from {orders} v
  where not list_contains(['TEST', 'DUMMY', 'CANCELLED_TEST'], {_clean('order_status')}) and order_timestamp <= {now}),
stg_customers{sfx} as (
  select customer_id::varchar as customer_id, first as first_name, last as last_name, lower(trim(email)) as email,
    first || ' ' || last as full_name, {_clean('country_code')} as country_code,
    {initcap('customer_segment')} as customer_segment,
    coalesce({_clean('customer_segment')} = 'PREMIUM', false) as is_premium_customer,
    created_at, updated_at, _ingestion_timestamp, {now} as _dbt_loaded_at
  from (select *, {initcap('first_name')} as first, {initcap('last_name')} as last from {people} v) n
  where length(customer_id::varchar) > 0),
stg_transactions{sfx} as (
  select transaction_id::varchar as transaction_id, order_id::varchar as order_id, method as payment_method,
    {_eur('transaction_amount_eur')} as transaction_amount_eur, state as transaction_status,
    coalesce(state = 'COMPLETED', false) as is_successful,
    coalesce(list_contains(['CARD', 'APPLE_PAY', 'GOOGLE_PAY'], method), false) as is_digital_payment,
    transaction_timestamp, transaction_timestamp::date as transaction_date, _ingestion_timestamp, {now} as _dbt_loaded_at
  from (select *, {_clean('payment_method')} as method, {_clean('transaction_status')} as state from {payments} v) n
  where transaction_id is not null and {_eur('transaction_amount_eur')} > 0)"""


def most_frequent(rows: str, key: str, value: str) -> str:
    """Per key the value seen most often, the smallest of equally frequent ones."""
    return (f"(select {key}, {value} from {rows} where {value} is not null group by {key}, {value} "
            f"qualify row_number() over (partition by {key} order by count(*) desc, {value}) = 1)")


def zero_eur(x: str) -> str:
    return f"cast(coalesce({x}, 0) as decimal(38,2))"


def dim(sfx: str = "", as_of: str = AS_OF) -> str:
    """One row per customer; orders are added up by day first, then by customer."""
    now = ts(as_of)
    return f"""
customer_days{sfx} as (
  select customer_id, order_date, count(distinct order_id) as n, sum(order_amount_eur) as eur,
    min(order_timestamp) as earliest, max(order_timestamp) as latest
  from stg_orders{sfx} where order_status <> 'CANCELLED' group by all),
customer_orders{sfx} as (
  select customer_id, sum(n)::bigint as n, sum(eur) as eur, min(earliest) as earliest, max(latest) as latest,
    count(order_date) as days
  from customer_days{sfx} group by customer_id),
dim_customers{sfx} as (
  select sha256(coalesce(p.customer_id, '__null_key__')) as customer_sk, p.customer_id, p.full_name,
    sha256(p.email) as email_hash, p.country_code, p.customer_segment, p.is_premium_customer,
    coalesce(n, 0) as lifetime_order_count, {zero_eur('eur')} as lifetime_order_value_eur,
    earliest as first_order_at, latest as last_order_at, coalesce(days, 0) as distinct_order_days,
    case when latest is null then 'never_ordered' when latest < {now} - interval 365 day then 'churned'
         when latest < {now} - interval 90 day then 'lapsing' else 'active' end as customer_status,
    p.created_at, p.updated_at, {now} as _dbt_loaded_at
  from stg_customers{sfx} p left join customer_orders{sfx} using (customer_id))"""


def fct(sfx: str = "", as_of: str = AS_OF, target: str | None = None) -> str:
    """One row per order. Each measure of its payments is taken from the rows it is about.
    ``target``: name of a CTE holding the previous fact; then only the look-back batch is built."""
    recent = f"where order_timestamp >= (select max(order_timestamp) - interval 3 day from {target})" if target else ""
    t = f"stg_transactions{sfx}"
    return f"""
paid_for{sfx} as (
  select order_id, sum(transaction_amount_eur) as eur, max(transaction_timestamp) as latest from {t} where is_successful group by 1),
given_back{sfx} as (
  select order_id, sum(transaction_amount_eur) as eur from {t} where transaction_status = 'REFUNDED' group by 1),
payments_seen{sfx} as (select order_id, count(distinct transaction_id) as n from {t} group by 1),
fct_orders{sfx} as (
  select o.order_id, d.customer_sk, o.customer_id, o.order_date, o.order_timestamp, o.order_status, o.order_size_band,
    o.order_amount_eur, d.customer_segment, d.is_premium_customer, coalesce(s.n, 0) as transaction_count,
    {zero_eur('p.eur')} as paid_amount_eur, {zero_eur('b.eur')} as refunded_amount_eur, p.latest as last_paid_at,
    exists (select 1 from {t} x where x.order_id = o.order_id and x.transaction_status = 'CHARGEBACK') as has_chargeback,
    m.payment_method as primary_payment_method,
    cast(o.order_amount_eur - coalesce(b.eur, 0) as decimal(38,2)) as net_revenue_eur,
    o.order_status = 'DELIVERED' as is_fulfilled, o._ingestion_timestamp, {ts(as_of)} as _dbt_loaded_at
  from (select * from stg_orders{sfx} {recent}) o
  left join payments_seen{sfx} s on s.order_id = o.order_id
  left join paid_for{sfx} p on p.order_id = o.order_id
  left join given_back{sfx} b on b.order_id = o.order_id
  left join {most_frequent(t, 'order_id', 'payment_method')} m on m.order_id = o.order_id
  left join dim_customers{sfx} d on d.customer_id = o.customer_id)"""


def mart(sfx: str = "", as_of: str = AS_OF, fct_name: str | None = None, target: str | None = None) -> str:
    """One row per customer. Look-back features come from one long table (customer, window, count, sum)."""
    now = ts(as_of)
    today = f"cast({now} as date)"
    done = f"delivered{sfx}"
    where = ""
    if target:
        where = (f"where exists (select 1 from {done} r where r.customer_id = d.customer_id and r.order_timestamp >= "
                 f"(select max(_dbt_loaded_at) - interval 3 day from {target}))")

    def pick(column: str, days: int) -> str:
        return f"(select max({column}) from looked_back{sfx} w where w.customer_id = d.customer_id and w.days = {days})"

    counts = ", ".join(f"coalesce({pick('n', k)}, 0) as orders_last_{k}d" for k in (7, 30, 90, 365))
    sums = ", ".join(f"{zero_eur(pick('eur', k))} as revenue_last_{k}d" for k in (30, 90, 365))
    return f"""
{done} as (select * from {fct_name or f"fct_orders{sfx}"} where is_fulfilled),
looked_back{sfx} as (
  select customer_id, days, count(distinct order_id) as n, sum(net_revenue_eur) as eur
  from {done}, (select unnest([7, 30, 90, 365]) as days) w where order_date >= {today} - days group by all),
spent{sfx} as (
  select customer_id, count(distinct order_id) as n, sum(net_revenue_eur) as eur, count(net_revenue_eur) as known,
    sum(refunded_amount_eur) as back, min(order_timestamp) as earliest, max(order_timestamp) as latest,
    max(order_date) - min(order_date) as tenure from {done} group by 1),
disputed{sfx} as (select customer_id, count(distinct order_id) as n from {done} where has_chargeback group by 1),
mart_customer_lifetime{sfx} as (
  select d.customer_id, d.customer_sk, d.country_code, d.customer_segment, d.is_premium_customer, d.customer_status,
    coalesce(s.n, 0) as lifetime_orders, {zero_eur('s.eur')} as lifetime_revenue_eur,
    coalesce(s.eur::double / s.known, 0.0) as avg_order_value_eur, {counts}, {sums},
    coalesce(x.n, 0) as chargeback_count, {zero_eur('s.back')} as total_refunded_eur, x.n is not null as is_high_risk,
    pm.primary_payment_method as preferred_payment_method, sb.order_size_band as typical_order_size,
    cast(coalesce(s.tenure, 0) as bigint) as customer_tenure_days, {today} - s.latest::date as days_since_last_order,
    s.earliest as first_order_at, s.latest as last_order_at, d.created_at as customer_created_at, {now} as _dbt_loaded_at
  from dim_customers{sfx} d
  left join spent{sfx} s on s.customer_id = d.customer_id
  left join disputed{sfx} x on x.customer_id = d.customer_id
  left join {most_frequent(done, 'customer_id', 'primary_payment_method')} pm on pm.customer_id = d.customer_id
  left join {most_frequent(done, 'customer_id', 'order_size_band')} sb on sb.customer_id = d.customer_id
  {where})"""


def models(sfx: str = "", as_of: str = AS_OF, cutoff: str | None = None) -> str:
    """All six models at one point in time, as a CTE list (no leading WITH)."""
    return ",".join([bronze(sfx, cutoff), silver(sfx, as_of), dim(sfx, as_of), fct(sfx, as_of), mart(sfx, as_of)])


def with_models(select: str, sfx: str = "", as_of: str = AS_OF, cutoff: str | None = None) -> str:
    return f"with {models(sfx, as_of, cutoff)}\n{select}"


def incremental_ctes() -> str:
    """Previous run at PREV (Bronze as ingested by then), then incremental fact and mart at AS_OF."""
    prev = models("_p", PREV, PREV)
    cur = ",".join([bronze("_c"), silver("_c", AS_OF), dim("_c", AS_OF), fct("_c", AS_OF, target="fct_orders_p")])
    merged_fct = """
fct_merged as (
  select * from fct_orders_p p where not exists (select 1 from fct_orders_c c where c.order_id = p.order_id)
  union all select * from fct_orders_c where order_id is not null)"""
    mart_src = mart("_c", AS_OF, fct_name="fct_merged", target="mart_customer_lifetime_p")
    merged_mart = """
mart_merged as (
  select * from mart_customer_lifetime_p
  p where not exists (select 1 from mart_customer_lifetime_c c where c.customer_id = p.customer_id)
  union all select * from mart_customer_lifetime_c where customer_id is not null)"""
    return ",".join([prev, cur, merged_fct, mart_src, merged_mart])
