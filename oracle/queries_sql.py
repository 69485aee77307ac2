"""Oracle SQL per registered query (DuckDB dialect, over the driver's pre-registered views)."""

from __future__ import annotations

from . import models_sql as m

ORACLE: dict[str, str] = {}

ORACLE["src_raw_orders"] = f"with {m.bronze()} select * from raw_orders"
ORACLE["src_raw_customers"] = f"with {m.bronze()} select * from raw_customers"
ORACLE["src_raw_transactions"] = f"with {m.bronze()} select * from raw_transactions"

for _n in ["stg_orders", "stg_customers", "stg_transactions", "dim_customers", "fct_orders",
           "mart_customer_lifetime"]:
    ORACLE[_n] = m.with_models(f"select * from {_n}")

ORACLE["fct_orders_incremental"] = f"with {m.incremental_ctes()} select * from fct_merged"
ORACLE["mart_customer_lifetime_incremental"] = f"with {m.incremental_ctes()} select * from mart_merged"


# The 41 assertions by kind, written down here a second time so that a change of the job's list is noticed.
_STATUS = "'PENDING', 'CONFIRMED', 'SHIPPED', 'DELIVERED', 'CANCELLED', 'REFUNDED'"
_HEALTH = "'active', 'lapsing', 'churned', 'never_ordered'"
_BROKEN = {   # kind -> (model.column, what makes a known value fail)
    "accepted_values": [(c, "{} not in (" + v + ")") for c, v in (
        ("stg_orders.order_status", _STATUS), ("fct_orders.order_status", _STATUS),
        ("stg_orders.order_size_band", "'small', 'medium', 'large', 'enterprise'"),
        ("stg_customers.customer_segment", "'Standard', 'Premium', 'Wholesale', 'Internal'"),
        ("stg_transactions.transaction_status", "'PENDING', 'COMPLETED', 'FAILED', 'REFUNDED', 'CHARGEBACK'"),
        ("stg_transactions.payment_method", "'CARD', 'BANK_TRANSFER', 'APPLE_PAY', 'GOOGLE_PAY', 'VOUCHER', 'CRYPTO'"),
        ("dim_customers.customer_status", _HEALTH), ("mart_customer_lifetime.customer_status", _HEALTH))],
    "between": [(c, f"{{0}} < {low} or {{0}} > {high}") for c, low, high in (
        ("stg_orders.order_amount_eur", 0, 1000000), ("stg_transactions.transaction_amount_eur", 0.01, 500000),
        ("dim_customers.lifetime_order_count", 0, 100000), ("fct_orders.net_revenue_eur", -50000, 1000000),
        ("mart_customer_lifetime.lifetime_orders", 0, 100000))],
    "matches_regex": [("stg_customers.email", "not regexp_matches({}, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{{2,}}$')")],
    "length_between": [("stg_customers.country_code", "length({}) <> 2")],
    "relationships": [("fct_orders.customer_sk", "{} not in (select customer_sk from dim_customers)")],
    "of_type": [("stg_orders.order_timestamp", "typeof({}) <> 'TIMESTAMP'")],
}
_KEYS = ["stg_orders.order_id", "stg_customers.customer_id", "stg_transactions.transaction_id", "dim_customers.customer_sk",
         "dim_customers.customer_id", "fct_orders.order_id", "mart_customer_lifetime.customer_id"]
_FILLED = [*_KEYS, "stg_orders.customer_id", "stg_orders.order_amount_eur", "stg_orders.order_status", "stg_orders.order_timestamp",
           "stg_customers.email", "stg_customers.country_code", "stg_transactions.order_id", "stg_transactions.transaction_amount_eur",
           "fct_orders.customer_sk", "fct_orders.net_revenue_eur"]


def _dq_sql(kind: str | None = None) -> str:
    rows = [(c, "not_null", f"count(*) - count({c.split('.')[1]})") for c in _FILLED]
    rows += [(c, "unique", f"(select count(*) from (select 1 from {c.split('.')[0]} where {c.split('.')[1]} is not null "
                           f"group by {c.split('.')[1]} having count(*) > 1))") for c in _KEYS]
    rows += [(c, k, f"count(*) filter (where {c.split('.')[1]} is not null and ({bad.format(c.split('.')[1])}))")
             for k, of in _BROKEN.items() for c, bad in of]
    body = "\nunion all\n".join(
        f"select '{c.split('.')[0]}' as model, '{c.split('.')[1]}' as column_name, '{k}' as test, any_value(n) as failing_rows "
        f"from (select {n} as n from {c.split('.')[0]})" for c, k, n in rows if kind in (None, k))
    return m.with_models(f"select model, column_name, test, cast(failing_rows as bigint) as failing_rows, "
                         f"failing_rows = 0 as passed from (\n{body}\n) r")


ORACLE["dq_report"] = _dq_sql()
for _t in ["not_null", "unique", "accepted_values", "between", "matches_regex", "length_between",
           "relationships"]:
    ORACLE[f"dq_{_t}"] = _dq_sql(_t)

ORACLE["freshness_report"] = f"""with {m.bronze()},
f as (
  select 'raw_orders' as source, max(_ingestion_timestamp) as max_loaded_at, count(*) as row_count, 60 as target_lag_minutes from raw_orders
  union all select 'raw_customers', max(_ingestion_timestamp), count(*), 1440 from raw_customers
  union all select 'raw_transactions', max(_ingestion_timestamp), count(*), 30 from raw_transactions)
select source, max_loaded_at, row_count, lag_minutes, cast(target_lag_minutes as bigint) as target_lag_minutes,
  case when lag_minutes is null then 'error' when lag_minutes > 1440 then 'error' when lag_minutes > 360 then 'warn' else 'pass' end as status,
  coalesce(lag_minutes <= target_lag_minutes, false) as meets_target
from (select *, cast(floor((epoch({m.ts('2001-11-04 05:00:00')}) - epoch(max_loaded_at)) / 60) as bigint) as lag_minutes from f) x"""


def _w(select: str) -> str:
    return m.with_models(select)


def _b(select: str) -> str:
    return f"with {m.bronze()} {select}"


ORACLE["proj_cast_keys"] = _b("select cast(order_id as varchar) as order_id, cast(customer_id as varchar) as customer_id from raw_orders")
ORACLE["proj_money"] = _b("select order_id, cast(round(cast(order_amount_eur as decimal(18,2)), 2) as decimal(18,2)) as order_amount_eur from raw_orders")
ORACLE["proj_timestamps"] = _b("select transaction_id, transaction_timestamp, cast(transaction_timestamp as date) as transaction_date from raw_transactions")
ORACLE["proj_normalise_upper"] = _b("select transaction_id, upper(trim(payment_method)) as payment_method, upper(trim(transaction_status)) as transaction_status from raw_transactions")
ORACLE["proj_normalise_lower"] = _b("select customer_id, lower(trim(email)) as email from raw_customers")
ORACLE["proj_normalise_title"] = _b(f"select customer_id, {m.initcap('first_name')} as first_name, {m.initcap('last_name')} as last_name, {m.initcap('customer_segment')} as customer_segment from raw_customers")
ORACLE["proj_full_name"] = _b(f"select customer_id, {m.initcap('first_name')} || ' ' || {m.initcap('last_name')} as full_name from raw_customers")
ORACLE["proj_size_band"] = _b("""select order_id, order_amount_eur,
  case when cast(order_amount_eur as decimal(18,2)) < 50 then 'small' when cast(order_amount_eur as decimal(18,2)) < 500 then 'medium'
       when cast(order_amount_eur as decimal(18,2)) < 5000 then 'large' else 'enterprise' end as order_size_band from raw_orders""")
ORACLE["proj_flags"] = _w("select transaction_id, is_successful, is_digital_payment from stg_transactions")
ORACLE["proj_defaults"] = _w("select customer_id, lifetime_order_count, lifetime_order_value_eur, distinct_order_days from dim_customers")
ORACLE["proj_net_revenue"] = _w("select order_id, order_amount_eur, refunded_amount_eur, net_revenue_eur from fct_orders")
ORACLE["proj_customer_status"] = _w("select customer_id, last_order_at, customer_status from dim_customers")
ORACLE["proj_days_since"] = _w("select customer_id, last_order_at, days_since_last_order from mart_customer_lifetime")
ORACLE["pii_mask"] = _w("select customer_id, email_hash from dim_customers")
ORACLE["surrogate_key"] = _w("select customer_id, customer_sk from dim_customers")

_DEDUP_O = """(select * from (select *, row_number() over (partition by order_id order by _ingestion_timestamp desc nulls last,
  _source_file desc nulls last) as rn from raw_orders) d where rn = 1)"""
_DEDUP_C = """(select * from (select *, row_number() over (partition by customer_id order by updated_at desc nulls last,
  _ingestion_timestamp desc nulls last) as rn from raw_customers) d where rn = 1)"""
_DEDUP_T = """(select * from (select *, row_number() over (partition by transaction_id order by _ingestion_timestamp desc nulls last,
  transaction_amount_eur desc nulls last, payment_method asc nulls first, transaction_status asc nulls first) as rn
  from raw_transactions) d where rn = 1)"""
ORACLE["filter_test_records"] = _b(f"select cast(order_id as varchar) as order_id, order_status from {_DEDUP_O} x where upper(trim(order_status)) not in ('TEST', 'DUMMY', 'CANCELLED_TEST')")
ORACLE["filter_future"] = _b(f"select cast(order_id as varchar) as order_id, order_timestamp from {_DEDUP_O} x where order_timestamp <= {m.ts(m.AS_OF)}")
ORACLE["filter_valid_key"] = _b(f"select cast(customer_id as varchar) as customer_id, updated_at from {_DEDUP_C} x where customer_id is not null and cast(customer_id as varchar) != ''")
ORACLE["filter_positive"] = _b(f"select cast(transaction_id as varchar) as transaction_id, transaction_amount_eur from {_DEDUP_T} x where cast(transaction_amount_eur as decimal(18,2)) > 0")
ORACLE["filter_not_cancelled"] = _w("select order_id, customer_id, order_status from stg_orders where order_status != 'CANCELLED'")
ORACLE["filter_fulfilled"] = _w("select order_id, customer_id from fct_orders where is_fulfilled")
ORACLE["filter_lookback"] = f"with {m.incremental_ctes()} select * from fct_orders_c"
ORACLE["dedup_orders"] = _b(f"select * exclude (rn, order_id, customer_id), cast(order_id as varchar) as order_id, "
                            f"cast(customer_id as varchar) as customer_id from {_DEDUP_O} x")
ORACLE["dedup_customers"] = _b(f"select * exclude (rn, customer_id), cast(customer_id as varchar) as customer_id from {_DEDUP_C} x")
ORACLE["dedup_transactions"] = _b(f"select * exclude (rn, transaction_id, order_id), cast(transaction_id as varchar) as transaction_id, "
                                  f"cast(order_id as varchar) as order_id from {_DEDUP_T} x")

ORACLE["join_customer_stats"] = _w("""select customer_id, email, n as lifetime_order_count, latest as last_order_at
  from stg_customers left join customer_orders using (customer_id)""")
# An order without payments has neither count nor sum; one whose payments were all kept has 0 refunded.
ORACLE["join_order_payments"] = _w(f"""select order_id, order_amount_eur, s.n as transaction_count,
  case when s.n > 0 then {m.zero_eur('b.eur')} end as refunded_amount_eur
  from stg_orders left join payments_seen s using (order_id) left join given_back b using (order_id)""")
ORACLE["join_order_customer"] = _w("""select o.order_id, o.customer_id, c.customer_sk, c.customer_segment, c.is_premium_customer
  from stg_orders o left join dim_customers c on o.customer_id = c.customer_id""")
ORACLE["join_mart"] = _w("""select customer_id, customer_status, n as lifetime_orders, latest as last_order_at
  from dim_customers left join spent using (customer_id)""")
ORACLE["semi_recent_customers"] = f"with {m.incremental_ctes()} select customer_id, lifetime_orders from mart_customer_lifetime_c"
ORACLE["anti_orphans"] = _w("""select t.transaction_id, t.order_id from stg_transactions t
  where t.order_id is not null and not exists (select 1 from stg_orders o where o.order_id = t.order_id)""")
ORACLE["scalar_subquery_max"] = m.with_models(
    "select max(order_timestamp) as max_order_timestamp, max(order_timestamp) - interval 3 day as lookback_from from fct_orders",
    "", m.PREV, m.PREV)
ORACLE["rolling_sum"] = _w("""select order_id, customer_id, order_date, order_amount_eur,
  cast(sum(order_amount_eur) over (partition by customer_id order by order_date
       range between interval 30 days preceding and current row) as decimal(38,2)) as order_amount_30d from stg_orders""")
# One measure at a time, each counted over the rows it is about and attached to the keys that occur.
ORACLE["agg_order_stats"] = _w("""select customer_id, n as lifetime_order_count, eur::decimal(38,2) as lifetime_order_value_eur,
  earliest as first_order_at, latest as last_order_at, days as distinct_order_days from customer_orders""")
_PAYMENTS = f"""(select order_id, s.n as transaction_count, {m.zero_eur('p.eur')} as paid_amount_eur,
    {m.zero_eur('b.eur')} as refunded_amount_eur, p.latest as last_paid_at,
    order_id in (select order_id from stg_transactions where transaction_status = 'CHARGEBACK') as has_chargeback,
    v.payment_method as primary_payment_method
  from payments_seen s left join paid_for p using (order_id) left join given_back b using (order_id)
  left join {m.most_frequent('stg_transactions', 'order_id', 'payment_method')} v using (order_id))"""
ORACLE["agg_payments"] = _w(f"select * from {_PAYMENTS} a")
ORACLE["agg_conditional"] = _w(f"select order_id, paid_amount_eur, refunded_amount_eur, last_paid_at from {_PAYMENTS} a")
ORACLE["agg_bool_or"] = _w(f"select order_id, has_chargeback from {_PAYMENTS} a")


def _windows(column: str, prefix: str, days: tuple[int, ...], cast: str) -> str:
    """Look-back measures of every customer with delivered orders: a pivot of the long (customer, days) table."""
    picked = ", ".join(f"coalesce(max({column}) filter (where days = {k}), 0)::{cast} as {prefix}_last_{k}d" for k in days)
    return f"(select customer_id, {picked} from spent left join looked_back l using (customer_id) group by customer_id)"


_N_ORDERS = _windows("l.n", "orders", (7, 30, 90, 365), "bigint")
_REVENUE = _windows("l.eur", "revenue", (30, 90, 365), "decimal(38,2)")
_LIFETIME = """(select customer_id, n as lifetime_orders, eur::decimal(38,2) as lifetime_revenue_eur,
    eur::double / known as avg_order_value_eur, back::decimal(38,2) as total_refunded_eur, earliest as first_order_at,
    latest as last_order_at, tenure::bigint as customer_tenure_days from spent)"""
_FAVOURITES = f"""(select customer_id, a.primary_payment_method as preferred_payment_method, b.order_size_band as typical_order_size
  from spent left join {m.most_frequent('delivered', 'customer_id', 'primary_payment_method')} a using (customer_id)
  left join {m.most_frequent('delivered', 'customer_id', 'order_size_band')} b using (customer_id))"""
ORACLE["agg_customer_features"] = _w(f"""select *, coalesce((select x.n from disputed x where x.customer_id = t.customer_id), 0) as chargeback_count
  from {_LIFETIME} t join {_N_ORDERS} o using (customer_id) join {_REVENUE} r using (customer_id) join {_FAVOURITES} f using (customer_id)""")
ORACLE["agg_windowed_counts"] = _w(f"select * from {_N_ORDERS} o")
ORACLE["agg_windowed_sums"] = _w(f"select * from {_REVENUE} r")
ORACLE["agg_windowed_as_of"] = _w("\nunion all\n".join(
    f"select customer_id, " + ", ".join(f"count(*) filter (where order_date >= d - {k}) as orders_last_{k}d" for k in (7, 30, 90, 365))
    + ", " + ", ".join(f"{m.zero_eur(f'sum(net_revenue_eur) filter (where order_date >= d - {k})')} as revenue_last_{k}d" for k in (30, 90, 365))
    + f", {m.ts(t)} as as_of from (select *, {m.ts(t)}::date as d from delivered) x where order_date <= d group by customer_id"
    for t in (m.PREV, m.AS_OF)))
ORACLE["agg_basic"] = _w(f"select * exclude (lifetime_orders, customer_tenure_days) from {_LIFETIME} t")
ORACLE["agg_tenure"] = _w(f"select customer_id, customer_tenure_days from {_LIFETIME} t")
ORACLE["agg_mode"] = _w(f"select * from {_FAVOURITES} f")
ORACLE["agg_count_distinct"] = _w("select customer_id, count(distinct order_date) as distinct_order_days from stg_orders group by customer_id")
ORACLE["safe_divide"] = _w("""select order_id, case when cast(paid_amount_eur as double) = 0 or paid_amount_eur is null then null
  else cast(refunded_amount_eur as double) / cast(paid_amount_eur as double) end as refund_share from fct_orders""")
ORACLE["days_between"] = _w("select customer_id, date_diff('day', cast(created_at as date), cast(updated_at as date)) as days_created_to_updated from stg_customers")


# ---------------------------------------------------------------- table writes, history, audit, publish

_INC = m.incremental_ctes()
ORACLE["silver_view"] = ORACLE["stg_orders"]
ORACLE["gold_overwrite"] = ORACLE["dim_customers"]
ORACLE["incremental_merge"] = f"with {_INC} select * from mart_merged"
ORACLE["partitioned_write"] = f"with {_INC} select * from fct_merged"
ORACLE["late_data_lookback"] = f"with {_INC} select * from fct_merged"
ORACLE["layout_by"] = ORACLE["mart_customer_lifetime"]

_FCT_STRINGS = {"order_id", "customer_sk", "customer_id", "order_status", "order_size_band", "customer_segment",
                "primary_payment_method"}
_FCT_COLUMNS = ["order_id", "customer_sk", "customer_id", "order_date", "order_timestamp", "order_status",
                "order_size_band", "order_amount_eur", "customer_segment", "is_premium_customer",
                "transaction_count", "paid_amount_eur", "refunded_amount_eur", "last_paid_at", "has_chargeback",
                "primary_payment_method", "net_revenue_eur", "is_fulfilled", "_ingestion_timestamp",
                "_dbt_loaded_at"]
ORACLE["analyze_stats"] = _w("\nunion all\n".join(
    f"select '{c}' as column_name, count(*) as row_count, count(*) filter (where {c} is null) as null_count, "
    + (f"cast(max(length({c})) as bigint)" if c in _FCT_STRINGS else "cast(null as bigint)")
    + " as max_length from fct_orders" for c in _FCT_COLUMNS))

ORACLE["audit_append"] = _w(f"""
select 'dim_customers' as model_name, 'prod' as environment, {m.ts(m.AS_OF)} as run_at, count(*) as row_count from dim_customers
union all select 'fct_orders', 'prod', {m.ts(m.AS_OF)}, count(*) from fct_orders
union all select 'mart_customer_lifetime', 'prod', {m.ts(m.AS_OF)}, count(*) from mart_customer_lifetime""")

_MART_COLS = ["customer_sk", "country_code", "customer_segment", "is_premium_customer", "customer_status",
              "lifetime_orders", "lifetime_revenue_eur", "avg_order_value_eur", "orders_last_7d", "orders_last_30d",
              "orders_last_90d", "orders_last_365d", "revenue_last_30d", "revenue_last_90d", "revenue_last_365d",
              "chargeback_count", "total_refunded_eur", "is_high_risk", "preferred_payment_method",
              "typical_order_size", "customer_tenure_days", "days_since_last_order", "first_order_at",
              "last_order_at", "customer_created_at"]
_BOTH = f"with {m.models('_p', m.PREV, m.PREV)}, {m.models()}"
_anydiff = " or ".join(f"a.{c} is distinct from b.{c}" for c in _MART_COLS)
_stack = "\nunion all\n".join(
    f"select '{c}' as column_name, count(*) filter (where a.customer_id is not null and b.customer_id is not null "
    f"and a.{c} is distinct from b.{c}) as values_changed from mart_customer_lifetime_p b full outer join "
    f"mart_customer_lifetime a on a.customer_id = b.customer_id" for c in _MART_COLS)
ORACLE["audit_compare"] = f"""{_BOTH},
j as (select a.customer_id as a_id, b.customer_id as b_id, ({_anydiff}) as any_diff
      from mart_customer_lifetime_p b full outer join mart_customer_lifetime a on a.customer_id = b.customer_id),
t as (select count(*) filter (where b_id is null) as rows_added, count(*) filter (where a_id is null) as rows_removed,
             count(*) filter (where a_id is not null and b_id is not null and any_diff) as rows_changed from j),
c as ({_stack})
select t.rows_added, t.rows_removed, t.rows_changed, c.column_name, c.values_changed from t cross join c"""

_pub_cols = ", ".join(f"a.{c}" for c in _MART_COLS)
ORACLE["feature_publish"] = f"""{_BOTH}
select a.customer_id, {_pub_cols} from mart_customer_lifetime a
left join mart_customer_lifetime_p b on a.customer_id = b.customer_id
where b.customer_id is null or {_anydiff}"""

ORACLE["feature_publish_records"] = f"""select customer_id as key, 'feature-store.customer-features' as topic, * from (
{ORACLE["feature_publish"]}) x"""

_TYPED_CUST = f"""typed as (select cast(customer_id as varchar) as customer_id, {m.initcap('first_name')} as first_name,
  {m.initcap('last_name')} as last_name, lower(trim(email)) as email,
  {m.initcap('first_name')} || ' ' || {m.initcap('last_name')} as full_name, upper(trim(country_code)) as country_code,
  {m.initcap('customer_segment')} as customer_segment, created_at, updated_at, _ingestion_timestamp
  from raw_customers where customer_id is not null)"""
ORACLE["snapshot_scd2"] = f"""with {m.bronze()}, {_TYPED_CUST},
v as (select * exclude (rn) from (select *, row_number() over (partition by customer_id, updated_at
        order by _ingestion_timestamp asc nulls last, first_name, last_name, email, full_name, country_code,
        customer_segment, created_at) as rn from typed) x where rn = 1)
select customer_id, first_name, last_name, email, full_name, country_code, customer_segment, created_at, updated_at,
  updated_at as valid_from, lead(updated_at) over (partition by customer_id order by updated_at asc nulls first) as valid_to,
  lead(updated_at) over (partition by customer_id order by updated_at asc nulls first) is null as is_current
from v"""

# Every customer has at most one version per snapshot, so two snapshots in turn give the same history.
ORACLE["history_from_versions"] = ORACLE["snapshot_scd2"]
ORACLE["seed_load"] = "select cast(n_nationkey as integer) as n_nationkey, n_name, cast(n_regionkey as integer) as n_regionkey from nation"
ORACLE["bronze_ingest_stream"] = _b("select order_id, customer_id, order_status, order_amount_eur, order_timestamp, true as has_audit_columns from raw_orders")

# ---------------------------------------------------------------- lineage and classification

_LINEAGE = """with pl as (select l_orderkey as k, l_linenumber as l, min(l_quantity) as q, min(l_linestatus) as st,
                           min(l_returnflag) as rf from lineitem group by 1, 2),
md as (select k, l, q, st, 'model.p' || cast(k as varchar) || '.line_' || cast(l as varchar) as unique_id,
         'line_' || cast(l as varchar) as name, case when l % 2 = 1 then 'gold' else 'silver' end as schema_name,
         case when k % 3 = 0 then 'main' else 'lake' end as database_name, rf as tags,
         case when l % 2 = 1 then 'line ' || cast(l as varchar) else '' end as description from pl),
mf as (select *, database_name || '.' || schema_name || '.' || name as fqn from md)"""
_RUNS = "(select 1 as r union all select 2) runs"
_RUN_ID = "'run-' || cast({}k as varchar) || '-' || cast(r as varchar) as run_id"
ORACLE["lineage_models"] = _LINEAGE + f"""
select {_RUN_ID.format('')}, unique_id, name, schema_name, database_name, fqn, tags, description from mf, {_RUNS}"""
ORACLE["lineage_columns"] = _LINEAGE + f"""
select {_RUN_ID.format('')}, fqn || '#quantity' as qualified_name, fqn as table_fqn, 'quantity' as column_name,
  'qty ' || cast(cast(q as bigint) as varchar) as description, 'decimal(18,2)' as data_type from mf, {_RUNS}
union all
select {_RUN_ID.format('')}, fqn || '#status', fqn, 'status', st, 'unknown' from mf, {_RUNS}"""
ORACLE["lineage_edges"] = _LINEAGE + f"""
, needed as (select *, case when l > 1 then 'model.p' || cast(k as varchar) || '.line_' || cast(l - 1 as varchar)
                            when k % 5 = 0 then 'model.other.z_' || cast(k as varchar) end as need from mf)
select {_RUN_ID.format('o.')}, 'process://' || o.unique_id as process_name, coalesce(i.fqn, o.need) as input_fqn,
  o.fqn as output_fqn, i.fqn is not null as resolved
from needed o left join mf i on i.unique_id = o.need, {_RUNS} where o.need is not null"""

_EMAIL_FIELD = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
_EMAIL_TEXT = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"


def _classify(table: str, cols: list[str], pattern: str) -> str:
    return "\nunion all\n".join(
        f"select '{table}' as table_name, '{c}' as column_name, count({c}) as non_null, "
        f"count(*) filter (where regexp_matches({c}, '{pattern}')) as matches from {table}" for c in cols)


ORACLE["classify_columns"] = _w(f"""
select table_name, column_name, non_null, matches,
  case when non_null > 0 then matches / non_null end as match_share,
  case when non_null > 0 and matches / non_null >= 0.5 then 'PersonalData.Email' end as tag
from (
{_classify('stg_customers', ['customer_id', 'first_name', 'last_name', 'email', 'full_name', 'country_code', 'customer_segment'], _EMAIL_FIELD)}
union all
{_classify('documents', ['text', 'lang', 'source'], _EMAIL_TEXT)}
) r""")
