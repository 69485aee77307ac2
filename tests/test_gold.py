from helpers import AS_OF, customer, customers, orders, payments

from ferrolake.plans import pipeline


def _bronze(spark, order_rows, customer_rows, payment_rows):
    return {"raw_orders": orders(spark, order_rows), "raw_customers": customers(spark, customer_rows),
            "raw_transactions": payments(spark, payment_rows)}


def test_order_without_payments_and_orphan_customer(spark):
    o = [(1, 99, "DELIVERED", 10, "2001-06-01 00:00:00", "2001-06-02 00:00:00", "f")]
    m = pipeline.models(_bronze(spark, o, [customer(1)], [(9, 5, "card", 1, "completed", "2001-01-01 00:00:00",
                                                           "2001-01-01 00:00:00")]), AS_OF)
    r = m["fct_orders"].first()
    assert (r.transaction_count, str(r.paid_amount_eur), r.has_chargeback, r.primary_payment_method) == (0, "0.00", False, None)
    assert r.customer_sk is None
    from ferrolake.plans.reports import dq_report
    rep = {(x.model, x.column_name, x.test): x.failing_rows for x in dq_report(m).collect()}
    assert rep[("fct_orders", "customer_sk", "not_null")] == 1
    assert rep[("fct_orders", "customer_sk", "relationships")] == 0   # NULL child keys are not orphans


def test_mode_tie_goes_to_smallest(spark):
    t = "2001-06-01 00:00:00"
    o = [(1, 1, "DELIVERED", 10, t, t, "f")]
    p = [(1, 1, "voucher", 1, "completed", t, t), (2, 1, "card", 1, "completed", t, t)]
    m = pipeline.models(_bronze(spark, o, [customer(1)], p), AS_OF)
    assert m["fct_orders"].first().primary_payment_method == "CARD"


def test_status_boundaries_and_never_ordered(spark):
    o = [(1, 1, "DELIVERED", 10, "2001-04-02 00:00:00", "2001-04-02 00:00:00", "f"),   # as_of - 90 d
         (2, 2, "DELIVERED", 10, "2000-07-01 00:00:00", "2000-07-01 00:00:00", "f"),   # as_of - 365 d
         (3, 3, "DELIVERED", 10, "2000-06-30 00:00:00", "2000-06-30 00:00:00", "f")]
    m = pipeline.models(_bronze(spark, o, [customer(i) for i in (1, 2, 3, 4)], []), AS_OF)
    st = {r.customer_id: r.customer_status for r in m["dim_customers"].collect()}
    assert st == {"1": "active", "2": "lapsing", "3": "churned", "4": "never_ordered"}
    mart = {r.customer_id: r for r in m["mart_customer_lifetime"].collect()}
    assert mart["4"].days_since_last_order is None and mart["4"].lifetime_orders == 0
    assert mart["1"].days_since_last_order == 90


def test_net_revenue_identity_at_sf_small(spark):
    from pyspark.sql import functions as F
    from conftest import SF_SMALL
    m = pipeline.models_from_tables(spark, SF_SMALL)
    f = m["fct_orders"].agg(F.sum("net_revenue_eur").alias("n"), F.sum("order_amount_eur").alias("o"),
                            F.sum("refunded_amount_eur").alias("r")).first()
    assert f.n == f.o - f.r
    assert m["dim_customers"].count() == m["dim_customers"].select("customer_id").distinct().count()


def test_late_rows_within_lookback_admitted_older_missed(spark):
    from ferrolake.session import scratch_path
    root = scratch_path(spark, "t-late")
    a = (1, 1, "DELIVERED", 10, "2001-06-10 00:00:00", "2001-06-11 00:00:00", "f")
    late_ok = (2, 1, "DELIVERED", 20, "2001-06-08 00:00:00", "2001-06-20 00:00:00", "f")   # 2 days before max
    late_old = (3, 1, "DELIVERED", 30, "2001-06-01 00:00:00", "2001-06-20 00:00:00", "f")  # 9 days before max
    cust = [customer(1)]
    pipeline.run_full(spark, _bronze(spark, [a], cust, []), "2001-06-12 00:00:00", root)
    run = pipeline.run_incremental(spark, _bronze(spark, [a, late_ok, late_old], cust, []), "2001-06-21 00:00:00", root)
    assert sorted(r.order_id for r in run.tables["fct_orders"].collect()) == ["1", "2"]
    full = pipeline.run_full(spark, _bronze(spark, [a, late_ok, late_old], cust, []), "2001-06-21 00:00:00",
                             scratch_path(spark, "t-late-full"))
    assert sorted(r.order_id for r in full["fct_orders"].collect()) == ["1", "2", "3"]
