from helpers import AS_OF, customer, customers, orders, payments

from ferrolake.plans import silver


def _o(oid, status="DELIVERED", amount=10, t="2001-01-01 00:00:00", ing="2001-01-02 00:00:00", src="f", cust=1):
    return (oid, cust, status, amount, t, ing, src)


def test_newest_test_version_hides_older_good_version(spark):
    df = orders(spark, [_o(1, "PENDING", ing="2001-01-02 00:00:00"), _o(1, "test", ing="2001-01-03 00:00:00")])
    assert silver.stg_orders(df, AS_OF).count() == 0


def test_newest_future_dated_version_hides_order(spark):
    df = orders(spark, [_o(1, ing="2001-01-02 00:00:00"),
                        _o(1, t="2002-01-01 00:00:00", ing="2001-01-03 00:00:00")])
    assert silver.stg_orders(df, AS_OF).count() == 0


def test_null_status_drops_and_null_amount_is_enterprise(spark):
    df = orders(spark, [_o(1, status=None), _o(2, amount=None)])
    rows = silver.stg_orders(df, AS_OF).collect()
    assert [(r.order_id, r.order_amount_eur, r.order_size_band) for r in rows] == [("2", None, "enterprise")]


def test_size_band_bounds(spark):
    amounts = [49.99, 50.00, 499.99, 500.00, 5000.00]
    df = orders(spark, [_o(i, amount=a) for i, a in enumerate(amounts)])
    got = {r.order_id: r.order_size_band for r in silver.stg_orders(df, AS_OF).collect()}
    assert [got[str(i)] for i in range(5)] == ["small", "medium", "medium", "large", "enterprise"]


def test_null_order_ids_collapse_to_one_row(spark):
    df = orders(spark, [_o(None, ing="2001-01-02 00:00:00"), _o(None, ing="2001-01-03 00:00:00")])
    assert silver.stg_orders(df, AS_OF).count() == 1


def test_normalisation(spark):
    df = orders(spark, [_o(1, status="  shipped ")])
    r = silver.stg_orders(df, AS_OF).first()
    assert r.order_status == "SHIPPED" and str(r.order_date) == "2001-01-01"


def test_customer_key_null_or_empty_dropped_and_latest_wins(spark):
    rows = [customer(None), customer(1, "2000-01-01 00:00:00", first="old"),
            customer(1, "2000-06-01 00:00:00", first=" jean-luc "), customer(2, last=None)]
    out = {r.customer_id: r for r in silver.stg_customers(customers(spark, rows), AS_OF).collect()}
    assert set(out) == {"1", "2"}
    assert out["1"].first_name == "Jean-luc" and out["1"].full_name == "Jean-luc Lee"
    assert out["2"].full_name is None


def test_payments_non_positive_and_null_amounts_dropped(spark):
    t = "2001-01-01 00:00:00"
    df = payments(spark, [(1, 1, "card", 0, "completed", t, t), (2, 1, "card", -5, "completed", t, t),
                          (3, 1, "card", None, "completed", t, t), (4, 1, " apple_pay", 5, "completed", t, t)])
    rows = silver.stg_transactions(df, AS_OF).collect()
    assert [(r.transaction_id, r.is_successful, r.is_digital_payment, r.payment_method) for r in rows] == \
        [("4", True, True, "APPLE_PAY")]


def test_dedup_is_deterministic_on_ties(spark):
    t = "2001-01-01 00:00:00"
    df = payments(spark, [(1, 1, "card", 5, "completed", t, t), (1, 1, "card", 7, "failed", t, t)])
    r = silver.stg_transactions(df, AS_OF).first()
    assert str(r.transaction_amount_eur) == "7.00"


def test_payments_for_orders_equal_full_silver_restricted(spark):
    from conftest import SF_SMALL
    from pyspark.sql import functions as F

    from ferrolake.sources import derived
    raw = derived.raw_transactions(spark, SF_SMALL)
    orders_ = derived.raw_orders(spark, SF_SMALL).where(F.col("order_id") % 3 == 0).select("order_id")
    full = silver.stg_transactions(raw, AS_OF).join(
        orders_.select(F.col("order_id").cast("string").alias("order_id")), "order_id", "left_semi")
    pruned = silver.stg_transactions_for_orders(raw, orders_, AS_OF)
    cols = ["transaction_id", "order_id", "transaction_amount_eur", "transaction_status"]
    assert sorted(full.select(*cols).collect()) == sorted(pruned.select(*cols).collect())
    assert pruned.count() > 0
