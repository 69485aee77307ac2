import datetime as dt
from decimal import Decimal

from ferrolake.sources.bronze import RAW_CUSTOMERS_SCHEMA, RAW_ORDERS_SCHEMA, RAW_TRANSACTIONS_SCHEMA

AS_OF = "2001-07-01 00:00:00"


def ts(s):
    return dt.datetime.fromisoformat(s)


def D(x):
    return None if x is None else Decimal(str(x))


def orders(spark, rows):
    """rows: (order_id, customer_id, status, amount, order_ts, ingest_ts, source_file)"""
    return spark.createDataFrame([(r[0], r[1], r[2], D(r[3]), ts(r[4]) if r[4] else None, ts(r[5]), r[6])
                                  for r in rows], RAW_ORDERS_SCHEMA)


def customers(spark, rows):
    """rows: (customer_id, first, last, email, country, segment, created, updated, ingest)"""
    return spark.createDataFrame([(*r[:6], ts(r[6]), ts(r[7]), ts(r[8])) for r in rows], RAW_CUSTOMERS_SCHEMA)


def payments(spark, rows):
    """rows: (transaction_id, order_id, method, amount, status, tx_ts, ingest_ts)"""
    return spark.createDataFrame([(r[0], r[1], r[2], D(r[3]), r[4], ts(r[5]), ts(r[6])) for r in rows],
                                 RAW_TRANSACTIONS_SCHEMA)


def customer(cid, updated="2000-01-01 00:00:00", first="ann", last="lee"):
    return (cid, first, last, f"u{cid}@x.org", "de", "standard", "1999-01-01 00:00:00", updated, updated)
