import datetime as dt

from ferrolake.operators.audit import audit_compare
from ferrolake.operators.history import history_from_versions, snapshot_scd2
from ferrolake.operators.publish import changed_rows, to_records
from ferrolake.operators.quality import Check, run_checks


def test_checks_find_planted_violations(spark):
    df = spark.createDataFrame([("a", "x@y.org", "DE"), ("a", "bad", "DEU"), (None, None, None)],
                               "k string, email string, cc string")
    checks = [Check("t", "k", "not_null"), Check("t", "k", "unique"),
              Check("t", "email", "matches_regex", {"regex": r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"}),
              Check("t", "cc", "length_between", {"min": 2, "max": 2}),
              Check("t", "cc", "accepted_values", {"values": ["DE"]})]
    got = {(r.column_name, r.test): (r.failing_rows, r.passed) for r in run_checks({"t": df}, checks).collect()}
    assert got == {("k", "not_null"): (1, False), ("k", "unique"): (1, False), ("email", "matches_regex"): (1, False),
                   ("cc", "length_between"): (1, False), ("cc", "accepted_values"): (1, False)}


def _snap(spark, rows):
    return spark.createDataFrame([(k, v, dt.datetime.fromisoformat(u), dt.datetime.fromisoformat(u)) for k, v, u in rows],
                                 "k string, v string, updated_at timestamp, _ingestion_timestamp timestamp")


def test_scd2_sequential_equals_one_pass(spark):
    s1 = _snap(spark, [("a", "1", "2001-01-01 00:00:00"), ("b", "1", "2001-01-01 00:00:00")])
    s2 = _snap(spark, [("a", "2", "2001-02-01 00:00:00"), ("b", "1", "2001-01-01 00:00:00"), ("c", "1", "2001-02-01 00:00:00")])
    h = snapshot_scd2(None, s1, "k")
    h = snapshot_scd2(h, s2, "k")
    one = history_from_versions(s1.unionByName(s2), "k")
    cols = ["k", "v", "updated_at", "valid_from", "valid_to", "is_current"]
    assert sorted(map(tuple, h.select(*cols).collect())) == sorted(map(tuple, one.select(*cols).collect()))
    cur = {r.k: r.v for r in h.where("is_current").collect()}
    assert cur == {"a": "2", "b": "1", "c": "1"} and h.count() == 4


def test_changed_rows_catch_new_all_null_key_and_compare(spark):
    before = spark.createDataFrame([("a", 1, None), ("b", 2, None)], "k string, x int, y int")
    after = spark.createDataFrame([("a", 1, None), ("b", 3, None), ("c", None, None)], "k string, x int, y int")
    assert sorted(r.k for r in changed_rows(before, after, "k").collect()) == ["b", "c"]
    rec = to_records(changed_rows(before, after, "k"), "k").collect()
    assert {r.topic for r in rec} == {"feature-store.customer-features"} and len(rec) == 2
    cmp = {r.column_name: r for r in audit_compare(before, after, "k").collect()}
    assert (cmp["x"].rows_added, cmp["x"].rows_removed, cmp["x"].rows_changed, cmp["x"].values_changed) == (1, 0, 1, 1)
