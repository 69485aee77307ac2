import json
import os

from ferrolake.session import scratch_path


def test_ingest_twice_no_duplicates(spark):
    from conftest import SF_SMALL
    import __spark_entry__ as e
    df = e.queries()["bronze_ingest_stream"](spark, SF_SMALL)
    raw = e.queries()["src_raw_orders"](spark, SF_SMALL)
    assert df.count() == raw.count()
    assert df.where("not has_audit_columns").count() == 0


def test_manifest_file_per_run(spark):
    from ferrolake.plans.lineage import lineage_columns, lineage_edges, lineage_models
    from ferrolake.sources.manifests import read_manifests
    d = scratch_path(spark, "t-manifests")
    os.makedirs(d)  # written with open() below, so the local folder must exist
    nodes = {
        "model.p.a": {"resource_type": "model", "name": "a", "schema": "silver", "depends_on": {"nodes": ["source.p.raw"]},
                      "columns": {"id": {"description": "key"}}, "tags": ["t"]},
        "model.p.b": {"resource_type": "model", "name": "b", "schema": "gold", "database": "cat",
                      "depends_on": {"nodes": ["model.p.a"]}, "columns": {}, "tags": [], "description": "B"},
        "seed.p.s": {"resource_type": "seed", "name": "s"},
    }
    with open(f"{d}/manifest.json", "w") as f:
        json.dump({"nodes": nodes}, f, indent=2)
    m = lineage_models(read_manifests(spark, d, one_per_file=True))
    assert sorted(r.fqn for r in m.collect()) == ["cat.gold.b", "main.silver.a"]
    c = lineage_columns(m).first()
    assert (c.qualified_name, c.description, c.data_type) == ("main.silver.a#id", "key", "unknown")
    e = lineage_edges(m).collect()
    assert [(x.input_fqn, x.output_fqn) for x in e] == [("main.silver.a", "cat.gold.b")]
    nodes["model.p.b"]["depends_on"]["nodes"].append("model.other.z")
    for run in ("r1", "r2"):
        with open(f"{d}/{run}.json", "w") as f:
            json.dump({"metadata": {"invocation_id": run}, "nodes": nodes}, f)
    m = lineage_models(read_manifests(spark, d, one_per_file=True)).where("run_id in ('r1', 'r2')")
    assert m.count() == 4
    e = sorted((x.run_id, x.input_fqn, x.output_fqn, x.resolved) for x in lineage_edges(m).collect())
    assert e == [(r, i, "cat.gold.b", i.startswith("main")) for r in ("r1", "r2") for i in ("main.silver.a", "model.other.z")]


def test_lineage_of_manifests_is_small_and_read_once(spark):
    """What the queries store of the manifests is a small part of their text; a document is parsed once per query, and the
    edges come from one scan and one shuffle. Edges given twice count once; a model described twice has its first name."""
    import glob
    import os

    from ferrolake.plans import catalog
    from ferrolake.plans.lineage import lineage_edges, lineage_models
    from ferrolake.session import scratch_path
    from ferrolake.sources import derived
    from ferrolake.sources.manifests import read_manifests

    sf = scratch_path(spark, "t-sf")
    spark.range(4000).selectExpr("id div 4 as l_orderkey", "cast(id % 4 + 1 as int) as l_linenumber", "cast(id % 50 as double) as l_quantity",
                                 "'O' as l_linestatus", "'N' as l_returnflag").write.parquet(f"{sf}/lineitem.parquet")
    edges = catalog.QUERIES["lineage_edges"](spark, sf)
    path = edges.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
    stored = sum(os.path.getsize(f) for f in glob.glob(f"{path}/part-*"))
    text = derived.run_manifests(spark, sf).selectExpr("sum(octet_length(value))").first()[0]
    assert stored < text / 5
    for name in ("lineage_models", "lineage_columns", "lineage_edges"):
        plan = catalog.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json") == 1 and plan.count("FileScan text") == 1
        assert plan.count("Exchange") == (name == "lineage_edges")

    d = scratch_path(spark, "t-manifests")
    b = '{"metadata": {"invocation_id": "r"}, "nodes": {"model.b": {"resource_type": "model", "name": "b", "schema": "%s", "depends_on": {"nodes": ["model.a", "model.a"]}}}}'
    a = '{"metadata": {"invocation_id": "r"}, "nodes": {"model.a": {"resource_type": "model", "name": "a", "schema": "%s"}}}'
    spark.createDataFrame([(b % "s",), (b % "s",), (a % "y",), (a % "x",)], "value string").write.text(d)
    got = lineage_edges(lineage_models(read_manifests(spark, d, one_per_file=False, without=("columns", "tags", "description")))).collect()
    assert [tuple(r) for r in got] == [("r", "process://model.b", "main.x.a", "main.s.b", True)]
