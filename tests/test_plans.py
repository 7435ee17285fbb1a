import __spark_entry__ as E
from vellum.plans import FAMILY, ORACLE, QUERIES

SMOKE = "/root/testdata/sf0.001"


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_registry_and_oracles():
    q, o = QUERIES, ORACLE
    assert len(q) >= 60 and set(o) == set(q)
    assert set(q) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())
    assert all(FAMILY[n] for n in q)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["l_orderkey", "l_linenumber", "l_partkey", "o_orderdate", "unit_price", "cost"]
    assert df.count() > 0


def test_no_cross_products_in_join_heavy_queries(spark):
    for name in ("table_similarity", "sieve_roles", "domain_probe", "model_id_prefix_match", "asof_cost_join"):
        p = plan_text(QUERIES[name](spark, SMOKE))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_filters_and_pruning_reach_scan(spark):
    df = QUERIES["latest_per_key"](spark, SMOKE)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), LessThanOrEqual(ts" in p
    scan = QUERIES["embedding_filter"](spark, SMOKE)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<vec_id:bigint,embedding:array<float>,label:int>" in scan


def test_every_query_runs_on_smoke_data(spark):
    for name, fn in QUERIES.items():
        fn(spark, SMOKE).write.format("noop").mode("overwrite").save()
