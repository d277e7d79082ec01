"""Plan shapes that matter at scale."""

from recount.plans.extracts import auth, order, product, user
from recount.operators.counts import row_count
from tests.conftest import optimized_text, plan_text


def test_employee_is_a_semi_join(cat):
    assert "LeftSemi" in optimized_text(auth.auth_employee(cat))


def test_brand_parents_semi_join(cat):
    assert "LeftSemi" in optimized_text(product.brand(cat, with_ids=False))


def test_filters_reach_the_scan(spark):
    from recount.sources.catalog import ParquetCatalog

    c = ParquetCatalog(spark, "/root/testdata/sf0.001")
    df = c["orders"].filter("o_orderstatus = 'F'").select("o_orderkey")
    p = plan_text(df)
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in p


def test_count_reads_no_columns(spark):
    from recount.sources.catalog import ParquetCatalog

    c = ParquetCatalog(spark, "/root/testdata/sf0.001")
    assert "ReadSchema: struct<>" in plan_text(row_count(c["lineitem"]))


def test_rank_one_extracts_use_group_limit(cat):
    for df in (order.cancellation_reason(cat, with_ids=False), user.user(cat), user.employee(cat), product.promotion(cat)):
        assert "WindowGroupLimit" in plan_text(df)


def test_no_sort_under_a_count(cat):
    p = plan_text(row_count(order.order_product(cat)))
    assert "Sort " not in p.replace("SortMergeJoin", "")  # joins may sort; no ORDER BY survives


def test_order_shipment_does_not_fan_out(cat):
    # one row per non-cart order, like the legacy rank-1 over the joined product
    assert order.order_shipment(cat).count() == order.live_orders(cat).count()


def test_order_address_reads_orders_once(cat):
    p = optimized_text(order.order_address(cat))
    assert p.count("Generate explode") == 1 and "Union" not in p


def test_no_registered_query_plans_a_cross_join(spark):
    import __spark_entry__ as entry
    from recount.plans.harness import REGISTRY

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, fn in entry.queries().items():
            if name not in REGISTRY:  # the training-data operators have their own tests
                continue
            p = plan_text(fn(spark, "/root/testdata/sf0.001"))
            assert "CartesianProduct" not in p and "NestedLoopJoin" not in p, name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_orders_go_through_one_join(spark, cat):
    """Country and district meet the addresses, not the doubled orders; its count builds no rows."""
    from recount.plans.suites import order_suite

    text = optimized_text(order.order_address(cat))
    top = text.splitlines()
    first = next(i for i, line in enumerate(top) if "Join" in line)
    assert "address_id" in top[first] and "place_id" in top[first] and sum("Generate explode" in x for x in top) == 1
    spec = next(s for s in order_suite() if s.dest_label == "order_address")
    assert "formatted_address" not in optimized_text(spec.source.count(cat))
    assert "address1" not in optimized_text(spec.source.count(cat)).split("Relation")[0]


def test_cart_lines_go_before_the_variants(cat):
    """The upper join is that with the variants."""
    joins = [line for line in optimized_text(order.order_product(cat)).splitlines() if " Join " in line or "Join LeftOuter" in line or "Join Inner" in line]
    assert "LeftOuter" in joins[0] and "Inner" in joins[1]
