"""Sessions: nothing is left behind in them."""


def test_fixtures_leave_no_views_behind(spark):
    from recount.sources.fixtures import FixtureCatalog

    before = {t.name for t in spark.catalog.listTables()}
    FixtureCatalog(spark, "/root/testdata/sf0.001").table("spree_user_addresses").count()
    assert {t.name for t in spark.catalog.listTables()} == before
