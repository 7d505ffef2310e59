"""Names of ranked competitor stores are looked up in every price feed."""

from __spark_entry__ import queries
from registry.roles import Roles

SF_DIR = "/root/testdata/sf0.001"


def test_stores_of_every_feed_are_found(spark):
    r = Roles(spark, SF_DIR)
    named = lambda df: {f"{x.comp_source}-{x.comp_store}" for x in df.select("comp_source", "comp_store").distinct().collect()}
    ranked, priced = named(r.cats.matrix), named(r.prices)
    rows = queries()["store_name_reconcile_all_feeds"](spark, SF_DIR).collect()
    assert {x.comp_name_in_matrix for x in rows} == ranked
    assert {x.comp_name_in_feeds for x in rows} - {None} == ranked & priced
    assert {x[:2] for x in ranked & priced} == {x[:2] for x in priced}
