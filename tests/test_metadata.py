import pytest

from basketry.plans import fixtures as fx
from basketry.plans.metadata import prepare_metadata
from conftest import SF001


def test_prepare_all_entities(spark):
    d = SF001
    out = prepare_metadata((), users=fx.raw_users(spark, d), mapping=fx.comp_mid_mapping(spark, d),
                           product=fx.product_raw(spark, d), valid_products=fx.valid_products(spark, d),
                           search_words=fx.search_words(spark, d), category=fx.category_raw(spark, d),
                           deal_item=fx.deal_item_raw(spark, d), prod_category=fx.prod_category(spark, d),
                           filter_words=fx.TEST_FILTER_WORDS)
    assert set(out) == {"user", "product", "category", "deal_item", "prod_category"}
    prods = {r.prod_no for r in out["product"].collect()}
    assert all(r.item_no in prods and r.deal_no in prods for r in out["deal_item"].collect())
    assert all(r.prod_no in prods for r in out["prod_category"].collect())
    assert out["user"].count() == fx.users(spark, d).where("m_id like 'U%'").count()


def test_prepare_needs_product_for_links(spark):
    with pytest.raises(ValueError):
        prepare_metadata(("deal_item",), deal_item=fx.deal_item_raw(spark, SF001))
    with pytest.raises(ValueError):
        prepare_metadata(("nope",))
