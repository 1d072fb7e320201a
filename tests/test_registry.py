import pytest

from millrace.registry import ENTITIES, LOOKUPS, TABLES, check_mode, with_ancestors


def test_fifteen_tables_with_distinct_names_and_paths():
    assert len(LOOKUPS) == 11 and len(ENTITIES) == 4
    assert len({spec.table for spec in TABLES.values()}) == 15
    assert len({spec.path for spec in TABLES.values()}) == 15


def test_child_lookups_carry_the_parent_id():
    assert LOOKUPS["city"].columns == ("City_ID", "City_Name", "State_ID")
    assert LOOKUPS["city"].ancestry == ("City", "State/Province", "Country")
    assert LOOKUPS["brand"].columns == ("Brand_ID", "Brand_Name")


def test_ancestors_come_along():
    assert with_ancestors(["city"]) == ["country", "state_provinces", "city"]
    assert with_ancestors(["brand", "product_type"]) == ["category", "brand", "product_type"]


def test_unknown_mode_is_refused():
    with pytest.raises(ValueError):
        check_mode("by_guess")
