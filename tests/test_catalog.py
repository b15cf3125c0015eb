from datetime import date, datetime

import pytest

from mentionkit.catalog import AI_TOOLS, Entity, EntityCatalog, catalog_key_gaps


def test_default_catalog_is_complete():
    assert len(AI_TOOLS.entities) == 12
    assert all(type(e.start) is date for e in AI_TOOLS.entities)
    assert sum(len(e.strong) for e in AI_TOOLS.entities) == 35
    assert sum(len(e.weak) for e in AI_TOOLS.entities) == 9
    assert len(AI_TOOLS.context) == 28 and len(AI_TOOLS.exclusions) == 5


@pytest.mark.parametrize(
    "entities",
    [
        (Entity("A", ("x",)), Entity("A", ("y",))),
        (Entity("A"),),
        (Entity("A", ("Upper",)),),
        (Entity("A", ("",)),),
        (Entity("A", ("x",), (), datetime(2024, 1, 1)),),
    ],
)
def test_bad_catalogs_are_refused(entities):
    with pytest.raises(ValueError, match="invalid catalog"):
        EntityCatalog(entities)


def test_mappings_need_the_same_keys():
    aliases = {"A": {"strong": ["a"]}, "B": {"weak": ["b"]}}
    starts = {"A": date(2024, 1, 1), "B": date(2024, 1, 2)}
    assert EntityCatalog.from_mappings(aliases, starts).starts == starts
    with pytest.raises(ValueError, match="without a start date: \\['B'\\]"):
        EntityCatalog.from_mappings(aliases, {"A": date(2024, 1, 1)})
    with pytest.raises(ValueError, match="without an entity: \\['B'\\]"):
        EntityCatalog.from_mappings({"A": {"strong": ["a"]}}, starts)


def test_tables_of_a_catalog(spark):
    assert AI_TOOLS.aliases_df(spark).count() == 44
    gaps = catalog_key_gaps(AI_TOOLS.aliases_df(spark), AI_TOOLS.starts_df(spark).filter("tool != 'v0'"))
    assert [tuple(r) for r in gaps.collect()] == [("v0", "no start date")]
