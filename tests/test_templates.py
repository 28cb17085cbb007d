import pytest

from quillmesh.plans import templates as T
from quillmesh.plans.graph import PropertyGraph


def test_unbound_facets_are_no_part_of_the_plan(spark, small):
    g = PropertyGraph.of(spark, small)
    wide = T.ask(g, "tpl_docs_filtered", limit=200)
    assert "topic" not in wide._jdf.queryExecution().optimizedPlan().toString().lower().split("limit")[-1] or wide.count() > 0
    assert T.ask(g, "tpl_docs_filtered", doc_type="Quyết định", limit=200).where("doc_type <> 'Quyết định'").count() == 0


def test_parameters(spark, small):
    g = PropertyGraph.of(spark, small)
    with pytest.raises(ValueError):
        T.ask(g, "tpl_docs_by_topic", limit=5)
    with pytest.raises(ValueError):
        T.ask(g, "tpl_docs_by_topic", topic="x", colour="red", limit=5)
    assert T.ask(g, "tpl_docs_recent", limit=10**6).count() <= T.ROW_CAP
    # a value is bound, never spliced
    assert T.ask(g, "tpl_docs_by_topic", topic="x' OR '1'='1", limit=5).count() == 0


def test_every_template_names_its_parameters():
    for t in T.REGISTRY.values():
        assert set(t.required) <= set(t.example), t.name
        assert set(t.example) <= {*t.required, *t.optional, "limit"}, t.name
