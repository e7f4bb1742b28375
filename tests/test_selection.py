import random

import pytest
from rows import catalog, feed_map, ids, rule

from rulespark import operators as op
from rulespark.model import RULE_COLUMNS

MAPPINGS = [
    ("here", "F1", "Yes"), ("here", "F1", "Yes"), ("here", "F2", "No"), ("elsewhere", "F2", "Yes"),
    ("refused", "F1", "No"), ("unflagged", "F1", None), ("no feed", None, "Yes"), (None, "F1", "Yes"),
]
RULES = [rule(name) for name in ("here", "elsewhere", "refused", "unflagged", "no feed", "never", None)]


@pytest.fixture
def tables(spark):
    rules = RULES + [rule("here"), rule("other module", module="X"), rule("inactive", rule_status="Inactive"),
                     rule("no status", rule_status=None), rule("passive", rule_status="Passive")]
    return catalog(spark, *rules), feed_map(spark, *MAPPINGS)


def test_selection_by_module_stage_package_and_status(tables):
    assert ids(op.select_rules(tables[0], "M", "S", "P")) == [
        "", "elsewhere", "here", "never", "no feed", "passive", "refused", "unflagged"]
    assert ids(op.select_rules(tables[0], "M", "S", "Q")) == []


def test_mapped_and_unmapped_halves(tables):
    assert ids(op.mapped_rules(*tables, "M", "S", "P", "F1")) == ["here"]
    # A rule with any mapping row is in neither half unless it is mapped to this feed. One without
    # an id matches nothing, so it counts as never mapped.
    assert ids(op.unmapped_rules(*tables, "M", "S", "P")) == ["", "never", "passive"]


def test_rules_for_a_feed_are_the_two_halves(tables):
    assert ids(op.rules_for_feed(*tables, "M", "S", "P", "F1")) == ["", "here", "never", "passive"]
    assert ids(op.rules_for_feed(*tables, "M", "S", "P", "F1", unmapped="drop")) == ["here"]
    with pytest.raises(ValueError):
        op.rules_for_feed(*tables, "M", "S", "P", "F1", unmapped="maybe")


@pytest.mark.parametrize("feed", [None, ""])
def test_without_a_feed_every_selected_rule_applies(tables, feed):
    assert ids(op.rules_for_feed(*tables, "M", "S", "P", feed)) == ids(op.select_rules(tables[0], "M", "S", "P"))


def test_packages_keep_their_order_and_repeats(spark):
    rules = catalog(spark, rule("a", package="P"), rule("a", package="P"), rule("b", package="Q"),
                    rule("c", package="R"))
    chosen = op.rules_for_packages(rules, feed_map(spark), "M", "S", ["Q", "P", "Q", "absent"])
    assert sorted((row.package_position, row.rule_id) for row in chosen.collect()) == [(0, "b"), (1, "a"), (2, "b")]
    assert chosen.columns == [*RULE_COLUMNS, "package_position"]
    none = op.rules_for_packages(rules, feed_map(spark), "M", "S", [])
    assert none.collect() == [] and none.columns == chosen.columns


def test_one_pass_equals_the_union_of_halves(spark):
    draw = random.Random(7)
    names = [str(number) for number in range(40)]
    rules = catalog(spark, *[
        rule(draw.choice(names), package=draw.choice("PQ"), slg=draw.choice("xy"),
             rule_status=draw.choice(["Active", "Passive", "Inactive"])) for _ in range(200)])
    mappings = feed_map(spark, *[
        (draw.choice(names[:25]), draw.choice(["F1", "F2", None]), draw.choice(["Yes", "No", None]))
        for _ in range(60)])
    one_pass = op.rules_for_feed(rules, mappings, "M", "S", "P", "F1")
    halves = op.mapped_rules(rules, mappings, "M", "S", "P", "F1").union(
        op.unmapped_rules(rules, mappings, "M", "S", "P")).distinct()
    assert sorted(one_pass.collect()) == sorted(halves.collect()) and one_pass.count() > 10


def test_rule_rows_are_text(spark):
    rules = catalog(spark, rule("a", created_dt=None, modified_by=None))
    rules = rules.selectExpr(*RULE_COLUMNS[:12], "DATE '2024-02-29' AS modified_dt", "modified_by", "7 AS other")
    row = op.rule_rows(rules).first()
    assert (row.created_dt, row.modified_dt, row.modified_by, row.other) == ("", "2024-02-29", "", 7)


def test_feed_mapping_flags(spark):
    mappings = feed_map(spark, *MAPPINGS)
    flags = op.has_feed_mapping(["here", "refused", "never", "elsewhere", "never"], mappings).collect()
    assert {row.rule_id: row.has_feed_mapping for row in flags} == {
        "here": True, "refused": False, "never": False, "elsewhere": True}
    assert op.has_feed_mapping([], mappings).count() == 0


def test_approvals(spark):
    approvals = spark.createDataFrame(
        [("a", "Approved"), ("a", "Approved"), ("b", "Pending"), ("c", None), ("d", "Approved")],
        "rule_id string, approval_status string")
    given = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "rule_id string")
    assert ids(op.approved_rules(given, approvals)) == ["a"]
    assert ids(op.approved_rules(["a", "d", "a"], approvals)) == ["a", "d"]
    assert ids(op.approved_rules(given, None)) == ids(op.approved_rules(["c", "b", "a", "a"], None)) == ["a", "b", "c"]


@pytest.mark.parametrize("unmapped", ["keep", "drop"])
def test_requests_give_what_each_gives_alone(spark, tables, unmapped):
    rules, mappings = tables
    rules = rules.unionByName(catalog(spark, rule("here", package="Q"), rule("never", package="Q"), rule("elsewhere", package="Q")))
    wanted = [(f"{package}-{feed}", module, "S", package, feed) for module in ("M", "X") for package in ("P", "Q", "none")
              for feed in ("F1", "F2", "F9", "", None)]
    wanted = [(f"{module}-{request}", module, *rest) for request, module, *rest in wanted]
    requests = spark.createDataFrame(wanted + wanted[:3], "request_id string, module string, stage string, package string, feed_id string")
    found = {}
    for row in op.rules_for_requests(rules, mappings, requests, unmapped).collect():
        found.setdefault(row.request_id, []).append(tuple(row)[1:])
    for request, module, stage, package, feed in wanted:
        alone = op.rules_for_feed(rules, mappings, module, stage, package, feed, unmapped)
        assert sorted(found.get(request, []), key=str) == sorted(map(tuple, alone.collect()), key=str), request
    assert len(found) > 6


def test_a_request_of_several_packages_and_feeds(spark, tables):
    requests = spark.createDataFrame([("r", "M", "S", "P", "F1"), ("r", "M", "S", "P", "F2"), ("r", None, "S", "P", "F1")],
                                     "request_id string, module string, stage string, package string, feed_id string")
    assert ids(op.rules_for_requests(*tables, requests)) == ["", "elsewhere", "here", "never", "passive"]
    assert op.rules_for_requests(*tables, requests.limit(0)).count() == 0
    with pytest.raises(ValueError):
        op.rules_for_requests(*tables, requests, unmapped="maybe")
