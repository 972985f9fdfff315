"""Plan lint: no sort-merge join can leave a hot key whole in one task.

The silver and gold jobs, planned as the job runner plans them (reading
written tables) with broadcasts off (the at-scale shape) and AQE off (the
static plan). Every sort-merge join must be one of:

* fed by a fresh shuffle on both sides, the shape AQE's skew-join handling
  can split (``balanced_join`` makes sure of it);
* on the customer key of the customers table, which is deduplicated on it, against
  an aggregate on that key: no key can be hot on either side;
* fed on both sides by an aggregate grouped on exactly the join keys: one row
  per key on each side, so no key can be hot.

A join of a shuffle with an aggregate fails: the shuffled side can hold a hot
key, and AQE cannot split a join whose other input is not a shuffle.
"""

from __future__ import annotations

import os
import re

import pytest

from emporia.plans import jobs
from emporia.sources import Registry, Warehouse
from tests.fixtures import write_landing

# Narrow nodes that keep their input's partitioning (and codegen wrappers).
PASS_THROUGH = ("Sort", "Project", "Filter", "WholeStageCodegen", "InputAdapter")
NAMES = [n for n in jobs.JOBS if jobs.JOBS[n].layer in ("silver", "gold")]


def _children(node):
    seq = node.children()
    return [seq.apply(i) for i in range(seq.size())]


def _nodes(node):
    yield node
    for child in _children(node):
        yield from _nodes(child)


def _names(seq) -> list[str]:
    """Expression names without their ids: ``customer_id#12L`` -> ``customer_id``."""
    return [re.sub(r"#\d+L?$", "", seq.apply(i).toString()) for i in range(seq.size())]


def _feeding(node):
    while node.nodeName().startswith(PASS_THROUGH):
        node = _children(node)[0]
    return node


def _shape(child, keys: list[str]) -> str:
    """``shuffle``, ``unique`` (aggregate on exactly ``keys``) or ``other``."""
    fed = _feeding(child)
    if fed.nodeName() == "Exchange":
        return "shuffle"
    if "Aggregate" in fed.nodeName() and sorted(_names(fed.groupingExpressions())) == sorted(keys):
        return "unique"
    return "other"


@pytest.fixture(scope="module")
def static_plans(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lint"))
    landing = write_landing(os.path.join(root, "landing"))
    wh = Warehouse(Registry(landing_root=landing), root=os.path.join(root, "wh"))
    jobs.run_all(spark, wh, layers=("bronze", "silver"))
    keys = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    saved = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield {n: jobs.plan(jobs.JOBS[n], spark, wh)._jdf.queryExecution().executedPlan() for n in NAMES}
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", NAMES)
def test_every_sort_merge_join_can_split_a_hot_key(static_plans, name):
    joins = [n for n in _nodes(static_plans[name]) if n.nodeName() == "SortMergeJoin"]
    for join in joins:
        left, right = _names(join.leftKeys()), _names(join.rightKeys())
        l_child, r_child = _children(join)
        shapes = {_shape(l_child, left), _shape(r_child, right)}
        if name == "gold-customer-ltv" and left == ["customer_id"]:
            assert shapes == {"shuffle", "unique"}
            continue
        assert shapes in ({"shuffle"}, {"unique"}), (shapes, join.toString()[:2000])


def test_the_lint_sees_the_joins(static_plans):
    joins = sum(
        1 for n in NAMES for node in _nodes(static_plans[n]) if node.nodeName() == "SortMergeJoin"
    )
    assert joins >= 10
