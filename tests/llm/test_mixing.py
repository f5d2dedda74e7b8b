"""Mixing of sources: exact budgets, reruns, edge cases, cut texts."""

from fractions import Fraction

import pytest
from compare import connect, differences
from conftest import logical_plan_of, plan_of
from pyspark.sql import functions as F

from assaymill.llm import mixing, queries, reference_sql

SCHEMA = "doc_id bigint, text string, source string"


def water_levels(sizes, weights, most):
    """Targets by the rule in words: share, stop at the limit, share the excess again."""
    total, limit = sum(sizes.values()), {s: most * n for s, n in sizes.items()}
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    fixed = {}
    while True:
        free = [s for s in order if s not in fixed]
        left, width = total - sum(fixed.values()), sum(weight[s] for s in free)
        found = {s: Fraction(left * weight[s], width) for s in free} if width else {}
        above = [s for s in free if found[s] > limit[s]]
        if not above:
            return fixed | found
        fixed |= {s: limit[s] for s in above}


def test_query_matches_sql(spark, sf_dir):
    sql = reference_sql.statements()["op11_mix"]
    assert differences(queries.op11_mix(spark, sf_dir), connect(sf_dir), sql) == []


@pytest.mark.parametrize("weights, most", [((5, 2, 1), 3), ((1,), 1), ((1, 1000), 2), ((7, 3), 3)])
def test_budgets(spark, weights, most):
    rows = [(i, "w " * (i % 7), s) for s, n in (("b", 40), ("a", 3), (None, 9), ("é", 200)) for i in range(n)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = mixing.plan(docs, weights, most, keep=[F.col("source")], range_rows=16).collect()
    sizes = {}
    for i, _, s in rows:
        sizes[s] = sizes.get(s, 0) + i % 7
    wanted = water_levels(sizes, weights, most)
    assert len(found) == len(rows)
    for s in sizes:
        mine = [r for r in found if r.source == s]
        assert {r.source_size for r in mine} == {sizes[s]}
        assert {r.target for r in mine} == {float(wanted[s])}
        assert sum(r.taken for r in mine) == int(wanted[s] + Fraction(1, 2))
        assert all(0 <= r.taken <= most * r.size for r in mine)
        # Whole rounds differ by one at most, and one document is cut.
        assert len({r.taken / r.size for r in mine if r.size}) <= 3


def test_reruns_and_layout_agree(spark):
    rows = [(i % 50 if i % 3 else None, f"{i % 11} x " * (i % 9), "s" if i % 2 else "t") for i in range(400)]
    docs = spark.createDataFrame(rows, SCHEMA)
    one = sorted(map(tuple, mixing.plan(docs, range_rows=1000).collect()), key=str)
    two = sorted(map(tuple, mixing.plan(docs.repartition(7), range_rows=13).collect()), key=str)
    assert one == two


def test_mixed_texts(spark):
    rows = [(i, f" a{i}\tb\n\nc  d ", "big") for i in range(30)] + [(99, "x y z", "small"), (107, None, "big"), (108, "", "small")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("epoch", F.lit("mine")).withColumn("_key", F.lit(1))
    plan = {(r.doc_id): r.taken for r in mixing.plan(docs).collect()}
    made = mixing.mixed(docs).collect()
    assert made[0].asDict().keys() == {"doc_id", "text", "source", "_key", "epoch", "n_words"}
    texts = {i: t for i, t, _ in rows}
    taken = {}
    for r in made:
        assert r.n_words == len(r.text.split()) > 0
        assert texts[r.doc_id].startswith(r.text)
        assert r.text == texts[r.doc_id] or r.text[-1] not in " \t\n"
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.n_words
    assert taken == {i: n for i, n in plan.items() if n}
    assert sorted(r.epoch for r in made if r.doc_id == 99) == list(range(plan[99] // 3 + (plan[99] % 3 > 0)))


def test_empty_and_wordless(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert mixing.plan(nothing).collect() == [] and mixing.mixed(nothing).collect() == []
    blank = spark.createDataFrame([(1, None, None), (None, " \n", "a")], SCHEMA)
    assert {(r.size, r.source_size, r.target, r.taken) for r in mixing.plan(blank).collect()} == {(0, 0, 0.0, 0)}


def test_plan_stays_in_the_jvm_with_one_row_shuffle(spark, sf_dir):
    found = queries.op11_mix(spark, sf_dir)
    assert "Python" not in plan_of(found) and "Arrow" not in plan_of(found)
    assert "rangepartitioning" in plan_of(found)
    # The only other shuffles are those of the carry rows: per range and per source.
    window = plan_of(found).split("Union")[0]
    assert window.count("Exchange") == 1
    assert "Join" not in logical_plan_of(found).split("Union")[0]
