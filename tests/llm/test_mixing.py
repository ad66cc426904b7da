"""The mix: targets, Pareto order, words near the target."""

from collections import defaultdict

import pytest
from helpers import PLAIN, odd_rows, rows_of, table
from pyspark.sql import functions as F

from tidemark.llm import mixing


def targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, held = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in held)
        open_ = sum(w for s, w in weight.items() if s not in held)
        out = {s: most * sizes[s] if s in held else weight[s] * rest / open_ for s in names}
        above = {s for s in names if s not in held and out[s] > most * sizes[s]}
        if not above:
            return out
        held |= above


def many(n=900):
    return [(i, "w " * (1 + i * 7 % 23), (None, "a", "b", "c", "ä", "b")[i % 6]) for i in range(n)] + [
        (5000 + i, "w", f"tiny{i}") for i in range(4)
    ]


def check(rows, found):
    sizes, taken = defaultdict(int), defaultdict(int)
    of = {}
    for r in rows:
        source = r[2] if len(r) > 2 else "s"
        n = len(PLAIN.findall(r[1] or ""))
        sizes[source] += n
        of[r[0]] = source, n
    want = targets(sizes)
    largest = defaultdict(int)
    for r in found:
        source, n = of[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (n, sizes[source])
        assert r["target"] == pytest.approx(want[source])
        assert r["taken"] == r["copies"] * n and 0 <= r["copies"] <= 3
        taken[source] += r["taken"]
        largest[source] = max(largest[source], n)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6


def test_words_meet_targets(spark):
    rows = many()
    found = mixing.mixed(table(spark, rows)).collect()
    assert len(found) == len(rows)
    check(rows, found)


def test_reruns_agree(spark):
    docs = table(spark, many(300))
    a = rows_of(mixing.mixed(docs, keep=["doc_id"]), "doc_id", "taken")
    assert a == rows_of(mixing.mixed(docs.repartition(5)), "doc_id", "taken")
    assert a != rows_of(mixing.mixed(docs, seed=1), "doc_id", "taken")


def test_odd_rows(spark):
    rows = odd_rows()
    found = mixing.mixed(table(spark, rows))
    assert found.count() == len(rows)
    assert all(r["taken"] == r["size"] for r in found.collect())  # one source gets its own size
    assert mixing.mixed(table(spark, [])).count() == 0
    nothing = mixing.mixed(table(spark, [(1, None), (2, "", "b")])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in nothing] == [(0, 0.0, 0)] * 2


def test_columns_stay(spark):
    found = mixing.mixed(table(spark, many(60)))
    assert set(found.columns) == set(table(spark, []).columns) | {"size", "source_size", "target", "copies", "taken"}
    assert found.where("size != cast(size as bigint)").count() == 0


def test_weights_are_inclusion_probabilities(spark):
    """Heavier documents come in more often, in proportion, over many seeds."""
    rows = [(i, "w w w w", "a") for i in range(200)] + [(1000 + i, "w w w w", "b") for i in range(200)]
    docs = table(spark, rows).withColumn("weight", F.when(F.col("doc_id") % 2 == 0, 1.0).otherwise(0.5))
    heavy = light = 0
    for seed in range(6):
        found = mixing.mixed(docs, seed=seed, weight_col="weight", keep=["doc_id"]).where("source_size > 0")
        for r in found.where("doc_id >= 1000").collect():
            if r["doc_id"] % 2 == 0:
                heavy += r["copies"]
            else:
                light += r["copies"]
    assert 1.6 < heavy / light < 2.5


def test_long_documents_are_preferred_as_their_weight_says(spark):
    """Over many seeds, copies by size follow the expected ones; the order is not that of the plain draw."""
    sizes = [1, 3, 7, 15, 31]
    rows = [(i, "w " * sizes[i % 5], "b") for i in range(400)] + [(5000 + i, "w " * 20, "a") for i in range(150)]
    docs = table(spark, rows)
    taken, seeds = defaultdict(int), 8
    for seed in range(seeds):
        for r in mixing.mixed(docs, seed=seed, keep=["doc_id"]).where("doc_id < 5000").collect():
            taken[r["size"]] += r["copies"]
            target, source = r["target"], r["source_size"]
    weight = {n: n.bit_length() for n in sizes}
    rate = target / sum(80 * n * weight[n] for n in sizes)
    assert target < source and all(rate * w < 3 for w in weight.values())
    for n in sizes:
        assert taken[n] / (80 * seeds) == pytest.approx(rate * weight[n], rel=0.2)
    found = mixing._measured(docs, "doc_id", "text", "source", 0).join(mixing.mixed(docs, keep=["doc_id"]), "doc_id")
    draws = sorted((r["_mix_draw"], r["copies"]) for r in found.where("doc_id < 5000").collect())
    copies = [c for _, c in draws]
    assert copies != sorted(copies, reverse=True)
    plain = mixing.mixed(docs, by_size=False, keep=["doc_id"]).join(found.select("doc_id", "_mix_draw"), "doc_id")
    copies = [c for _, c in sorted((r["_mix_draw"], r["copies"]) for r in plain.where("doc_id < 5000").collect())]
    assert copies == sorted(copies, reverse=True)


@pytest.mark.parametrize("share", [0.4, 1.0, 2.6, 3.0])
def test_rates_meet_the_target_when_some_are_held(spark, share):
    """Three copies of the heaviest at most, the others make up for it."""
    groups = [("s", 10, 8.0), ("s", 40, 4.0), ("s", 100, 1.0), ("t", 5, 0.5)]
    small = spark.createDataFrame(groups, "_mix_source string, _mix_size bigint, _mix_weight double")
    size = {"s": 150.0, "t": 5.0}
    targets = spark.createDataFrame([(k, v, share * v) for k, v in size.items()], "_mix_source string, _mix_source_size double, _mix_target double")
    rates = {r["_mix_source"]: r["_mix_rate"] for r in mixing._rates(small, targets).collect()}
    for name, total in size.items():
        words = sum(n * min(rates[name] * w, 3) for s, n, w in groups if s == name)
        assert words == pytest.approx(share * total)


def test_main_path_is_native(spark):
    found = mixing.mixed(table(spark, many(60)).repartition(3))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
