import pytest

from gleaner.operators import calibration as cal
from gleaner.operators import ranking as rk
from gleaner.operators import views as vw


def test_basket_views(spark):
    ranked = spark.createDataFrame([("A", 5, 0.30, "x", "milk"), ("B", 5, 0.25, "", ""), ("C", 2, 0.9, "", "")], "store string, covered bigint, avg double, wins string, weak string")
    totals = spark.createDataFrame([("A", 9, 3.0, 0.1), ("B", 8, 9.0, 0.2), ("C", 1, 0.1, 0.9)], "store string, n bigint, w double, s double")
    order = lambda **k: [r["store"] for r in vw.ordered_stores(ranked, totals, **k).orderBy("place").collect()]
    assert (order(), order(sort="quality"), order(sort="evidence"), order(hide_thin=True), order(min_weight=5.0)) == (["A", "B", "C"], ["C", "B", "A"], ["B", "A", "C"], ["A", "B"], ["B"])
    note = lambda r: tuple(vw.second_stop(vw.ordered_stores(r, totals)).first())
    assert note(ranked) == ("A", "B", 0.05, "weak")
    assert note(ranked.withColumn("weak", ranked["wins"].substr(9, 9))) == ("A", "B", 0.05, "close")
    assert note(ranked.where("store = 'C'")) == ("C", None, None, "alone") and vw.second_stop(vw.ordered_stores(ranked.limit(0), totals)).count() == 0
    with pytest.raises(ValueError):
        vw.ordered_stores(ranked, totals, "price")
    empty = spark.createDataFrame([], "term string, qty int")
    assert tuple(vw.basket_size(empty).first()) == (0, 0)
    assert [r["word"] for r in vw.suggestions(rk.ordered_keywords(spark), empty, most=2).orderBy("place").collect()] == ["produce", "vegetables"]


def test_a_long_basket_is_resolved_in_blocks(spark, monkeypatch):
    items = spark.createDataFrame([("A", f"thing{i:03}", 2.0, 0.5, None) for i in range(60)], "store string, name string, w double, s double, pl double")
    cells = spark.createDataFrame([], "store string, category string, w double, s double, pl double")
    basket = spark.createDataFrame([(f"thing{i:03}", 1) for i in range(60)], "term string, qty int")
    want = {(f"thing{i:03}", f"thing{i:03}") for i in range(60)}
    for most in (10_000, 7):
        monkeypatch.setattr(rk, "BASKET_TERMS", most)
        assert {(r["term"], r["label"]) for r in rk.resolve(basket, items, cells, rk.keyword_table(spark)).collect()} == want


def test_map_and_details(spark):
    pins = spark.createDataFrame([("n1", "A", "x"), ("n2", "A", None), ("n3", "B", "y")], "osm string, store string, branch string")
    totals = spark.createDataFrame([("A", 0.5), ("B", -0.5)], "store string, s double")
    scores = spark.createDataFrame([("n1", 0.1), ("n2", None)], "osm string, s double")
    ratings = spark.createDataFrame([("n1", 0.7, False), ("n3", 0.2, True)], "osm string, norm double, thin boolean")
    show = lambda **k: {r["osm"]: r["s"] for r in vw.map_pins(pins, totals, **k).collect()}
    assert show() == {"n1": 0.5, "n2": 0.5, "n3": -0.5} and show(store="B") == {"n3": -0.5} and show(with_branch=True, scores=scores) == {"n1": 0.1}
    assert show(ratings=ratings, colour="ratings") == {"n1": 0.7}
    stores, branches = spark.createDataFrame([("A", 0.3)], "store string, v double"), spark.createDataFrame([("A", "x", 0.4)], "store string, branch string, v double")
    assert show(merged_stores=stores, merged_branches=branches, colour="merged") == {"n1": 0.4, "n2": 0.3}
    assert [(r["store"], r["branch"]) for r in vw.map_list(pins, ["osm"], 2).orderBy("place").collect()] == [("A", "x"), ("A", None)]


def test_older_totals_are_taken_back(spark):
    rows = [("a", 6.0, 4.0, 1.0, 9.9), ("b", None, None, 0.5, 2.0), ("c", None, None, 0.5, 0.0), ("d", 0.0, 0.0, 0.0, 3.0)]
    out = vw.raw_evidence(spark.createDataFrame(rows, "k string, score double, valenced double, sentiment double, weighted_evidence double"))
    assert {r["k"]: (r["score"], r["valenced"]) for r in out.collect()} == {"a": (6.0, 4.0), "b": (2.0, 2.0), "c": (None, 0.0), "d": (None, 0.0)}


def test_a_branch_only_the_second_source_knows_is_left_to_the_caller(spark):
    cells = lambda rows: spark.createDataFrame(rows, "store string, branch string, category string, score double, valenced double")
    fit = spark.createDataFrame([(0.0, 1.0, 0.1)], "intercept double, slope double, residual_sd double")
    first, second = cells([("A", "x", "meat", 2.0, 4.0)]), cells([("A", "x", "meat", 1.0, 2.0), ("A", "x", "dairy", 1.0, 2.0), ("A", "z", "meat", 1.0, 2.0)])
    out = cal.combine_claims(first, second.join(first.select("store", "branch"), ["store", "branch"], "left_semi"), ["store", "branch", "category"], fit)
    assert {(r["branch"], r["category"]): (r["r"], r["g"]) for r in out.collect()} == {("x", "meat"): (0.5, 0.5), ("x", "dairy"): (None, 0.5)}
    assert cal.combine_claims(first, second, ["store"], fit.limit(0)).count() == 0


def test_leave_one_out_equals_fits_without_each(spark):
    import numpy as np

    for rows in ([(0.1, 0.2, 1.0), (0.4, 0.1, 2.0), (0.5, 0.9, 0.5), (0.7, 0.4, 3.0), (0.7, 0.8, 1.0)], [(0.1, 0.2, 1.0), (0.1, 0.4, 1.0), (0.9, 0.5, 1.0)], [(0.1, 0.2, 1.0)] * 4):
        got = {int(r["id"]): r["error"] for r in cal.leave_one_out(spark.createDataFrame([(str(i), *r) for i, r in enumerate(rows)], "id string, x double, y double, w double")).collect()}
        want = {}
        for i, (x, y, _) in enumerate(rows):
            rest = np.array([r for j, r in enumerate(rows) if j != i])
            if len(set(rest[:, 0])) > 1:
                slope, start = np.polyfit(rest[:, 0], rest[:, 1], 1, w=np.sqrt(rest[:, 2]))
                want[i] = y - (start + slope * x)
        assert got == pytest.approx(want)
