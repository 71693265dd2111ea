import pytest
from pyspark.sql import functions as F

from gleaner.functions import sql
from gleaner.operators import evaluation as evl
from gleaner.operators import evidence as ev
from gleaner.operators import extraction as ex
from gleaner.operators import ranking as rk

SCHEMA = "id string, subreddit string, kind string, created_utc bigint, score bigint, author string, parent_body string, permalink string, stores array<string>, text string"


def docs(spark, n=20):
    return spark.createDataFrame([(f"i{k}", "town", "comments", 1_600_000_000, None, "u", "", "/r/town/1", ["Aldi"], f"The milk is fresh and great {k}") for k in range(n)], SCHEMA)


def test_resumes_where_it_stopped(spark, tmp_path):
    class Flaky:
        def __call__(self, text, parent, stores):
            if text.endswith(("3", "7")):
                raise ValueError("no")
            return ex.WordProvider()(text, parent, stores)

    folder, limits = str(tmp_path), ex.Limits(chunk=6)
    first = ex.run_extraction(docs(spark), folder, Flaky(), limits=limits)
    assert (first.done, first.failed, first.claims) == (16, 4, 16) and len(first.chunks) == 4
    again = ex.run_extraction(docs(spark), folder, ex.WordProvider(), limits=limits)
    assert (again.done, again.failed, again.claims) == (4, 0, 20)
    assert ex.run_extraction(docs(spark), folder, ex.WordProvider()).done == 0
    claims = spark.read.json(f"{folder}/claims")
    assert {"source_key", "source_id", "permalink", "author", "created_utc", "subreddit", "kind"} <= set(claims.columns)


def test_a_repeated_chunk_counts_once(spark, tmp_path):
    results = ex.extract(docs(spark, 3), ex.WordProvider())
    claims = ex.claims_of(results, docs(spark, 3)).withColumn("claim_row", F.monotonically_increasing_id())
    twice = claims.unionByName(claims.withColumn("claim_row", F.col("claim_row") + 10**12))
    assert ev.dedupe(twice).count() == 3


def test_breaker_ceiling_and_stop(spark, tmp_path):
    class Broken:
        def __call__(self, *a):
            raise ValueError("down")

    assert ex.run_extraction(docs(spark), str(tmp_path / "a"), Broken(), limits=ex.Limits(chunk=5, failures=4)).stopped == "too many failures in a row"
    out = ex.run_extraction(docs(spark), str(tmp_path / "b"), ex.WordProvider(), limits=ex.Limits(chunk=5, cost=0.0001, prices=(0, 15.0, 0, 0)))
    assert out.stopped == "cost ceiling" and 0 < out.done < 20
    assert ex.run_extraction(docs(spark), str(tmp_path / "c"), ex.WordProvider(), stop=lambda: True).stopped == "asked to stop"


GOOD = {"store": "Aldi", "location": "", "category": "dairy", "item": "", "claim": "c", "sentiment": "positive", "price_signal": "none", "confidence": "high", "comparator_store": "", "transient": False}


@pytest.mark.parametrize(
    "claims", ["no list", [1], [{**GOOD, "extra": 1}], [{k: v for k, v in GOOD.items() if k != "item"}], [{**GOOD, "store": "Nowhere"}], [{**GOOD, "sentiment": "glad"}], [{**GOOD, "transient": "no"}], [{**GOOD, "claim": None}]]
)
def test_answers_outside_the_schema_are_errors_that_cost(claims):
    with pytest.raises(ex.AnsweredError) as e:
        ex.checked(claims, {"tokens_out": 7})
    assert e.value.used == {"tokens_out": 7}


def test_what_was_paid_for_counts_and_a_refusal_is_done(spark, tmp_path):
    assert ex.checked([GOOD], {}) == [GOOD] and ex.checked([], {}) == []

    class Mixed:
        def __call__(self, text, parent, stores):
            if text.endswith("1"):
                raise ex.AnsweredError("no text in the answer", {"tokens_out": 1_000_000})
            if text.endswith("2"):
                return None, {"tokens_out": 5}
            return [{**GOOD, "store": "Nowhere"}] if text.endswith("3") else [GOOD], {"tokens_out": 10}

    rows = {r["key"]: r for r in ex.extract(docs(spark, 5), Mixed()).collect()}
    of = lambda i: (rows[f"c_town_i{i}"]["status"], rows[f"c_town_i{i}"]["tokens_out"])
    assert [of(i) for i in range(5)] == [("ok", 10), ("error", 1_000_000), ("refusal", 5), ("error", 10), ("ok", 10)]
    out = ex.run_extraction(docs(spark, 5), str(tmp_path), Mixed(), limits=ex.Limits(prices=(0, 1.0, 0, 0)))
    assert (out.done, out.failed, out.claims) == (3, 2, 2) and out.spent == pytest.approx(1.000035)
    assert {r["key"] for r in ex.read_ledger(spark, str(tmp_path)).collect()} == {"c_town_i0", "c_town_i2", "c_town_i4"}


def test_failures_in_a_row_follow_the_keys(spark):
    rows = spark.createDataFrame([(f"k{i:02}", "error" if c == "x" else "ok") for i, c in enumerate("xx.xxx.x")], "key string, status string")
    assert ex.failures_in_a_row(rows, 0) == (3, 1) and ex.failures_in_a_row(rows, 9) == (11, 1)
    assert ex.failures_in_a_row(rows.where("status = 'error'"), 4) == (10, 10) and ex.failures_in_a_row(rows.limit(0), 4) == (4, 4)


def test_progress_lines(spark, tmp_path):
    said = []
    ex.run_extraction(docs(spark), str(tmp_path), ex.WordProvider(), limits=ex.Limits(chunk=4), progress=ex.progress_lines(8, said.append))
    assert said and said[-1].startswith("20/20 done, 0 failed")


def test_retries():
    waits, left = [], [2]

    def provider(*a):
        if left[0]:
            left[0] -= 1
            raise ex.TransientError
        return [], {}

    retry = ex.Retry(sleep=waits.append, jitter=lambda: 0.0)
    assert ex.call_with_retries(provider, "", "", [], retry) == ([], {}) and waits == [2.0, 4.0]
    left[0] = 99
    with pytest.raises(ex.TransientError):
        ex.call_with_retries(provider, "", "", [], retry)
    assert waits[2:] == [2.0, 4.0, 8.0, 16.0, 32.0]


def test_sample(spark):
    keys = lambda n, seed: {r["id"] for r in ex.sample(docs(spark), n, seed).collect()}
    assert keys(5, 1) == keys(5, 1) and len(keys(5, 1)) == 5 and keys(5, 1) != keys(5, 2)
    assert len(keys(None, 0)) == 20 and not keys(0, 0) and not keys(-1, 0) and len(keys(99, 0)) == 20


def test_projection():
    used = {"tokens_in": 36_681, "tokens_out": 12_458, "cache_read": 336_206, "cache_write": 40_144}
    assert ex.projected_cost(used, 150, 25_108, (3.0, 15.0, 0.3, 3.75)) == pytest.approx(66.8, abs=0.5)
    assert ex.projected_cost(used, 0, 10, (1, 1, 1, 1)) is None


def test_evaluation(spark):
    schema = "case string, ord int, store string, category string, sentiment string, price_signal string"
    cases = spark.createDataFrame([("a",), ("b",)], "case string")
    none = spark.createDataFrame([], schema)
    got = spark.createDataFrame([("a", 0, "A", "meat", "positive", "none")], schema)
    row = evl.score(evl.compare(cases, none, none)).first()
    assert (row["precision"], row["recall"], row["exact_match"], row["silence"], row["flag_accuracy"]) == (None, 1.0, 1.0, 1.0, None)
    row = evl.score(evl.compare(cases, got, got)).first()
    assert (row["precision"], row["recall"], row["f1"], row["silence"]) == (1.0, 1.0, 1.0, 1.0)
    row = evl.score(evl.compare(cases, none, got)).first()
    assert (row["precision"], row["recall"], row["f1"], row["silence"]) == (0.0, 1.0, 0.0, 0.5)


def test_ranking(spark):
    items = spark.createDataFrame([("A", "key limes", 2.0, 0.5, None), ("A", "limes", 9.0, 0.1, None), ("B", "limes", 3.0, 0.4, -0.5)], "store string, name string, w double, s double, pl double")
    cells = spark.createDataFrame([("A", "dairy", 5.0, 0.3, None), ("B", "dairy", 0.5, 0.9, None)], "store string, category string, w double, s double, pl double")
    basket = spark.createDataFrame([("key limes", 2), ("milk", 1), ("unicorn", 1)], "term string, qty int")
    resolved = rk.resolve(basket, items, cells, rk.keyword_table(spark))
    assert {(r["term"], r["store"], r["label"]) for r in resolved.collect()} == {("key limes", "A", "key limes"), ("key limes", "B", "limes"), ("milk", "A", "dairy"), ("milk", "B", "dairy")}
    ranked = {r["store"]: tuple(r)[1:] for r in rk.rank_stores(resolved, 1.0).collect()}
    assert ranked == {"A": (3, 0.4333, "key limes,milk", ""), "B": (2, 0.4, "", "")}
    cheapest = {r["store"]: r["avg"] for r in rk.rank_stores(resolved, 0.0).collect()}
    assert cheapest == {"A": 0.0, "B": 0.5}


def test_order_puts_missing_last_both_ways(spark):
    rows = spark.createDataFrame([("a", 0.5), ("b", None), ("c", -0.5)], "store string, price double")
    order = lambda d: [r["store"] for r in rk.ordered_comparison(rows, "price", d).collect()]
    assert order(True) == ["c", "a", "b"] and order(False) == ["a", "c", "b"]


def test_list_and_habits(spark):
    terms = spark.createDataFrame([("Milk,\n eggs; milk ,,Bread",)], "t string").select(rk.parse_list(F.col("t"))).first()[0]
    assert terms == ["milk", "eggs", "bread"]
    bought = spark.createDataFrame([("milk", 2, 1_000_000), ("milk", 1, 1_000_000 - 56 * 86_400), ("tea", 1, 0)], "name string, qty int, at bigint")
    rows = rk.habits(bought, 1_000_000)
    assert {r["name"]: (r["seen"], r["units"]) for r in rows.collect()} == {"milk": (2, 3), "tea": (1, 1)}
    assert [(r["name"], r["qty"]) for r in rk.basket_from(rows).collect()] == [("milk", 3), ("tea", 1)]


def test_sql_functions(spark):
    sql.register(spark)
    row = spark.sql("SELECT recency_weight(0, 126230400, 4.0D) AS r, vote_weight(NULL) AS v, star_scale(5.0D) AS s, shrunk(2.0D, 4.0D) AS k, metres(0D, 0D, 0D, 1D) AS m").first()
    assert row["r"] == pytest.approx(0.5) and row["v"] == 1.0 and row["s"] == 1.0 and row["k"] == pytest.approx(1 / 3) and row["m"] == pytest.approx(111_195, abs=5)
