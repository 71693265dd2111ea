import random

import pytest

from gleaner.streaming import once as once_module
from gleaner.streaming.once import OnceSettings, Progress, deliver_once, once, redelivered, redeliveries, run_once

SCHEMA = "delivery_id bigint, kind string, id string, created_utc bigint, scope string, kept int"


def brute(rows):
    first = {}
    for d, kind, i, *_ in rows:
        key = (i or "").strip().lower().removeprefix("t1_").removeprefix("t3_")
        if key and d is not None:
            first[kind, key] = min(d, first.get((kind, key), d))
    kept = set(first.values())
    return sorted(d for d, _, i, *_ in rows if d is not None and (i or "").strip() and d not in kept)


def write(spark, rows, path, files):
    # unordered across files, as a table's file order carries no meaning
    rows = list(rows)
    random.Random(5).shuffle(rows)
    for i in range(files):
        spark.createDataFrame(rows[i::files], SCHEMA).coalesce(1).write.mode("append").parquet(str(path))


def deliveries(n, seed):
    r = random.Random(seed)
    out = []
    for d in range(n):
        i = f"m{r.randrange(n // 3)}"
        i = r.choice([i, i, i.upper(), f" t1_{i}", f"{i} ", None if r.random() < 0.05 else i])
        at = 1_500_000_000 + r.randrange(400) * 86_400
        out.append((d, r.choice(["comments", "comments", "posts"]), i, r.choice([at, at * 1000, None]), "x", 1))
    return out


@pytest.mark.parametrize("files_per_batch", [1, 100])
def test_lowest_delivery_stays_over_any_cut_into_batches(spark, tmp_path, files_per_batch):
    rows = deliveries(300, 1)
    write(spark, rows, tmp_path / "t", 5)
    got = redeliveries(spark, str(tmp_path / "t"), OnceSettings(delay="5 days", files_per_batch=files_per_batch))
    assert sorted(r[0] for r in got.collect()) == brute(rows)


def test_late_copies_are_looked_up(spark, tmp_path):
    day = 86_400
    first = [(1, "posts", "a", 1_600_000_000, "", 0)]
    later = [(2, "posts", "b", 1_600_000_000 + 300 * day, "", 0)]
    late = [(3, "posts", "a", 1_600_000_000, "", 0), (4, "posts", "old", 1_600_000_000 - 300 * day, "", 0)]
    import time

    for rows in (first, later, late):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "t"))
        time.sleep(1.1)  # the source reads files by age
    kept = deliver_once(spark, str(tmp_path / "t"), OnceSettings(delay="10 days", files_per_batch=1))
    assert {r["message"]: r["kept"] for r in kept.collect()} == {"a": 1, "b": 2, "old": 4}


def test_a_table_of_one_file_is_read_as_it_arrived(spark, tmp_path, monkeypatch):
    r, day = random.Random(4), 86_400
    rows = [(d, "posts", f"m{r.randrange(max(1, d - 300), d + 1)}" if d % 3 else f"m{r.randrange(d + 1)}", 1_500_000_000 + d * day, "x", 1) for d in range(600)]
    first = {}
    rows = [(d, kind, i, first.setdefault(i, at), x, n) for d, kind, i, at, x, n in rows]  # a copy has its message's time
    write(spark, rows, tmp_path / "t", 1)
    queries, start = [], once_module.accept_once
    monkeypatch.setattr(once_module, "accept_once", lambda *a, **k: queries.append(start(*a, **k)) or queries[-1])
    settings = OnceSettings(delay="30 days", files_per_batch=1, slices=8)
    assert sorted(x[0] for x in redeliveries(spark, str(tmp_path / "t"), settings).collect()) == brute(rows)
    progress = [p for p in queries[0].recentProgress if p.numInputRows]
    states = [s for p in progress for s in p.stateOperators]
    assert len(progress) > 4
    assert sum(s.numRowsRemoved for s in states) > 0  # expired
    assert sum(s.numRowsDroppedByWatermark for s in states) > 0  # late: left to the lookup


def test_rows_without_identifier_all_stay_and_columns_too(spark, tmp_path):
    rows = [(1, "posts", None, 5, "s", 7), (2, "posts", " ", 5, "s", 7), (3, "posts", "a", None, "s", 7), (4, "posts", "A", 9, "s", 7), (None, "posts", "a", 9, "s", 7), (5, None, "a", 9, "s", 7)]
    write(spark, rows, tmp_path / "t", 1)
    out = once(spark, str(tmp_path / "t"))
    assert out.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    assert sorted(str(r["delivery_id"]) for r in out.collect()) == ["1", "2", "3", "5", "None"]


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "t"))
    assert redeliveries(spark, str(tmp_path / "t")).count() == 0
    assert once(spark, str(tmp_path / "t")).count() == 0


def in_order(n, seed, late):
    """Deliveries whose event time goes up with them; with late ones, copies of long ago among them."""
    r, day, out = random.Random(seed), 86_400, []
    for d in range(n):
        of = r.randrange(d + 1) if late and r.random() < 0.1 else max(0, d - r.randrange(8))
        out.append((d, "posts", f"m{of}", 1_500_000_000 + of * day, "x", 1))
    return out


class Killed(Exception):
    pass


def test_a_query_killed_between_log_and_commit_goes_on_to_the_same_result(spark, tmp_path):
    rows = in_order(400, 2, late=True)
    write(spark, rows, tmp_path / "t", 1)
    settings = OnceSettings(delay="40 days", files_per_batch=1, slices=20)
    kills = {0, 7, 8}
    seen = []

    def kill(number):
        seen.append(number)
        if number in kills:
            kills.discard(number)
            raise Killed

    for _ in range(3):
        with pytest.raises(Exception, match="Killed"):
            run_once(spark, str(tmp_path / "t"), settings, Progress(logged=kill), str(tmp_path / "base"))
    log = run_once(spark, str(tmp_path / "t"), settings, Progress(logged=kill), str(tmp_path / "base"))
    assert max(seen) >= 19 and all(seen.count(k) == 2 for k in (0, 7, 8))
    assert sorted(x[0] for x in redelivered(spark, log).collect()) == brute(rows)


def test_the_state_decides_and_the_log_is_read_for_late_rows_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(once_module, "_looked_up", lambda *a: pytest.fail("the log was read"))
    rows = in_order(400, 3, late=False)
    write(spark, rows, tmp_path / "t", 1)
    progress = Progress()
    log = run_once(spark, str(tmp_path / "t"), OnceSettings(delay="40 days", files_per_batch=1, slices=20), progress)
    assert len(progress.batches) >= 19 and all(late == 0 and not shelves for _, late, shelves in progress.batches)
    assert sorted(x[0] for x in redelivered(spark, log).collect()) == brute(rows)


def test_a_lookup_reads_only_the_years_of_late_rows(spark, tmp_path):
    rows = in_order(1500, 4, late=False) + [(1500, "posts", "m3", 1_500_000_000 + 3 * 86_400, "x", 1)]
    write(spark, rows, tmp_path / "t", 1)
    progress = Progress()
    log = run_once(spark, str(tmp_path / "t"), OnceSettings(delay="200 days", files_per_batch=1, slices=3), progress)
    assert [(late, shelves) for _, late, shelves in progress.batches] == [(0, []), (0, []), (1, [2017])]
    assert sorted(x[0] for x in redelivered(spark, log).collect()) == brute(rows)
