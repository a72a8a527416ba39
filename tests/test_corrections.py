"""Corrected rows over batches: the last delivery of a key counts, and gold changes by the difference."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest

from tallymart.plans import corrections, marts
from tallymart.plans.pipeline import RunOptions, run_batch
from tallymart.sources.paths import LakePaths

HEADER = "Order ID,Order Date,Sales,Category\n"
OPTIONS = RunOptions(business_keys=("order_id",), latest_first=("sales_clean",), corrections=True, key_buckets=4)


@pytest.fixture
def deliver(spark, tmp_path):
    lake = LakePaths(str(tmp_path / "lake"))

    def run(batch_id, rows, options=OPTIONS, header=HEADER):
        path = tmp_path / f"{batch_id}.csv"
        path.write_text(header + "".join(",".join(map(str, r)) + "\n" for r in rows))
        run_batch(spark, str(path), lake, options, run_id=batch_id, batch_id=batch_id)

    run.lake = lake
    return run


def gold(spark, lake, *dims):
    name = "monthly_revenue_by_category" if dims else "monthly_revenue"
    rows = marts.read_gold_batches(spark, lake, name, dims).collect()
    return {(r["month"], *[r[d] for d in dims]): r["total_sales"] for r in rows}


def test_cover_holds_every_batch_once():
    for number in (0, 1, 15, 16, 17, 255, 256, 300, 4097):
        held = [b for level, i in corrections.cover(number) for b in range(i * 16**level + 1, (i + 1) * 16**level + 1)]
        assert held == list(range(1, number + 1))
    assert len(corrections.cover(16**4 - 1)) == 15 * 4


def test_a_correction_moves_gold_by_the_difference(spark, deliver):
    deliver("b1", [(1, "1/5/2020", 10, "a"), (1, "1/5/2020", 4, "a"), (2, "1/6/2020", 5, "a"), (3, "2/1/2020", 7, "b")])
    deliver("b2", [(2, "3/1/2020", 6, "c"), (3, "2/1/2020", 7, "b"), (4, "2/1/2020", 1, "b")])
    want = {(1, "a"): 10, (3, "c"): 6, (2, "b"): 8}
    assert gold(spark, deliver.lake, "category") == want
    deliver("b3", [(1, "3/1/2020", 1, "c")])  # January has no row any more
    want = {(3, "c"): 7, (2, "b"): 8}
    for again in (None, "b3"):
        if again:
            deliver(again, [(1, "3/1/2020", 1, "c")])
        assert gold(spark, deliver.lake, "category") == want
        assert gold(spark, deliver.lake) == {(3,): 7, (2,): 8}
    rows = corrections.current_silver(spark, deliver.lake, ["order_id"]).collect()
    assert sorted((r["order_id"], int(r["sales_clean"]), r["batch_id"]) for r in rows) == [
        ("1", 1, "b3"), ("2", 6, "b2"), ("3", 7, "b1"), ("4", 1, "b2"),
    ]
    # an equal row that comes again is a duplicate, and counted as one
    counts = {r["run_id"]: r["row_duplicate"] for r in marts.audit_log(spark, deliver.lake).collect()}
    assert counts == {"b1": 1, "b2": 1, "b3": 0}


def test_back_to_an_earlier_value_and_an_early_batch_again(spark, deliver):
    first, second = [(1, "1/5/2020", 10, "a")], [(1, "2/5/2020", 20, "a")]
    for batch_id, rows in (("b1", first), ("b2", second), ("b3", first), ("b1", first), ("b2", second)):
        deliver(batch_id, rows)
        assert corrections.current_silver(spark, deliver.lake, ["order_id"]).count() == 1
    assert gold(spark, deliver.lake) == {(1,): 10}


def test_a_failed_batch_is_not_seen(spark, deliver, monkeypatch):
    deliver("b1", [(1, "1/5/2020", 10, "a")])
    with monkeypatch.context() as m, pytest.raises(ZeroDivisionError):
        m.setattr(corrections, "publish_turn", lambda *a: 1 / 0)
        deliver("b2", [(1, "2/5/2020", 99, "a"), (9, "2/5/2020", 99, "a")])
    assert gold(spark, deliver.lake) == {(1,): 10}
    assert corrections.current_silver(spark, deliver.lake, ["order_id"]).count() == 1
    deliver("b3", [(1, "3/5/2020", 30, "a")])
    assert gold(spark, deliver.lake) == {(3,): 30}
    deliver("b2", [(1, "2/5/2020", 99, "a"), (9, "2/5/2020", 99, "a")])  # now it comes after b3
    assert gold(spark, deliver.lake) == {(2,): 198}


def test_a_delivery_without_a_dimension(spark, deliver):
    deliver("b1", [(1, "1/5/2020", 10, "a"), (2, "1/5/2020", 3, "a")])
    deliver("b2", [(1, "1/5/2020", 4)], header="Order ID,Order Date,Sales\n")
    assert gold(spark, deliver.lake, "category") == {(1, "a"): 3}
    assert gold(spark, deliver.lake) == {(1,): 7}


def test_mixed_modes_are_refused(spark, deliver):
    deliver("b1", [(1, "1/5/2020", 10, "a")])
    with pytest.raises(ValueError, match="key table"):
        deliver("b2", [(2, "1/5/2020", 10, "a")], RunOptions(business_keys=("order_id",)))
    with pytest.raises(ValueError, match="business keys"):
        deliver("b2", [(2, "1/5/2020", 10, "a")], RunOptions(corrections=True))


def test_merged_segments_give_the_same_gold(spark, deliver, monkeypatch):
    """Random deliveries against a plain dictionary, over two levels of merges."""
    monkeypatch.setattr(corrections, "FAN", 2)
    monkeypatch.setattr(corrections.cover, "__defaults__", (2,))
    random.seed(5)
    current = {}
    for number in range(6):
        rows = {k: (k, f"{random.randint(1, 3)}/1/2020", random.randint(1, 9), random.choice("ab")) for k in random.sample(range(12), 5)}
        current.update(rows)
        deliver(f"b{number}", rows.values())
    want = {}
    for _, day, sales, category in current.values():
        key = (int(day[0]), category)
        want[key] = want.get(key, Decimal(0)) + sales
    assert gold(spark, deliver.lake, "category") == want
