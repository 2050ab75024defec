from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import joins as J
from ledgerloom.operators import rollup as R
from ledgerloom.operators import windows as W

col = F.col
D = dt.date


def by(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_rolling_average_skips_zero_months_and_gaps(rows):
    months = rows(
        "k string, mon date, v long",
        [("a", D(2000, 10, 1), 30), ("a", D(2000, 11, 1), 0), ("a", D(2000, 12, 1), 10), ("a", D(2001, 1, 1), 7), ("a", D(2001, 5, 1), 9), (None, D(2000, 12, 1), 5), (None, D(2001, 1, 1), 6)],
    )
    out = by(W.rolling_previous(months, ["k"], "mon", {"b": W.rolling_nonzero(col("v"))}), "k", "mon")
    assert out["a", D(2001, 1, 1)].b == 20.0  # zero November leaves the divisor at two
    assert out["a", D(2000, 10, 1)].b is None
    assert out["a", D(2001, 5, 1)].b is None  # three empty months, January is too old
    assert out[None, D(2001, 1, 1)].b is None  # a null key has no history
    shared = by(W.rolling_previous(months, ["k"], "mon", {"b": W.rolling_nonzero(col("v"))}, null_keys_match=True), "k", "mon")
    assert shared[None, D(2001, 1, 1)].b == 5.0


def test_rolling_average_start_date_and_empty_value(rows):
    months = rows("k string, mon date, v long", [("a", D(2000, 1, 1), 4), ("a", D(2000, 2, 1), 6), ("a", D(2000, 3, 1), 8)])
    out = by(W.rolling_previous(months, ["k"], "mon", {"b": W.rolling_nonzero(col("v"))}, baseline_from=D(2000, 2, 1), empty=0.0), "mon")
    assert [out[(m,)].b for m in (D(2000, 1, 1), D(2000, 2, 1), D(2000, 3, 1))] == [None, 4.0, 5.0]


def test_rolling_window_agrees_with_self_join_on_random_months(rows):
    rng = random.Random(3)
    data, seen = [], set()
    for _ in range(200):
        k, m = rng.choice("abc"), rng.randrange(40)
        if (k, m) not in seen:
            seen.add((k, m))
            data.append((k, D(2000 + m // 12, m % 12 + 1, 1), rng.choice([0, 0, 5, 9, 12])))
    value = {(k, m.year * 12 + m.month): v for k, m, v in data}
    got = by(W.rolling_previous(rows("k string, mon date, v long", data), ["k"], "mon", {"b": W.rolling_nonzero(col("v"))}), "k", "mon")
    for k, m, _ in data:
        prev = [value.get((k, m.year * 12 + m.month - i), 0) for i in (1, 2, 3)]
        n = sum(p != 0 for p in prev)
        assert got[k, m].b == (sum(prev) / n if n else None)


@pytest.mark.parametrize("keys", [["k"], []])
def test_running_sum_matches_brute_force_when_one_key_dominates(rows, keys):
    rng = random.Random(5)
    data = [("hot" if rng.random() < 0.6 else f"k{rng.randrange(9)}", i, rng.randrange(50), rng.randrange(-3, 9)) for i in range(800)]
    df = rows("k string, id long, t long, v long", data)
    order = [col("k"), col("t"), col("id")]
    if keys:
        out = W.running_sum(df, keys, order, col("v"), F.floor(col("t") / 5), "s")
    else:
        out = W.running_sum(df, keys, order, col("v"), [F.struct("k", F.floor(col("t") / 5).alias("b")), F.left("k", F.lit(1))], "s")
    got = {r.id: r.s for r in out.collect()}
    total: dict = {}
    for k, i, t, v in sorted(data, key=lambda r: (r[0], r[2], r[1])):
        g = k if keys else None
        total[g] = total.get(g, 0) + v
        assert got[i] == total[g]


def test_running_sum_with_common_source(rows):
    df = rows("k string, t long, v long", [("a", i, i) for i in range(20)])
    one = W.sequence_in_group(df, ["k"], [col("t")], F.floor(col("t") / 3), "n", df)
    two = W.running_sum(one, ["k"], [col("t")], col("v"), F.floor(col("t") / 4), "s", df)
    assert all(r.n == r.t + 1 and r.s == r.t * (r.t + 1) // 2 for r in two.collect())


def test_reject_all_keep_first_and_ties(rows):
    df = rows("k string, t long, v string", [("a", 1, "x"), ("a", 1, "y"), ("b", 2, "z"), (None, 3, "n")])
    assert {r.k for r in W.reject_all_copies(df, ["k"]).collect()} == {"b", None}
    assert {(r.k, r.v) for r in W.keep_first(df, ["k"], [col("t"), col("v")]).collect()} == {("a", "x"), ("b", "z"), (None, "n")}
    assert sorted(r.v for r in W.latest_with_ties(df.where(col("k").isNotNull()), ["k"], "t").collect()) == ["x", "y", "z"]


def test_active_months_before(rows):
    df = rows("s string, m date", [("a", D(2000, 1, 5)), ("a", D(2000, 1, 9)), ("a", D(2000, 4, 1)), ("b", D(2000, 2, 1)), ("b", D(2000, 6, 1))])
    got = {(r.m, r.s): r.n for r in W.active_periods_before(df, "s", "m", "n").collect()}
    # calendar: Jan, Feb, Apr, Jun
    assert got == {(D(2000, 2, 1), "a"): 1, (D(2000, 4, 1), "a"): 1, (D(2000, 6, 1), "a"): 2, (D(2000, 4, 1), "b"): 1, (D(2000, 6, 1), "b"): 1}


def test_prior_period_does_not_take_a_gap_for_the_previous(rows):
    df = rows("k string, m date, v long", [("a", D(2000, 12, 1), 1), ("a", D(2001, 1, 1), 2), ("a", D(2001, 3, 1), 3)])
    out = by(W.prior_period(df, ["k"], W.D.month_index(col("m")), {"p": col("v")}, 1), "m")
    assert [out[(m,)].p for m in (D(2000, 12, 1), D(2001, 1, 1), D(2001, 3, 1))] == [None, 1, None]


def test_not_in_null_rules(rows):
    df = rows("k long", [(1,), (2,), (None,)])
    assert {r.k for r in J.not_in(df, rows("k long", [(1,)]), "k").collect()} == {2}
    assert J.not_in(df, rows("k long", [(1,), (None,)]), "k").count() == 0
    assert J.not_in(df, rows("k long", []), "k").count() == 3


def test_full_outer_keeps_null_keys_apart(rows):
    out = J.full_outer(rows("k long, a string", [(1, "l"), (None, "ln")]), rows("k long, b string", [(1, "r"), (None, "rn"), (2, "x")]), ["k"])
    assert sorted((r.k or 0, r.a or "", r.b or "") for r in out.collect()) == [(0, "", "rn"), (0, "ln", ""), (1, "l", "r"), (2, "", "x")]


def test_duplicate_threshold_stops_the_query(rows):
    control = rows("rule_id double, attribute string, merchant string, merchant_to_report string, value double", [(1.0, "Low", "M", "", 5.0), (1.0, "Low", "M", "", 6.0)])
    with pytest.raises(Exception, match="duplicate key"):
        J.threshold(rows("m string", [("M",)]), control, col("m"), 1, "Low").collect()


def test_threshold_falls_back_to_default_then_constant(rows):
    control = rows("rule_id double, attribute string, merchant string, merchant_to_report string, value double", [(1.0, "Low", "M", "", 5.0), (1.0, "Def", "*", "", 7.0)])
    out = by(J.threshold(rows("m string", [("M",), ("N",)]), control, col("m"), 1, "Low", "Def", 0.2, out="t"), "m")
    assert (round(out[("M",)].t, 6), round(out[("N",)].t, 6)) == (0.05, 0.07)
    bare = by(J.threshold(rows("m string", [("N",)]), control, col("m"), 2, "Low", None, 0.2, out="t"), "m")
    assert bare[("N",)].t == 0.2


def test_levels_tell_all_from_null(rows):
    out = R.levels(rows("a string, v long", [("x", 1), (None, 2)]), ["a"], [["a"], []], {"v": F.sum("v")})
    assert sorted((r.a or "", r.v) for r in out.collect()) == [("", 2), ("All", 3), ("x", 1)]


def test_range_lookup_forms_agree(rows):
    facts = rows("k string, d date", [("a", D(2000, 1, 1)), ("a", D(2000, 6, 30)), ("a", D(2000, 7, 1)), ("a", D(2031, 1, 1)), ("b", D(2000, 1, 1))])
    rates = rows("k string, f date, t date, r long", [("a", D(2000, 1, 1), D(2000, 6, 30), 1), ("a", D(2000, 7, 1), None, 2)])
    plain = J.range_lookup(facts, rates, {"k": "k"}, col("d"), "f", "t", ["r"])
    monthly = J.range_lookup(facts, rates, {"k": "k"}, col("d"), "f", "t", ["r"], by_month=True)
    want = {("a", D(2000, 1, 1)): 1, ("a", D(2000, 6, 30)): 1, ("a", D(2000, 7, 1)): 2, ("a", D(2031, 1, 1)): 2, ("b", D(2000, 1, 1)): None}
    for out in (plain, monthly):
        assert {(r.k, r.d): r.r for r in out.collect()} == want


def test_ranges_split_a_key_that_holds_most_rows(spark, tmp_path):
    """Nine tenths of the rows in one key on one day: even ranges, exact totals, nulls and ties included."""
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 7).when(F.col("id") % 11 == 0, None).otherwise(-1).alias("k"), (F.col("id") % 4999).alias("o"), (F.col("id") % 13).alias("v"), "id"
    )
    got = W.running_sum_by_range(rows, ["k"], [F.col("o"), F.col("id").desc()], F.col("v"), "upto", str(tmp_path / "r"), 16).collect()
    assert len(got) == 20_000
    by = {}
    for r in got:
        by.setdefault(r["k"], []).append(r)
    for some in by.values():
        total = 0
        for r in sorted(some, key=lambda r: (r["o"], -r["id"])):
            total += r["v"]
            assert r["upto"] == total
    parts = spark.read.parquet(str(tmp_path / "r")).groupBy("__part").count().collect()
    assert len(parts) >= 14 and max(p["count"] for p in parts) < 3 * 20_000 / 16
    hot = spark.read.parquet(str(tmp_path / "r")).where("k = -1").select("__part").distinct().count()
    assert hot >= 11
    empty = W.running_sum_by_range(rows.limit(0), [], [F.col("o")], F.col("v"), "upto", str(tmp_path / "e"))
    assert empty.collect() == [] and empty.columns == ["k", "o", "v", "id", "upto"]
