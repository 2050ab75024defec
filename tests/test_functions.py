from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import cards as K
from ledgerloom.functions import dates as D
from ledgerloom.functions import geo as G
from ledgerloom.functions import money as M
from ledgerloom.functions import nested as N
from ledgerloom.functions import text as X
from ledgerloom.params import RunParams

col = F.col


def one(df, c):
    return [r[0] for r in df.select(c).collect()]


def test_masks(rows):
    df = rows("p string", [("4567891234567890",), ("123456789",), (" 4567891234 ",), (None,)])
    assert one(df, X.mask_pan(col("p"))) == ["456789******7890", "123456789", "456789******1234", None]
    assert one(df, X.mask_pan_keep_length(col("p"))) == ["456789*******890", "123456789", "456789*234", None]


def test_number_text(rows):
    df = rows("n decimal(18,4)", [(None,), (__import__("decimal").Decimal("-2.5"),), (__import__("decimal").Decimal("1.005"),)])
    assert one(df, X.money_text(col("n"))) == [None, "-2.50", "1.01"]
    assert one(rows("n long", [(7,), (123456,)]), X.zero_pad(col("n"), 3)) == ["007", "123456"]


def test_text_between_and_lists(rows):
    df = rows("t string", [("a[x]b",), ("none",), ("[open",)])
    assert one(df, X.text_between(col("t"), "[", "]")) == ["x", None, None]
    assert one(rows("l string", [("AMCX",), (None,)]), X.list_has_text(col("l"), F.lit("mc"))) == [True, False]


def test_weeks_and_iso_year(rows):
    df = rows("d date", [(dt.date(2024, 12, 30),), (dt.date(2023, 1, 1),), (dt.date(2024, 2, 29),)])
    assert one(df, D.iso_year2(col("d"))) == ["25", "22", "24"]
    assert one(df, D.monday_week_start(col("d"))) == [dt.date(2024, 12, 30), dt.date(2022, 12, 26), dt.date(2024, 2, 26)]
    assert one(df, D.sunday_week_start(col("d"))) == [dt.date(2024, 12, 29), dt.date(2023, 1, 1), dt.date(2024, 2, 25)]
    assert one(df, D.sunday_week_number(col("d"))) == [int(x.strftime("%U")) for x in (dt.date(2024, 12, 30), dt.date(2023, 1, 1), dt.date(2024, 2, 29))]
    assert one(rows("d date", [(dt.date(2024, 1, 31),)]), D.days_in_month(col("d"))) == [31]


@pytest.mark.parametrize("run", [dt.date(2001, 7, 11) + dt.timedelta(days=i) for i in range(9)])
def test_last_complete_week_is_thursday_to_wednesday_before_the_run(run):
    start, end = D.last_complete_week(run)
    assert (start.weekday(), end.weekday()) == (3, 2) and end < run and (run - end).days <= 7


def test_payout_dates(rows):
    days = [dt.date(2024, 3, 1) + dt.timedelta(days=i) for i in range(4)]  # Friday to Monday
    df = rows("d date", [(d,) for d in days])
    plan = lambda kind: D.payout_date(col("d"), F.lit(kind), F.lit(1), F.lit("Tuesday"))
    assert one(df, plan("Weekdays")) == [dt.date(2024, 3, 4), dt.date(2024, 3, 5), dt.date(2024, 3, 5), dt.date(2024, 3, 5)]
    assert one(df, plan("All")) == [d + dt.timedelta(days=1) for d in days]


def test_cutoffs(rows):
    df = rows("n int", [(0,), (1830,), (900,)])
    assert one(df, D.cutoff_shift_minutes(col("n"))) == [0, 330, 900]
    ts = rows("t timestamp_ntz", [(dt.datetime(2024, 1, 1, 17, 59, 59),), (dt.datetime(2024, 1, 1, 18),), (dt.datetime(2024, 1, 1, 18, 0, 1),)])
    assert one(ts, D.cutoff_label(col("t"))) == ["Pre", "Pre", "Post"]


def test_daylight_saving(rows):
    df = rows("t timestamp_ntz", [(dt.datetime(2024, 10, 5, 15, 59),), (dt.datetime(2024, 10, 5, 16, 0),)])
    assert one(df, D.local_from_utc(col("t"), "Australia/Sydney")) == [dt.datetime(2024, 10, 6, 1, 59), dt.datetime(2024, 10, 6, 3, 0)]


def test_timestamp_from_int(rows):
    df = rows("n long", [(20240203,), (20240203040506,), (99,), (None,)])
    assert one(df, D.timestamp_from_int(col("n"))) == [dt.datetime(2024, 2, 3), dt.datetime(2024, 2, 3, 4, 5, 6), None, None]


def test_fees_and_ratios(rows):
    df = rows("c string", [("ALL",), ("FIXED",), ("PERCENT",), ("?",)])
    assert one(df, M.processing_fee(col("c"), F.lit(200.0), F.lit(1.5), F.lit(0.3))) == [3.3, 0.3, 3.0, 0.0]
    assert one(rows("n long", [(4,), (0,)]), M.ratio(F.lit(2), col("n"))) == [0.5, 0.0]
    fee = M.service_fee(col("f"), F.lit("100.00").cast("decimal(18,2)"), F.lit("1.25"), F.lit("0.10"))
    assert [str(v) for v in one(rows("f string", [("Y",), ("N",)]), fee)] == ["1.3500", "0.0000"]
    kinds = rows("k string", [("PURCHASE",), ("REFUND",), ("REFUND REVERSAL",), (None,)])
    assert one(kinds, M.commission_flag(F.lit("S"), col("k"))) == ["Y", "N", "Y", "Y"]


def test_card_codes(rows):
    df = rows("p string, i string, a string, m string", [("RED", "x", "purchase", "1440"), ("FDI", "I0", "refund", "1240"), ("FDI", "z", "refund", None), ("??", "z", "cash", "1240")])
    assert one(df, K.scheme_of(col("p"), col("i"))) == ["GIFT CARDS", "UPI", "DINERS", None]
    assert one(df, K.calc_tran_type(col("p"), col("a"), col("m"))) == ["REDEMPTION REVERSAL", "REFUND", "REFUND", "CASH"]
    assert one(rows("x int", [(1,)]), K.wallet_uid(F.lit(None).cast("string"), F.lit(None).cast("date"), F.lit(None).cast("string"))) == ["LK_NULL_19000101T000000"]


def test_settlement_window_edges(rows):
    day = dt.date(2024, 5, 10)
    ts = rows("t timestamp_ntz", [(dt.datetime(2024, 5, 8),), (dt.datetime(2024, 5, 8, 0, 0, 1),), (dt.datetime(2024, 5, 10, 18, 30),), (dt.datetime(2024, 5, 10, 18, 30, 1),)])
    last = F.lit("2024-05-07 22:00:00").cast("timestamp_ntz")
    inside = K.in_settlement_window(col("t"), last, F.lit(1), F.lit(dt.date(2024, 1, 1)), F.lit(day), F.lit(0), F.lit(1830))
    assert one(ts, inside) == [False, True, True, False]


def test_distance_is_never_nan(rows):
    km = G.great_circle_km(F.lit(-33.8), F.lit(151.2), F.lit(-33.8), F.lit(151.2))
    assert one(rows("x int", [(1,)]), km) == [0.0]
    bands = rows("k double", [(9.9,), (10.0,), (100.0,), (None,)])
    assert one(bands, G.band(col("k"), [10, 50, 100])) == ["<10", "10-50", ">=100", "NA"]


def test_name_value_lookup(spark):
    df = spark.sql("SELECT array(named_struct('Name', 'a', 'Value', '1'), named_struct('Name', 'a', 'Value', '2'), named_struct('Name', cast(null as string), 'Value', 'x')) f UNION ALL SELECT array() UNION ALL SELECT null")
    got = sorted((r[0] or "") for r in df.select(F.try_element_at(N.name_value_map(col("f")), F.lit("a"))).collect())
    assert got == ["", "", "1"]


def test_report_window_spans_a_year_end():
    p = RunParams(dt.date(2024, 3, 15))
    assert (p.window_start, p.window_end, p.report_start) == (dt.date(2023, 5, 1), dt.date(2024, 4, 1), dt.date(2023, 8, 1))


def test_fiscal_calendar_has_whole_weeks_and_a_53rd(spark):
    import datetime as dt

    from ledgerloom.sources import tables as TB

    rows = TB.fiscal_calendar(TB.date_spine(spark, dt.date(2018, 6, 25), dt.date(2032, 6, 27))).collect()
    years = {}
    for r in rows:
        assert r["fw_start_date"] <= r["calendar_date"] <= r["fw_end_date"] and r["fw_start_date"].weekday() == 0
        assert r["fp_start_date"] <= r["fw_start_date"] and r["fw_end_date"] <= r["fp_end_date"]
        years.setdefault(r["fy_start_date"], set()).add((r["wofy"], r["pofy"]))
    whole = sorted(years)[:-1]
    assert {max(w for w, _ in years[y]) for y in whole} == {52, 53}
    for y in whole:
        per = [sum(p == k for _, p in years[y]) for k in range(1, 13)]
        assert per[:11] == [4, 4, 5] * 3 + [4, 4] and per[11] in (5, 6)
