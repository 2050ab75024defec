"""Invariants of the settlement flow on the derived feeds."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import control as O
from ledgerloom.operators import windows as W
from ledgerloom.plans import settlement as P
from ledgerloom.workload.feeds import RUN_TS, Tables

col = F.col


@pytest.fixture(scope="module")
def t(spark):
    return Tables(spark, "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def detail(t):
    return P.ledger_detail(t.settlement_std, t.store, t.settlement_window, t.sap_map, RUN_TS)


def test_trailer_equals_the_sum_of_its_details(t, detail):
    lines = P.ledger_file(P.ledger_lines(detail), t.sap_map, RUN_TS)
    per = {}
    for r in lines.collect():
        per.setdefault(r.file_name, {"H": [], "D": [], "T": []})[r.record_type].append(r)
    assert per
    for parts in per.values():
        assert len(parts["H"]) == len(parts["T"]) == 1
        assert parts["T"][0].amount_cents == sum(d.amount_cents for d in parts["D"])
        assert parts["T"][0].line_count == len(parts["D"])


def test_net_and_commission_add_up_to_the_amounts(detail):
    gap = detail.select(F.sum(col("net") + col("commission")).alias("a"), F.sum((col("settlement_cents") + col("discount_cents")).cast("decimal(20,4)") / 100).alias("b")).first()
    assert gap.a == gap.b


def test_marking_leaves_nothing_open_twice(t, detail):
    std = t.settlement_std.withColumn("posting_date", F.lit(None).cast("date"))
    posted = detail.select("tran_uid", col("file_name").alias("result_file"))
    done = O.mark_processed(std, posted, RUN_TS)
    assert done.count() == std.count()
    again = P.ledger_detail(done, t.store, t.settlement_window, t.sap_map, RUN_TS)
    assert again.isEmpty()


def test_repeated_ids_are_rejected_in_every_copy(t):
    one = P.wallet_source(t.wallet_txn, 10)
    both = P.combined([one, one.limit(5)])
    kept = W.without_repeats(one, ["tran_uid"], both)
    assert kept.count() == W.reject_all_copies(P.combined([one]), ["tran_uid"]).count() - 5


def test_a_value_longer_than_its_field_ends_the_job(rows):
    import pytest
    from pyspark.errors import PySparkException

    from ledgerloom.sinks import files as S

    df = rows("cents long, title string", [(12345678901, "a long title")])
    line = lambda width: df.select(S.fixed_width_line([S.Slot(F.col("cents"), width, right=True, fill="0"), S.Slot(F.col("title"), 6, cut=True)]).alias("line"))
    assert line(12).first()[0] == "012345678901a long"
    with pytest.raises(PySparkException, match="longer than its field"):
        line(10).collect()
