"""Direct-entry days too large for one file: several files, each with a trailer that holds its total."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.plans import fees as P


def test_direct_entry_beyond_one_trailer_takes_several_files(rows):
    big = 6_000_000_000
    amounts = {"S000000001": big, "S000000002": big, "S000000003": 25_000_000_000, "S000001001": 7, "S000001002": big, "S000002001": 0}
    stores = [(s, "062-001", s[1:], "t") for s in [*amounts, "S000002001"]]
    accounts = rows("store_number string, bsb string, account string, title string", list(dict.fromkeys(stores)))
    out = P.direct_entry(rows("store_number string, cents long", list(amounts.items())), accounts, dt.date(2001, 7, 14), 1).collect()
    per, paid = {}, {}
    for r in out:
        per.setdefault(r.file_name, {0: [], 1: [], 2: []})[r.line_rank].append(r)
    assert sorted(per) == [f"DE.010714{i}" for i in range(1, len(per) + 1)] and len(per) > 4
    for lines in per.values():
        assert len(lines[0]) == len(lines[2]) == 1
        cents = [int(r.line[20:30]) for r in lines[1]]
        assert int(lines[2][0].line[20:30]) == sum(cents) and int(lines[2][0].line[-6:]) == len(cents)
        for r, c in zip(lines[1], cents):
            paid[r.sort_key] = paid.get(r.sort_key, 0) + c
    assert paid == {s: c for s, c in amounts.items() if c}


def test_entry_files_by_number_of_payments(rows):
    few = rows("store_number string, cents long", [(f"S{i:09d}", 10) for i in range(25)])
    assert sorted(r["count"] for r in P.entry_files(few, lines_limit=10).groupBy("file_no").count().collect()) == [5, 10, 10]
    assert P.entry_files(few, lines_limit=25).agg(F.max("file_no")).first()[0] == 0
    assert P.entry_files(few.limit(0)).count() == 0
