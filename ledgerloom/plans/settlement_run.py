"""The settlement run: file lines, history, audit, watermarks, control rows and marks, committed as one batch.

State lives in ``VersionedTables``: settlement (by day or another period, open rows in parts of their own),
windows, windows_by_store, result, history (by run), audit and control.  Everything is worked out from the version the run starts
with, so a run that stops anywhere leaves that version, and a run that is repeated after its
commit does nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import dates as D
from ledgerloom.functions import text as X
from ledgerloom.operators import control as O
from ledgerloom.operators import joins as J
from ledgerloom.plans import settlement as P
from ledgerloom.sinks.versions import VersionedTables, Write

_TS = "transaction_timestamp"
_OPEN = " open"


def _part() -> Column:
    """A row's part: its period; open rows, which a run settles, are apart from those it leaves alone."""
    is_open = F.col("setlmnt_result_file").isNull() & ~F.col("tran_uid").startswith("QP")
    return F.concat("period", F.when(is_open, _OPEN).otherwise(""))


def _shaped(rows: DataFrame, period: str) -> DataFrame:
    """The settlement table's shape: posting date, and the period it is divided by."""
    posting = F.col("posting_date") if "posting_date" in rows.columns else F.lit(None).cast("date").alias("posting_date")
    return rows.select(*[c for c in rows.columns if c != "posting_date"], posting, F.coalesce(F.date_format(_TS, period), F.lit("null")).alias("period"))


def start(tables: VersionedTables, settlement: DataFrame, windows: DataFrame, by_store: DataFrame, batch: str, period: str = "yyyy-MM-dd") -> bool:
    """The first version: standard settlement rows, divided by day or another ``period``, and both kinds of windows."""
    return tables.commit(batch, {"settlement": Write(_shaped(settlement, period), by=_part()), "windows": Write(windows), "windows_by_store": Write(by_store)})


def arrive(tables: VersionedTables, rows: DataFrame, batch: str, period: str = "yyyy-MM-dd") -> bool:
    """Rows that came in since, once a batch."""
    return tables.commit(batch, {"settlement": Write(_shaped(rows, period), "append", _part())})


def _mapped(sap_map: DataFrame) -> DataFrame:
    return sap_map.where((X.norm_key(F.coalesce("active_flag", F.lit(""))) != "N") & X.non_blank(F.col("company_code")))


def _posting(sap_map: DataFrame, companies: DataFrame) -> DataFrame:
    """Mapped stores with their company and the file their open rows are posted in."""
    rows = _mapped(sap_map).select(F.col("store_number").alias("store_id"), "company_code")
    return J.lookup(rows, companies, {"company_code": "company_code"}, {"file_name": "posting_file"}, "inner")


def audit_places(posting: DataFrame, store: DataFrame, windows: DataFrame, by_store: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Posted stores with their division and cut-offs: the store's where the division settles by store and the store has a window."""
    rows = J.lookup(posting.select("store_id", "posting_file"), store, {"store_id": "store_id"}, ["division"], "inner")
    own = windows.where((F.col("is_active") == "Y") & (F.trim("division_type") != "PARTNER"))
    rows = J.lookup(rows, own, {"division": "division"}, ["settle_by_store", "last_execution_time", "day_lag", "settlement_cutoff"], "inner")
    per_store = by_store.where(F.col("is_active") == "Y").withColumn("has_window", F.lit(True))
    rows = J.lookup(rows, per_store, {"store_id": "store_id"}, {c: f"s_{c}" for c in ("has_window", "last_execution_time", "day_lag", "settlement_cutoff")})
    of_division = F.col("s_has_window").isNull() | (F.col("settle_by_store") == "N")
    pick = lambda c: F.when(of_division, F.col(c)).otherwise(F.col(f"s_{c}"))
    first = F.coalesce(pick("last_execution_time"), F.lit("1900-01-01").cast("timestamp_ntz"))
    last = D.cutoff_on(F.date_add(F.lit(run_ts.date()), pick("day_lag")), pick("settlement_cutoff"))
    return rows.select("store_id", "posting_file", "division", first.alias("first_cutoff"), last.alias("last_cutoff"))


def audit(unsettled: DataFrame, places: DataFrame, batch: str, run_ts: dt.datetime) -> DataFrame:
    """J-15: counts, amounts and cut-offs for each division, record type, source file and posting file."""
    rows = J.lookup(unsettled, places, {"store_id": "store_id"}, ["posting_file", "division", "first_cutoff", "last_cutoff"], "inner")
    out = O.audit_batch(rows, ["division", "record_type", "filename", "posting_file"], _TS, "settlement_cents", "discount_cents", F.col("first_cutoff"), F.col("last_cutoff"), batch)
    return out.withColumn("created", D.at(run_ts))


def control(unsettled: DataFrame, posting: DataFrame, companies: DataFrame, batch: str, run_ts: dt.datetime) -> DataFrame:
    """J-13: one row a company that has rows, with their first and last time to the second."""
    rows = J.lookup(unsettled.select("store_id", _TS), posting, {"store_id": "store_id"}, ["company_code"], "inner")
    spans = rows.groupBy("company_code").agg(F.min(_TS).alias("lo"), F.max(_TS).alias("hi"))
    rows = J.lookup(companies, spans, {"company_code": "company_code"}, ["lo", "hi"], "inner")
    ends = D.plus_seconds(D.at(run_ts), F.col("entity_seq"))
    second = lambda c: F.date_trunc("second", c).cast("timestamp_ntz")
    return rows.select(
        F.lit(batch).alias("batch_number"),
        ends.cast("date").alias("processing_date"),
        P.merchant_name("ledgersettlement", F.col("company_code")).alias("merchant_name"),
        F.lit(True).alias("etl_complete"),
        F.lit(None).cast("boolean").alias("extract_wf_complete"),
        F.coalesce(second("lo"), ends).alias("extract_start"),
        F.coalesce(second("hi"), ends).alias("extract_end"),
        ends.alias("file_date"),
        F.lit(None).cast("string").alias("remarks"),
    )


def newest(settlement: DataFrame) -> DataFrame:
    """The newest time of each store and source, which is all that watermarks need; a source stands for its ids."""
    facts = settlement.where(~F.col("tran_uid").startswith("QP"))
    return facts.groupBy(F.left("tran_uid", F.lit(2)).alias("tran_uid"), "store_id").agg(F.max(_TS).alias(_TS))


def division_watermarks(facts: DataFrame, store: DataFrame, windows: DataFrame, by_store: DataFrame) -> DataFrame:
    """J-17: windows of divisions; stores with a window of their own don't count for their division."""
    rest = J.left_anti(facts, by_store.where(F.col("is_active") == "Y"), ["store_id"])
    rest = J.lookup(rest, store, {"store_id": "store_id"}, ["division"], "inner")
    return O.advance_watermark(windows, rest, "division", _TS)


def marked(unsettled: DataFrame, posting: DataFrame, run_ts: dt.datetime, aside: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """J-16: open rows with the file of their store; rows of one id all get the greatest file of any of them.

    Ids that repeat are found by a count of their hashes and only their rows are grouped, so the rows
    are not joined with themselves.
    """
    files = aside(posting.groupBy("store_id").agg(F.max("posting_file").alias("__own")))
    rows = J.lookup(unsettled, files, {"store_id": "store_id"}, ["__own"])
    repeated = aside(unsettled.groupBy(F.xxhash64("tran_uid").alias("__h")).agg(F.count("*").alias("__n")).where(F.col("__n") > 1).select("__h"))
    several = J.left_semi(rows.select("tran_uid", "__own", F.xxhash64("tran_uid").alias("__h")), repeated, ["__h"])
    greatest = aside(several.groupBy("tran_uid").agg(F.max("__own").alias("__any")).where(F.col("__any").isNotNull()))
    rows = J.lookup(rows, greatest, {"tran_uid": "tran_uid"}, ["__any"])
    file = F.coalesce("__any", "__own")
    posted = F.when(file.isNotNull(), F.lit(run_ts.date())).otherwise(F.col("posting_date"))
    return rows.withColumns({"setlmnt_result_file": F.coalesce(file, F.col("setlmnt_result_file")), "posting_date": posted}).select(unsettled.columns)


def run(
    tables: VersionedTables, store: DataFrame, sap_map: DataFrame, batch: str, run_ts: dt.datetime, prefix: str = "LEDGER", after_write: Callable[[str], None] | None = None
) -> bool:
    """One settlement run; False if the batch is committed already or has no number (C-22).

    Of the settlement table only the parts of open rows are read for files and marks, and written anew:
    rows that get their file are added to the settled rows of their period, which stay as they are.  A
    row that has its file keeps it, even if an open row has the same id.  What depends on the store
    alone is worked out once and joined to the rows in one step.
    """
    if not O.usable_batch(batch) or tables.holds(batch):
        return False
    std, windows, by_store = (tables.read(t) for t in ("settlement", "windows", "windows_by_store"))
    touched = tuple(p for p in tables.parts("settlement") if p.endswith(_OPEN))
    unsettled = tables.read("settlement", parts=touched)
    companies = P.company_files(sap_map, prefix, run_ts)
    posting = cache(lambda: tables.aside(_posting(sap_map, companies)))
    facts = cache(lambda: tables.aside(newest(std)))
    stamp: Column = D.at(run_ts)

    def lines(_) -> DataFrame:
        places = tables.aside(P.ledger_places(store, windows, sap_map, run_ts, prefix))
        return P.ledger_file(P.ledger_lines(P.placed_detail(unsettled, places)), sap_map, run_ts, prefix)

    writes = {
        "result": Write(lines),
        "history": Write(lambda written: written("result").select(stamp.alias("run_ts"), F.lit(batch).alias("run"), "*"), "append", one=batch),
        "audit": Write(lambda _: audit(unsettled, tables.aside(audit_places(posting(), store, windows, by_store, run_ts)), batch, run_ts), "append"),
        "windows_by_store": Write(lambda _: O.advance_watermark(by_store, facts(), "store_id", _TS)),
        "windows": Write(lambda _: division_watermarks(facts(), store, windows, by_store)),
        "control": Write(lambda _: control(unsettled, posting(), companies, batch, run_ts), "append"),
        "settlement": Write(lambda _: marked(unsettled, posting(), run_ts, tables.aside), "move", _part(), touched),
    }
    return tables.commit(batch, writes, after_write)
