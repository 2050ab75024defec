"""Secrets in texts: rules for known forms, and two character Markov models for the rest.

Long tokens are scored by the log-likelihood ratio of two first-order models, one of random
strings and one of ordinary identifiers.  They are trained from labelled strings of a bounded
sample of ``SAMPLE_DOCS`` documents (lowest hash first): values that the rules found and digests
of the sample's ids in three encodings count as random, the sample's words as ordinary.  The two
models are one table over pairs of ASCII characters.  Everything runs in native functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.matching import bound, found, places, running

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
#: kinds in the order of the contract; the model's spans come last
KINDS = ("assign", "access", "hex", "random")
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WORD = r"[A-Za-z][A-Za-z0-9_-]{5,}"
ASSIGN_LENGTH = 8
SAMPLE_DOCS = 2000
#: log odds from which a token counts as random
LEAST_RATIO = 10.0
_SPANS = "array<struct<start:int,kind:int,end:int>>"


def _none() -> Column:
    return F.array().cast(_SPANS)


def _of_kind(text: Column, pattern: str, kind: int, keep: Column | None = None) -> Column:
    """Spans of one kind; ``keep`` is an array of booleans, one a match."""
    at = places(text, pattern)
    if keep is not None:
        at = F.filter(F.zip_with(at, keep, lambda s, k: F.when(k, s)), lambda s: s.isNotNull())
    spans = F.transform(at, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))
    return F.when(text.rlike(pattern), spans).otherwise(_none())


def base_spans(text: Column) -> list[Column]:
    """Spans of the three rules."""
    long_enough = F.transform(found(text, ASSIGN, 2), lambda v: F.length(v) >= ASSIGN_LENGTH)
    return [_of_kind(text, ASSIGN, 0, long_enough), _of_kind(text, ACCESS, 1), _of_kind(text, HEX, 2)]


def transition_table(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> list[float]:
    """ln P(b | a, random) - ln P(b | a, ordinary) at 128 a + b, both with 0.5 added to each pair."""
    share = min(1.0, 2 * sample_docs / max(docs.count(), 1))  # about twice the sample is ordered, however many documents there are
    hashed = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.xxhash64("doc_id").alias("h"))
    sample = hashed.where(F.pmod("h", F.lit(1 << 30)) < int(share * (1 << 30))).orderBy("h", "text").limit(sample_docs)
    digest = F.sha2(F.col("h").cast("string"), 256)
    random = F.flatten(F.array(F.filter(found("text", ASSIGN, 2), lambda v: F.length(v) >= ASSIGN_LENGTH), found(F.col("text"), ACCESS), found(F.col("text"), HEX)))
    made = F.array(digest, F.base64(F.unhex(digest)), F.upper(F.translate(F.base64(F.unhex(digest)), "+/=", "XYZ")))
    random = F.concat(random, made)
    strings = sample.select(F.explode(F.concat(F.transform(random, lambda s: F.struct(F.lit(1).alias("random"), s.alias("s"))), F.transform(found(F.col("text"), WORD), lambda s: F.struct(F.lit(0).alias("random"), s.alias("s"))))).alias("x")).select("x.*")
    pairs = F.transform(F.sequence(F.lit(1), F.length("s") - 1), lambda i: F.ascii(F.substring(F.col("s"), i, F.lit(1))) * 128 + F.ascii(F.substring(F.col("s"), i + 1, F.lit(1))))
    counted = strings.where(F.length("s") > 1).select("random", F.explode(pairs).alias("pair")).groupBy("random", "pair").count().collect()  # at most 2 * 128 * 128 rows
    counts = [[0.5] * (128 * 128) for _ in range(2)]
    for r in counted:
        counts[r["random"]][r["pair"]] += r["count"]
    rows = [[sum(c[128 * a : 128 * a + 128]) for a in range(128)] for c in counts]
    return [math.log(counts[1][p] / rows[1][p // 128]) - math.log(counts[0][p] / rows[0][p // 128]) for p in range(128 * 128)]


def ratio(token: Column, table: list[float]) -> Column:
    """Log-likelihood ratio of a token's transitions."""
    values = F.split(F.lit(",".join(f"{x:.5f}" for x in table)), ",").cast("array<double>")
    char = lambda i: F.ascii(F.substring(token, i, F.lit(1)))
    return F.aggregate(F.sequence(F.lit(1), F.length(token) - 1), F.lit(0.0), lambda acc, i: acc + F.get(values, char(i) * 128 + char(i + 1)))


def scan(docs: DataFrame, table: list[float] | None = None) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, base and all, arrays of (start, kind, end)
    sorted by start and kind; places are code points, ends exclusive.

    The model adds spans only where no rule's span overlaps.  Null and empty texts have no spans;
    repeated rows give the same; other columns don't matter; an empty table gives no rows.
    """
    table = transition_table(docs) if table is None else table
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    base = F.concat(*base_spans(F.col("text")))
    random = F.transform(found(F.col("text"), CANDIDATE), lambda s: ratio(s, table) >= LEAST_RATIO)
    rows = rows.select("doc_id", base.alias("base"), _of_kind(F.col("text"), CANDIDATE, 3, random).alias("random"))
    every = F.when(F.size("random") == 0, F.array_sort("base")).otherwise(bound(F.array_sort(F.concat("base", "random")), _apart))
    return rows.select("doc_id", F.array_sort("base").alias("base"), every.alias("all"))


def _apart(spans: Column) -> Column:
    """The rules' spans, and those of the model that overlap none of them; ``spans`` are sorted."""
    rule = lambda s: s["kind"] < len(KINDS) - 1
    ends = running(F.transform(spans, lambda s: F.when(rule(s), s["end"]).otherwise(0)), F.greatest)
    starts = F.reverse(running(F.reverse(F.transform(spans, lambda s: F.when(rule(s), s["start"]).otherwise((1 << 31) - 1))), F.least))
    near = F.zip_with(ends, starts, lambda e, s: F.struct(e.alias("until"), s.alias("from")))
    kept = F.zip_with(spans, near, lambda s, n: F.when(rule(s) | ((n["until"] <= s["start"]) & (n["from"] >= s["end"])), s))
    return F.filter(kept, lambda s: s.isNotNull())


def _listed(spans: str) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, table: list[float] | None = None) -> DataFrame:
    of = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return scan(docs, table).select(F.col("doc_id").cast("long").alias("doc_id"), of(0), of(1), of(2), F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("all").alias("spans"))
