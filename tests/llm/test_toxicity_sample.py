"""The fit takes one row a labelled id."""

from __future__ import annotations

from ledgerloom.llm import severity


def test_repeated_ids_are_one_row(spark, documents):
    rows = [(1, f"text number {i % 9}") for i in range(300)] + [(i, f"other {i}") for i in range(2, 9)] + [(9, None), (9, None)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 10)], "doc_id long, toxic int")
    got = sorted(map(tuple, severity.labelled_sample(documents(rows), labels, 3).collect()))
    again = sorted(map(tuple, severity.labelled_sample(documents(rows[::-1]), labels, 3).collect()))
    assert got == again and len(got) == 6
    everything = severity.labelled_sample(documents(rows), labels, 100).collect()
    assert sorted(r["labelled_id"] for r in everything) == list(range(1, 10))
