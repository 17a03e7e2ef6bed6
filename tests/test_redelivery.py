"""Failing messages are tried again with later batches."""

import pytest
from pyspark.sql import functions as F

from docflow.operators import Outcome
from docflow.streaming import redelivery
from test_streaming import files, run, source

SCHEMA = "id STRING, works_at INT"


def test_fails_twice_and_then_works(spark, tmp_path):
    """``works_at`` is the number of the call, counted over all batches, from which a message is accepted."""
    rows = [("now", 0), ("third", 3), ("never", 99), ("now", 0), (None, 0), ("late", 5), ("x", 0), ("y", 0), ("z", 0)]
    folder, table, check = (str(tmp_path / n) for n in ("in", "table", "check"))
    files(spark, rows, SCHEMA, folder, [slice(0, 5)])
    batch = [0]

    def handle(df):
        ok = F.col("works_at") <= batch[0]
        return Outcome(df.where(ok), df.where(~ok).withColumn("reason", F.lit(f"refused in {batch[0]}")))

    def ids(df, *names):
        return sorted((tuple(r) for r in df.select(*names).collect()), key=str)

    for cut in (None, slice(5, 7), slice(7, 8), slice(8, 9)):
        batch[0] += 1
        if cut:
            files(spark, rows, SCHEMA, folder, [cut])
        run(redelivery.stream_redelivered(source(spark, SCHEMA, folder), table, check, handle))
        if batch[0] == 2:
            assert ids(redelivery.waiting_messages(spark, table), "id", "attempt", "reason") == [
                ("late", 1, "refused in 2"), ("never", 2, "refused in 2"), ("third", 2, "refused in 2")]
    done = ids(redelivery.accepted_messages(spark, table), "id", "attempt")
    assert done == sorted([("now", 1), ("now", 1), (None, 1), ("third", 3), ("x", 1), ("y", 1), ("z", 1)], key=str)
    assert ids(redelivery.dead_messages(spark, table), "id", "attempt", "reason") == [
        ("late", 3, "refused in 4"), ("never", 3, "refused in 3")]
    assert redelivery.waiting_messages(spark, table).count() == 0


def test_one_attempt(spark, tmp_path):
    folder, table, check = (str(tmp_path / n) for n in ("in", "table", "check"))
    files(spark, [("a", 1), ("b", 0)], SCHEMA, folder, [slice(0, 2)])
    run(redelivery.stream_redelivered(source(spark, SCHEMA, folder), table, check, lambda df: Outcome(
        df.where("works_at = 0"), df.where("works_at > 0").withColumn("reason", F.lit("no"))), attempts=1))
    assert [r.id for r in redelivery.dead_messages(spark, table).collect()] == ["a"]
    assert redelivery.waiting_messages(spark, table).count() == 0
    with pytest.raises(ValueError):
        redelivery.stream_redelivered(source(spark, SCHEMA, folder), table, check, None, attempts=0)
