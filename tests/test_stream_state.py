"""Tracking with keyed state, and the lookup of signatures that grows."""

import random

import pytest
from pyspark.sql import functions as F

from docflow import schemas as S
from docflow import streaming
from docflow.operators import lineage, tracking
from docflow.streaming import batches, signatures, state
from test_state import LINEAGE, STATUS, lineage_row, status
from test_streaming import files, run, source


def last_progress(writer):
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    return q.lastProgress, q.recentProgress


def some_events(seed, n=90, documents=8):
    rng, rows = random.Random(seed), []
    for i in range(n):
        stage = rng.choice([S.STAGE_ANNOTATE, S.STAGE_CLASSIFIER, "other"])
        init = "True" if rng.random() < 0.3 else None
        rows.append(status(f"d{rng.randrange(documents)}", i, rng.choice(["FAILED", "SUCCEEDED"]), init, stage=stage))
    order = list(range(n))
    rng.shuffle(order)
    return [rows[i] for i in order]  # arrival is not the order of seq


@pytest.mark.parametrize("keep", [None, 0])
def test_states_equal_the_batch_fold_after_every_batch(spark, tmp_path, keep):
    rows = some_events(3, 60)
    folder, table, check = (str(tmp_path / n) for n in ("in", "table", "check"))
    seen = []
    for start in (0, 30):
        files(spark, rows, STATUS, folder, [slice(start, start + 15), slice(start + 15, start + 30)])
        run(state.stream_states(source(spark, STATUS, folder), table, check, keep))
        want = tracking.fold_status_events(spark.createDataFrame(rows[: start + 30], STATUS)).operations
        assert sorted(state.state_operations(spark, table).collect()) == sorted(want.collect())
        if keep is None:
            assert sorted(map(str, state.kept_summary(spark, table).collect())) == sorted(map(str, tracking.pipeline_summary(want).collect()))
        seen.append(batches.last_finished(spark, table))
    assert seen == [1, 3]
    done = {r.documentId for r in state.finished_stream(spark, table).collect()}
    assert {r.documentId for r in tracking.finished_documents(want).collect()} <= done


def test_finished_documents_leave_the_state(spark, tmp_path):
    folder, table, check = (str(tmp_path / n) for n in ("in", "table", "check"))
    rows = [status(f"d{i}", 10 * i + 1, "SUCCEEDED", "True", stage=S.STAGE_ANNOTATE) for i in range(20)]
    rows.append(status("open", 1000, "FAILED", "True"))
    files(spark, rows, STATUS, folder, [slice(0, 21)])
    first, _ = last_progress(state.stream_states(source(spark, STATUS, folder), table, check, 1))
    assert first["stateOperators"][0]["numRowsTotal"] >= 21
    late = status("d3", 5000, "FAILED")
    files(spark, [late], STATUS, folder, [slice(0, 1)])
    run(state.stream_states(source(spark, STATUS, folder), table, check, 1))
    files(spark, [status("open", 5001, "FAILED")], STATUS, folder, [slice(0, 1)])
    _, recent = last_progress(state.stream_states(source(spark, STATUS, folder), table, check, 1))
    assert min(p["stateOperators"][0]["numRowsTotal"] for p in recent) <= 4  # the open one and the late one
    want = tracking.fold_status_events(spark.createDataFrame([*rows, late, status("open", 5001, "FAILED")], STATUS)).operations
    assert sorted(state.state_operations(spark, table).collect()) == sorted(want.collect())


def test_replay_and_unfinished_batches(spark, tmp_path):
    rows = some_events(5, 20)
    given = spark.createDataFrame([("a", "A", "x", "B", "y"), ("b", None, None, "B", "y"), ("c", "A", "x", "A", "x"), ("d", "A", "x", None, "z")],
                                  "documentId STRING, oldStage STRING, oldStatus STRING, newStage STRING, newStatus STRING")
    assert {tuple(r) for r in state.changed_counts(given).collect()} == {("A", "x", -2), ("B", "y", 2), (None, "z", 1)}
    table = str(tmp_path / "table")
    df = spark.createDataFrame(rows, STATUS)
    batches.write_batch(df, f"{table}/events", 0)
    assert batches.read_batches(spark, table, "events") is None  # the batch has not finished
    batches.finish_batch(spark, table, 0)
    batches.write_batch(df, f"{table}/events", 1)
    assert batches.read_batches(spark, table, "events").count() == 20
    batches.finish_batch(spark, table, 1)
    assert batches.read_batches(spark, table, "events").count() == 40


def signature_rows(spark, names):
    return spark.createDataFrame([(f"s{i}", f"t{t:05d}", f"d{t}") for i, t in names], "documentSignature STRING, timestamp STRING, documentId STRING")


def test_generations_answer_like_one_table_and_read_little(spark, tmp_path, monkeypatch):
    for name, value in (("BASE_ROWS", 40), ("BLOCK_KEYS", 16), ("BUCKET_BLOCKS", 2)):
        monkeypatch.setattr(signatures, name, value)
    rng, path, best = random.Random(1), str(tmp_path / "sig"), {}
    for batch in range(11):
        names = [(rng.randrange(400), rng.randrange(10**4)) for _ in range(rng.choice([0, 20, 30]))]
        names = list({i: (i, t) for i, t in names}.values())
        gens = signatures.add(spark, path, signature_rows(spark, names), batch)
        if batch == 6:  # replayed: the same list again
            assert gens == signatures.add(spark, path, signature_rows(spark, names), batch)
        for i, t in names:
            best[f"s{i}"] = min(best.get(f"s{i}", ("z", "")), (f"t{t:05d}", f"d{t}"))
    gens = signatures.live(spark, path)
    assert len(gens) <= 9 and len({signatures._size(g.rows) for g in gens}) > 1 and max(g.rows for g in gens) > 100
    assert all(sum(signatures._size(g.rows) == s for g in gens) < signatures.FAN for s in range(9))

    def ask(names, before=99):
        found = signatures.known(spark, path, spark.createDataFrame([(n,) for n in names], "documentSignature STRING"), before)
        return found, {} if found is None else {
            r.documentSignature: tuple(r._doc) for r in lineage.first_documents(found, ["documentSignature"]).collect() if r.documentSignature in names}

    every, got = ask([f"s{i}" for i in range(400)])
    assert got == best
    few, got = ask(["s1", "s2", "nothing"])
    assert got == {k: best[k] for k in ("s1", "s2") if k in best}
    assert few is None or len(few.inputFiles()) < len(every.inputFiles()) / 3
    strangers = sum(len(ask([f"x{i}"])[0].inputFiles()) if ask([f"x{i}"])[0] is not None else 0 for i in range(6))
    assert strangers <= 2  # a filter is rarely wrong
    assert ask(["s1"], 0)[0] is None and ask([])[0] is None
    monkeypatch.setattr(signatures, "MAX_FOLDERS", 1)
    assert ask([f"s{i}" for i in range(400)])[1] == best
    assert signatures.vacuum(spark, path) and signatures.vacuum(spark, path) == []
    assert ask([f"s{i}" for i in range(400)])[1] == best


def test_lineage_stream_over_many_batches_equals_the_batch_operator(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(signatures, "BASE_ROWS", 4)
    rng, rows = random.Random(7), []
    for i in range(48):
        kind = rng.choice(["ObjectCreated:Put", "ObjectCreated:Put", "ObjectRemoved:Delete"])
        rows.append(lineage_row("UNKNOWN_YET" if "Removed" in kind else f"d{i}", i + 1, kind, time=f"t{rng.randrange(999):04d}", name=f"f{rng.randrange(14)}"))
    folder, table, check = (str(tmp_path / n) for n in ("in", "table", "check"))
    for start in (0, 24):
        files(spark, rows, LINEAGE, folder, [slice(i, i + 6) for i in range(start, start + 24, 6)])
        run(streaming.stream_lineage(source(spark, LINEAGE, folder), table, check))
    events = spark.createDataFrame(rows, LINEAGE)
    out = lineage.resolve_deleted_ids(None, events)
    want = lineage.append_lineage(None, out.accepted)
    assert sorted(map(str, streaming.stored_lineage(spark, table).select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert streaming.rejected_lineage(spark, table).count() == out.rejected.count() > 0
    assert len(signatures.live(spark, f"{table}/signatures")) < 8
    assert events.where(F.col("s3Event").startswith("ObjectRemoved")).count() > 6


def test_state_is_only_asked_and_put_where_needed():
    """Rows go in as they are; a message that changes nothing puts no state, and timers are only sought where one runs."""
    from pyspark.sql import Row

    class Fake:
        def __init__(self):
            self.value, self.timers, self.calls = None, [], []

        def __getattr__(self, name):
            def call(*args):
                self.calls.append(name)
                if name == "getValueState":
                    return self
                if name == "update":
                    self.value = args[0]
                if name == "registerTimer":
                    self.timers.append(args[0])
                if name == "deleteTimer":
                    self.timers.remove(args[0])
                return {"get": self.value, "listTimers": list(self.timers), "getCurrentProcessingTimeInMs": 100}.get(name)
            return call

    columns = ["documentId", "initDoc", *state.INIT]

    def rows(*given):
        return iter([Row(*columns)("d", init, seq, "b", "o", status_, S.STAGE_ANNOTATE, str(seq), None) for init, seq, status_ in given])

    fake, keep = Fake(), state.KeepState(7)
    keep.init(fake)

    def feed(*given):
        fake.calls.clear()
        (out,) = keep.handleInputRows(("d",), rows(*given), fake)
        return out.asDict()

    out = feed(("True", 5, "FAILED"), (None, 3, "FAILED"), (None, None, "FAILED"), ("True", 4, "FAILED"))
    assert (out["init_seq"], out["last_seq"], out["oldStatus"], out["newStatus"]) == (4, 3, None, "FAILED")
    assert fake.calls == ["get", "update"]
    feed((None, 2, "SUCCEEDED"), ("True", 9, "SUCCEEDED"))
    assert fake.calls == ["get"]  # both came too late to count
    out = feed((None, 8, "SUCCEEDED"), (None, 8, "FAILED"))
    assert (out["last_seq"], out["oldStatus"], out["newStatus"]) == (8, "FAILED", "SUCCEEDED") and fake.timers == [107]
    assert "listTimers" not in fake.calls
    out = feed((None, 11, "FAILED"))
    assert (out["oldStatus"], out["newStatus"]) == ("SUCCEEDED", "FAILED") and fake.timers == []
