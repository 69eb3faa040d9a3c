"""Batches of texts stay small while a table is written, and the session's setting comes back."""

from tabsmith.llm import common as C


def test_written_hands_small_batches_to_tasks(spark):
    def sizes(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows]})

    df = spark.range(0, 5_000, 1, 1).mapInArrow(sizes, "n long")
    before = spark.conf.get(C._BATCH)
    assert max(r["n"] for r in C.written(df, "sizes").collect()) <= C.BATCH_ROWS
    assert spark.conf.get(C._BATCH) == before
    spark.conf.set(C._BATCH, "70")
    try:
        assert max(r["n"] for r in C.written(df, "sizes").collect()) == 70 and spark.conf.get(C._BATCH) == "70"
    finally:
        spark.conf.set(C._BATCH, before)


def test_a_worker_remembers_words_of_one_operator(monkeypatch):
    monkeypatch.setattr(C, "_remembered", [])
    gone = []
    for name in ("op1", "op1", "hashes", "hashes", "op1"):
        C.remembers(name, lambda name=name: gone.append(name))
    assert gone == ["op1", "hashes"]


def test_a_worker_gives_memory_back_when_the_operator_changes(monkeypatch):
    given = []
    monkeypatch.setattr(C, "_remembered", [])
    monkeypatch.setattr(C, "give_back", lambda: given.append(list(C._remembered)[0][0]))
    for name in ("op1", "op1", "hashes", "op1"):
        C.remembers(name, dict().clear)
    assert given == ["op1", "hashes"]
    monkeypatch.undo()
    C.give_back()
