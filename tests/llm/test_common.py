import pyarrow as pa
from pyspark.sql import functions as F

from costmart.llm.common import BATCH_BYTES, BATCH_ROWS, _held, held, let_go, map_rows


def test_batches_are_bounded_by_rows_and_bytes(llm):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "size"])

    long_ = llm.range(100).select("id", F.expr("repeat('word ', 200000)").alias("text")).coalesce(1)
    short = llm.range(5000).select("id", F.lit("word").alias("text")).coalesce(1)
    for df in (long_, short):
        for r in df.mapInArrow(sizes, "n long, size long").collect():
            assert r["n"] <= BATCH_ROWS and r["size"] <= BATCH_BYTES + 2_000_000


def test_a_worker_keeps_the_state_of_one_operator(llm):
    keep = lambda key: lambda cols: {"n": [held((key,), lambda: [key])[0]] * len(cols["text"])}

    def look(cols):
        from costmart.llm import common  # the worker's, not a copy of the driver's list

        return {"n": [str(len(common._held))] * len(cols["text"])}

    rows = llm.range(8).select(F.col("id").cast("string").alias("text")).repartition(4)
    for key in ("one", "two"):
        assert {r["n"] for r in map_rows(rows, keep(key), "n string", keeps=True).collect()} == {key}
    assert {r["n"] for r in map_rows(rows, look, "n string").collect()} == {"0"}
    first = held(("here", 1), list)
    assert held(("here", 1), list) is first and held(("here", 2), list) is not first and len(_held) == 2
    let_go()
    assert not _held
