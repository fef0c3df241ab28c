"""Fourth round: rows that line dedup holds in Python at once."""

import pyarrow as pa

from lathe.llm import line_dedup


def test_line_dedup_works_on_slices_of_a_batch():
    n = 3 * line_dedup.BATCH_ROWS + 7
    text = "\n".join(f"line {k}" for k in range(4))
    ids = pa.array(range(n), pa.int64())
    marks = list(line_dedup._fingerprints(3, 2, 50, True)(iter([pa.RecordBatch.from_arrays(
        [ids, ids, pa.array([text.encode()] * n)], names=["id", "th", "t"])])))
    assert [len(set(b.column(0).to_pylist())) for b in marks] == [line_dedup.BATCH_ROWS] * 3 + [7]
    spans = pa.array([[{"at": 1, "size": 2}]] * n, pa.list_(pa.struct({"at": pa.int64(), "size": pa.int64()})))
    out = list(line_dedup._without(iter([pa.RecordBatch.from_arrays(
        [ids, pa.array([text] * n), spans], names=["_row", "_t", "_spans"])])))
    assert [b.num_rows for b in out] == [line_dedup.BATCH_ROWS] * 3 + [7]
    assert [x for b in out for x in b.column("_row").to_pylist()] == list(range(n))
    assert {x for b in out for x in b.column("_text").to_pylist()} == {"line 0\nline 3"}
