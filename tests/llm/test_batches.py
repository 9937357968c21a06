"""Tasks that make Python objects work on bounded slices of a batch."""
from __future__ import annotations

import pyarrow as pa

from assetscan.llm import common as C
from assetscan.llm import pii


def test_small_batches_are_bounded_and_whole():
    batch = pa.RecordBatch.from_arrays([pa.array(range(2500)), pa.array([str(i) for i in range(2500)])], names=["doc_id", "text"])
    parts = list(C.small_batches([batch, batch.slice(0, 0), batch.slice(7, 3)]))
    assert [p.num_rows for p in parts] == [1024, 1024, 452, 3]
    assert [x for p in parts for x in p.column(0).to_pylist()] == [*range(2500), 7, 8, 9]


def test_scan_task_gives_small_batches():
    text = "write to a.person@example.org or +1 (202) 555-0143, 10.0.0.1"
    batch = pa.RecordBatch.from_arrays([pa.array(range(1500)), pa.array([text, None, ""] * 500)], names=["doc_id", "text"])
    out = list(pii._scan_task([batch]))
    assert [b.num_rows for b in out] == [1024, 476]
    whole = next(pii._scan([batch]))
    assert pa.Table.from_batches(out).to_pylist() == pa.Table.from_batches([whole]).to_pylist()
