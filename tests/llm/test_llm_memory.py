"""What Python workers hold at once."""

import numpy as np
import pyarrow as pa

from scoreline.llm import near_dup
from scoreline.llm.common import sliced


def test_slices_hold_about_a_megabyte():
    texts = ["ab" * 50_000, None, "é" * 400_000, "x", "y" * 2_000_000, "", "z"]
    batch = pa.RecordBatch.from_pydict({"id": pa.array(range(7)), "text": pa.array(texts)})
    got = list(sliced([batch, batch.slice(0, 0)]))
    assert [ids for ids, _ in got] == [[0, 1, 2, 3, 4], [5, 6]]
    assert [t for _, part in got for t in part] == texts
    many = pa.RecordBatch.from_pydict({"id": pa.array(range(1000)), "text": pa.array(["w" * 5000] * 1000)})
    assert max(sum(map(len, part)) for _, part in sliced([many])) == 1_000_000


def test_shingle_sets_are_views_of_the_table():
    sets = [[3, 5], [-7], [1, 2, 9]]
    whole = pa.record_batch({"shingles": pa.array(sets, pa.list_(pa.int64()))})
    t = pa.Table.from_batches([whole.slice(1, 2), whole.slice(0, 1)])
    got = near_dup.sets_of(t)
    assert [x.tolist() for x in got] == [[-7], [1, 2, 9], [3, 5]]
    assert all(x.dtype == np.int64 and not x.flags.owndata for x in got)
