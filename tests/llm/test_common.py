"""What a Python worker holds: parts of bounded size, and the tables of one operator at a time."""

import gc
import weakref

import numpy as np
import public_tokenizers
import pyarrow as pa

from chartloom.llm import bpe, common, language


def test_parts_are_bounded():
    texts = ["x" * n for n in (0, 700, 400, 5000, 300, 0, 600, 600)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array(texts)], names=["id", "text"])
    parts = list(common.sliced([batch, batch.slice(2, 3), batch.slice(0, 0)], 1, 1000))
    assert [r for p in parts for r in p.column(0).to_pylist()] == [*range(9), 2, 3, 4]
    assert [t for p in parts for t in p.column(1).to_pylist()] == texts + texts[2:5]
    sizes = [[len(t or "") for t in p.column(1).to_pylist()] for p in parts]
    assert all(sum(s) <= 1000 or len(s) == 1 for s in sizes)
    assert max(map(len, sizes)) > 1


def test_tables_of_one_operator_at_a_time():
    encoder, decoder = bpe._tools(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    assert bpe._tools(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)[0] is encoder
    gone = weakref.ref(encoder)
    del encoder, decoder
    folding = language._folding()
    gc.collect()
    assert gone() is None
    assert language._folding() is folding and isinstance(folding, np.ndarray)

