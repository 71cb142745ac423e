import random
from types import SimpleNamespace

import pyarrow as pa

from sliceworks.llm import op2_mixing
from sliceworks.llm.op10_pack import Ids, ids_of, tokenizer_path


def test_counts_of_parts_add_up():
    ids, r = Ids(tokenizer_path()), random.Random(1)
    some = [" ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "\u3000", "\r\n", "a", "'s", "'", "\xe9", "1", "9", "!", "\u65e5", "\u200b", "ab", "<|endoftext|>"]
    for _ in range(5000):
        text = "".join(r.choice(some) for _ in range(r.randint(0, 12)))
        assert ids.count(text) == (len(ids.encode(text)) if text else 0), repr(text)
    assert ids.known


def test_op2_workers_keep_the_tokenizer_the_pipelines_do_not():
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["one two"])], names=["doc_id", "text"])
    none = SimpleNamespace(value=[([], [], 0.0)] * 2)
    for keep in (True, False):
        list(op2_mixing._memberships(none, False, tokenizer_path(), keep)([batch]))
        assert ids_of.cache_info().currsize == keep
