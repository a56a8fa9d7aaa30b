from __future__ import annotations

import numpy as np
import pytest

from corpuscope.llm import training_order as T
from corpuscope.llm.common import read_file
from corpuscope.llm.queries import RANKS


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 64, 1000, 4097])
@pytest.mark.parametrize("key", [0, 1, 12345])
def test_permutation_is_one_and_has_its_inverse(n, key):
    numbers = np.arange(n)
    slots = T.permute(numbers, n, key)
    assert sorted(slots.tolist()) == numbers.tolist()
    assert T.permute(slots, n, key, inverse=True).tolist() == numbers.tolist()


def test_keys_give_different_orders_that_look_shuffled():
    a, b = (T.permute(np.arange(5000), 5000, k) for k in (1, 2))
    assert np.mean(a == b) < 0.01 and abs(np.corrcoef(a, np.arange(5000))[0, 1]) < 0.05


def stream(tokenizer, texts):
    return [i for t in texts if t for i in [*tokenizer.encoding.encode_ordinary(t), tokenizer.end]]


def test_shards_hold_the_stream_in_keyed_order(spark, documents, prose, tmp_path):
    ranks = read_file(spark, RANKS)
    tokenizer = T.Tokenizer(ranks)
    texts = [*prose(1, 30, (0, 40)), None, "", "one text twice", "one text twice", "long " * 700, "Ünï 日本 <|endoftext|>"]
    docs = documents(list(enumerate(texts))).coalesce(1)
    path = f"file://{tmp_path}/shards"
    layout = T.write_shards(docs, path, ranks, key=7, length=16, per_shard=10)
    want = stream(tokenizer, texts)
    assert (layout.tokens, layout.sequences) == (len(want), -(-len(want) // 16))
    want += [tokenizer.end] * (layout.sequences * 16 - len(want))
    rows = sorted(T.read_slots(spark, path).collect())
    assert [r.slot for r in rows] == list(range(layout.sequences))
    order = T.permute(np.arange(layout.sequences), layout.sequences, 7, inverse=True)
    slots = T.permute(np.arange(layout.sequences), layout.sequences, 7)
    assert all(r["ids"] == want[16 * n:16 * n + 16] for n, r in ((n, rows[slots[n]]) for n in range(layout.sequences)))
    assert order[slots[0]] == 0
    assert [r.sequence for r in rows] == order.tolist()
    files = sorted((tmp_path / "shards" / "shards").glob("part-*"))
    assert [f.stat().st_size for f in files[:-1]] == [10 * layout.stride] * (len(files) - 1)
    for r in rows[::7]:  # a reader may seek straight to a record
        raw = files[r.shard].read_bytes()[r.offset:r.offset + 32]
        assert np.frombuffer(raw, "<u2").tolist() == r["ids"] and r.shard == r.slot // 10
    assert sorted(T.read_slots(spark, path, first=23).collect()) == rows[23:]
    assert T.read_slots(spark, path, first=layout.sequences).count() == 0


def test_parts_of_several_tasks_join_into_one_stream(spark, documents, prose, tmp_path):
    ranks = read_file(spark, RANKS)
    docs = documents(list(enumerate(prose(2, 40, (1, 30))))).repartition(5)
    texts = [r.text for r in docs.collect()]
    layout = T.write_shards(docs, f"file://{tmp_path}/s", ranks, key=3, length=32, per_shard=4)
    rows = sorted(T.read_slots(spark, f"file://{tmp_path}/s").collect())
    slots = T.permute(np.arange(layout.sequences), layout.sequences, 3)
    got = [i for n in range(layout.sequences) for i in rows[slots[n]]["ids"]][:layout.tokens]
    # Whatever the order of the tasks, the texts are all there, whole and ended.
    end, parts, part = layout.end, [], []
    for i in got:
        part.append(i)
        if i == end:
            parts.append(tuple(part))
            part = []
    tokenizer = T.Tokenizer(ranks)
    assert sorted(parts) == sorted(tuple(stream(tokenizer, [t])) for t in texts)


def test_odd_and_empty_tables(spark, odd, none, tmp_path):
    ranks = read_file(spark, RANKS)
    layout = T.write_shards(odd, f"file://{tmp_path}/odd", ranks, key=1)
    assert T.read_slots(spark, f"file://{tmp_path}/odd").count() == layout.sequences > 20
    layout = T.write_shards(none, f"file://{tmp_path}/none", ranks, key=1)
    assert layout.sequences == 0 and T.read_slots(spark, f"file://{tmp_path}/none").count() == 0
