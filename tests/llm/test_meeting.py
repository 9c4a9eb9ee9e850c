from collections import Counter

import numpy as np

from provena.llm import meeting
from provena.llm.common import stored
from provena.llm.meeting import meeting_keys, pack, unpack


def test_packed_lists():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 5000):
        v = np.unique(rng.integers(0, 1 << 32, n).astype(np.uint32))
        assert (unpack(pack(v), len(v)) == v).all()
    edge = np.array([0, 1, (1 << 32) - 1], np.uint32)
    assert (unpack(pack(edge), 3) == edge).all()


def test_keys_of_several_owners(spark, monkeypatch):
    """All keys that two owners have, wherever they stand; hardly any that one owner has, however often."""
    monkeypatch.setattr(meeting, "BLOCK_ROWS", 50)
    rng = np.random.default_rng(2)
    hot = [int(x) for x in rng.integers(-(1 << 63), 1 << 63, 3)]
    few = [int(x) for x in rng.integers(-(1 << 63), 1 << 63, 300)]
    rows = []
    for i in range(600):
        keys = {int(x) for x in rng.integers(-(1 << 63), 1 << 63, 20)} | {few[j] for j in rng.integers(0, 300, 3)}
        rows.append((i, list(keys | (set(hot) if i % 3 else set()))))
    rows += rows[:40] + [(None, [1, 2]), (700, None), (701, [])]  # an owner's rows may come again
    df = stored(spark.createDataFrame(rows, "owner long, keys array<long>").repartition(5), "meeting-test")
    got = {(r.owner, r.key) for r in meeting_keys(df, "owner", "keys").collect()}
    pairs = {(i, k) for i, keys in rows if i is not None for k in keys or []}
    times = Counter(k for _, k in pairs)
    want = {(i, k) for i, k in pairs if times[k] > 1}
    assert want <= got <= pairs
    again = {i for i, _ in rows[600:640]}
    assert all(i in again for i, k in got - want)  # rows of one owner in several blocks may let its keys through
    assert meeting_keys(df.limit(0).transform(lambda d: stored(d, "meeting-none")), "owner", "keys").count() == 0
