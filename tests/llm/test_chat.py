import itertools

import numpy as np
import pandas as pd

from plinth.llm import chat
from plinth.llm.catalog import op2_chat
from tests.llm.conftest import LONG

_SCHEMA = "conv_id long, turn long, role string, text string, part string, state int"


def model(rng):
    rows = [(0, "start", i, 0, int(rng.integers(1, 9))) for i in range(3)]
    rows += [(0, "pair", i, j, int(rng.integers(1, 30))) for i in range(3) for j in range(3)]
    rows += [(0, "seen", i, j, int(rng.integers(0, 9))) for i in range(3) for j in range(96)]
    return chat.Model(rows)


def brute(m, seen):
    def score(path):
        s = m.start[path[0]] + m.seen[path[0], seen[0]]
        return s + sum(m.pair[a, b] + m.seen[b, x] for a, b, x in zip(path, path[1:], seen[1:], strict=False))
    return max(itertools.product(range(3), repeat=len(seen)), key=score)


def test_viterbi_whole_and_in_parts():
    rng = np.random.default_rng(2)
    for _ in range(30):
        m, seen = model(rng), rng.integers(0, 96, 7)
        want = brute(m, seen)
        assert tuple(m.decode(seen, -1, None)) == want
        cuts = sorted({0, *rng.integers(1, 7, 2).tolist(), 7})
        parts = list(zip(cuts[:-1], cuts[1:], strict=True))
        fixed = chat.fixed_ends([(p, 9, m.transfer(seen[a:b]).ravel().tolist()) for p, (a, b) in enumerate(parts)])
        got = [m.decode(seen[a:b], *fixed.get((p, 9), (-1, None))) for p, (a, b) in enumerate(parts)]
        assert tuple(np.concatenate(got)) == want


def test_one_long_conversation_over_many_partitions(spark):
    rng = np.random.default_rng(4)
    rows = [(1, t, chat.ROLES[1 + t % 2], ("User: " if t % 2 == 0 else "A: ") * int(rng.random() < 0.5) + "x" * int(rng.integers(1, 900)), None, 0) for t in range(900)]
    rows += [(c, t, "user", "hm?", None, 0) for c in (0, 2) for t in range(3)]
    df = spark.createDataFrame(rows, _SCHEMA)
    got = {(r.conv_id, r.turn): r.role_pred for r in chat.parse(df).collect()}
    frame = df.select("conv_id", "turn", "role", "text", chat.symbol(df.text).alias("symbol")).toPandas().sort_values(["conv_id", "turn"])
    frame["state"] = [chat.ROLES.index(r) for r in frame["role"]]
    frame["conv"], frame["turn_no"], frame["tie"], frame["part"] = frame["conv_id"], frame["turn"], 0, 0
    m = chat.Model(list(chat._counts(pd.DataFrame(frame)).itertuples(index=False, name=None)))
    for c in (0, 1, 2):
        one = frame[frame.conv_id == c]
        want = [chat.ROLES[s] for s in m.decode(one["symbol"].to_numpy(), -1, None)]
        assert [got[c, t] for t in one["turn"]] == want


def test_query_recovers_roles(spark):
    rows = op2_chat(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").count()
    assert np.mean([r.role == r.role_pred for r in rows]) > 0.97
    assert all(r.rendered.startswith(f"<|im_start|>{r.role_pred}\n") for r in rows)


def test_edge_rows(spark):
    rows = [(1, 0, "user", "User: hi", "p", 5), (1, 1, None, None, "p", 5), (1, 1, "other", "", "p", 5), (None, 0, "user", LONG, "p", 5),
            (None, None, "assistant", "Bot> yes", "p", 5), (1, 0, "user", "User: hi", "p", 5)]
    got = chat.parse(spark.createDataFrame(rows, _SCHEMA)).collect()
    assert len(got) == 6
    assert sum(r.rendered == "<|im_start|>user\nhi<|im_end|>\n" for r in got) == 2
    assert any(r.rendered == "<|im_start|>assistant\nyes<|im_end|>\n" for r in got)
    assert chat.parse(spark.createDataFrame([], _SCHEMA)).count() == 0
