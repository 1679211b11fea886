import numpy as np
import xxhash

from plinth.llm import simhash
from plinth.llm.catalog import op9_simhash
from tests.llm.conftest import LONG, frame


def brute_print(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in low.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(points, distance=3):
    points = sorted(set(points))
    group = {p: p for p in points}
    changed = True
    while changed:
        changed = False
        for a in points:
            for b in points:
                if (a ^ b).bit_count() <= distance and group[b] < group[a]:
                    group[a], changed = group[b], True
    return group


def test_query_matches_brute_force(spark, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    prints = {d: brute_print(t) for d, t in texts.items()}
    group = brute_groups(prints.values())
    low = {}
    for d, p in prints.items():
        low[group[p]] = min(d, low.get(group[p], d))
    rows = op9_simhash(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {
        d: (f"{p:016x}", low[group[p]]) for d, p in prints.items()}
    assert len(rows) == len(texts)


def _clustered(rng, centres, each):
    out = []
    for c in rng.integers(0, 1 << 63, centres, dtype=np.uint64):
        out.append(int(c))
        for _ in range(each):
            flips = rng.choice(64, rng.integers(1, 5), replace=False)
            out.append(int(c) ^ sum(1 << int(f) for f in flips))
    return out


def test_local_search_finds_all_links():
    rng = np.random.default_rng(5)
    points = _clustered(rng, 60, 12) + [i << 40 for i in range(300)]      # the last ones share a half
    a, b = simhash.local_stars(np.array(points, np.uint64), 3)
    star = dict(zip(a.tolist(), b.tolist(), strict=True))
    want = brute_groups(points)
    assert {p: star.get(p, p) for p in set(points)} == want


def test_tree_separates_no_link():
    rng = np.random.default_rng(6)
    points = np.unique(np.array(_clustered(rng, 300, 6), np.uint64))
    trees = [simhash.Tree(points[::3], m, 3, 16, 0) for m in simhash.HALVES]
    near = np.bitwise_count(points[:, None] ^ points[None, :]) <= 3
    together = np.zeros_like(near)
    for tree in trees:
        for _, some in tree.deal(points):
            at = np.searchsorted(points, some)
            together[np.ix_(at, at)] = True
    assert not (near & ~together).any()
    assert len(trees[0].nodes) > 20


def test_spark_links_and_components(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD", 64)
    rng = np.random.default_rng(7)
    points = sorted({int(np.int64(np.uint64(p).view(np.int64))) for p in _clustered(rng, 80, 8)})
    frame_ = spark.createDataFrame([(p,) for p in points], "fp long").repartition(5)
    stars = {r.a: r.b for r in simhash.components(simhash.links(frame_)).collect()}
    want = brute_groups([p & (1 << 64) - 1 for p in points])
    mine, theirs = {}, {}
    for p in points:
        mine.setdefault(stars.get(p, p), set()).add(p)
        theirs.setdefault(want[p & (1 << 64) - 1], set()).add(p)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    got = {r.a: r.b for r in simhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, 501: 500}


def test_edge_rows(spark):
    texts = [None, "", "  ", "same text here and there", "Same text here\tand there", LONG, "one", "same text here and there"]
    docs = frame(spark, texts, [9, 8, 7, 5, 4, 3, None, 5]).selectExpr("*", "0 AS fp", "1 AS component_id")
    rows = simhash.near_duplicates(docs).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in rows) == [(-1, -1), (3, 3), (4, 4), (5, 4), (5, 4), (7, 7), (8, 7), (9, 7)]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
