import functools

from plinth.llm import substring
from plinth.llm.catalog import op10_substring
from plinth.llm.common import Words, mix
from tests.llm.conftest import LONG, frame

_PASSAGE = ("The quick brown fox jumps over the lazy dog near the river bank. Then it walks home in the rain, "
            "humming an old song about winter. Nobody hears it but the owl in the tall oak tree. "
            "So ends the night, and the stars go out one by one over the quiet hills.")


def sentences(text):
    """(sentences as (words, start, stop)) by a plain walk; offsets are of the text's words."""
    raw = text.encode()
    words, at = [], 0
    for w in raw.split():
        at = raw.index(w, at)
        words.append((w.lower(), at, at + len(w)))
        at += len(w)
    pieces, now = [], []
    for i, (w, _, end) in enumerate(words):
        now.append(i)
        over = i + 1 == len(words) or b"\n" in raw[end:words[i + 1][1]]
        if over or w[-1:] in b".!?":
            pieces.append(now)
            now = []
    out = []
    for piece in pieces:
        parts = [piece]
        if len(piece) > substring.LONG:
            parts, now = [], []
            for i in piece:
                now.append(i)
                if words[i][0][-1:] in b",;:" or i == piece[-1]:
                    parts.append(now)
                    now = []
        for part in parts:
            ends = {part[-1]}
            for k in range(len(part) - substring.LONG + 1) if len(part) > substring.LONG else ():
                window = part[k:k + substring.LONG]
                ends.add(min(window, key=lambda i: (word_hash(words[i][0]), -i)))
            now = []
            for i in part:
                now.append(i)
                if i in ends:
                    out.append(now)
                    now = []
    return words, out


@functools.cache
def word_hash(word):
    """The order of words, the one thing taken from the code under test."""
    return int(mix(Words([word]).hash)[0])


def runs(text):
    """(its words, first sentence, last sentence) of the shortest runs of two sentences and MIN_WORDS words or
    more that start with a sentence, and of those that end with one."""
    words, pieces = sentences(text)
    spans, n = set(), len(pieces)
    for i in range(n):
        j, size = i + 1, len(pieces[i]) + (len(pieces[i + 1]) if i + 1 < n else 0)
        while j < n and size < substring.MIN_WORDS:
            j += 1
            size += len(pieces[j]) if j < n else 0
        if j < n:
            spans.add((i, j))
        j, size = i - 1, len(pieces[i]) + (len(pieces[i - 1]) if i else 0)
        while j >= 0 and size < substring.MIN_WORDS:
            j -= 1
            size += len(pieces[j]) if j >= 0 else 0
        if j >= 0:
            spans.add((j, i))
    return words, pieces, [(tuple(words[k][0] for p in pieces[i:j + 1] for k in p), i, j) for i, j in sorted(spans)]


def brute(docs):
    low = {}
    for d, t in docs:
        for key, i, _ in runs(t)[2]:
            low[key] = min(low.get(key, (d, i)), (d, i))
    out = {}
    for d, t in docs:
        words, pieces, found = runs(t)
        gone = {k for key, i, j in found if low[key] != (d, i) for k in range(i, j + 1)}
        start = [words[p[0]][1] for p in pieces] + [len(t.encode())]
        raw = t.encode()
        kept = raw[:start[0]] + b"".join(raw[start[k]:start[k + 1]] for k in range(len(pieces)) if k not in gone)
        out[d] = (kept.decode() if gone else t, len(gone))
    return out


def test_query_matches_brute_force(spark, documents):
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    rows = op10_substring(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: (r.text, r.n_removed) for r in rows} == brute(docs)
    assert len(rows) == len(docs) and any(r.n_removed for r in rows)


def test_passage_goes_from_all_but_the_first(spark):
    texts = [f"Unlike words number {w} come first here. {_PASSAGE}\nAnd more of {w} follows after that." for w in ("one", "two", "three")]
    rows = substring.dedup(frame(spark, texts, [7, 3, 5])).collect()
    kept = {r.doc_id: "lazy dog" in r.text for r in rows}
    assert kept == {3: True, 5: False, 7: False}
    assert all("Unlike words" in r.text and "follows after" in r.text for r in rows)


def test_edge_rows(spark):
    texts = [None, "", " \n ", LONG, LONG, _PASSAGE, _PASSAGE, _PASSAGE, "x"]
    ids = [1, 2, 3, 4, 4, None, None, 6, 8]
    rows = substring.dedup(frame(spark, texts, ids).selectExpr("*", "5 AS n_removed", "1 AS run", "2 AS id")).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].text is None and by[2][0].text == "" and by[3][0].text == " \n " and by[8][0].text == "x"
    assert by[6][0].text == _PASSAGE
    assert [r.text for r in by[None]] == ["", ""]                       # null ids come last
    assert len({r.text for r in by[4]}) == 1 and len(by[4][0].text) < len(LONG) / 10
    assert rows[0].run == 1 and rows[0].id == 2
    assert substring.dedup(frame(spark, [])).count() == 0
