"""Fingerprints, lexical search and prefix tries against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tontine.llm import fingerprints, lexical, prefix_trie

# --- fingerprints -------------------------------------------------------------------------------


def marks(text, k=5, w=8):
    ws = [x for x in re.split("[ \t\n\x0b\x0c\r]+", text or "") if x]
    if not ws:
        return []
    pos = [0]
    if len(ws) >= k:
        h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) % (1 << 31) for x in ws]
        g = [sum(h[i + j] * pow(fingerprints.BASE, k - 1 - j, 1 << 31) for j in range(k)) % (1 << 31) for i in range(len(h) - k + 1)]
        pos = sorted({max(range(i, min(i + w, len(g))), key=lambda p: (-g[p], p)) for i in range(max(1, len(g) - w + 1))})
    return [(p, hashlib.md5(" ".join(ws[p:p + k]).encode()).hexdigest()[:16]) for p in pos]


def alike(a, b):
    a, b = {h for _, h in a}, {h for _, h in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def texts():
    r = random.Random(1)
    return ([None, "", " ", "a", "a b c d", "a b c d e", "  x\ty z ", "same " * 50, "é　中 ß " * 9]
            + [" ".join(r.choice("abcdefg") for _ in range(n)) for n in (5, 6, 7, 8, 11, 12, 13, 14, 30, 100, 8203, 8204, 8205)])


@pytest.mark.parametrize("k,w,segment", [(5, 8, 8192), (5, 8, 16), (4, 4, 7), (7, 5, 3), (1, 1, 4), (3, 2, 5), (6, 13, 9)])
def test_winnow_in_segments(spark, k, w, segment):
    """Ties (few words), every segment length and texts around the limits."""
    df = spark.createDataFrame(list(enumerate(texts())), "i long, text string")
    got = {r[0]: [tuple(m) for m in r[1]] for r in df.select("i", fingerprints.winnow(F.col("text"), k, w, segment)).collect()}
    assert got == {i: marks(t, k, w) for i, t in enumerate(texts())}


def test_shared_passage_leaves_a_mark(spark):
    """k + w - 1 common words: a common mark, whatever stands around them."""
    r = random.Random(2)
    for n in range(20):
        word = lambda s: " ".join(f"{s}{r.randrange(10 ** 6)}" for _ in range(r.randrange(0, 40)))
        passage = " ".join(f"p{r.randrange(10 ** 6)}" for _ in range(12))
        a, b = marks(f"{word('a')} {passage} {word('b')}"), marks(f"{word('c')} {passage} {word('d')}")
        assert {h for _, h in a} & {h for _, h in b}


@pytest.mark.parametrize("parts", [None, 1, 3])
def test_edit_report(spark, parts):
    got = [r.asDict() for r in fingerprints.edit_report(brute.docs(spark)).collect()]
    rows = sorted(((i, t or "") for i, t, *_ in brute.DOCS), key=lambda r: (r[0] is not None, r[0] or 0))
    assert len(got) == len(rows)
    ordered = [r for r in rows if [x[0] for x in rows].count(r[0]) == 1]  # repeated ids: either order
    by_id = {r["doc_id"]: r for r in got}
    for n, (i, t) in enumerate(rows):
        j, nxt = rows[(n + 1) % len(rows)]
        if (i, t) not in ordered or (j, nxt) not in ordered:
            continue
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        r = by_id[i]
        assert (r["n_chars"], r["edited"]) == (len(t), edited)
        assert [tuple(m) for m in r["marks"]] == marks(t) and [tuple(m) for m in r["edited_marks"]] == marks(edited)
        assert (r["near_edited"], r["near_next"]) == (alike(marks(t), marks(edited)), alike(marks(t), marks(nxt)))


def test_following_by_range(spark):
    """Any number of ranges, a third of the rows under one id, one row, no row."""
    rows = [(i, f"t{i}") for i in range(60)] + [(7, f"u{i}") for i in range(30)] + [(None, "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for parts in (1, 2, 7, 200):
        got = fingerprints.with_following(df, parts=parts).collect()
        order = {r["text"]: r["next_text"] for r in got}
        assert len(got) == len(rows) and sorted(order.values()) == sorted(t for _, t in rows)
        at, seen = "n", []
        for _ in rows:
            seen.append(at)
            at = order[at]
        assert at == "n" and [s for s in seen if s[0] == "t"] == ["t%d" % i for i in range(60)]
    one = fingerprints.with_following(df.where("doc_id = 3")).collect()
    assert [(r["text"], r["next_text"]) for r in one] == [("t3", "t3")]
    assert fingerprints.edit_report(df.limit(0)).count() == 0


# --- lexical search -----------------------------------------------------------------------------


def ranking(docs, items, top=10):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    bags = [(i, n, Counter(re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(lower)))) for n, (i, t, *_) in enumerate(docs)]
    total, words = sum(bool(b) for *_, b in bags), sum(sum(b.values()) for *_, b in bags)
    df = Counter(t for *_, b in bags for t in b)
    out = []
    for item, text in items:
        terms = set(re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(lower)))
        scores = []
        for i, n, b in bags:
            m = 10 + (90 * sum(b.values()) * total) // max(1, words)
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10 ** 9 * b[t]) // (1000 * b[t] + 8 * m)) for t in terms if t in b)
            if s > 0:
                scores.append((-s, i is not None, i or 0, n))
        out += [(item, k + 1, x[2] if x[1] else None, -x[0]) for k, x in enumerate(sorted(scores)[:top])]
    return out


def found(spark, docs, items, **params):
    d = spark.createDataFrame([(*r[:2], "x", 1, 2) for r in docs], "doc_id long, text string, row string, n int, terms int").coalesce(1)
    q = spark.createDataFrame([(*r, "y", 3) for r in items], "item_id long, text string, row string, tid int").coalesce(1)
    return sorted((tuple(r) for r in lexical.search(lexical.index(d), q, **params).collect()), key=repr)


@pytest.mark.parametrize("params", [{}, {"owners": 1}, {"owners": 3, "block_rows": 4, "group_items": 2}, {"top": 2, "block_rows": 5, "owners": 6}])
def test_search_awkward_rows(spark, params):
    assert found(spark, brute.DOCS, brute.BENCH, **params) == sorted(ranking(brute.DOCS, brute.BENCH, params.get("top", 10)), key=repr)


def test_search_prunes_exactly(spark):
    """Few words with very different frequencies, ties, a third of the documents alike."""
    r = random.Random(4)
    vocabulary = [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(r.choices(vocabulary, [1 / (k + 1) ** 1.5 for k in range(40)], k=r.randrange(1, 30)))) for i in range(400)]
    docs += [(1000 + i, "w1 w5 w30 w39") for i in range(200)]
    items = [(i, " ".join(r.sample(vocabulary, r.randrange(1, 12)))) for i in range(25)]
    want = sorted(ranking(docs, items), key=repr)
    assert found(spark, docs, items, owners=5, block_rows=64, group_items=7) == want == found(spark, docs, items)


def test_search_empty(spark):
    assert found(spark, [], brute.BENCH) == [] == found(spark, brute.DOCS, []) == found(spark, [(1, None), (2, "...")], brute.BENCH)


def test_accumulators_shrink():
    """A bundle that cannot be beaten any more takes no new documents and drops the hopeless."""
    bundle = pa.table({"team": [0], "block": [0], "item": [5], "terms": pa.array([[1]], pa.list_(pa.int64())), "rest": [10],
                       "rows": pa.array([list(range(12))], pa.list_(pa.int64())), "scores": pa.array([[100 + 10 * i for i in range(12)]], pa.list_(pa.int64())), "closed": [False]})
    postings = pa.table({"tid": pa.array([1, 1], pa.int64()), "row": pa.array([0, 99], pa.int64()), "gain": pa.array([7, 7], pa.int64())})
    got = lexical.add_postings(bundle, postings, 10).to_pylist()[0]
    assert got["closed"] and got["rows"] == list(range(1, 12))  # 110 + 10 can still tie with the tenth, 120


# --- prefix tries -------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 2, 7, 60, 500])
@pytest.mark.parametrize("shape", ["path", "bushy", "random", "forest", "star"])
def test_subtree_sums(n, shape):
    rng = np.random.default_rng(3)
    pick = {"path": lambda i: i - 1, "bushy": lambda i: rng.integers(max(0, i - 3), i), "random": lambda i: rng.integers(0, i),
            "forest": lambda i: -1 if rng.random() < 0.1 else rng.integers(0, i), "star": lambda i: 0}[shape]
    parent = np.array([-1 if i == 0 else pick(i) for i in range(n)], dtype=np.int64)
    depth = np.zeros(n, dtype=np.int64)
    for i in range(n):
        depth[i] = 0 if parent[i] < 0 else depth[parent[i]] + 1
    order = np.argsort(depth, kind="stable")
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    parent = np.array([-1 if parent[i] < 0 else place[parent[i]] for i in order], dtype=np.int64)
    values = rng.integers(-5, 9, (n, 2))
    want = values.copy()
    for i in range(n - 1, -1, -1):
        if parent[i] >= 0:
            want[parent[i]] += want[i]
    assert (prefix_trie.subtree_sums(parent, depth[order], values) == want).all()


def trie(rows, branch=True):
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for *_, r, x in sorted(ts)] for c, ts in convs.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if branch else 0
        built[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + ts[h:]
    members, kids = {}, {}
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved, out = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[x] for x in kids.get(p, ())) or 1
        own_saved = (len(members[p]) - 1) * len(brute.words(p[-1][1], brute.BLANK)) if p else 0
        saved[p] = own_saved + sum(saved[x] for x in kids.get(p, ()))
        ends = ",".join(map(str, sorted(c for c in members[p] if len(built[c]) == len(p))))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(kids.get(p, ())), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[1], r[0]))


def conversations():
    r = random.Random(5)
    rows = [(c, r.choice([t, t, t, None, 0]), r.choice(["user", "assistant", None]), r.choice(["hi there", "x", None, "", "a\tb c"]))
            for c in [*range(-25, 60), 100, 105, 119, 300] if c not in (40, 100, -20) for t in range(r.choice([0, 1, 2, 3, 4, 6]))]
    rows += [(None, 1, "user", "z"), (0, 1, "user", "hi"), (0, 1, "user", "hi"), (500, 1, "a", "1:b"), (501, 1, "a1", ":b")]
    rows += [(20, i, "u", f"w{i % 3} q") for i in range(200)] + [(300, i, "u", "same") for i in range(5000)]  # slices, a deep path
    return rows + [(600 + i, t, "user", f"copy {t}") for i in range(300) for t in range(3)]  # a third alike


@pytest.mark.parametrize("bound,branch", [(20_000, True), (40, True), (20_000, False)])
def test_prefix_trie(spark, bound, branch):
    df = spark.createDataFrame([(*r, 1, "z", 5) for r in conversations()], "conv_id long, turn long, role string, text string, d int, rep string, pos int")
    got = prefix_trie.prefix_trie(df, bound=bound, n_heads=4 if branch else 1)
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: (r[1], r[0])) == trie(conversations(), branch)


def test_prefix_trie_small(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert prefix_trie.prefix_trie(spark.createDataFrame([], schema)).count() == 0
    turnless = [(5, 0, "u", "x")]  # it inherits from a conversation that is not there
    while zlib.crc32(str(turnless[0][0]).encode()) % 4 == 0:
        turnless = [(turnless[0][0] + 1, 0, "u", "x")]
    for rows in (turnless, [(None, 0, "u", "x")], turnless + [(0, None, None, None)]):
        got = sorted((tuple(r) for r in prefix_trie.prefix_trie(spark.createDataFrame(rows, schema)).collect()), key=lambda r: (r[1], r[0]))
        assert got == trie(rows)
