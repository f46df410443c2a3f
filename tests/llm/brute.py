"""Plain-Python versions of the operators, and the awkward rows that they are tried on."""

import hashlib
import re
import zlib

UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

P = "the quick brown fox jumps over the lazy dog while seven wizards brew strong potions near an old stone bridge tonight and then they rest"
LONG = " ".join(f"w{i % 5003}x{i}" for i in range(60_000))

#: (doc_id, text, lang, source): nulls in every column, empty and very long texts, repeats, near copies.
DOCS = [
    (1, P, "en", "a"), (2, P, "en", "a"), (3, P + " again", "en", "b"), (4, P.upper(), None, None), (5, None, None, None), (6, "", "en", "a"),
    (7, " \t\n ", "en", ""), (8, LONG, "en", "b"), (9, LONG + " tail", "en", "b"), (10, "one two", "en", "c"), (11, "One\ttwo", "en", "c"),
    (12, "a", "en", "c"), (12, "a", "en", "c"), (13, "same line that is long enough to count as a key here\nx\n" * 3, "en", "c"),
    *[(14 + i, f"head {i}\n  Same line that is long enough to count as a key here\t\nfoot {i}", "de", "d") for i in range(6)],
    (None, P, "en", "a"), (None, None, None, None), (30, "é" * 50 + " ß Ünï 中文 mixed   words", "fr", "d"), (-5, "negative id", "fr", "d"),
    (31, "Licensed under the Apache License, Version 2.0.", "en", "d"), (32, P + "\nReleased under the MIT License.", "en", "e"),
    (33, "|||| ### *** $$$ %%% &&& " * 30, "en", "e"), (34, "x\x0by\x0cz\x1cq r", "en", "e"),
]
BENCH = [(1, P), (2, "one two"), (3, None), (4, ""), (5, "negative"), (None, "brown fox"), (10, " ".join(P.split()[3:20])), (10, " ".join(P.split()[3:20])), (6, "...")]


def docs(spark, rows=None):
    """The rows as documents with extra columns, some named like the operators' own."""
    rows = DOCS if rows is None else rows
    more = [(*r, len(r[1] or ""), "x", 7, None, 0.5, 1, True, 3, "h", "k") for r in rows]
    return spark.createDataFrame(more, "doc_id long, text string, lang string, source string, n_chars long, id string, n long, component_id long, "
                                 "score double, size int, kept boolean, n_lines int, path string, rank string")


def words(text, pattern):
    return re.findall(pattern, (text or "").translate(UPPER))


ALNUM, BLANK = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "[^\x20\x09-\x0d]+"


def contamination(rows, bench, n=13):
    wins = []
    for item, text in bench:
        w = words(text, ALNUM)
        k = min(n, len(w))
        wins += [(item, tuple(w[i:i + k])) for i in range(len(w) - k + 1) if k]
    out = []
    for i, text, *_ in rows:
        w = words(text, ALNUM)
        hit, items = set(), set()
        for item, x in wins:
            for at in range(len(w) - len(x) + 1):
                if w[at] == x[0] and tuple(w[at:at + len(x)]) == x:
                    hit |= set(range(at, at + len(x)))
                    items |= {str(item)} - {"None"}
        out.append((i, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def shingle_set(text, n=5):
    w = words(text, BLANK)
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def components(rows):
    """doc_id -> (smallest id reachable); rows without id are alone."""
    sets = [(i, shingle_set(t)) for i, t, *_ in rows]
    known = [(i, s) for i, s in sets if i is not None and s]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(known):
        for j, t in known[:a]:
            common = len(s & t)
            if 100 * common >= 75 * (len(s) + len(t) - common):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [(i, len(s), None if i is None else find(i), i is None or find(i) == i) for i, s in sets]


def line_dedup(rows, min_chars=40, min_docs=5):
    holders = {}

    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(UPPER)

    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(key(x)) < min_chars or len(holders[key(x)]) < min_docs or max(holders[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def water_fill(sizes, weights=(3.0, 1.0, 2.0), share=1.5, epochs=2):
    """{source: size} -> {source: target} by resharing until none is above its limit."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, open_ = {}, share * sum(sizes.values()), list(names)
    while open_:
        total = sum(w[s] for s in open_)
        over = [s for s in open_ if left * w[s] / total > epochs * sizes[s]]
        if not over:
            return target | {s: left * w[s] / total for s in open_}
        for s in over:
            target[s] = float(epochs * sizes[s])
        left -= sum(target[s] for s in over)
        open_ = [s for s in open_ if s not in over]
    return target


ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return sorted(spans + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24])


def join_spans(spans):
    return ",".join(f"{('assign', 'access', 'hex', 'random')[k]}:{s}:{e}" for s, k, e in spans)


def token_rows(rows, tokenizer, end=2):
    out, start = [], 0
    for i, t in sorted(((r[0], r[1] or "") for r in rows), key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, end]
        out.append((i, start, len(ids), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids))))
        start += len(ids)
    return out
