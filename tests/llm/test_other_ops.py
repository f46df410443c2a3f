"""License scans, neighbours, quality and URL filters against brute force or held-out accuracy."""

import hashlib
import itertools
import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tontine.llm import licenses, neighbours, quality, url_filter

# --- licenses ----------------------------------------------------------------------------------

FILES = [
    ("LICENSE", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("src/main.c", "int main;\n"), ("src/vendor/x/COPYING", "This work is licensed under the GNU General Public License, version 3."),
    ("src/vendor/x/a/b/deep.c", None), ("src/vendor/y.c", "// Licensed under the Apache License, Version 2.0.\nint y;\n" + "code;\n" * 50),
    ("src/vendor/z.c", "Copyright someone who said nothing else of use whatsoever here"), ("other/readme", ""), (None, "Released under the MIT License."),
    (None, None), ("src/vendor/y.c", "// Licensed under the Apache License, Version 2.0.\nint y;\n" + "code;\n" * 50), ("docs/licence_notes.txt", "nothing"), ("/abs/f", "x" * 300_000),
]


def license_units(p, t):
    lines = [re.sub(licenses.MARKS.replace(r"\z", r"\Z"), "", x) for x in t.split("\n")]
    out = []
    for par in re.split(licenses.PARAGRAPH, "\n".join(lines)):
        flat = par.replace("\n", " ")
        if re.search(licenses.MENTIONS, flat):
            out += [x for x in par.split("\n") + re.split(licenses.SENTENCE, flat) if re.search(licenses.MENTIONS, x)] + [flat]
    return set(out) | ({t} if re.search(licenses.LICENCE_FILE, p) and t else set())


def license_rows(files, threshold=0.5, share=0.5):
    def terms(t):
        return Counter(x for x in re.split("[^a-z0-9]+", t.lower()) if x)
    occ = [(k, x) for k, (p, t) in enumerate(files) for x in license_units(p or "", t or "")]
    df = Counter()
    for _, x in licenses.TEMPLATES:
        df.update(set(terms(x)))
    n = len(licenses.TEMPLATES)

    def vec(x):
        return {t: (1 + math.log(c)) * (math.log((1 + n) / (1 + df[t])) + 1) for t, c in terms(x).items()}
    temps = [(s, vec(x)) for s, x in licenses.TEMPLATES]

    def norm(v):
        return math.sqrt(sum(a * a for a in v.values()))

    def best(x):
        v = vec(x)
        return max(((round(sum(a * w.get(t, 0) for t, a in v.items()) / (norm(v) * norm(w)), 6) if v else 0, -i, s) for i, (s, w) in enumerate(temps)))
    own, out, spoken = {}, [], {}
    for k, (p, t) in enumerate(files):
        hits = [(best(x), x) for j, x in occ if j == k]
        hits = [(b, x) for b, x in hits if b[0] >= threshold]
        if hits:
            own[k] = max(hits, key=lambda h: (round(h[0][0] * math.sqrt(len(terms(h[1]))), 6), h[0][0], hashlib.md5(h[1].encode()).hexdigest()))[0]
            p, t = p or "", t or ""
            if re.search(licenses.LICENCE_FILE, p) or max(len(x) for _, x in hits) >= share * len(t):
                spoken.setdefault(p.rpartition("/")[0], []).append(own[k][2])
    for k, (p, t) in enumerate(files):
        d, source = (p or "").rpartition("/")[0], None
        while k not in own:
            if d in spoken:
                source = d
                break
            if not d:
                break
            d = d.rpartition("/")[0]
        lic = own[k][2] if k in own else (Counter(spoken[source]).most_common(1)[0][0] if source is not None else None)
        out.append((p or "", own[k][2] if k in own else None, own[k][0] if k in own else None, lic, source))
    return out


def test_license_scan(spark):
    f = spark.createDataFrame([(p, t, "x", 1) for p, t in FILES], "path string, text string, license string, unit int")
    got = sorted(map(repr, (tuple(r) for r in licenses.scan(f).collect())))
    assert got == sorted(map(repr, license_rows(FILES)))
    assert licenses.scan(f.limit(0)).count() == 0
    assert licenses.scan(f.where("path like 'other%'")).where("license is not null").count() == 0


def wrapped(text, mark="# ", width=70):
    import textwrap
    return "\n".join(mark + x for x in textwrap.wrap(text, width))


BODY = "\n\nimport os\n\n\ndef main():\n    return os.name\n" * 20
REAL = [
    ("a/LICENSE", "Copyright (c) 2001-2020 Some Body and others.\nAll rights reserved.\n\n" + wrapped(licenses._BSD, "", 76) + "\n\n" + wrapped(licenses._NAMES, "  3. ", 70) + "\n\n" + wrapped(licenses._DISCLAIMER, "", 76), "BSD-3-Clause"),
    ("b/LICENSE.txt", "BSD License\n\nCopyright 1999 X\n\n" + wrapped(licenses._BSD, "", 60) + "\n\n" + wrapped(licenses._DISCLAIMER, "", 60), "BSD-2-Clause"),
    ("c/LICENSE.md", "# The MIT License (MIT)\n\nCopyright (c) 2015 Jane Roe <jane@example.org>\n\n" + wrapped(licenses._MIT, "", 72), "MIT"),
    ("d/COPYING", " " * 20 + "GNU GENERAL PUBLIC LICENSE\n" + " " * 22 + "Version 2, June 1991\n\n Copyright (C) 1989, 1991 Free Software Foundation, Inc.\n" + "\n\nOther words entirely, of preambles and terms.\n" * 40, "GPL-2.0"),
    ("e/COPYING", " " * 20 + "GNU GENERAL PUBLIC LICENSE\n" + " " * 22 + "Version 3, 29 June 2007\n\n" + "Other words entirely, of preambles and terms.\n\n" * 40, "GPL-3.0"),
    ("f/LICENSE", " " * 30 + "Apache License\n" + " " * 27 + "Version 2.0, January 2004\n" + " " * 20 + "http://www.apache.org/licenses/\n\n" + "Terms and conditions, many of them.\n\n" * 50, "Apache-2.0"),
    ("s/gpl2.py", wrapped("This program is free software; " + licenses._GPL.format("", "2") + ".") + BODY, "GPL-2.0"),
    ("s/gpl3.c", "/*\n" + wrapped("This program is free software: " + licenses._GPL.format("", "3") + ".", " * ") + "\n */" + BODY, "GPL-3.0"),
    ("s/lgpl.c", wrapped("This library is free software; " + licenses._GPL.format("Lesser ", "2.1") + ".", "// ") + BODY, "LGPL-2.1"),
    ("s/bsd.go", "// Copyright 2011 The Authors. All rights reserved.\n// Use of this source code is governed by a BSD-style\n// license that can be found in the LICENSE file.\n" + BODY, "BSD-3-Clause"),
    ("s/apache.py", wrapped(licenses.TEMPLATES[2][1] + ".") + BODY, "Apache-2.0"),
    ("s/spdx.py", "# SPDX-License-Identifier: MIT" + BODY, "MIT"), ("s/spdx2.c", "/* SPDX-License-Identifier: GPL-2.0-only */" + BODY, "GPL-2.0"),
    ("s/spdx3.c", "// SPDX-License-Identifier: GPL-3.0-or-later" + BODY, "GPL-3.0"),
    ("s/own.txt", "Some words. All rights reserved. More words, of this and that.", "Proprietary"), ("s/none.py", "# nothing to see" + BODY, None),
    ("s/talk.txt", "We talked about the fee of a fishing license at length, and of who must hold one on the lake.", None),
]


@pytest.mark.parametrize("copies", [1, 40])
def test_license_names_of_real_texts(spark, copies):
    """Full texts, wrapped headers, SPDX lines and short notices, however often the corpus has them."""
    f = spark.createDataFrame([(f"{i}/{p}", t) for i in range(copies) for p, t, _ in REAL], "path string, text string")
    got = {r.path: (r.own_license, r.own_score) for r in licenses.scan(f).collect()}
    assert [got[f"0/{p}"][0] for p, *_ in REAL] == [w for *_, w in REAL]
    assert any(s is not None and s < 1 for _, s in got.values())
    assert all(got[f"{i}/{p}"] == got[f"0/{p}"] for i in range(copies) for p, *_ in REAL)


def test_license_scan_of_documents(spark):
    got = licenses.scan(brute.docs(spark), text_col="text", path_col="path", keep=("doc_id",))
    own = {r.doc_id: r.own_license for r in got.where("own_license is not null").collect()}
    assert own == {31: "Apache-2.0", 32: "MIT"}


# --- neighbours --------------------------------------------------------------------------------

def exact(x, ids, queries, k=10):
    out = {}
    for q in queries:
        d = np.sqrt(((x - x[ids.index(q)]) ** 2).sum(1))
        out[q] = sorted((float(a), i) for a, i in zip(d, ids) if i != q)[:k]
    return out


def test_search_is_exact_with_one_part_and_skips_bad_rows(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 8)).round(1)
    x[100:200] = x[100]  # ties
    rows = [(i, v.tolist(), "x", 1) for i, v in enumerate(x)] + [(5, x[5].tolist(), "again", 2), (None, x[0].tolist(), "x", 1), (900, None, "x", 1),
            (1000, [0.0] * 8, "x", 1), (1100, [1.0] * 7 + [float("nan")], "x", 1), (1200, [1.0] * 7 + [None], "x", 1), (1300, [float("inf")] * 8, "x", 1), (1400, [1.0] * 3, "x", 1), (1500, [], "x", 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, vec string, part int")
    got = neighbours.search(df, F.col("vec_id") % 50 == 0, block=64, query_block=2).collect()
    want = exact(x, list(range(300)), range(0, 300, 50))
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted((q, i + 1, v, d) for q, near in want.items() for i, (d, v) in enumerate(near))
    assert neighbours.search(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    few = neighbours.search(df.where("vec_id in (0, 1, 2)"), F.col("vec_id") == 0).collect()
    assert [r.vec_id for r in sorted(few, key=lambda r: r["rank"])] == [v for _, v in exact(x[:3], [0, 1, 2], [0])[0]]


@pytest.mark.parametrize("clusters", [0, 40])
def test_recall_of_learned_partitions(spark, clusters):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(6000, 16)).astype(np.float32)
    if clusters:
        x = x * 0.3 + rng.normal(size=(clusters, 16))[rng.integers(0, clusters, 6000)].astype(np.float32)
    x[1000:2500] = x[1000]  # one vector holds a quarter of the rows
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for r in neighbours.search(df, F.col("vec_id") % 100 == 0, rows_per_part=400, sample=3000).collect():
        got.setdefault(r.query_id, set()).add((r.score, r.vec_id))
    want = exact(x.astype(np.float64), list(range(6000)), range(0, 6000, 100))
    assert np.mean([len(got[q] & set(near)) / 10 for q, near in want.items()]) >= 0.9
    assert all(len(g) == 10 for g in got.values())


def test_parts_are_balanced():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(900, 4)), rng.normal(5, 0.1, size=(100, 4))])
    graph = np.array([np.argsort(((x - v) ** 2).sum(1))[1:6] for v in x])
    part = neighbours.balanced_parts(x, graph, 8)
    size = np.bincount(part, minlength=8)
    assert size.sum() == 1000 and size.max() <= 138
    assert (part[graph] == part[:, None]).mean() > 0.5


# --- quality -----------------------------------------------------------------------------------

def prose(rng, bad):
    w = ["".join(rng.choice(list("abcdefghij"), int(rng.integers(2, 9)))) for _ in range(int(rng.integers(20, 150)))]
    return " ".join(x + ("###" if bad and rng.random() < 0.5 else "") for x in w)


def test_quality_learns_and_ignores_the_held_out_fold(spark):
    rng = np.random.default_rng(4)
    y = rng.integers(0, 2, 900)
    data = [(i, prose(rng, not v), "en", "a") for i, v in enumerate(y)]
    d = brute.docs(spark, data + brute.DOCS)
    lab = [(i, int(v), 0) for i, v in enumerate(y)] + [(0, None, None), (None, 1, 0), (10**9, 0, 0)]
    wrong = [(i, 1 - v if v is not None and i is not None and zlib.crc32(str(i).encode()) % 5 == 0 else v, t) for i, v, t in lab]
    schema = "doc_id long, quality int, toxic int"
    model, other = (quality.train(d, spark.createDataFrame(x, schema)) for x in (lab, wrong))
    got = quality.score(d.select("doc_id", "text", "score"), model)
    assert got.columns == ["doc_id", "score"] and got.count() == len(data) + len(brute.DOCS)
    r = got.withColumn("held", quality.held_out()).collect()
    assert all(0 <= x.score <= 1 for x in r)
    x = np.array([quality.features(t.encode()) for _, t, *_ in data[:50]])
    assert (model.score(x) == other.score(x)).all()  # labels of the held-out fold are never seen
    # ids of the awkward rows and of the prose overlap: the last 850 are prose only
    held = [(x.score, int(y[x.doc_id])) for x in r if x.held and x.doc_id is not None and 50 <= x.doc_id < 900]
    assert np.mean([(s >= 0.5) == v for s, v in held]) > 0.95
    assert all(x.held == (zlib.crc32(b"" if x.doc_id is None else str(x.doc_id).encode()) % 5 == 0) for x in r)


def test_quality_without_labels_or_rows(spark):
    d, lab = brute.docs(spark), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = quality.train(d, lab)
    assert {r.score for r in quality.score(d, model).collect()} == {0.5}
    assert quality.keep_good(d, model).columns == d.columns and quality.keep_good(d, model).count() == d.count()
    one = quality.train(d, spark.createDataFrame([(i, 1, 0) for i in range(40)], lab.schema))
    assert quality.score(d, one).agg(F.min("score")).first()[0] > 0.9
    assert quality.score(d.limit(0), model).count() == 0


def test_additive_model_finds_an_interaction():
    rng = np.random.default_rng(6)
    x = rng.uniform(size=(4000, len(quality.FEATURES)))
    y = ((x[:, 2] > 0.5) ^ (x[:, 5] > 0.5)).astype(float)
    m = quality.fit(x[:3000], y[:3000], rounds=30, pair_rounds=30)
    assert ((m.score(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.9
    assert {m.pairs[0][0], m.pairs[0][1]} == {2, 5}


# --- URL filters -------------------------------------------------------------------------------

URLS = [None, "", "no scheme", "http://", "://com/x", "http://COM/a", "https://Example.com/en/1?x=1#y", "https://WWW.example.com/en/2", "http://a.www.example.com/en/",
        "http://badexample.com/en/1", "http://x.net/es/1", "http://net/fr/2/", "http://x.net/en/3", "http://x.net?es/1", "http://x.org/es/1?b=://c/d", "http://com", "http://com#/",
        "x://a.b://c.com/en/1", "http://x.net/ES/1", "http://y\n.com/e\nn", *[f"http://h{i % 7}.net/{'es' if i % 3 else 'en'}/{i}?ref=1" for i in range(60)],
        *[f"http://h{i % 7}.org/{('es', 'en', 'fr')[i % 3]}/{i}" for i in range(30)], *[f"https://c{i % 4}.com/{('es', 'en')[i % 2]}/{i}" for i in range(40)]]


def split_url(url):
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    m = re.match(r"([^/?#]*)([^?#]*)", url[at + 3:])
    return m[1].translate(brute.UPPER), m[2]


def listed(host, path):
    fits = []
    for rule, verdict in url_filter.RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(rule), rule, verdict))
    return max(fits, default=(0, None, None))[1:]


def tokens(url, host, path):
    query = re.match(r"[^?#]*\?([^#]*)", url[url.find("://") + 3:]) if "://" in (url or "") else None
    return tuple(sorted({f"h:{x}" for x in host.split(".") if x} | {f"p:{x}" for x in re.sub("[0-9]+", "0", path).split("/") if x}
                        | {f"q:{x.split('=')[0]}" for x in (query[1] if query else "").split("&") if x.split("=")[0]}))


def judged(urls, support=0.005, confidence=0.9):
    base = [(u, *split_url(u)) for u in urls]
    lab = [(tokens(u, h, p), listed(h, p)[1]) for u, h, p in base if listed(h, p)[1] and tokens(u, h, p)]
    freq, mined = Counter(), Counter()
    for t, v in lab:
        for n in range(1, len(t) + 1):
            for a in itertools.combinations(t, n):
                freq[a] += 1
                mined[a, v] += 1
    rules = [(c / freq[a], c, v == "allow", v, set(a)) for (a, v), c in mined.items() if c >= math.ceil(support * len(lab)) and c / freq[a] >= confidence]
    out = []
    for u, h, p in base:
        rule, verdict = listed(h, p)
        if not rule:
            t = set(tokens(u, h, p))
            verdict = max((r[:4] for r in rules if r[4] <= t), default=(0, 0, 0, "allow"))[3]
        out.append((h, p, rule or "", verdict))
    return out


def test_url_filter(spark):
    rows = [(i, u, "x", "y", ["t"]) for i, u in enumerate(URLS)] + [(None, "http://x.com/", "x", "y", None), (0, None, None, None, None)]
    p = spark.createDataFrame(rows, "page_id long, url string, html string, host string, tokens array<string>")
    got = sorted((r.host, r.path, r.rule or "", r.verdict) for r in url_filter.judge(p).collect())
    assert got == sorted(judged([r[1] for r in rows]))
    assert url_filter.judge(p.limit(0)).count() == 0
    none = url_filter.judge(p.where("url like 'http://h%.org%'")).collect()
    assert {r.verdict for r in none} == {"allow"}


def test_own_labels(spark):
    p = spark.createDataFrame([(i, f"http://{'spam' if i % 2 else 'fine'}{i}.org/{'bad' if i % 2 else 'good'}/") for i in range(20)], "page_id long, url string")
    lab = p.select("url", F.when(F.col("page_id") % 2 == 1, "block").otherwise("allow").alias("verdict"))
    got = url_filter.judge(p, labels=lab).collect()
    assert all((r.verdict == "block") == (r.page_id % 2 == 1) and r.antecedent for r in got)


LONG = "http://" + ".".join(f"l{i}" for i in range(20)) + ".net/fr/" + "/".join(f"s{'abcdefghij'[i % 10]}{'klmnop'[i // 10]}" for i in range(40)) + "?q=1"


@pytest.mark.parametrize("copies, others", [(1, 100), (30, 2970), (1, 3000)])
def test_long_urls_are_mined_in_seconds(spark, copies, others):
    """A labelled url of over 60 tokens, once or as one row in a hundred, and unlisted ones that share a few."""
    rows = [LONG] * copies + [f"http://host{i % 7}.com/a{'bc'[i % 2]}/" for i in range(others)]
    rows += [LONG.replace(".net", ".org"), "http://l3.org/sck/", "http://none.org/of/these"]
    p = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    began = time.time()
    got = {r.page_id: r.verdict for r in url_filter.judge(p).collect()}
    assert time.time() - began < 60
    frequent = copies >= math.ceil(0.005 * (copies + others))
    assert [got[i] for i in range(len(rows) - 3, len(rows))] == (["block", "block", "allow"] if frequent else ["allow"] * 3)
    assert got[0] == "block"


def test_a_long_url_under_both_verdicts(spark):
    """Sixty tokens that the same urls hold, labelled both ways: one item."""
    words = [f"p:t{i}" for i in range(60)]
    rows = [(words, "block")] * 19 + [(words, "allow")] + [(["h:x", *words[:1]], "allow")] * 80
    got = url_filter.mine(spark.createDataFrame(rows, "tokens array<string>, verdict string")).collect()
    best = {tuple(r.antecedent): (r.verdict, round(r.confidence, 9), round(r.support, 9)) for r in got}
    assert best[("p:t1",)] == ("block", 0.95, 0.19) and best[("h:x",)] == ("allow", 1.0, 0.8)


def test_mining_reads_every_label(spark):
    """Over 200,000 labels: one token set holds most of them, another is labelled both ways."""
    r = spark.range(280_000)
    lab = r.select(F.when(r.id < 210_000, F.array(F.lit("h:most"))).otherwise(F.array(F.lit("h:few"))).alias("tokens"),
                   F.when((r.id < 210_000) | (r.id >= 276_500), "allow").otherwise("block").alias("verdict"))
    got = {(tuple(x.antecedent), x.verdict): (round(x.confidence, 9), round(x.support, 9)) for x in url_filter.mine(lab).collect()}
    assert got == {(("h:most",), "allow"): (1.0, 0.75), (("h:few",), "block"): (0.95, 0.2375)}
