"""Quality classifier: a generalised additive model with pairwise interactions.

Every text gives a fixed list of numeric features. Training bins them by quantiles and boosts
shallow trees cyclically, one feature at a time, on the logistic loss; the trees of a feature
add up to one lookup table over its bins. The feature pairs that best explain what is left
then get tables over two coarser bins, boosted the same way. A score is the sigmoid of a sum of
table entries, computed for a whole batch by index additions.

The model is fitted on at most ``max_train`` labelled rows (the smallest hashes of the ids, so
every run takes the same); everything else covers all rows. Defined results: null text counts as
empty and is scored; rows with a null label or a label of an unknown id are not learned from;
several labels of one id count by majority (a tie is 1); no labels, or only one class, give the
constant share of label 1 (0.5 without labels). Rows without an id are held out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tontine.llm.common import in_parts, tidied
from tontine.llm.words import word_hashes

MAX_TRAIN = 20_000
FOLDS = 5
THRESHOLD = 0.3
FEATURES = (
    "log_words", "log_bytes", "word_length", "longest_word", "short_words", "distinct_words", "top_word",
    "alnum_words", "log_lines", "line_words", "repeated_lines", "sentence_words", "digits", "upper", "non_ascii",
    "blanks", "marks", "symbols", "pipes", "hashes", "stars", "money", "percent", "ampersands", "brackets", "entropy",
    "repeated_pairs", "word_spread",
)
_CLASS = {name: np.isin(np.arange(256), np.frombuffer(chars.encode(), np.uint8)) for name, chars in {
    "digits": "0123456789", "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "blanks": " \t\n\r\x0b\x0c", "marks": ".,;:!?",
    "symbols": "#$%&*|@~^<>{}[]_=+\\/", "pipes": "|", "hashes": "#", "stars": "*", "money": "$", "percent": "%",
    "ampersands": "&", "brackets": "()[]{}<>"}.items()}
_SENTENCE = np.isin(np.arange(256), np.frombuffer(b".!?", np.uint8))


def features(text: bytes) -> np.ndarray:
    """The ``FEATURES`` of one text."""
    f = dict.fromkeys(FEATURES, 0.0)
    if text:
        counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
        n = len(text)
        share = counts[counts > 0] / n
        f.update({k: counts[m].sum() / n for k, m in _CLASS.items()})
        f["non_ascii"] = counts[128:].sum() / n
        f["entropy"] = float(-(share * np.log2(share)).sum())
        s, e, h = word_hashes(text, "space")
        lines = text.split(b"\n")
        f["log_bytes"], f["log_words"], f["log_lines"] = np.log1p(n), np.log1p(len(h)), np.log1p(len(lines))
        f["repeated_lines"] = 1 - len(set(lines)) / len(lines)
        if len(h):
            length = e - s
            _, seen = np.unique(h, return_counts=True)
            f["word_length"], f["longest_word"] = length.mean(), np.log1p(length.max())
            f["word_spread"] = length.std()
            f["short_words"] = (length <= 2).mean()
            f["distinct_words"], f["top_word"] = len(seen) / len(h), seen.max() / len(h)
            f["alnum_words"] = len(word_hashes(text, "alnum")[0]) / len(h)
            f["line_words"] = np.log1p(len(h) / len(lines))
            f["sentence_words"] = np.log1p(len(h) / (1 + counts[_SENTENCE].sum()))
            if len(h) > 1:
                pairs = h[1:] * np.uint64(0x9E3779B97F4A7C15) + h[:-1]
                f["repeated_pairs"] = 1 - len(np.unique(pairs)) / len(pairs)
    return np.array([f[k] for k in FEATURES])


@dataclass(frozen=True)
class Model:
    base: float
    edges: tuple[np.ndarray, ...]  # of the bins of each feature
    tables: tuple[np.ndarray, ...]
    pairs: tuple[tuple[int, int, np.ndarray, np.ndarray, np.ndarray], ...]  # features, their coarse edges, table

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for j, (e, t) in enumerate(zip(self.edges, self.tables)):
            z += t[np.searchsorted(e, x[:, j], side="right")]
        for i, j, ei, ej, t in self.pairs:
            z += t[np.searchsorted(ei, x[:, i], side="right"), np.searchsorted(ej, x[:, j], side="right")]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _edges(v: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(v, np.linspace(0, 1, bins + 1)[1:-1]))


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, l2: float, least: float) -> np.ndarray:
    """Newton steps of the best shallow tree over ordered bins, as a table."""
    step = np.zeros(len(g))
    cuts = [(0, len(g))]
    gs, hs = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    for _ in range(leaves - 1):
        best = (1e-9, None, None)
        for a, b in cuts:
            if b - a < 2:
                continue
            k = np.arange(a + 1, b)
            gl, hl = gs[k] - gs[a], hs[k] - hs[a]
            gr, hr = gs[b] - gs[k], hs[b] - hs[k]
            gain = gl ** 2 / (hl + l2) + gr ** 2 / (hr + l2) - (gs[b] - gs[a]) ** 2 / (hs[b] - hs[a] + l2)
            gain[(hl < least) | (hr < least)] = -1
            i = int(gain.argmax())
            if gain[i] > best[0]:
                best = (gain[i], (a, b), int(k[i]))
        if best[1] is None:
            break
        cuts.remove(best[1])
        cuts += [(best[1][0], best[2]), (best[2], best[1][1])]
    for a, b in cuts:
        step[a:b] = (gs[b] - gs[a]) / (hs[b] - hs[a] + l2)
    return step


def _quadrants(g: np.ndarray, h: np.ndarray, l2: float, least: float) -> tuple[float, np.ndarray]:
    """Gain and Newton steps of the best split of a table into four quadrants."""
    def sums(a: np.ndarray) -> tuple[np.ndarray, ...]:
        c = a.cumsum(0).cumsum(1)
        q, all_, right, below = c[:-1, :-1], c[-1, -1], c[:-1, -1:], c[-1:, :-1]
        return q, right - q, below - q, all_ - right - below + q
    if min(g.shape) < 2:
        return 0.0, np.zeros_like(g)
    gq, hq = sums(g), sums(h)
    gain = sum(x ** 2 / (y + l2) for x, y in zip(gq, hq))
    gain = np.where(np.minimum.reduce(hq) < least, -1, gain)
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    step = np.zeros_like(g)
    if gain[i, j] > 0:
        for x, y, rows, cols in zip(gq, hq, (slice(None, i + 1),) * 2 + (slice(i + 1, None),) * 2, (slice(None, j + 1), slice(j + 1, None)) * 2):
            step[rows, cols] = x[i, j] / (y[i, j] + l2)
    return float(gain[i, j]), step


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 120, pair_rounds: int = 60, n_pairs: int = 8, bins: int = 32,
        coarse: int = 12, leaves: int = 3, rate: float = 0.1, l2: float = 2.0, least: float = 2.0) -> Model:
    """Fit on feature rows ``x`` and labels ``y`` (0 or 1)."""
    empty = tuple(np.zeros(0) for _ in FEATURES)
    flat = tuple(np.zeros(1) for _ in FEATURES)
    share = float(y.mean()) if len(y) else 0.5
    clipped = min(max(share, 1e-3), 1 - 1e-3)
    base = float(np.log(clipped / (1 - clipped))) if len(y) else 0.0
    if len(y) < 20 or share in (0.0, 1.0):
        return Model(base, empty, flat, ())
    edges = [_edges(x[:, j], bins) for j in range(x.shape[1])]
    at = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    z = np.full(len(y), base)

    def slope() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-z))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j, b in enumerate(at):
            g, h = slope()
            t = rate * _tree(np.bincount(b, g, len(tables[j])), np.bincount(b, h, len(tables[j])), leaves, l2, least)
            tables[j] += t
            z += t[b]
    rough = [_edges(x[:, j], coarse) for j in range(x.shape[1])]
    cell = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(rough)]

    def grid(i: int, j: int, v: np.ndarray) -> np.ndarray:
        w = len(rough[j]) + 1
        return np.bincount(cell[i] * w + cell[j], v, (len(rough[i]) + 1) * w).reshape(-1, w)

    g, h = slope()
    gains = sorted(((_quadrants(grid(i, j, g), grid(i, j, h), l2, least)[0], i, j) for i in range(x.shape[1]) for j in range(i)), reverse=True)
    chosen = [(i, j, np.zeros((len(rough[i]) + 1, len(rough[j]) + 1))) for _, i, j in gains[:n_pairs]]
    for _ in range(pair_rounds):
        for i, j, t in chosen:
            g, h = slope()
            step = rate * _quadrants(grid(i, j, g), grid(i, j, h), l2, least)[1]
            t += step
            z += step[cell[i], cell[j]]
    return Model(base, tuple(edges), tuple(tables), tuple((i, j, rough[i], rough[j], t) for i, j, t in chosen))


def held_out(id_col: str = "doc_id", folds: int = FOLDS) -> Column:
    """Whether the row is never learned from: crc32 of the id as text divides by ``folds``."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == 0


def _featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = [features(t.as_py() or b"") for t in b.column(2).cast(pa.large_binary())]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([r.tolist() for r in x], pa.list_(pa.float64()))], ["id", "y", "x"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          max_train: int = MAX_TRAIN, folds: int = FOLDS, **params) -> Model:
    """Fit on labelled rows outside the held-out fold, ``max_train`` at most."""
    lab = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col, folds))
           .groupBy(F.col(id_col).cast("long").alias("__id")).agg((F.avg(F.col(label_col).cast("double")) >= 0.5).cast("int").alias("y")))
    sample = lab.orderBy(F.xxhash64("__id"), "__id").limit(max_train)
    rows = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
            .join(F.broadcast(sample), F.col("id") == F.col("__id"))  # max_train rows
            .select("id", "y", "text").mapInArrow(tidied(_featurize), "id long, y int, x array<double>"))
    got = sorted((r.id, r.y, tuple(r.x)) for r in rows.collect())[:max_train]  # repeated ids repeat rows
    return fit(np.array([r[2] for r in got]).reshape(-1, len(FEATURES)), np.array([r[1] for r in got], dtype=float), **params)


def _scorer(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([features(t.as_py() or b"") for t in b.column(1).cast(pa.large_binary())]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(x))], ["__row", "score"])
    return run


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without the text (and any ``score`` it had), plus ``score``."""
    rest = [c for c in docs.columns if c not in (text_col, "score")]
    src = docs.select((F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.struct(F.lit(0).alias("_"))).alias("__row"), F.col(text_col).cast("string").alias("__text"))
    out = src.mapInArrow(tidied(in_parts(_scorer(model))), f"__row {src.schema['__row'].dataType.simpleString()}, score double")
    return out.select(*[F.col("__row").getField(c).alias(c) for c in rest], "score")


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without those that score below ``threshold``; all columns stay as they are."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([features(t.as_py() or b"") for t in b.column(at).cast(pa.large_binary())]).reshape(-1, len(FEATURES))
            yield b.filter(pa.array(model.score(x) >= threshold))

    return docs.mapInArrow(tidied(in_parts(run)), docs.schema)
