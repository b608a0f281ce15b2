"""Quality classifier: a sparse rule ensemble over text statistics.

Small boosted trees propose conjunctive rules (every path from the root), a
lasso logistic regression keeps few of them, and the kept rules become one
Spark column expression over the statistics columns.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from slotwise.llm.common import cut, fold, table
from slotwise.llm.grams import codes

SAMPLE = 20_000     # labelled rows the ensemble is fitted on, at most
TREES, DEPTH, BINS, RATE = 40, 3, 32, 0.3
PENALTY = 1e-3
STEPS = 400

STATISTICS = ("chars", "words", "word_length", "upper_share", "digit_share", "symbol_share", "mark_share",
              "shout_share", "repeat_share", "top_word_share", "triple_repeat_share", "distinct_share",
              "lines", "line_repeat_share", "short_line_share", "lone_symbol_share")

LOWER, UPPERCASE, DIGIT, BLANK, MARK, SHOUT, SYMBOL = range(7)
_classes: list[np.ndarray] = []


def classes() -> np.ndarray:
    """Character class of each code point below 65,536, built once per process; higher ones count as symbols."""
    if not _classes:
        lut = np.full(65536, SYMBOL, np.uint8)
        for i in range(65536):
            c = chr(i)
            if c.isupper():
                lut[i] = UPPERCASE
            elif c.isalpha():
                lut[i] = LOWER
            elif c.isdigit():
                lut[i] = DIGIT
            elif c.isspace():
                lut[i] = BLANK
        for c in ".,;:?'\"()-":
            lut[ord(c)] = MARK
        lut[ord("!")] = SHOUT
        _classes.append(lut)
    return _classes[0]


def statistics(text: str | None) -> list[float]:
    """The numbers named in ``STATISTICS``; all 0 for a null, empty or blank text."""
    words = text.split() if text else []
    if not words:
        return [0.0] * len(STATISTICS)
    points = codes(text)
    n = np.bincount(classes()[np.minimum(points, 65535)], minlength=7)
    chars, count = len(points), len(words)
    letters = max(1, int(n[LOWER] + n[UPPERCASE]))
    ink = max(1, chars - int(n[BLANK]))
    seen = Counter(words)
    triples = max(0, count - 2)
    lines = [x for x in text.split("\n") if x.strip()]
    return [
        float(chars), float(count), (ink / count), n[UPPERCASE] / letters, n[DIGIT] / ink, n[SYMBOL] / ink,
        n[MARK] / ink, n[SHOUT] / ink,
        sum(map(str.__eq__, words, words[1:])) / count,
        max(seen.values()) / count,
        1.0 - len(set(zip(words, words[1:], words[2:]))) / triples if triples else 0.0,
        len(seen) / count,
        float(len(lines)), 1.0 - len(set(lines)) / len(lines),
        sum(len(x) < 20 for x in lines) / len(lines),
        sum(v for w, v in seen.items() if len(w) == 1 and not w.isalnum()) / count,
    ]


def with_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with its ``text`` replaced by the statistics columns (clashing columns are replaced)."""
    keep = [c for c in docs.columns if c != "text" and c not in STATISTICS]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = np.array([statistics(t) for t in b.column("text").to_pylist()]).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in keep), *(pa.array(m[:, i]) for i in range(len(STATISTICS)))],
                names=[*keep, *STATISTICS])

    schema = StructType([docs.schema[c] for c in keep])
    for s in STATISTICS:
        schema = schema.add(s, DoubleType())
    return docs.select(*keep, "text").mapInArrow(task, schema)


Rule = tuple[tuple[int, bool, float], ...]      # (statistic, above?, threshold), ... all of them hold


@dataclass
class Ensemble:
    rules: list[Rule]
    weights: list[float]
    bias: float


def _tree(binned: np.ndarray, edges: list[np.ndarray], g: np.ndarray, h: np.ndarray) -> list[tuple[Rule, np.ndarray, float]]:
    """All paths of one regression tree: (rule, rows, leaf value)."""
    found: list[tuple[Rule, np.ndarray, float]] = []

    def grow(rows: np.ndarray, path: Rule) -> None:
        if path:
            found.append((path, rows, -g[rows].sum() / (h[rows].sum() + 1.0)))
        if len(path) == DEPTH or len(rows) < 40:
            return
        gr, hr = g[rows], h[rows]
        gs, hs = gr.sum(), hr.sum()
        best = (1e-3, 0, 0)
        for f in range(binned.shape[1]):
            b = binned[rows, f]
            gl = np.cumsum(np.bincount(b, gr, BINS))[:-1]
            hl = np.cumsum(np.bincount(b, hr, BINS))[:-1]
            nl = np.cumsum(np.bincount(b, minlength=BINS))[:-1]
            gain = gl * gl / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs * gs / (hs + 1)
            gain[(nl < 10) | (len(rows) - nl < 10)] = 0
            at = int(gain.argmax())
            if gain[at] > best[0]:
                best = (float(gain[at]), f, at)
        if best[0] <= 1e-3:
            return
        _, f, at = best
        above = binned[rows, f] > at
        threshold = float(edges[f][at]) if at < len(edges[f]) else float("inf")
        grow(rows[~above], (*path, (f, False, threshold)))
        grow(rows[above], (*path, (f, True, threshold)))

    grow(np.arange(len(g)), ())
    return found


def fit(x: np.ndarray, y: np.ndarray) -> Ensemble:
    """Rules and weights for labels 0/1.  With one class only, or no rows, there is no rule."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    prior = float(np.log(share / (1 - share)))
    if len(y) == 0 or y.min() == y.max():
        return Ensemble([], [], prior)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    z = np.full(len(y), prior)
    rules: dict[Rule, np.ndarray] = {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-z))
        found = _tree(binned, edges, p - y, p * (1 - p))
        inner = {path[:-1] for path, _, _ in found}
        for path, rows, value in found:
            if path not in rules:
                hit = np.zeros(len(y), np.float32)
                hit[rows] = 1
                rules[path] = hit
            if path not in inner:
                z[rows] += RATE * value
    names = list(rules)
    r = np.stack([rules[k] for k in names], axis=1)
    w, bias = _lasso(r, y.astype(np.float32), prior)
    on = np.flatnonzero(np.abs(w) > 1e-6)
    return Ensemble([names[i] for i in on], [float(w[i]) for i in on], bias)


def _lasso(r: np.ndarray, y: np.ndarray, bias: float) -> tuple[np.ndarray, float]:
    """Logistic regression with an L1 penalty by accelerated proximal gradient steps."""
    n, m = r.shape
    v = np.ones(m, np.float32)
    for _ in range(20):     # largest singular value, for the step size
        v = r.T @ (r @ v)
        v /= np.linalg.norm(v)
    step = 1.0 / (0.25 * (float(np.linalg.norm(r @ v)) ** 2 / n + 1.0) * 1.05)
    w, u, t = np.zeros(m, np.float32), np.zeros(m, np.float32), 1.0
    b, ub = bias, bias
    for _ in range(STEPS):
        e = 1 / (1 + np.exp(-(r @ u + ub))) - y
        nw = u - step * (r.T @ e) / n
        nw = np.sign(nw) * np.maximum(np.abs(nw) - step * PENALTY, 0)
        nb = ub - step * float(e.mean())
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        u, ub = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return w, float(b)


def compiled(model: Ensemble) -> Column:
    """Probability of label 1 as a column expression over the statistics."""
    z = F.lit(model.bias)
    for rule, weight in zip(model.rules, model.weights):
        holds = F.lit(True)
        for f, above, threshold in rule:
            c = F.col(STATISTICS[f])
            holds = holds & ((c > threshold) if above else (c <= threshold))
        z = z + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def train(stats: DataFrame, labels: DataFrame) -> Ensemble:
    """Fit on at most ``SAMPLE`` rows of ``stats`` that ``labels`` (doc_id, label) marks.

    The sample is the lowest hashes of doc_id, whatever the size of the input.
    Null labels are ignored; several labels of a document all count.
    """
    rows = (stats.select("doc_id", *STATISTICS).join(labels.select("doc_id", "label").filter(F.col("label").isNotNull()), "doc_id")
                 .select(*STATISTICS, F.col("label").cast("int").alias("label"), F.xxhash64("doc_id").alias("h"))
                 .orderBy("h", *STATISTICS, "label").limit(SAMPLE).toArrow())
    x = np.stack([rows[s].to_numpy() for s in STATISTICS], axis=1) if len(rows) else np.zeros((0, len(STATISTICS)))
    return fit(x, (rows["label"].to_numpy() > 0).astype(float))


def quality(docs: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """``docs`` (doc_id, text) with statistics, ``score`` and ``predicted``, taught by the rows where ``learn`` holds.

    Row by row: repeated rows stay; an empty or null text is scored from
    statistics that are all 0.  ``lang``, ``source`` and ``doc_id`` are not
    read by a score.
    """
    stats = cut(with_statistics(docs))
    model = train(stats.filter(learn), labels)
    return (stats.withColumn("score", compiled(model))
                 .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; learnt from the labelled rows outside fold 1 of 3."""
    docs = (table(spark, sf_dir, "documents").select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "text"))
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return quality(docs, labels, ~F.col("held_out")).select("doc_id", "held_out", "score", "predicted")
