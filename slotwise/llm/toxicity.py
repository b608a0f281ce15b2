"""Toxicity: noisy-channel deobfuscation, then a score of the restored text.

Disguised words (leetspeak, letters set apart, letters repeated, look-alike
letters) become character lattices; Viterbi decoding under a character
language model of the corpus picks the reading.  A logistic model over words
and word beginnings scores the restored words.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructType

from slotwise.llm.common import counted, cut, fold, table
from slotwise.llm.grams import codes, pieces, slot, slots

# What a disguised character may stand for.
READINGS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "¡": "i",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "к": "k", "м": "m", "т": "t",
    "*": "abcdefghijklmnopqrstuvwxyz", "#": "abcdefghijklmnopqrstuvwxyz",
}
# log cost of a reading other than the character itself
READ_COST, KEEP_COST, STAR_COST = -0.5, -3.0, -2.5
APART = frozenset(" .-_~|*'\t\n\r")
HIDDEN = re.compile("[­​-‏⁠﻿]")
SPACED = re.compile(r"(?<!\S)(?:[^\W_]|[@$!])(?:\s{1,2}(?:[^\W_]|[@$!])){2,}(?!\S)")
WORD = re.compile(r"\w+")
LEET = re.compile(r"[0-9@$!|+€£(¡*#](?=[^\W\d_])|(?<=[^\W\d_])[0-9@$](?!\S)")
REPEATED = re.compile(r"([^\W\d_])\1\1")
SET_APART = re.compile(r"(?:[^\W_]|[@$!])(?:[.\-_~|*'](?:[^\W_]|[@$!])){2,}")
MARKS = ".,;:?!\"()"
LOOK_ALIKE, LATIN = re.compile("[а-яі]"), re.compile("[a-z]")
LETTERS = re.compile(r"[^\W\d_]")
TAIL = re.compile(r"^[^\w@$!|+€£(*#]+|(?:[^\w@$]+|([^\w])\1+[^\w]*)$")

ORDERS = (1, 2, 3, 4)
BITS = 18
BEAM = 32
MEMO = 200_000          # words remembered per task

SAMPLE = 20_000         # labelled rows the score is fitted on, at most
FEATURES = 4096         # features it uses, at most
MIN_ROWS, MIN_Z = 3, 3.0
BEGINNINGS = (3, 4, 5, 6, 7)
STEPS, RIDGE = 500, 1e-4


class CharModel:
    """Interpolated character 4-gram model over hashed counts."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts.reshape(len(ORDERS), 1 << BITS)
        self.total = max(1, int(self.counts[0].sum()))
        self.memo: dict[str, float] = {}

    def logp(self, past: str, c: str) -> float:
        """log probability of ``c`` after ``past`` (its last three characters count)."""
        key = past[-3:] + c
        got = self.memo.get(key)
        if got is None:
            points = tuple(map(ord, key))
            p = 1e-6
            seen = self.total
            for n in ORDERS[:len(key)]:
                own = int(self.counts[n - 1][slot(points[-n:], BITS)])
                p = (own + 4.0 * p) / (seen + 4.0)
                # the count of the history that the next order continues
                if n < len(key):
                    seen = int(self.counts[n - 1][slot(points[-n - 1:-1], BITS)])
            got = self.memo[key] = math.log(min(p, 1.0))
            if len(self.memo) > MEMO:
                self.memo.clear()
        return got


def char_counts(docs: DataFrame) -> np.ndarray:
    """Hashed character n-gram counts of every whole text (fixed size)."""
    size = len(ORDERS) << BITS

    def count(columns: list) -> dict[int, np.ndarray]:
        n = np.zeros(size, np.int64)
        low = [" " + " ".join(t.lower().split()) + " " if t else None for t in columns[0]]
        for _, parts in pieces(low, ORDERS[-1]):
            for k, s in enumerate(slots(codes("".join(parts)), ORDERS, BITS)):
                n[k << BITS:(k + 1) << BITS] += np.bincount(s, minlength=1 << BITS)
        return {0: n}

    return counted(docs.select("text"), count, size)[0]


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """Per character or run of one character: the readings and their log costs."""
    out: list[list[tuple[str, float]]] = []
    apart = bool(SET_APART.fullmatch(token)) or bool(SPACED.fullmatch(token))
    i = 0
    while i < len(token):
        c = token[i]
        j = i
        while j < len(token) and token[j] == c:
            j += 1
        run, i = j - i, j
        if apart and c in APART:
            out.append([("", 0.0), (" ", READ_COST)])
        elif c in READINGS:
            star = c in "*#"
            reads = [(x, STAR_COST if star else READ_COST) for x in READINGS[c]]
            if run == 1 or star:
                out.extend([[(c, KEEP_COST), *reads]] * min(run, 3))
            else:
                out.append([(c * run, KEEP_COST), *reads, *((x + x, k) for x, k in reads)])
        elif run >= 3 and c.isalpha():
            out.append([(c, 0.0), (c + c, 0.0)])
        else:
            out.append([(c * run, 0.0)])
    return out


def decode(token: str, model: CharModel) -> str:
    """The likeliest reading of a token under the language model (Viterbi over the last three characters)."""
    paths: dict[str, tuple[float, str]] = {" ": (0.0, "")}
    for column in lattice(token):
        nxt: dict[str, tuple[float, str]] = {}
        for past, (score, text) in paths.items():
            for read, cost in column:
                s, h = score + cost, past
                for c in read:
                    s += model.logp(h, c)
                    h = (h + c)[-3:]
                if h not in nxt or s > nxt[h][0]:
                    nxt[h] = (s, text + read)
        if len(nxt) > BEAM:
            nxt = dict(sorted(nxt.items(), key=lambda x: -x[1][0])[:BEAM])
        paths = nxt
    return max(((s + model.logp(h, " "), t) for h, (s, t) in paths.items()))[1]


def restore_token(token: str, model: CharModel) -> str:
    """One lower-case token without blanks; a token that shows no disguise is returned as it is."""
    core = token.strip(MARKS)
    if core.isalpha():
        if REPEATED.search(core) or not core.isascii() and LOOK_ALIKE.search(core) and LATIN.search(core):
            return decode(core, model)
        return core
    core = TAIL.sub("", core)
    if LETTERS.search(core) and (LEET.search(core) or REPEATED.search(core) or SET_APART.fullmatch(core)):
        return decode(core, model)
    return token


def restore(text: str | None, model: CharModel) -> str:
    """Lower-cased text with disguised words restored; line feeds and single blanks stay."""
    if not text:
        return ""
    low = HIDDEN.sub("", text.lower())
    low = SPACED.sub(lambda m: decode(re.sub(r"\s+", " ", m[0]), model), low)
    return re.sub(r"\S+", lambda m: restore_token(m[0], model), low)


def features(word: str) -> list[str]:
    """A word and its beginnings (marked with a trailing hyphen)."""
    return [word, *(word[:k] + "-" for k in BEGINNINGS if len(word) > k)]


class Reader:
    """Features present in restored texts, with a memo of the tokens seen."""

    def __init__(self, counts: np.ndarray, wanted: dict[str, int] | None = None):
        self.model, self.wanted = CharModel(counts), wanted
        self.memo: dict[str, tuple] = {}
        # every feature of a word begins as the word does
        self.heads = None if wanted is None else {f[:3] for f in wanted}

    def of(self, token: str) -> tuple:
        read = restore_token(token, self.model)
        words = (read,) if read.isalpha() else WORD.findall(read)
        found: list = []
        for w in words:
            if len(w) > 2 and (self.heads is None or w[:3] in self.heads):
                found += features(w)
        if self.wanted is not None:
            found = [self.wanted[f] for f in found if f in self.wanted]
        if len(self.memo) >= MEMO:
            self.memo.clear()
        got = self.memo[token] = tuple(found)
        return got

    def read(self, text: str | None) -> set:
        out: set = set()
        if not text:
            return out
        low = HIDDEN.sub("", text.lower())
        low = SPACED.sub(lambda m: decode(re.sub(r"\s+", " ", m[0]), self.model), low)
        memo = self.memo
        for token in set(low.split()):
            got = memo.get(token)
            if got is None:
                got = self.of(token)
            if got:
                out.update(got)
        return out


@dataclass
class Model:
    counts: np.ndarray
    names: list[str] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = 0.0


def _logistic(ids: np.ndarray, per_row: np.ndarray, y: np.ndarray, size: int) -> tuple[np.ndarray, float]:
    """Ridge logistic regression over sparse 0/1 rows by accelerated gradient steps.

    ``ids``: the features of all rows, one row after the other; ``per_row``:
    how many each has.  Columns are scaled to unit mean square, so that rare
    features learn as fast as frequent ones.
    """
    n = max(1, len(per_row))
    own = np.repeat(np.arange(len(per_row)), per_row)
    scale = 1 / np.sqrt(np.maximum(1, np.bincount(ids, minlength=size)) / n)
    value = scale[ids]
    v, vb = np.ones(size), 1.0
    top = 1.0
    for _ in range(30):     # largest eigenvalue of the mean outer product, for the step size
        z = np.bincount(own, value * v[ids], n) + vb
        v, vb = np.bincount(ids, value * z[own], size) / n, z.mean()
        top = math.sqrt(float(v @ v) + vb * vb)
        v, vb = v / top, vb / top
    step = 1.0 / (0.25 * top * 1.1 + RIDGE)
    w, u, t = np.zeros(size), np.zeros(size), 1.0
    share = (y.sum() + 0.5) / (n + 1)
    b = ub = math.log(share / (1 - share))
    for _ in range(STEPS):
        z = np.bincount(own, value * u[ids], n) + ub
        e = 1 / (1 + np.exp(-np.clip(z, -50, 50))) - y
        nw = u - step * (np.bincount(ids, value * e[own], size) / n + RIDGE * u)
        nb = ub - step * e.mean()
        nt = (1 + math.sqrt(1 + 4 * t * t)) / 2
        u, ub = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return w * scale, float(b)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Language model from every text of ``docs``; score from at most ``SAMPLE`` rows of ``labels`` (doc_id, label).

    The sample is the lowest hashes of doc_id at any input size; its ids and
    labels are the only broadcast table.  Null labels teach nothing.  Only
    features that speak for label 1 are used, so that no amount of other
    words makes up for one of them.
    """
    counts = char_counts(docs)
    model = Model(counts)
    sample = (labels.filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull())
                    .select("doc_id", (F.col("label") > 0).cast("int").alias("label"))
                    .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(SAMPLE))
    picked = cut(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", "label")
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast(counts)

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value)
        n: tuple[Counter, Counter] = (Counter(), Counter())
        for b in batches:
            for text, label in zip(b.column("text").to_pylist(), b.column("label").to_pylist()):
                n[label].update(reader.read(text))
        names = list(n[0] | n[1])
        for at in range(0, len(names), 100_000):
            part = names[at:at + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.string()), *(pa.array([c[x] for x in part], pa.int64()) for c in n)],
                names=["feature", "n0", "n1"])

    size = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    n0, n1 = size.get(0, 0), size.get(1, 0)
    if not n0 or not n1:
        share = (n1 + 0.5) / (n0 + n1 + 1)
        model.bias = math.log(share / (1 - share)) if n0 + n1 else 0.0
        return model
    per_class = rows.mapInArrow(seen, "feature string, n0 long, n1 long").groupBy("feature").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    odds = (F.log((F.col("n1") + 0.5) / (n1 - F.col("n1") + 0.5)) - F.log((F.col("n0") + 0.5) / (n0 - F.col("n0") + 0.5)))
    error = F.sqrt(1 / (F.col("n1") + 0.5) + 1 / (F.col("n0") + 0.5))
    best = (per_class.filter(F.col("n0") + F.col("n1") >= MIN_ROWS)
                     .select("feature", (odds / error).alias("z")).filter(F.col("z") >= MIN_Z)
                     .orderBy(F.desc("z"), "feature").limit(FEATURES).collect())
    model.names = [r["feature"] for r in best]
    wanted = sc.broadcast({f: i for i, f in enumerate(model.names)})

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value, wanted.value)
        for b in batches:
            found = [sorted(reader.read(t)) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), b.column("label")],
                                             names=["ids", "label"])

    got = rows.mapInArrow(ids, "ids array<int>, label int").toArrow()
    found = got["ids"].combine_chunks()
    model.weights, model.bias = _logistic(found.flatten().to_numpy().astype(np.int64), np.diff(found.offsets.to_numpy()),
                                          got["label"].to_numpy().astype(float), len(model.names))
    return model


def score(docs: DataFrame, model: Model, restored: str | None = None, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``; ``restored`` names a column for the restored text.

    Row by row over whole texts: repeated rows stay; a null or empty text gets
    the score of no feature at all.  Only ``text`` is read; clashing columns
    are replaced.
    """
    new = ["score", "predicted", *([restored] if restored else [])]
    keep = [c for c in docs.columns if c not in new]
    out = [c for c in keep if keep_text or c != "text"]
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(**shared.value)
        reader = Reader(m.counts, {f: i for i, f in enumerate(m.names)})
        for b in batches:
            texts = b.column("text").to_pylist()
            p = np.array([1 / (1 + math.exp(-max(-700.0, m.bias + sum(m.weights[i] for i in reader.read(t)))))
                          for t in texts])
            columns = [*(b.column(c) for c in out), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))]
            if restored:
                columns.append(pa.array([restore(t, reader.model) for t in texts], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[*out, *new])

    schema = StructType([docs.schema[c] for c in out]).add("score", DoubleType()).add("predicted", IntegerType())
    if restored:
        schema = schema.add(restored, docs.schema["text"].dataType)
    return docs.select(*keep).mapInArrow(task, schema)


def learn_from(labels: DataFrame, held_out: Column) -> DataFrame:
    return labels.filter(~held_out).select("doc_id", F.col("toxic").alias("label"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; learnt from the labelled rows outside fold 0 of 5."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, learn_from(table(spark, sf_dir, "labels"), fold("doc_id", 5) == 0))
    scored = score(docs.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "text"), model, keep_text=False)
    return scored.select("doc_id", "held_out", "score", "predicted")
