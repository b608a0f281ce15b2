"""Language ID: multinomial naive Bayes over hashed character n-grams.

Training is one distributed count of (language, n-gram slot); the matrix of
log probabilities has a fixed number of rows and one column per language, so
it is small enough to broadcast.  Scoring sums its rows over a text's n-grams
in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from slotwise.llm.common import counted, fold, table
from slotwise.llm.grams import codes, pieces, slots

ORDERS = (1, 2, 3)
BITS = 15                   # slots per order: 2^15
MAX_LANGUAGES = 200         # columns of the broadcast matrix: 3 * 2^15 rows of 4 bytes each, 79 MB at most
SMOOTHING = 0.5
UNKNOWN = "und"
# Separator between joined texts; n-grams over it are left out.
GAP = "\x00"


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray     # (orders << BITS, languages) float32
    prior: np.ndarray       # log share of training texts


def grams(parts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Slots of each order over parts, and the part each comes from."""
    points = codes(GAP.join(parts))
    owner = np.repeat(np.arange(len(parts), dtype=np.int32), [len(p) + 1 for p in parts])[:len(points)]
    gap = points == 0
    ids, own = [], []
    crosses = gap
    for k, (n, s) in enumerate(zip(ORDERS, slots(points, ORDERS, BITS))):
        if k:
            crosses = crosses[:len(s)] | gap[n - 1:n - 1 + len(s)]
        ok = ~crosses[:len(s)]
        ids.append(s[ok].astype(np.int64) + (k << BITS))
        own.append(owner[:len(s)][ok])
    return ids, own


def normal(text: str | None) -> str:
    return text.lower().replace(GAP, " ") if text else ""


def fit(rows: DataFrame) -> Model:
    """Counts over every row with a text and a ``lang``; others teach nothing."""
    rows = rows.filter(F.col("lang").isNotNull() & (F.coalesce(F.length("text"), F.lit(0)) > 0))
    share = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
             .orderBy("lang").limit(MAX_LANGUAGES + 1).collect()}
    if len(share) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: the model matrix would not be small")
    languages = sorted(share)
    number = {x: i for i, x in enumerate(languages)}
    size = len(ORDERS) << BITS

    def count(columns: list) -> dict[int, np.ndarray]:
        out: dict[int, np.ndarray] = {}
        texts, langs = columns
        for lang in set(langs):
            mine = [normal(t) for t, x in zip(texts, langs) if x == lang]
            for _, parts in pieces(mine, ORDERS[-1]):
                n = np.bincount(np.concatenate(grams(parts)[0]), minlength=size)
                g = number[lang]
                out[g] = out[g] + n if g in out else n
        return out

    n = counted(rows.select("text", "lang"), count, size, max(1, len(languages)))[:len(languages)]
    by_order = n.reshape(len(languages), len(ORDERS), 1 << BITS) + SMOOTHING
    weights = np.log(by_order / by_order.sum(axis=2, keepdims=True)).reshape(len(languages), size)
    prior = np.log(np.array([share[x] for x in languages], float) / max(1, sum(share.values())))
    return Model(languages, np.ascontiguousarray(weights.T, np.float32), prior)


def score(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Best language and its posterior probability for each text."""
    total = np.zeros((len(texts), max(1, len(model.languages))))
    low = [normal(t) for t in texts]
    if model.languages:
        for rows, parts in pieces(low, ORDERS[-1]):
            ids, own = grams(parts)
            back = np.array(rows)
            for i, o in zip(ids, own):
                if len(i) == 0:
                    continue
                first = np.flatnonzero(np.diff(o, prepend=-1))
                # slices keep the gathered weights small
                sums = np.empty((len(first), len(model.languages)))
                for c in range(len(model.languages)):
                    sums[:, c] = np.add.reduceat(model.weights[i, c], first, dtype=np.float64)
                np.add.at(total, back[o[first]], sums)
        total += model.prior
    best = total.argmax(axis=1)
    top = total[np.arange(len(texts)), best]
    p = 1.0 / np.exp(np.clip(total - top[:, None], -700, 0)).sum(axis=1)
    names = []
    for i, t in enumerate(texts):
        if not model.languages or not t or not any(ch.isalpha() for ch in t):
            names.append(UNKNOWN)
            p[i] = 0.0
        else:
            names.append(model.languages[best[i]])
    return names, p


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (the posterior, 0 to 1).

    Row by row, whole texts: repeated rows stay and get equal results; a null
    text or one without a letter is ``und`` with score 0, and so is every text
    if there was nothing to learn from; ties go to the first language in
    alphabetical order.  ``lang``, ``source`` and ``doc_id`` are not read; a
    clashing ``lang_pred`` or ``score`` column is replaced.
    """
    keep = [c for c in docs.columns if c not in ("text", "lang_pred", "score")]
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))   # plain values only

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(**shared.value)
        for b in batches:
            names, p = score(m, b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(names, pa.string()),
                                              pa.array(p, pa.float64())], names=[*keep, "lang_pred", "score"])

    schema = StructType([docs.schema[c] for c in keep]).add("lang_pred", StringType()).add("score", DoubleType())
    return docs.select(*keep, "text").mapInArrow(task, schema)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; learnt from the rows outside fold 0 of 5."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.filter(fold("doc_id", 5) != 0).select("text", "lang"))
    rows = docs.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "text")
    return predict(rows, model)
