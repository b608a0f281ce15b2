"""Quality, toxicity, language, near duplicates, packing and the pipeline."""

import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotwise.llm import language_id as G
from slotwise.llm import near_dedup as N
from slotwise.llm import packing as P
from slotwise.llm import quality_rules as Q
from slotwise.llm import toxicity as T

SF = "/root/testdata/sf0.01"
LONG = "word " * 30_000
ODD = [(None, "no id here", "x"), (1, None, "x"), (2, "", None), (3, LONG, "x"), (3, LONG, "x"), (4, "tie", "x"),
       (4, "tie two", "x"), (5, "12 !! --", None)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string, score string")


def held(doc_id, mod):
    return zlib.crc32(str(doc_id).encode()) % mod


def accuracy(spark, df, column):
    rows = df.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").filter("held_out").collect()
    right = [(r["predicted"] == r[column], r[column], r["score"]) for r in rows]
    assert all(0 <= s <= 1 for _, _, s in right)
    per_class = [[ok for ok, y, _ in right if y == c] for c in (0, 1)]
    return [sum(x) / len(x) for x in per_class]


# quality

def test_quality_on_held_out_rows(spark):
    df = Q.op2_quality_rules(spark, SF)
    rows = df.collect()
    assert len(rows) == 1000 and all(r["held_out"] == (held(r["doc_id"], 3) == 1) for r in rows)
    assert min(accuracy(spark, df, "quality")) > 0.9


def test_rules_compiled_to_columns_equal_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.random((600, len(Q.STATISTICS)))
    y = ((x[:, 3] > 0.6) & (x[:, 5] < 0.7)).astype(float)
    model = Q.fit(x, y)
    assert 0 < len(model.rules) and all(1 <= len(r) <= Q.DEPTH for r in model.rules)
    z = np.full(len(x), model.bias)
    for rule, w in zip(model.rules, model.weights):
        hit = np.ones(len(x), bool)
        for f, above, t in rule:
            hit &= (x[:, f] > t) if above else (x[:, f] <= t)
        z += w * hit
    df = spark.createDataFrame(x.tolist(), list(Q.STATISTICS)).select(Q.compiled(model).alias("p"))
    got = np.array([r["p"] for r in df.collect()])
    assert np.allclose(got, 1 / (1 + np.exp(-z))) and ((got >= 0.5) == y).mean() > 0.97


def test_quality_of_odd_rows(spark, odd):
    none = spark.createDataFrame([], "doc_id long, label int")
    one = spark.createDataFrame([(1, 1), (4, None), (4, 1)], "doc_id long, label int")
    for labels in (none, one):
        rows = Q.quality(odd, labels, F.lit(True)).collect()
        assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert Q.quality(odd.limit(0), one, F.lit(True)).count() == 0
    clash = odd.withColumn("label", F.lit("x")).withColumn("words", F.lit("x"))
    assert Q.quality(clash, one, F.lit(True)).filter("label = 'x'").count() == len(ODD)
    assert Q.statistics(None) == Q.statistics(" \n") == [0.0] * len(Q.STATISTICS)


# toxicity

@pytest.fixture(scope="module")
def char_model(spark):
    return T.CharModel(T.char_counts(spark.read.parquet(f"{SF}/documents.parquet")))


def test_toxicity_on_held_out_rows(spark):
    df = T.op9_toxicity(spark, SF)
    assert df.count() == 1000
    clean, toxic = accuracy(spark, df, "toxic")
    assert clean > 0.97 and toxic > 0.5


@pytest.mark.parametrize("seen, meant", [
    ("id1ot", "idiot"), ("1d10t", "idiot"), ("idiooot", "idiot"), ("i.d.i.o.t", "idiot"), ("m0r0n", "moron"), ("$tupid", "stupid"),
    ("tr@sh", "trash"), ("i d i o t", "idiot"), ("p4th3tic", "pathetic"), ("idiot", "idiot"), ("the cat", "the cat"), ("", "")])
def test_restored_words(spark, seen, meant):
    # a language model of a small vocabulary: the words themselves, in running text
    docs = spark.createDataFrame([("the idiot and the moron are stupid pathetic trash the cat sat",)] * 50, "text string")
    key = "model"
    if key not in _models:
        _models[key] = T.CharModel(T.char_counts(docs))
    assert T.restore(seen, _models[key]) == meant


_models: dict = {}


def test_viterbi_finds_the_best_path(char_model):
    import itertools
    for token in ("1d10t", "m0r0n", "aaab1", "s.c.u.m"):
        best = max(
            (sum(k for _, k in path) + sum(char_model.logp((" " + text)[max(0, i - 2):i + 1] if i else " ", c)
                                            for i, c in enumerate(text + " ")), text)
            for path in itertools.product(*T.lattice(token)) for text in ["".join(x for x, _ in path)])
        assert T.decode(token, char_model) == best[1]


def test_toxicity_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(4, 1), (5, 0), (3, 0), (1, None)], "doc_id long, label int")
    model = T.train(odd, labels)
    rows = T.score(odd, model, restored="clear").collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 and r["clear"] is not None for r in rows)
    assert T.score(odd.limit(0), model).count() == 0
    assert T.train(odd, labels.limit(0)).bias == 0 and T.train(odd.limit(0), labels).names == []


# language

def test_language_on_held_out_rows(spark):
    docs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = G.op10_language_id(spark, SF).collect()
    assert len(rows) == len(docs) and all(r["held_out"] == (held(r["doc_id"], 5) == 0) for r in rows)
    out = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == docs[r["doc_id"]] for r in out) / len(out) > 0.98


def test_language_against_plain_naive_bayes(spark):
    rows = [("aa", "abab abba aab"), ("aa", "bab aba"), ("cc", "cdcd dccd ccd"), ("cc", "dc cdc cd dcd")]
    train = spark.createDataFrame(rows, "lang string, text string")
    model = G.fit(train)
    assert model.languages == ["aa", "cc"]
    from collections import Counter
    grams = lambda t, n: [t[i:i + n] for i in range(len(t) - n + 1)]
    for text in ("abab", "dcdc", "ad"):
        logp = []
        for lang in model.languages:
            z = np.log(0.5)
            for n in G.ORDERS:
                c = Counter(g for x, t in rows if x == lang for g in grams(t, n))
                total = sum(c.values()) + G.SMOOTHING * (1 << G.BITS)
                z += sum(np.log((c[g] + G.SMOOTHING) / total) for g in grams(text, n))
            logp.append(z)
        p = np.exp(logp - max(logp)) / np.exp(logp - max(logp)).sum()
        names, got = G.score(model, [text])
        assert names[0] == model.languages[int(np.argmax(logp))] and abs(got[0] - p.max()) < 1e-4


def test_language_of_odd_and_very_long_texts(spark, odd):
    model = G.fit(odd.withColumn("lang", F.when(F.col("doc_id") == 3, "xx")))
    got = sorted(((r["doc_id"], r["lang_pred"]) for r in G.predict(odd, model).collect()), key=str)
    assert (1, "und") in got and (2, "und") in got and (5, "und") in got and (3, "xx") in got and len(got) == len(ODD)
    nothing = G.fit(odd.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in G.predict(odd, nothing).collect()} == {"und"}
    assert G.predict(odd.limit(0), model).count() == 0
    # a text of several pieces counts every n-gram once
    big = "ab" * (G.PIECE if hasattr(G, "PIECE") else 1 << 20)
    from slotwise.llm.grams import pieces
    parts = [p for _, ps in pieces([big], 3) for p in ps]
    assert sum(len(p) - 2 for p in parts) == len(big) - 2


# near duplicates

def shingles(text):
    w = re.findall(r"\w+", (text or "").lower())
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset([text or ""])


def classes(docs):
    """Least id of the connected component of each document, by all pairs."""
    ids, sets = [d for d, _ in docs], [shingles(t) for _, t in docs]
    root = list(range(len(ids)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                root[max(top(i), top(j))] = min(top(i), top(j))
    least = {}
    for i, d in enumerate(ids):
        least[top(i)] = min(d, least.get(top(i), d))
    return {d: least[top(i)] for i, d in enumerate(ids)}


def copies(n, seed=1):
    """Chains and stars of near copies, exact copies, and texts of their own."""
    rng = random.Random(seed)
    docs = []
    for group in range(8):
        words = [f"g{group}w{i}" for i in range(120)]
        for _ in range(n // 8):
            docs.append((len(docs), " ".join(words)))
            if rng.random() < 0.8:
                words = words[:]
                for _ in range(rng.randrange(1, 4)):
                    words[rng.randrange(120)] = f"x{rng.randrange(10 ** 6)}"
    docs += [(len(docs) + i, f"one of its own {i} " + " ".join(f"u{i}v{k}" for k in range(20))) for i in range(20)]
    docs += [(len(docs) + i, t) for i, t in enumerate(["", "", None, "?!", "a b", "a  B", "c d e f g"])]
    return docs


@pytest.mark.parametrize("block", [N.BLOCK, 4])
def test_near_duplicates_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(N, "BLOCK", block)
    docs = copies(160)
    got = {r["doc_id"]: r["class_id"] for r in N.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == classes(docs)


def test_near_duplicates_that_repeat_a_passage_unlike_often(spark):
    docs = []
    for pair in range(60):
        own = [f"p{pair}w{i}" for i in range(200)]
        passage = [f"p{pair}r{i}" for i in range(54)]
        docs.append((len(docs), " ".join(own + passage * 50)))
        docs.append((len(docs), " ".join(own + passage + [f"p{pair}x{i}" for i in range(50)])))
    got = {r["doc_id"]: r["class_id"] for r in N.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == classes(docs) == {i: i - i % 2 for i in range(120)}


def test_registers_estimate_probability_jaccard():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(600)]
    other = [w if rng.random() < 0.96 else w + "x" for w in words]
    (_, _, a, ca), (_, _, b, cb) = N.shingles([" ".join(words), " ".join(other)])
    r = N.signatures([a, b], [ca, cb])
    exact = len(set(a.tolist()) & set(b.tolist())) / len(set(a.tolist()) | set(b.tolist()))
    assert abs((r[0] == r[1]).mean() - exact) < 0.15
    # early termination changes nothing: the winners are those of one set alone
    assert (N.signatures([a], [ca])[0] == r[0]).all()


def test_word_hashes_of_long_texts_do_not_depend_on_pieces(monkeypatch):
    text = " ".join(f"word{i}" for i in range(5000))
    whole = N.word_hashes(text)
    monkeypatch.setattr(N, "PIECE", 1000)
    N._tables.clear()
    assert (N.word_hashes(text) == whole).all()
    N._tables.clear()


def test_near_duplicates_of_odd_rows(spark, odd):
    rows = N.near_duplicates(odd).collect()
    assert len(rows) == len(ODD)
    assert [r["class_size"] for r in rows if r["doc_id"] == 3] == [2, 2]
    assert {(r["class_id"], r["class_size"]) for r in rows if r["doc_id"] in (1, 2)} == {(1, 2)}   # null is empty
    assert N.near_duplicates(odd.limit(0)).count() == 0
    kept = N.one_of_each(odd)
    assert kept.columns == odd.columns and kept.count() == len(ODD) - 2


# packing

def tightest(items, capacity):
    """Best fit by looking at every bin."""
    bins, out = [], []
    for length, source, cluster in items:
        fits = [(capacity - b["used"] - length, n) for n, b in enumerate(bins)
                if b["used"] + length <= capacity and (source is None or source not in b["s"]) and (cluster is None or cluster not in b["c"])]
        n = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append({"used": 0, "s": set(), "c": set()})
        bins[n]["used"] += length
        bins[n]["s"].add(source)
        bins[n]["c"].add(cluster)
        out.append(n)
    return out


def test_best_fit_takes_the_tightest_compatible_bin():
    rng = random.Random(4)
    for _ in range(20):
        items = [(rng.randrange(0, 60), rng.choice(["a", "b", "c", None, "d"]), rng.choice([None, 1, 2, 3, 4, 5])) for _ in range(200)]
        items.sort(key=lambda x: -x[0])
        assert P.pack_items(items, 60)[0] == tightest(items, 60)


def test_packing_keeps_everything_and_respects_conflicts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    info = {r["doc_id"]: r for r in P.measured(docs).collect()}
    bins, length = {}, {}
    for r in P.pack(P.measured(docs), shard=100).collect():
        bins.setdefault(r["bin_id"], []).append(r)
        length[r["doc_id"]] = length.get(r["doc_id"], 0) + r["length"]
    assert length == {d: r["length"] for d, r in info.items()}
    for rows in bins.values():
        assert sum(r["length"] for r in rows) <= P.CAPACITY
        assert sorted(r["position"] for r in rows) == list(range(len(rows)))
        for c in ("source", "cluster"):
            assert len({info[r["doc_id"]][c] for r in rows}) == len(rows)


def test_packing_of_odd_rows(spark):
    rows = [(None, 5, "a", 1), (1, None, None, None), (2, 0, "a", 2), (3, 25, "b", 3), (3, 25, "b", 3), (4, 20, "c", 4), (5, -3, "c", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, length long, source string, cluster long").withColumn("bin_id", F.lit("clash"))
    got = P.pack(docs, capacity=10).collect()
    by_doc = {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r["length"])
    assert {d: sum(x) for d, x in by_doc.items()} == {None: 5, 1: 0, 2: 0, 3: 50, 4: 20, 5: 0}
    assert sorted(by_doc[4]) == [10, 10]
    assert P.pack(docs.limit(0)).count() == 0


# pipeline

def test_pipeline_stages(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = []
    for k, (name, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < 4:
            assert out.columns == docs.columns, name
            out.write.mode("overwrite").parquet(path := os.path.join(os.environ["SLOTWISE_CHECKPOINT_DIR"], f"stage-{k}"))
            docs = spark.read.parquet(path)
            kept.append(docs.count())
            assert docs.filter("n_chars <> length(text)").count() == 0
        else:
            packed = {r["doc_id"] for r in out.collect()}
    assert 1000 > kept[0] and kept[1] == kept[0] and kept[1] > kept[2] > kept[3] > 800
    assert packed == {r["doc_id"] for r in docs.select("doc_id").collect()}


def test_pipeline_stages_of_odd_rows(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    small = "/root/testdata/sf0.001"
    rows = [(i, t, "en", s, len(t or "")) for i, t, s in ODD]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        docs = docs.withColumn("score", F.lit("clash")).withColumn("keep", F.lit(1)).withColumn("key", F.lit(2))
        n = docs.count()
        for k, (name, stage) in enumerate(pipeline.STAGES):
            out = stage(spark, docs, small)
            if k == 4:
                assert {r["doc_id"] for r in out.collect()} == ({r[0] for r in rows} if n else set())
                continue
            assert tuple(out.columns) == pipeline.COLUMNS, name
            got = out.collect()
            assert len(got) == (n if name != "near dedup" else n and n - 2), name      # the second 3, and one of null and empty
            assert name != "line dedup" or all(r["text"] is not None for r in got)


def test_components_stop_once_all_are_stars(spark):
    """Random graphs against a union-find; stars are seen to be stars without a round over them."""
    import random
    rnd = random.Random(12)

    def least(edges):
        root = {}

        def top(x):
            while root.setdefault(x, x) != x:
                x = root[x]
            return x
        for a, b in edges:
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
        return {x: top(x) for x in list(root)}

    def found(df):
        rows = [(bytes(r["key"]), bytes(r["comp"])) for r in df.collect()]
        assert len(rows) == len(dict(rows))
        return dict(rows)

    name = lambda k: b"%03d" % k
    chain = [(name(k), name(k + 1)) for k in range(40)]
    loose = [tuple(rnd.sample([name(k) for k in range(100, 200)], 2)) for _ in range(60)]
    first = chain + loose
    frame = lambda edges: spark.createDataFrame(edges, "a binary, b binary").repartition(3)
    comps = N.components(frame(first))
    assert found(comps) == least(first)
    # links between components, single keys among them
    of = lambda k: least(first).get(k, k)
    more = [(of(name(5)), of(first[45][0])), (name(300), name(301)), (of(first[50][1]), name(302))]
    assert found(N.joined(comps, frame(more))) == least(first + more)

    stars = frame([(name(k), name(k % 7)) for k in range(7, 90)])
    rounds = []
    cut, N.cut = N.cut, lambda df: rounds.append(df) or cut(df)
    try:
        assert found(N.components(stars)) == {name(k): name(k if k < 7 else k % 7) for k in range(90)}
    finally:
        N.cut = cut
    assert len(rounds) == 1
