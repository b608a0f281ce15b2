"""Source divergence, mixing to target weights, filter interaction."""

import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotwise.check import duck, rows_of
from slotwise.llm import divergence as D
from slotwise.llm import filter_audit as A
from slotwise.llm import mixing as M

SF = "/root/testdata/sf0.01"
LONG = "word " * 30_000
ODD = [(None, "no id here", "x", None), (1, None, "x", "en"), (2, "", None, "en"), (3, LONG, "x", "en"), (3, LONG, "x", "en"),
       (4, "tie", "y", "en"), (4, "tie two", "y", "en"), (5, "12 !! --", None, None), (6, "ÀÉ ß tie Tie", "", "")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, "clash") for r in ODD], "doc_id long, text string, source string, lang string, n string").select(
        "*", F.lit(1).alias("rank"), F.lit("p").alias("part"), F.lit(7).alias("size"), F.lit(0).alias("mask"))


def same_as_sql(spark, query, sql, sf=SF):
    df = query(spark, sf)
    rel = duck(sf).sql(sql)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(rel.columns, rel.fetchall())


# source divergence

def brute_divergence(docs, min_docs):
    """The rows by their definition, in Python integers."""
    count, held = Counter(), Counter()
    groups = {(lang or "", source or "") for lang, source, _ in docs}
    for lang, source, text in docs:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        for t in found:
            count[lang or "", source or "", t] += 1
        for t in set(found):
            held[lang or "", t] += 1
    rows = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for (x, t), n in held.items() if x == lang and n >= min_docs)
        sources = sorted(s for x, s in groups if x == lang)
        v = len(kept)
        own = {s: {t: count[lang, s, t] for t in kept} for s in sources}
        own[None] = {t: sum(own[s][t] for s in sources) for t in kept}
        p = {s: {t: 1 + 10 ** 9 * (c[t] + 2) // (sum(c.values()) + 2 * v) for t in kept} for s, c in own.items()}
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s in sources:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            terms = [(-f(p[s][t], p[None][t]), t.encode(), t) for t in kept if own[s][t] and p[s][t] > p[None][t]]
            rows += [(lang, s, "pair", o, -x, k + 1) for k, (x, _, o) in enumerate(sorted(pairs))]
            rows += [(lang, s, "term", t, -x, k + 1) for k, (x, _, t) in enumerate(sorted(terms)[:10])]
    return sorted(rows)


def divergence_rows(spark, docs, **kw):
    df = spark.createDataFrame(docs, "lang string, source string, text string")
    return sorted(tuple(r) for r in D.divergence(df, **kw).collect())


def some_docs(seed, sources=9, rows=250):
    rnd = random.Random(seed)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)] + ["Straße", "ÜBER", "日本", "ZZ"]
    out = []
    for _ in range(rows):
        s = 0 if rnd.random() < 0.4 else rnd.randrange(sources)
        start = 9 * s
        text = " ".join(rnd.choice(words[start:start + 40] + words[-4:]) for _ in range(rnd.randrange(0, 40)))
        out.append((rnd.choice(["en", "en", "de", None]), None if s == 3 else f"s{s}", text))
    return out + [("xx", "only", "rare words here"), ("xx", "other", None), ("yy", "alone", "")]


def test_divergence_matches_sql(spark):
    same_as_sql(spark, D.op11_divergence, D.SQL)


@pytest.mark.parametrize("strip,tile,leaf", [(1 << 17, 512, 8), (50, 512, 4), (200, 2, 2)])
def test_divergence_by_definition(spark, monkeypatch, strip, tile, leaf):
    for name, value in (("STRIP", strip), ("TILE", tile), ("LEAF", leaf), ("CHUNK", 7), ("HELD", 100)):
        monkeypatch.setattr(D, name, value)
    docs = some_docs(strip)
    assert divergence_rows(spark, docs, min_docs=4) == brute_divergence(docs, 4)


def test_divergence_of_odd_rows(spark, odd):
    docs = [(r[3], r[2], r[1]) for r in ODD] * 10
    df = odd.select("*").unionByName(odd)
    for _ in range(2):
        df = df.unionByName(df)
    df = df.unionByName(odd).unionByName(odd)
    got = sorted(tuple(r) for r in D.divergence(df).collect())
    assert got == brute_divergence(docs, 10)
    assert D.divergence(odd.limit(0)).count() == 0


def test_probabilities_are_exact():
    rnd = random.Random(1)
    rows = [(rnd.randrange(10 ** k), 10 ** k + rnd.randrange(10 ** k)) for k in range(1, 15) for _ in range(50)]
    count, total = (np.array(x, np.int64) for x in zip(*rows))
    assert D.probability(count, total).tolist() == [1 + 10 ** 9 * (c + 2) // n for c, n in rows]


def test_tree_prices_zero_quadrants_without_cells():
    rnd = np.random.default_rng(3)
    rows, columns = 37, 301
    p = rnd.integers(1, 1000, (rows, columns))
    zero = rnd.integers(1, 50, rows)
    on = rnd.random((rows, columns)) < 0.05
    r, c = np.nonzero(on)
    dense = np.where(on, p, zero[:, None])
    tree = D.Tree(r, c, p[r, c], zero, columns, D.depth_of(rows, columns))
    want = D.price(dense[:, None, :], dense[None, :, :]).sum(axis=2)
    got = D.joint_walk(tree, tree, columns, True)
    assert all(got[i, j] == want[i, j] for i in range(rows) for j in range(i, rows))
    assert (D.joint_walk(tree, tree, columns, False) == want).all()
    assert len(tree.levels[0]) == 1 and len(tree.leaves) <= on.sum()
    none = D.Tree(*(np.empty(0, np.int64),) * 3, zero, columns, D.depth_of(rows, columns))
    assert (D.joint_walk(none, none, columns, False) == columns * D.price(zero[:, None], zero[None, :])).all()


def test_terms_of_long_texts_do_not_depend_on_pieces(monkeypatch):
    text = ("Über den Wolken 12 " * 500 + "x" * 300).encode()
    whole = [t for part in D.term_lists(text) for t in part]
    monkeypatch.setattr(D, "PIECE", 7)
    assert [t for part in D.term_lists(text) for t in part] == whole and len(whole) == 1501


# mixing

def brute_targets(sizes):
    """Shares by weight, limited sources set aside until none is above; ``sizes``: in source order."""
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sizes)}
    limited = set()
    while True:
        room = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in limited)
        others = sum(weight[s] for s in sizes if s not in limited)
        got = {s: 2 * sizes[s] if s in limited else room * weight[s] / others for s in sizes}
        above = {s for s in sizes if s not in limited and got[s] > 2 * sizes[s]}
        if not above:
            return got
        limited |= above


def test_mixing_matches_sql(spark):
    same_as_sql(spark, M.op12_mixing, M.SQL)


def test_targets_by_resharing(spark):
    rnd = random.Random(5)
    for _ in range(6):
        sizes = {f"s{k:02d}": rnd.choice([0, 1, 5, 80, 3000, 100_000]) for k in range(rnd.randrange(1, 12))} | {None: rnd.randrange(50)}
        if not sum(sizes.values()):
            continue
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r["source"]: r["target"] for r in M.targets(df).collect()}
        assert got == pytest.approx(brute_targets(sizes))


def test_draws_follow_the_hypergeometric_distribution(spark):
    for good, total, draws in ((7, 20, 10), (300, 1000, 500), (3, 5_000_000, 2_500_000), (50_000, 200_000, 100_000)):
        args = (F.lit(x).cast("long") for x in (good, total, draws))
        x = np.array([r[0] for r in spark.range(8000).select(M.hypergeometric(*args, F.col("id"))).collect()])
        want = np.random.default_rng(0).hypergeometric(good, total - good, draws, 8000)
        assert max(0, draws - total + good) <= x.min() and x.max() <= min(good, draws)
        edges = np.unique(np.quantile(want, np.linspace(0, 1, 9)))
        a, b = (np.searchsorted(edges, y, "right") for y in (x, want))
        both = np.array([np.bincount(y, minlength=len(edges) + 2) for y in (a, b)], float)
        chi = ((both[0] - both[1]) ** 2 / np.maximum(both.sum(axis=0), 1)).sum()
        assert chi < 40, (good, total, draws, chi)


def test_tree_keeps_quotas_and_room(spark):
    counts = [5000, 17, 0, 1, 901, 40_000]
    root = spark.createDataFrame([(counts,)], "counts array<long>")
    leaves = [r["counts"] for r in M.split_tree(root, 5).collect()]
    assert len(leaves) == 32 and np.sum(leaves, axis=0).tolist() == counts
    rooms = [sum(x) for x in leaves]
    assert max(rooms) - min(rooms) <= 5       # halves differ by one at most, level by level
    assert len({x[0] for x in leaves}) > 5    # drawn, not dealt evenly


def test_spans_of_a_mix(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 16)
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 300")
    docs_, spans = M.mix(docs, shard=64)
    info = {r["uid"]: r for r in docs_.collect()}
    rows = spans.collect()
    assert len({(r["uid"], r["pass"], r["first_word"]) for r in rows}) == len(rows)       # no block twice in a pass
    assert all(0 < r["words"] <= 16 and r["first_word"] + r["words"] <= info[r["uid"]]["size"] for r in rows)
    shards = Counter(r["shard"] for r in rows)
    assert len(shards) > 8 and max(shards.values()) <= 64 and max(shards.values()) - min(shards.values()) <= 8
    assert all(sorted(r["position"] for r in rows if r["shard"] == s) == list(range(n)) for s, n in shards.items())
    taken, targets = Counter(), {}
    per_doc = Counter()
    for r in rows:
        taken[info[r["uid"]]["source"]] += r["words"]
        per_doc[r["uid"]] += r["words"]
    for r in info.values():
        targets[r["source"]] = r["target"]
        assert per_doc[r["uid"]] <= 2 * r["size"]
    assert all(abs(taken[s] - t) <= 0.5 for s, t in targets.items())
    again = sorted(tuple(r) for r in M.mix(docs, shard=64)[1].drop("uid").collect())
    assert again == sorted(tuple(r) for r in spans.drop("uid").collect())


def test_mixing_of_odd_rows(spark, odd):
    docs, spans = M.mix(odd)
    rows = docs.collect()
    assert len(rows) == len(ODD)
    assert sorted(r["size"] for r in rows) == sorted(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _, _ in ODD)
    sizes = Counter()
    for _, t, s, _ in ODD:
        sizes[s] += len((t or "").split(" ")) if t and t.strip() else 0
    order = {s: r for s in sorted(x for x in {o[2] for o in ODD} if x is not None) for r in [0]} | {None: 0}
    assert {r["source"]: r["target"] for r in rows} == pytest.approx(brute_targets(
        {s: next(r["source_size"] for r in rows if r["source"] == s) for s in order}))
    words = spans.agg(F.sum("words")).first()[0]
    assert abs(words - sum({r["source"]: r["target"] for r in rows}.values())) <= 2
    none, no_spans = M.mix(odd.limit(0))
    assert none.count() == no_spans.count() == 0
    empty, no_spans = M.mix(odd.withColumn("text", F.lit(None).cast("string")))
    assert empty.filter("size = 0 and target = 0").count() == len(ODD) and no_spans.count() == 0


def test_mixing_has_no_python_node(spark):
    plan = M.mix(spark.read.parquet(f"{SF}/documents.parquet"))[1]._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# filter interaction

def brute_masks(docs, labels):
    """Counts per (part, mask, good, toxic) of (doc_id, text, source)."""
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    out = Counter()
    for i, t, s in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = (len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                 bool(re.search(r"[#$%&*|]", t)), i is not None and least[t] < i)
        good, toxic = labels.get(i, (0, 0))
        out[s or "", sum(1 << k for k, x in enumerate(fails) if x), good, toxic] += 1
    return dict(out)


def brute_report(counts):
    rows = []
    for part in {c[0] for c in counts}:
        mine = [(m, g, t, n) for (p, m, g, t), n in counts.items() if p == part]
        steps = []
        for order in map("".join, permutations("ABCDE")):
            gone = 0
            for k, letter in enumerate(order):
                bit = 1 << "ABCDE".index(letter)
                total = lambda test: sum(n for m, g, t, n in mine if test(m, g, t))
                steps.append((order, k + 1, letter, total(lambda m, *_: not m & (gone | bit)), total(lambda m, *_: m & bit and not m & gone),
                              total(lambda m, *_: m & bit and m & gone), total(lambda m, *_: m == bit),
                              total(lambda m, g, t: m & bit and not m & gone and g), total(lambda m, g, t: m & bit and not m & gone and t)))
                gone |= bit
        shapley = Counter()
        for s in steps:
            shapley[s[2]] += s[4]
        rows += [(part, s[0], s[1], *s[3:], shapley[s[2]]) for s in steps]
    return sorted(rows)


def written(spark, docs, path, files):
    """``docs`` as a table of as many files, read by time in the given order."""
    per = -(-len(docs) // files)
    for k in range(files):
        (spark.createDataFrame(docs[k * per:(k + 1) * per], "doc_id long, text string, source string").coalesce(1)
              .withColumn("mask", F.lit("clash")).write.mode("append").parquet(path))
    return path


def test_filter_audit_matches_sql(spark):
    same_as_sql(spark, A.op13_filter_audit, A.SQL)


@pytest.mark.parametrize("order", ["down", "up", "mixed"])
def test_masks_are_retracted_when_smaller_ids_come(spark, tmp_path, monkeypatch, order):
    monkeypatch.setattr(A, "TEXTS", 16)
    rnd = random.Random(2)
    texts = [" ".join(rnd.choice(["a", "b", "C", "d#", "w%d" % rnd.randrange(200)]) for _ in range(rnd.choice([3, 60, 80])))
             for _ in range(40)] + [None, ""]
    docs = [(i, texts[0] if i % 3 == 0 else rnd.choice(texts), rnd.choice(["s1", "s2", None])) for i in range(400)]
    docs += [(17, docs[17][1], "s2"), (17, docs[17][1], "s1"), (None, texts[0], "s1")]
    docs.sort(key=lambda d: (d[0] is None, d[0] or 0), reverse=order == "down")
    if order == "mixed":
        rnd.shuffle(docs)
    labels = {i: (rnd.randrange(2), rnd.randrange(2)) for i in range(0, 400, 3)}
    marks = spark.createDataFrame([(i, *x) for i, x in labels.items()], "doc_id long, quality int, toxic int")
    counts = A.mask_counts(spark, written(spark, docs, str(tmp_path / "documents.parquet"), 6), marks, batches=6)
    got = {tuple(r)[:4]: r["n"] for r in counts.collect()}
    assert got == brute_masks(docs, labels)
    assert sorted(tuple(r) for r in A.report(counts).collect()) == brute_report(got)


def test_filter_audit_of_odd_rows(spark, odd, tmp_path):
    path = str(tmp_path / "documents.parquet")
    odd.write.parquet(path)
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 1), (None, 1, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    counts = A.mask_counts(spark, path, labels)
    got = {tuple(r)[:4]: r["n"] for r in counts.collect()}
    assert got == brute_masks([(i, t, s) for i, t, s, _ in ODD], {4: (1, 1)})
    odd.limit(0).write.parquet(str(tmp_path / "empty.parquet"))
    assert A.report(A.mask_counts(spark, str(tmp_path / "empty.parquet"), labels)).count() == 0


def test_masks_of_long_texts_do_not_depend_on_pieces(monkeypatch):
    rnd = random.Random(8)
    texts = ["".join(rnd.choice("aB \n\té") for _ in range(rnd.randrange(400))).encode() for _ in range(60)] + [b"", b" ", b"x" * 50]
    whole = [A.own_mask(t) for t in texts]
    for piece in (1, 3, 64):
        monkeypatch.setattr(A, "PIECE", piece)
        assert [A.own_mask(t) for t in texts] == whole
    want = [m for t in texts for (_, m, _, _), n in brute_masks([(1, t.decode(), "")], {}).items()]
    assert whole == want
