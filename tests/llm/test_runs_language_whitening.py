from __future__ import annotations

import random
import re
import zlib
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattlake.llm import language, registry, runs, whitening

# Periodic runs


def every_run(words, least, periods):
    """Brute force: each maximal stretch of equal words at distance q, unless a shorter one fits."""
    n, out = len(words), []
    for q in range(1, n // periods + 1):
        same = [words[k] == words[k + q] for k in range(n - q)] + [False]
        begin = None
        for k, flag in enumerate(same):
            if flag and begin is None:
                begin = k
            if not flag and begin is not None:
                length = k - begin + q
                part = words[begin : begin + length]
                shorter = any(part[p:] == part[:-p] for p in range(1, q))
                if length >= max(least, periods * q) and not shorter:
                    out.append((begin, length, q))
                begin = None
    return sorted(out)


def mixed_words(rng):
    words = [rng.choice("abc"[: rng.randint(1, 3)]) for _ in range(rng.randint(0, 40))]
    for _ in range(rng.randint(0, 3)):
        root = [rng.choice("abcd") for _ in range(rng.randint(1, 7))]
        at = rng.randint(0, len(words))
        words[at:at] = (root * rng.randint(2, 9))[rng.randint(0, 3) :]
    return words


@pytest.mark.parametrize("least, periods", [(6, 4), (2, 2), (3, 3)])
def test_runs_equal_brute_force(least, periods):
    rng = random.Random(5)
    for _ in range(700):
        words = mixed_words(rng)
        found = runs.runs_of_words(words, least, periods)
        assert [tuple(r) for r in found.tolist()] == every_run(words, least, periods), words


def test_tree_ranks_and_extensions():
    rng = random.Random(6)
    for _ in range(200):
        text = [rng.randrange(rng.randint(1, 4)) for _ in range(rng.randint(2, 30))]
        tree, n = runs.SuffixTree(text), len(text)
        for rank, sign in ((tree.rank, 1), (tree.reverse_rank, -1)):
            order = sorted(range(n), key=lambda i: [sign * s for s in text[i:]])
            assert [i for i in np.argsort(rank) if i < n] == order
        pairs = [(i, j) for i in range(n) for j in range(n) if i != j]
        for (i, j), found in zip(pairs, tree.lce(*np.array(pairs).reshape(-1, 2).T).tolist()):
            length = 0
            while max(i, j) + length < n and text[i + length] == text[j + length]:
                length += 1
            assert found == length


def test_runs_of_rows(spark):
    long = ["x"] * 3 + ["a", "b", "c"] * 20000 + ["y"]
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a a a a a"), (5, "A a A a A a A a"), (5, "A a A a A a A a")]
    rows += [(None, "z z z z z z  z"), (7, " ".join(long)), (8, "ä " * 6 + "b c " * 4)]
    docs = spark.createDataFrame([(*r, 0, "k") for r in rows], "doc_id long, text string, runs int, words string")
    found = runs.find_runs(docs).collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == len(rows)
    for i in (1, 2, 3):
        assert (by_id[i].n_words, by_id[i].runs, by_id[i].collapsed) == (0, [], "")
    assert by_id[4].runs == [] and by_id[4].collapsed == "a a a a a"
    assert [tuple(r) for r in by_id[5].runs] == [(0, 8, 2)] and by_id[5].collapsed == "A a"
    # A no-break space is no ASCII white space.
    assert by_id[None].runs == [] and by_id[None].n_words == 7
    assert [tuple(r) for r in by_id[7].runs] == [(3, 60000, 3)] and by_id[7].collapsed == "x x x a b c y"
    assert [tuple(r) for r in by_id[8].runs] == [(0, 6, 1), (6, 8, 2)] and by_id[8].collapsed == "ä b c"
    digest = {r.doc_id: r for r in runs.digest(runs.find_runs(docs)).collect()}
    assert (digest[8].start, digest[8].length, digest[8].period, digest[8].exponent_milli) == (6, 8, 2, 4000)
    assert digest[1].start is None and digest[1].runs_sha256 == digest[2].collapsed_sha256
    assert runs.find_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        runs.find_runs(docs, periods=1)


def test_runs_query_equals_brute_force(spark, sf_dir):
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = {r.doc_id: r for r in registry.QUERIES["op12_periodic_runs"](spark, sf_dir).collect()}
    assert len(found) == len(texts)


    for r in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and n:
            a = (h // 10) % n
            p = 1 + (n - a) // (3 + (h // 10) % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        # Only distances at which some word recurs four times over can be periods.
        own = every_run(words, 6, 4) if n < 800 else [tuple(x) for x in runs.runs_of_words(words).tolist()]
        dropped = {i for s, m, q in own for i in range(s + q, s + m)}
        kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in own)
        row = found[r.doc_id]
        assert row.n_runs == len(own)
        assert row.runs_sha256 == sha256(lines.encode()).hexdigest()
        assert row.collapsed_sha256 == sha256(kept.encode()).hexdigest()
        best = min(own, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
        assert (row.start, row.length, row.period) == best


# Language


def test_language_query_on_held_out_documents(spark, sf_dir):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = registry.QUERIES["op13_language_id"](spark, sf_dir).collect()
    assert len(found) == len(langs)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    out = [r for r in found if r.held_out]
    right = sum(r.lang_pred == langs[r.doc_id] for r in out)
    assert len(out) > 30 and right >= 0.98 * len(out)


def test_language_of_unseen_words_and_odd_rows(spark):
    rng = random.Random(7)
    parts = {"aa": ["ka", "to", "mi", "nu"], "bb": ["stra", "elk", "und", "ger"]}
    word = lambda kind: "".join(rng.choice(parts[kind]) for _ in range(rng.randint(1, 4)))
    rows = [(i, " ".join(word(kind) for _ in range(60)), kind) for i, kind in enumerate(["aa", "bb"] * 60)]
    # Rows that are not learnt from: without text or language, and one that teaches the wrong thing.
    rows += [(1000, None, "aa"), (1001, "kato kato", None), (1002, "mi nu " * 999, "zz")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, lang string, entry int, n int")
    asked = [(1, "KATOMINU, tonumika!"), (2, "straundgerelk"), (3, None), (4, ""), (5, "12 % _ 3"), (6, "漢字")]
    asked += [(None, "kato"), (1, "KATOMINU, tonumika!"), (9, "straelk" * 50_000)]
    seen = docs.where("lang = 'aa' OR lang = 'bb' OR lang IS NULL")
    both = seen.select("doc_id", "text", "lang", F.lit(True).alias("learn")).union(
        spark.createDataFrame([(*r, None, False) for r in asked], "doc_id long, text string, lang string, learn boolean")
    )
    found = language.identify(spark, both, F.col("learn")).collect()
    assert len(found) == both.count()
    answers = [(r.doc_id, r.lang_pred) for r in found[-len(asked) :]]
    assert sorted(answers, key=str) == sorted(
        [(1, "aa"), (2, "bb"), (3, "und"), (4, "und"), (5, "und"), (6, "aa"), (None, "aa"), (1, "aa"), (9, "bb")], key=str
    )
    # The id, the source or the language of a row never matter to its own prediction.
    assert not any(r.lang_pred == "zz" for r in found)
    nothing = language.identify(spark, docs, F.lit(False)).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}
    assert language.identify(spark, docs.limit(0), F.lit(True)).count() == 0


def test_scores_do_not_depend_on_what_a_worker_keeps(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language.fit(spark, docs.where("doc_id % 2 = 0"), most_words=400, most_grams=4000)
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    want = [model.predict([t])[0] for t in texts]
    monkeypatch.setattr(language, "CACHED", 50)
    model._all, model._rows = None, {}
    found = [p for i in range(0, len(texts), 7) for p in model.predict(texts[i : i + 7])]
    assert [f[0] for f in found] == [w[0] for w in want]
    assert all(abs(f[1] - w[1]) < 1e-9 for f, w in zip(found, want))


def test_language_counts_equal_plain_counts(spark, monkeypatch):
    monkeypatch.setattr(language, "FLUSH", 3)
    docs = spark.createDataFrame([("a b a", "x"), ("A b1c_d", "x"), ("b", "y")] * 3, "text string, language string")
    words = {(r.entry, r.language): r.n for r in language._counted(docs, language._words, ["text", "language"]).collect()}
    assert words == {("a", "x"): 9, ("b", "x"): 6, ("c", "x"): 3, ("d", "x"): 3, ("b", "y"): 3}
    common = lambda most: {r.entry for r in language._common(spark.createDataFrame(
        [(*k, v) for k, v in words.items()], "entry string, language string, n long"), most).collect()}
    # a and b have 9 each, c and d 3 each; entries of one total stay or go together.
    assert common(4) == {"a", "b", "c", "d"} and common(3) == {"a", "b"} and common(1) == {"a"}


# Whitening


def symmetric(rng, n, kind):
    a = rng.standard_normal((n, n))
    q = np.linalg.qr(a)[0]
    values = {
        "plain": np.linalg.eigvalsh(a @ a.T),
        "equal": np.full(n, 3.0),
        "clusters": np.repeat([5.0, 1.0], [min(3, n), max(0, n - 3)]),
        "rank two": np.r_[2.0, 1.0, np.zeros(n)][:n],
        "zero": np.zeros(n),
        "steep": 10.0 ** -np.arange(n),
        "close": 1 + 1e-9 * np.arange(n),
    }[kind]
    v = q @ np.diag(values) @ q.T
    return (v + v.T) / 2


@pytest.mark.parametrize("kind", ["plain", "equal", "clusters", "rank two", "zero", "steep", "close"])
def test_spectrum_slices_equal_all_eigenvalues(kind):
    rng = np.random.default_rng(8)
    for n in (1, 2, 3, 7, 40):
        v = symmetric(rng, n, kind)
        want, norm = np.linalg.eigvalsh(v), max(1, np.abs(v).max())
        for shift in rng.uniform(want[0] - 1, want[-1] + 1, 8):
            assert whitening.inertia(v - shift * np.eye(n)) == ((want > shift).sum(), (want < shift).sum())
        values, vectors = whitening.leading(v, 4)
        k = min(4, n)
        assert np.allclose(values, want[::-1][:k], rtol=0, atol=1e-13 * n * norm)
        assert np.allclose(vectors.T @ vectors, np.eye(k), atol=1e-12)
        assert np.allclose(v @ vectors, vectors * values, rtol=0, atol=1e-12 * n * norm)


def whitened_by_hand(vectors, k=4):
    x = np.floor(256 * np.array(vectors, float)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    mean = fit.astype(float).mean(axis=0)
    away = fit - mean
    values, basis = np.linalg.eigh(away.T @ away / n)
    values, basis = values[::-1][:k], basis[:, ::-1][:, :k]
    return n, ((n * x - total) ** 2).sum(axis=1), (x - mean) @ basis / np.sqrt(values), values / np.trace(away.T @ away / n)


def test_whitening_query_equals_eigh(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    n, deviation, z, share = whitened_by_hand([r.embedding for r in rows])
    found = registry.QUERIES["op11_spectrum_whitening"](spark, sf_dir).orderBy("vec_id", "component").toPandas()
    assert len(found) == 4 * len(rows) and (found.n == n).all()
    assert (found.deviation.to_numpy().reshape(-1, 4) == deviation[:, None]).all()
    mine = found.whitened.to_numpy().reshape(-1, 4)
    assert np.allclose(mine * np.sign((mine * z).sum(axis=0)), z, atol=1e-9)
    assert np.allclose(found.explained.to_numpy().reshape(-1, 4), share, rtol=1e-9)
    assert found.identity_error.nunique() == 1 and found.identity_error[0] < 1e-9


def test_whitening_of_odd_rows(spark):
    rng = random.Random(9)
    good = [[rng.gauss(0, 1 + d) for d in range(6)] for _ in range(60)]
    good += good[:20] * 3 + [[v + 0.001 if d == 0 else v for d, v in enumerate(good[0])]]
    bad = [None, [], [1.0, None, 0.0, 0.0, 0.0, 0.0], [float("nan")] * 6, [float("inf")] * 6, [1e300] * 6, [1.0, 2.0]]
    rows = [(i, v, 1, 2) for i, v in enumerate(good + bad)] + [(None, good[3], 1, 2), (0, good[0], 1, 2)]
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int, x int").repartition(5)
    found = whitening.whiten(spark, table).collect()
    assert len(found) == 4 * (len(good) + 2)
    n, deviation, z, share = whitened_by_hand(good)
    signs = np.sign(sum(r.whitened * z[r.vec_id][r.component - 1] * (np.arange(1, 5) == r.component) for r in found if r.vec_id is not None))
    for r in found:
        i = 3 if r.vec_id is None else r.vec_id
        assert r.n == n and r.deviation == deviation[i] and abs(r.explained / share[r.component - 1] - 1) < 1e-9
        assert abs(r.whitened * signs[r.component - 1] - z[i][r.component - 1]) < 1e-9
    assert whitening.whiten(spark, table.limit(0)).count() == 0
    assert whitening.whiten(spark, table.where("embedding IS NULL OR size(embedding) = 0")).count() == 0


def test_whitening_without_variance_and_with_large_entries(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(3)], "vec_id int, embedding array<float>")
    found = whitening.whiten(spark, same).collect()
    assert len(found) == 6
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in found} == {(1, 0, None, None, None)}
    rng = random.Random(10)
    # Entries near the end of the range of a long: sums and moments leave it, deviations do not fit.
    large = [[rng.uniform(-3e16, 3e16) for _ in range(3)] for _ in range(40)]
    found = whitening.whiten(spark, spark.createDataFrame(list(enumerate(large)), "vec_id long, embedding array<double>")).collect()
    assert len(found) == 120 and {r.deviation for r in found} == {None} and found[0].identity_error < 1e-6
    n, _, z, share = whitened_by_hand(large, 3)
    assert n == 40 and all(abs(abs(r.whitened) - abs(z[r.vec_id][r.component - 1])) < 1e-6 for r in found)
    # Deviations are exact where they fit: by fractions.
    few = [[2.0**40 + i, 0.5 * i] for i in range(5)]
    found = whitening.whiten(spark, spark.createDataFrame(list(enumerate(few)), "vec_id long, embedding array<double>")).collect()
    x = [[int(256 * Fraction(c) // 1) for c in v] for v in few]
    total = [sum(c) for c in zip(*x)]
    assert all(r.deviation == sum((5 * c - s) ** 2 for c, s in zip(x[r.vec_id], total)) for r in found)
