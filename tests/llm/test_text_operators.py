from __future__ import annotations

import math
import random
import re
import textwrap
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wattlake.llm import (
    decontaminate,
    importance,
    jaccard_join,
    licences,
    line_quality,
    pii,
    suffix_tree,
)

WORD = r"[^\x20\x09-\x0D]+"


def low(text):
    return "".join(c.lower() if c < "\x80" else c for c in text or "")


def docs_of(spark, rows, more="doc_id2 int"):
    return spark.createDataFrame([(*r, 1) for r in rows], f"doc_id long, text string, {more}").repartition(4)


# Jaccard join


def _components(rows):
    sets = {}
    for i, text in rows:
        w = re.findall(WORD, low(text))
        sets[i] = set(zip(w, w[1:], w[2:])) if len(w) > 2 else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 90 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


def test_jaccard_join_equals_brute_force(spark):
    rng = random.Random(3)
    rows = [(1, None), (2, ""), (3, "a"), (4, "A"), (5, "a b"), (6, "b a"), (7, "x y z"), (8, " x  y\nZ ")]
    for _ in range(40):
        words = [f"{rng.choice('abcdefgh')}{rng.randint(0, 60)}" for _ in range(rng.choice([5, 11, 20, 40, 150]))]
        for _ in range(rng.randint(1, 9)):
            own = list(words)
            for _ in range(rng.randint(0, 1 + len(words) // 30)):
                own[rng.randrange(len(own))] = f"q{rng.randint(0, 99)}"
            rows.append((len(rows) + 1, " ".join(own)))
            if rng.random() < 0.3:
                words = own
    found = jaccard_join.near_duplicates(spark, docs_of(spark, rows, "node int")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == _components(rows)
    assert jaccard_join.near_duplicates(spark, docs_of(spark, rows).limit(0)).count() == 0


def test_jaccard_join_indexes_no_copies_and_no_unlinked_sets(spark, monkeypatch):
    rng = random.Random(9)
    text = lambda: " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(200))
    alone = [text() for _ in range(60)]
    near = [t + " and more" for t in alone[:3]]
    rows = [(i, t) for i, t in enumerate([*alone, *near, *alone, *alone])]
    stored, store = [], jaccard_join._Store.__call__
    monkeypatch.setattr(jaccard_join._Store, "__call__", lambda *a: stored.append(store(*a)) or stored[-1])
    docs = docs_of(spark, rows).repartition(6, "doc_id")
    found = jaccard_join.near_duplicates(spark, docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == _components(rows)
    # Keys of copies and of texts without a near copy are not written: three pairs' are, of 36,000 shingles.
    assert max(s.count() for s in stored) < 12 * 200


def test_prefixes_of_linked_sets_meet():
    rng = np.random.default_rng(8)
    for percent in (10, 50, 80, 90, 100):
        for _ in range(300):
            both, a, b = rng.integers(1, 60), rng.integers(0, 30), rng.integers(0, 30)
            if 100 * both < percent * (both + a + b):
                continue
            order = rng.permutation(both + a + b)
            x, y = np.sort(order[: both + a]), np.sort(np.concatenate([order[:both], order[both + a :]]))
            (m, n), least = jaccard_join.prefixes(np.array([len(x), len(y)]), percent)
            assert len(np.intersect1d(x[:m], y[:n])) >= max(least)


def test_jaccard_join_of_a_large_group_of_far_variants(spark):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        own = list(base)
        for _ in range(rng.randint(0, 14)):
            own[rng.randrange(len(own))] = f"e{rng.randint(0, 400)}"
        rows.append((i, " ".join(own)))
    found = jaccard_join.near_duplicates(spark, docs_of(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == _components(rows)


def test_blocks_of_an_open_group_stay_bounded(spark, values, monkeypatch):
    sizes = [1, 64, 65, 2560, 80_000, 1_000_000, 10**8]
    found = values(jaccard_join.blocks_of(F.col("n")), "n long", *sizes)
    assert found[:4] == [1, 1, 2, 40] and all(n <= 2048 * b for n, b in zip(sizes, found, strict=True))
    # With more blocks than MOST_BLOCKS the pairs are those of one block.
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 60).astype(np.uint64)
    own = [np.concatenate([base[: 60 - k % 5], rng.integers(0, 2**63, k % 4).astype(np.uint64)]) for k in range(60)]
    rows = [(1, k, f"p{k}", len(o), bytearray(jaccard_join.sketch(o).tobytes()), 60) for k, o in enumerate(own)]
    nodes = spark.createDataFrame(rows, "pivot long, node long, part string, size long, sketch binary, n long")
    pairs = lambda: {tuple(r) for r in jaccard_join._near_in_blocks(nodes, 90).collect()}
    one = pairs()
    monkeypatch.setattr(jaccard_join, "MOST_BLOCKS", 2)
    monkeypatch.setattr(jaccard_join, "MOST_NODES", 8)
    assert pairs() == one and len(one) > 100


def test_allocations_cover_every_difference():
    for low_size, high in jaccard_join.band_limits(5000):
        for sets in (1, 10**5, 10**9):
            band = jaccard_join.allocate(low_size, high, sets, 90)
            assert band.exact + 2 * band.deletion > jaccard_join.most_apart(90, 2 * high)


def test_sketches_never_exceed_the_difference():
    rng = np.random.default_rng(1)
    for _ in range(100):
        a = rng.integers(0, 2**63, rng.integers(1, 900)).astype(np.uint64)
        b = np.concatenate([a[: rng.integers(0, len(a) + 1)], rng.integers(0, 2**63, 20).astype(np.uint64)])
        x, y = jaccard_join.sketch(a), jaccard_join.sketch(b)
        n = min(len(x), len(y))
        bits = np.bitwise_count(jaccard_join.fold(x, n) ^ jaccard_join.fold(y, n)).sum()
        assert bits <= len(np.setxor1d(a, b))


# Quality rules


def test_quality_figures_equal_brute_force():
    rng = random.Random(2)
    texts = ["", " ", "\n\n", "a a a a", "a\na\n a\na", "#é|\n  x\n  x"]
    texts += ["".join(rng.choice("ab \n#é") for _ in range(rng.randint(0, 60))) for _ in range(500)]
    found, _ = line_quality.figures([t.encode() for t in texts])
    for i, text in enumerate(texts):
        w = re.findall(WORD, text)
        lines = [x for x in text.split("\n") if re.search(WORD, x)]
        windows = Counter(zip(w, w[1:], w[2:]))
        often = {k + j for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for j in range(3)}
        wanted = (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(often),
        )
        assert tuple(int(found[c][i]) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == wanted


def test_depleted_documents_are_rejected_and_others_kept(spark):
    common = " ".join(f"Common{i}" for i in range(60))
    rows = [(i, f"{common}\nown {i}", "h") for i in range(30)]
    rows += [(100 + i, f"{common}\n" + " ".join(f"own{i}x{k}" for k in range(60)), "h") for i in range(30)]
    rows += [(200, common, "other"), (201, common.upper(), None), (202, None, "h"), (203, "", "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id: r.kept for r in line_quality.judge(spark, docs).collect()}
    # The line stays whole in the text of the least id.
    assert kept[0] and not any(kept[i] for i in range(1, 30)) and all(kept[100 + i] for i in range(30))
    assert kept[200] and kept[201] and not kept[202] and not kept[203]
    assert line_quality.judge(spark, docs.limit(0)).count() == 0


def test_boilerplate_goes_in_hosts_of_any_size(spark):
    words = lambda name, n: " ".join(f"{name}x{k}" for k in range(n))
    rows = []
    for host, size, planted in (("hot", 600, 40), ("small", 8, 6)):
        plate = words(f"plate{host}", 60)
        for i in range(size):
            text = f"{plate}\nown {host} {i}" if i < planted else words(f"{host}{i}", 60)
            rows.append((len(rows), text, host))
    # Copies count once, and one of a group of near copies is left whole.
    rows += [(1000 + i, words("copy", 60), "small") for i in range(30)]
    copy = "\n".join(words(f"copied{k}", 30) for k in range(4))
    rows += [(1100 + i, copy, "small") for i in range(30)]
    # Half of its words are left, but too few.
    rows += [(1200 + i, f"{words('foot', 25)}\n{words(f'short{i}', 40)}", "small") for i in range(5)]
    rows += [(2000 + i, f"{words('near', 60)}\nmark {i}", "small") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    found = line_quality.judge(spark, docs)
    gone = {r.doc_id for r in found.where("NOT kept").collect()}
    assert gone == {*range(1, 40), *range(601, 606), *range(1201, 1205), *range(2001, 2030)}
    stage = corpus_pipeline.quality_rules(spark, docs, "")
    assert {r.doc_id for r in stage.collect()} == {r[0] for r in rows} - gone


# Decontamination and licences


def test_decontamination(spark):
    words = [f"w{i}" for i in range(30)]
    items = spark.createDataFrame(
        [("a", " ".join(words[:12])), ("b", "Short, item"), ("c", None), ("d", "--"), ("a2", " ".join(words[2:12]))],
        "item_id string, text string",
    )
    rows = [
        (1, "x " + " ".join(words[:12]).upper() + " y"), (2, " ".join(words[:9])), (3, "a short ITEM and short item"),
        (4, None), (5, ""), (6, " ".join(words[2:12]) + " " + " ".join(words[2:12])), (7, "short"),
    ]
    found = {r.doc_id: r for r in decontaminate.decontaminate(docs_of(spark, rows, "n int"), items).collect()}
    assert (found[1].n_words, found[1].n_hit, found[1]["items"]) == (14, 12, ["a", "a2"])
    assert (found[2].n_hit, found[2].contaminated) == (0, False)
    assert (found[3].n_hit, found[3]["items"]) == (4, ["b"])
    assert (found[4].n_words, found[5].n_words, found[7].n_hit) == (0, 0, 0)
    assert found[6].n_hit == 20
    none = decontaminate.decontaminate(docs_of(spark, rows), items.limit(0)).collect()
    assert len(none) == 7 and not any(r.contaminated for r in none)
    assert decontaminate.decontaminate(docs_of(spark, rows).limit(0), items).count() == 0


def test_decontamination_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 3)
    words = [f"w{i}" for i in range(30)]
    items = spark.createDataFrame([("a", " ".join(words))], "item_id string, text string")
    found = decontaminate.decontaminate(docs_of(spark, [(1, "x " + " ".join(words)), (2, "x")]), items)
    assert sorted((r.doc_id, r.n_words, r.n_hit) for r in found.collect()) == [(1, 31, 30), (2, 1, 0)]


def test_native_plans_hold_no_python(spark):
    docs, items = docs_of(spark, [(1, "a b")]), spark.createDataFrame([("a", "a")], "item_id string, text string")
    for frame in (decontaminate.decontaminate(docs, items), licences.scan(spark, docs)):
        plan = frame._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|MapInArrow", plan)


def test_licence_scan(spark):
    rows = [
        (1, "text\nReleased under the  MIT license\nmore"), (2, "All rights reserved."), (3, None), (4, ""),
        (5, "Nothing of that kind is said here."), (6, "word\n" + licences.TEMPLATES[4][1]),
        (7, "Licensed under CC BY-NC 4.0.\nLicensed under CC BY-NC 4.0."),
    ]
    found = {r.doc_id: r for r in licences.scan(spark, docs_of(spark, rows, "unit int")).collect()}
    assert [found[i].licences for i in (1, 2, 3, 4, 5, 6)] == ["MIT", "proprietary", "", "", "", "MIT"]
    assert "CC-BY-NC-4.0" in found[7].licences and found[7].best_dice == 1.0
    assert licences.scan(spark, docs_of(spark, rows).limit(0)).count() == 0


def test_licences_wrapped_inside_lines_and_in_full(spark):
    wrap = lambda t: textwrap.fill(" ".join(t.split()), 78)
    bodies = dict(licences.BODIES)
    prose = " ".join(f"prose{i}" for i in range(300))
    rows = [
        (1, "MIT License\n\nCopyright (c) 2024 A. Person\n\n" + wrap(bodies["MIT"])),
        (2, "Some words before. All rights reserved. More words behind."), (3, wrap(licences.TEMPLATES[8][1])),
        (4, f"{prose}\n{wrap(licences.TEMPLATES[6][1])}\n{prose}"), (5, prose + wrap(bodies["GPL-3.0"]) + prose),
        (6, wrap(bodies["BSD-3-Clause"]).replace("copyright holder", "Some Company")), (7, prose),
        (8, "rights reserved"), (9, "Permission is hereby granted, free of charge, to nobody at all."),
    ]
    found = {r.doc_id: r for r in licences.scan(spark, docs_of(spark, rows, "unit int")).collect()}
    assert {"MIT"} == {*found[1].licences.split(",")} and found[1].best_dice == 1.0
    assert [found[i].licences for i in (2, 3, 4, 7, 9)] == ["proprietary", "GPL-3.0", "BSD-3-Clause", "", ""]
    assert "GPL-3.0" in found[5].licences and "BSD-3-Clause" in found[6].licences
    assert found[2].n_units == 1 and found[7].n_units == 0


# Personal data


def _brute(text):
    def luhn(digits):
        return sum((2 * int(c) - 9 * (c > "4")) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10 == 0

    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for kind, pattern, least, most in ((2, r"[0-9]([\x20-]?[0-9])+", 16, 19), (3, r"\+[0-9][\x20().0-9-]+[0-9]", 8, 15)):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if least <= len(digits) <= most and (kind == 3 or luhn(digits)):
                out.append((kind, *m.span()))
    return out


def test_base_spans_equal_the_patterns():
    rng = random.Random(2)
    texts = ["a@b.c@d.e", "x 4111111111111111 y", "4111 1111 1111 1111", "1.2.3.4.5.6.7.8", "256.1.1.1", "+49 (30) 123-456 7"]
    texts += ["".join(rng.choice("ab1.@+-% ()é2_") for _ in range(rng.randint(0, 25))) for _ in range(8000)]
    for text in texts:
        assert pii.base_spans(text) == _brute(text)


@pytest.fixture(scope="module")
def snippets():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    makers = (
        lambda: f"{word()}.{rng.randint(1, 99)}@mail{rng.randint(0, 9)}.example.com",
        lambda: ".".join(str(rng.randint(1, 255)) for _ in range(4)),
        lambda: rng.choice(["4111111111111111", "5500005555555559", "4012888888881881"]),
        lambda: f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}",
    )
    texts = [" ".join([*(word() for _ in range(9)), makers[i % 4](), *(word() for _ in range(9))]) for i in range(240)]
    return [(t, pii.base_spans(t)) for t in texts + [" ".join(word() for _ in range(20)) for _ in range(60)]]


def test_the_model_finds_held_out_spans_and_what_patterns_merge(spark, snippets):
    model = pii.train([s for i, s in enumerate(snippets) if i % 5])
    held = snippets[::5]
    found = pii.Decoder(model).spans([t for t, _ in held])
    wanted = {(i, s) for i, (_, own) in enumerate(held) for s in own}
    got = {(i, s) for i, own in enumerate(found) for s in own}
    assert len(wanted & got) >= 0.9 * len(wanted)
    merged = "abcdef +1 (269) 555-3296 4111111111111111 ghijk"
    far = "abc def " * 400 + merged
    rows = [(1, merged), (2, far), (3, None), (4, ""), (5, "no data")]
    spans = {r.doc_id: r for r in pii.find(spark, docs_of(spark, rows, "base int"), model).collect()}
    kinds = lambda r: {s["kind"] for s in r.spans}
    assert not any(s["kind"] == "phone" for s in spans[1].base)
    assert kinds(spans[1]) & {"card", "phone"} and kinds(spans[2]) == kinds(spans[1])
    assert spans[3].spans == spans[4].spans == spans[5].spans == []
    masked = pii.find(spark, spark.createDataFrame([(1, "to a@b.cd now", 13), (2, None, None)], "doc_id long, text string, n_chars long"), model, masked=("doc_id", "text", "n_chars"))
    assert sorted(map(tuple, masked.collect())) == [(1, "to <email> now", 14), (2, None, None)]


def test_windows_and_gradients():
    model = pii.new_model(1)
    for name in ("table", "recur", "tag"):
        setattr(model, name, [a.astype(float) for a in getattr(model, name)])
    model.bias, model.trans = model.bias.astype(float), model.trans.astype(float)
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, pii._CLASSES, (6, 3)), np.zeros((6, 3), int)
    y[1:3, 0] = 2
    _, gradients = pii._loss_and_gradients(model, x, y)
    for a, g in zip(model.arrays(), gradients, strict=True):
        at = (0, 2) if a.shape == (pii.TAGS, pii.TAGS) else tuple(rng.integers(0, n) for n in a.shape)
        old, step = a[at], 1e-5
        a[at] = old + step
        up = pii._loss_and_gradients(model, x, y)[0]
        a[at] = old - step
        down = pii._loss_and_gradients(model, x, y)[0]
        a[at] = old
        assert abs((up - down) / (2 * step) - g[at]) < 1e-3
    assert pii.reconcile({(0, 1, 9), (0, 2, 5), (1, 2, 5), (0, 9, 12)}) == [(0, 1, 9), (0, 9, 12), (1, 2, 5)]


# Suffix tree


def _tree_scores(tokens, held, settings):
    """Gains over the root by the definition, with contexts as tuples of words."""
    texts = [tokens[i] for i in tokens if not held[i]]
    total = sum(map(len, texts))
    kinds = len({w for t in texts for w in t})
    words = Counter(w for t in texts for w in t)
    own = {((), w): n / total for w, n in words.items()}
    q = {((), w): (n + 1) / (total + kinds + 1) for w, n in words.items()}
    root, less, levels = dict(q), {}, 0
    candidates = {(w,): n for w, n in words.items() if w and n >= settings.least_context}
    while candidates:
        levels += 1
        found = Counter((tuple(t[i - levels : i]), t[i]) for t in texts for i in range(levels, len(t)))
        grown = {}
        for c, n in candidates.items():
            after = {w: m for (d, w), m in found.items() if d == c and m >= settings.least_pair}
            after = {w: m for w, m in after.items() if (c[1:], w) in own}
            if not after:
                continue
            g = sum(2 * m * math.log(m / n / own[c[1:], w]) for w, m in after.items())
            rest, t = n - sum(after.values()), len(after)
            if rest:
                g += 2 * rest * math.log(rest / n / max(1 - sum(own[c[1:], w] for w in after), 1e-12))
            if g < t + 3.1 * math.sqrt(2 * t) + 6:
                continue
            less[c] = (rest + t) / (n + t)
            for w, m in after.items():
                own[c, w], q[c, w] = m / n, m / (n + t) + less[c] * q[c[1:], w]
                if w and m >= settings.least_context:
                    grown[(*c, w)] = m
        candidates = {c: n for c, n in grown.items() if c[1:] in less}

    def gain(text):
        out = 0.0
        for i, w in enumerate(text):
            value, k = 0.0, 1
            while k <= i and tuple(text[i - k : i]) in less:
                c = tuple(text[i - k : i])
                value = math.log10(q[c, w] / root[(), w]) if (c, w) in q else value + math.log10(less[c])
                k += 1
            out += value
        return out

    return {i: gain(t) for i, t in tokens.items()}, less


def test_base_scores_and_tree_equal_brute_force(spark):
    rng = random.Random(9)
    words = ["the", "An", "of", "é", "x1", "thin", "there"]
    phrases = ["the end of An x1", "of An thin", "é é there the of", *words]
    rows = [(i, " ".join(rng.choice(phrases) for _ in range(rng.randint(0, 60)))) for i in range(80)]
    rows += [(500, None), (501, "rare the end of An rarer"), (502, "the " * 3000)]
    docs = docs_of(spark, rows, "score int")
    settings = suffix_tree.Settings(least_context=6, least_pair=2)
    found = {r.doc_id: r for r in suffix_tree.score(spark, docs, settings=settings).collect()}
    tokens = {i: [*re.findall(WORD, low(t)), None] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    counts = Counter(w for i in tokens if not held[i] for w in tokens[i])
    total = sum(counts.values())
    gains, less = _tree_scores(tokens, held, settings)
    assert max(map(len, less)) >= 3
    for i, own in tokens.items():
        base = sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in own)
        r = found[i]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[i], len(own), total)
        assert r.n_known == sum(counts[w] > 0 for w in own)
        assert abs(r.base_score - base) < 1e-6
        assert abs(r.score - base - gains[i]) < 1e-4 * len(own) + 1e-6
    held_ids = [i for i in held if held[i]]
    assert sum(found[i].score for i in held_ids) > sum(found[i].base_score for i in held_ids)
    # With few keys in the tasks and bitmaps that hold nearly anything, the joins give the same.
    few = suffix_tree.Settings(least_context=6, least_pair=2, head_keys=9, bitmap_bits=8)
    for r in suffix_tree.score(spark, docs, settings=few).collect():
        assert abs(r.score - found[r.doc_id].score) < 1e-4 * r.n_tokens + 1e-6
    assert suffix_tree.score(spark, docs_of(spark, rows).limit(0)).count() == 0


def test_only_unsettled_keys_are_joined(spark):
    rng = random.Random(6)
    texts = [" ".join(["a b c d", "a b e", "x b c", "c d a"][rng.randint(0, 3)] for _ in range(8)) for _ in range(60)]
    docs = docs_of(spark, [(i, t) for i, t in enumerate(texts)])
    settings = suffix_tree.Settings(least_context=6, least_pair=2)
    nodes, entries, depth = suffix_tree.train(spark, docs, suffix_tree.word_counts(docs), len(texts), settings)
    contexts, every = suffix_tree.Known(nodes, settings), suffix_tree.Known(entries, settings)
    some = suffix_tree.Known(entries, suffix_tree.Settings(head_keys=len(every.keys) // 2))
    rest = {r.key: r.value for r in some.rest.collect()}
    assert depth > 1 and some.keys.size and rest
    whole, none, _ = suffix_tree.Tree(contexts, every, depth).gains([t.encode() for t in texts])
    part, late, owner = suffix_tree.Tree(contexts, some, depth).gains([t.encode() for t in texts])
    # Of a position, levels that the arrays know are not sent, nor are contexts.
    assert not len(none) and {*late.view(np.int64).tolist()} <= {*rest}
    joined = np.bincount(owner, [rest[k] for k in late.view(np.int64).tolist()], minlength=len(texts))
    assert np.allclose(part + joined, whole, atol=1e-4)


def test_more_text_grows_the_tree(spark):
    rng = random.Random(10)
    words = [f"w{i}" for i in range(40)]
    text = lambda: " ".join(w for _ in range(60) for w in rng.choice([words[:2], words[2:5], [rng.choice(words)]]))

    def contexts(n):
        docs = spark.createDataFrame([(text(),) for _ in range(n)], "text string")
        vocabulary = suffix_tree.word_counts(docs)
        return suffix_tree.train(spark, docs, vocabulary, n, suffix_tree.Settings())[0].count()

    assert 0 < contexts(20) < contexts(200)


# Importance resampling


def test_resampling_prefers_the_target_and_takes_exactly_k(spark):
    rng = random.Random(10)
    text = lambda words: " ".join(rng.choice(words) for _ in range(80))
    good, bad = [f"g{i}" for i in range(50)], [f"b{i}" for i in range(50)]
    rows = [(i, text(good if i % 4 else bad)) for i in range(200)] + [(900, None)]
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(100)], "doc_id long, quality int")
    docs = docs_of(spark, rows, "key int")
    found = importance.resample(spark, docs, labels, labels["quality"] == 1).collect()
    assert sum(r.kept for r in found) == round(0.75 * 201)
    assert sum(r.kept for r in found if r.doc_id % 4) >= 148
    again = importance.resample(spark, docs.repartition(2), labels, labels["quality"] == 1).collect()
    assert {r.doc_id for r in found if r.kept} == {r.doc_id for r in again if r.kept}
    assert all(r.kept for r in importance.resample(spark, docs, labels.limit(0), labels["quality"] == 1).collect())
    assert importance.resample(spark, docs.limit(0), labels, labels["quality"] == 1).count() == 0


def test_cut_of_top_equals_a_sort(spark):
    rng = random.Random(11)
    rows = [(rng.choice([rng.random(), 0.5, rng.random() * 1e-9]), i) for i in range(3000)]
    scored = spark.createDataFrame(rows, "key double, doc_id long")
    ordered = sorted(rows, key=lambda r: (-r[0], r[1]))
    for k in (1, 2, 700, 1500, 2999, 3000):
        assert importance.cut_of_top(scored, k, few=20) == ordered[k - 1]
    assert importance.cut_of_top(scored, 0) is None


def test_packed_halves_are_those_of_counted_pairs(spark):
    """Also halves with the upper bit set, of many rows, and counts beyond what a packed one holds."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choices(words, k=40)) for _ in range(300)] + [" ".join(["tick"] * 3000)] * 3
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)

    every = suffix_tree.Bitmap(6, np.array([0]), np.array([-1]))
    counts = Counter()
    for t in texts:
        s = suffix_tree.symbols_of([t.encode()])
        pair = s.codes[1:] + suffix_tree.BASE * s.codes[:-1]
        counts.update((pair >> np.uint64(32) << np.uint64(32)).view(np.int64).tolist())
    for least in (4, 9, 9000):
        shared = spark.sparkContext.broadcast(every)
        found = suffix_tree._repeated(docs, shared, least).toArrow()["key"].to_pylist()
        limit = min(least, suffix_tree.MOST_COUNTED)
        assert sorted(found) == sorted(k for k, n in counts.items() if n >= limit)
        assert min(found) < 0 or least == 9000


def test_shuffles_of_training_are_dropped(spark, monkeypatch):
    """Jobs that write or collect run with clean-up; the session is as before afterwards."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    seen = []
    train = suffix_tree.train

    def spied(*args):
        seen.append(spark.conf.get(key))
        return train(*args)

    monkeypatch.setattr(suffix_tree, "train", spied)
    before = spark.conf.get(key, None)
    docs = spark.createDataFrame([(i, "a b c d") for i in range(50)], "doc_id long, text string")
    assert suffix_tree.score(spark, docs).count() == 50
    assert seen == ["true"] and spark.conf.get(key, None) == before
