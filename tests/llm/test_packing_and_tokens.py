from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from wattlake.llm import arrow, encoding, id_codec, packing, token_count, token_files
from wattlake.llm.encoding import ChunkEncoder
from wattlake.llm.vocabularies import default_path

ODD = [
    "", " ", "a", "a b", "a  b", "a \n b", "\n a", "a ", "x<|endoftext|> y", "it's a b ́e",
    "a..", "a.).\n", "a,.", ".,", "İ. b", "1,2. 3 . x", "a.\r\nb", "\x00 a", "<s>hi</s>", "▁a▁ b", "ﬁ①",
]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_chunks_give_the_ids_of_the_library(name):
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choice("ab .,\n\t'é<|1)́İ　") for _ in range(rng.randint(1, 14))) for _ in range(5000)]
    encoder, whole = ChunkEncoder(name), Tokenizer.from_file(default_path(name))
    for i in range(0, len(texts), 97):
        part = texts[i : i + 97]
        wanted = [np.asarray(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in part]
        assert encoder.encode(part) == wanted


def test_counts_equal_the_library():
    model = sentencepiece.SentencePieceProcessor(model_file=default_path("piece_bpe_32k.model"))
    counter = token_count.MergeCounter("piece_bpe_32k.model")
    rng = random.Random(6)
    texts = ODD + ["".join(rng.choice("the an ▁\nx😀é①") for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    assert [counter.text(t) for t in texts] == [len(model.encode(t)) for t in texts]


def _check_plan(histogram, capacity):
    seen, used = set(), {}
    for r in packing.plan(histogram, capacity):
        for d in range(r.n):
            assert (r.length, r.rank_0 + d) not in seen
            seen.add((r.length, r.rank_0 + d))
            place = (r.offset_0 + d // r.across * r.length, r.length)
            used.setdefault(r.sequence_0 + d % r.across, []).append(place)
    assert len(seen) == sum(histogram.values())
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
        assert sum(3 * length > capacity for _, length in places) <= 2
    return len(used)


def test_plans_place_every_piece_once_and_without_gaps():
    rng = random.Random(1)
    for _ in range(200):
        capacity = rng.choice([5, 10, 50, 1024])
        histogram = {rng.randint(1, capacity): rng.randint(1, 30) for _ in range(rng.randint(0, 40))}
        _check_plan(histogram, capacity)
    many = {k: 50 for k in range(1, 1025)}
    assert _check_plan(many, 1024) <= 1.01 * sum(k * n for k, n in many.items()) / 1024 + 1


def test_pack(spark):
    rows = [(1, "a b " * 3000), (2, None), (3, ""), (4, "same"), (4, "same"), (5, "x" * 50)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, piece int")
    found = packing.pack(spark, docs.repartition(3), capacity=64).collect()
    encoder = Tokenizer.from_file(default_path("byte_bpe_50k.json"))
    for doc_id in (1, 2, 3, 5):
        text = dict(rows)[doc_id] or ""
        ids = np.asarray([*encoder.encode(text, add_special_tokens=False).ids, 2], "<u4").tobytes()
        own = sorted((r for r in found if r.doc_id == doc_id), key=lambda r: r.piece)
        assert b"".join(bytes(r.ids) for r in own) == ids
        assert [r.start for r in own] == np.cumsum([0, *(r.length for r in own)])[:-1].tolist()
        assert all(r.length == 64 for r in own[1:])
    assert sum(r.doc_id == 4 for r in found) == 2
    whole = packing.sequences(spark.createDataFrame(found)).collect()
    assert all(len(r.ids) == 4 * r.length <= 256 for r in whole)
    assert packing.pack(spark, docs.limit(0)).count() == 0


def test_codec_round_trip_and_damage():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 63, 64, 65, 5000, 70000):
        for ids in (
            rng.integers(0, 49408, n), rng.zipf(1.3, n) % 3000, np.arange(n) % 7, np.full(n, 65535),
        ):
            assert (id_codec.decode(id_codec.encode(ids.astype(np.int64))) == ids).all()
    block = bytearray(id_codec.encode(np.arange(5000) % 900))
    assert len(block) < 5000 * 2
    block[len(block) // 2] ^= 1
    with pytest.raises(ValueError):
        id_codec.decode(bytes(block))
    with pytest.raises(ValueError):
        id_codec.encode(np.array([65536]))


def test_files_keep_order_and_ids(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 50)
    rows = [(i * 7 % 40, f"text number {i} " * (i % 9)) for i in range(40)] + [(3, "again"), (None, None)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, file string")
    token_files.write(docs.repartition(5), str(tmp_path / "files"))
    found = token_files.read(spark, str(tmp_path / "files")).collect()
    assert sorted(r.doc_id for r in found if r.doc_id is not None) == sorted(r[0] for r in rows[:-1])
    encoder = Tokenizer.from_file(default_path("word_bpe_49k.json"))
    at = 0
    for r in sorted(found, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
        assert len(r.ids) == 4 * r.n_tokens
    ordered = [r.doc_id for r in sorted(found, key=lambda r: r.start)]
    assert ordered[0] is None and ordered[1:] == sorted(ordered[1:])
    for doc_id, text in rows[:40]:
        if doc_id != 3:
            ids = [*encoder.encode(text, add_special_tokens=False).ids, 2]
            own = next(r for r in found if r.doc_id == doc_id)
            assert zlib.crc32(bytes(own.ids)) == zlib.crc32(np.asarray(ids, "<u4").tobytes())


def test_count_tokens_of_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, 5), (2, "", 6), (3, "a b c", 7), (3, "a b c", 7), (None, "é", 8)],
        "doc_id long, text string, n_tokens int",
    )
    found = token_count.count_tokens(docs, limit=2).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in found) == [
        (0, 2, 1, False), (1, 0, 0, False), (2, 0, 0, False), (3, 5, 3, True), (3, 5, 3, True),
    ]
    assert token_count.count_tokens(docs.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_frequent_chunks_stay_in_a_full_memory(name, monkeypatch):
    """Ids are the library's while halves of the memory change, and a chunk met again is not encoded again."""
    monkeypatch.setattr(encoding, "MEMORY_ENTRIES", 200)
    rng = random.Random(7)
    rare = ["".join(rng.choices("abcdeéüßÀÑ'-.,%$<|>12 ", k=rng.randint(1, 9))) for _ in range(3000)]
    texts = [f"Often. the Énd, {r}%%%.\n{r} it's <|endoftext|> of,\nthe" for r in rare] + ["\nA.", "a\n\nb", "", "."]
    encoder = ChunkEncoder(default_path(name))
    asked = []
    model = encoder.model
    encoder.model = lambda word: asked.append(word) or model(word)
    whole = Tokenizer.from_file(default_path(name))
    for i in range(0, len(texts), 100):
        part = texts[i : i + 100]
        wanted = [np.asarray(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in part]
        assert encoder.encode(part) == wanted
    often = "ĠtheĠ"[:4] if name.startswith("byte") else "the"
    assert asked.count(often) <= 6  # in its three places, with and without a sign
    assert len(encoder.fine) <= 100 and len(encoder.fine.old) <= 100


def test_arrow_batches_are_bounded(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        for given, wanted in (("10000", "2000"), ("0", "2000"), ("500", "500")):
            spark.conf.set(key, given)
            table = spark.range(6000).coalesce(1)
            sizes = arrow.map_in_arrow(
                table, lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n long"
            ).collect()
            assert spark.conf.get(key) == wanted and max(r["n"] for r in sizes) <= int(wanted)
    finally:
        spark.conf.set(key, before)
