"""Phrases, pieces and resampling against brute force, on given rows and edge cases."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.llm import collocations, importance, pieces, queries, words
from kestrel.llm.queries import tokenizer_file

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, key long, n long, c long, score double, rank string"
MODEL = tokenizer_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def docs(spark):
    """Whole documents of the small table, with edge cases and clashing columns."""
    base = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    prose = max((t for _, t, _ in base), key=len)
    extra = [(10_001, None, "en"), (10_002, "", None), (10_003, " \n\t . ", "en"), (10_004, "one two", None),
             (10_005, "One  TWO, one\ttwo\x0bone two\x1cx", "und"), (10_006, "a a a a a a a a a a. a a", "en"),
             (10_007, "x" * 5000, ""), (10_008, prose, "de"), (10_008, prose, "de"), (10_009, (prose + "\n") * 10, None),
             (None, prose, "fr"), (None, None, None), (10_010, "é́ \U0001F600 a\x1cb ▁ <s> é  \x00", "en"),
             (10_011, "a" * 128 + " " + "b" * 129 + " " + "é" * 300 + " " + "c" * 700, "en")]
    rows = [(i, t, lang, 7, 1, 3, 0.5, "clash") for i, t, lang in base + extra]
    return spark.createDataFrame(rows, SCHEMA).repartition(4).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text or "", r.lang) for r in docs.collect()]


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


# ------------------------------------------------------------ phrases ---

def phrase_rows(rows, min_count, top):
    f, n = collections.Counter(), collections.Counter()
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang if lang is not None else "und"] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[(lang if lang is not None else "und", tuple(w[i:i + k]))] += 1
    out = []
    often = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    most = collections.Counter()
    for (lang, w), a in often.items():
        for size in range(2, len(w)):
            for i in range(len(w) - size + 1):
                most[lang, w[i:i + size]] = max(most[lang, w[i:i + size]], a)
    for (lang, w), a in often.items():
        if 100 * most[lang, w] >= 80 * a:
            continue
        score, _, l, r = min((2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]])
                             for k in range(1, len(w)))
        out.append((lang, -score, -a, " ".join(w).encode(), l, r, n[lang]))
    out.sort()
    seen, got = collections.Counter(), []
    for lang, score, a, w, l, r, n_ in out:
        seen[lang] += 1
        if seen[lang] <= top:
            got.append((lang, seen[lang], w.decode(), -a, l, r, n_, -score))
    return got


@pytest.mark.parametrize("min_count,top", [(5, 2000), (3, 40)])
def test_collocations(docs, rows, min_count, top):
    got = collocations.collocations(docs, min_count=min_count, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score", "doc_id"]
    got = got.collect()
    assert sorted(tuple(r)[:8] for r in got) == phrase_rows(rows, min_count, top)
    text = collections.defaultdict(list)
    for i, t, _ in rows:
        text[i].append(" ".join(re.findall(r"[^\x20\x09]+", lower(t))))
    for r in got:                                        # the pointer leads to an occurrence
        assert any(r.phrase in t for t in text[r.doc_id])


def test_collocations_empty(empty, spark):
    assert collocations.collocations(empty).count() == 0
    none = spark.createDataFrame([(1, None, None)], "doc_id long, text string, lang string")
    assert collocations.collocations(none).count() == 0


def test_equal_fingerprints_part_by_their_text():
    """With only eight different word hashes all phrases collide; the words' bytes tell them apart."""
    text = ("the cat sat on the mat and the dog sat on the cat " * 3).encode()
    block = collocations.Block(np.frombuffer(text, np.uint8), np.array([0, len(text)]), np.zeros(1, np.uint64))
    block.hash = block.hash % np.uint64(3)
    np.cumsum(block.hash * block.up[:-1], out=block.prefix[1:])
    every = collocations.Bitmap(8, np.full(collocations.BITMAP // 64, ~np.uint64(0), np.uint64))
    got = collections.Counter()
    for n, phrases, count, _ in collocations._phrases(block, [every] * 4, np.zeros(1, np.int64)):
        assert phrases.to_pylist() == sorted(phrases.to_pylist(), key=str.split)
        for p, c in zip(phrases.to_pylist(), count.tolist()):
            assert len(p.split()) == n
            got[p] += c
    w = text.decode().split()
    assert got == collections.Counter(" ".join(w[i:i + n]) for n in range(1, 5) for i in range(len(w) - n + 1))


@pytest.mark.parametrize("least", [5, 300])
def test_bitmap_has_every_frequent_run(docs, rows, least):
    texts = docs.select("doc_id", "text", F.coalesce("lang", F.lit("und")).alias("lang"))
    bitmap = collocations._bitmap(texts, 1, None, least).value
    count = collections.Counter()
    for _, text, lang in rows:
        for w in re.findall(r"[^\x20\x09.,;:!?\x0A-\x0D]+", lower(text)):
            count[lang if lang is not None else "und", w] += 1
    often = [k for k, c in count.items() if c >= least]
    assert often and int(np.bitwise_count(bitmap.bits).sum()) <= len(often)
    for lang, w in often:
        head, raw = np.frombuffer(lang.encode(), np.uint8), np.frombuffer(w.encode(), np.uint8)
        lang_hash = words.hash_spans(head, np.array([0]), np.array([len(head)]))
        key, _ = collocations.Block(raw, np.array([0, len(raw)]), lang_hash).runs(1)
        assert bitmap.holds(key).all()


# ------------------------------------------------------------- pieces ---

def test_pieces(docs, rows, empty):
    from sentencepiece import SentencePieceProcessor
    lib = SentencePieceProcessor(model_file=MODEL)
    want = []
    for i, text, _ in rows:
        ids = lib.encode(text) + [lib.eos_id()]
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(lib.decode(ids).encode()).hexdigest()))
    encoded = pieces.encode(docs, MODEL)
    assert sorted(map(tuple, pieces.digest(encoded, MODEL).collect()), key=repr) == sorted(want, key=repr)
    back = pieces.decode(encoded, MODEL).collect()
    assert sorted([(r.doc_id, r.text) for r in back], key=repr) == \
        sorted([(i, lib.decode(lib.encode(t))) for i, t, _ in rows], key=repr)
    assert pieces.digest(pieces.encode(empty, MODEL), MODEL).count() == 0


def test_agenda_forms_agree_with_the_library():
    v, rand = pieces.Vocabulary(MODEL, cache_bytes=1 << 16), random.Random(5)
    letters = ["the", " ", "  ", "▁", "\n", "12", ".", "\x00", "﻿", "on", "tion", "é", "漢字", "a" * 40]
    for _ in range(400):
        text = "".join(rand.choice(letters + [chr(rand.randrange(1, 0xD7FF)), chr(rand.randrange(0xE000, 0x10FFFF))])
                       for _ in range(rand.randrange(25)))
        want = v.library.encode(text)
        assert np.frombuffer(v.encode([text])[0], "<u4").tolist() == want
        assert [i for c in v._chunks(text) for i in v._ids(v.merged(c))] == want          # the heap
        assert np.frombuffer(b"".join(v._many(v._chunks(text))) if text else b"", "<u4").tolist() == want
        ids = [rand.randrange(32000) if rand.random() < 0.6 else rand.randrange(259) for _ in range(rand.randrange(20))]
        assert v.decode(np.array(ids, np.int64), np.array([0, len(ids)]))[0].decode() == v.library.decode(ids)
    long = "supercalifragilistic" * 2000
    assert np.frombuffer(v.encode([long])[0], "<u4").tolist() == v.library.encode(long)


def test_the_library_is_asked_about_every_new_chunk():
    v = pieces.Vocabulary(MODEL)
    v.merged_id = v.merged_id[::-1].copy()               # a wrong agenda is an error, not a wrong result
    with pytest.raises(ValueError, match="in another way"):
        v.encode(["some words here"])


def test_piece_cache_is_bounded():
    v = pieces.Vocabulary(MODEL, cache_bytes=200_000)
    rand = random.Random(1)
    for _ in range(30):
        v.encode([" ".join("".join(rand.choices("abcdefgh", k=9)) for _ in range(200))])
        assert v.held <= 200_000 + 200 * (pieces._ENTRY + 80)


# --------------------------------------------------------- resampling ---

def features(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    return len(w), w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def test_position_table_crc():
    rand = np.random.default_rng(3)
    buf = rand.integers(0, 256, 20_000, dtype=np.uint8)
    for longest in (3, 128, 129, 700):
        size = rand.integers(1, longest + 1, 60)
        gap = rand.integers(0, 5, 60)
        start = np.cumsum(size + gap) - size
        keep = start + size <= len(buf)
        start, end = start[keep], (start + size)[keep]
        assert importance._CRC.of_spans(buf, start, end).tolist() == \
            [zlib.crc32(buf[a:z].tobytes()) for a, z in zip(start, end)]
    for n in (128, 129, 256, 257, 1000):
        assert importance._CRC.of_spans(buf, np.array([5]), np.array([5 + n])).tolist() == [zlib.crc32(buf[5:5 + n].tobytes())]
    assert len(importance._CRC.of_spans(buf, np.zeros(0, int), np.zeros(0, int))) == 0


def resampled_rows(rows, target, share=25, least=20, buckets=10_000, seed=7):
    s, t = collections.Counter(), collections.Counter()
    for held, texts in ((s, [r[1] for r in rows]), (t, target)):
        for text in texts:
            held.update(zlib.crc32(f.encode()) % buckets for f in features(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (all_s + buckets) / ((s[b] + 1.0) * (all_t + buckets))))
            for b in range(buckets)]
    out = []
    for i, text, _ in rows:
        n, f = features(text)
        weight = sum(gain[zlib.crc32(x.encode()) % buckets] for x in f) // max(1, len(f))
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= least))
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {}
    drawn = share * len(able) // 100
    places = collections.defaultdict(list)
    for k, r in enumerate(able, 1):
        places[r[:4]].append(k if k <= drawn else None)
    return sorted(((*r[:4], places[r[:4]].pop() if r[4] else None) for r in out), key=repr)


@pytest.mark.parametrize("share", [25, 100, 0])
def test_resampling(docs, rows, spark, share):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").withColumn("score", F.lit(1))
    got = importance.resampled(docs, bench, share=share).select("doc_id", "n_features", "weight", "score", "rank")
    want = resampled_rows(rows, [r.text for r in bench.collect()], share)
    assert sorted(map(tuple, got.collect()), key=repr) == want


def test_resampling_empty_tables(docs, rows, empty, spark):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert importance.resampled(empty, bench).count() == 0
    got = importance.resampled(docs, bench.limit(0)).select("doc_id", "n_features", "weight", "score", "rank")
    assert sorted(map(tuple, got.collect()), key=repr) == resampled_rows(rows, [])


def test_queries_return_the_contract_columns(spark):
    want = {"op11_collocations": "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint",
            "op12_piece_agenda": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
            "op13_importance_resampling": "doc_id bigint, n_features bigint, weight bigint, score bigint, rank bigint"}
    for name, schema in want.items():
        got = queries.QUERIES[name](spark, SF)
        kinds = dict(f"{c} {t}".split() for c, t in got.dtypes)
        assert kinds == dict(x.split() for x in schema.split(", "))
