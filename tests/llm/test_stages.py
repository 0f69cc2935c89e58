"""Stages of the pipeline and other learned or sampled operators against plain versions."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import combinations
from zlib import crc32

import numpy as np
import pytest

import corpus_pipeline
from sieveline.llm.fingerprints import fingerprint_documents
from sieveline.llm.near import probability_jaccard, shingles

tokenizers = pytest.importorskip("public_tokenizers")
DDL = "doc_id long, text string, lang string, source string, n_chars long"
ASSIGN = r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
STAGE = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(21)
    vocabulary = {lang: ["".join(rng.choice(letters) for _ in range(rng.randrange(2, 9))) for _ in range(400)] for lang, letters in (("en", "etaoinshrdlu"), ("ru", "абвгдежзикл"))}
    passage = [rng.choice(vocabulary["en"]) for _ in range(70)]
    out = []
    for i in range(300):
        lang = "en" if i % 2 else "ru"
        words = [rng.choice(vocabulary[lang]) for _ in range(rng.randrange(60, 200))]
        if i > 20 and i % 10 == 1:
            words = out[-2][1].split() if i % 20 == 1 else [*out[-2][1].split()[:-2], "other", "end"]
        elif i % 15 == 3:
            words[20:20] = passage
        elif i % 15 == 4:
            words.insert(9, f"password={rng.randrange(10**9, 10**10)}")
        out.append((i, " ".join(words), lang))
    out += [(900 + i, " ".join("".join(rng.choice("qzxjkvw") for _ in range(5)) for _ in range(80)), None) for i in range(5)]
    out += [(950, None, "en"), (951, "", "ru"), (952, " 12 -- ", None), (None, "qzx " * 40, None)]
    return [(i, t, lang, "s", None if t is None else len(t)) for i, t, lang in out]


def plain_near(docs):
    sets = {i: shingles(t) for i, t in docs.items()}
    root = {i: i for i in docs}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(docs), 2):
        if docs[a] == docs[b] or probability_jaccard(sets[a], sets[b]) >= 0.8:
            x, y = sorted((top(a), top(b)))
            root[y] = x
    return {i: t for i, t in docs.items() if top(i) == i}


def plain_substring(docs, length=50):
    cut = {i: t.split() for i, t in docs.items()}
    first = {}
    for i in sorted(cut):
        for p in range(len(cut[i]) - length + 1):
            first.setdefault(tuple(cut[i][p : p + length]), i)
    out = {}
    for i, w in cut.items():
        gone = {q for p in range(len(w) - length + 1) if first[tuple(w[p : p + length])] < i for q in range(p, p + length)}
        text = " ".join(x for q, x in enumerate(w) if q not in gone) if gone else docs[i]
        if text or not gone:
            out[i] = text
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_each_stage_equals_a_plain_version(spark, rows):
    docs = spark.createDataFrame(rows, DDL).repartition(3)
    kept = STAGE["language_id"](spark, docs, "")
    assert kept.columns == docs.columns
    assert texts(kept) == {r[0]: r[1] for r in rows if r[0] is not None and r[0] < 900}
    single = STAGE["near_dedup"](spark, kept, "")
    want = plain_near(texts(kept))
    assert texts(single) == want and len(want) < 290
    cut = STAGE["substring_dedup"](spark, single, "")
    want = plain_substring(want)
    assert texts(cut) == want and sum(r.n_chars for r in cut.collect()) == sum(map(len, want.values()))
    masked = STAGE["secret_scan"](spark, cut, "")
    found = texts(masked)
    secrets = {i: [m.group(0) for m in re.finditer(ASSIGN, t)] for i, t in want.items()}
    assert sum(map(len, secrets.values())) >= 15
    for i, t in want.items():
        for s in secrets[i]:
            assert s not in found[i]
        assert found[i] == t if not secrets[i] else "[SECRET]" in found[i]
    packed = STAGE["packing"](spark, masked, "").collect()
    whole = tokenizers_of()
    ids = {i: np.array([*whole.encode(t, add_special_tokens=False).ids, 1], np.uint32) for i, t in found.items()}
    sequences, seen = {}, Counter()
    for r in packed:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and r.doc_tokens == len(ids[r.doc_id])
        assert crc32(part.astype("<u4").tobytes()) == r.ids_crc32
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        seen.update((r.doc_id, p) for p in range(r.start, r.start + r.length))
    assert set(seen.values()) == {1} and len(seen) == sum(map(len, ids.values()))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def tokenizers_of():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizers.path("byte_bpe_50k.json"))


def test_stages_of_an_empty_table(spark):
    docs = spark.createDataFrame([], DDL)
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, "")
        assert found.count() == 0
        assert name == "packing" or found.columns == docs.columns


def test_recall_of_near_duplicates(spark):
    """Pairs at 0.8 and more are found, in a family that shares most of its text, too."""
    from sieveline.llm.near import near_duplicates

    rng = random.Random(22)
    shared = [f"s{i}" for i in range(150)]
    docs = {}
    for i in range(120):
        own = [f"d{i}w{j}" for j in range(28)]
        docs[2 * i] = " ".join(shared + own)
        docs[2 * i + 1] = " ".join(shared + own[: rng.randrange(14, 28)])
    got = {r.doc_id: r.class_id for r in near_duplicates(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()}
    sets = {i: shingles(t) for i, t in docs.items()}
    for a, b in combinations(docs, 2):
        if probability_jaccard(sets[a], sets[b]) >= 0.8:
            assert got[a] == got[b], (a, b)


def test_likeness_estimates_generalised_jaccard(spark):
    rng = random.Random(23)
    rows = [(i, " ".join(rng.choice([f"w{k}" for k in range(30 + i % 40)]) for _ in range(rng.randrange(20, 120)))) for i in range(300)]
    got = {r.doc_id: r for r in fingerprint_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    errors = []
    for (i, a), (_, b) in zip(rows, rows[1:] + rows[:1], strict=True):
        x, y = Counter(a.split()), Counter(b.split())
        exact = sum((x & y).values()) / sum((x | y).values())
        errors.append(got[i].near_next - exact)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.08


def test_texts_of_more_than_a_megabyte(spark):
    """Every operator takes whole texts, whatever their length, beside clashing columns and repeated rows."""
    from sieveline.llm.language import identify_language
    from sieveline.llm.packing import pack_documents
    from sieveline.llm.quality import quality_filter
    from sieveline.llm.secrets import scan_secrets
    from sieveline.llm.sentencepieces import encode_documents, first_byte_id, load_pieces
    from sieveline.llm.sharding import shard_documents
    from sieveline.llm.warc import archive_roundtrip

    rng = random.Random(31)
    long = " ".join(f"w{rng.randrange(5000)}" for _ in range(220_000)) + " password=abcdef123456 "
    assert len(long) > 1 << 20
    rows = [(1, long, "en", "s", 1), (2, "short text", "en", "s", 2), (2, "short text", "en", "s", 2), (None, long + "x", None, None, None), (3, None, "de", "s", 0)]
    docs = spark.createDataFrame([(*r, 1, "d", 2) for r in rows], DDL + ", size long, digest string, html long")
    n = 220_001

    sizes = sorted(r.n_words for r in quality_filter(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int")).collect())
    assert sizes == [0, 2, 2, n, n + 1]
    assert {r.lang_pred for r in identify_language(docs).where("doc_id < 3").collect()} <= {"en", "und"}
    found = scan_secrets(docs, tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN).collect()
    assert sorted(r.n_assign for r in found) == [0, 0, 0, 1, 1]
    model = tokenizers.path("piece_bpe_32k.model")
    encoded = encode_documents(docs, load_pieces(model), first_byte_id(model)).collect()
    assert len(encoded) == 5 and all(r.decoded_ok for r in encoded if r.n_tokens > 200_000)
    packed = pack_documents(docs, tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN)
    whole = len(tokenizers_of().encode(long, add_special_tokens=False).ids) + 1
    assert packed.where("doc_id = 1").agg({"length": "sum"}).first()[0] == whole
    pages = spark.createDataFrame([(r[0], r[1], 1) for r in rows], "page_id long, html string, n_bytes long")
    back = archive_roundtrip(pages).collect()
    assert sorted(r.payload_bytes for r in back) == sorted(len((r[1] or "").encode()) for r in rows) and all(r.intact for r in back)
    assert sorted(r.n_chars for r in fingerprint_documents(docs).collect()) == sorted(len(r[1] or "") for r in rows)
    assert sorted(r["size"] for r in shard_documents(docs).collect()) == sorted(len((r[1] or "").encode()) + 16 for r in rows)
