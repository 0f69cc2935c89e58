"""Operators against brute force on small tables with nulls, ties, copies and clashing columns."""

from __future__ import annotations

import random
import re
from collections import Counter
from hashlib import md5, sha256

import numpy as np
import pytest

from sieveline.llm import near, packing, secrets, sentencepieces
from sieveline.llm.fingerprints import edited, fingerprint_documents
from sieveline.llm.language import identify_language
from sieveline.llm.near import keep_one, near_duplicates, probability_jaccard, shingles, signatures
from sieveline.llm.quality import quality_filter
from sieveline.llm.secrets import mask_secrets, scan_secrets
from sieveline.llm.sharding import shard_documents
from sieveline.llm.substrings import remove_repeats, repeated_words
from sieveline.llm.warc import MAGIC, archive_roundtrip

tokenizers = pytest.importorskip("public_tokenizers")
RANKS, PATTERN = tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN
DDL = "doc_id long, text string, lang string, source string, n_chars long, digest string, size long"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = []
    for i in range(60):
        words = [rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(rng.randrange(9)) for _ in range(rng.randrange(1, 90))]
        if out and i % 4 == 0:
            words = words[:5] + (out[-1][1] or "").split()[3:70] + words[:9]
        out.append((i, " ".join(words), rng.choice(["en", "de", None])))
    out += [(70, None, "en"), (71, "", "de"), (72, " \n\t", None), (None, out[3][1], "en"), (73, out[5][1], "de"), (74, "x" * 30_000 + " é日本", "en")]
    out += [out[1], out[2]]
    return [(*r, "s", 1, "clash", 2) for r in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DDL).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DDL)


def test_repeated_words(docs, empty, rows):
    length = 8
    cut = [(r[1] or "").encode().split() for r in rows]
    first: dict = {}
    for r, w in zip(rows, cut, strict=True):
        for p in range(len(w) - length + 1):
            if r[0] is not None:
                key = tuple(w[p : p + length])
                first[key] = min(first.get(key, r[0]), r[0])
    want = []
    for r, w in zip(rows, cut, strict=True):
        gone = {q for p in range(len(w) - length + 1) if r[0] is not None and first[tuple(w[p : p + length])] < r[0] for q in range(p, p + length)}
        want.append((r[0], len(w), len(gone), sha256(b" ".join(x for q, x in enumerate(w) if q not in gone)).hexdigest()))
    assert Counter(map(tuple, repeated_words(docs, length).collect())) == Counter(want)
    assert repeated_words(empty).count() == 0
    kept = remove_repeats(docs, length)
    assert kept.columns == docs.columns
    assert kept.where("doc_id = 73").count() == 0


def test_near_duplicates(docs, empty, spark):
    base = [f"w{i}" for i in range(200)]
    texts = [base, base[:199] + ["end"], base[:100], [*base, "more"], [f"z{i}" for i in range(50)]]
    table = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)] + [(9, " ".join(base))], "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.class_size) for r in near_duplicates(table).collect()}
    assert got == {0: (0, 4), 1: (0, 4), 2: (2, 1), 3: (0, 4), 4: (4, 1), 9: (0, 4)}
    assert near_duplicates(docs).count() == docs.count()
    assert near_duplicates(empty).count() == 0
    assert {r.doc_id for r in keep_one(table).collect()} == {0, 2, 4}


def test_near_duplicates_of_a_family_with_a_template(spark):
    rng = random.Random(8)
    shared = [f"t{i}" for i in range(170)]
    texts = []
    for i in range(60):
        own = [f"o{i}x{j}" for j in range(30)]
        texts += [shared + own, shared + own[:26] + [f"e{i}x{j}" for j in range(18)]] if i % 3 else [shared + own]
    rng.shuffle(texts)
    sets = [shingles(" ".join(t)) for t in texts]
    root = list(range(len(sets)))
    for b in range(len(sets)):
        for a in range(b):
            if root[a] != root[b] and probability_jaccard(sets[a], sets[b]) >= 0.8:
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    assert 60 <= len(set(root)) < len(texts)
    table = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in near_duplicates(table).collect()} == dict(enumerate(root))


def test_candidates_hold_every_alike_pair(spark):
    rng = np.random.default_rng(4)
    sets = []
    for i in range(120):
        if i % 4:
            names, counts = sets[i - 1]
            counts = np.maximum(counts + (rng.random(len(counts)) < 0.1) * rng.integers(-1, 3, len(counts)), 1)
            held = rng.random(len(names)) > 0.06
            sets.append((names[held], counts[held]))
        else:
            names = np.unique(rng.integers(0, 90, 60)).astype(np.uint64)
            sets.append((names, rng.integers(1, 4, len(names))))
    rows = [(i, i, int(e), float(c / counts.sum())) for i, (names, counts) in enumerate(sets) for e, c in zip(names, counts.tolist(), strict=True)]
    elements = spark.createDataFrame(rows, "node long, root long, element long, mass double")
    got = {tuple(r) for r in near.alike_candidates(elements, 0.8).collect()}
    alike = {(a, b) for b in range(120) for a in range(b) if probability_jaccard(sets[a], sets[b]) >= 0.8}
    assert alike and alike <= got and len(got) < 120 * 119 / 2


def test_probability_jaccard_and_its_estimate():
    rng = random.Random(1)
    sets, exact = [], []
    for _ in range(150):
        a, b = ({rng.randrange(40): rng.randrange(1, 5) for _ in range(25)} for _ in range(2))
        exact.append(sum(1 / sum(max(a.get(j, 0) / a[i], b.get(j, 0) / b[i]) for j in a.keys() | b.keys()) for i in a.keys() & b.keys()))
        as_arrays = lambda z: (np.array(sorted(z), np.uint64), np.array([z[k] for k in sorted(z)]))
        sets += [as_arrays(a), as_arrays(b)]
        assert probability_jaccard(sets[-2], sets[-1]) == pytest.approx(exact[-1])
    names = signatures(sets)
    estimate = (names[0::2] == names[1::2]).mean(axis=1)
    assert abs(estimate.mean() - np.mean(exact)) < 0.03
    assert len(shingles(None)[0]) == 0 and len(shingles("one two")[0]) == 1
    assert near.bands(names).shape == (300, near.BANDS)


def test_quality_counts(docs, empty, spark, rows):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None)], "doc_id long, quality long")
    want = []
    for r in rows:
        text = r[1] or ""
        w = text.encode().split()
        grams = Counter(zip(w, w[1:], w[2:], strict=False))
        repeats = {q for p in range(len(w) - 2) if grams[tuple(w[p : p + 3])] > 1 for q in (p, p + 1, p + 2)}
        lines = [x for x in text.split("\n") if x.encode().split()]
        chars = sum(len(x.decode()) for x in w)
        symbols = len(re.findall(r"[#*$%&|<>]", text))
        failed = len(w) < 50 or 100 * len(repeats) > 50 * len(w)
        want.append((r[0], len(w), chars, symbols, len(lines) - len(set(lines)), len(repeats), failed, not failed))
    got = quality_filter(docs, labels).drop("failed_rules")
    assert Counter(map(tuple, got.collect())) == Counter(want)
    assert quality_filter(empty, labels).count() == 0


def test_quality_of_a_stratum_that_certifies_nothing(spark):
    words = " ".join(f"w{i}x" for i in range(60))
    # Each text has a word of its own: equal texts would count as one label.
    rows = [(i, f"{words} n{i}", None) for i in range(4000)] + [(10_000 + i, f"{words} a{i}", "aa") for i in range(300)]
    bad = words + " *" * 45
    rows += [(20_000 + i, f"{bad} b{i}", None) for i in range(300)] + [(30_000, bad, "aa"), (30_001, bad, "cc")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = docs.where("doc_id < 30000").selectExpr("doc_id", "cast(doc_id < 20000 AS long) AS quality")
    got = {r.doc_id: r.kept for r in quality_filter(docs, labels).where("doc_id >= 20000").collect()}
    assert not got[20_000] and not got[30_001] and got[30_000]


def test_language(spark, docs, empty):
    rng = random.Random(2)
    kinds = {"aa": "the of and thing with".split(), "bb": "der und nicht schön auch".split()}
    table = spark.createDataFrame(
        [(i, " ".join(rng.choices(kinds[k], k=30)), k) for i in range(80) for k in [rng.choice(["aa", "bb"])]], "doc_id long, text string, lang string"
    )
    got = identify_language(table).join(table.select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.where("lang <> lang_pred").count() == 0 and got.count() > 5
    odd = {r.doc_id: r for r in identify_language(docs).where("doc_id >= 70").collect()}
    assert all(odd[i].lang_pred == "und" and odd[i].score == 0 for i in (70, 71, 72))
    assert identify_language(empty).count() == 0


def test_secrets(spark, empty):
    uuid = "123e4567-e89b-12d3-a456-426614174000"
    text = f'API_KEY: "abc123def" token=abc AKIA{"Q7" * 9} {"0f" * 16} q8Zr1LmX0vTy7KpWs3Nd9Bg2 {uuid} some_long_identifier_name_here'
    table = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    got = {r.doc_id: r for r in scan_secrets(table, RANKS, PATTERN).collect()}
    kinds = [s.split(":")[0] for s in got[1].spans.split(",")]
    assert kinds == ["assign", "access", "hex", "random"]
    for span in got[1].spans.split(","):
        kind, s, e = span.split(":")
        assert kind != "assign" or text[int(s) : int(e)] == 'API_KEY: "abc123def'
    base = ",".join(got[1].spans.split(",")[:3])
    assert got[1].base_sha256 == sha256(base.encode()).hexdigest()
    assert got[2].spans == "" and got[3].n_hex == 0
    masked = {r.doc_id: r.text for r in mask_secrets(table, RANKS, PATTERN).collect()}
    assert masked[1].count("[SECRET]") == 4 and uuid in masked[1] and masked[2] is None
    assert scan_secrets(empty, RANKS, PATTERN).count() == 0
    assert secrets.redact("abcdef", [1, 2], [4, 3], "#") == "a#ef"


def test_random_strings_of_one_case_and_inside_runs():
    from sieveline.llm.tokens import encoding

    rng, coder = random.Random(3), encoding(RANKS, PATTERN)
    low, base32 = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    base62 = low + low.upper() + "0123456789"

    def spans(text):
        return [text[s:e] for s, e, kind in secrets.find_spans(text, coder, 2.0) if kind == "random"]

    for letters in (low, low.upper(), base32, low + "0123456789"):
        some = ["".join(rng.choices(letters, k=32)) for _ in range(100)]
        assert sum(spans(x) == [x] for x in some) >= 97
    for lead in ("services/configuration/production/deployment/", "production_database_connection_string="):
        for _ in range(20):
            key = "".join(rng.choices(base62, k=24))
            assert any(key in x for x in spans(lead + key))
    key = "q8Zr1LmX0vTy7KpWs3Nd9Bg2"
    assert spans("0f" * 16 + key) == [key]
    assert not spans("some_long_identifier_name_here getUserAccountConfigurationById 2024-01-01-12-00-00-000000 ")


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text or "" for r in docs.where("doc_id >= 3").collect()}
    out = packing.pack_documents(docs.where("doc_id >= 3"), RANKS, PATTERN, 4096).collect()
    held: dict = {}
    sequences: dict = {}
    for r in out:
        held.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc, parts in held.items():
        n = len(whole.encode(texts[doc], add_special_tokens=False).ids) + 1
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == n
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048 and at & (at - 1) == 0
    assert set(held) == set(texts)
    assert packing.pack_documents(empty, RANKS, PATTERN).count() == 0


def test_packing_keeps_added_tokens_whole(spark):
    from zlib import crc32

    from tokenizers import Tokenizer

    from sieveline.llm.tokens import added_tokens

    path = tokenizers.path("byte_bpe_50k.json")
    texts = ["a doc <|endoftext|> next", "<|endoftext|>", "x  <|endoftext|><|endoftext|>\n y", "<|endof text|>"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got: dict = {}
    for r in packing.pack_documents(table, RANKS, PATTERN, added=added_tokens(path)).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    for doc, text in enumerate(texts):
        ids = np.array([*Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids, packing.END_ID], "<u4")
        assert all((crc, n) == (crc32(ids[s : s + k].tobytes()), len(ids)) for s, k, crc, n in got[doc])
        assert sum(k for _, k, _, _ in got[doc]) == len(ids)


def test_archives(spark):
    same = "a" * 120
    fake = MAGIC + "WARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    pages = [(1, same), (0, same), (2, None), (3, "q" + fake + MAGIC + "é"), (4, fake), (5, MAGIC * 2), (None, same), (6, MAGIC + "WARC-Type: response\r\nContent-Length: 40000\r\n\r\n")]
    for parts in (1, 3):
        table = spark.createDataFrame(pages, "page_id long, html string").repartition(parts)
        got = {r.page_id: r for r in archive_roundtrip(table).collect()}
        assert len(got) == len(pages) and all(r.intact for r in got.values())
        for page, html in pages:
            assert got[page].payload_digest == sha256((html or "").encode()).hexdigest()
            assert got[page].payload_bytes == len((html or "").encode())
        assert (got[1].record_type, got[1].refers_to, got[0].record_type) == ("revisit", 0, "response")


def test_fingerprints(spark, docs, empty):
    table = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    order = sorted(((r.doc_id, r.text or "") for r in table.collect()))
    got = {r.doc_id: r for r in fingerprint_documents(table, range_bytes=600).collect()}
    assert len(got) == len(order)
    for k, (i, text) in enumerate(order):
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == sha256(edited(text, order[(k + 1) % len(order)][1]).encode()).hexdigest()
    assert got[5].fingerprint == got[73].fingerprint
    assert fingerprint_documents(docs).count() == docs.count()
    assert fingerprint_documents(empty).count() == 0


def test_sharding(docs, empty):
    got = shard_documents(docs, 5).collect()
    assert len(got) == docs.count()
    shards: dict = {}
    for r in got:
        shards.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in shards.values())
    where = {}
    for r in got:
        assert where.setdefault((r.text_crc32, r.size), r.shard) == r.shard
    atoms: Counter = Counter()
    for r in docs.collect():
        atoms[md5((r.text or "").encode()).hexdigest()[:4]] += len((r.text or "").encode()) + 16
    sizes = [atoms[k] for k in sorted(atoms)]

    def needed(most: int) -> int:
        n, used = 1, 0
        for x in sizes:
            n, used = (n + 1, x) if used + x > most else (n, used + x)
        return n

    best = next(c for c in range(max(sizes), sum(sizes) + 1) if needed(c) <= 5)
    assert max(sum(r.size for r in got if r.shard == s) for s in shards) <= best
    assert shard_documents(empty).count() == 0


def test_sharding_of_a_heavy_group_uses_all_shards(spark):
    rng = random.Random(6)
    for copies in (600, 60):
        rows = [(i, f"text {i} " + "x" * rng.randrange(50, 150)) for i in range(1200)] + [(5000 + i, "y" * 100) for i in range(copies)]
        got = shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 40).collect()
        loads: Counter = Counter()
        for r in got:
            loads[r.shard] += r.size
        assert set(loads) == set(range(40))
        heavy = copies * 116
        others = sorted(loads.values())[:-1]
        assert max(loads.values()) <= max(heavy, 2 * sum(loads.values()) / 40)
        assert min(others) > 0.5 * max(others)


def test_pieces_equal_the_library(spark, empty):
    import sentencepiece

    path = tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["Hello world  aaa\n\tx", None, "", "日本語 é 😀 abcabc", "x" * 100 + " abAB19" * 9, "  lead  ", " ", "==== ////"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pieces, first = sentencepieces.load_pieces(path), sentencepieces.first_byte_id(path)
    for r in sentencepieces.encode_documents(table, pieces, first).collect():
        assert r.ids == model.encode(texts[r.doc_id] or "") and r.decoded_ok
    assert sentencepieces.encode_documents(empty, pieces, first).count() == 0


def test_pipeline_stages(spark, data):
    import corpus_pipeline

    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_dedup", "substring_dedup", "secret_scan", "packing"]
    out = corpus_pipeline.run(spark, data)
    assert out.count() > 0 and out.where("length <= 0").isEmpty()


def test_null_and_repeated_ids_are_dealt_to_many_tasks(spark):
    rng = random.Random(12)
    texts = [" ".join(f"w{rng.randrange(50)}" for _ in range(60)) for _ in range(400)]
    rows = [(None if i < 150 else 7 if i < 300 else i, t) for i, t in enumerate(texts)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    whole = Counter(map(tuple, fingerprint_documents(table).collect()))
    assert Counter(map(tuple, fingerprint_documents(table, range_bytes=2000).collect())) == whole
    from sieveline.llm.fingerprints import _cuts, _range_of

    keyed = table.selectExpr("doc_id", "xxhash64(text) AS hash", "text")
    sizes = keyed.withColumn("range", _range_of(*_cuts(keyed, 2000))).groupBy("range").count().collect()
    assert max(r["count"] for r in sizes) < 60


def test_labels_of_equal_texts_count_once(spark):
    from sieveline.llm.quality import QualityConfig, measured, risk_tests

    texts = [" ".join(f"w{i}x{j}" for j in range(60)) for i in range(30)]
    rows = [(i, texts[i % 30], "*") for i in range(90)] + [(3, texts[3], "*")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(90)], "doc_id long, quality int")
    measures = measured(docs).selectExpr("*", "false AS base_failed")
    found = risk_tests(measures, labels, QualityConfig(min_good=10)).select("stratum", "n").distinct().collect()
    assert [tuple(r) for r in found] == [("*", 30)]


def test_ids_of_words_are_joined_and_long_words_forgotten():
    pieces = [(c, i + 300, 0.0) for i, c in enumerate("▁ab")] + [("ab", 310, -1.0), ("▁ab", 311, -2.0)]
    encoder = sentencepieces.Encoder(pieces, 3)
    texts = ["ab ab\u00e9", "a" * 100, "", "ab  b"]
    packed, spelled = encoder.packed(texts)
    assert [np.frombuffer(x, np.intc).tolist() for x in packed] == encoder.encode(texts)
    assert encoder.encode(texts)[0] == [311, 311, 3 + 0xC3, 3 + 0xA9]
    assert [sentencepieces.read(x) for x in spelled] == texts
    assert [sentencepieces.decode(x, encoder.raw) for x in encoder.encode(texts)] == texts
    assert max(map(len, encoder.known)) <= sentencepieces.MAX_LATTICE_CHARS and encoder.known.keys() == encoder.spelled.keys()


def test_ids_are_decoded_by_word_and_only_doubtful_texts_put_together(monkeypatch):
    pieces = [(c, i + 300, 0.0) for i, c in enumerate("▁ab")] + [("ab", 310, -1.0), ("▁ab", 311, -2.0), ("ba", 312, -1.0)]
    encoder = sentencepieces.Encoder(pieces, 3)
    asked = []
    read = sentencepieces.read
    monkeypatch.setattr(sentencepieces, "read", lambda x: asked.append(read(x)) or asked[-1])
    texts = ["ab ab\u00e9\U00010400", "a" * 100, "", "ab  b", "a▁b", "aba"]
    ids, same = encoder.checked(texts)
    assert same == [True, True, True, True, False, True] and asked == ["a b"]
    assert np.frombuffer(ids[0], np.intc).tolist()[-4:] == [3 + b for b in "\U00010400".encode()]
    assert np.frombuffer(ids[5], np.intc).tolist() == [311, 301]
    encoder.raw[312] = b"xx"
    encoder._forget()
    assert encoder.checked(["bba", "ab"])[1] == [False, True]


def test_white_space_of_any_length_is_encoded(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizers.path("byte_bpe_50k.json"))
    rows = [(i, "ab" + c * 2_000_000 + "cd 's") for i, c in enumerate((" ", "\t", "\n"))]
    pieces = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), RANKS, PATTERN, added=(("<|endoftext|>", 50256),))
    sizes = {r.doc_id: r.doc_tokens for r in pieces.select("doc_id", "doc_tokens").distinct().collect()}
    assert sizes == {i: len(whole.encode(t, add_special_tokens=False).ids) + 1 for i, t in rows}


def test_noise_and_unlearned_languages_go(spark):
    from sieveline.llm.language import keep_identified

    rng = random.Random(13)
    sets = {"aa": "sun moon star cloud river stone".split(), "bb": "хлеб вода земля небо огонь ветер".split()}
    clean = [(i, " ".join(rng.choice(sets[lang]) for _ in range(rng.randrange(40, 90))), lang) for i, lang in enumerate(["aa", "bb"] * 300)]
    noise = [(1000 + i, " ".join("".join(rng.choice("qxzjkv") for _ in range(6)) for _ in range(60)), None) for i in range(40)]
    noise += [(2000 + i, "\U00030000\U00030001 " * 40, None) for i in range(5)]
    kept = {r.doc_id for r in keep_identified(spark.createDataFrame(clean + noise, "doc_id long, text string, lang string")).collect()}
    assert len([i for i in kept if i < 1000]) >= 594 and not [i for i in kept if i >= 1000]


def test_cutoffs_come_from_every_labelled_document(spark):
    """20 rows of a length among 25,000 are enough for its cutoff; a sample would leave some of them out."""
    from sieveline.llm import language

    rows = [(i, "sun moon", "aa") for i in range(25_000)] + [(30_000 + i, "sun moon star cloud river stone", "aa") for i in range(20)]
    prototypes = {"aa": language.bundle(*language.counted("sun moon star cloud river stone"))}
    found = language.least_cosines(spark.createDataFrame(rows, "doc_id long, text string, lang string"), prototypes)
    assert {bits for _, bits in found} == {len(language.counted(t)[0]).bit_length() for t in ("sun moon", rows[-1][1])}


def test_language_steps_of_a_worker_stay_within_their_memory():
    """A batch of 8 MB of text in twelve languages; trigrams of all of it at once, or a cache for each language, take more."""
    import tracemalloc

    import pyarrow as pa

    from sieveline.llm import language

    class Docs:
        """Keeps the function that tasks would run."""

        def where(self, *_):
            return self

        select = where

        def mapInArrow(self, step, schema):  # noqa: N802
            self.step = step
            raise StopIteration

    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(200)]
    texts = [" ".join(rng.choice(words) for _ in range(1_150)) for _ in range(1_000)]
    batch = pa.RecordBatch.from_pydict({"text": texts, "lang": [f"l{i % 12}" for i in range(1_000)]})
    prototypes = {f"l{i}": language.bundle(*language.counted(texts[i])) for i in range(12)}
    for build in (language.train_prototypes, lambda docs: language.least_cosines(docs, prototypes)):
        docs = Docs()
        with pytest.raises(StopIteration):
            build(docs)
        tracemalloc.start()
        made = list(docs.step(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert sum(b.num_rows for b in made) in (12, 1_000)
        assert peak < 128 << 20


def test_long_texts_of_a_repeated_pair(spark):
    rows = [(i, "ab cd " * 150_000, "en") for i in range(3)] + [(9, "x", "en")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: (r.n_words, r.n_removed) for r in repeated_words(table).collect()}
    assert got == {0: (300_000, 0), 1: (300_000, 300_000), 2: (300_000, 300_000), 9: (1, 0)}


def test_rows_of_one_id_keep_one_whatever_the_order(spark):
    rows = [(1, f"text {i}", i) for i in range(5)] + [(2, "other", 0), (None, "x", 1), (None, "x", 1)]
    table = spark.createDataFrame(rows, "doc_id long, text string, n int")
    first = sorted(map(str, keep_one(table.repartition(5)).collect()))
    assert first == sorted(map(str, keep_one(table.repartition(2)).collect())) and len(first) == 4
