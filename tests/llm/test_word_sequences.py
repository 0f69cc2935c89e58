"""Decontamination, collocations and periodic runs against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest

from sieveline.llm import contamination, phrases
from sieveline.llm.contamination import contamination_report, decontaminate
from sieveline.llm.phrases import collocations, frequent_prefixes
from sieveline.llm.queries import with_periodic_ends
from sieveline.llm.runs import RUNS_DDL, Words, collapse_runs, find_runs, periodic_runs, re_pair, run_digests

DDL = "doc_id long, text string, lang string, source string, n_chars long, words string, n long, key long, items string, hash long"
CLASH = ("s", 1, "x", 1, 2, "y", 3)


def table(spark, rows):
    return spark.createDataFrame([(*r, *CLASH) for r in rows], DDL).repartition(3)


def normal(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def covered(words, benchmark, window):
    hit, items = set(), set()
    for item, text in benchmark:
        w = normal(text)
        k = min(window, len(w))
        grams = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if k else set()
        for i in range(len(words) - k + 1):
            if tuple(words[i : i + k]) in grams:
                hit.update(range(i, i + k))
                items.add(str(item))
    return hit, sorted(items)


@pytest.fixture(scope="module")
def benchmark_rows():
    rng = random.Random(3)
    out = [(i, " ".join(rng.choice(["Red", "blue", "GREEN", "é", "x1"]) for _ in range(rng.randrange(1, 9)))) for i in range(12)]
    return [*out, (12, out[0][1]), (20, None), (21, " -- "), (9, out[9][1])]


@pytest.fixture(scope="module")
def texts(benchmark_rows):
    rng = random.Random(4)
    out = []
    for i in range(60):
        w = [rng.choice(["red", "Blue", "green", "É", "x1", "z"]) for _ in range(rng.randrange(0, 40))]
        if i % 3 == 0:
            w += benchmark_rows[i % 12][1].upper().split()
        out.append((i, rng.choice([" ", ", ", "\n"]).join(w), rng.choice(["en", "de", None])))
    out += [(60, None, "en"), (61, "", "de"), (62, " \n\t...", None), (None, out[3][1], "en"), (63, out[6][1], "und")]
    return [*out, out[0], out[3], (5, out[6][1], "en")]


@pytest.mark.parametrize("blocked", [False, True])
def test_decontamination(spark, texts, benchmark_rows, monkeypatch, blocked):
    if blocked:
        monkeypatch.setattr(contamination, "BLOCK_WINDOWS", 7)
    docs = table(spark, texts)
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in benchmark_rows], "item_id long, text string, doc_id long")
    got = [(r.doc_id, r.n_words, r.n_hit, r.n_items, tuple(r["items"]), r.contaminated) for r in contamination_report(docs, benchmark, 4).collect()]
    want = []
    for doc_id, text, _ in texts:
        hit, items = covered(normal(text), benchmark_rows, 4)
        want.append((doc_id, len(normal(text)), len(hit), len(items), tuple(items), bool(hit)))
    assert Counter(got) == Counter(want)
    kept = decontaminate(docs, benchmark, 4)
    assert kept.columns == docs.columns
    left = Counter((r.doc_id, tuple(normal(r.text))) for r in kept.collect())
    expect = Counter()
    for doc_id, text, _ in texts:
        w = normal(text)
        hit, _ = covered(w, benchmark_rows, 4)
        rest = tuple(x for i, x in enumerate(w) if i not in hit)
        if rest or not hit:
            expect[(doc_id, rest)] += 1
    assert left == expect
    clean = decontaminate(docs, benchmark, 4, remove="documents")
    assert clean.count() == sum(not x[-1] for x in want)


def test_decontamination_of_empty_tables_and_long_text(spark, benchmark_rows):
    none = spark.createDataFrame([], DDL)
    benchmark = spark.createDataFrame(benchmark_rows, "item_id long, text string")
    assert contamination_report(none, benchmark).count() == 0
    rng = random.Random(9)
    words = [f"w{rng.randrange(999)}" for _ in range(220_000)]
    docs = table(spark, [(1, " ".join(words), "en")])
    assert [r.n_hit for r in contamination_report(docs, benchmark.limit(0)).collect()] == [0]
    planted = spark.createDataFrame([(7, " ".join(words[150_000:150_030]))], "item_id long, text string")
    assert [(r.n_words, r.n_hit) for r in contamination_report(docs, planted).collect()] == [(220_000, 30)]


def plain_collocations(rows, least, share, most):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f[lang].update(tuple(w[i : i + k]) for k in range(1, 6) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        frequent = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in frequent.items():
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            longer = [b for q, b in frequent.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if not any(100 * b >= share * a for b in longer):
                scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_collocations(spark, monkeypatch, small):
    if small:
        for name, value in (("CHUNK_WORDS", 60), ("TASK_SUFFIXES", 20), ("SHARE_ROWS", 6), ("MAP_BITS", 128)):
            monkeypatch.setattr(phrases, name, value)
    rng = random.Random(8)
    vocabulary = ["An", "b", "c", "É", "日本", "e f", "g'", "h"]
    rows = []
    for i in range(120):
        w = [rng.choice(vocabulary) + rng.choice(["", "", "", "", ".", "\n", ",x"]) for _ in range(rng.randrange(0, 60))]
        if i % 3 == 0:
            w += ["new", "york", "city", "hall", "of", "fame"] * rng.randrange(1, 4)
        rows.append((i, rng.choice([" ", "\t", "  "]).join(w), rng.choice(["en", "en", "de", None, "und"])))
    rows += [(200, None, "en"), (201, "", "fr"), (None, "new york city", "en"), rows[0], rows[3]]
    for share, most in ((100, 5), (60, 2000)):
        want = plain_collocations(rows, 12, share, most)
        assert Counter(map(tuple, collocations(table(spark, rows), 12, share, most).collect())) == Counter(want)
        assert len(want) > 10
    assert collocations(spark.createDataFrame([], DDL)).count() == 0


def test_long_text_collocations(spark):
    rng = random.Random(2)
    text = " ".join(f"w{rng.randrange(40)}" for _ in range(300_000))
    got = collocations(table(spark, [(1, text, "en")]), 7000).collect()
    assert got == [] or all(r.a >= 7000 for r in got)
    assert [tuple(r) for r in collocations(table(spark, [(1, "a b. " * 250_000, None)])).collect()] == [("und", 1, "a b", 250_000, 250_000, 250_000, 500_000, 2000)]


def test_suffixes_of_triples_that_are_not_frequent_stay_behind(spark, monkeypatch):
    """Every pair is frequent and no triple of different words: only "new york city hall" leaves its task."""
    kept = []
    stage = phrases.stage
    monkeypatch.setattr(phrases, "stage", lambda df, name: kept.append((name, out := stage(df, name))) or out)
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(30)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=400)), "en", "", 0) for i in range(120)]
    rows += [(200 + i, "new york city hall", "en", "", 0) for i in range(40)]
    words, counted = phrases.count_phrases(spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string"), 30)
    plain = Counter()
    for _, text, *_ in rows:
        w = text.split()
        plain.update(tuple(w[i : i + d]) for d in range(2, 6) for i in range(len(w) - d + 1))
    spelled = {r.key: r.word for r in words.collect()}
    got = {tuple(spelled[k] for k in r.words): r.n for r in counted.collect()}
    assert got == {p: n for p, n in plain.items() if n >= 30} and len(got) > 800
    assert dict(kept)["phrase-suffixes"].count() <= 4 * 16


def test_names_of_pairs_come_back_from_keys():
    words = np.random.default_rng(3).integers(1, 2**63, 1000).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    assert (phrases._second(phrases._pairs(words)[:-1], words[:-1]) == words[1:]).all()


def test_three_way_sort_counts_all_prefixes():
    rng = np.random.default_rng(1)
    rows = rng.integers(-2, 3, (400, 5))
    rows[rows == 0] = 7
    for row, end in zip(rows, rng.integers(2, 6, 400), strict=True):
        row[end:] = 0
    weight = rng.integers(1, 5, 400)
    want = Counter()
    for row, w in zip(rows.tolist(), weight.tolist(), strict=True):
        for d in range(2, 6):
            if row[d - 1]:
                want[tuple(row[:d] + [0] * (5 - d))] += w
    found, counts = frequent_prefixes(rows, weight, 9)
    assert dict(zip(map(tuple, found.tolist()), counts.tolist(), strict=True)) == {p: c for p, c in want.items() if c >= 9}


def plain_runs(w):
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def repetitive(rng):
    k, w = rng.choice([1, 2, 3, 10]), []
    while len(w) < rng.randrange(0, 90):
        part = [rng.choice("abcdefghij"[:k]) for _ in range(rng.randrange(1, 9))]
        w += part * rng.choice([1, 1, 4, 7])
        w = w[: len(w) - rng.choice([0, 0, 1, 2])]
    return w


def test_runs_of_many_texts():
    rng = random.Random(6)
    for _ in range(400):
        texts = [repetitive(rng) for _ in range(rng.randrange(1, 5))]
        words = Words.of([" ".join(w).encode() for w in texts])
        want = [(s + words.low[i], s + n + words.low[i], q) for i, w in enumerate(texts) for s, n, q in plain_runs(w)]
        assert [tuple(r) for r in find_runs(words).tolist()] == want


def test_grammar_derives_the_text():
    rng = random.Random(7)
    for _ in range(100):
        texts = [repetitive(rng) for _ in range(2)]
        words = Words.of([" ".join(w).encode() for w in texts])
        if not len(words.owner):
            continue
        grammar = re_pair(words)
        flat = [w for t in texts for w in t]
        spelled = defaultdict(set)
        for rule, start, cut, end in zip(grammar.rule, grammar.start, grammar.cut, grammar.end, strict=True):
            spelled[rule].add((tuple(flat[start:end]), cut - start))
            assert words.owner[start] == words.owner[end - 1]
        assert all(len(x) == 1 for x in spelled.values())
        assert min(Counter(grammar.rule.tolist()).values(), default=2) >= 2
        assert len(grammar.cut) + len(grammar.left) == len(flat) - sum(bool(t) for t in texts)


def plain_digests(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = crc32(str(doc_id).encode()), len(w)
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(w)
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    lines = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], *(sha256(x.encode()).hexdigest() for x in (lines, kept)))


def test_periodic_runs_query(spark):
    rng = random.Random(10)
    rows = [(i, rng.choice([" ", "\n", " \t"]).join(repetitive(rng) if i % 2 else [str(rng.randrange(50)) for _ in range(rng.randrange(0, 70))]), "en") for i in range(300)]
    rows += [(400, None, "en"), (401, "", "en"), (402, " \n ", None), (None, "a b " * 9, "en"), rows[1], rows[2], (7, rows[9][1], "en")]
    docs = table(spark, rows)
    got = Counter(map(tuple, run_digests(periodic_runs(with_periodic_ends(docs))).collect()))
    assert got == Counter(plain_digests(i, t) for i, t, _ in rows)
    assert periodic_runs(spark.createDataFrame([], DDL)).count() == 0
    assert dict(periodic_runs(docs).dtypes)["runs"] == RUNS_DDL.replace("long", "bigint")
    cut = collapse_runs(docs)
    assert cut.columns == docs.columns
    assert {r.text for r in cut.where("doc_id IS NULL").collect()} == {"a b"}
    assert [r.text for r in cut.where("doc_id = 402").collect()] == [" \n "]


def test_runs_of_very_long_texts(spark):
    rng = random.Random(11)
    words = [str(rng.randrange(10**6)) for _ in range(160_000)]
    period = words[:777]
    rows = [(1, "a " * 600_000, "en"), (2, " ".join(words[:1000] + period * 300 + words[1000:]), "en")]
    got = {r.doc_id: [tuple(x) for x in r.runs] for r in periodic_runs(table(spark, rows)).collect()}
    assert got[1] == [(0, 600_000, 1)]
    assert len(got[2]) == 1 and got[2][0][2] == 777 and got[2][0][1] >= 777 * 300
