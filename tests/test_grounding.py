from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from sieveline.catalog.inputs import Inputs, encode
from sieveline.functions.stats import mean_ci, p_value, two_prop_z, wilson
from sieveline.operators import abtest, answers, grounding

PASSAGE = "array<struct<doc_id:string,title:string,text:string>>"


def one(spark, **columns):
    return spark.createDataFrame([tuple(columns.values())], ", ".join(columns))


def answer_frame(spark, *rows):
    schema = f"query_id string, condition string, seed int, answer string, passages {PASSAGE}, latency_ms double"
    return spark.createDataFrame(list(rows), schema)


def corrupt(spark, text, factor=None):
    df = spark.createDataFrame([(text,)], "t string")
    f = None if factor is None else F.lit(factor)
    return df.select(grounding.corrupt_text(F.col("t"), F.lit(42), F.lit("k"), f)).first()[0]


def python_corrupt(text, factor):
    def invert(m):
        other = grounding.DIRECTIONAL_SWAPS.get(m[0].lower())
        if other is None:
            return m[0]
        return other.title() if m[0][0].isupper() else other

    def scale(m):
        value = float(m[0]) * factor
        return "%d" % value if value.is_integer() else "%.2g" % value

    return re.sub(r"\b\d+(\.\d+)?\b", scale, re.sub(r"\w+", invert, text))


@pytest.mark.parametrize("factor", [10.0, 0.1])
@pytest.mark.parametrize(
    "text",
    [
        "increases by 30",
        "More than 12.5% of Higher values; 3 cases, 0.2 left, 1234 seen, x7y 8",
        "Éffective effective, emore more MORE associated",
        "7",
        "no change here",
        "",
        "a 0.001 b 0.00004 c 99999 d 10.0",
    ],
)
def test_corrupt_text_equals_plain_python(spark, text, factor):
    assert corrupt(spark, text, factor) == python_corrupt(text, factor)


@pytest.mark.parametrize("text", [
    "\U0001d400more \U0001f600more more\U0001d400 more\U0001f600", "\u017fuppress \u0130mproves MORE less_ _less less1 1.5less",
    "More", "more", "", "higher,lower;Higher lower", "unmore moreover \u0301more more\u0301",
])
def test_corrupt_text_changes_whole_words_alone(spark, text):
    assert corrupt(spark, text, 10.0) == python_corrupt(text, 10.0)
    plan = spark.range(1).select(grounding.corrupt_text(F.concat(F.lit(text), F.col("id")), F.lit(42), F.col("id")))
    found = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "[^\\p{L}\\p{N}_]+" not in found  # words that stay are not taken apart


def test_corrupt_text_uses_both_factors_and_repeats(spark):
    text = " ".join(str(n) for n in range(101, 160))
    got = corrupt(spark, text)
    assert got == corrupt(spark, text)
    pairs = list(zip(text.split(), got.split()))
    up = sum(b == a + "0" for a, b in pairs)
    assert 0 < up < len(pairs) and all(b == a + "0" or float(b) < float(a) for a, b in pairs)


def test_citations(spark):
    five = [(f"id{i}", "", "t") for i in range(1, 6)]
    df = answer_frame(spark, ("q", "normal", 1, "x [P1] [P9] [P1] [P0] [P99999999999]", five, 0.0))
    assert df.select(answers.cited_ids()).first()[0] == ["id1"]
    df = answer_frame(spark, ("q", "normal", 1, "[P3][P1] [P3]", five, 0.0))
    assert df.select(answers.cited_ids()).first()[0] == ["id3", "id1"]


def test_verdict_and_abstention(spark):
    rows = [("UNSUPPORTED claim", "SUPPORTED"), (" refuted by", "REFUTED"), ("Insufficient", "NOT ENOUGH INFO"), ("x" * 101 + "SUPPORTED", "UNKNOWN")]
    df = spark.createDataFrame(rows, "answer string, want string")
    assert all(r.v == r.want for r in df.select(answers.verdict().alias("v"), "want").collect())
    df = spark.createDataFrame([("Well, I DON'T know.",), ("I know",)], "answer string")
    assert [r[0] for r in df.select(answers.is_abstention()).collect()] == [True, False]


def test_prompt(spark):
    df = spark.createDataFrame([("Q?", [("a", "T", " body "), ("b", "", "x")]), ("Q?", [])], f"text string, passages {PASSAGE}")
    full, empty = [r.prompt for r in answers.build_prompts(df).collect()]
    assert full.endswith("Passages:\n[P1] — T\nbody\n\n[P2]\nx\n\nQuestion: Q?\n\nAnswer:")
    assert "Passages:\n(No passages provided.)\n\n" in empty


def test_similarity_and_response_type(spark):
    df = answer_frame(
        spark,
        ("q", "normal", 1, "abc abc", [], 0.0),
        ("q", "swapped_context", 1, "abc abc abc abc", [], 0.0),
        ("q", "random_in_domain", 1, "zzz", [], 0.0),
        ("q", "no_retrieval", 1, "I don't know", [], 0.0),
        ("q", "shuffled_order", 1, "  ", [], 0.0),
        ("lone", "swapped_context", 1, "abc", [], 0.0),
    ).withColumn("abstained", answers.is_abstention())
    rows = answers.with_response_type(answers.answer_similarity(df, encode)).collect()
    got = {(r.query_id, r.condition): (r.similarity_to_normal, r.response_type) for r in rows}
    assert got[("q", "normal")] == (1.0, "reference")
    assert got[("q", "swapped_context")] == (1.0, "both_answer_same")
    assert got[("q", "random_in_domain")] == (0.0, "content_change")
    assert got[("q", "no_retrieval")][1] == "abstention_shift"
    assert got[("q", "shuffled_order")] == (0.0, "content_change")
    assert got[("lone", "swapped_context")] == (0.0, "abstention_shift")


def test_faithfulness_and_support(spark):
    s1, s2 = "aaaa aaaa aaaa aaaa aaaa aaaa.", "zzzz zzzz zzzz zzzz zzzz zzzz."
    df = answer_frame(
        spark,
        ("half", "normal", 1, f"{s1} {s2} [P1] [P2]", [("p1", "", s1), ("p2", "", "bbbb bbbb bbbb bbbb bbbb bbbb.")], 0.0),
        ("blank", "normal", 1, f"{s1} [P1]", [("p1", "", " ")], 0.0),
        ("short", "normal", 1, "ok [P1]", [("p1", "", s1)], 0.0),
        ("uncited", "normal", 1, s1, [("p1", "", s1)], 0.0),
    )
    rows = {r.query_id: r for r in answers.grounding_rows(df, encode).collect()}
    assert (rows["half"].sentence_faithfulness, rows["half"].citation_support) == (0.5, 0.5)
    assert (rows["blank"].sentence_faithfulness, rows["blank"].citation_support) == (0.0, 0.0)
    assert (rows["short"].sentence_faithfulness, rows["short"].citation_support) == (None, None)
    assert (rows["uncited"].sentence_faithfulness, rows["uncited"].citation_support) == (1.0, None)


def test_condition_passages(spark):
    queries = spark.createDataFrame([(f"q{i}", "d") for i in range(9)] + [("lone", "e")], "query_id string, domain string")
    hits = queries.select(
        "query_id", F.posexplode(F.array(*[F.lit(i) for i in range(7)])).alias("p", "x")
    ).select(
        "query_id", (F.col("p") + 1).alias("rank"), F.concat("query_id", F.lit("-"), "x").alias("doc_id"),
        F.concat("query_id", F.lit("-"), "x").alias("chunk_id"), F.lit("").alias("title"), F.lit("more 5").alias("text"),
    )
    store = spark.range(13).select(
        F.when(F.col("id") < 11, "d").otherwise("e").alias("domain"),
        F.when(F.col("id") < 11, F.col("id")).otherwise(F.col("id") - 11).alias("chunk_ord"),
        F.concat(F.lit("r"), "id").alias("doc_id"), F.concat(F.lit("r"), "id").alias("chunk_id"),
        F.lit("").alias("title"), F.lit("t").alias("text"),
    )
    seeds = (1, 2)
    rows = grounding.condition_passages(queries, hits, store, seeds, 5).collect()
    by = {}
    for r in rows:
        by.setdefault((r.query_id, r.seed, r.condition), []).append((r.position, r.chunk_id, r.text))
    partners = {}
    for q in [f"q{i}" for i in range(9)]:
        for s in seeds:
            normal = sorted(by[(q, s, "normal")])
            assert [c for _, c, _ in normal] == [f"{q}-{i}" for i in range(5)]
            swapped = {c.split("-")[0] for _, c, _ in by[(q, s, "swapped_context")]}
            assert len(swapped) == 1 and q not in swapped
            partners.setdefault(s, set()).update(swapped)
            assert len({c for _, c, _ in by[(q, s, "random_in_domain")]}) == 5
            assert {c for _, c, _ in by[(q, s, "shuffled_order")]} == {c for _, c, _ in normal}
            assert all(t.startswith("less ") for _, _, t in by[(q, s, "corrupted_context")])
            assert (q, s, "no_retrieval") not in by
    assert all(len(p) == 9 for p in partners.values())
    assert {c.split("-")[0] for _, c, _ in by[("lone", 1, "swapped_context")]} == {"lone"}
    assert len(by[("lone", 1, "random_in_domain")]) == 2
    lists = grounding.passage_lists(queries, grounding.condition_passages(queries, hits, store, seeds, 5), seeds)
    sizes = {(r.query_id, r.condition): len(r.passages) for r in lists.collect()}
    assert len(sizes) == 60 and sizes[("q1", "no_retrieval")] == 0 and sizes[("q1", "normal")] == 5


def test_intervals(spark):
    df = spark.createDataFrame([(0, 10, 2.0, 1.0), (0, 0, 2.0, None)], "k long, n long, m double, sd double")
    low, high = wilson(F.col("k"), F.col("n"))
    ml, mh = mean_ci(F.col("m"), F.col("sd"), F.col("n"))
    a, b = df.select(low.alias("l"), high.alias("h"), ml.alias("ml"), mh.alias("mh")).collect()
    assert a.l == 0.0 and a.h == pytest.approx(0.2775, abs=1e-4)
    assert b.l is None and b.h is None and b.ml is None
    assert a.mh - a.ml == pytest.approx(2 * 1.96 / 10**0.5)


def test_p_values(spark):
    rows = [(2.228, 10.0, 0.05), (12.706, 1.0, 0.05), (1.96, None, 0.05), (3.169, 10.0, 0.01), (1.984, 100.0, 0.05), (0.0, 5.0, 1.0), (None, 5.0, 1.0), (float("inf"), 3.0, 0.0)]
    df = spark.createDataFrame(rows, "s double, d double, want double")
    for r in df.select(p_value("s", "d").alias("p"), "want").collect():
        assert r.p == pytest.approx(r.want, abs=2e-4)
    z = spark.range(1).select(two_prop_z(F.lit(10), F.lit(0), F.lit(10), F.lit(0)).alias("z")).first().z
    assert z == 0.0


def test_bh(spark):
    df = spark.createDataFrame([("d", 0.01), ("d", 0.04), ("d", 0.03), ("e", 0.9)], "domain string, p_value double")
    got = sorted((r.domain, r.p_value, round(r.p_adjusted, 6)) for r in abtest.bh_fdr(df).collect())
    assert got == [("d", 0.01, 0.03), ("d", 0.03, 0.04), ("d", 0.04, 0.04), ("e", 0.9, 0.9)]


def test_every_event_is_a_row_of_an_arm(spark, data):
    inputs = Inputs(spark, data)
    arms = inputs.arms.select("arm", "query_id", "condition", "seed").collect()
    assert len(arms) == len(set(arms)) == inputs.table("events").count()


def test_ab_test_invariants(spark, data):
    rows = abtest.ab_test(Inputs(spark, data).arms).collect()
    assert len(abtest.TESTS) == 21 and 0 < len(rows) <= 21
    for r in rows:
        assert 0 <= r.p_value <= r.p_adjusted <= 1
        assert r.wins + r.losses + r.ties == len(rows)
        assert r.test_type in ("z-test", "paired t-test", "t-test (unpaired)")
    ordered = sorted(rows, key=lambda r: r.p_value)
    assert all(a.p_adjusted <= b.p_adjusted + 1e-12 for a, b in zip(ordered, ordered[1:]))


def test_unpaired_and_missing_tests(spark):
    schema = "domain string, arm string, query_id string, seed int, condition string, abstained boolean, similarity_to_normal double, sentence_faithfulness double, citation_support double, response_type string"
    rows = [("d", "control", f"a{i}", 1, "normal", False, 0.1 * i, None, None, "reference") for i in range(4)]
    rows += [("d", "treatment", f"b{i}", 1, "normal", i == 0, 0.2 * i, None, None, "reference") for i in range(4)]
    got = {r.metric: r for r in abtest.ab_metric_stats(spark.createDataFrame(rows, schema)).collect()}
    assert set(got) == {"abstained", "similarity_to_normal"}
    sim = got["similarity_to_normal"]
    assert sim.test_type == "t-test (unpaired)" and sim.statistic == pytest.approx(1.0392305, abs=1e-6)
    assert sim.dof == pytest.approx(4.411765, abs=1e-6)


def test_summary_types_add_up(spark, data):
    for r in grounding.grounding_summary(Inputs(spark, data).arms, ["arm", "condition"]).collect():
        parts = r.content_change_rate + r.both_answer_same_rate + r.abstention_shift_rate + r.both_abstain_rate
        assert parts == pytest.approx(0.0 if r.condition == "normal" else 1.0)
