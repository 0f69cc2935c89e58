"""Query-domain classification: data, model, predictions and their metrics."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.config import BASE_SEED
from sieveline.functions.text import is_train_query, md5_of, strip
from sieveline.operators.ranking import bucketed_rank, first_n_by_hash, hash_bucket


def train_eval_split(queries: DataFrame) -> DataFrame:
    """``split`` is ``train`` for about 70 % of the ids, by md5, else ``eval``."""
    return queries.withColumn(
        "split", F.when(is_train_query("query_id"), "train").otherwise("eval")
    )


def title_candidates(docs: DataFrame, longer_than: int = 15) -> DataFrame:
    """Distinct stripped titles that are long enough to carry a domain signal."""
    titles = docs.select("domain", strip("title").alias("title"))
    return titles.filter(F.length("title") > longer_than).distinct()


def training_queries(queries: DataFrame, qrels: DataFrame) -> DataFrame:
    """Queries without judgements, and judged ones of the training split."""
    judged = qrels.select("query_id").distinct().withColumn("_judged", F.lit(True))
    joined = queries.join(judged, "query_id", "left")
    keep = F.col("_judged").isNull() | is_train_query("query_id")
    return joined.filter(keep & F.col("text").isNotNull()).drop("_judged")


def class_balance(
    queries: DataFrame,
    titles: DataFrame,
    seeds: DataFrame,
    min_per_domain: int,
    max_per_domain: int,
    seed: int = BASE_SEED,
) -> DataFrame:
    """Training texts between the bounds for every domain of ``seeds``.

    Below the minimum, titles are added and then the domain's seed texts in a
    cycle; above the maximum, a repeatable sample stays. ``seeds``: domain, seeds
    (array of texts). Returns domain, text, origin, item.
    """
    capped = first_n_by_hash(
        queries.select("domain", "query_id", "text"),
        ["domain"],
        md5_of(F.lit(seed), "query_id"),
        max_per_domain,
        [F.col("query_id")],
    )
    n_queries = queries.groupBy("domain").agg(F.count(F.lit(1)).alias("nq"))
    need = seeds.join(n_queries, "domain", "left").select(
        "domain",
        "seeds",
        F.greatest(F.lit(min_per_domain) - F.coalesce("nq", F.lit(0)), F.lit(0)).alias("need"),
    )
    added = first_n_by_hash(
        titles.join(need.select("domain", "need").filter("need > 0"), "domain"),
        ["domain", "need"],
        md5_of(F.lit(seed), "domain", "title"),
        F.col("need"),
        [F.col("title")],
    )
    n_titles = added.groupBy("domain").agg(F.count(F.lit(1)).alias("nt"))
    short = need.join(n_titles, "domain", "left").withColumn(
        "short", (F.col("need") - F.coalesce("nt", F.lit(0))).cast("int")
    )
    repeated = (
        short.filter((F.col("short") > 0) & (F.size("seeds") > 0))
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("short") - 1)))
        .select(
            "domain",
            F.get("seeds", F.col("i") % F.size("seeds")).alias("text"),
            F.lit("seed").alias("origin"),
            F.col("i").cast("string").alias("item"),
        )
    )
    return (
        capped.select("domain", "text", F.lit("query").alias("origin"), F.col("query_id").alias("item"))
        .unionByName(
            added.select(
                "domain", F.col("title").alias("text"), F.lit("title").alias("origin"),
                F.col("title").alias("item"),
            )
        )
        .unionByName(repeated)
    )


def stratified_validation(texts: DataFrame, fraction: float = 0.2, seed: int = BASE_SEED) -> DataFrame:
    """Adds ``is_validation``: the md5-smallest ``fraction`` of each domain."""
    keyed = texts.withColumn("_key", md5_of(F.lit(seed), "domain", "origin", "item")).withColumn(
        "_bucket", hash_bucket("_key")
    )
    ranked = bucketed_rank(keyed, ["domain"], "_bucket", [F.col("_key"), F.col("item")], "_r")
    sizes = texts.groupBy("domain").agg(F.count(F.lit(1)).alias("_n"))
    return (
        ranked.join(sizes, "domain")
        .withColumn("is_validation", F.col("_r") <= F.floor(F.col("_n") * F.lit(fraction)))
        .drop("_key", "_bucket", "_r", "_n")
    )


def train_domain_classifier(
    texts: DataFrame, features: int = 1 << 15, max_iter: int = 20, fraction: float = 0.2
) -> tuple[PipelineModel, DataFrame]:
    """Fit text to domain; returns the model and its validation accuracies."""
    split = stratified_validation(texts, fraction)
    stages = [
        StringIndexer(inputCol="domain", outputCol="label", stringOrderType="alphabetAsc"),
        RegexTokenizer(inputCol="text", outputCol="_words", pattern=r"[^\p{L}\p{N}]+"),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=features),
        IDF(inputCol="_tf", outputCol="_idf"),
        Normalizer(inputCol="_idf", outputCol="features"),  # long and short texts weigh alike
        LogisticRegression(maxIter=max_iter, regParam=0.001, probabilityCol="probability"),
    ]
    model = Pipeline(stages=stages).fit(split.filter(~F.col("is_validation")))
    validated = predict(model, split.filter("is_validation"))
    metrics = validated.agg(
        F.count(F.lit(1)).alias("n_validation"),
        F.avg((F.col("top1_domain") == F.col("domain")).cast("double")).alias("top1_accuracy"),
        F.avg(
            ((F.col("top1_domain") == F.col("domain")) | F.col("top2_domain").eqNullSafe(F.col("domain")))
            .cast("double")
        ).alias("top2_accuracy"),
    )
    return model, metrics


def predict(model: PipelineModel, texts: DataFrame) -> DataFrame:
    """Class probabilities of a fitted pipeline, as classified rows."""
    indexer, *rest = model.stages
    labels = F.array(*[F.lit(x) for x in indexer.labels])
    scored = PipelineModel(list(rest)).transform(texts)
    probs = F.arrays_zip(labels.alias("domain"), vector_to_array("probability").alias("p"))
    pairs = F.transform(probs, lambda s: F.struct(s["domain"].alias("domain"), s["p"].alias("p")))
    kept = [c for c in texts.columns]
    return classify_queries(scored.select(*kept, pairs.alias("probs")))


def classify_queries(probabilities: DataFrame) -> DataFrame:
    """Top-1, top-2 and the map of all probabilities.

    ``probs`` is an array of ``struct<domain, p>``; equal probabilities are
    ordered by domain.
    """
    keyed = F.transform("probs", lambda s: F.struct((-s["p"]).alias("np"), s["domain"].alias("d")))
    ordered = probabilities.withColumn("_o", F.array_sort(keyed))
    return ordered.select(
        *[c for c in probabilities.columns if c != "probs"],
        F.get("_o", F.lit(0))["d"].alias("top1_domain"),
        (-F.get("_o", F.lit(0))["np"]).alias("top1_prob"),
        F.get("_o", F.lit(1))["d"].alias("top2_domain"),
        (-F.get("_o", F.lit(1))["np"]).alias("top2_prob"),
        F.map_from_entries("probs").alias("all_probs"),
    )


def routing_samples(queries: DataFrame, qrels: DataFrame, per_domain: int = 200) -> DataFrame:
    """At most ``per_domain`` held-out judged queries of each domain."""
    held_out = queries.join(qrels.select("query_id").distinct(), "query_id", "left_semi").filter(
        ~is_train_query("query_id")
    )
    return first_n_by_hash(
        held_out, ["domain"], md5_of(F.lit(BASE_SEED), "query_id"), per_domain, [F.col("query_id")]
    )


def routing_metrics(classified: DataFrame, truth: str = "domain") -> DataFrame:
    """Top-1 and top-2 accuracy, macro F1 over the true domains, sample count.

    Everything is read from one confusion table, at most classes squared rows.
    """
    confusion = classified.groupBy(F.col(truth).alias("t"), F.col("top1_domain").alias("p")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("top2_domain").eqNullSafe(F.col(truth))).alias("second"),
    )
    actual = confusion.groupBy(F.col("t").alias("label")).agg(
        F.sum("n").alias("support"),
        F.sum(F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(F.lit(0))).alias("tp"),
        F.sum(F.when(F.col("t") != F.col("p"), F.col("second")).otherwise(F.lit(0))).alias("second"),
    )
    predicted = confusion.groupBy(F.col("p").alias("label")).agg(F.sum("n").alias("predicted"))
    per_label = actual.join(predicted, "label", "left").withColumn(
        "f1",
        2.0 * F.col("tp") / (F.col("support") + F.coalesce("predicted", F.lit(0))),
    )
    total = F.sum("support")
    return per_label.agg(
        F.round(F.sum("tp") / total, 4).alias("top1_accuracy"),
        F.round((F.sum("tp") + F.sum("second")) / total, 4).alias("top2_accuracy"),
        F.round(F.avg("f1"), 4).alias("macro_f1"),
        total.alias("n_total"),
    )


def routing_by_domain(classified: DataFrame, truth: str = "domain") -> DataFrame:
    return classified.groupBy(F.col(truth).alias("domain")).agg(
        F.round(F.avg((F.col("top1_domain") == F.col(truth)).cast("double")), 4).alias(
            "top1_accuracy"
        ),
        F.count(F.lit(1)).alias("n_queries"),
        F.round(F.avg("top1_prob"), 4).alias("mean_confidence"),
    )
