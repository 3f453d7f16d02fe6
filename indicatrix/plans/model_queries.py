"""Registered queries for features, data split, models and their measures."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicatrix.functions.buckets import risk_level
from indicatrix.operators import features, gold, layers, matches, metrics, models
from indicatrix.plans.lookup_queries import feature_rows, listed
from indicatrix.plans.registry import query
from indicatrix.plans.standins import Tables, now
from indicatrix.session import materialise, scratch_dir

SPEC = models.FeatureSpec()


def training_rows(t: Tables) -> DataFrame:
    return models.training_table(features.with_membership(feature_rows(t), listed(t)))


@query(
    "k1_char_ngrams",
    """SELECT registered_domain, gram, count(*) AS n FROM (SELECT registered_domain, substr(registered_domain, CAST(i AS BIGINT), k) AS gram
      FROM (SELECT registered_domain, k, unnest(range(1, length(registered_domain) - k + 2)) AS i
        FROM (SELECT DISTINCT domain AS registered_domain, unnest([3, 4, 5]) AS k FROM label_row)))
    GROUP BY ALL""",
)
def k1_char_ngrams(t: Tables):
    return models.gram_table(t.labels_rd.select("registered_domain").distinct())


@query("k1_gram_vectors", "SELECT DISTINCT domain AS registered_domain, CASE WHEN length(domain) >= 3 THEN 1.0 ELSE 0.0 END AS squared_length FROM label_row")
def k1_gram_vectors(t: Tables):
    """Length of each hashed gram vector, at full width."""
    spec = models.FeatureSpec()
    hashed = reduce(lambda df, stage: stage.transform(df), models.vector_stages(spec)[:2], models.prepare(t.labels_rd.select("registered_domain").distinct(), spec))
    values = vector_to_array("gram_vector")
    return hashed.select(
        "registered_domain",
        F.round(F.aggregate(values, F.lit(0.0), lambda a, x: a + x * x), 6).alias("squared_length"),
    )


@query(
    "k2_category_vectors",
    """SELECT registered_domain, sample_asn, sample_isp, sample_country, registrar, status,
      CAST((sample_asn IS NOT NULL)::INT + (sample_isp IS NOT NULL)::INT + (sample_country IS NOT NULL)::INT + (registrar IS NOT NULL)::INT
        + (status IS NOT NULL)::INT AS INTEGER) AS categories FROM feature_row""",
)
def k2_category_vectors(t: Tables):
    """How many hashed categories each row has."""
    spec = models.FeatureSpec()
    hashed = models.vector_stages(spec)[2].transform(models.prepare(feature_rows(t), spec))
    total = F.aggregate(vector_to_array("category_vector"), F.lit(0.0), lambda a, x: a + x)
    return hashed.select("registered_domain", *features.CATEGORIES, total.cast("int").alias("categories"))


@query(
    "k3_numeric_block",
    """SELECT registered_domain, CAST(coalesce(num_unique_ips, 0) AS DOUBLE) AS num_unique_ips, CAST(coalesce(has_ipv6, 0) AS DOUBLE) AS has_ipv6,
      CAST(coalesce(num_countries, 0) AS DOUBLE) AS num_countries, CAST(coalesce(num_asns, 0) AS DOUBLE) AS num_asns,
      round(coalesce(age_days, 0), 6) AS age_days, round(coalesce(days_to_expiry, 0), 6) AS days_to_expiry,
      CAST(coalesce(created_isnull, 0) AS DOUBLE) AS created_isnull, CAST(coalesce(expires_isnull, 0) AS DOUBLE) AS expires_isnull,
      CAST(coalesce(has_error, 0) AS DOUBLE) AS has_error, 0.0 AS is_in_misp FROM feature_row""",
)
def k3_numeric_block(t: Tables):
    columns = [*features.DNS_FEATURES, *models.FeatureSpec().whois]
    rows = features.numeric_block(feature_rows(t), columns).select("registered_domain", *columns)
    return rows.withColumns({c: F.round(c, 6) for c in ("age_days", "days_to_expiry")})


@query("k4_vector_widths", "SELECT 'lexical' AS name, count(*) AS rows, CAST(4106 AS INTEGER) AS width FROM feature_row UNION ALL SELECT 'full', count(*), 4372 FROM feature_row")
def k4_vector_widths(t: Tables):
    """Rows and widths of the lexical and the full vector."""
    spec = models.FeatureSpec()
    prepared = models.prepare(features.with_membership(feature_rows(t), listed(t)), spec)
    parts = []
    for name, full in (("lexical", False), ("full", True)):
        vectors = reduce(lambda df, stage: stage.transform(df), models.vector_stages(spec, full), prepared)
        summary = vectors.select(Summarizer.metrics("count", "numNonZeros").summary(F.col("features")).alias("s"))
        nonzero = vector_to_array("s.numNonZeros")
        parts.append(
            summary.select(
                F.lit(name).alias("name"),
                F.col("s.count").alias("rows"),
                F.size(nonzero).alias("width"),
            )
        )
    return parts[0].unionByName(parts[1])


@query(
    "k5_stratified_split",
    """SELECT registered_domain, label, row_number() OVER (PARTITION BY label ORDER BY md5(concat(registered_domain, ':42')), registered_domain)
      <= ceil(count(*) OVER (PARTITION BY label) * 0.25) AS is_test FROM feature_row""",
)
def k5_stratified_split(t: Tables):
    rows = features.label_rows(layers.binary_labels(t.labels_rd)).select("registered_domain", "label")
    return models.split(rows).select("registered_domain", "label", "is_test")


@query(
    "k5_temporal_split",
    "SELECT registered_domain, label, last_first_seen >= TIMESTAMP '2001-01-01' AS is_test FROM feature_row",
)
def k5_temporal_split(t: Tables):
    rows = features.label_rows(layers.binary_labels(t.labels_rd)).select("registered_domain", "label", "last_first_seen")
    return models.split(rows, "last_first_seen", "2001-01-01").select("registered_domain", "label", "is_test")


_ROC = "sum(CAST(n AS DOUBLE) * (tp - p) + 0.5 * p * n) / max(CAST(tp_all AS DOUBLE) * fp_all)"
_AP = "sum(CAST(p AS DOUBLE) / tp_all * tp / (tp + fp))"
_R1 = "max(CASE WHEN CAST(fp AS DOUBLE) / fp_all <= 0.01 THEN CAST(tp AS DOUBLE) / tp_all ELSE 0 END)"


def _measure(name: str):
    def build(t: Tables):
        return metrics.evaluate(t.scored).select(F.round(name, 9).alias(name))

    return build


query("k6_roc_auc", f"SELECT round({_ROC}, 9) AS roc_auc FROM curve")(_measure("roc_auc"))
query("k7_average_precision", f"SELECT round({_AP}, 9) AS pr_auc FROM curve")(_measure("pr_auc"))
query("k8_recall_at_fpr", f"SELECT round({_R1}, 9) AS recall_at_1pct FROM curve")(_measure("recall_at_1pct"))


@query(
    "k9_class_weights",
    """SELECT doc_id, label, round(count(*) OVER () / (2.0 * count(*) OVER (PARTITION BY label)), 9) AS weight FROM scored""",
)
def k9_class_weights(t: Tables):
    return models.class_weights(t.scored).select("doc_id", "label", F.round("weight", 9).alias("weight"))


@query(
    "k14_model_comparison",
    f"""SELECT 'score' AS model, round({_ROC}, 9) AS roc_auc, round({_AP}, 9) AS pr_auc, round({_R1}, 9) AS recall_at_1pct FROM curve
    UNION ALL SELECT 'constant', 0.5, (SELECT avg(label) FROM scored), 0.0""",
)
def k14_model_comparison(t: Tables):
    table = metrics.compare({"score": t.scored, "constant": t.scored.withColumn("score", F.lit(0.5))})
    return table.withColumns({c: F.round(c, 9) for c in ("roc_auc", "pr_auc", "recall_at_1pct")})


def _fitted(t: Tables, estimator_of, full: bool = True) -> tuple[PipelineModel, DataFrame]:
    """A model of full width out of the training rows, and all rows."""
    rows = training_rows(t)
    return _trained(rows, estimator_of, full), rows


def _trained(rows: DataFrame, estimator_of, full: bool = True) -> PipelineModel:
    train = rows.filter(~F.col("is_test"))
    return models.train(train, estimator_of(train.count()), SPEC, full)


def _weighted_scores(model: PipelineModel, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Training rows with class weights and scores, and test rows with scores. All rows are scored once."""
    scored = materialise(models.score(model, rows, SPEC).select("registered_domain", "label", "is_test", "score"), "scored")
    return models.class_weights(scored.filter(~F.col("is_test"))), scored.filter("is_test")


_TEST_ROWS = "(SELECT CAST(sum(n) AS BIGINT) FROM (SELECT ceil(count(*) * 0.25) AS n FROM feature_row GROUP BY label))"


def logistic_facts(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Test rows scored, and whether the training rows' weighted residuals and the penalty of the constant feature cancel, as at the optimum."""
    train, test = _weighted_scores(model, rows)
    constant = float(model.stages[-1].coefficients[-1])
    pull = F.lit(constant * model.stages[-1].getRegParam())
    residual = F.abs(F.sum(F.col("weight") * (F.col("score") - F.col("label"))) / F.sum("weight") + pull)
    return test.agg(F.count_if(F.col("score").between(0, 1)).alias("test_rows")).withColumn("balanced", train.agg(residual < 1e-4).scalar())


def _logistic_facts(t: Tables, full: bool) -> DataFrame:
    return logistic_facts(*_fitted(t, models.logistic, full))


query("k10_logistic_lexical", f"SELECT {_TEST_ROWS} AS test_rows, true AS balanced")(lambda t: _logistic_facts(t, False))
query("k10_logistic_full", f"SELECT {_TEST_ROWS} AS test_rows, true AS balanced")(lambda t: _logistic_facts(t, True))


def measures(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Rows and measures of held-out rows, and the weighted loss of training rows."""
    train, test = _weighted_scores(model, rows)
    score = F.greatest(F.lit(1e-15), F.least(F.lit(1 - 1e-15), F.col("score")))
    loss = F.sum(-F.col("weight") * F.log(F.when(F.col("label") == 1, score).otherwise(1 - score))) / F.sum("weight")
    return metrics.evaluate(test).withColumns({"train_loss": train.agg(loss).scalar(), "test_rows": test.agg(F.count("*")).scalar()})


@query("k10_logistic_measures")
def k10_logistic_measures(t: Tables):
    """What the full linear model is worth on held-out domains."""
    return measures(*_fitted(t, models.logistic)).select("test_rows", "roc_auc", "pr_auc", "recall_at_1pct", "train_loss")


@query("k11_boosted_trees")
def k11_boosted_trees(t: Tables):
    """What boosted trees with all their rounds and leaves are worth on held-out domains."""
    model, rows = _fitted(t, lambda n: models.boosted())
    _, trees = model.stages[-1].content()
    leaves = max(sum(f < 0 for f in tree.feature) for tree in trees)
    return measures(model, rows).select(
        F.lit(len(trees)).alias("trees"), F.lit(leaves).alias("most_leaves"), "test_rows", "roc_auc", "pr_auc", "recall_at_1pct", "train_loss"
    )


@query(
    "k12_model_registry",
    """SELECT registered_domain, label, true AS same_score FROM (SELECT registered_domain, label,
      row_number() OVER (PARTITION BY label ORDER BY md5(concat(registered_domain, ':42')), registered_domain) <= ceil(count(*) OVER (PARTITION BY label) * 0.25) AS is_test
      FROM feature_row) WHERE is_test""",
)
def k12_model_registry(t: Tables):
    """Held-out domains scored by a model and by what the registry gives back as the newest of two."""
    registry = scratch_dir(t.spark, "registry")
    model, rows = _fitted(t, models.logistic)
    test = rows.filter("is_test")
    counts = features.dataset_counts(test).first().asDict()
    old = Pipeline(stages=models.vector_stages(SPEC)).fit(models.prepare(test.limit(1), SPEC))
    models.register(old, registry, "features", "2024-01-01 00:00:00", counts, {"roc_auc": 0.5})
    models.register(model, registry, "logistic", "2024-02-01 00:00:00", counts, {"roc_auc": 0.5})
    before = models.score(model, test, SPEC).withColumnRenamed("score", "before")
    after = models.score(models.newest(t.spark, registry), before, SPEC)
    return after.select("registered_domain", "label", (F.col("before") == F.col("score")).alias("same_score"))


@query(
    "a21_model_metadata",
    """SELECT 'features-2' AS model_file, count(*) AS n_rows, count(*) FILTER (WHERE label = 1) AS n_pos, count(*) FILTER (WHERE label = 0) AS n_neg, CAST(0.75 AS DOUBLE) AS roc_auc
    FROM feature_row""",
)
def a21_model_metadata(t: Tables):
    """The metadata row of the newest of two registered pipelines."""
    registry = scratch_dir(t.spark, "registry")
    rows = feature_rows(t)
    counts = features.dataset_counts(rows).first().asDict()
    pipeline = Pipeline(stages=models.vector_stages(SPEC)).fit(models.prepare(rows, SPEC))
    for n, auc in ((1, 0.5), (2, 0.75)):
        models.register(pipeline, registry, f"features-{n}", f"2024-02-0{n} 00:00:00", counts, {"roc_auc": auc})
    meta = models.newest_meta(t.spark, registry)
    return meta.select("model_file", "n_rows", "n_pos", "n_neg", "metrics.roc_auc")


def _threats(t: Tables) -> tuple[DataFrame, DataFrame]:
    """All domains with their scores, and the threat table out of them."""
    # Training and scoring read the same sides; each is worked out once and stored.
    addresses = materialise(matches.dns_summary_with_overlap(t.dns_geo, matches.listed_ips(t.misp_attr)), "addresses")
    registrations = materialise(features.whois_rows(t.whois, now()), "registrations")
    names = materialise(listed(t), "listed-domains")
    known = features.feature_rows(
        layers.binary_labels(t.labels_rd), t.dns_geo, t.whois, now(), addresses=addresses.drop("matched_misp_ip"), registrations=registrations
    )
    training = models.training_table(features.with_membership(known, names))
    model = _trained(training, models.logistic)
    rows = gold.scored_rows(t.labels_rd, t.dns_geo, t.whois, t.misp_attr, now(), addresses, registrations, names)
    scored = materialise(models.score(model, rows, SPEC), "scored")
    return scored, gold.assemble(scored)


@query(
    "k13_scored_threats",
    """SELECT domain, url, "firstSeen", label, source, "threatType", country, registrar, "domainAgeDays", true AS level_fits FROM threat_row""",
)
def k13_scored_threats(t: Tables):
    """Train, score all domains with their list flags, publish the threat table; levels have to follow from scores."""
    _, threats = _threats(t)
    score, listed = F.col("riskScore"), F.col("source") == "misp_osint"
    # Published scores are rounded, levels are not.
    near = F.exists(F.array(*[F.lit(x) for x in (0.2, 0.6, 0.9)]), lambda x: F.abs(score - x) < 1e-4)
    fits = F.when(listed, (score == 1.0) & (F.col("riskLevel") == "CRITICAL")).otherwise(near | (F.col("riskLevel") == risk_level(score)))
    return threats.withColumn("level_fits", fits).drop("riskScore", "riskLevel")


@query("k13_published_scores")
def k13_published_scores(t: Tables):
    """The threat table with its scores and levels, beside what the model said."""
    scored, threats = _threats(t)
    said = scored.select(F.col("registered_domain").alias("domain"), F.round("score", 9).alias("model_score"))
    return threats.select("domain", "source", "riskScore", "riskLevel", "domainAgeDays").join(said, "domain")
