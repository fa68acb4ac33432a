"""Registered queries: classifiers, scoring routes, evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quireflow.functions import hashing, text
from quireflow.operators import classify, embed, evaluate, gate, labels, prepare, registry, score, sequences, splits
from quireflow.contracts import PREDICTION_COLUMNS
from quireflow.plans import features as feature_queries
from quireflow.plans import sqltext as q
from quireflow.plans.tables import document_pages, load, turn_pages
from quireflow.session import stored


# ---- vectors --------------------------------------------------------------------------

def _centroid_scored(spark, d):
    vecs = load(spark, d, "embeddings")
    model = classify.fit_centroids(vecs, "label", "embedding")
    return classify.classify_by_centroid(vecs, model, "embedding", "label")


def _centroid_nearest(spark, d):
    vecs = load(spark, d, "embeddings")
    return classify.nearest_class(vecs, classify.fit_centroids(vecs, "label", "embedding"), "embedding", "label")


def nearest_centroid(spark, d):
    return _centroid_nearest(spark, d).select(
        "vec_id", "label", "predicted", F.round("probability", 5).alias("score")
    )


def _centroid_pairs(spark, d):
    return evaluate.confusion(_centroid_nearest(spark, d), "label", "predicted")


def confusion_matrix(spark, d):
    return _centroid_pairs(spark, d)


def confusion_matrix_wide(spark, d):
    """The columns follow the dictionary of the classes."""
    named = labels.label_index(load(spark, d, "embeddings")).select("label").distinct().orderBy("label")
    return evaluate.confusion_wide(_centroid_pairs(spark, d), [r["label"] for r in named.collect()])


def confusion_normalised(spark, d):
    return evaluate.confusion_share(_centroid_pairs(spark, d)).select(
        "actual", "predicted", F.round("share", 6).alias("share")
    )


def _rounded(report):
    return report.select("cls", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "support")])


def classification_report(spark, d):
    return _rounded(evaluate.class_report(_centroid_pairs(spark, d)))


def classification_report_missing(spark, d):
    """Class list with names that never occur: they are listed, and the accuracy row
    becomes the micro average."""
    pairs = evaluate.confusion(_bayes_scored(spark, d), "label", "class")
    listed = document_pages(spark, d).select(F.col("label").alias("cls")).union(
        turn_pages(spark, d).select("label")
    ).distinct()
    return _rounded(evaluate.class_report(pairs, listed))


def accuracy_loss(spark, d):
    scored = _centroid_scored(spark, d).withColumn(
        "loss", evaluate.cross_entropy("scores", "label_id")
    )
    return evaluate.accuracy_and_loss(scored, "label", "predicted", "loss").select(
        F.round("acc", 6).alias("acc"), F.round("loss", 6).alias("loss")
    )


def accuracy_loss_batched(spark, d):
    """Per split; the loss is the mean over batch means."""
    scored = splits.with_split(_centroid_scored(spark, d), "vec_id", cuts=splits.CUTS_60_20_20).withColumn(
        "loss", evaluate.cross_entropy("scores", "label_id")
    ).withColumn("batch", F.floor(F.col("vec_id") / 4))
    return evaluate.accuracy_and_loss(
        scored, "label", "predicted", "loss", batch="batch", by=("split",)
    ).select("split", F.round("acc", 6).alias("acc"), F.round("loss", 6).alias("loss"))


def run_metrics(spark, d):
    """Metrics of one run as rows, one set per split."""
    scored = splits.with_split(_centroid_scored(spark, d), "vec_id", cuts=splits.CUTS_60_20_20).withColumn(
        "loss", evaluate.cross_entropy("scores", "label_id")
    )
    rows = registry.metric_rows(
        scored, "centroid-1", "split", acc=evaluate.accuracy("label", "predicted"), loss=F.avg("loss")
    )
    return rows.select("run_id", "step", "metric", F.round("value", 6).alias("value"))


def accuracy_loss_extreme(spark, d):
    """Scores a thousand times as far apart: the true class's probability is often no
    number above zero, its loss still one."""
    scored = _centroid_scored(spark, d).withColumn("scores", F.transform("scores", lambda x: x * 1000))
    scored = scored.withColumn("loss", evaluate.cross_entropy("scores", "label_id"))
    return evaluate.accuracy_and_loss(scored, "label", "predicted", "loss").select(
        F.round("acc", 6).alias("acc"), F.round("loss", 3).alias("loss")
    )


# ---- text -----------------------------------------------------------------------------

def _is_training():
    return hashing.stable_bucket(1000, "dcn", "page") < 900


def _counted(spark, d):
    """Stored bucket counts of all pages: texts are read and cleaned once for the fit and
    the scoring."""
    return stored(classify.page_counts(document_pages(spark, d), "text").drop("text"), "counts")


def _bayes(spark, d):
    pages = _counted(spark, d)
    return pages, classify.fit_text_model(pages.where(_is_training()), None)


def _bayes_scored(spark, d):
    pages, model = _bayes(spark, d)
    return classify.apply_text_model(pages, model, None)


def naive_bayes_lang(spark, d):
    return _bayes_scored(spark, d).select("dcn", "page", "label", F.col("class").alias("predicted"))


def score_pages(spark, d):
    """The scoring wrapper: upper-case label and probability for every page."""
    pages, model = _bayes(spark, d)
    return score.score_pages(pages, model, None).select(
        "dcn", "page", "pred_label", F.round("pred_score", 6).alias("pred_score"))


def score_by_partition(spark, d):
    pages, model = _bayes(spark, d)
    scored = score.score_by_partition(
        score.count_arrays(pages), ["dcn", "page"], "counts", score.count_predictor(model))
    return score.with_names(scored, model, "class_id", "Label").select(
        "dcn", "page", "Label", F.round(F.col("Score").cast("double"), 4).alias("Score"),
        (F.col("ElapsedTime") > 0).alias("timed"))


def _column_scored(spark, d):
    """Model as a column function, through the compatible array of strings and back."""
    pages, model = _bayes(spark, d)
    call = score.score_column("counts", score.count_predictor(model), 16**model.digits)
    called = score.unpack_struct(score.count_arrays(pages).select("dcn", "page", call.alias("predictions")))
    named = score.with_names(called, model, "class_id", "pred_label")
    listed = named.select("dcn", "page", score.as_strings("pred_label", "pred_score", "pred_elapsed_time").alias("predictions"))
    return score.unpack_strings(listed).withColumns({
        c: F.col(c).cast("double") for c in ("pred_score", "pred_elapsed_time")})


def score_column(spark, d):
    return _column_scored(spark, d).select(
        "dcn", "page", "pred_label", F.round("pred_score", 6).alias("pred_score"),
        (F.col("pred_elapsed_time") > 0).alias("timed"))


EPOCHS, RATE = 3, 2.0


def _linear_fit(spark, vec, frame):
    """Features with class ids and splits, stored once, and the model fitted on them."""
    frame = stored(frame, "features")
    dictionary = labels.label_index(frame)
    coded = labels.attach_label_id(frame, stored(dictionary, "classes"))
    named = stored(splits.with_split(coded, "dcn", "page").select("dcn", "page", "label_id", "split", vec), "training")
    classes = named.agg(F.max("label_id")).first()[0] + 1
    return classify.fit_linear(named, vec, "label_id", classes, EPOCHS, RATE)


def _full_chunks(spark, d):
    pages = prepare.silver(prepare.bronze(document_pages(spark, d)), "all")
    chunks = prepare.gold(pages, 200, 50, full_split=True, drop_empty=True)
    return embed.hashed_embedding(chunks, text.words(F.col("text_chunk")), digits=1)


def _metric_rows(spark, model, run_id):
    rows = classify.linear_metrics(spark, model, run_id)
    return rows.select("run_id", "step", "split", "metric", F.round("value", 4).alias("value"))


def lr_chunk_classifier(spark, d):
    """Every chunk classified by a linear model over its embedding; loss and accuracy per
    epoch and split."""
    vecs = _full_chunks(spark, d).select("dcn", "page", "index", "label", "embedding")
    return _metric_rows(spark, _linear_fit(spark, "embedding", vecs), "chunks-1")


def page_sequence_classifier(spark, d):
    """Pages classified by the mean of their chunk vectors; metrics per epoch and split."""
    pages = sequences.pool(_full_chunks(spark, d), ["dcn", "page", "label"], "embedding")
    pages = pages.withColumn("mean", F.col("mean").cast("array<float>"))
    return _metric_rows(spark, _linear_fit(spark, "mean", pages), "pages-1")


def model_embedding(spark, d):
    """A caller's model as embedding function: here the length and the vowels of a turn."""

    def load_model():
        import numpy as np

        def predict(texts):
            return np.array(
                [[len(t), *[t.count(v) for v in "aeiou"]] for t in texts.reshape(-1)], dtype="float32"
            )

        return predict

    pages = turn_pages(spark, d).select(
        "dcn", "page", embed.model_embedding(load_model, "text").alias("emb")
    )
    return pages.select("dcn", "page", F.array_join(F.col("emb").cast("array<int>").cast("array<string>"), " ").alias("emb"))


# ---- gate -----------------------------------------------------------------------------

def _checks(spark, d):
    return gate.check_rows(document_pages(spark, d), _column_scored(spark, d), PREDICTION_COLUMNS, ["dcn", "page"])


def validation_report(spark, d):
    return _checks(spark, d)


def validation_decision(spark, d):
    return gate.decide(_checks(spark, d), "Staging")


def _broken(spark, d):
    """Scored rows of which some are lost, doubled, without label or out of range."""
    left = F.col("page").cast("bigint") % 50
    scored = _column_scored(spark, d).where(left != 3)
    scored = scored.unionByName(scored.where(left == 7))
    return scored.withColumn("pred_label", F.when(left != 11, F.col("pred_label"))).withColumn(
        "pred_score", F.when(left == 13, 1.5).otherwise(F.col("pred_score")))


def _broken_checks(spark, d):
    return gate.check_rows(document_pages(spark, d), _broken(spark, d), PREDICTION_COLUMNS, ["dcn", "page"])


def validation_report_bad(spark, d):
    return _broken_checks(spark, d)


def validation_reject(spark, d):
    return gate.decide(_broken_checks(spark, d), "Staging")


def validation_empty(spark, d):
    """A scoring run that fails stands for no predictions at all."""
    contract = T.StructType([*document_pages(spark, d).select("dcn", "page").schema.fields, *PREDICTION_COLUMNS.fields])

    def fails():
        return document_pages(spark, d).select("dcn", "page", F.raise_error(F.lit("no model")).cast("string").alias("pred_label"))

    scored = gate.predictions_or_empty(spark, fails, contract)
    return gate.check_rows(document_pages(spark, d), scored, PREDICTION_COLUMNS, ["dcn", "page"])


def validation_schema(spark, d):
    """Two sets whose columns break the contract, one by a type and one by a column that is not
    there: the checks of each, and the decision they lead to."""
    scored = stored(document_pages(spark, d).select(
        "dcn", "page", F.upper("label").alias("pred_label"), F.lit(0.5).alias("pred_score"),
        F.lit(1.0).alias("pred_elapsed_time")), "scored")
    pages = document_pages(spark, d)
    cases = {"type": scored.withColumn("pred_score", F.col("pred_score").cast("string")),
             "missing": scored.drop("pred_elapsed_time"), "good": scored}
    out = []
    for name, rows in cases.items():
        checks = stored(gate.check_rows(pages, rows, PREDICTION_COLUMNS, ["dcn", "page"]), "checks")
        decision = gate.decide(checks, "Staging").first()["decision"]
        out.append(checks.select(F.lit(name).alias("case"), "check", "ok", "detail", F.lit(decision).alias("decision")))
    return out[0].unionByName(out[1]).unionByName(out[2])


QUERIES = {
    f.__name__: f for f in (
        nearest_centroid, confusion_matrix, confusion_matrix_wide, confusion_normalised,
        classification_report, classification_report_missing, accuracy_loss, accuracy_loss_batched, accuracy_loss_extreme,
        run_metrics, naive_bayes_lang, score_pages, score_by_partition, score_column,
        lr_chunk_classifier, page_sequence_classifier, model_embedding,
        validation_report, validation_decision, validation_report_bad, validation_reject, validation_empty,
        validation_schema,
    )
}

_CENTROID = """cells AS (SELECT vec_id, label, unnest(range(64)) AS dim, unnest(embedding)::DOUBLE AS v FROM embeddings),
  centroids AS (SELECT label AS cls, dim, avg(v) AS c FROM cells GROUP BY ALL),
  dist AS (SELECT vec_id, label, cls, -sum((v - c) * (v - c)) AS s FROM cells JOIN centroids USING (dim) GROUP BY ALL),
  probs AS (SELECT *, exp(s - m) / sum(exp(s - m)) OVER (PARTITION BY vec_id) AS p
    FROM (SELECT *, max(s) OVER (PARTITION BY vec_id) AS m FROM dist)),
  scored AS (SELECT vec_id, label, arg_max(cls, s) AS predicted, max(p) AS score,
    ln(sum(exp(s - m))) + any_value(m) - max(CASE WHEN cls = label THEN s END) AS loss FROM probs GROUP BY ALL)"""


def _linear_sql(vectors: str, run_id: str) -> str:
    """Full-batch gradient steps, an epoch after another. ``vectors``: rows ``id, dcn, page,
    label, dim, v`` with all dimensions; the intercept is one more."""
    split = q.split_name(q.bucket(1000, "dcn", "page"), splits.CUTS_90_5_5)
    steps = []
    for e in range(EPOCHS + 1):
        weight = "0.0::DOUBLE" if e == 0 else "w.w"
        join = "" if e == 0 else f"JOIN w{e} w USING (cls, dim)"
        steps.append(f"""raw{e} AS MATERIALIZED (SELECT id, y, split, cls, sum(v * {weight}) AS s
            FROM x CROSS JOIN ids {join} GROUP BY ALL),
          p{e} AS MATERIALIZED (SELECT *, exp(s - m) / sum(exp(s - m)) OVER (PARTITION BY id) AS p FROM
            (SELECT *, max(s) OVER (PARTITION BY id) AS m FROM raw{e})),
          m{e} AS (SELECT {e} AS step, split, avg(loss) AS loss, avg((y = best)::INT) AS acc FROM
            (SELECT id, y, split, -ln(max(CASE WHEN cls = y THEN p END)) AS loss,
              first(cls ORDER BY s DESC, cls) AS best FROM p{e} GROUP BY ALL) GROUP BY split)""")
        if e < EPOCHS:
            steps.append(f"""w{e + 1} AS MATERIALIZED (SELECT g.cls, g.dim, {"0.0::DOUBLE" if e == 0 else "w.w"}
                - {RATE} * g.g / (SELECT count(DISTINCT id) FROM x WHERE split = 'train') AS w
              FROM (SELECT p.cls, x.dim, sum((p.p - (p.cls = p.y)::INT) * x.v) AS g
                FROM p{e} p JOIN x USING (id) WHERE x.split = 'train' GROUP BY ALL) g
              {"" if e == 0 else f"JOIN w{e} w USING (cls, dim)"})""")
    every = " UNION ALL ".join(f"SELECT * FROM m{e}" for e in range(EPOCHS + 1))
    return f"""WITH cells AS MATERIALIZED ({vectors}),
      ids AS (SELECT label, (row_number() OVER (ORDER BY count(*) DESC, label) - 1)::INT AS cls
        FROM (SELECT DISTINCT id, label FROM cells) GROUP BY label),
      rows AS (SELECT DISTINCT id, {split} AS split, cls AS y FROM cells JOIN ids USING (label)),
      x AS MATERIALIZED (SELECT id, y, split, dim, v::DOUBLE AS v FROM rows JOIN cells USING (id)
        UNION ALL SELECT id, y, split, -1, 1.0 FROM rows),
      {", ".join(steps)}, every AS ({every})
      SELECT '{run_id}' AS run_id, step::INT AS step, split, 'loss' AS metric, round(loss, 4) AS value FROM every
      UNION ALL SELECT '{run_id}', step::INT, split, 'acc', round(acc, 4) FROM every"""


def _report_sql(pairs: str, classes: str) -> str:
    return f"""per AS (SELECT cls, (SELECT coalesce(sum(n), 0) FROM {pairs} WHERE actual = cls) AS support,
        (SELECT coalesce(sum(n), 0) FROM {pairs} WHERE predicted = cls) AS guessed,
        (SELECT coalesce(sum(n), 0) FROM {pairs} WHERE actual = cls AND predicted = cls) AS hits FROM {classes}),
      pr AS (SELECT *, CASE WHEN guessed > 0 THEN hits / guessed ELSE 0 END AS p,
        CASE WHEN support > 0 THEN hits / support ELSE 0 END AS r FROM per),
      f AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f1 FROM pr),
      tot AS (SELECT sum(support) AS n, sum(hits) / sum(support) AS acc, min(support + guessed) > 0 AS every_one FROM f),
      out AS (SELECT cls, p AS precision, r AS recall, f1, support::DOUBLE AS support FROM f
        UNION ALL SELECT CASE WHEN every_one THEN 'accuracy' ELSE 'micro avg' END, acc, acc, acc,
          CASE WHEN every_one THEN acc ELSE n END FROM tot
        UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f1), sum(support) FROM f
        UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
          sum(f1 * support) / sum(support), sum(support) FROM f)
      SELECT cls, round(precision::DOUBLE, 6) AS precision, round(recall::DOUBLE, 6) AS recall,
        round(f1::DOUBLE, 6) AS f1, round(support::DOUBLE, 6) AS support FROM out"""


def oracles() -> dict[str, str]:
    training = f"{q.bucket(1000, 'dcn', 'page')} < 900"
    silver_all = f"(SELECT dcn, page, label, {q.clean_all('text')} AS text_processed FROM {q.BRONZE})"
    chunks = q.chunk_rows(silver_all, "text_processed", 200, 50, True, drop_empty=True)
    bayes = f"WITH {q.bayes(q.DOC_PAGES, training)}"
    centroid = f"WITH {_CENTROID}"
    split = q.split_name(q.bucket(1000, "vec_id"), splits.CUTS_60_20_20)
    pairs = "(SELECT label::VARCHAR AS actual, predicted::VARCHAR AS predicted, count(*) AS n FROM scored GROUP BY ALL)"
    # SQL has no columns from data: the generated table has the classes 0 to 9.
    wide = ", ".join(f"count(*) FILTER (label = {i}) AS \"{i}\"" for i in range(10))
    chunk_vectors = f"""SELECT g.id, g.dcn, g.page, g.label, g.dim, coalesce(v.v, 0.0::FLOAT) AS v
      FROM (SELECT *, unnest(range(16))::INT AS dim FROM (SELECT page::BIGINT * 100000 + "index" AS id, dcn, page, label, "index"
        FROM {chunks})) g LEFT JOIN {feature_queries.embedding_sql(chunks, 'dcn, page, "index"', q.tokens("text_chunk", False), 1)} v
      ON g.dcn = v.dcn AND g.page = v.page AND g."index" = v."index" AND g.dim = v.dim"""

    def checks_sql(out, lost, extra, bare, wild, schema):
        return f"""SELECT unnest(['schema', 'not_empty', 'rows_kept', 'no_extra_rows', 'labels_present', 'scores_in_range']) AS "check",
          unnest([{str(schema == "Schema OK").lower()}, n > 0, lost = 0, extra = 0, bare = 0, wild = 0]) AS ok,
          unnest(['{schema}', n::VARCHAR, lost::VARCHAR, extra::VARCHAR, bare::VARCHAR, wild::VARCHAR]) AS detail
          FROM (SELECT {out} AS n, {lost} AS lost, {extra} AS extra, {bare} AS bare, {wild} AS wild
            FROM (SELECT doc_id % 50 AS left_over FROM documents))"""

    vowels = " || ' ' || ".join(f"(length(text) - length(replace(text, '{v}', '')))::VARCHAR" for v in "aeiou")
    return {
        "nearest_centroid": f"{centroid} SELECT vec_id, label, predicted, round(score, 5) AS score FROM scored",
        "confusion_matrix": f"""{centroid} SELECT label AS actual, predicted, count(*) AS "rows" FROM scored GROUP BY ALL""",
        "confusion_matrix_wide": f"{centroid} SELECT predicted, {wide} FROM scored GROUP BY predicted",
        "confusion_normalised": f"""{centroid} SELECT actual, predicted, round(n / sum(n) OVER (PARTITION BY actual), 6) AS share
          FROM (SELECT label AS actual, predicted, count(*) AS n FROM scored GROUP BY ALL)""",
        "classification_report": f"""{centroid}, {_report_sql(pairs,
          '(SELECT DISTINCT label::VARCHAR AS cls FROM embeddings)')}""",
        "classification_report_missing": f"""{bayes}, {_report_sql(pairs,
          '(SELECT lang AS cls FROM documents UNION SELECT role FROM conversations)')}""",
        "accuracy_loss": f"""{centroid} SELECT round(avg((label = predicted)::INT), 6) AS acc,
          round(avg(loss), 6) AS loss FROM scored""",
        "accuracy_loss_batched": f"""{centroid} SELECT split, round(sum(hits) / sum(n), 6) AS acc, round(avg(loss), 6) AS loss
          FROM (SELECT {split} AS split, vec_id // 4 AS batch, sum((label = predicted)::INT) AS hits, count(*) AS n,
            avg(loss) AS loss FROM scored GROUP BY ALL) GROUP BY split""",
        "run_metrics": f"""{centroid}, m AS (SELECT {split} AS step, avg((label = predicted)::INT) AS acc, avg(loss) AS loss
          FROM scored GROUP BY ALL) SELECT 'centroid-1' AS run_id, step, 'acc' AS metric, round(acc, 6) AS value FROM m
          UNION ALL SELECT 'centroid-1', step, 'loss', round(loss, 6) FROM m""",
        "naive_bayes_lang": f"{bayes} SELECT dcn, page, label, predicted FROM scored",
        "score_pages": f"{bayes} SELECT dcn, page, upper(predicted) AS pred_label, round(score, 6) AS pred_score FROM scored",
        "score_by_partition": f"""{bayes} SELECT dcn, page, upper(predicted) AS Label,
          round(score::FLOAT::DOUBLE, 4) AS Score, true AS timed FROM scored""",
        "score_column": f"""{bayes} SELECT dcn, page, upper(predicted) AS pred_label, round(score, 6) AS pred_score,
          true AS timed FROM scored""",
        "accuracy_loss_extreme": f"""WITH {_CENTROID.replace('-sum((v - c) * (v - c)) AS s', '-1000 * sum((v - c) * (v - c)) AS s')}
          SELECT round(avg((label = predicted)::INT), 6) AS acc, round(avg(loss), 3) AS loss FROM scored""",
        "lr_chunk_classifier": _linear_sql(chunk_vectors, "chunks-1"),
        "page_sequence_classifier": _linear_sql(f"""SELECT id // 100000 AS id, dcn, page, label, dim,
          avg(v::DOUBLE)::FLOAT AS v FROM ({chunk_vectors}) GROUP BY ALL""", "pages-1"),
        "model_embedding": f"""SELECT dcn, page, length(text)::VARCHAR || ' ' || {vowels} AS emb FROM {q.TURN_PAGES}""",
        "validation_report": checks_sql("count(*)", "0", "0", "0", "0", "Schema OK"),
        "validation_decision": """SELECT 'approve' AS decision, 'All tests passed!  Moving to Staging.' AS comment
          FROM documents HAVING count(*) > 0""",
        "validation_report_bad": checks_sql(
            "count(*) FILTER (left_over <> 3) + count(*) FILTER (left_over = 7)", "count(*) FILTER (left_over = 3)",
            "count(*) FILTER (left_over = 7)", "count(*) FILTER (left_over = 11)", "count(*) FILTER (left_over = 13)",
            "Schema OK"),
        "validation_reject": """SELECT CASE WHEN bad > 0 THEN 'reject' ELSE 'approve' END AS decision,
          CASE WHEN bad > 0 THEN 'Tests failed, moving to archived.  Check the job run to see what happened.'
            ELSE 'All tests passed!  Moving to Staging.' END AS comment
          FROM (SELECT count(*) FILTER (doc_id % 50 IN (3, 7, 11, 13)) AS bad FROM documents)""",
        "validation_schema": " UNION ALL ".join(
            f"""SELECT '{case}' AS "case", *, '{decision}' AS decision FROM ({checks_sql("count(*)", "0", "0", "0", "0", told)})"""
            for case, told, decision in (("type", "Schema validation failed", "reject"),
                                         ("missing", "Schema validation failed", "reject"), ("good", "Schema OK", "approve"))),
        "validation_empty": checks_sql("0", "count(*)", "0", "0", "0", "Schema OK"),
    }
