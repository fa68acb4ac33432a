"""Registered queries: dedup, cleaning, chunking, labels, splits, encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from quireflow.functions import text
from quireflow.operators import encode, labels, prepare, splits
from quireflow.plans import sqltext as q
from quireflow.plans.tables import NOISE, document_pages, load, turn_pages
from quireflow.session import stored


# A phrase with blanks of its own, which meet those at the ends of a paragraph.
STAMP = (" of the ", " and ")


def bronze_dedup(spark, d):
    return prepare.bronze(document_pages(spark, d))


def _silver(mode, noise=()):
    def run(spark, d):
        return prepare.silver(document_pages(spark, d), mode, noise)
    return run


def serving_clean(spark, d):
    cleaned = text.clean_serving(F.col("text"), NOISE)
    return document_pages(spark, d).select("dcn", "page", cleaned.alias("text_processed"))


STEPS = {
    "printable": text.keep_printable,
    "hyphens": text.rejoin_hyphens,
    "punctuation": text.tighten_punctuation,
    "blanks": text.collapse_blanks,
    "dots": text.collapse_dots,
    "letters": lambda c: text.letters_only(F.lower(c)),
    "phrases": lambda c: text.drop_phrases(c, NOISE),
    "header": lambda c: text.last_paragraph(text.drop_header_number(F.concat(F.lit("\x01"), c))),
}


def cleaning_steps(spark, d):
    """Each cleaning step on its own, on the raw texts, as digests."""
    pages = document_pages(spark, d)
    return pages.select("dcn", "page", *[
        F.md5(step(F.col("text")).cast("binary")).alias(name) for name, step in STEPS.items()
    ])


def page_labels_join(spark, d):
    """Labels kept in a table of their own, attached by page; pages without one stay."""
    marks = load(spark, d, "labels").select(
        F.col("doc_id").cast("double").alias("page"), "quality", "toxic"
    )
    pages = document_pages(spark, d).select("dcn", "page", "label")
    return pages.join(marks, "page", "left").select(
        "dcn", "page", "label", F.coalesce("quality", F.lit(-1)).alias("quality"),
        F.coalesce("toxic", F.lit(-1)).alias("toxic"),
    )


def first_rows(spark, d):
    """The first 50 pages in key order: the limit is the feature."""
    return document_pages(spark, d).select("dcn", "page", "label").orderBy("dcn", "page").limit(50)


def spread_pages(spark, d):
    """Evened-out partitions hold the same rows."""
    return prepare.spread(document_pages(spark, d), "dcn").groupBy("dcn").agg(
        F.count("*").alias("pages"), F.sum(F.length("text")).alias("chars")
    )


def sentence_split(spark, d):
    parts = text.split_sentences(F.col("text"))
    return document_pages(spark, d).select(
        "dcn", "page", F.posexplode_outer(parts).alias("pos", "sentence")
    )


def _gold(maxlen, overlap, full):
    def run(spark, d):
        pages = prepare.silver(prepare.bronze(document_pages(spark, d)), "all")
        return prepare.gold(pages, maxlen, overlap, full)
    return run


def gold_shared_pages(spark, d):
    """Chunks numbered through per (source, language), where one such page may be huge."""
    pages = document_pages(spark, d).select(
        "text", "label", F.col("label").alias("dcn"), F.lit(1.0).alias("page"),
        F.col("page").cast("bigint").alias("doc_id"),
    )
    cleaned = stored(prepare.silver(pages, "all", keep=["doc_id"]), "silver")
    return prepare.gold_shared(cleaned, "doc_id", 200, 50, full_split=True, drop_empty=True)


def chunk_stats_by_label(spark, d):
    """Flagship: dedup, clean, chunk, and count per label."""
    pages = prepare.silver(prepare.bronze(document_pages(spark, d)), "all")
    return prepare.chunk_stats(prepare.gold(pages, 200, 50, full_split=True, drop_empty=True), "label")


def label_index(spark, d):
    return labels.label_index(document_pages(spark, d))


def label_index_large(spark, d):
    """On a label with many values."""
    pages = load(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("label"))
    return labels.label_index(pages)


def label_attach(spark, d):
    pages = turn_pages(spark, d).select("dcn", "page", "label")
    return labels.attach_label_id(pages, labels.label_index(pages))


def label_decode_roundtrip(spark, d):
    pages = document_pages(spark, d).select("dcn", "page", "label")
    dictionary = labels.label_index(pages)
    coded = labels.attach_label_id(pages.withColumn("name", F.col("label")), dictionary)
    return labels.decode_label(coded, dictionary, "label_id", "decoded").select(
        "dcn", "page", F.col("name").alias("label"), "label_id", "decoded"
    )


def class_count(spark, d):
    return labels.class_count(document_pages(spark, d))


def split_90_5_5(spark, d):
    return splits.with_split(
        load(spark, d, "conversations").select("conv_id", "turn", "role"), "conv_id", "turn"
    )


def split_60_20_20(spark, d):
    parts = load(spark, d, "part").select("p_partkey", "p_retailprice")
    return splits.with_split(parts, "p_partkey", cuts=splits.CUTS_60_20_20)


def _turn_tokens():
    return text.serving_words(F.col("text"))


def vocabulary(spark, d):
    return encode.vocabulary(turn_pages(spark, d), _turn_tokens())


def encode_fixed_len(spark, d):
    """Over the dictionary of the training split, so that other turns have unknown tokens."""
    pages = turn_pages(spark, d)
    training = splits.with_split(pages, "dcn", "page").where("split = 'train'")
    vocab = encode.vocabulary(training, _turn_tokens())
    coded = encode.encode(pages, ["dcn", "page"], _turn_tokens(), vocab, 64)
    return coded.select(
        "dcn", "page",
        F.array_join(F.col("input_ids").cast("array<string>"), " ").alias("input_ids"),
        F.array_join(F.col("attention_mask").cast("array<string>"), " ").alias("attention_mask"),
    )


QUERIES = {
    "bronze_dedup": bronze_dedup,
    "silver_clean_last": _silver("last"),
    "silver_clean_all": _silver("all"),
    "silver_clean_noise": _silver("all", NOISE),
    "silver_clean_stamp": _silver("all", STAMP),
    "serving_clean": serving_clean,
    "sentence_split": sentence_split,
    "cleaning_steps": cleaning_steps,
    "page_labels_join": page_labels_join,
    "first_rows": first_rows,
    "spread_pages": spread_pages,
    "gold_chunks": _gold(200, 50, False),
    "gold_chunks_full": _gold(40, 10, True),
    "gold_shared_pages": gold_shared_pages,
    "chunk_stats_by_label": chunk_stats_by_label,
    "label_index": label_index,
    "label_index_large": label_index_large,
    "label_attach": label_attach,
    "label_decode_roundtrip": label_decode_roundtrip,
    "class_count": class_count,
    "split_90_5_5": split_90_5_5,
    "split_60_20_20": split_60_20_20,
    "vocabulary": vocabulary,
    "encode_fixed_len": encode_fixed_len,
}


def _index_sql(source: str, label: str) -> str:
    return f"""SELECT {label} AS label,
      (row_number() OVER (ORDER BY count(*) DESC, {label}) - 1)::INT AS label_id,
      count(*) AS "rows" FROM {source} GROUP BY {label}"""


def _vocab_sql(where: str = "true") -> str:
    return f"""(SELECT token, row_number() OVER (ORDER BY uses DESC, token) + 3 AS token_id, uses
      FROM (SELECT token, count(*) AS uses FROM (SELECT unnest({q.tokens(q.clean_serving('text'), False)}) AS token
        FROM {q.TURN_PAGES} WHERE {where}) GROUP BY token))"""


def oracles() -> dict[str, str]:
    clean_all = q.clean_all("text")
    silver_all = f"(SELECT dcn, page, label, {clean_all} AS text_processed FROM {q.BRONZE})"
    chunks = q.chunk_rows(silver_all, "text_processed", 200, 50)
    shared = f"""(SELECT lang AS dcn, 1.0::DOUBLE AS page, lang AS label, doc_id, {clean_all} AS text_processed FROM documents)"""
    shared_chunks = q.chunk_rows(shared, "text_processed", 200, 50, True, "dcn, page, label, doc_id", drop_empty=True)
    full = q.chunk_rows(silver_all, "text_processed", 200, 50, True, drop_empty=True)
    training = f"{q.bucket(1000, 'dcn', 'page')} < 900"
    coded = f"""(SELECT dcn, page, list(coalesce(v.token_id, 1) ORDER BY pos) FILTER (pos IS NOT NULL) AS body
      FROM (SELECT dcn, page, p.token, p.pos FROM {q.TURN_PAGES} t LEFT JOIN
        (SELECT dcn, page, unnest(w) AS token, unnest(range(len(w))) AS pos FROM
          (SELECT dcn, page, ({q.tokens(q.clean_serving('text'), False)})[1:62] AS w FROM {q.TURN_PAGES})) p
        USING (dcn, page)) x LEFT JOIN {_vocab_sql(training)} v USING (token) GROUP BY dcn, page)"""
    silver = "SELECT dcn, page, {} AS text_processed, label FROM " + q.DOC_PAGES
    return {
        "bronze_dedup": f"SELECT text, label, dcn, page FROM {q.BRONZE}",
        "silver_clean_last": silver.format(q.clean_last("text")),
        "silver_clean_all": silver.format(clean_all),
        "silver_clean_noise": silver.format(q.clean_all("text", NOISE)),
        "silver_clean_stamp": silver.format(q.clean_all("text", STAMP)),
        "serving_clean": f"SELECT dcn, page, {q.clean_serving('text', NOISE)} AS text_processed FROM {q.DOC_PAGES}",
        "sentence_split": f"""SELECT dcn, page, unnest(range(len(ss)))::INT AS pos, unnest(ss) AS sentence
          FROM (SELECT dcn, page, string_split(regexp_replace(text, '([.!?]){q.BLANK}+', '\\1' || chr(1), 'g'), chr(1)) AS ss
                FROM {q.DOC_PAGES})""",
        "cleaning_steps": f"""SELECT dcn, page,
          md5(regexp_replace(text, '[^\\x20-\\x7E\\t\\n\\r\\x0B\\f]', '', 'g')) AS printable,
          md5(regexp_replace(text, '{q.BLANK}?-{q.BLANK}?', '-', 'g')) AS hyphens,
          md5(regexp_replace(text, '{q.BLANK}?([,:;.])', '\\1', 'g')) AS punctuation,
          md5(regexp_replace(text, '{q.BLANK}+', ' ', 'g')) AS blanks,
          md5(regexp_replace(text, '\\.+', '.', 'g')) AS dots,
          md5(regexp_replace(lower(text), '[^a-z ]+', ' ', 'g')) AS letters,
          md5(replace(text, '{NOISE[0]}', '')) AS phrases,
          md5(chr(1) || regexp_replace(text, '^{q.BLANK}?[0-9]+', '')) AS header FROM {q.DOC_PAGES}""",
        "page_labels_join": """SELECT source AS dcn, doc_id::DOUBLE AS page, lang AS label,
          coalesce(quality, -1)::INT AS quality, coalesce(toxic, -1)::INT AS toxic
          FROM documents LEFT JOIN labels USING (doc_id)""",
        "first_rows": f"SELECT dcn, page, label FROM {q.DOC_PAGES} ORDER BY dcn, page LIMIT 50",
        "spread_pages": """SELECT source AS dcn, count(*) AS pages, sum(length(text))::BIGINT AS chars
          FROM documents GROUP BY source""",
        "gold_chunks": f'SELECT dcn, page, text_chunk, "index", label FROM {chunks}',
        "gold_chunks_full": f"""SELECT dcn, page, text_chunk, "index", label
          FROM {q.chunk_rows(silver_all, 'text_processed', 40, 10, True)}""",
        "gold_shared_pages": f"""SELECT dcn, page, text_chunk, row_number() OVER
          (PARTITION BY dcn, page ORDER BY doc_id, "index") AS "index", label, doc_id FROM {shared_chunks}""",
        "chunk_stats_by_label": f"""SELECT label, count(*) AS chunks, sum(("index" = 1)::INT)::BIGINT AS pages,
          sum(len({q.tokens('text_chunk', False)}))::BIGINT AS words FROM {full} GROUP BY label""",
        "label_index": _index_sql("documents", "lang"),
        "label_index_large": _index_sql("orders", "o_custkey::VARCHAR"),
        "label_attach": f"""SELECT dcn, page, label_id FROM {q.TURN_PAGES}
          JOIN ({_index_sql('conversations', 'role')}) USING (label)""",
        "label_decode_roundtrip": f"""SELECT dcn, page, label, label_id, label AS decoded FROM {q.DOC_PAGES}
          JOIN ({_index_sql('documents', 'lang')}) USING (label)""",
        "class_count": "SELECT count(DISTINCT lang) AS classes FROM documents",
        "split_90_5_5": f"""SELECT conv_id, turn, role,
          {q.split_name(q.bucket(1000, 'conv_id', 'turn'), splits.CUTS_90_5_5)} AS split FROM conversations""",
        "split_60_20_20": f"""SELECT p_partkey, p_retailprice,
          {q.split_name(q.bucket(1000, 'p_partkey'), splits.CUTS_60_20_20)} AS split FROM part""",
        "vocabulary": f"SELECT * FROM {_vocab_sql()}",
        "encode_fixed_len": f"""SELECT dcn, page,
          array_to_string(list_resize(ids, 64, 0), ' ') AS input_ids,
          array_to_string(list_resize(list_transform(ids, lambda x: 1), 64, 0), ' ') AS attention_mask
          FROM (SELECT dcn, page, list_concat(list_concat([2], coalesce(body, [])), [3]) AS ids FROM {coded})""",
    }
