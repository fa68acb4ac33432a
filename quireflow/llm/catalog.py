"""Queries opN_* over the test tables, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from quireflow.llm import (chat, decontaminate, divergence, fingerprints, licenses, lm, mixing, neardup, negatives, quality,
                           rules, substrings, urlfilter)
from quireflow.llm.common import load, remainder, stored


def op1_mix_sources(spark, d):
    return mixing.plan(load(spark, d, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op2_lm_score(spark, d):
    left = remainder("doc_id", 7)
    use = F.when(left == 2, lm.HELD_OUT).when(left == 3, lm.FOLD).otherwise(lm.TRAIN)
    return lm.score(load(spark, d, "documents"), use)


def op3_decontaminate(spark, d):
    docs = load(spark, d, "documents").select("doc_id", "text")
    found = decontaminate.verdicts(decontaminate.find(docs, load(spark, d, "benchmark"), ["doc_id"]))
    return found.select(
        "doc_id", F.col("__n_words").alias("n_words"), F.col("__n_hit").alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"), F.sha2(F.array_join("__items", ","), 256).alias("items_sha256"),
        F.col("__contaminated").alias("contaminated"))


def op4_license_scan(spark, d):
    found = licenses.scan(load(spark, d, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", F.size("sentence_ids").cast("long").alias("n_sentences"),
        F.array_join("sentence_ids", " ").alias("sentence_ids"), F.array_join("licenses", ",").alias("licenses"))


def op5_quality(spark, d):
    held_out = remainder("doc_id", 3) == 1
    stats = quality.features(load(spark, d, "documents"))
    trees = quality.fit(stats, load(spark, d, "labels").filter(~held_out))
    return quality.scored(stats, trees).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op6_chat_format(spark, d):
    quote = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(quote).alias("text"))
    turns = load(spark, d, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digests(turns)


def op7_near_dedup(spark, d):
    return neardup.classes(load(spark, d, "documents").select("doc_id", "text"))


def op8_fingerprint(spark, d):
    return fingerprints.with_next(load(spark, d, "documents").select("doc_id", "text"))


def op9_url_filter(spark, d):
    pages = load(spark, d, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched_at", F.date_add(
        F.lit("2023-01-01").cast("date"), (F.crc32(F.col("page_id").cast("string").cast("binary")) % 900).cast("int")))
    judged = urlfilter.judge(captures, dated_entries(pages))
    return judged.withColumn("fetched_at", F.col("fetched_at").cast("string")).withColumn(
        "valid_from", F.col("valid_from").cast("string"))


def op10_substring_dedup(spark, d):
    docs = load(spark, d, "documents").select("doc_id", "text")
    return substrings.digest(substrings.remove_repeats(docs))


def op11_hard_negatives(spark, d):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = load(spark, d, "embeddings").withColumn("label", moved)
    return negatives.mine(vectors, F.col("vec_id") % 100 == 0)


def op12_quality_rules(spark, d):
    measured = stored(rules.measure(load(spark, d, "documents").select("doc_id", "text")), "measured")
    learned = rules.fit(measured, load(spark, d, "labels").filter(remainder("doc_id", 3) != 1))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"]
    return rules.judged(measured, learned).select("doc_id", *[F.col(f"__{n}").alias(n) for n in names])


def op13_source_divergence(spark, d):
    return divergence.audit(load(spark, d, "documents"))


def dated_entries(pages):
    """A dated list from the hosts seen: up to three entries for each name, by checksums."""
    names = pages.select(F.explode(urlfilter.names_above(urlfilter.host(F.col("url")))).alias("name")).distinct()
    code = F.crc32(F.concat_ws("#", "name", F.col("step").cast("string")).cast("binary"))
    return names.filter("name <> ''").select("name", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("step")).filter(
        code % 3 != 0
    ).select(
        "name", F.when(code % 5 < 3, urlfilter.BLOCK).otherwise(urlfilter.ALLOW).alias("action"),
        F.concat(F.lit("list"), (code % 4).cast("string")).alias("category"),
        F.date_add(F.lit("2023-01-01").cast("date"), (code % 900).cast("int")).alias("listed_at"))


QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_lm_score": op2_lm_score,
    "op3_decontaminate": op3_decontaminate,
    "op4_license_scan": op4_license_scan,
    "op5_quality": op5_quality,
    "op6_chat_format": op6_chat_format,
    "op7_near_dedup": op7_near_dedup,
    "op8_fingerprint": op8_fingerprint,
    "op9_url_filter": op9_url_filter,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_quality_rules": op12_quality_rules,
    "op13_source_divergence": op13_source_divergence,
}


_MIX_SQL = r"""
WITH docs AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
    FROM documents),
  per AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
  w AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight, 3 * source_size AS cap
    FROM per),
  s AS (SELECT *, coalesce(sum(cap) OVER before, 0) AS fixed, coalesce(sum(weight) OVER before, 0) AS spent,
      sum(source_size) OVER () AS total, sum(weight) OVER () AS weights
    FROM w WINDOW before AS (ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  level AS (SELECT arg_min((total - fixed)::DOUBLE / (weights - spent), spent) AS share FROM s
    WHERE NOT cap < weight * ((total - fixed)::DOUBLE / (weights - spent))),
  goal AS (SELECT source, source_size, CASE WHEN cap < weight * coalesce(share, 0.0) THEN cap::DOUBLE
      ELSE weight * coalesce(share, 0.0) END AS target,
      coalesce('=' || source, '~') AS key FROM w, level),
  p AS (SELECT source, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS each,
      ('0x' || substr(md5('mix:' || key), 1, 5))::INT / 1048576.0::DOUBLE AS start FROM goal),
  r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, doc_id NULLS FIRST) - 1 AS k FROM docs)
SELECT doc_id, size, p.source_size, target,
  (size * least(floor((k + 1) * each + start) - floor(k * each + start), 3))::BIGINT AS taken
FROM r JOIN p ON r.source IS NOT DISTINCT FROM p.source"""


def _chat_sql() -> str:
    t = chat.Template()

    def escaped(c: str) -> str:
        c = f"replace({c}, '\\', '\\\\')"
        for mark in t.controls:
            c = f"replace({c}, '{mark}', '{mark[0]}\\{mark[1:]}')"
        return c
    marks = len(t.opening) + len(t.middle) + len(t.closing)
    order = "ORDER BY turn NULLS FIRST, role, text"
    return f"""
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' {order})) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' {order}) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum({marks} + length({escaped('role')}) + length({escaped('text')}))::BIGINT AS formatted_chars,
  regexp_full_match(string_agg(role, ' ' {order}), '(system )?user( tool)*( assistant( tool)?( tool)*( user( tool)*)?)*')
    AND last(role {order}) = 'assistant' AS valid
FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
GROUP BY conv_id"""


def _url_sql() -> str:
    host = ("regexp_replace(translate(regexp_extract(coalesce(url, ''), "
            "'^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
            "'abcdefghijklmnopqrstuvwxyz'), '^www[.]', '')")

    day = "DATE '2023-01-01' + ({} % 900)::INT"
    return f"""
WITH RECURSIVE crc_table AS (SELECT i, i AS c, 0 AS k FROM range(256) r(i) UNION ALL
    SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc_table WHERE k < 8),
  steps AS (SELECT list(c ORDER BY i) AS t FROM crc_table WHERE k = 8),
  h AS (SELECT page_id, {host} AS host FROM pages),
  n AS (SELECT page_id, host, unnest(range(d)) AS depth, d FROM
    (SELECT *, greatest(len(string_split(host, '.')) - 1, 1) AS d FROM h)),
  named AS (SELECT page_id, host, depth, array_to_string(string_split(host, '.')[depth + 1:], '.') AS name FROM n),
  codes AS (SELECT x, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(x, ''), lambda c: ascii(c)::BIGINT)),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS code FROM steps,
    (SELECT DISTINCT name || '#' || s AS x FROM named, range(3) r(s) WHERE name <> '' UNION SELECT DISTINCT page_id::VARCHAR FROM h)),
  e AS (SELECT DISTINCT name, CASE WHEN code % 5 < 3 THEN 'block' ELSE 'allow' END AS action,
      'list' || (code % 4) AS category, {day.format('code')} AS listed_at
    FROM (SELECT DISTINCT name FROM named), range(3) r(s) JOIN codes ON x = name || '#' || s WHERE code % 3 <> 0),
  one AS (SELECT name, listed_at, max({{'action': action, 'category': category}}) AS v FROM e GROUP BY ALL),
  c AS (SELECT page_id, host, depth, name, {day.format('code')} AS fetched_at FROM named JOIN codes ON x = page_id::VARCHAR),
  best AS (SELECT c.page_id, c.host, c.fetched_at, arg_min(CASE WHEN o.name IS NOT NULL THEN
      {{'name': o.name, 'v': o.v, 'at': o.listed_at}} END, depth) AS b
    FROM c ASOF LEFT JOIN one o ON c.name = o.name AND c.fetched_at >= o.listed_at GROUP BY ALL)
SELECT page_id, host, fetched_at::VARCHAR AS fetched_at, b.name AS listed_name, b.v.action AS action, b.v.category AS category,
  b.at::VARCHAR AS valid_from, coalesce(b.v.action = 'block', false) AS blocked FROM best"""


#: Windows by their words; a word goes if a window over it starts in a smaller document.
_REPEATS_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
  win AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 12], ' ')) AS k
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
  least AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k),
  gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM win JOIN least USING (k) WHERE m < doc_id),
  per AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id),
  words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
  kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept
    FROM (SELECT words.* FROM words ANTI JOIN gone ON words.doc_id = gone.doc_id AND words.p = gone.p) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN per USING (doc_id) LEFT JOIN kept USING (doc_id)"""


_CONTAMINATION_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
  b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
  p AS (SELECT DISTINCT item, least(len(ws), 13) AS n, array_to_string(ws[i:i + 12], ' ') AS k
    FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - 11, 2))) AS i FROM b WHERE len(ws) > 0)),
  win AS (SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS k
    FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM p))),
  occ AS (SELECT doc_id, i, n, item FROM win JOIN p USING (n, k)),
  hit AS (SELECT doc_id, count(DISTINCT w) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS w FROM occ) GROUP BY doc_id),
  its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item FROM occ) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)"""


def oracles() -> dict[str, str]:
    return {
        "op1_mix_sources": _MIX_SQL,
        "op3_decontaminate": _CONTAMINATION_SQL,
        "op4_license_scan": licenses.oracle(),
        "op6_chat_format": _chat_sql(),
        "op9_url_filter": _url_sql(),
        "op10_substring_dedup": _REPEATS_SQL,
        "op11_hard_negatives": negatives.oracle(),
        "op13_source_divergence": divergence.oracle(),
    }
