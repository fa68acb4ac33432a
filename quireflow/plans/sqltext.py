"""SQL fragments the twins share. Regular expressions spell out white space, because not
every engine counts the vertical tab as one."""

from __future__ import annotations

from quireflow.functions.text import english_stop_words

BLANK = r"[ \t\n\r\f\x0B]"


def stop_list() -> str:
    return "[" + ",".join("'" + w.replace("'", "''") + "'" for w in english_stop_words()) + "]"


def tokens(text: str, drop: bool = True) -> str:
    extra = f" AND NOT list_contains({stop_list()}, tk)" if drop else ""
    return f"list_filter(regexp_split_to_array({text}, '{BLANK}+'), lambda tk: tk <> ''{extra})"


def joined(items: str) -> str:
    return f"coalesce(array_to_string({items}, ' '), '')"


def paragraph(z: str, noise=()) -> str:
    b = BLANK
    z = f"regexp_replace({z}, '^{b}?\\d+', '')"
    z = f"regexp_replace(regexp_replace({z}, '^{b}+', ''), '{b}+$', '')"
    z = f"regexp_replace({z}, '{b}?-{b}?', '-', 'g')"
    z = f"regexp_replace({z}, '{b}?([,:;.])', '\\1', 'g')"
    z = f"regexp_replace({z}, '{b}+', ' ', 'g')"
    z = f"regexp_replace({z}, '\\.+', '.', 'g')"
    for phrase in noise:
        z = f"replace({z}, '{phrase}', '')"
    return joined(tokens(z))


def paragraphs(text: str) -> str:
    """List of raw paragraphs, newlines inside them folded to blanks."""
    t = f"' ' || regexp_replace({text}, '[^\\x20-\\x7E\\t\\n\\r\\x0B\\f]', '', 'g')"
    t = f"replace({t}, '.' || chr(10) || ' ', '.  ')"
    t = f"replace({t}, '.' || chr(10), '.' || chr(1))"
    return f"string_split(replace({t}, chr(10), ' '), chr(1))"


def clean_last(text: str, noise=()) -> str:
    return paragraph(f"({paragraphs(text)})[-1]", noise)


def clean_all(text: str, noise=()) -> str:
    each = f"list_transform({paragraphs(text)}, lambda pz: {paragraph('pz', noise)})"
    return joined(f"list_filter({each}, lambda pc: pc <> '')")


def clean_serving(text: str, noise=()) -> str:
    z = f"regexp_replace(lower({text}), '[,.!?]', '', 'g')"
    z = f"regexp_replace(regexp_replace({z}, '[^a-zA-Z]', ' ', 'g'), ' +', ' ', 'g')"
    for phrase in noise:
        z = f"replace({z}, '{phrase}', '')"
    return joined(tokens(z))


def chunk_rows(source: str, text: str, maxlen: int, overlap: int, full: bool = False,
               keep: str = "dcn, page, label", drop_empty: bool = False) -> str:
    """Rows ``keep, text_chunk, index`` for every window of every text. Only the last
    window of a text can be empty."""
    stride, more = maxlen - overlap, 1 if full else 0
    return f"""(SELECT {keep}, {joined(f"w[i * {stride} + 1 : i * {stride} + {maxlen}]")} AS text_chunk,
      (i + 1)::INT AS "index"
      FROM (SELECT *, unnest(range(n)) AS i FROM (SELECT *,
        CASE WHEN len(w) // {stride} > 0 THEN len(w) // {stride} + {more} ELSE 1 END AS n
        FROM (SELECT *, {tokens(text, drop=False)} AS w FROM {source}))){" WHERE i * " + str(stride) + " < len(w)" if drop_empty else ""})"""


DOC_PAGES = """(SELECT text, lang AS label, source AS dcn, doc_id::DOUBLE AS page FROM documents)"""
TURN_PAGES = """(SELECT text, role AS label, conv_id::VARCHAR AS dcn, turn::DOUBLE AS page FROM conversations)"""
BRONZE = f"""(SELECT text, label, dcn, page FROM (SELECT *, row_number() OVER
  (PARTITION BY text, label ORDER BY dcn, page) AS rn FROM {DOC_PAGES} WHERE text IS NOT NULL) WHERE rn = 1)"""


def bucket(buckets: int, *keys: str, seed="42") -> str:
    key = " || ':' || ".join([f"'{seed}'"] + [f"{k}::VARCHAR" for k in keys])
    return f"(('0x' || substr(md5({key}), 1, 8))::BIGINT % {buckets})::INT"


def split_name(b: str, cuts) -> str:
    whens = " ".join(f"WHEN {b} < {top} THEN '{name}'" for name, top in cuts[:-1])
    return f"CASE {whens} ELSE '{cuts[-1][0]}' END"


def bayes(source: str, train: str = "true", digits: int = 2) -> str:
    """CTEs that train and apply the hashed Bayes model on page records; the last one,
    ``scored``, has ``dcn, page, label, predicted, score``."""
    toks = """flatten(list_transform(range(len(w) // 150 + 1),
      lambda ci: w[ci * 150 + 1 : ci * 150 + 200]))"""
    cells = 16**digits
    return f"""base AS (SELECT dcn, page, label, {tokens(clean_serving("text"), drop=False)} AS w,
        {train} AS training FROM {source}),
      counts AS (SELECT dcn, page, label, training, substr(md5(tk), 1, {digits}) AS b, count(*) AS c
        FROM (SELECT dcn, page, label, training, unnest({toks}) AS tk FROM base) GROUP BY ALL),
      classes AS (SELECT label, count(*) AS n FROM base WHERE training GROUP BY label),
      prior AS (SELECT label, ln(n + 1.0::DOUBLE) - ln(((SELECT sum(n) FROM classes)
          + (SELECT count(*) FROM classes))::DOUBLE) AS lp FROM classes),
      sums AS (SELECT label, b, sum(c) AS s FROM counts WHERE training GROUP BY ALL),
      theta AS (SELECT g.label, g.b, ln(coalesce(p.s, 0) + 1.0::DOUBLE)
          - ln(((SELECT sum(s) FROM sums q WHERE q.label = g.label) + {cells})::DOUBLE) AS lt
        FROM (SELECT label, lower(printf('%0{digits}x', r.range)) AS b
              FROM prior, range({cells}) r) g LEFT JOIN sums p USING (label, b)),
      parts AS (SELECT c.dcn, c.page, t.label AS cls, sum(c.c * t.lt) AS s
        FROM counts c JOIN theta t USING (b) GROUP BY ALL),
      raw AS (SELECT x.dcn, x.page, x.label, p.label AS cls, p.lp + coalesce(s.s, 0) AS r
        FROM base x CROSS JOIN prior p
        LEFT JOIN parts s ON s.dcn = x.dcn AND s.page = x.page AND s.cls = p.label),
      scored AS (SELECT dcn, page, label, arg_max(cls, r) AS predicted, 1.0 / sum(exp(r - m)) AS score
        FROM (SELECT *, max(r) OVER (PARTITION BY dcn, page) AS m FROM raw) GROUP BY dcn, page, label)"""
