"""Operator 4: license scans by recognised sentences and ordered rules.

A text is cut into normalised sentences. Those that a table of license sentences knows
become identifiers, in order. A rule is an ordered list of identifiers; it matches when the
text has them in that order, with anything between. Rules stand in order, too: a license that
others come before (``UNLESS``) is left out where one of them is found.

A sentence goes on over line ends, wherever a notice is wrapped; blank lines, list marks and
sentence marks end it. A title or a short statement that fills a line is a sentence as well.

DataFrame functions only, within the row: no exchange at all. The tables are part of the
program, so their size is fixed; pass others to scan for other licenses. Only texts that have
one of the words of ``anchors`` are cut at all: every known sentence has one, so no other text
can have a known sentence.

Defined cases: a null or empty text has no sentences and no licenses; indentation and comment
marks before a line do not count; repeated sentences repeat in the sequence; an empty table
gives an empty result. Only the text is read; other columns stay, and one that is named like a
result is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quireflow.llm.common import LOWER, UPPER, lower_ascii, set_aside, text_or_empty

#: Titles that stand on a line of their own, normalised (lower case, letters,
#: digits and inner dots).
TITLES: dict[str, str] = {
    "mit-title": "the mit license",
    "mit-title-2": "mit license",
    "mit-title-3": "the mit license mit",
    "isc-title": "isc license",
    "apache-title": "apache license",
    "apache-version": "version 2.0 january 2004",
    "gpl-title": "gnu general public license",
    "lgpl-title": "gnu lesser general public license",
    "agpl-title": "gnu affero general public license",
    "v2-1991": "version 2 june 1991",
    "v2.1-1999": "version 2.1 february 1999",
    "v3-2007": "version 3 29 june 2007",
    "v3-2007-2": "version 3 19 november 2007",
    "mpl-title": "mozilla public license version 2.0",
    "cc0-title": "cc0 1.0 universal",
    "cc0-title-2": "creative commons cc0 1.0 universal",
}

#: What follows the words of ``STATED``.
NAMES: tuple[tuple[str, str], ...] = (
    ("MIT", "the mit license"), ("Apache-2.0", "the apache license version 2.0"),
    ("Apache-2.0", "the apache license version 2.0 the license"), ("ISC", "the isc license"),
    ("BSD-2-Clause", "the bsd 2 clause license"), ("BSD-3-Clause", "the bsd 3 clause license"),
    ("GPL-2.0", "the gnu general public license version 2"), ("GPL-3.0", "the gnu general public license version 3"),
    ("LGPL-2.1", "the gnu lesser general public license version 2.1"),
    ("LGPL-3.0", "the gnu lesser general public license version 3"),
    ("AGPL-3.0", "the gnu affero general public license version 3"),
    ("MPL-2.0", "the mozilla public license version 2.0"), ("CC0-1.0", "cc0 1.0"),
)
STATED: tuple[str, ...] = ("licensed under", "released under", "this work is licensed under",
                           "this project is licensed under", "this software is licensed under")

#: The parts of the names of the 4.0 family.
ATTRIBUTION: tuple[tuple[str, str, str], ...] = (
    ("CC-BY-4.0", "by", "attribution"), ("CC-BY-SA-4.0", "by sa", "attribution sharealike"),
    ("CC-BY-NC-4.0", "by nc", "attribution noncommercial"), ("CC-BY-ND-4.0", "by nd", "attribution noderivatives"),
    ("CC-BY-NC-SA-4.0", "by nc sa", "attribution noncommercial sharealike"),
    ("CC-BY-NC-ND-4.0", "by nc nd", "attribution noncommercial noderivatives"),
)

#: Identifiers in one-line tags.
TAGS: tuple[tuple[str, str], ...] = (
    ("MIT", "mit"), ("Apache-2.0", "apache 2.0"), ("ISC", "isc"), ("MPL-2.0", "mpl 2.0"), ("Unlicense", "unlicense"),
    ("BSD-2-Clause", "bsd 2 clause"), ("BSD-3-Clause", "bsd 3 clause"), ("CC0-1.0", "cc0 1.0"),
    ("GPL-2.0", "gpl 2.0 only"), ("GPL-2.0", "gpl 2.0 or later"), ("GPL-3.0", "gpl 3.0 only"), ("GPL-3.0", "gpl 3.0 or later"),
    ("LGPL-2.1", "lgpl 2.1 only"), ("LGPL-2.1", "lgpl 2.1 or later"), ("LGPL-3.0", "lgpl 3.0 only"),
    ("LGPL-3.0", "lgpl 3.0 or later"), ("AGPL-3.0", "agpl 3.0 only"), ("AGPL-3.0", "agpl 3.0 or later"),
)

#: Sentences of license texts and notices.
PHRASES: dict[str, str] = {
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software "
                 "and associated documentation files the software to deal in the software without restriction",
    "mit-grant-whole": "permission is hereby granted free of charge to any person obtaining a copy of this software "
                       "and associated documentation files the software to deal in the software without restriction "
                       "including without limitation the rights to use copy modify merge publish distribute "
                       "sublicense and or sell copies of the software and to permit persons to whom the software is "
                       "furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or "
                  "substantial portions of the software",
    "as-is": "the software is provided as is without warranty of any kind express or implied",
    "as-is-whole": "the software is provided as is without warranty of any kind express or implied including but not "
                   "limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is "
                 "hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc-grant-2": "permission to use copy modify and distribute this software for any purpose with or without fee is "
                   "hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc-as-is": "the software is provided as is and the author disclaims all warranties with regard to this software "
                 "including all implied warranties of merchantability and fitness",
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "apache-copy-2": "you may obtain a copy of the license at http www.apache.org licenses license 2.0",
    "apache-copy-3": "you may obtain a copy of the license at https www.apache.org licenses license 2.0",
    "gnu-program": "this program is free software",
    "gnu-library": "this library is free software",
    "gpl-terms": "you can redistribute it and or modify it under the terms of the gnu general public license as "
                 "published by the free software foundation",
    "lgpl-terms": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as "
                  "published by the free software foundation",
    "agpl-terms": "you can redistribute it and or modify it under the terms of the gnu affero general public license as "
                  "published by the free software foundation",
    "later-2": "either version 2 of the license or at your option any later version",
    "later-2.1": "either version 2.1 of the license or at your option any later version",
    "later-3": "either version 3 of the license or at your option any later version",
    "mpl-terms": "this source code form is subject to the terms of the mozilla public license v",
    "mpl-copy": "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla.org mpl 2.0",
    "mpl-copy-2": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla.org mpl 2.0",
    "mpl-contributor": "contributor means each individual or legal entity that creates contributes to the creation of or "
                       "owns covered software",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "unlicense-free": "anyone is free to copy modify publish use compile sell or distribute this software either in source "
                      "code form or as a compiled binary for any purpose commercial or non commercial and by any means",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted "
                 "provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of "
                  "conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of "
                  "conditions and the following disclaimer in the documentation and or other materials "
                  "provided with the distribution",
    "bsd-names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                 "promote products derived from this software without specific prior written permission",
    "bsd-as-is": "this software is provided by the copyright holders and contributors as is and any express or implied "
                 "warranties including but not limited to the implied warranties of merchantability and fitness for a "
                 "particular purpose are disclaimed",
    "reserved": "all rights reserved",
}

_WHOLE = {f"{terms}-{later}": f"{PHRASES[terms]} {PHRASES[later]}"
          for terms in ("gpl-terms", "lgpl-terms", "agpl-terms") for later in ("later-2", "later-2.1", "later-3")}
_STATED = {f"stated:{name}:{i}:{j}": f"{words} {what}"
           for i, (name, what) in enumerate(NAMES) for j, words in enumerate(STATED)}
_STATED |= {f"cc:{name}:{k}": sentence for name, short, full in ATTRIBUTION for k, sentence in enumerate([
    *[f"{words} cc {short} 4.0" for words in STATED], f"creative commons {full} 4.0 international",
    f"creative commons {full} 4.0 international public license",
    f"this work is licensed under a creative commons {full} 4.0 international license",
    f"this work is licensed under the creative commons {full} 4.0 international license"])}
_TAGGED = {f"tag:{name}:{i}": f"spdx license identifier {tag}" for i, (name, tag) in enumerate(TAGS)}

#: All known sentences by their identifier.
SENTENCES: dict[str, str] = {**TITLES, **_STATED, **_TAGGED, **PHRASES, **_WHOLE}


def _gnu(name: str, terms: str, later: str) -> list[tuple[str, tuple[str, ...]]]:
    return [(name, (opening, *rest)) for opening in ("gnu-program", "gnu-library")
            for rest in ((f"{terms}-{later}",), (terms, later))]


#: Fixed values: (license, identifiers in order).
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    *[(key.split(":")[1], (key,)) for key in (*_STATED, *_TAGGED)],
    *[("MIT", (title, grant)) for title in ("mit-title", "mit-title-2", "mit-title-3")
      for grant in ("mit-grant", "mit-grant-whole")],
    ("MIT", ("mit-grant", "mit-notice", "as-is")), ("MIT", ("mit-grant-whole", "mit-notice", "as-is-whole")),
    ("ISC", ("isc-grant", "isc-as-is")), ("ISC", ("isc-grant-2", "isc-as-is")),
    ("Apache-2.0", ("apache-title", "apache-version")), ("Apache-2.0", ("apache-use", "apache-copy")),
    ("Apache-2.0", ("apache-use", "apache-copy-2")), ("Apache-2.0", ("apache-use", "apache-copy-3")),
    ("GPL-2.0", ("gpl-title", "v2-1991")), ("GPL-3.0", ("gpl-title", "v3-2007")),
    ("LGPL-2.1", ("lgpl-title", "v2.1-1999")), ("LGPL-3.0", ("lgpl-title", "v3-2007")),
    ("AGPL-3.0", ("agpl-title", "v3-2007-2")),
    *_gnu("GPL-2.0", "gpl-terms", "later-2"), *_gnu("GPL-3.0", "gpl-terms", "later-3"),
    *_gnu("LGPL-2.1", "lgpl-terms", "later-2.1"), *_gnu("LGPL-3.0", "lgpl-terms", "later-3"),
    *_gnu("AGPL-3.0", "agpl-terms", "later-3"),
    ("MPL-2.0", ("mpl-terms", "mpl-copy")), ("MPL-2.0", ("mpl-terms", "mpl-copy-2")),
    ("MPL-2.0", ("mpl-title", "mpl-contributor")), ("Unlicense", ("unlicense", "unlicense-free")),
    ("CC0-1.0", ("cc0-title",)), ("CC0-1.0", ("cc0-title-2",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is")),
    ("BSD", ("bsd-grant", "bsd-source", "bsd-binary")), ("Proprietary", ("reserved",)),
)

#: A license does not count where one of those before it is found. The text of one
#: clause less is part of the longer one; rights are reserved in many free licenses.
UNLESS: dict[str, tuple[str, ...]] = {
    "BSD-2-Clause": ("BSD-3-Clause",), "BSD": ("BSD-2-Clause", "BSD-3-Clause"),
    "Proprietary": tuple(dict.fromkeys(name for name, _ in RULES if name != "Proprietary")),
}

#: Every known sentence has one of these within a word.
ANCHORS: tuple[str, ...] = ("licens", "permission", "software", "copyright", "redistribut", "version", "reserved", "cc0",
                            "public", "mpl", "creative", "released")

#: Between two identifiers of a rule, in the blank-separated sequence.
BETWEEN = "( .*)? "

_GAP = r"[^A-Za-z0-9.\n]+"
_LINES = "|".join(_GAP.join(w.replace(".", "[.]") for w in s.split()) for s in (*TITLES.values(), *_STATED.values()))
#: A line that is a title, a short statement, a tag or a copyright notice.
HEAD = rf"(^|\n)((?i:{_LINES})[^A-Za-z0-9\n]*|SPDX-License-Identifier [^\n]*|Copyright [^\n]*)(\n|$)"

#: The steps of normalising, in order; the SQL twin applies the same.
STEPS: tuple[tuple[str, str], ...] = (
    (r"\r\n?", "\n"),                       # one kind of line end
    (r"(^|\n)[ \t]*(//+|/[*]+|[*]+/?|#+|;+|--+|%+|<!--+)?[ \t]*", "{1}"),  # indentation and comment marks
    (r"SPDX-License-Identifier:[ \t]*", "\nSPDX-License-Identifier "),
    (HEAD, "; {2};\n"), (HEAD, "; {2};\n"),  # twice, for heads in a row
    (r"\n(\n+|[(]?[0-9A-Za-z]{1,2}[)][ \t])", "; "),  # blank lines and list marks end a sentence
    (r"\n", " "),                           # other line ends do not
    (r"[.!?;:]+([ \t]|$)", "\n"),           # the end of a sentence
    (r"([^A-Za-z0-9. \n][^A-Za-z0-9.\n]*| [^A-Za-z0-9.\n]+)", " "),  # words, and numbers with a point
    (r" +", " "),
    (r" *\n *", "\n"),
)


def anchors(known: dict[str, str]) -> tuple[str, ...]:
    """Strings of which every known sentence has one: ``ANCHORS``, and the first word of each
    sentence without any of them. A word of a sentence is unbroken in the text, too."""
    first = {s.split()[0] for s in known.values() if s and not any(a in s for a in ANCHORS)}
    return (*ANCHORS, *sorted(first))


def sentences(text: Column) -> Column:
    for pattern, by in STEPS:
        text = F.regexp_replace(text, pattern, by.replace("{1}", "$1").replace("{2}", "$2"))
    return F.split(F.trim(lower_ascii(text)), "\n")


def scan(docs: DataFrame, known: dict[str, str] = SENTENCES,
         rules: tuple[tuple[str, tuple[str, ...]], ...] = RULES, unless: dict[str, tuple[str, ...]] = UNLESS) -> DataFrame:
    """``docs`` plus ``sentence_ids`` (array, in order) and ``licenses`` (sorted array)."""
    docs, back = set_aside(docs, "text")
    none = F.array().cast("array<string>")
    by_text = F.create_map(*[F.lit(x) for name, sentence in known.items() for x in (sentence, name)])
    text = text_or_empty()
    may = lower_ascii(text).rlike("|".join(anchors(known)))
    found = F.filter(F.when(may, sentences(text)).otherwise(none), lambda s: s.isin(*known.values()))
    marked = docs.withColumn("sentence_ids", F.transform(found, lambda s: F.element_at(by_text, s)))
    line = F.concat(F.lit(" "), F.array_join("sentence_ids", " "), F.lit(" "))
    hits = [F.when(line.rlike(" " + BETWEEN.join(rule) + " "), F.lit(name)) for name, rule in rules]
    all_of = F.array_sort(F.array_distinct(F.array_compact(F.array(*hits))))
    marked = marked.withColumn("licenses", F.when(F.size("sentence_ids") > 0, all_of).otherwise(none))
    for name, others in unless.items():
        first = F.arrays_overlap("licenses", F.array(*map(F.lit, others)))
        marked = marked.withColumn("licenses", F.when(first, F.array_remove("licenses", name)).otherwise(F.col("licenses")))
    return back(marked)


def oracle() -> str:
    """The same in DuckDB's SQL, over ``documents``; it cuts every text."""
    text = "coalesce(text, '')"
    for pattern, by in STEPS:
        shown = pattern.replace("\n", "\\n")
        plain = by.replace("{1}", "\\1").replace("{2}", "\\2").replace("\n", "' || chr(10) || '")
        text = f"regexp_replace({text}, '{shown}', '{plain}', 'g')"
    names = ", ".join(f"'{s}': '{n}'" for n, s in SENTENCES.items())
    hits = ", ".join(
        f"CASE WHEN regexp_matches(line, ' {BETWEEN.join(rule)} ') THEN '{name}' END" for name, rule in RULES)
    left = f"list_sort(list_distinct(list_filter([{hits}], lambda x: x IS NOT NULL)))"
    for name, others in UNLESS.items():
        left = (f"list_filter({left}, lambda x: x <> '{name}' OR NOT regexp_matches(line, '"
                + "|".join(f" {BETWEEN.join(rule)} " for n, rule in RULES if n in others) + "'))")
    return f"""SELECT doc_id, len(ids)::BIGINT AS n_sentences, array_to_string(ids, ' ') AS sentence_ids,
      array_to_string({left}, ',') AS licenses
      FROM (SELECT *, ' ' || array_to_string(ids, ' ') || ' ' AS line FROM (SELECT doc_id,
        list_transform(list_filter(string_split(trim(translate({text}, '{UPPER}', '{LOWER}')), chr(10)),
          lambda x: names[x] IS NOT NULL), lambda x: names[x]) AS ids
        FROM documents, (SELECT MAP {{{names}}} AS names)))"""
