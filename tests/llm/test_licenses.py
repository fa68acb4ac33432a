"""License notices as published, wrapped at every width, plain and in comments."""

import textwrap

import pytest

from quireflow.llm import licenses

WARRANTY = ('THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED '
            'TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL '
            'THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM.')
BSD = ["Copyright (c) 2019, Some Body", "All rights reserved.",
       "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
       "following conditions are met:",
       "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
       "following disclaimer.",
       "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
       "following disclaimer in the documentation and/or other materials provided with the distribution."]
NAMES = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
         "products derived from this software without specific prior written permission.")
DISCLAIMED = ('THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
              'WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A '
              'PARTICULAR PURPOSE ARE DISCLAIMED.')


def gnu(kind, version, between=","):
    opening = "library" if "Lesser" in kind else "program"
    return [f"This {opening} is free software{':' if between == ',' else ';'} you can redistribute it and/or modify it under "
            f"the terms of the GNU {kind}General Public License as published by the Free Software Foundation{between} either "
            f"version {version} of the License, or (at your option) any later version."]


#: Paragraphs of each notice.
NOTICES = {
    "MIT": ["MIT License", "Copyright (c) 2020 Some Body",
            'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
            'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
            'the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and '
            'to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
            "of the Software.", WARRANTY],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies.",
            'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING '
            'ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE.'],
    "BSD-2-Clause": [*BSD, DISCLAIMED],
    "BSD-3-Clause": [*BSD, NAMES, DISCLAIMED],
    "Apache-2.0": ['Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
                   'compliance with the License. You may obtain a copy of the License at',
                   "http://www.apache.org/licenses/LICENSE-2.0"],
    "GPL-2.0": gnu("", "2", ";"), "GPL-3.0": gnu("", "3"), "LGPL-2.1": gnu("Lesser ", "2.1", ";"),
    "LGPL-3.0": gnu("Lesser ", "3"), "AGPL-3.0": gnu("Affero ", "3"),
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
                "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "Unlicense": ["This is free and unencumbered software released into the public domain.",
                  "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source "
                  "code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."],
    "CC-BY-SA-4.0": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-ND-4.0": ["This work is licensed under the Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 "
                        "International License."],
    "CC0-1.0": ["CC0 1.0 Universal", "Statement of Purpose"],
}
MARKS = ["", "# ", "// ", " * ", "    ", ";; ", "-- "]


def test_notices_at_every_width(spark):
    rows = []
    for name, paragraphs in NOTICES.items():
        for width in range(40, 101):
            lines = "\n\n".join(textwrap.fill(p, width, break_on_hyphens=False) for p in paragraphs).split("\n")
            mark = MARKS[width % len(MARKS)]
            for m in {"", mark}:
                rows.append((name, width, m, "\n".join((m + line).rstrip() for line in lines)))
    docs = spark.createDataFrame(rows, "name string, width int, mark string, text string")
    wrong = [(r.name, r.width, r.mark, r.licenses) for r in licenses.scan(docs).collect() if r.licenses != [r.name]]
    assert not wrong


@pytest.mark.parametrize("text, expected", [
    ("# SPDX-License-Identifier: MPL-2.0\nimport os", ["MPL-2.0"]), ("/* SPDX-License-Identifier: MIT */\nint x;", ["MIT"]),
    ("GNU LESSER GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n\nCopyright (C) 2007", ["LGPL-3.0"]),
    ("   GNU GENERAL PUBLIC LICENSE\r\n      Version 2, June 1991\r\n", ["GPL-2.0"]),
    ("Tool.\nLicensed under the MIT License\nAuthor: someone", ["MIT"]), ("Copyright 2020 X. All rights reserved.", ["Proprietary"]),
    ("Copyright 2020 X. All rights reserved.\nReleased under the ISC license.", ["ISC"]),
    ("This is not software that anyone has licensed under the MIT license or so", []),
    ("Copyright (c) A\nCopyright (c) B\nCopyright (c) C\nReleased under CC0 1.0", ["CC0-1.0"]),
    ("the version of the public\n" * 3000, []), ("", []), (None, []),
])
def test_short_statements(spark, text, expected):
    docs = spark.createDataFrame([(text, "mine", 3)], "text string, licenses string, n int")
    r = licenses.scan(docs).first()
    assert r.licenses == expected and r.n == 3


def test_every_sentence_has_an_anchor():
    assert all(any(a in w for w in s.split() for a in licenses.ANCHORS) for s in licenses.SENTENCES.values())
    assert licenses.anchors({"a": "first words"}) == (*licenses.ANCHORS, "first")
    assert {i for _, rule in licenses.RULES for i in rule} <= set(licenses.SENTENCES)
