"""Licence recognition by known sentences and ordered rules, in DataFrame expressions only.

A text is cut into sentences, each normalised to lower-case words and looked up among
known licence sentences. What remains of a text is a sequence of sentence identifiers,
which is matched against rules: a rule names a licence and the identifiers that must
follow each other. Rules are tried in order; sentences that a rule has used are gone for
the later ones, so whole notices come before the lines they are made of.

Everything happens within a row: no shuffle, no join, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Licences by SPDX identifier, with the stem of their sentence identifiers and the
# names that notices call them by, normalised.
NAMES = {
    "MIT": ("mit", "mit license"),
    "Apache-2.0": ("apache2", "apache license version 2 0", "apache license 2 0", "apache 2 0 license"),
    "GPL-2.0-only": ("gpl2", "gnu general public license version 2", "gnu general public license v2 0"),
    "GPL-3.0-only": ("gpl3", "gnu general public license version 3", "gnu general public license v3 0"),
    "LGPL-2.1-only": ("lgpl21", "gnu lesser general public license version 2 1", "gnu lesser general public license v2 1"),
    "LGPL-3.0-only": ("lgpl3", "gnu lesser general public license version 3", "gnu lesser general public license v3 0"),
    "AGPL-3.0-only": ("agpl3", "gnu affero general public license version 3", "gnu affero general public license v3 0"),
    "BSD-2-Clause": ("bsd2", "bsd 2 clause license", "2 clause bsd license", "simplified bsd license"),
    "BSD-3-Clause": ("bsd3", "bsd 3 clause license", "3 clause bsd license", "new bsd license"),
    "ISC": ("isc", "isc license"),
    "MPL-2.0": ("mpl2", "mozilla public license 2 0", "mozilla public license version 2 0"),
    "EPL-1.0": ("epl1", "eclipse public license 1 0", "eclipse public license v1 0", "eclipse public license version 1 0"),
    "EPL-2.0": ("epl2", "eclipse public license 2 0", "eclipse public license v2 0", "eclipse public license version 2 0"),
    "BSL-1.0": ("boost1", "boost software license 1 0", "boost software license version 1 0"),
    "Unlicense": ("unlicense", "unlicense"),
    "Zlib": ("zlib", "zlib license"),
    "CC0-1.0": ("cc0", "cc0 1 0 license", "creative commons zero v1 0 universal license", "creative commons cc0 1 0 universal license"),
    "CC-BY-4.0": ("cc-by4", "creative commons attribution 4 0 international license", "cc by 4 0 license"),
    "CC-BY-SA-4.0": ("cc-by-sa4", "creative commons attribution sharealike 4 0 international license", "cc by sa 4 0 license"),
    "CC-BY-NC-4.0": ("cc-by-nc4", "creative commons attribution noncommercial 4 0 international license", "cc by nc 4 0 license"),
}
# How a line that names its licence begins.
LEADS = ("licensed under the", "released under the", "distributed under the", "available under the", "this project is licensed under the", "this work is licensed under the", "this work is licensed under a")
# Identifiers that a tag may give, beside those that have names above.
TAGS = ("GPL-2.0-or-later", "GPL-3.0-or-later", "LGPL-2.1-or-later", "LGPL-3.0-or-later", "AGPL-3.0-or-later")

# Sentences of public licence notices, normalised, with their identifiers. Colons and
# semicolons end sentences too, so notices stand here as the parts between.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit-disclaimer",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license": "apache2-grant",
    "licensed under the apache license version 2 0 the license": "apache2-head",
    "you may not use this file except in compliance with the license": "apache2-compliance",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "apache2-copy",
    "you may obtain a copy of the license at https www apache org licenses license 2 0": "apache2-copy",
    "you may obtain a copy of the license at": "apache2-copy-at",
    "http www apache org licenses license 2 0": "apache2-address",
    "https www apache org licenses license 2 0": "apache2-address",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache2-disclaimer",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3-later-grant",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2-later-grant",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3-later-grant",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2-later-grant",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl-grant",
    "you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation": "gpl2-grant",
    "you can redistribute it and or modify it under the terms of the gnu general public license version 3 as published by the free software foundation": "gpl3-grant",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation": "lgpl-grant",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version": "lgpl21-later-grant",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "lgpl3-later-grant",
    "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation": "agpl-grant",
    "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "agpl3-later-grant",
    "version 2 of the license": "v2-only",
    "version 3 of the license": "v3-only",
    "either version 2 of the license or at your option any later version": "v2-later",
    "either version 2 1 of the license or at your option any later version": "v21-later",
    "either version 3 of the license or at your option any later version": "v3-later",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gpl-warranty",
    "this program is distributed in the hope that it will be useful but without any warranty": "gpl-hope",
    "this library is distributed in the hope that it will be useful but without any warranty": "gpl-hope",
    "without even the implied warranty of merchantability or fitness for a particular purpose": "gpl-implied",
    "see the gnu general public license for more details": "gpl-details",
    "see the gnu lesser general public license for more details": "lgpl-details",
    "see the gnu affero general public license for more details": "agpl-details",
    "licensed under cc by nc 4 0": "cc-by-nc4-line",
    "licensed under cc by 4 0": "cc-by4-line",
    "licensed under cc by sa 4 0": "cc-by-sa4-line",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-names",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "bsd-disclaimer",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl2-grant",
    "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which accompanies this distribution and is available at http www eclipse org legal epl v10 html": "epl1-grant",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0": "epl2-grant",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following": "boost1-grant",
    "distributed under the boost software license version 1 0": "boost1-line",
    "in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all copyright interest in the software to the public domain": "unlicense-grant",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "zlib-grant",
    "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work": "cc0-grant",
}
LINES = {f"{lead} {name}": f"{stem}-line" for stem, *names in NAMES.values() for name in names for lead in LEADS}
SPDX = {f"spdx license identifier {spdx.lower().replace('-', ' ').replace('.', ' ')}": f"spdx-{spdx.lower()}" for spdx in (*NAMES, *TAGS)}
SENTENCES = {**LINES, **SPDX, **NOTICES}

# In order, the licence that a run of sentences states.
NOTICE_RULES = (
    ("MIT", ("mit-grant", "mit-notice", "mit-disclaimer")),
    ("Apache-2.0", ("apache2-grant", "apache2-copy", "apache2-disclaimer")),
    ("Apache-2.0", ("apache2-head", "apache2-compliance", "apache2-copy", "apache2-disclaimer")),
    ("Apache-2.0", ("apache2-head", "apache2-compliance", "apache2-copy-at", "apache2-address", "apache2-disclaimer")),
    ("GPL-3.0-or-later", ("gpl3-later-grant", "gpl-warranty", "gpl-details")),
    ("GPL-2.0-or-later", ("gpl2-later-grant", "gpl-warranty", "gpl-details")),
    ("GPL-3.0-or-later", ("gpl3-later-grant", "gpl-hope", "gpl-implied", "gpl-details")),
    ("GPL-2.0-or-later", ("gpl2-later-grant", "gpl-hope", "gpl-implied", "gpl-details")),
    ("GPL-3.0-or-later", ("gpl-grant", "v3-later", "gpl-hope", "gpl-implied", "gpl-details")),
    ("GPL-2.0-or-later", ("gpl-grant", "v2-later", "gpl-hope", "gpl-implied", "gpl-details")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("GPL-3.0-or-later", ("gpl3-later-grant",)),
    ("GPL-2.0-or-later", ("gpl2-later-grant",)),
    ("GPL-3.0-or-later", ("gpl-grant", "v3-later")),
    ("GPL-2.0-or-later", ("gpl-grant", "v2-later")),
    ("GPL-3.0-only", ("gpl-grant", "v3-only")),
    ("GPL-2.0-only", ("gpl-grant", "v2-only")),
    ("GPL-3.0-only", ("gpl3-grant",)),
    ("GPL-2.0-only", ("gpl2-grant",)),
    ("LGPL-2.1-or-later", ("lgpl21-later-grant",)),
    ("LGPL-3.0-or-later", ("lgpl3-later-grant",)),
    ("LGPL-2.1-or-later", ("lgpl-grant", "v21-later")),
    ("LGPL-3.0-or-later", ("lgpl-grant", "v3-later")),
    ("AGPL-3.0-or-later", ("agpl3-later-grant",)),
    ("AGPL-3.0-or-later", ("agpl-grant", "v3-later")),
    ("Apache-2.0", ("apache2-grant",)),
    ("Apache-2.0", ("apache2-head",)),
    ("Apache-2.0", ("apache2-address",)),
    ("ISC", ("isc-grant",)),
    ("MPL-2.0", ("mpl2-grant",)),
    ("EPL-1.0", ("epl1-grant",)),
    ("EPL-2.0", ("epl2-grant",)),
    ("BSL-1.0", ("boost1-grant",)),
    ("Unlicense", ("unlicense-grant",)),
    ("Zlib", ("zlib-grant",)),
    ("CC0-1.0", ("cc0-grant",)),
    ("LicenseRef-BSD", ("bsd-grant",)),
)
RULES = (
    *NOTICE_RULES,
    *((spdx, (f"{stem}-line",)) for spdx, (stem, *_) in NAMES.items()),
    *((spdx, (f"spdx-{spdx.lower()}",)) for spdx in (*NAMES, *TAGS)),
)
# Every known sentence holds one of these, so other texts need no cutting.
MARKS = ("licens", "permi", "copyright", "warrant")

# A tag's colon ends no sentence.
TAG = r"(?i)(spdx-license-identifier)[ \t]*:"
SENTENCE_END = r"([.;:!?][\"')]*)[ \t\n\r\f]+"
# A line without a letter or digit, such as a blank one or that of a comment's frame.
BLANK_LINE = r"\n[^\p{L}\p{N}\n]*\n"
NOT_WORD = r"[^\p{L}\p{N}]+"


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), NOT_WORD, " "))


def _known(sentences: Column, known: Column) -> Column:
    return F.filter(F.transform(sentences, lambda s: F.element_at(known, normalised(s))), lambda x: x.isNotNull())


def sentence_ids(text: Column, sentences: dict[str, str] = SENTENCES) -> Column:
    """Identifiers of the known sentences of a text, in order.

    Sentences end at punctuation before white space. A line feed may end one or lie inside
    it; both readings are tried and the one that knows more sentences counts, line ends
    first. In the second, blank lines still end sentences, so that titles and addresses
    that stand alone are not read into what follows.
    """
    known = F.create_map(*[F.lit(x) for pair in sentences.items() for x in pair])
    text = F.regexp_replace(text, TAG, "$1 ")
    ended = F.split(F.regexp_replace(text, SENTENCE_END, "$1\n"), "\n")
    paragraphs = F.regexp_replace(text, BLANK_LINE, "\f\f")
    joined = F.split(F.regexp_replace(F.translate(paragraphs, "\n\r", "  "), SENTENCE_END, "$1\f\f"), "\f\f")
    # Each reading is looked up once: the lambda holds it for comparison and result.
    both = F.transform(F.array(F.struct(_known(ended, known).alias("e"), _known(joined, known).alias("j"))), lambda x: F.when(F.size(x["j"]) > F.size(x["e"]), x["j"]).otherwise(x["e"]))
    return both[0]


def stated_licences(ids: Column, rules=RULES) -> Column:
    """Licences stated by a sequence of identifiers, in the order of the rules."""
    table = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(f",{',,'.join(run)},").alias("run")) for name, run in rules])
    # Each identifier stands between commas of its own; a used run leaves a bar.
    sequence = F.array_join(F.transform(ids, lambda x: F.concat(F.lit(","), x, F.lit(","))), "")
    return F.aggregate(
        table,
        F.struct(sequence.alias("left"), F.array().cast("array<string>").alias("found")),
        lambda s, r: F.struct(
            F.replace(s["left"], r["run"], F.lit("|")).alias("left"),
            F.when(F.contains(s["left"], r["run"]), F.array_union(s["found"], F.array(r["name"]))).otherwise(s["found"]).alias("found"),
        ),
        lambda s: s["found"],
    )


def scan_licences(docs: DataFrame, text: str = "text", key: str = "doc_id", sentences: dict[str, str] = SENTENCES, rules=RULES) -> DataFrame:
    """One row per row of `docs`: key, sentence_ids and licences (arrays, empty where none).

    Null and empty texts state nothing. Repeated rows are rows of their own; other columns
    are not read.
    """
    unmarked = [s for s in sentences if not any(m in s for m in MARKS)]
    if unmarked:
        raise ValueError(f"sentences without any of {MARKS}: {unmarked}")
    lower = F.lower(F.col(text))
    marked = F.contains(lower, F.lit(MARKS[0]))
    for mark in MARKS[1:]:
        marked = marked | F.contains(lower, F.lit(mark))
    none = F.array().cast("array<string>")
    ids = F.when(marked, sentence_ids(F.col(text), sentences)).otherwise(none)
    found = docs.select(key, ids.alias("sentence_ids"))
    return found.select(key, "sentence_ids", F.when(F.size("sentence_ids") > 0, stated_licences(F.col("sentence_ids"), rules)).otherwise(none).alias("licences"))


def scan_sql(sentences: dict[str, str] = SENTENCES, rules=RULES) -> str:
    """SQL for DuckDB that gives the rows of the query on `documents`: sentences are looked up by a join."""
    known = ", ".join(f"('{s}', '{i}')" for s, i in sentences.items())
    runs = ", ".join(f"{{'l': ',{',,'.join(run)},', 'r': ',{name},'}}" for name, run in rules)
    return f"""
WITH known(sentence, id) AS (VALUES {known}),
texts AS (SELECT row_number() OVER () AS n, doc_id, regexp_replace(text, '{TAG}', '\\1 ', 'g') AS t FROM documents),
readings AS (
  SELECT n, 0 AS way, string_split(regexp_replace(t, '{_quoted(SENTENCE_END)}', '\\1' || chr(10), 'g'), chr(10)) AS parts FROM texts
  UNION ALL
  SELECT n, 1, string_split(regexp_replace(translate(regexp_replace(t, '{BLANK_LINE}', chr(12) || chr(12), 'g'), chr(10) || chr(13), '  '),
    '{_quoted(SENTENCE_END)}', '\\1' || chr(12) || chr(12), 'g'), chr(12) || chr(12)) FROM texts
),
parts AS (SELECT n, way, unnest(parts) AS part, generate_subscripts(parts, 1) AS place FROM readings),
found AS (
  SELECT n, way, count(*) AS c, list(id ORDER BY place) AS ids
  FROM parts JOIN known ON trim(regexp_replace(lower(part), '{NOT_WORD}', ' ', 'g')) = sentence GROUP BY n, way
),
best AS (SELECT n, arg_max(ids, c * 2 - way) AS ids FROM found GROUP BY n),
stated AS (
  SELECT n, ids, list_reduce(list_concat([{{'l': ',' || array_to_string(ids, ',,') || ',', 'r': ''}}], [{runs}]), lambda s, x: {{
    'l': replace(s.l, x.l, '|'),
    'r': CASE WHEN contains(s.l, x.l) AND NOT contains(s.r, x.r) THEN s.r || x.r ELSE s.r END}}).r AS licences
  FROM best
)
SELECT doc_id, coalesce(array_to_string(ids, ','), '') AS sentence_ids, coalesce(replace(trim(licences, ','), ',,', ','), '') AS licences
FROM texts LEFT JOIN stated USING (n)
"""


def _quoted(text: str) -> str:
    return text.replace("'", "''")
