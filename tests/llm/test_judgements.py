"""URL rules, licences, components and the quality classifier."""

import random

import pytest
from pyspark.sql import functions as F

from sluice.llm.components import components
from sluice.llm.cotraining import classify, features_of, keep_good, lexicon_of, train
from sluice.llm.licences import SENTENCES, scan_licences
from sluice.llm.queries import URL_RULES
from sluice.llm.registry import QUERIES, SQL
from sluice.llm.url_rules import judge_urls, link_edges

SF_DIR = "/root/testdata/sf0.01"


def plain_components(edges):
    label = {}

    def root(x):
        label.setdefault(x, x)
        while label[x] != x:
            x = label[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            ra, rb = root(a), root(b)
            label[max(ra, rb)] = min(ra, rb)
    return {x: root(x) for x in label}


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    r = random.Random(seed)
    edges = [(r.randint(0, 120), r.randint(0, 120)) for _ in range(90)]
    edges += [(200 + i, 201 + i) for i in range(40)] + [(300, 300 + i) for i in range(50)] + [(7, 7), (None, 3), (3, None), (999, 999)]
    found = components(spark.createDataFrame(edges, "a LONG, b LONG"))
    assert {x.node: x.component for x in found.collect()} == plain_components(edges)
    assert components(spark.createDataFrame([], "a STRING, b STRING")).count() == 0


def plain_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    after = rest[cut:]
    end = min([after.find(c) for c in "?#" if c in after], default=len(after))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    return host, after[:end]


def plain_rule(host, path, rules):
    fits = []
    for rule, action in rules:
        own, start = rule.split("/", 1)
        if (host == own or host.endswith("." + own)) and path.startswith("/" + start):
            fits.append((len(rule), rule, action))
    return max(fits)[1:] if fits else (None, None)


def test_rules_and_aliases(spark):
    rules = URL_RULES
    page = '<html><LINK rel="Canonical" href="%s"><meta http-equiv=refresh content="0; url=%s">'
    pages = [
        (0, None, None), (1, "", ""), (2, "nothing here", None), (3, "http://a.NET", None), (4, "x://A.net/b?q#f", None),
        (5, "http://example.net/en/1#top", None), (6, "http://notexample.net/en/1", None), (7, "https://w.org/fr/?a", None),
        (8, "http://c.com/p/1", page % ("http://bad.net/x", "")),  # alias of a blocked address
        (9, "http://d.com/q", page % ("//c.com/p/1", "/q2?a=1&amp;b=2")), (10, "http://d.com/q2?a=1&b=2#z", None),
        (11, "http://e.com/r", page % ("http://bad.net/y", "http://ok.org/fr/z")),  # a block and an allow
        (12, "http://bad.net/y", None), (13, "http://f.com/s", page % ("t", "#")), (14, "http://f.com/t", None), (14, "http://f.com/t", None),
        (15, "http://g.com/", "<link rel=stylesheet href=http://bad.net/x>canonical"),
    ]
    df = spark.createDataFrame([(*p, "x", "y") for p in pages], "page_id LONG, url STRING, html STRING, host STRING, rule STRING")
    table = spark.createDataFrame(rules, "rule STRING, action STRING")
    found = judge_urls(df, table).collect()
    assert len(found) == len(pages)
    verdicts = {}
    for r in found:
        url = next(p[1] for p in pages if p[0] == r.page_id)
        host, path = plain_url(url)
        rule, action = plain_rule(host, path, rules)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert action is None or r.verdict == action
        verdicts[r.page_id] = r.verdict
    assert [verdicts[i] for i in (8, 9, 10)] == ["block"] * 3
    assert [verdicts[i] for i in (0, 1, 2, 11, 13, 14, 15)] == ["allow"] * 7
    assert verdicts[12] == "block"
    more = spark.createDataFrame([("http://f.com/t", "http://z.net/")], "a STRING, b STRING")
    again = {r.page_id: r.verdict for r in judge_urls(df, table, more).collect()}
    assert again[13] == again[14] == "block"
    assert judge_urls(df.limit(0), table).count() == 0
    assert {r.verdict for r in judge_urls(df, table.limit(0)).collect()} == {"allow"}


def test_long_hosts_and_rules_of_many_labels(spark):
    """Only suffixes as long as some rule are made; the longest rule still wins, in hosts of any length."""
    deep = ".".join(f"l{i}" for i in range(20000))
    rules = [("net/", "block"), ("b.c.d.net/", "allow"), (".net/", "block"), ("l19999/", "block"), (f"{deep}/x", "allow"), ("", "block"), ("noslash", "block")]
    hosts = [deep, "a." * 30000 + "net", "a.b.c.d.net", "b.c.d.net", "c.d.net", "a..net", "net", "xnet", "net.", ".", "", "l19999"]
    pages = [(i, f"http://{h}{path}") for i, (h, path) in enumerate((h, path) for h in hosts for path in ("", "/", "/x" * 5000))]
    df = spark.createDataFrame(pages, "page_id LONG, url STRING")
    found = {r.page_id: r for r in judge_urls(df, spark.createDataFrame(rules, "rule STRING, action STRING"), html=None).collect()}
    given = [r for r in rules if "/" in r[0]]
    for i, url in pages:
        host, path = plain_url(url)
        rule, action = plain_rule(host, path, given)
        assert (found[i].host, found[i].path, found[i].rule, found[i].verdict) == (host, path, rule, action or "allow")


def test_link_edges_compile(spark):
    """The columns of the edges are not inlined into the filter on them."""
    pages = spark.createDataFrame([(1, "http://a.net/b", "<link rel=canonical href='/c'>")], "page_id LONG, url STRING, html STRING")
    edges = link_edges(pages)
    assert [tuple(r) for r in edges.collect()] == [("a.net/b", "a.net/c")]
    plan = edges._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line and "target" in line]
    assert filters and not any("regexp" in line.lower() for line in filters)


def test_licence_sequences(spark):
    name = {v: k for k, v in reversed(SENTENCES.items())}
    say = lambda *ids: ".\n".join(name[i].capitalize() for i in ids) + "."
    wrapped = say("mit-grant", "mit-notice").replace(" software", "\nsoftware") + " " + say("mit-disclaimer")
    texts = {
        0: (None, "", ""), 1: ("", "", ""), 2: ("Released under the MIT License.", "mit-line", "MIT"),
        3: ("x\n  LICENSED under the Apache License, Version 2.0.\ny", "apache2-line", "Apache-2.0"),
        4: (wrapped, "mit-grant,mit-notice,mit-disclaimer", "MIT"),
        5: (say("gpl3-later-grant", "gpl-warranty", "gpl-details"), "gpl3-later-grant,gpl-warranty,gpl-details", "GPL-3.0-or-later"),
        6: (say("mit-notice", "mit-grant"), "mit-notice,mit-grant", ""),  # out of order
        7: (say("mit-line", "apache2-line", "mit-line"), "mit-line,apache2-line,mit-line", "MIT,Apache-2.0"),
        8: ("license " * 20000, "", ""), 9: ("A licensed permit.", "", ""),
    }
    rows = [(k, t, "x") for k, (t, _, _) in texts.items()] * 2
    found = scan_licences(spark.createDataFrame(rows, "doc_id LONG, text STRING, licences STRING")).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (",".join(r.sentence_ids), ",".join(r.licences)) == texts[r.doc_id][1:]
    with pytest.raises(ValueError):
        scan_licences(spark.createDataFrame(rows, "doc_id LONG, text STRING, x STRING"), sentences={"no mark": "a"})


APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
GNU = """This %s is free software%s you can redistribute it and/or modify
it under the terms of the GNU %s as published by
the Free Software Foundation%s either version %s of the License, or
(at your option) any later version.

This %s is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU %s for more details."""
BSD = """Copyright (c) 2020, Some Body

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution."""
BSD_NAMES = """

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""


def gnu(name, version, thing="program", colon=":", semicolon=","):
    return GNU % (thing, colon, name, semicolon, version, thing, name)


def comment(text, mark):
    return "".join(f"{mark} {line}".rstrip() + "\n" for line in text.split("\n"))


PRINTED_NOTICES = {
    APACHE: "Apache-2.0",
    BSD: "BSD-2-Clause",
    BSD + BSD_NAMES: "BSD-3-Clause",
    BSD[: BSD.index("1.")]: "LicenseRef-BSD",
    gnu("General Public License", "3"): "GPL-3.0-or-later",
    gnu("General Public License", "2", colon=";", semicolon=";"): "GPL-2.0-or-later",
    gnu("Lesser General Public License", "2.1", "library", ";", ";"): "LGPL-2.1-or-later",
    gnu("Affero General Public License", "3"): "AGPL-3.0-or-later",
    "MIT License\n\nCopyright (c) 2020 A. Body\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software.\n": "MIT",
}
LICENCE_LINES = {
    "SPDX-License-Identifier: MIT": "MIT", "// SPDX-License-Identifier: GPL-2.0-or-later\npackage main;": "GPL-2.0-or-later",
    "/* spdx-license-identifier : LGPL-2.1-only */\nint x;": "LGPL-2.1-only", "Released under the Boost Software License, Version 1.0.": "BSL-1.0",
    "This work is licensed under a Creative Commons Attribution 4.0 International License.": "CC-BY-4.0",
    "SPDX-License-Identifier:\nMITx": "", "The identifier: MIT. A license it is not.": "",
}


def test_printed_notices_and_the_sql(spark):
    """Notices as files print them: wrapped, with blank lines, behind comment marks, by either line end; SQL agrees on all."""
    cases = [(text, wanted) for text, wanted in (PRINTED_NOTICES | LICENCE_LINES).items()]
    cases += [(comment(text, mark), wanted) for text, wanted in PRINTED_NOTICES.items() for mark in ("#", " *", "//")]
    cases += [(text.replace("\n", "\r\n"), wanted) for text, wanted in LICENCE_LINES.items()]
    cases += [(APACHE + "\n\n" + BSD + BSD_NAMES, "Apache-2.0,BSD-3-Clause"), (None, ""), ("", ""), ("\f\f\n\n \n", ""), ("license.\n" * 5000, "")]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id LONG, text STRING")
    found = {r.doc_id: (",".join(r.sentence_ids), ",".join(r.licences)) for r in scan_licences(docs).collect()}
    wrong = [(text, wanted, found[i]) for i, (text, wanted) in enumerate(cases) if found[i][1] != wanted]
    assert not wrong, wrong[:3]
    import duckdb

    with duckdb.connect() as db:
        db.register("documents", docs.toPandas())
        assert {r[0]: r[1:] for r in db.execute(SQL["op4_licence_sentences"]).fetchall()} == found
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
        told = db.execute(SQL["op4_licence_sentences"]).fetchall()
    query = QUERIES["op4_licence_sentences"](spark, SF_DIR).select("doc_id", "sentence_ids", "licences")
    assert sorted(told) == sorted(tuple(r) for r in query.collect())


def test_classifier_on_labels_it_has_not_seen(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    seen, unseen = labels.where("doc_id % 3 > 0"), labels.where("doc_id % 3 = 0")
    found = classify(docs, seen)
    assert found.count() == docs.count()
    right = found.join(unseen, "doc_id").selectExpr("avg(cast(kept = (quality = 1) AS INT))", "count(*)").first()
    assert right[0] > 0.97 and right[1] > 100
    lexicon = lexicon_of(docs, seen)
    model = train(features_of(docs, lexicon), seen, lexicon)
    good = keep_good(docs, model)
    assert good.columns == docs.columns
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in found.where("kept").collect()}


def test_classifier_reads_letters_not_shapes_alone(spark):
    """Good texts with their letters swapped, a for z, keep every shape; they are rejected, the others are not."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    lexicon = lexicon_of(docs, labels)
    model = train(features_of(docs, lexicon), labels, lexicon)
    good = docs.join(labels.where("quality = 1"), "doc_id", "left_semi").where("n_chars > 200")
    letters = "abcdefghijklmnopqrstuvwxyz"
    swap = F.translate("text", letters + letters.upper(), letters[::-1] + letters[::-1].upper())
    n = good.count()
    assert n > 100
    assert keep_good(good, model).count() > 0.98 * n
    assert keep_good(good.withColumn("text", swap), model).count() < 0.02 * n


def test_classifier_on_odd_rows(spark):
    rows = [(None, None, None, None, None), (1, "", "", "", 0), (1, "a b", None, "s", -5), (2, "x" * 100000, "en", None, 7)] * 2
    docs = spark.createDataFrame([(*r, "z") for r in rows], "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, score STRING")
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (77, 0)], "doc_id LONG, quality INT")
    assert classify(docs, labels).count() == len(rows)
    unlabelled = classify(docs, labels.limit(0)).collect()
    assert all(r.score == 0.5 and r.kept for r in unlabelled) and len(unlabelled) == len(rows)
    assert classify(docs.limit(0), labels).count() == 0


def test_queries_of_whole_tables(spark):
    for name, key in (("op1_redirect_equivalence", "page_id"), ("op4_licence_sentences", "doc_id")):
        found = QUERIES[name](spark, "/root/testdata/sf0.001").toPandas()
        assert found[key].is_unique and len(found) >= 200 or name.startswith("op1")


def test_texts_meet_their_labels_the_same_way_whatever_the_number(spark):
    from sluice.llm.cotraining import _labelled

    docs = spark.createDataFrame([(i, f"text {i}") for i in range(40)] + [(None, "x"), (3, "again")], "doc_id LONG, text STRING")
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 40, 2)] + [(2, 1), (None, 1), (99, 1)], "doc_id LONG, quality INT")
    found = _labelled(docs, labels, "doc_id", "text", "quality")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
    held = {r[0] for r in spark.range(100).where("pmod(xxhash64(id), 5) = 0").collect()}
    learned = [i for i in range(0, 40, 2) if i not in held]
    assert {r.text: r.label for r in found.collect()} == {f"text {i}": 0.5 if i == 2 else 0.0 for i in learned}
