import math
import re
import textwrap

from pyspark.sql import functions as F

from rentscope.llm import license_scan as L

MIT, APACHE, GPL = (L.TEMPLATES[k][0] for k in ("MIT", "Apache-2.0", "GPL-3.0"))


def cosine(a, b, known):
    def vec(t):
        w = re.findall(r"[a-z0-9]+(?:\.[0-9]+)*", t.lower())
        return {x: (1 + math.log(w.count(x))) * known.idf.get(x, known.unknown) for x in w}
    u, v = vec(a), vec(b)
    norm = math.sqrt(sum(x * x for x in u.values())) * math.sqrt(sum(x * x for x in v.values()))
    return sum(u[x] * v.get(x, 0) for x in u) / norm


def test_scores_equal_brute_force(spark):
    known = L.Templates(L.TEMPLATES)
    texts = [MIT, GPL + " Really.", "licensed under the apache license 2.0 only", "Copyright 2020 Jane", "license license", "CC BY-NC 4.0"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", L.best_template(F.col("t"), known).alias("b"))
    for r in df.collect():
        best = min((-round(cosine(r.t, x, known), 6), k) for k, xs in L.TEMPLATES.items() for x in xs)
        assert abs(r.b.score + best[0]) < 2e-6 and (r.b.license == best[1])


def test_nearest_ancestor(spark):
    rows = [("LICENSE", MIT), ("a/b/COPYING", GPL), ("a/x.py", "code"), ("a/b/c/y.py", "code"), ("a/b/z.py", f"# head\n{APACHE}\ncode"),
            ("/a/b/c/y.py", None), (None, None), ("a/b/LICENSE-MIT", MIT + " extra words here"), ("a/b/c", ""), ("a/b/c/y.py", "code")]
    got = [(r.path, r.license, r.origin, r.from_directory) for r in L.scan(
        spark.createDataFrame(rows, "path string, text string").withColumn("holder", F.lit(1)).withColumn("license", F.lit(0))).collect()]
    want = [("LICENSE", "MIT", "own", None), ("a/b/COPYING", "GPL-3.0", "own", None), ("a/x.py", "MIT", "inherited", ""),
            ("a/b/c/y.py", "GPL-3.0", "inherited", "a/b"), ("a/b/z.py", "Apache-2.0", "own", None),
            ("/a/b/c/y.py", "GPL-3.0", "inherited", "a/b"), (None, "MIT", "inherited", ""), ("a/b/LICENSE-MIT", "MIT", "own", None),
            ("a/b/c", "GPL-3.0", "inherited", "a/b"), ("a/b/c/y.py", "GPL-3.0", "inherited", "a/b")]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_no_licence_and_empty(spark):
    df = spark.createDataFrame([("s/f.txt", "nothing to see"), ("s/LICENSE", "all of the words")], "path string, text string")
    assert {(r.origin, r.license) for r in L.scan(df).collect()} == {("none", None)}
    assert L.scan(df.limit(0)).count() == 0


def test_every_template_is_found_as_a_header(spark):
    rows, want = [], {}
    for name, texts in L.TEMPLATES.items():
        for k, t in enumerate(texts):
            for form, text in (("plain", t), ("code", f"/*\n * " + "\n * ".join(textwrap.wrap(t, 50)) + "\n */\n\nint x = 1;\n")):
                rows.append((f"{name}-{k}-{form}.c", text))
                want[rows[-1][0]] = name
    rows.append(("only.c", "# Distributed under GPL-3.0-only.\n\nx = 1"))
    want["only.c"] = "GPL-3.0"
    got = {r.path: r.own_license for r in L.scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert got == want


def test_headings_and_identifiers(spark):
    openings = {
        "GPL-2.0": "                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n\n Copyright (C) 1989, 1991 Free "
                   "Software Foundation, Inc.\n Everyone is permitted to copy and distribute verbatim copies\n of this license document, but "
                   "changing it is not allowed.\n\n                            Preamble\n",
        "GPL-3.0": "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software "
                   "Foundation, Inc. <https://fsf.org/>\n",
        "LGPL-3.0": "                   GNU LESSER GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n",
        "AGPL-3.0": "                    GNU AFFERO GENERAL PUBLIC LICENSE\n                       Version 3, 19 November 2007\n",
        "Apache-2.0": "                                 Apache License\n                           Version 2.0, January 2004\n"
                      "                        http://www.apache.org/licenses/\n\n   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION\n",
        "MIT": "MIT License\n\nCopyright (c) 2024 A. Person\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this "
               "software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including without "
               "limitation the rights\nto use, copy, modify, merge, publish.\n",
        "ISC": "ISC License\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n",
        "BSD-3-Clause": "BSD 3-Clause License\n\nCopyright (c) 2024\n\nRedistribution and use in source and binary forms, with or without\n"
                        "modification, are permitted provided that the following conditions are met:\n",
        "MPL-2.0": "Mozilla Public License Version 2.0\n==================================\n\n1. Definitions\n",
        "EPL-2.0": "Eclipse Public License - v 2.0\n\n    THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE\n",
        "Unlicense": "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy.\n",
        "CC0-1.0": "Creative Commons Legal Code\n\nCC0 1.0 Universal\n",
        "CC-BY-4.0": "Creative Commons Attribution 4.0 International Public License\n\nBy exercising the Licensed Rights\n",
    }
    rows = [(k, f"d{n}/LICENSE", t) for n, (k, t) in enumerate(openings.items())]
    rows += [(k, f"s/{n}.py", f"# SPDX-License-Identifier: {tag}\nimport os\n") for n, (k, tag) in enumerate([
        ("MIT", "MIT"), ("Apache-2.0", "Apache-2.0"), ("GPL-2.0", "GPL-2.0-only"), ("GPL-3.0", "GPL-3.0-or-later"), ("LGPL-3.0", "lgpl-3.0+"),
        ("BSD-2-Clause", "(BSD-2-Clause OR MIT)")])]
    rows += [("GPL-2.0", "h/a.c", "/* This program is free software; you can redistribute it and/or modify\n * it under the terms of the GNU General "
              "Public License as published by\n * the Free Software Foundation; either version 2 of the License, or\n * (at your option) any later "
              "version.\n */\nint x;\n")]
    got = L.scan(spark.createDataFrame(rows, "want string, path string, text string"))
    assert [(r.path, r.want, r.license) for r in got.collect() if r.want != r.license] == []
    unknown = L.scan(spark.createDataFrame([("x.py", "# SPDX-License-Identifier: Foo-1.0\n")], "path string, text string")).first()
    assert unknown.license is None


def test_columns_of_any_name_are_carried(spark):
    clash = ["j", "row", "named", "holder", "given", "__given", "__holder", "b", "_"]
    df = spark.createDataFrame([("a/LICENSE", "Released under the MIT License.", *range(9)), ("a/b.txt", None, *range(9))],
                               "path string, text string, " + ", ".join(f"`{c}` int" for c in clash))
    got = {r.path: r for r in L.scan(df).collect()}
    assert got["a/b.txt"].license == "MIT" and [got["a/b.txt"][c] for c in clash] == list(range(9))


def test_factored_words_match_the_same():
    import re
    words = ["a", "ab", "abc", "b", "ba", "free", "freed", "x2"]
    for w in words + ["", "abcd", "fre", "x", "c"]:
        assert bool(re.fullmatch(L._any_of(sorted(words)), w)) == (w in words)
