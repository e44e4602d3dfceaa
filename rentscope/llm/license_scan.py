"""License scan: sparse TF-IDF cosine to templates, then directory inheritance.

An ``SPDX-License-Identifier`` line of a known licence names it.  Otherwise a
file's header statements (lines and sentences with licence vocabulary or rare
words of the templates, and the leading comment block or paragraph joined across
its line breaks) and, for licence files, the whole text are turned into sparse TF-IDF vectors and
compared with every template by cosine; weights of the fixed templates are
literals of the expression, so scoring is one map in built-in functions.

A file without a licence of its own inherits from the nearest directory above
it that holds a licence file.  Licence files are first reduced to one row per
directory, the distinct directories are joined with those by their ancestor
paths, and only (directory, licence) pairs meet the files again, so a directory
with a third of all files is no hot group.

Defined cases: null text holds no statement; a null path is the root
directory; of several licence files in a directory the best score decides, then
the smaller licence id; equal scores of templates go to the smaller id;
repeated rows keep a row each; extra columns of any name are carried through
unless they have the name of an output column; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import let

THRESHOLD = 0.55
STATEMENT = ("(?i)licen[sc]e|copyright|copyleft|spdx|public domain|creative commons|\\bcc[ -]by\\b|\\bcc0\\b"
             "|permission is hereby|redistribution and use")
LICENSE_FILE = "(?i)^(?:un)?licen[sc]e(?:$|[._\\-])|^copying(?:$|[._\\-])|^copyright(?:$|[._\\-])|^notice(?:$|[._\\-])"
# Usual statements and opening sentences of licences.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License."],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction."],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License (Simplified)."],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License (New or Revised).",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met."],
    "ISC": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted."],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or any later "
        "version."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or any later "
        "version."],
    "LGPL-3.0": ["This library is licensed under the GNU Lesser General Public License, version 3."],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "EPL-2.0": ["Made available under the terms of the Eclipse Public License 2.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "CC0-1.0": ["Dedicated to the public domain under Creative Commons CC0 1.0 Universal."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0.", "Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "Proprietary": ["Copyright. All rights reserved.", "Proprietary and confidential; unauthorized copying is strictly prohibited."],
}
# Headings of the licences' texts.
HEADINGS = {
    "Apache-2.0": "Apache License Version 2.0, January 2004",
    "MIT": "MIT License",
    "BSD-2-Clause": "BSD 2-Clause License",
    "BSD-3-Clause": "BSD 3-Clause License",
    "ISC": "ISC License",
    "GPL-2.0": "GNU General Public License Version 2, June 1991",
    "GPL-3.0": "GNU General Public License Version 3, 29 June 2007",
    "LGPL-3.0": "GNU Lesser General Public License Version 3, 29 June 2007",
    "AGPL-3.0": "GNU Affero General Public License Version 3, 19 November 2007",
    "MPL-2.0": "Mozilla Public License Version 2.0",
    "EPL-2.0": "Eclipse Public License - v 2.0",
    "CC0-1.0": "Creative Commons CC0 1.0 Universal",
    "CC-BY-4.0": "Creative Commons Attribution 4.0 International Public License",
    "CC-BY-SA-4.0": "Creative Commons Attribution-ShareAlike 4.0 International Public License",
    "CC-BY-NC-4.0": "Creative Commons Attribution-NonCommercial 4.0 International Public License",
    "CC-BY-ND-4.0": "Creative Commons Attribution-NoDerivatives 4.0 International Public License",
}
for _k, _t in HEADINGS.items():
    TEMPLATES[_k].append(_t)
SPDX = "(?i)SPDX-License-Identifier:[\\x20\\t(]*([A-Za-z0-9.+\\-]+)"
# ... and their names as they stand in short notices
SHORT_NAMES = [k for k in TEMPLATES if k not in ("Unlicense", "Proprietary")]
for _k in SHORT_NAMES:
    TEMPLATES[_k].append(f"Distributed under {_k}.")
HEADER_CHARS = 600  # a leading block up to this length is also scored as one statement
# comment marks at the start of a line, and at the end of a block
COMMENT_MARKS = "(?m)^[\\x20\\t]*(?:/\\*+|\\*+/?|//+|#+|--+|;+|%+|<!--|\"\"\")[\\x20\\t]*|[\\x20\\t]*(?:\\*+/|-->)[\\x20\\t]*$"
# Template words that common prose holds too.
COMMON_WORDS = frozenset("a all and any are as at by can copy either except file following for form free fee in is it "
                         "later made may not of only or person purpose source terms that the this to under use "
                         "version v with without work you following provided subject general public code new "
                         "international library program software compliance conditions available rights reserved".split())


def _terms(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+(?:\.[0-9]+)*", text.lower())


def _any_of(words: list[str]) -> str:
    """A pattern of any of the words, factored by their beginnings: a place in
    the text is tried against the letters that may follow, not against every word."""
    if not words:
        return ""
    tails: dict[str, list[str]] = {}
    for w in words:
        if w:
            tails.setdefault(w[0], []).append(w[1:])
    branches = [re.escape(c) + _any_of(t) for c, t in sorted(tails.items())]
    body = branches[0] if len(branches) == 1 and "" not in words else f"(?:{'|'.join(branches)})"
    return (f"(?:{body})?" if branches else "") if "" in words else body


class Templates:
    """Unit TF-IDF vectors of the templates and the inverse document frequencies."""

    def __init__(self, templates: dict[str, list[str]]):
        texts = [(name, _terms(t)) for name, ts in sorted(templates.items()) for t in ts]
        n = len(texts)
        df: dict[str, int] = {}
        for _, words in texts:
            for w in set(words):
                df[w] = df.get(w, 0) + 1
        self.idf = {w: math.log((1 + n) / (1 + c)) + 1 for w, c in df.items()}
        self.unknown = math.log(1 + n) + 1
        self.names = sorted(templates)
        self.vectors = []
        for name, words in texts:
            v = {w: (1 + math.log(words.count(w))) * self.idf[w] for w in dict.fromkeys(words)}
            norm = math.sqrt(sum(x * x for x in v.values()))
            self.vectors.append((name, {w: x / norm for w, x in v.items()}))
        rare = sorted(w for w in df if w not in COMMON_WORDS and re.fullmatch("[a-z]{3,}[0-9]?", w))
        # two rare words of the templates make a statement too, as does one beside a number
        word = f"\\b{_any_of(rare)}\\b"
        self.statement = f"{STATEMENT}|{word}[\\s\\S]*?(?:{word}|\\b[0-9]\\.[0-9]\\b)"


def _map(values: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def _dot(vector: Column, weights: Column) -> Column:
    return F.aggregate(vector, F.lit(0.0),
                       lambda a, x: a + x["w"] * F.coalesce(F.try_element_at(weights, x["t"]), F.lit(0.0)))


def best_template(statement: Column, templates: Templates) -> Column:
    """Struct (score, license) of the closest template of a statement."""
    terms = F.regexp_extract_all(F.lower(statement), F.lit("[a-z0-9]+(?:\\.[0-9]+)*"), 0)
    idf = _map(templates.idf)

    def scored(words: Column) -> Column:
        distinct = F.array_distinct(words)
        vector = F.transform(distinct, lambda t: F.struct(t.alias("t"), (
            (1 + F.log(F.size(F.filter(words, lambda x: x == t))))
            * F.coalesce(F.try_element_at(idf, t), F.lit(templates.unknown))).alias("w")))

        def compared(v: Column) -> Column:
            norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x["w"] * x["w"]))
            cells = []
            for name, weights in templates.vectors:
                cells.append(F.struct((-F.round(_dot(v, _map(weights)) / norm, 6)).alias("minus"),
                                      F.lit(name).alias("license")))
            return F.array_min(F.array(*cells))
        return let(vector, compared)

    found = F.when(F.size(terms) > 0, let(terms, scored))
    return let(found, lambda b: F.struct((-b["minus"]).alias("score"), b["license"].alias("license")))


def named_license(text: Column, templates: Templates) -> Column:
    """The known licence that an SPDX line names, ``-only`` and ``-or-later`` left aside."""
    found = F.regexp_replace(F.regexp_extract(F.coalesce(text, F.lit("")), SPDX, 1), "(?i)(?:\\+|-only|-or-later)$", "")
    known = F.filter(F.lit(templates.names), lambda n: F.lower(n) == F.lower(found))
    return F.get(known, F.lit(0))


def statements(text: Column, whole: Column, vocabulary: str = STATEMENT) -> Column:
    """Lines and sentences with licence vocabulary, and those of the leading block joined across its line
    breaks; of licence files with any, the whole text too."""
    t = F.coalesce(text, F.lit(""))
    none = F.array().cast("array<string>")
    sentence = "(?<=[.!?])\\s+(?=\\p{Lu})"

    def held(parts: Column) -> Column:
        return F.filter(parts, lambda x: F.rlike(x, F.lit(vocabulary)))

    cut = held(F.split(t, "\\n|" + sentence))
    block = F.element_at(F.split(F.regexp_replace(F.regexp_replace(t, COMMENT_MARKS, ""), "^\\s+", ""),
                                 "\\n[\\x20\\t\\r]*\\n"), 1)
    joined = F.trim(F.regexp_replace(block, "\\s+", " "))

    def header(h: Column) -> Column:
        short = F.when(F.length(h) <= HEADER_CHARS, F.array(h)).otherwise(none)
        return held(F.concat(F.split(h, sentence), short))

    def chosen(lines: Column) -> Column:
        found = F.concat(lines, F.array_except(let(joined, header), lines))
        return F.when(F.size(found) > 0, F.concat(found, F.when(whole, F.array(t)).otherwise(none))).otherwise(none)

    return F.when(F.rlike(t, F.lit(vocabulary)), let(cut, chosen)).otherwise(none)


def directory(path: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.coalesce(path, F.lit("")), "^/+", ""), "/?[^/]*$", "")


def scan(files: DataFrame, path: str = "path", text: str = "text", threshold: float = THRESHOLD,
         templates: dict[str, list[str]] | None = None) -> DataFrame:
    """``files`` without their text, plus directory, is_license_file, own_license, own_score,
    n_statements, license, origin ('own', 'inherited', 'none') and from_directory."""
    known = Templates(templates or TEMPLATES)
    out = ("directory", "is_license_file", "own_license", "own_score", "n_statements", "license", "origin",
           "from_directory", text)
    carried = F.struct(*[F.col(f"`{c}`") for c in files.columns if c not in out])
    kept = [f"row.`{c}`" for c in files.columns if c not in out]
    name = F.regexp_extract(F.coalesce(F.col(f"`{path}`"), F.lit("")), "[^/]*$", 0)
    is_file = F.rlike(name, F.lit(LICENSE_FILE))

    def judged(found: Column) -> Column:
        scored = F.transform(found, lambda s: best_template(s, known))
        top = F.array_min(F.transform(F.filter(scored, lambda b: b["score"] >= threshold),
                                      lambda b: F.struct((-b["score"]).alias("minus"), b["license"].alias("license"))))
        return F.struct(F.size(found).alias("n"), top.alias("top"))

    source = F.col(f"`{text}`")
    own = files.select(carried.alias("row"), directory(F.col(f"`{path}`")).alias("directory"), is_file.alias("is_license_file"),
                       named_license(source, known).alias("named"), let(statements(source, is_file, known.statement), judged).alias("j")) \
        .select("row", "directory", "is_license_file", F.coalesce("named", "j.top.license").alias("own_license"),
                F.when(F.col("named").isNotNull(), 1.0).otherwise(-F.col("j.top.minus")).alias("own_score"),
                F.col("j.n").cast("bigint").alias("n_statements"))
    # read three times below: the texts are scored once and stay behind
    own = materialize(own, "license-scores")
    # one row per directory that holds a licence file
    holders = own.where("is_license_file and own_license is not null").groupBy("directory") \
        .agg(F.min(F.struct((-F.col("own_score")).alias("minus"), "own_license")).alias("b")) \
        .select(F.col("directory").alias("holder"), F.col("b.own_license").alias("given"))
    # every distinct directory with its ancestors, itself included; the deepest holder decides
    dirs = own.select("directory").distinct()
    steps = F.when(F.col("directory") == "", F.array(F.lit(""))).otherwise(F.concat(F.array(F.lit("")), F.transform(
        F.sequence(F.lit(1), F.size(F.split("directory", "/"))),
        lambda k: F.array_join(F.slice(F.split(F.col("directory"), "/"), F.lit(1), k), "/"))))
    nearest = dirs.select("directory", F.explode(steps).alias("holder")).join(holders, "holder") \
        .groupBy("directory").agg(F.max(F.struct(F.length("holder").alias("depth"), "holder", "given")).alias("b")) \
        .select("directory", F.col("b.given").alias("given"), F.col("b.holder").alias("holder"))
    return own.join(nearest, "directory", "left").select(
        *kept, "directory", "is_license_file", "own_license", "own_score", "n_statements",
        F.coalesce("own_license", "given").alias("license"),
        F.when(F.col("own_license").isNotNull(), "own").when(F.col("given").isNotNull(), "inherited")
        .otherwise("none").alias("origin"),
        F.when(F.col("own_license").isNull(), F.col("holder")).alias("from_directory"))
