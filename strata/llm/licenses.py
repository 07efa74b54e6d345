"""Operator 10: license scan by MinHash over overlapping windows (SQL functions
only, no shuffle).

Words are lower-case runs of letters and digits; a shingle is a hash of five
consecutive words. Windows of ``WIDTH`` shingles start every ``STRIDE``
shingles; ``BANDS`` bands of one MinHash row each (least value of hash XOR a
mask) look up the bands of the templates, which are cut into pieces of
``WIDTH`` shingles. A piece of four or more shingles and the best-placed window
over it have a Jaccard similarity of at least 1/2, so a template is missed with
a probability of at most 2 ** -``BANDS``, about 0.001; templates under four
shingles use windows of one shingle, whose MinHash is the shingle itself and
never misses. A retrieved template is then verified around its window: at
least ``CONTAINMENT`` of its distinct shingles must stand within the window
widened by the template's length on both sides.

The template list is a parameter of at most ``MAX_TEMPLATES`` texts, which bounds
the constants in the plan. Defined results: a null text has no words; texts of
any length are scanned whole; texts or templates under five words never match. Rows are judged one by one, so repeated
rows, null ids and further columns need no rule; an empty table gives an empty
result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import text_or_empty

SHINGLE = 5
WIDTH, STRIDE = 8, 4
BANDS = 10
CONTAINMENT = 0.8
MAX_TEMPLATES = 500
MASKS = tuple(((k + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1) - (1 << 63) for k in range(BANDS))

# Wording of common public license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
    "except in compliance with the License. You may obtain a copy of the License at",
    "Apache-2.0-warranty": "Unless required by applicable law or agreed to in writing, software distributed under the "
    "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "MIT": "Released under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "MIT-notice": "The above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the Software.",
    "BSD-redistribution": "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met",
    "BSD-3-name": "may be used to endorse or promote products derived from this software without specific prior "
    "written permission.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation",
    "LGPL-header": "This library is free software; you can redistribute it and/or modify it under the terms of the "
    "GNU Lesser General Public License as published by the Free Software Foundation",
    "AGPL-header": "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public "
    "License v. 2.0",
    "zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors "
    "be held liable for any damages arising from the use of this software.",
}


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def shingles(w: Column) -> Column:
    """Hash of each run of five words."""
    return F.when(F.size(w) >= SHINGLE, F.transform(
        F.sequence(F.lit(0), F.size(w) - SHINGLE),
        lambda p: F.xxhash64(*[F.get(w, p + j) for j in range(SHINGLE)]))).otherwise(
        F.array().cast("array<bigint>"))


class Templates:
    """Shingles and band keys of the templates, made by the same SQL functions."""

    def __init__(self, spark, templates: dict[str, str]):
        if len(templates) > MAX_TEMPLATES:
            raise ValueError(f"at most {MAX_TEMPLATES} templates")
        rows = spark.createDataFrame(sorted(templates.items()), "name string, text string").select(
            "name", shingles(words(F.col("text"))).alias("h")).collect()     # bounded by MAX_TEMPLATES
        self.names = [r.name for r in rows if r.h]
        self.sets = [list(dict.fromkeys(r.h)) for r in rows if r.h]
        self.short: list[tuple[int, int]] = []                              # (shingle, template)
        self.keys: list[tuple[int, int]] = []                               # (band key, template)
        for t, h in enumerate(self.sets):
            if len(h) < STRIDE:
                self.short += [(x, t) for x in h]
                continue
            pieces = [h[i:i + WIDTH] for i in range(0, max(1, len(h) - STRIDE + 1), WIDTH)]
            self.keys += {(min(x ^ m for x in p), t) for p in pieces for m in MASKS}

    def of(self, pairs: list[tuple[int, int]], key: Column) -> Column:
        """Templates listed under a key."""
        if not pairs:
            return F.array().cast("array<int>")
        ks, ts = F.lit([k for k, _ in pairs]), F.lit([t for _, t in pairs])
        at = F.filter(F.sequence(F.lit(0), F.lit(len(pairs) - 1)), lambda i: F.get(ks, i) == key)
        return F.transform(at, lambda i: F.get(ts, i))


def _in(pairs, x: Column) -> Column:
    return x.isin([k for k, _ in pairs]) if pairs else F.lit(False)


def scan(docs: DataFrame, templates: dict[str, str] | None = None, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, matches: array of (license, start, end) in words, by start."""
    t = Templates(docs.sparkSession, TEMPLATES if templates is None else templates)
    df = docs.select("doc_id", words(text_or_empty()).alias("w")).select("doc_id", shingles(F.col("w")).alias("h"))
    at = lambda p: F.get("h", p)
    # least values of blocks of STRIDE shingles for every band; a window is two blocks
    blocks = F.when(F.size("h") > 0, F.transform(
        F.sequence(F.lit(0), F.floor((F.size("h") - 1) / STRIDE).cast("int")),
        lambda j: F.array(*[F.least(*[at(j * STRIDE + q).bitwiseXOR(F.lit(m)) for q in range(STRIDE)])
                            for m in MASKS])))
    df = df.withColumn("blocks", blocks)
    least = lambda j, k: F.least(F.get(F.get("blocks", j), F.lit(k)), F.get(F.get("blocks", j + 1), F.lit(k)))
    empty = F.array().cast("array<int>")

    def banded(j):
        any_band = F.lit(False)
        for k in range(BANDS):
            any_band = any_band | F.coalesce(_in(t.keys, least(j, k)), F.lit(False))
        return any_band

    windows = F.when(F.size("h") > 0, F.filter(F.sequence(F.lit(0), F.size("blocks") - 1), banded)).otherwise(empty)
    singles = F.when(F.size("h") > 0, F.filter(F.sequence(F.lit(0), F.size("h") - 1),
                                               lambda p: _in(t.short, at(p)))).otherwise(empty)
    df = df.withColumns({"windows": windows, "singles": singles})
    cand = lambda p, width, ids: F.transform(F.array_distinct(ids), lambda x: F.struct(
        p.alias("p"), F.lit(width).alias("width"), x.alias("t")))
    found = F.concat(
        F.flatten(F.transform("windows", lambda j: cand(j * STRIDE, WIDTH, F.flatten(F.array(
            *[t.of(t.keys, least(j, k)) for k in range(BANDS)]))))),
        F.flatten(F.transform("singles", lambda p: cand(p, 1, t.of(t.short, at(p))))))
    df = df.withColumn("found", F.when((F.size("windows") > 0) | (F.size("singles") > 0), found))
    sets = F.array(*[F.lit(s) for s in t.sets]) if t.sets else F.array().cast("array<array<bigint>>")

    def verify(c):
        """The places in the widened window that hold shingles of the template."""
        need = F.get(sets, c["t"])
        lo = F.greatest(F.lit(0), c["p"] - F.size(need))
        region = F.slice("h", lo + 1, c["p"] + c["width"] + F.size(need) - lo)
        places = F.filter(F.transform(region, lambda x, i: F.when(F.array_contains(need, x), lo + i)),
                          lambda x: x.isNotNull())
        return F.struct(c["t"].alias("t"), F.size(F.array_intersect(region, need)).alias("n"),
                        F.size(need).alias("m"), F.array_min(places).alias("first"), F.array_max(places).alias("last"))

    names = F.lit(t.names) if t.names else F.array().cast("array<string>")
    good = F.transform(F.filter(F.transform("found", verify), lambda v: v["n"] >= v["m"] * containment),
                       lambda v: F.struct(v["first"].cast("long").alias("start"),
                                          (v["last"] + SHINGLE).cast("long").alias("end"),
                                          F.get(names, v["t"]).alias("license")))
    nothing = F.array().cast("array<struct<start:bigint,end:bigint,license:string>>")
    return df.select("doc_id", F.coalesce(F.array_sort(F.array_distinct(good)), nothing).alias("matches"))


def report(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id, n_licenses, licenses (names, sorted, comma-joined)."""
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"])))
    return scan(docs, templates).select("doc_id", F.size(names).cast("long").alias("n_licenses"),
                                        F.array_join(names, ",").alias("licenses"), "matches")


def plain_shingles(text: str | None) -> list[tuple[str, ...]]:
    """The same shingles as word tuples (for tests)."""
    w = [x for x in re.split(r"[^\w]|_", (text or "").lower()) if x]
    return [tuple(w[i:i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)]
