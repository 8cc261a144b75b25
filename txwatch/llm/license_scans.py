"""License scans: notices by TF-IDF cosine to templates, then inheritance along paths.

1. Inverse document frequencies of the template words are counted over all files; every
   other word weighs as much as the heaviest template word.
2. Every run of as many words as a template has, wherever it stands in a whole text, every
   sentence, every line and every block of neighbouring lines with heavy words is compared
   with each template by the cosine of sparse TF-IDF vectors.  A text is compared with a
   template only if it has one of its heavy words: those are chosen so that what is left of
   the template without them is too short for the threshold.  Running sums then bound the
   cosine of each run from above, and only runs whose bound reaches the threshold get a
   vector.  Neither shortcut loses a match.  A match must have the template's own licence
   name (``NAMES``).  An SPDX line names its licence itself, with score 1.  "All rights
   reserved" stands in notices of open licences as well, so any other licence goes before it.
3. A file whose words mostly lie in notices, or whose name says so, is a licence file: its
   licence holds for its directory.  Files without an own notice inherit from the nearest
   ancestor directory with a licence, by a join of directories' ancestors with those
   directories; only distinct directories are joined, so a huge directory costs one row.

Null text is an empty text; a null path has no directory and inherits nothing.  Of several
licence files in a directory the best score wins, ties go to the smallest path.  Repeated
rows are judged each; empty tables give no rows; other columns pass through.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import received, sent, staged

_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution. ")
_AS_IS_BSD = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
              "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
              "PARTICULAR PURPOSE ARE DISCLAIMED.")
_AS_IS_MIT = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
              "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.")
# Public notices of common licences (fixed values).
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                   "except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("CC0-1.0", "No rights reserved."),
    # standard headers
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                   "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or "
                   "implied. See the License for the specific language governing permissions and limitations under "
                   "the License."),
    *((name, f"This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU "
             f"{kind}General Public License as published by the Free Software Foundation, either version {version} of "
             "the License, or (at your option) any later version.")
      for name, what, kind, version in (
          ("GPL-3.0", "program", "", "3"), ("GPL-2.0", "program", "", "2"), ("AGPL-3.0", "program", "Affero ", "3"),
          ("LGPL-3.0", "library", "Lesser ", "3"), ("LGPL-2.1", "library", "Lesser ", "2.1"))),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
                "License 2.0 which is available at"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("ISC", "Released under the ISC License."),
    # whole bodies of the short licences, openings of the long ones
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions: The above copyright notice and this permission notice shall be included in all "
            "copies or substantial portions of the Software. " + _AS_IS_MIT),
    ("BSD-2-Clause", _BSD + _AS_IS_BSD),
    ("BSD-3-Clause", _BSD + "Neither the name of the copyright holder nor the names of its contributors may be used to "
                     "endorse or promote products derived from this software without specific prior written "
                     "permission. " + _AS_IS_BSD),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
                  "modify, publish, use, compile, sell, or distribute this software, either in source code form or as "
                  "a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("EPL-2.0", "Eclipse Public License - v 2.0"),
    ("proprietary", "All rights reserved."),
)
THRESHOLD = 0.7
RESERVED = "proprietary"  # goes after all others
# Words that name a licence: a match has all of them that its template has.
NAMES = frozenset("apache mit bsd isc mozilla eclipse affero lesser gnu cc cc0 by by-nc by-sa by-nd by-nc-sa by-nc-nd "
                  "2-clause 3-clause unencumbered reserved no".split())
SPDX = re.compile(r"spdx-license-identifier:[ \t]*(\(?[a-z0-9][a-z0-9.+-]*\)?(?:[ \t]+(?:and|or|with)[ \t]+"
                  r"\(?[a-z0-9][a-z0-9.+-]*\)?)*)", re.IGNORECASE)
SENTENCE = re.compile(r"[.!?;](?=\s)|\n\s*\n")
FILE_SHARE = 0.5         # share of its words in notices that makes a file a licence file
FILE_NAME = r"(?i)(^|/)(licen[sc]e|copying|notice)(\.[a-z]+)?$"
WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


class Templates:
    """Template vectors, and the heavy words without which no line can match."""

    def __init__(self, df: dict[str, int], files: int, templates=TEMPLATES, threshold: float = THRESHOLD) -> None:
        counts = [(name, Counter(words(text))) for name, text in templates]
        self.names = [name for name, _ in counts]
        vocabulary = sorted({w for _, c in counts for w in c})
        self.idf = {w: float(np.log((1 + files) / (1 + df.get(w, 0))) + 1) for w in vocabulary}
        self.other = max(self.idf.values())
        self.threshold = threshold
        self.vectors, self.heavy_of, heavy = [], [], set()
        for _, c in counts:
            vector = {w: n * self.idf[w] for w, n in c.items()}
            norm = float(np.sqrt(sum(x * x for x in vector.values())))
            vector = {w: x / norm for w, x in vector.items()}
            self.vectors.append(vector)
            rest, own = 1.0, set()
            for w, x in sorted(vector.items(), key=lambda y: (-y[1], y[0])):
                if rest < threshold * threshold:
                    break
                own.add(w)
                rest -= x * x
            self.heavy_of.append(frozenset(own))
            heavy |= own
        self.heavy = frozenset(heavy)
        self.sizes = [sum(c.values()) for _, c in counts]
        self.needed = [NAMES.intersection(c) for _, c in counts]
        # by code of a word (0: any other word): what it adds to the product with a template, and
        # the least it adds to the squared length of a run
        self.code = {w: i for i, w in enumerate(vocabulary, 1)}
        self.squares = np.array([self.other, *(self.idf[w] for w in vocabulary)]) ** 2
        self.adds = np.array([[0.0, *(t.get(w, 0.0) * self.idf[w] for w in vocabulary)] for t in self.vectors])

    def best(self, own: list[str]) -> tuple[float, str]:
        count = Counter(own)
        vector = {w: n * self.idf.get(w, self.other) for w, n in count.items()}
        norm = float(np.sqrt(sum(x * x for x in vector.values()))) or 1.0
        return max((sum(x * vector.get(w, 0.0) for w, x in t.items()) / norm, name)
                   for name, t in zip(self.names, self.vectors))

    def cosine(self, own: list[str], template: int) -> float:
        """Cosine of a run of words to a template; 0 without the names that the template has."""
        count = Counter(own)
        if not count.keys() >= self.needed[template]:
            return 0.0
        vector = {w: n * self.idf.get(w, self.other) for w, n in count.items()}
        norm = float(np.sqrt(sum(x * x for x in vector.values()))) or 1.0
        return sum(x * vector.get(w, 0.0) for w, x in self.vectors[template].items()) / norm

    def units(self, text: str, starts: np.ndarray, own: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word and end of lines, blocks and sentences, and the first word of each line."""
        def cut(ends: list[int]) -> np.ndarray:
            return np.concatenate(([0], np.searchsorted(starts, ends), [len(starts)])).astype(np.int64)

        lines = cut([m.start() for m in re.finditer("\n", text)])
        heavy = np.concatenate(([0], np.cumsum([w in self.heavy for w in own])))
        has = np.concatenate(([0], (heavy[lines[1:]] > heavy[lines[:-1]]).astype(np.int8), [0]))
        step = np.diff(has)
        blocks = lines[np.flatnonzero(step == 1)], lines[np.flatnonzero(step == -1)]
        sentences = cut([m.start() for m in SENTENCE.finditer(text)])
        first = np.concatenate((lines[:-1], blocks[0], sentences[:-1]))
        end = np.concatenate((lines[1:], blocks[1], sentences[1:]))
        return first[end > first], end[end > first], lines

    def scan(self, text: str) -> tuple[str | None, float, int, float]:
        """Best licence of a text, its score, its line (from 0), and the share of words in notices."""
        text = text.replace("\u0130", "i\u0307")       # the one letter whose lower case has another length
        low = text.lower()
        own = WORD.findall(low)
        met = self.heavy.intersection(own)
        marked = "spdx-license-identifier:" in low
        if not met and not marked:
            return None, 0.0, -1, 0.0
        starts = np.array([m.start() for m in WORD.finditer(low)], np.int64)
        first, end, lines = self.units(low, starts, own)
        codes = np.array([self.code.get(w, 0) for w in own], np.int64)
        squares = np.concatenate(([0.0], np.cumsum(self.squares[codes])))
        found: list[tuple[float, int, int, str]] = []
        for t, (name, size) in enumerate(zip(self.names, self.sizes)):
            if met.isdisjoint(self.heavy_of[t]):
                continue
            size, adds = min(size, len(own)), np.concatenate(([0.0], np.cumsum(self.adds[t][codes])))
            begin = np.arange(len(own) - size + 1)
            lo, hi = np.concatenate((first, begin)), np.concatenate((end, begin + size))
            bound = (adds[hi] - adds[lo]) / np.sqrt(squares[hi] - squares[lo])
            for i in np.flatnonzero(bound >= self.threshold - 1e-6).tolist():
                score = self.cosine(own[lo[i]:hi[i]], t)
                if score >= self.threshold:
                    found.append((score, int(lo[i]), int(hi[i]), name))
        if marked:
            for m in SPDX.finditer(text):
                lo, hi = np.searchsorted(starts, m.span()).tolist()
                found.append((1.0, lo, max(hi, lo + 1), m[1]))
        if not found:
            return None, 0.0, -1, 0.0
        # notices do not overlap: the best first, of equals the longest, then the earliest
        found.sort(key=lambda x: (-round(x[0], 9), x[1] - x[2], x[1]))
        inside, best, chosen = np.zeros(len(own), bool), [], {}
        for score, lo, hi, name in found:
            if not inside[lo:hi].any():
                inside[lo:hi] = True
                best.append((name != RESERVED, round(score, 9), -lo, score, name))
                chosen.setdefault(name, []).append((lo, hi))
        # a whole header or body counts as well where its first sentence is the better match
        for held in chosen.values():
            held.sort()
        for _, lo, hi, name in found:
            held = chosen.get(name, [])
            at = bisect_left(held, (lo, 0))
            if at < len(held) and held[at][1] <= hi:
                inside[lo:hi] = True
        _, _, at, score, name = max(best)
        return name, score, int(np.searchsorted(lines, -at, "right")) - 1, float(inside.mean())


def document_frequencies(files: DataFrame, templates=TEMPLATES) -> tuple[int, dict[str, int]]:
    """Files in all, and how many of them have each template word."""
    vocabulary = frozenset(w for _, text in templates for w in words(text))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for b in batches:
            for text in b["text"]:
                seen[""] += 1
                if isinstance(text, str):
                    seen.update(vocabulary.intersection(WORD.findall(text.lower())))
        if seen:
            yield pd.DataFrame({"word": list(seen), "n": list(seen.values())})

    rows = files.select("text").mapInPandas(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()
    found = {r["word"]: r["n"] for r in rows}   # a row per template word
    return found.pop("", 0), found


def scanned(files: DataFrame, path: str = "path", templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``files`` without their text, plus own_license, own_score, own_line, is_license_file,
    license (own or inherited), license_from (the path it comes from)."""
    added = ("own_license", "own_score", "own_line", "is_license_file", "license", "license_from")
    total, df = document_frequencies(files, templates)
    known = sent(files.sparkSession, Templates(df, total, templates, threshold))
    keep = [c for c in files.columns if c != "text" and c not in added]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own_templates = received(known)
        for b in batches:
            found = [own_templates.scan(t if isinstance(t, str) else "") for t in b["text"]]
            out = b.drop(columns="text")
            for i, name in enumerate(("own_license", "own_score", "own_line", "l_share")):
                out[name] = pd.Series([f[i] for f in found], index=b.index, dtype=(object, float, "int64", float)[i])
            yield out

    plain = files.select(F.col(path).alias("l_path"), *[F.col(f"`{c}`").alias(f"l_{i}") for i, c in enumerate(keep)], "text")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema if f.name != "text")
    own = staged(plain.mapInPandas(run, kinds + ", own_license string, own_score double, own_line bigint, l_share double"),
                 "licences")
    own = own.withColumn("is_license_file", F.col("own_license").isNotNull() & (
        (F.col("l_share") >= FILE_SHARE) | F.coalesce(F.col("l_path").rlike(FILE_NAME), F.lit(False))))
    own = own.withColumn("l_dir", F.when(F.col("l_path").contains("/"), F.regexp_replace("l_path", "/[^/]*$", "")).otherwise(
        F.when(F.col("l_path").isNotNull(), F.lit(""))))
    # one licence per directory, then the nearest one for every distinct directory
    best = own.where("is_license_file").groupBy("l_dir").agg(
        F.min(F.struct((-F.col("own_score")).alias("l_less"), "l_path", "own_license")).alias("l_file"))
    dirs = own.where("l_dir is not null").select("l_dir").distinct()
    parts = F.split("l_dir", "/")
    ups = dirs.select("l_dir", F.posexplode(F.concat(F.array(F.lit("")), F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")))).alias("l_depth", "l_up"))
    near = (ups.join(best.withColumnRenamed("l_dir", "l_up"), "l_up")
            .groupBy("l_dir").agg(F.max_by("l_file", "l_depth").alias("l_file")))
    joined = own.join(near, "l_dir", "left")
    has = F.col("own_license").isNotNull()
    return joined.select(
        *[F.col(f"l_{i}").alias(c) for i, c in enumerate(keep)], "own_license", "own_score", "own_line", "is_license_file",
        F.coalesce("own_license", "l_file.own_license").alias("license"),
        F.when(has, F.col("l_path")).otherwise(F.col("l_file.l_path")).alias("license_from"))
