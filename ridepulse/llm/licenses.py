"""License scans: sparse TF-IDF cosine of notices to templates, then inheritance from the nearest directory.

A text is taken in pieces: its lines, the sentences and paragraphs it has once comment marks are gone and wrapped lines
are joined, the header of comments it begins with, and the whole of it. Notices are compared by sentence, headers and
licence files by their full length. Document frequencies of the template words are counted over all texts; other words
weigh ``OTHER``. A piece can only reach the wanted similarity if it has one of the telling words of a template, without
which the rest of it is too light, so only such pieces are compared: an exact filter. Terms meet templates in a join,
and dot products are sums over the common terms.

A file with a notice has its own license. A licence file's license holds for its directory and all below it, until a
nearer one: every directory is joined with its ancestors by path, and files take the result of their directory.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Mapping, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, store

#: Public notices by SPDX id (fixed texts).
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, "
        "to deal in the Software without restriction.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "LGPL-3.0": ["This library is licensed under the GNU Lesser General Public License, version 3."],
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3."],
    "BSD-3-Clause": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met.",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
}
#: Stands in several licenses, so it counts for its own only where nothing else is found.
SHARED = {TEMPLATES["BSD-3-Clause"][1]}


def _licence_files() -> dict[str, str]:
    return {path.stem: path.read_text(encoding="utf-8") for path in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}


def _gnu_header(kind: str, version: str, noun: str = "program") -> str:
    return (
        f"This {noun} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} as published by the "
        f"Free Software Foundation, either version {version} of the License, or (at your option) any later version. This {noun} is distributed in "
        "the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        f"PARTICULAR PURPOSE. See the GNU {kind} for more details. You should have received a copy of the GNU {kind} along with this {noun}. "
        "If not, see <https://www.gnu.org/licenses/>."
    )


_FILES = _licence_files()
#: Headers, titles and licence files, each compared as a whole.
FULL = {name: [text] for name, text in _FILES.items()}
for _name, _text in [
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may '
        "obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or '
        "implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("GPL-2.0", _gnu_header("General Public License", "2")),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", _gnu_header("General Public License", "3")),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", _gnu_header("Lesser General Public License", "2.1", "library")),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", _gnu_header("Lesser General Public License", "3")),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", _gnu_header("Affero General Public License", "3")),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("BSD-2-Clause", re.sub(r"(?s)3\. Neither.*?permission\.\s+", "", _FILES["BSD-3-Clause"])),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        'above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL '
        "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE "
        "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
        "SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies.",
    ),
]:
    FULL.setdefault(_name, []).append(_text)
SIMILARITY = 0.8
#: Weight of a word that no template has.
OTHER = 1.0
SENTENCE_END = r"(?<=[.!?])\s+|\n"
NOT_TERM = "[^a-z0-9]+"
#: What a comment puts before a line, lines that belong to a comment, and a comment in one piece.
MARKS = r"(?m)^[ \t/*#;%!<>-]*+(?:(?:dnl|rem|REM)\b[ \t]*+)?"
COMMENT_LINE = r"^\s*+(?:/\*|\*|//|#|--|;|%|<!|(?:dnl|rem|REM)\b|$)"
COMMENT_BLOCK = r"(?s)\A\s*+(?:/\*.*?\*/|<!--.*?-->)"


def terms_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), NOT_TERM, -1), "")


def pieces_of(text: Column) -> Column:
    """What is compared of a text: lines, sentences, paragraphs, the header of comments, and all of it."""
    plain = F.regexp_replace(F.regexp_replace(text, r"\r\n?", "\n"), MARKS, "")
    paragraphs = F.transform(F.split(plain, r"\n\s*\n", -1), lambda p: F.regexp_replace(p, r"\s+", " "))
    sentences = F.flatten(F.transform(paragraphs, lambda p: F.split(p, r"(?<=[.!?])\s+", -1)))
    lines = F.split(text, r"\r\n?|\n", -1)
    code = F.array_position(F.transform(lines, lambda line: line.rlike(COMMENT_LINE)), False).cast("int")
    header = F.array_join(F.slice(lines, 1, F.greatest(code - 1, F.lit(0))), "\n")
    wholes = [F.regexp_replace(x, MARKS, "") for x in (F.regexp_extract(text, COMMENT_BLOCK, 0), header)]
    return F.concat(F.split(text, SENTENCE_END, -1), sentences, paragraphs, F.array(*wholes, plain))


def template_terms(templates: Mapping[str, Sequence[str]], full: Mapping[str, Sequence[str]]) -> dict[tuple[str, int, bool], Counter]:
    """Term counts of every template sentence and full template by license, number, and whether others share it."""
    out = {}
    for name in sorted({*templates, *full}):
        sentences = dict.fromkeys(s for text in templates.get(name, ()) for s in re.split(SENTENCE_END, text) if s)
        for number, piece in enumerate([*sentences, *full.get(name, ())]):
            out[name, number, piece in SHARED] = Counter(re.findall("[a-z0-9]+", piece.lower()))
    return out


def term_weights(df: DataFrame, text: str, vocabulary: Sequence[str]) -> dict[str, float]:
    """Inverse document frequency of each template term over all rows."""
    known = F.array(*[F.lit(t) for t in vocabulary])
    present = df.select(F.explode(F.concat(F.array(F.lit("")), F.array_intersect(known, terms_of(F.coalesce(F.col(text), F.lit("")))))).alias("t"))
    # at most one row per template term and one for the number of texts
    counts = {row.t: row.n for row in present.groupBy("t").agg(F.count("*").alias("n")).collect()}
    return {t: 1 + math.log((1 + counts.get("", 0)) / (1 + counts.get(t, 0))) for t in vocabulary}


def telling_terms(vectors: dict[tuple[str, int, bool], Counter], weights: dict[str, float], similarity: float) -> list[str]:
    """Terms of which a piece must have one to be that similar to any template: rare ones that weigh much in it."""
    telling = set()
    for counts in vectors.values():
        squares = {t: (n * weights[t]) ** 2 for t, n in counts.items()}
        # the weight is one more than the logarithm of how rare a term is
        ranked = sorted(squares, key=lambda t: (t not in telling, -squares[t] * math.exp(weights[t]), t))
        left = sum(squares.values())
        least = similarity**2 * left * (1 - 1e-9)
        for term in ranked:
            if left < least:
                break
            telling.add(term)
            left -= squares[term]
    return sorted(telling)


def _any_of(terms: Sequence[str]) -> str:
    """A pattern of these terms as whole words, by first letter, so that most words are passed over at once."""
    by_letter: dict[str, list[str]] = {}
    for term in terms:
        by_letter.setdefault(term[0], []).append(term[1:])
    return rf"(?i)(?<![a-z0-9])(?:{'|'.join(f'{first}(?:{"|".join(rest)})' for first, rest in sorted(by_letter.items()))})(?![a-z0-9])"


def notices(
    df: DataFrame,
    key: str,
    text: str,
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
    similarity: float = SIMILARITY,
    full: Mapping[str, Sequence[str]] = FULL,
) -> DataFrame:
    """The best template of every row that has a piece similar enough: key, license, similarity.

    ``covered`` is the share of the text's words in its longest such piece. The key must tell rows apart. Ties go to
    the longer piece, then the license first in alphabetical order. Null and empty texts and those without notices give
    no row.
    """
    vectors = template_terms(templates, full)
    vocabulary = sorted({t for counts in vectors.values() for t in counts})
    weights = term_weights(df, text, vocabulary)
    spark = df.sparkSession
    rows = []
    for (name, number, shared), counts in vectors.items():
        norm = math.sqrt(sum((n * weights[t]) ** 2 for t, n in counts.items()))
        rows += [(t, name, number, shared, n * weights[t] / norm) for t, n in counts.items()]
    # a row per term of a template: a constant of the rule set
    wanted = spark.createDataFrame(rows, "term string, license string, number int, shared boolean, part double")
    idf = spark.createDataFrame(list(weights.items()), "term string, weight double")
    telling = _any_of(telling_terms(vectors, weights, similarity))
    pieces = df.filter(F.col(text).rlike(telling)).select(
        F.col(key).alias("_key"), F.posexplode(F.array_distinct(F.filter(pieces_of(F.col(text)), lambda s: s.rlike(telling)))).alias("at", "piece")
    )
    terms = pieces.select("_key", "at", F.explode(terms_of(F.col("piece"))).alias("term"))
    counted = terms.groupBy("_key", "at", "term").agg(F.count("*").alias("n")).join(F.broadcast(idf), "term", "left")
    weighed = store(counted.withColumn("value", F.col("n") * F.coalesce("weight", F.lit(OTHER))), "notice-terms")
    norms = store(weighed.groupBy("_key", "at").agg(F.sqrt(F.sum(F.col("value") ** 2)).alias("norm"), F.sum("n").alias("words")), "notice-norms")
    # the whole text is the longest piece
    sizes = norms.groupBy("_key").agg(F.max("words").alias("all"))
    dots = weighed.join(F.broadcast(wanted), "term").groupBy("_key", "at", "license", "number", "shared").agg(F.sum(F.col("value") * F.col("part")).alias("dot"))
    found = dots.join(norms, ["_key", "at"]).withColumn("similarity", F.round(F.col("dot") / F.col("norm"), 9)).filter(F.col("similarity") >= similarity)
    order = F.struct("shared", (-F.col("similarity")).alias("s"), (-F.col("words")).alias("w"), "license")
    best = found.groupBy("_key").agg(F.min(order).alias("b"), F.max("words").alias("most")).join(sizes, "_key")
    covered = F.col("most") / F.col("all")
    return best.select(F.col("_key").alias(key), F.col("b.license").alias("license"), (-F.col("b.s")).alias("similarity"), covered.alias("covered"))


def scan(
    df: DataFrame,
    path: str,
    text: str,
    licence_file: Column,
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
    similarity: float = SIMILARITY,
    covering: float | None = None,
) -> DataFrame:
    """All rows with own_license, similarity, license and source_directory.

    ``path`` is a file path with ``/``; ``licence_file`` marks files whose notice holds for their directory; with
    ``covering`` so do those whose notice or licence text has at least that share of their words, however long. If a
    directory has several, the most similar counts, then the first license by name. The root is the empty directory.
    Files with equal paths share one result, the best notice among them. A null path is a file in no directory and
    inherits nothing; its own notice is found if its text alone has one. Columns with the new names are replaced.
    """
    new = ["own_license", "similarity", "license", "source_directory"]
    mark, file, folder = (fresh([*df.columns, *new], c) for c in ("_mark", "_file", "_folder"))
    rows = df.drop(*new).withColumn(mark, F.coalesce(licence_file, F.lit(False)))
    rows = rows.withColumn(file, F.coalesce(F.concat(F.lit("p"), F.col(path)), F.concat(F.lit("t"), F.md5(F.coalesce(F.col(text), F.lit(""))))))
    # the directory with a closing slash, so that the root is one too
    rows = rows.withColumn(folder, F.when(F.col(path).isNotNull(), F.concat(F.lit("/"), F.regexp_extract(F.ltrim(F.col(path), F.lit("/")), "^(.*/)?", 0))))
    own = store(notices(rows.select(file, text), file, text, templates, similarity), "notices")
    placed = rows.filter(F.col(folder).isNotNull()).select(file, F.col(folder).alias("_at"), mark)
    marked = F.col(mark) if covering is None else F.col(mark) | (F.col("covered") >= covering)
    holders = placed.join(own, file).filter(marked).drop(mark).distinct()
    directories = holders.groupBy("_at").agg(F.min(F.struct((-F.col("similarity")).alias("s"), "license")).alias("b")).select("_at", F.col("b.license").alias("_license"))
    directories = store(directories, "directory-licenses")
    parts = F.split(F.col(folder), "/")
    ancestors = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.concat(F.array_join(F.slice(parts, 1, n), "/"), F.lit("/")))
    folders = rows.select(folder).filter(F.col(folder).isNotNull()).distinct().withColumn("_up", F.explode(ancestors))
    nearest = folders.join(directories, F.col("_up") == F.col("_at")).groupBy(F.col(folder).alias("_in")).agg(
        F.max_by(F.struct("_at", "_license"), F.length("_at")).alias("near")
    )
    nearest = store(nearest, "inherited-licenses")
    named = own.select(F.col(file).alias("_f"), F.col("license").alias("own_license"), F.col("similarity"))
    out = rows.join(named, F.col(file) == F.col("_f"), "left").join(nearest, F.col(folder) == F.col("_in"), "left")
    return out.select(
        *[F.col(c) for c in df.columns if c not in new], "own_license", "similarity",
        F.coalesce("own_license", "near._license").alias("license"),
        F.when(F.col("own_license").isNull(), F.col("near._at")).alias("source_directory"),
    )
