"""Licence scan: TF-IDF cosine of lines and licence files to templates, and inheritance by directory.

Licence statements of a sentence (``TEMPLATES``) and whole licence texts and file
headers (``licence_texts/``) are compared as sparse TF-IDF vectors with single lines,
with groups of adjacent lines of about the template's length that slide over the
file line by line, and the texts with the whole file too. The document
frequencies of the templates' words are counted over all files; a word that is
in no template weighs as one seen nowhere (sentences and texts each have their own
words). Screening loses nothing: a line that reaches the threshold must hold one
of the heaviest words of the template, enough of them that the rest of the template
alone stays below the threshold (prefix filter), and the squared weights of the
template's words that a file holds must sum up to the threshold squared, since
that bounds the cosine of any part of it. An SPDX-License-Identifier tag states its
licence itself: of the longest valid expression after it, of known identifiers, each
licence counts as an entry with cosine 1, and the file's first expression is kept whole.

A file gets every licence that reaches the threshold (``licences``, the most similar
first, each with its best place); ``licence`` is the expression of its first tag, such as
``MIT OR Apache-2.0``, or else the first of them. Versions of one
text are similar to one another and may be named together. Groups are of three lengths,
``GROUPS`` times the template's. A text similar to GPL-3.0 whose first line names the Affero
licence is AGPL-3.0, from which it differs in that title and one section. There is no
full text of CC-BY among the templates; such a text is named by its sentences only.

A file without a licence of its own inherits that of the nearest ancestor
directory that has a licence file: the file's ancestor directories, one row
each, are joined with the directories that have one, and the deepest stays.

Defined results: null and empty texts hold no licence and may inherit. Null
paths inherit nothing. Among equally similar templates the first by name wins;
among several licence files of a directory the most similar, then the name of
the licence. Rows are judged by themselves: repeated rows repeat.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from importlib import resources

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import spdx
from .scratch import written

# fixed values: short licence statements, by SPDX name
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.",
}
THRESHOLD = 0.8
_LISTED = pa.list_(pa.struct([("licence", pa.string()), ("cosine", pa.float64()), ("line", pa.int64())]))
_WORD = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
_AFFERO = re.compile(r"\s*gnu affero general public license")
#: Groups of lines end where they hold these many times the words of the template.
GROUPS = (0.8, 1.0, 1.25)
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice)[^/]*$"


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def licence_texts() -> dict[str, str]:
    """Whole licence texts and file headers by SPDX name; a header's name goes on with ``.header``."""
    folder = resources.files(__package__) / "licence_texts"
    return {f.name.removesuffix(".txt"): f.read_text("utf-8") for f in folder.iterdir() if f.name.endswith(".txt")}


class Matcher:
    """Templates as TF-IDF vectors under given document frequencies, and a matcher of whole texts beside it."""

    def __init__(self, templates: dict[str, str], files: int, frequency: dict[str, int], threshold: float, texts: Matcher | None = None) -> None:
        self.threshold, self.texts = threshold, texts
        self.sizes = {name: len(words(t)) for name, t in templates.items()}
        self.unseen = math.log(1 + files)
        self.idf = {w: math.log((1 + files) / (1 + frequency.get(w, 0))) + 1e-3 for t in templates.values() for w in words(t)}
        self.vectors = {}
        screen = set()
        for name, text in sorted(templates.items()):
            vector = self._vector(Counter(words(text)))
            norm = math.sqrt(sum(x * x for x in vector.values()))
            self.vectors[name] = {w: x / norm for w, x in vector.items()}
            left = 1.0
            for w, x in sorted(self.vectors[name].items(), key=lambda p: -p[1]):
                if left < threshold * threshold * 0.999:
                    break
                screen.add(w)
                left -= x * x
        self.screen = sorted(screen)
        self.squares: dict[str, list[tuple[str, float]]] = {}
        for name, vector in self.vectors.items():
            for w, x in vector.items():
                self.squares.setdefault(w, []).append((name, x * x))

    def _vector(self, counts: Counter) -> dict[str, float]:
        return {w: (1 + math.log(n)) * self.idf.get(w, self.unseen) for w, n in counts.items()}

    def reached(self, text: str) -> list[tuple[str, float]]:
        """The templates that reach the threshold, the most similar first, then by name."""
        vector = self._vector(Counter(words(text)))
        norm = math.sqrt(sum(x * x for x in vector.values()))
        if not norm:
            return []
        found = ((name, sum(x * vector.get(w, 0.0) for w, x in t.items()) / norm) for name, t in self.vectors.items())
        return sorted((f for f in found if f[1] >= self.threshold), key=lambda f: (-f[1], f[0]))

    def best(self, text: str) -> tuple[str, float] | None:
        """The most similar template, if it reaches the threshold."""
        return next(iter(self.reached(text)), None)

    def _possible(self, held: set[str]) -> list[str]:
        """The templates that a part of a text of these words can reach the threshold with."""
        bound = dict.fromkeys(self.vectors, 0.0)
        for w in held & self.squares.keys():
            for name, x in self.squares[w]:
                bound[name] += x
        return [name for name, x in bound.items() if x >= self.threshold * self.threshold * 0.999]

    def _groups(self, name: str, lines: list[list[str]], least: int) -> Iterator[tuple[float, int]]:
        """Cosine and first line of the groups of at least ``least`` adjacent lines (words) that reach the threshold."""
        template = self.vectors[name]
        filled = [k for k, line in enumerate(lines) if line]
        for share in GROUPS:
            counts: Counter = Counter()
            dot = square = 0.0
            size = end = 0

            def put(line: list[str], by: int) -> None:
                nonlocal dot, square, size
                for w in line:
                    n = counts[w]
                    counts[w] = n + by
                    weight = self.idf.get(w, self.unseen)
                    old, new = ((1 + math.log(x)) * weight if x else 0.0 for x in (n, n + by))
                    dot += (new - old) * template.get(w, 0.0)
                    square += new * new - old * old
                size += by * len(line)

            for at, first in enumerate(filled):
                while end < len(filled) and (size < share * self.sizes[name] or end < at + least):
                    put(lines[filled[end]], 1)
                    end += 1
                if end - at >= least and square > 0 and dot * dot >= self.threshold**2 * 0.999 * square:
                    group = self._vector(+counts)
                    cosine = sum(x * group.get(w, 0.0) for w, x in template.items()) / math.sqrt(sum(x * x for x in group.values()))
                    if cosine >= self.threshold:
                        yield cosine, first
                put(lines[first], -1)

    def found(self, text: str) -> list[tuple[str, float, int]]:
        """Every licence that reaches the threshold, with cosine and line number (from 0) of its best place; the most similar first."""
        low = text.lower()
        best: dict[str, tuple[float, int]] = {}

        def add(name: str, cosine: float, line: int) -> None:
            if name not in best or (-cosine, line) < (-best[name][0], best[name][1]):
                best[name] = cosine, line

        starts = set()
        for w in self.screen:  # the lines that hold a screening word
            at = low.find(w)
            while at >= 0:
                starts.add(low.rfind("\n", 0, at) + 1)
                end = low.find("\n", at)
                at = low.find(w, end) if end >= 0 else -1
        line, counted = 0, 0
        for start in sorted(starts):
            line, counted = line + low.count("\n", counted, start), start
            end = low.find("\n", start)
            for name, cosine in self.reached(low[start : end if end >= 0 else len(low)]):
                add(name, cosine, line)
        held = set(words(low))
        lines: list[list[str]] | None = None
        for matcher, least in ((self, 2), (self.texts, 1)):
            for name in matcher._possible(held) if matcher else ():
                lines = lines if lines is not None else [words(line) for line in low.split("\n")]
                for cosine, line in matcher._groups(name, lines, least):
                    add(name.removesuffix(".header"), cosine, line)
        if lines is not None and self.texts:
            for name, cosine in self.texts.reached(low):
                add(name.removesuffix(".header"), cosine, next(k for k, line in enumerate(lines) if line))
        if "GPL-3.0" in best and _AFFERO.match(low):
            best["AGPL-3.0"] = best.pop("GPL-3.0")
        if "spdx-license-identifier" in low:
            line = counted = 0
            for m in spdx.TAG.finditer(text):
                line, counted = line + text.count("\n", counted, m.start()), m.start()
                stated = spdx.expression(m.group(1))
                for name in spdx.identifiers(stated) if stated else ():
                    add(name, 1.0, line)
        return sorted(((name, cosine, line) for name, (cosine, line) in best.items()), key=lambda f: (-f[1], f[2], f[0]))

    def scan(self, text: str) -> tuple[str | None, float, int]:
        """The first of ``found``; (None, 0, -1) if none."""
        return next(iter(self.found(text)), (None, 0.0, -1))


def stated_licence(text: str) -> tuple[str, float, int] | None:
    """Expression, cosine 1 and line of the first SPDX tag with a valid expression."""
    for m in spdx.TAG.finditer(text):
        stated = spdx.expression(m.group(1))
        if stated:
            return stated, 1.0, text.count("\n", 0, m.start())
    return None


def _frequencies(templates: dict[str, str]):
    known = {w for t in templates.values() for w in words(t)}
    vocabulary = sorted(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, counts = 0, dict.fromkeys(vocabulary, 0)
        for batch in batches:
            n += batch.num_rows
            for text in batch.column(0):
                for w in known.intersection(words(text.as_py() or "")):
                    counts[w] += 1
        yield pa.RecordBatch.from_pydict({"word": ["", *vocabulary], "n": pa.array([n, *counts.values()], pa.int64())})

    return run


def fit_matcher(files: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD, texts: dict[str, str] | None = None) -> Matcher:
    """Document frequencies of the template words over all ``files`` (text). ``texts``: by default those of ``licence_texts``."""
    texts = licence_texts() if texts is None else texts
    every = {**{f"sentence {k}": t for k, t in templates.items()}, **{f"text {k}": t for k, t in texts.items()}}
    rows = files.select("text").mapInArrow(_frequencies(every), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    counts = {r["word"]: r["n"] for r in rows}  # a row for each template word
    n = counts.pop("", 0)
    return Matcher(templates, n, counts, threshold, Matcher(texts, n, counts, threshold))


def licences(files: DataFrame, matcher: Matcher, licence_file=None) -> DataFrame:
    """file_id, path, licence, cosine, line, inherited_from, licences of every row of ``files`` (file_id, path, text).

    ``licence_file``: condition on (path, line, licence) that makes a file with a
    licence one that holds for its directory; by default its name.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column("text")]
            every = [matcher.found(t) for t in texts]
            found = [stated_licence(t) or (f[0] if f else (None, 0.0, -1)) for t, f in zip(texts, every)]
            listed = [[{"licence": name, "cosine": cosine, "line": line} for name, cosine, line in f] for f in every]
            yield pa.RecordBatch.from_arrays(
                [batch.column("file_id"), batch.column("path"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.int64()), pa.array(listed, _LISTED)],
                names=["file_id", "path", "licence", "cosine", "line", "licences"],
            )

    kind = files.schema["file_id"].dataType.simpleString()
    own = files.select("file_id", "path", "text").mapInArrow(run, f"file_id {kind}, path string, licence string, cosine double, line long, licences array<struct<licence:string,cosine:double,line:long>>")
    own = written(own.withColumn("directory", F.regexp_extract("path", r"^(.*)/[^/]*$", 1)), "own-licences")
    is_licence = F.col("path").rlike(LICENCE_FILE) if licence_file is None else licence_file
    order = Window.partitionBy("directory").orderBy(F.col("cosine").desc(), "licence")
    best = own.where(is_licence & F.col("licence").isNotNull()).groupBy("directory", "licence").agg(F.max("cosine").alias("cosine"))
    holds = best.withColumn("place", F.row_number().over(order)).where("place = 1").select(F.col("directory").alias("ancestor"), F.col("licence").alias("from_directory"))

    # one row for each ancestor directory of each directory that has a file
    parts = F.split("directory", "/")
    directories = own.where(F.col("licence").isNull() & F.col("path").isNotNull()).select("directory").distinct()
    above = directories.select("directory", F.explode(F.sequence(F.lit(0), F.size(parts))).alias("depth")).withColumn(
        "ancestor", F.array_join(F.expr("slice(split(directory, '/'), 1, depth)"), "/")
    )
    nearest = above.join(holds, "ancestor").groupBy("directory").agg(F.max_by(F.struct("ancestor", "from_directory"), "depth").alias("near"))
    out = own.join(nearest, "directory", "left")
    without = F.col("licence").isNull() & F.col("path").isNotNull()
    return out.select(
        "file_id",
        "path",
        F.when(without, F.col("near.from_directory")).otherwise(F.col("licence")).alias("licence"),
        "cosine",
        "line",
        F.when(without, F.col("near.ancestor")).alias("inherited_from"),
        "licences",
    )
