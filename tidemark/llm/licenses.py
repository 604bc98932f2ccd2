"""Licence scans: TF-IDF cosine of lines and whole files to templates, then inheritance from ancestor directories.

A vector space of the templates' words and of one more dimension for each other word: words that no
template has are far from all, and weigh as the rarest.  Word weights come from the number of lines
that have the word, counted over all files.  Each run of 1 to ``WINDOW`` consecutive lines that
have words is a header candidate, and the file as a whole is one more; the best cosine of either
kind decides.  A run's products with the templates are sums over its lines, and its length is at
least that of its lines taken as unlike each other; only runs whose cosine so bounded can decide
are computed in full.  A file that states no licence
of its own takes that of the nearest directory above it with a licence file, found by joining each
directory's ancestors to the directories that have one.
"""

from __future__ import annotations

import pkgutil
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.scratch import stage
from tidemark.llm.words import Scanner, chunks


def _text(name: str) -> str:
    return pkgutil.get_data("tidemark.llm", f"license_texts/{name}.txt").decode()


#: Notices by which licences are stated, with their usual identifiers, and the full licence texts.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright to the public domain worldwide under CC0 1.0."),
    ("LicenseRef-All-Rights-Reserved", "All rights reserved."),
    *((name, _text(name)) for name in ("MIT", "Apache-2.0", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0")),
    ("AGPL-3.0", _text("GPL-3.0").replace("GNU General Public", "GNU Affero General Public").replace("GNU GENERAL PUBLIC", "GNU AFFERO GENERAL PUBLIC")),  # nearer to it than GPL-3.0 is
)
WINDOW = 20
_LINES, _WORDS = 1 << 15, 1 << 21  # lines whose runs are bounded together, words of runs computed together
LEAST_COSINE = 0.75
LICENCE_FILE = r"(?i)(^|/)(licen[sc]e|copying|notice)[^/]*$"


class Space:
    """The vocabulary of the templates, its word weights and the templates' unit vectors."""

    def __init__(self, templates: tuple[tuple[str, str], ...]) -> None:
        scan = Scanner("alnum", lower=True)
        column = pa.array([text for _, text in templates])
        found = [(w.hashes, w.first) for _, _, data, bounds in chunks(column) for w in [scan(data, bounds)]]
        hashes = np.concatenate([h for h, _ in found])
        of = np.concatenate([np.repeat(np.arange(len(f) - 1), np.diff(f)) for _, f in found])
        self.names = [name for name, _ in templates]
        self.words = np.unique(hashes)
        self.counts = np.zeros((len(self.words), len(templates)))
        np.add.at(self.counts, (np.searchsorted(self.words, hashes), of), 1)
        self.weigh(np.zeros(len(self.words)), 0)

    def weigh(self, lines_with: np.ndarray, lines: int) -> None:
        self.idf = np.log((1 + lines) / (1 + lines_with)) + 1
        self.other = np.log(1 + lines) + 1
        vectors = self.counts * self.idf[:, None]
        self.vectors = vectors / np.maximum(np.sqrt((vectors ** 2).sum(axis=0)), 1e-300)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Index of each word in the vocabulary, or -1."""
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at, -1)

    def best(self, place: np.ndarray, segment: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """For each of n segments its nearest template (the first of equals) and the cosine."""
        products, norm = self.products(place, segment, n)
        nearest = products.argmax(axis=1)
        return nearest, np.minimum(1.0, products[np.arange(n), nearest] / np.sqrt(np.maximum(norm, 1e-300)))

    def products(self, place: np.ndarray, segment: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """For each of n segments its scalar products with the templates and its squared length."""
        size = len(self.words)
        known = place >= 0
        pair, tf = np.unique(segment[known] * size + place[known], return_counts=True)
        of, weight = pair // size, tf * self.idf[pair % size]
        norm = np.bincount(of, weight ** 2, n) + np.bincount(segment[~known], minlength=n) * self.other ** 2
        cosines = np.zeros((n, len(self.names)))
        if len(pair):
            lead = np.flatnonzero(np.diff(of, prepend=-1))
            cosines[of[lead]] = np.add.reduceat(weight[:, None] * self.vectors[pair % size], lead)
        return cosines, norm

    def runs(self, place: np.ndarray, first: np.ndarray, of: np.ndarray, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of 2 to ``WINDOW`` lines of one file whose cosine can be above the line's ``floor``: their first line, nearest template and cosine.

        ``first`` has each line's first word and the number of words at the end, ``of`` its file.
        """
        lines, found = len(of), []
        for begin in range(0, lines, _LINES):
            end = min(lines, begin + _LINES + WINDOW - 1)
            words = place[first[begin]:first[end]]
            products, norm = self.products(words, np.repeat(np.arange(end - begin), np.diff(first[begin:end + 1])), end - begin)
            total, length = products.copy(), norm.copy()
            for size in range(2, WINDOW + 1):
                starts = min(begin + _LINES, end - size + 1) - begin
                if starts <= 0:
                    break
                total, length = total[:end - begin - size + 1] + products[size - 1:], length[:end - begin - size + 1] + norm[size - 1:]
                bound = total[:starts].max(axis=1) / np.sqrt(np.maximum(length[:starts], 1e-300))
                at = begin + np.flatnonzero(bound > floor[begin:begin + starts] + 1e-9)
                at = at[of[at] == of[at + size - 1]]
                found.append((at, np.full(len(at), size)))
        start, size = (np.concatenate([x[k] for x in found] or [np.zeros(0, np.int64)]) for k in range(2))
        n_words = first[start + size] - first[start]
        nearest, cosine = np.zeros(len(start), np.int64), np.zeros(len(start))
        slab = np.cumsum(n_words) // _WORDS
        for k in np.unique(slab):
            own = np.flatnonzero(slab == k)
            n = n_words[own]
            which = np.repeat(first[start[own]] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            nearest[own], cosine[own] = self.best(place[which], np.repeat(np.arange(len(own)), n), len(own))
        return start, nearest, cosine


def _lines(data: np.ndarray, bounds: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The line that each place is in, numbered through all texts, and each text's first line."""
    breaks = data == 0x0A
    breaks[bounds[1:-1][bounds[1:-1] > 0] - 1] = True  # a text's end ends its line
    before = np.concatenate([[0], np.cumsum(breaks)])
    return before[starts], before[bounds]


def _count_lines(space: Space):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scanner("alnum", lower=True)
        total = np.zeros(len(space.words) + 1, np.int64)  # the last: lines that have a word
        for batch in batches:
            for _, _, data, bounds in chunks(batch.column("text")):
                words = scan(data, bounds)
                line, _ = _lines(data, bounds, words.starts)
                place = space.places(words.hashes)
                pairs = np.unique(line[place >= 0] * len(space.words) + place[place >= 0])
                total[:-1] += np.bincount(pairs % len(space.words), minlength=len(space.words))
                total[-1] += len(np.unique(line))
        yield pa.record_batch([pa.array(np.arange(len(total))), pa.array(total)], names=["place", "n"])

    return run


def _scan(shared, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space: Space = shared.value
        scan = Scanner("alnum", lower=True)
        names = np.array(space.names, object)
        for batch in batches:
            for row, end, data, bounds in chunks(batch.column("text")):
                n = end - row
                words = scan(data, bounds)
                place = space.places(words.hashes)
                line, first = _lines(data, bounds, words.starts)
                lines, at = np.unique(line, return_inverse=True)
                nearest, cosine = space.best(place, at, len(lines))
                of = np.repeat(np.arange(n), words.per_doc())[np.searchsorted(line, lines)]
                whole, whole_cosine = space.best(place, np.repeat(np.arange(n), words.per_doc()), n)
                floor = np.maximum(least, np.where(whole_cosine >= least, whole_cosine, 0.0))
                np.maximum.at(floor, of, cosine)
                begin, run_nearest, run_cosine = space.runs(place, np.append(np.searchsorted(line, lines), len(line)), of, floor[of])
                nearest, cosine, of, lines = (np.concatenate(x) for x in ((nearest, run_nearest), (cosine, run_cosine), (of, of[begin]), (lines, lines[begin])))
                order = np.lexsort((lines, -cosine, of))
                lead = order[np.flatnonzero(np.diff(of[order], prepend=-1))]
                header, header_cosine, header_line = np.full(n, -1), np.zeros(n), np.full(n, -1)
                header[of[lead]], header_cosine[of[lead]], header_line[of[lead]] = nearest[lead], cosine[lead], lines[lead] - first[of[lead]]
                part = batch.slice(row, n)
                yield pa.record_batch(
                    [part.column("file_id"), part.column("path"), pa.array(names[header], pa.string(), mask=header < 0), pa.array(header_cosine), pa.array(header_line, mask=header < 0), pa.array(names[whole], pa.string()), pa.array(whole_cosine)],
                    names=["file_id", "path", "line_license", "line_cosine", "line", "text_license", "text_cosine"])

    return run


def _parent(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(path, "^(.*)/", 1), "/+$", "")


def scan(files: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, least: float = LEAST_COSINE) -> DataFrame:
    """Licence of every file of (file_id, path, text): file_id, path, license, evidence, cosine, line, from_directory.

    evidence is ``header`` (one or more lines of the file; ``line`` is the first), ``file`` (its text as a whole), ``inherited`` (from
    the licence file of ``from_directory``, the nearest one at or above the file's own) or ``none``.
    A licence file is one whose name says so, or whose whole text is near a template.  Of several in
    a directory the one with the highest cosine counts, then the smallest path and id.  Of equal
    headers the first counts, of equal templates the first listed.  Null and empty texts state
    nothing but can inherit; a null path is a directory of its own without ancestors.  Repeated rows
    each get a row, an empty table none; other columns are ignored.
    """
    spark = files.sparkSession
    rows = files.select(F.col("file_id").cast("long").alias("file_id"), F.col("path").cast("string").alias("path"), F.col("text").cast("string").alias("text"))
    space = Space(templates)
    counted = {r.place: r.n for r in rows.select("text").mapInArrow(_count_lines(space), "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()}  # a row for each template word
    space.weigh(np.array([counted.get(k, 0) for k in range(len(space.words))], float), counted.get(len(space.words), 0))
    scanned = stage(rows.mapInArrow(_scan(spark.sparkContext.broadcast(space), least), "file_id long, path string, line_license string, line_cosine double, line long, text_license string, text_cosine double"), "licences")
    scanned = scanned.withColumn("directory", _parent(F.col("path"))).withColumn("by_text", (F.col("text_cosine") >= least) & (F.col("text_cosine") >= F.col("line_cosine"))).withColumn("by_line", F.col("line_cosine") >= least)
    own = F.when(F.col("by_text"), F.col("text_license")).when(F.col("by_line"), F.col("line_license"))
    scanned = scanned.withColumn("own", own).withColumn("own_cosine", F.round(F.when(F.col("by_text"), F.col("text_cosine")).when(F.col("by_line"), F.col("line_cosine")), 6))

    stated = scanned.filter("own is not null and path is not null").filter(F.col("path").rlike(LICENCE_FILE) | (F.col("text_cosine") >= least))
    rank = F.struct(-F.col("own_cosine"), F.col("path"), F.col("file_id"))
    licensed = stage(stated.groupBy("directory").agg(F.min_by("own", rank).alias("license")), "licensed")
    directories = scanned.filter("path is not null").select("directory").distinct()
    depth = F.size(F.split("directory", "/"))
    above = directories.select("directory", F.explode(F.transform(F.sequence(F.lit(0), depth), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(F.split("directory", "/"), 1, k), "/").alias("name")))).alias("a"))
    nearest = above.select("directory", "a.depth", F.col("a.name").alias("from_directory")).join(licensed.withColumnRenamed("directory", "from_directory"), "from_directory")
    nearest = stage(nearest.groupBy("directory").agg(F.max_by("license", "depth").alias("license"), F.max_by("from_directory", "depth").alias("from_directory")), "inherited")
    out = scanned.join(nearest, "directory", "left")
    evidence = F.when(F.col("by_text"), "file").when(F.col("by_line"), "header").when(F.col("license").isNotNull(), "inherited").otherwise("none")
    return out.select(
        "file_id", "path", F.coalesce("own", "license").alias("license"), evidence.alias("evidence"), F.col("own_cosine").alias("cosine"),
        F.when(~F.col("by_text") & F.col("by_line"), F.col("line")).alias("line"), F.when(F.col("own").isNull(), F.col("from_directory")).alias("from_directory"))


def of_documents(docs: DataFrame) -> DataFrame:
    """Documents as files: a directory for each source, and in it one for each thousand and hundred of ids."""
    number = F.col("doc_id").cast("long")
    path = F.concat_ws("/", F.coalesce(F.col("source").cast("string"), F.lit("")), F.floor(number / 1000).cast("string"), F.floor(number / 100).cast("string"), F.concat(number.cast("string"), F.lit(".txt")))
    return docs.select(number.alias("file_id"), F.when(number.isNotNull(), path).alias("path"), F.col("text").cast("string").alias("text"))
