"""Licences of files: TF-IDF cosine of passages to templates, then inheritance from the
nearest directory above that has one.

Inverse document frequencies of all templates' words come from all files; any other word counts
as the rarest. Every line of every text is a candidate header, and a file that is named as
a licence file is one as a whole, too. Besides, runs of up to ``LINES`` lines, blocks between blank
lines and whole texts of all files are held against ``TEMPLATES`` and the headers and full texts
of ``notices``; an SPDX line is a licence's only if it has all words of its identifier. Such a
passage counts where it reaches the least cosine and is better than every
line. Where the best passage does not tell between versions of a licence, the best one that does
goes before it; without one, the first word that tells in the lines after it decides.
"""

from __future__ import annotations

from copy import copy

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adflow.llm.notices import SPDX, notices
from adflow.llm.stage import staged
from adflow.llm.text import NEWLINE, NOT_ALNUM, Texts, slices

LEAST = 0.7
NAMES = r"(?i)^(licen[sc]e|copying|notice|unlicense)([._-].*)?$"
SALTS = 16
LINES = 6
WORDS_AT_ONCE = 1 << 18

# SPDX identifiers and the customary words of their notices.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files, to deal in the software without "
            "restriction."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "You may not use this file except in compliance with the License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without "
                     "modification, are permitted provided that the following conditions are met."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("ISC", "Permission to use, copy, modify, and distribute this software for any purpose with "
            "or without fee is hereby granted."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, "
                "version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC0-1.0", "Released to the public domain under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


class Templates:
    """Words of the templates and, per template, which it has. An ``exact`` template is matched
    only by passages that have all its words."""

    def __init__(self, templates: list[tuple[str, str]]):
        words = Texts.of(pa.array([t for _, t in templates]), lower=True).words(NOT_ALNUM)
        self.names = [n for n, _ in templates]
        self.exact = [t.startswith(SPDX) for _, t in templates]
        hashes = words.hashes()
        self.words = np.unique(hashes)
        self.has = np.zeros((len(templates), len(self.words)))
        self.has[words.rows(), np.searchsorted(self.words, hashes)] = 1

        # Templates that tell licences apart by a few words on each side, such as versions.
        self.siblings: dict[int, list[tuple[int, np.ndarray]]] = {}
        has = self.has > 0
        for k in range(len(templates)):
            more, less = (has[k] & ~has).sum(axis=1), (~has[k] & has).sum(axis=1)
            near = np.flatnonzero((more > 0) & (more <= 2) & (less > 0) & (less <= 2))
            self.siblings[k] = [(int(s), np.flatnonzero(has[k] != has[s])) for s in near
                                if self.names[s] != self.names[k]]

    def first(self, n: int) -> Templates:
        """The first ``n`` templates over the same words, for matching alone."""
        out = copy(self)
        out.names, out.exact, out.has = self.names[:n], self.exact[:n], self.has[:n]
        return out

    def place(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each word, or -1."""
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at, -1)


def frequencies(files: DataFrame, templates: Templates) -> tuple[np.ndarray, int]:
    """In how many files each template word is, and the number of files."""

    def run(batches):
        total, n = np.zeros(len(templates.words), np.int64), 0
        for batch in slices(batches, "t"):
            words = Texts.of(batch.column("t"), lower=True).words(NOT_ALNUM)
            place = templates.place(words.hashes())
            own = np.unique(words.rows()[place >= 0] * len(total) + place[place >= 0])
            total += np.bincount(own % len(total), minlength=len(total))
            n += batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(-1, len(total)), pa.int32()),
             pa.array(np.concatenate([[n], total]))], names=["word", "files"])

    got = {r["word"]: r["n"] for r in files.select("t").mapInArrow(
        run, "word int, files bigint").groupBy("word").agg(F.sum("files").alias("n")).collect()}
    return np.array([got.get(k, 0) for k in range(len(templates.words))], np.float64), got.get(-1, 0)


def _cosines(part: np.ndarray, parts: int, hashes: np.ndarray, templates: Templates,
             idf: np.ndarray, rarest: float) -> tuple[np.ndarray, np.ndarray]:
    """Best template and cosine of each part; ``part`` numbers the part of each word."""
    # A word counts once per part.
    order = np.lexsort((hashes, part))
    part, hashes = part[order], hashes[order]
    new = np.ones(len(part), bool)
    new[1:] = (part[1:] != part[:-1]) | (hashes[1:] != hashes[:-1])
    part, place = part[new], templates.place(hashes[new])
    weight = np.where(place >= 0, idf[place], rarest)
    norm = np.sqrt(np.bincount(part, weights=weight * weight, minlength=parts))
    known = place >= 0
    part, place, weight = part[known], place[known], weight[known]
    best, top = np.zeros(parts, np.int64), np.zeros(parts)
    length = np.sqrt((templates.has * idf * idf).sum(axis=1))
    for k, has in enumerate(templates.has):
        own = has[place] > 0
        dot = np.bincount(part[own], weights=weight[own] ** 2, minlength=parts)
        cosine = dot / np.maximum(norm * length[k], 1e-12)
        if templates.exact[k]:
            cosine[dot < length[k] ** 2 * (1 - 1e-9)] = 0
        better = cosine > top + 1e-12
        best[better], top[better] = k, cosine[better]
    return best, top


def match(column: pa.Array, whole: np.ndarray, templates: Templates, idf: np.ndarray,
          rarest: float) -> tuple[np.ndarray, np.ndarray]:
    """Best template (-1 without words) and cosine of each text: over its lines, and the
    text as a whole where ``whole`` says so. Of equal cosines the first template wins."""
    texts = Texts.of(column, lower=True)
    words, lines = texts.words(NOT_ALNUM), texts.words(NEWLINE)
    rows, n = words.rows(), len(column)
    template, score = np.full(n, -1), np.zeros(n)
    if not len(words.start):
        return template, score
    line = np.searchsorted(lines.start, words.start, "right") - 1
    hashes = words.hashes()
    best, top = _cosines(line, len(lines.start), hashes, templates, idf, rarest)
    order = np.lexsort((best, -top))
    row, first = np.unique(lines.rows()[order], return_index=True)
    template[row], score[row] = best[order][first], top[order][first]
    if whole.any():
        best, top = _cosines(rows, n, hashes, templates, idf, rarest)
        better = whole & (top > score)
        template[better], score[better] = best[better], top[better]
    return template, score


def _candidates(words, hashes: np.ndarray, templates: Templates, idf: np.ndarray, rarest: float,
                least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word and end of the passages that can reach ``least``.

    A passage's cosine is at most the root of the known share of its weight, and its known
    words have to make up ``least`` of some template; both are bounded from its lines.
    """
    rows = words.rows()
    number = np.cumsum(words.texts.data == 0x0A)[words.start]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (number[1:] != number[:-1])
    start = np.flatnonzero(new)
    line, row, number = np.cumsum(new) - 1, rows[start], number[start]
    order = np.lexsort((hashes, line))
    once = np.ones(len(order), bool)
    once[1:] = (line[order][1:] != line[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
    own = order[once]
    place = templates.place(hashes[own])
    weight = np.where(place >= 0, idf[place], rarest) ** 2
    known = np.bincount(line[own], weights=np.where(place >= 0, weight, 0), minlength=len(start))
    other = np.bincount(line[own], weights=np.where(place >= 0, 0, weight), minlength=len(start))

    total = np.concatenate([[0], np.cumsum(known)])
    edge = np.append(start, len(rows))
    shortest = (templates.has * idf * idf).sum(axis=1).min()
    out = []

    def add(first: np.ndarray, end: np.ndarray, most: np.ndarray) -> None:
        own = total[end] - total[first]
        fit = (most <= (1 / least ** 2 - 1 + 1e-6) * own) & (own >= (least ** 2 - 1e-6) * shortest)
        out.append((row[first[fit]], edge[first[fit]], edge[end[fit]]))

    most = other
    for size in range(1, LINES + 1):
        first = np.arange(len(start) - size + 1)
        if size > 1:
            most = np.maximum(most[:-1], other[size - 1:])
        if not len(first):
            break
        same = row[first] == row[first + size - 1]
        add(first[same], first[same] + size, most[same])
    for cut in ((row[1:] != row[:-1]) | (number[1:] != number[:-1] + 1), row[1:] != row[:-1]):
        first = np.concatenate([[0], np.flatnonzero(cut) + 1])
        add(first, np.append(first[1:], len(start)), np.maximum.reduceat(other, first))
    text, a, b = (np.concatenate(c) for c in zip(*out))
    if not len(text):
        return text, a, b
    found = np.unique(np.stack([text, a, b]), axis=1)
    return found[0], found[1], found[2]


def _version(k: int, a: int, b: int, words, hashes: np.ndarray, templates: Templates
             ) -> tuple[int, bool]:
    """The template among ``k`` and its siblings that has the first telling word after a passage
    (words a to b) in a run of ``LINES`` lines from its start, and whether there is such a word."""
    last = words.first[np.searchsorted(words.first, a, "right")]
    breaks = np.cumsum(words.texts.data[words.start[a]:words.end[last - 1]] == 0x0A)
    after = np.arange(b, last)
    after = after[breaks[words.start[after] - words.start[a]] < LINES]
    place = templates.place(hashes[after])
    telling = place[np.isin(place, np.concatenate([d for _, d in templates.siblings[k]]))]
    if not len(telling):
        return k, False
    own = templates.place(hashes[a:b])
    own = np.unique(own[own >= 0])
    fit = [t for t in [k, *(s for s, _ in templates.siblings[k])] if templates.has[t, telling[0]]]
    return min(fit, key=lambda t: (-templates.has[t, own].sum(),
                                   (templates.has[t] != templates.has[k]).sum(), t)), True


def passages(column: pa.Array, templates: Templates, idf: np.ndarray, rarest: float, least: float
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best template (-1 where none reaches ``least``) and cosine of each text over its passages,
    and whether it went before a better one that does not tell between versions."""
    words = Texts.of(column, lower=True).words(NOT_ALNUM)
    n = len(column)
    template, score, told = np.full(n, -1), np.zeros(n), np.zeros(n, bool)
    if not len(words.start):
        return template, score, told
    hashes = words.hashes()
    text, first, end = _candidates(words, hashes, templates, idf, rarest, least)
    size = np.cumsum(end - first)
    found: dict[int, list[tuple[float, int, bool, int, int]]] = {}
    at = 0
    while at < len(text):
        before = size[at - 1] if at else 0
        stop = max(int(np.searchsorted(size, before + WORDS_AT_ONCE, "right")), at + 1)
        width = end[at:stop] - first[at:stop]
        part = np.repeat(np.arange(stop - at), width)
        word = np.arange(len(part)) + np.repeat(first[at:stop] - np.cumsum(width) + width, width)
        best, top = _cosines(part, stop - at, hashes[word], templates, idf, rarest)
        cut = np.cumsum(width) - width
        for u in np.flatnonzero(top >= least):
            k = int(best[u])
            near = templates.siblings[k]
            own = templates.place(hashes[word[cut[u]:cut[u] + width[u]]]) if near else None
            tells = all(np.isin(apart, own).any() for _, apart in near)
            found.setdefault(int(text[at + u]), []).append((
                -round(float(top[u]), 9), k, tells, int(first[at + u]), int(end[at + u])))
        at = stop
    for r, own in found.items():
        cosine, k, tells, a, b = min(own)
        if not tells:
            names = {templates.names[k]} | {templates.names[s] for s, _ in templates.siblings[k]}
            clear = [f for f in own if f[2] and templates.names[f[1]] in names]
            if clear:
                (cosine, k, *_), told[r] = min(clear), True
            else:
                k, told[r] = _version(k, a, b, words, hashes, templates)
        template[r], score[r] = k, -cosine
    return template, score, told


def scan(files: DataFrame, keep: list[str], least: float = LEAST,
         templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """``keep`` columns of ``files`` (with ``t``, ``whole``), ``license`` and ``cosine``.

    Under ``least`` the licence is null. A null or empty text has none, with cosine 0.
    """
    every = Templates([*templates, *notices()])
    own = every.first(len(templates))
    count, n = frequencies(files, every)
    rarest = float(np.log(1 + n) + 1)
    idf = np.log((1 + n) / (1 + count)) + 1
    names = np.array([*every.names, None], object)

    def run(batches):
        for batch in slices(batches, "t"):
            whole = batch.column("__whole").to_numpy(zero_copy_only=False).astype(bool)
            template, score = match(batch.column("t"), whole, own, idf, rarest)
            template[score < least] = -1
            wide, cosine, told = passages(batch.column("t"), every, idf, rarest, least)
            better = (wide >= 0) & (told | (cosine > score + 2e-9))
            template[better], score[better] = wide[better], cosine[better]
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in keep]
                + [pa.array(names[template], pa.string()), pa.array(score)],
                names=[*keep, "license", "cosine"])

    types = dict(files.dtypes)
    return files.select(*keep, "t", F.col("whole").alias("__whole")).mapInArrow(run, ", ".join(
        [f"`{k}` {types[k]}" for k in keep] + ["license string", "cosine double"]))


def _folder(path: Column) -> Column:
    """Folder of a path; a file without one is in the root, the empty string."""
    return F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", "")).otherwise("")


def licenses(files: DataFrame, key: str = "path", path: str = "path", text: str = "text",
             least: float = LEAST) -> DataFrame:
    """Per file: key, path, ``license``, ``cosine``, ``origin`` (own, inherited, none) and
    ``origin_path``.

    A licence file (by its name) rules its folder and all below, the nearest one first; of
    several in a folder the best match rules, then the smallest path. A file's own header
    goes before what it inherits. A null path is in no folder. Repeated rows each get a row.
    Texts are scanned whole, however long. Other columns are not read, whatever they are called.
    An empty table gives no row.
    """
    name = F.regexp_extract(F.coalesce(F.col(path), F.lit("")), "[^/]*$", 0)
    picked = files.select(F.col(key).alias("k"), F.col(path).alias("p"), F.col(text).alias("t"),
                          name.rlike(NAMES).alias("whole"))
    found = staged(scan(picked, ["k", "p", "whole"], least).withColumn(
        "folder", _folder(F.col("p"))), "licenses")
    rules = staged(found.where("whole AND license IS NOT NULL AND p IS NOT NULL").groupBy(
        "folder").agg(F.min_by(F.struct("license", "p"), F.struct(-F.col("cosine"), "p"))
                      .alias("rule")), "license-rules")
    # Folders are resolved once each, over all folders above them.
    folders = found.where("license IS NULL AND p IS NOT NULL").select("folder").distinct()
    parts = F.split("folder", "/")
    above = folders.select("folder", F.explode(F.concat(
        F.array(F.lit("")), F.transform(
            F.sequence(F.lit(1), F.size(parts)),
            lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/")))).alias("up")).distinct()
    nearest = above.join(rules.withColumnRenamed("folder", "up"), "up").groupBy("folder").agg(
        F.max_by("rule", F.length("up")).alias("rule"))
    salts = nearest.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    salted = found.withColumn("salt", F.pmod(F.xxhash64("k", "p"), F.lit(SALTS)).cast("int"))
    joined = salted.join(salts, ["folder", "salt"], "left")
    own = F.col("license").isNotNull()
    rule = F.when(F.col("p").isNotNull() & ~own, F.col("rule"))
    return joined.select(
        F.col("k").alias(key), *([] if key == path else [F.col("p").alias(path)]),
        F.coalesce("license", rule["license"]).alias("license"), "cosine",
        F.when(own, "own").when(rule.isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(own, F.col("p")).otherwise(rule["p"]).alias("origin_path"))
