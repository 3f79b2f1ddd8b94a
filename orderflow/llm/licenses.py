"""License scan: an exact set-similarity join of text blocks with license templates."""

from __future__ import annotations

import bisect
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import WORDS

#: Phrases that name a license wherever they stand.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: The notices of common licenses.
TEMPLATES = {
    "Released under the MIT License": "mit",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
    "software and associated documentation files (the \"Software\"), to deal in the Software "
    "without restriction": "mit",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
    "without fee is hereby granted, provided that the above copyright notice and this permission "
    "notice appear in all copies": "isc",
    "This software is provided 'as-is', without any express or implied warranty. In no event will "
    "the authors be held liable for any damages arising from the use of this software": "zlib",
    "Distributed under the Boost Software License, Version 1.0": "bsl",
    "This program and the accompanying materials are made available under the terms of the "
    "Eclipse Public License": "epl",
    "Licensed under the Apache License, Version 2.0": "apache",
    "You may not use this file except in compliance with the License": "apache",
    "This program is free software: you can redistribute it and/or modify it under the terms of "
    "the GNU General Public License as published by the Free Software Foundation": "gpl",
    "This work is licensed under the GNU General Public License, version 3": "gpl",
    "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met": "bsd",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0": "mpl",
    "This work is licensed under a Creative Commons Attribution 4.0 International License": "cc",
    "Licensed under CC BY-NC 4.0": "cc",
    "This is free and unencumbered software released into the public domain": "unlicense",
}

#: Words of a block: a longer line is cut into blocks that overlap by half.
BLOCK_WORDS = 400


#: A notice that is wrapped over lines lies within so many times its template's words, so that
#: each line may begin with a word of its own, as comments do.
SPREAD = 2


def blocks(text: bytes) -> tuple[list[bytes], list[tuple[int, int]], list[int]]:
    """A text's words, the first and last place of each block, and the lines' ends.

    A block is a line with words. A line of more than ``BLOCK_WORDS`` words is cut into blocks of
    that many, each beginning in the middle of the one before.
    """
    words: list[bytes] = []
    cut = []
    ends = []
    for line in text.split(b"\n"):
        found = line.translate(WORDS).split()
        first, size = len(words), len(found)
        words += found
        if size:
            ends.append(first + size)
        if 0 < size <= BLOCK_WORDS:
            cut.append((first, first + size))
        elif size:
            step = BLOCK_WORDS // 2
            cut += [(first + i, min(first + i + BLOCK_WORDS, first + size))
                    for i in range(0, size - step, step)]
    return words, cut, ends


def windows(ends: list[int], reach: int) -> Iterator[tuple[int, int]]:
    """First and last place of blocks over all lines of a text, which end at ``ends``.

    They have ``2 * reach`` words and begin every ``reach`` words, so any ``reach`` words in a row
    lie within one of them. Those within a single line are left out: the line's blocks hold them.
    """
    line, size = 0, ends[-1] if ends else 0
    for first in range(0, max(size - reach, min(size, 1)), reach):
        last = min(first + 2 * reach, size)
        while ends[line] <= first:
            line += 1
        if ends[line] < last:
            yield first, last


class Templates:
    """Templates' word sets in one global order, the corpus' rarest words first.

    ``index`` leads from a word to the templates that have it in their prefix, with its place.
    Any block that holds at least ``need`` of a template's words holds one of the prefix's
    ``size - need + 1`` words.
    """

    def __init__(self, templates: Mapping[str, str], threshold: float,
                 frequency: Mapping[bytes, int]) -> None:
        self.labels = list(templates.values())
        sets = [set(t.encode().translate(WORDS).split()) for t in templates]
        self.order = {w: i for i, w in enumerate(
            sorted(set().union(*sets), key=lambda w: (frequency.get(w, 0), w)))}
        self.words = [sorted(s, key=self.order.__getitem__) for s in sets]
        self.need = [max(1, int(np.ceil(threshold * len(s) - 1e-9))) for s in sets]
        self.index: dict[bytes, list[tuple[int, int]]] = {}
        for t, words in enumerate(self.words):
            for place, word in enumerate(words[:len(words) - self.need[t] + 1]):
                self.index.setdefault(word, []).append((t, place))
        self.sets = [frozenset(s) for s in sets]
        self.spread = [SPREAD * len(t.encode().translate(WORDS).split()) for t in templates]
        self.reach = max(self.spread, default=1)

    def match(self, block: set[bytes]) -> list[tuple[int, float]]:
        """Templates that the block contains to the threshold, and the contained part."""
        shared = sorted(block & self.order.keys(), key=self.order.__getitem__)
        seen: dict[int, int] = {}
        for j, word in enumerate(shared):
            for t, place in self.index.get(word, ()):
                if len(block) < self.need[t]:
                    continue  # length filter
                had = seen.get(t, 0)
                left = min(len(self.words[t]) - place, len(shared) - j)
                if had + left >= self.need[t]:  # positional filter
                    seen[t] = had + 1
        found = []
        for t in seen:
            part = len(self.sets[t] & block)
            if part >= self.need[t]:
                found.append((t, part / len(self.sets[t])))
        return found

    def densest(self, t: int, words: list[bytes]) -> tuple[int, int, float]:
        """The stretch of a wrapped notice with most of the template's words.

        First and last place of the first such stretch, and the contained part. A stretch begins
        and ends with a word of the template and has at most ``SPREAD`` times its words.
        """
        places = [i for i, w in enumerate(words) if w in self.sets[t]]
        best, low, inside = (0, 0, 0), 0, {}
        for at in places:
            inside[words[at]] = inside.get(words[at], 0) + 1
            while at - places[low] >= self.spread[t] or inside[words[places[low]]] > 1:
                gone = words[places[low]]
                inside[gone] -= 1
                if not inside[gone]:
                    del inside[gone]
                low += 1
            if len(inside) > best[0]:
                best = (len(inside), places[low], at)
        return best[1], best[2], best[0] / len(self.sets[t])


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[bytes]:
    for text in batch.column(column).cast(pa.large_binary()):
        yield text.as_py() or b""


def frequencies(docs: DataFrame, words: set[bytes]) -> dict[bytes, int]:
    """In how many blocks of the whole corpus each of ``words`` stands.

    Each task sums its own counts, so a few rows per task are shuffled. At most as many rows as
    there are template words reach the driver.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = dict.fromkeys(words, 0)
        for batch in batches:
            for text in _texts(batch, 0):
                found, cut, _ = blocks(text)
                for first, last in cut:
                    for word in words.intersection(found[first:last]):
                        total[word] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())],
            names=["word", "n"])

    rows = docs.select(F.col("text").cast("string")).mapInArrow(count, "word binary, n long")
    return {bytes(r["word"]): r["n"] for r in
            rows.groupBy("word").agg(F.sum("n").alias("n")).collect()}


SCANNED = ("doc_id long, n_words long, n_base long, first_word long, last_word long, "
           "base_labels string, labels string, score double, blocks array<struct<first:long,"
           "last:long,label:string,part:double>>")


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES,
         phrases: Mapping[str, str] = PHRASES, threshold: float = 0.8) -> DataFrame:
    """License notices in every whole text.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. Returns one row per input
    row: doc_id, n_words, n_base (places where a phrase's words follow each other), first_word
    and last_word (their smallest and largest first word, null without any), base_labels (of the
    phrases), labels (with those of the templates that some block contains to the threshold),
    score (the greatest contained part of those, else 0) and blocks (first and last word, label
    and part of each such pair). Blocks are the lines, and for notices that are wrapped over lines
    the stretches found in overlapping :func:`windows` over all words. Null and empty texts have no words; null and repeated ids keep
    their rows. An empty table gives no rows.

    Templates are few and fixed and go to every task. Two scans, no text is shuffled.
    """
    words = set().union(*(t.encode().translate(WORDS).split() for t in templates))
    join = Templates(templates, threshold, frequencies(docs, words))
    wanted = [(p.encode().split(), label) for p, label in phrases.items()]

    def places(found: list[bytes]) -> list[tuple[int, str]]:
        out = []
        for phrase, label in wanted:
            at, first = -1, phrase[0]
            for _ in range(found.count(first)):
                at = found.index(first, at + 1)
                if found[at:at + len(phrase)] == phrase:
                    out.append((at, label))
        return out

    def wrapped(found: list[bytes], ends: list[int]) -> list[tuple]:
        out: dict[tuple, None] = {}
        for first, last in windows(ends, join.reach):
            words = found[first:last]
            if join.index.keys().isdisjoint(words):
                continue
            for t, _ in join.match(set(words)):
                begin, end, part = join.densest(t, words)
                line = bisect.bisect_right(ends, first + begin)
                if part >= join.need[t] / len(join.sets[t]) and ends[line] <= first + end:
                    out[first + begin, first + end, join.labels[t], part] = None
        return list(out)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), _texts(batch, 1), strict=True):
                found, cut, ends = blocks(text)
                base = places(found)
                matched = []
                for first, last in cut:
                    if not join.index.keys().isdisjoint(found[first:last]):
                        matched += [(first, last - 1, join.labels[t], part)
                                    for t, part in join.match(set(found[first:last]))]
                matched += wrapped(found, ends)
                own = {label for _, label in base}
                every = own | {m[2] for m in matched}
                out.append((
                    doc, len(found), len(base), min((p for p, _ in base), default=None),
                    max((p for p, _ in base), default=None), ",".join(sorted(own)),
                    ",".join(sorted(every)), max((m[3] for m in matched), default=0.0),
                    [dict(zip(("first", "last", "label", "part"), m, strict=True))
                     for m in matched]))
            block = pa.struct([("first", pa.int64()), ("last", pa.int64()),
                               ("label", pa.string()), ("part", pa.float64())])
            kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64(), pa.list_(block)]
            columns = zip(*out, strict=True) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels",
                       "labels", "score", "blocks"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(read, SCANNED)
