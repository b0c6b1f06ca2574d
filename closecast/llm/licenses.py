"""Licence scan: sparse TF-IDF cosine of text lines to licence templates, and inheritance along directories.

Every line of a text is a possible notice. Its words (A-Z lower-cased) form a
TF-IDF vector whose document frequencies are counted over all lines of the
corpus, in 2^18 hashed counters (a table of fixed size). A line matches the
template with the largest cosine, if that is at least ``threshold``. Only lines whose words
carry enough of some template's weight are compared: the cosine cannot exceed
the norm of the template's shared part, so nothing that matches is skipped.

A document's own licence is that of its best line. A document whose first or
last line with words matches (a header or a footer) speaks for its directory. A document without a licence inherits
from its nearest ancestor directory that has one: directories, not documents,
are exploded into their ancestors and joined by path, then documents join
their directory's answer.

Defined cases: a null or empty text has no lines; equal cosines go to the
earlier template name; of several such documents in a directory the one with
the largest cosine counts, then the smaller path; a null path has no
directory and inherits nothing; repeated rows get equal answers; an empty
corpus gives no rows. Columns of the input pass through unless ``columns`` is given.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from closecast.llm.common import checkpointed, chunk_words, text_chunks, words
from closecast.llm.line_dedup import line_borders

THRESHOLD = 0.7
COUNTER_BITS = 18
_SLICES = 16

# Usual wording of licence notices.
TEMPLATES: dict[str, list[str]] = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0", "you may not use this file except in compliance with the License",
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "BSD-3-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
                     "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file", "Licensed under the BSD 3-Clause License"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2",
                "it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3",
                "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"],
    "MIT": ["Released under the MIT License", "Licensed under the MIT License",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "Licensed under the Mozilla Public License 2.0"],
}


class Templates(NamedTuple):
    names: list[str]  # of each template line
    vocabulary: np.ndarray  # sorted word hashes
    weights: np.ndarray  # template lines x vocabulary, unit rows
    idf: np.ndarray  # of each hashed counter


def _lines_of(data: bytes, offsets: np.ndarray):
    """Line starts, the lines' rows, their words, and each word's line."""
    borders, row = line_borders(data, offsets)
    w = chunk_words(data, borders)
    return row, w, np.repeat(np.arange(len(row)), np.diff(w.first))


def _counter(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines that each hashed counter's words occur in; the last slice adds the number of lines."""
    total = np.zeros(1 << COUNTER_BITS, dtype=np.int64)
    lines = 0
    for batch in batches:
        for c in text_chunks(batch.column("text")):
            row, w, line = _lines_of(c.data, c.offsets)
            if len(line) == 0:
                continue
            once = np.sort(line.astype(np.uint64) << np.uint64(COUNTER_BITS) | _counter(w.hash).astype(np.uint64))
            once = once[np.concatenate([[True], once[1:] != once[:-1]])]
            total += np.bincount((once & np.uint64((1 << COUNTER_BITS) - 1)).astype(np.int64), minlength=len(total))
            lines += len(np.unique(line))
    parts = [x.tobytes() for x in np.split(total, _SLICES)] + [np.array([lines], dtype=np.int64).tobytes()]
    yield pa.RecordBatch.from_arrays([pa.array(range(_SLICES + 1), pa.int32()), pa.array(parts, pa.binary())], names=["slice", "counts"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, x in zip(batch.column("slice").to_pylist(), batch.column("counts"), strict=True):
            got = np.frombuffer(x.as_buffer(), dtype=np.int64)
            total[k] = total[k] + got if k in total else got
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["slice", "counts"])


def weigh_templates(docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES) -> Templates:
    """Template vectors under the corpus' inverse document frequencies (lines are the documents)."""
    schema = "slice int, counts binary"
    parts = docs.select("text").mapInArrow(_frequencies, schema).repartition(_SLICES, "slice").mapInArrow(_summed, schema).collect()
    df, lines = np.zeros(1 << COUNTER_BITS, dtype=np.int64), 0
    each = len(df) // _SLICES
    for r in parts:
        got = np.frombuffer(bytes(r["counts"]), dtype=np.int64)
        if r["slice"] == _SLICES:
            lines = int(got[0])
        else:
            df[r["slice"] * each:(r["slice"] + 1) * each] = got
    idf = np.log((lines + 1) / (df + 1.0)) + 1
    names = [name for name in sorted(templates) for _ in templates[name]]
    hashed = []
    for text in (t for name in sorted(templates) for t in templates[name]):
        raw = b" ".join(words(text.encode()))
        hashed.append(chunk_words(raw, np.array([0, len(raw)])).hash)
    vocabulary = np.unique(np.concatenate(hashed))
    weights = np.zeros((len(names), len(vocabulary)))
    for k, h in enumerate(hashed):
        np.add.at(weights[k], np.searchsorted(vocabulary, h), 1.0)
    weights *= idf[_counter(vocabulary)]
    return Templates(names, vocabulary, weights / np.sqrt((weights ** 2).sum(axis=1, keepdims=True)), idf)


def match_lines(t: Templates, data: bytes, offsets: np.ndarray, threshold: float = THRESHOLD) -> list[list[tuple[int, str, float, bool]]]:
    """Per text of a chunk: (line number, licence, cosine, whether it is the first or last line) of its matching lines."""
    out: list[list[tuple[int, str, float, bool]]] = [[] for _ in range(len(offsets) - 1)]
    row, w, line = _lines_of(data, offsets)
    if len(line) == 0:
        return out
    at = np.searchsorted(t.vocabulary, w.hash)
    at[at == len(t.vocabulary)] = 0
    known = np.flatnonzero(t.vocabulary[at] == w.hash)
    if len(known) == 0:
        return out
    pair = np.unique(line[known] * len(t.vocabulary) + at[known])
    own = pair // len(t.vocabulary)
    lines, begin = np.unique(own, return_index=True)
    # the norm of the shared part of each template bounds the cosine
    bound = np.add.reduceat(t.weights.T[pair % len(t.vocabulary)] ** 2, begin, axis=0).max(axis=1)
    for k in lines[bound >= threshold ** 2 - 1e-9]:
        h, n = np.unique(w.hash[w.first[k]:w.first[k + 1]], return_counts=True)
        v = n * t.idf[_counter(h)]
        v /= np.sqrt((v ** 2).sum())
        i = np.searchsorted(t.vocabulary, h)
        i[i == len(t.vocabulary)] = 0
        shared = t.vocabulary[i] == h
        cosine = t.weights[:, i[shared]] @ v[shared]
        best = int(cosine.argmax())
        if cosine[best] >= threshold:
            begin, stop = np.searchsorted(row, (row[k], row[k] + 1))
            edge = k == begin or w.first[k + 1] == w.first[stop]  # nothing but wordless lines may follow the last
            out[row[k]].append((int(k - begin), t.names[best], min(1.0, round(float(cosine[best]), 9)), bool(edge)))
    return out


_OWN = T.StructType([
    T.StructField("license", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("n_notices", T.LongType()),
    T.StructField("notice_lines", T.ArrayType(T.LongType())), T.StructField("edge_license", T.StringType()), T.StructField("edge_score", T.DoubleType())])


def _scanned(templates, threshold: float):
    kind = pa.struct([("license", pa.string()), ("score", pa.float64()), ("n_notices", pa.int64()), ("notice_lines", pa.list_(pa.int64())),
                      ("edge_license", pa.string()), ("edge_score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = templates.value
        for batch in batches:
            out = []
            for c in text_chunks(batch.column("__text")):
                for found in match_lines(t, c.data, c.offsets, threshold):
                    best = min(found, key=lambda f: (-f[2], f[1]), default=None)
                    edge = min((f for f in found if f[3]), key=lambda f: (-f[2], f[1]), default=None)
                    out.append({"license": best and best[1], "score": best and best[2], "n_notices": len(found), "notice_lines": [f[0] for f in found],
                                "edge_license": edge and edge[1], "edge_score": edge and edge[2]})
            keep = [i for i, c in enumerate(batch.schema.names) if c != "__text"]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in keep] + [pa.array(out, kind)], names=[batch.schema.names[i] for i in keep] + ["__own"])
    return run


def scan_licenses(docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES, threshold: float = THRESHOLD, columns: list[str] | None = None) -> DataFrame:
    """``docs`` (text, path) with license, origin (own, inherited or none), inherited_from, score, n_notices and notice_lines."""
    ours = ["license", "origin", "inherited_from", "score", "n_notices", "notice_lines"]
    kept = [c for c in (columns if columns is not None else docs.columns) if c not in ours]
    weighed = docs.sparkSession.sparkContext.broadcast(weigh_templates(docs, templates))
    src = docs.select(*[F.col(f"`{c}`") for c in kept], F.col("path").alias("__path"), F.col("text").alias("__text"))
    schema = T.StructType([f for f in src.schema.fields if f.name != "__text"] + [T.StructField("__own", _OWN)])
    scanned = checkpointed(src.mapInArrow(_scanned(weighed, threshold), schema).withColumn(
        "__dir", F.when(F.col("__path").contains("/"), F.regexp_extract("__path", r"^(.*)/[^/]*$", 1))))
    own = F.col("__own")
    # directories that a document speaks for
    files = scanned.where(own["edge_license"].isNotNull() & F.col("__dir").isNotNull())
    given = files.groupBy(F.col("__dir").alias("ancestor")).agg(
        F.min(F.struct((-own["edge_score"]).alias("s"), F.col("__path").alias("p"), own["edge_license"].alias("l"))).alias("x")).select("ancestor", F.col("x.l").alias("given"))
    # each distinct directory looks up its ancestors (itself first); a path has few
    dirs = scanned.where(F.col("__dir").isNotNull()).select("__dir").distinct()
    parts = F.split("__dir", "/")
    up = dirs.select("__dir", F.explode(F.sequence(F.lit(1), F.size(parts))).alias("depth")).withColumn(
        "ancestor", F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/"))
    nearest = up.join(given, "ancestor").groupBy("__dir").agg(F.max(F.struct("depth", "ancestor", "given")).alias("x")).select(
        "__dir", F.col("x.ancestor").alias("__from"), F.col("x.given").alias("__given"))
    out = scanned.join(nearest, "__dir", "left")
    mine = own["license"].isNotNull()
    return out.select(
        *[F.col(f"`{c}`") for c in kept], F.coalesce(own["license"], "__given").alias("license"),
        F.when(mine, "own").when(F.col("__given").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(~mine, F.col("__from")).alias("inherited_from"), own["score"].alias("score"), own["n_notices"].alias("n_notices"), own["notice_lines"].alias("notice_lines"))
