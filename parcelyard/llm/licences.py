"""License scans: a trained paragraph classifier, confirmed by templates.

Word n-gram logistic regression over licence families and an unknown class is trained
on varied templates against paragraphs of the corpus. Its probabilities are calibrated
on held-back examples. Lines are read by themselves and, in rows without a blank line,
across their breaks. A paragraph counts as licensed if a family is likely enough and
the paragraph also holds most of the word n-grams of one of the family's templates.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelyard.llm import textarrays as ta
from parcelyard.llm.storage import text_or_empty

#: Opening sentences and usual notices of common licences.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license. See the LICENSE file for details.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "The software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement.",
        "The MIT License (MIT)",
        "MIT License",
        "SPDX-License-Identifier: MIT",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS",
        "Apache License Version 2.0, January 2004",
        "Apache License 2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Licensed under the GNU General Public License v2.0 or later.",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "GNU General Public License version 2",
        "Licensed under GPLv2",
        "Licensed under GPLv3",
        "SPDX-License-Identifier: GPL-2.0-or-later",
        "SPDX-License-Identifier: GPL-3.0-only",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "Licensed under the GNU Lesser General Public License v2.1 or later.",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
        "GNU Lesser General Public License version 3",
        "Licensed under LGPLv3",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "AGPL": (
        "Licensed under the GNU Affero General Public License.",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "Licensed under the GNU Affero General Public License v3.0 or later.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
        "Licensed under AGPLv3",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ),
    "BSD": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Licensed under the BSD 2-Clause License.",
        "BSD 3-Clause License",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "ISC": (
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "ISC License",
        "SPDX-License-Identifier: ISC",
    ),
    "BSL-1.0": (
        "Distributed under the Boost Software License, Version 1.0.",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license",
        "Boost Software License Version 1.0",
        "SPDX-License-Identifier: BSL-1.0",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
        "Mozilla Public License Version 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Creative Commons Attribution 4.0",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "CC-BY-ND": (
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
        "Creative Commons Attribution-NoDerivatives 4.0",
        "SPDX-License-Identifier: CC-BY-ND-4.0",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Creative Commons Attribution-ShareAlike 4.0",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Creative Commons Attribution-NonCommercial 4.0",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "CC0": (
        "This work is dedicated to the public domain under CC0 1.0 Universal.",
        "This is free and unencumbered software released into the public domain.",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "Proprietary": (
        "All rights reserved.",
        "Copyright. All rights reserved. No part of this publication may be reproduced without prior written permission of the publisher.",
    ),
}
#: Fixed value: a short claim counts only where it ends, not in the midst of a sentence.
CLAIM = re.compile(rb"all\s+rights\s+reserved\s*(?:[^\w\s]|\Z|\n|by\b|worldwide\b)", re.IGNORECASE)
FAMILIES = tuple(TEMPLATES)
UNKNOWN = len(FAMILIES)

SLOTS = 1 << 16
#: Words of a unit; a longer paragraph is read in units that overlap by half.
UNIT = 32
MOST_PARAGRAPHS = 3000
LEAST_PROBABILITY, LEAST_SIMILARITY = 0.6, 0.6
#: Templates of up to four words, seven with their pairs, must be held in full.
SHORT = 7

#: Letters in lower case; ASCII signs count as blanks, line breaks stay.
_PLAIN = np.array(
    [ord(chr(c).lower()) if chr(c).isalnum() or chr(c) == "\n" else 0x20 for c in range(128)] + list(range(128, 256)),
    np.uint8,
)


@dataclass(frozen=True)
class Units:
    """Overlapping word runs of paragraphs: ``start:end`` in ``found``, and their paragraph."""

    found: ta.Words
    start: np.ndarray
    end: np.ndarray
    paragraph: np.ndarray


def units(data: np.ndarray, ends: np.ndarray) -> Units:
    """Units of the paragraphs that ``ends`` delimits in ``data``, which is plain already."""
    found = ta.words(data, ends)
    return _units_of(found, found.first)


def _units_of(found: ta.Words, first: np.ndarray) -> Units:
    """Units of the word runs ``first[i]:first[i + 1]``."""
    count = np.diff(first)
    n = np.where(count > UNIT, -(-(count - UNIT) // (UNIT // 2)) + 1, (count > 0).astype(np.int64))
    paragraph = np.repeat(np.arange(len(count)), n)
    place = np.arange(len(paragraph)) - np.repeat(np.cumsum(n) - n, n)
    start = first[paragraph] + place * (UNIT // 2)
    return Units(found, start, np.minimum(start + UNIT, first[paragraph + 1]), paragraph)


def line_units(data: np.ndarray, ends: np.ndarray, text: np.ndarray) -> tuple[Units, np.ndarray]:
    """Units of all lines, then those over several lines in a row; and the line of each word.

    Lines without a word part the rows; signs at a line's start are blanks already. The
    paragraph of a unit is its first line.
    """
    own = units(data, ends)
    found, count = own.found, np.diff(own.found.first)
    line = np.repeat(np.arange(len(count)), count)
    opens = count > 0
    opens[1:] &= (count[:-1] == 0) | (text[1:] != text[:-1])
    row = _units_of(found, np.append(found.first[:-1][opens], found.first[-1]))
    over = np.flatnonzero(line[row.start] != line[row.end - 1])
    start, end = row.start[over], row.end[over]
    both = (np.concatenate(x) for x in ((own.start, start), (own.end, end), (own.paragraph, line[start])))
    return Units(found, *both), line


def plain(data: np.ndarray) -> np.ndarray:
    return _PLAIN[data]


def paragraph_ends(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of all lines of the texts, and the text of each line."""
    breaks = np.flatnonzero(data == 0x0A) + 1
    ends = np.unique(np.concatenate([offsets, breaks]))
    return ends, np.searchsorted(offsets, ends[:-1], "right") - 1


def grams(found: ta.Words) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the single words and of the word pairs that start at each word."""
    mask = np.uint64(SLOTS - 1)
    pair = np.zeros(len(found.hash), np.uint64)
    pair[:-1] = ta.mixed(found.hash[:-1] * np.uint64(31) + found.hash[1:])
    return (found.hash & mask).astype(np.int64), (pair & mask).astype(np.int64)


def logits(parts: Units, weights: np.ndarray) -> np.ndarray:
    """Summed weights of the words and word pairs of each unit, scaled by its length."""
    width = weights.shape[1]
    if not len(parts.start):
        return np.zeros((0, width), np.float32)
    one, two = grams(parts.found)
    empty = np.zeros((1, width), np.float32)
    total = np.zeros((len(parts.start), width), np.float32)
    for slots, end in ((one, parts.end), (two, parts.end - 1)):
        held = np.concatenate([weights[slots], empty])
        bounds = np.stack([parts.start, np.maximum(end, parts.start)], 1).ravel()
        total += np.where((end > parts.start)[:, None], np.add.reduceat(held, bounds, axis=0)[::2], 0)
    return total / np.sqrt(parts.end - parts.start)[:, None] + weights[-1]


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _as_units(texts: list[str]) -> Units:
    data, offsets = ta.text_bytes(pa.array([" ".join(t.split()[:UNIT]) for t in texts], pa.large_string()))
    return units(plain(data), offsets)


def examples(paragraphs: list[str], seed: int = 7, variants: int = 40) -> tuple[list[str], np.ndarray]:
    """Varied templates with their family, and corpus paragraphs as unknown.

    A variant loses some words, takes corpus words before and after it, and may change
    case. Fragments of corpus text with a few template words mixed in are unknown too.
    """
    rng = np.random.default_rng(seed)
    stock = [w for p in paragraphs for w in p.split()] or ["text"]
    draw = lambda n: [stock[i] for i in rng.integers(0, len(stock), n)]
    texts, labels = [], []
    cues = [w for family in TEMPLATES.values() for t in family for w in t.split()]
    for k, family in enumerate(FAMILIES):
        for _ in range(variants):
            for template in TEMPLATES[family]:
                words = template.split()
                if len(_pairs(template)) > SHORT:
                    words = [w for w in words if rng.random() > 0.06]
                room = max(0, UNIT - len(words))
                before, after = rng.integers(0, room // 2 + 1, 2) if rng.random() < 0.6 else (0, 0)
                text = " ".join([*draw(before), *words, *draw(after)])
                texts.append(text.upper() if rng.random() < 0.1 else text)
                labels.append(k)
    for _ in range(20 * variants):
        words = draw(int(rng.integers(4, UNIT)))
        for i in rng.integers(0, len(words), int(rng.integers(1, 4))):
            words[i] = cues[rng.integers(0, len(cues))]
        texts.append(" ".join(words))
        labels.append(UNKNOWN)
    texts += paragraphs
    labels += [UNKNOWN] * len(paragraphs)
    return texts, np.array(labels)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    temperature: float


def train(paragraphs: list[str], rounds: int = 120, sparsity: float = 2e-5) -> Model:
    """Logistic regression with soft-thresholded weights; the temperature is fitted on held-back rows.

    Corpus paragraphs that hold most of a template are no examples of unknown text and
    are left out. Without paragraphs the templates alone are learned from.
    """
    paragraphs = [p for p in paragraphs if p.split() and best_template(p)[1] < LEAST_SIMILARITY]
    texts, labels = examples(paragraphs)
    keep = np.array([bool(_PLAIN[np.frombuffer(t.encode(), np.uint8)].tobytes().split()) for t in texts])
    texts, labels = [t for t, k in zip(texts, keep) if k], labels[keep]
    held = np.arange(len(texts)) % 5 == 0
    fit = _as_units([t for t, h in zip(texts, held) if not h])
    truth = np.eye(UNKNOWN + 1, dtype=np.float32)[labels[~held]][fit.paragraph]
    one, two = grams(fit.found)
    size = fit.end - fit.start
    owner = np.repeat(np.arange(len(size)), size)
    within = np.concatenate([np.arange(a, b) for a, b in zip(fit.start, fit.end)])
    inner = within < fit.end[owner] - 1
    row = np.concatenate([owner, owner[inner]])
    slot, column = np.unique(np.concatenate([one[within], two[within[inner]]]), return_inverse=True)
    scale = 1 / np.sqrt(size)[row]
    weights = np.zeros((SLOTS + 1, UNKNOWN + 1), np.float32)
    used = np.zeros((len(slot) + 1, UNKNOWN + 1))
    squares = np.full_like(used, 1e-8)
    for _ in range(rounds):
        weights[slot], weights[-1] = used[:-1], used[-1]
        error = (_softmax(logits(fit, weights)) - truth) / len(size)
        step = np.zeros_like(used)
        for k in range(UNKNOWN + 1):
            step[:-1, k] = np.bincount(column, scale * error[row, k], len(slot))
        step[-1] = error.sum(0)
        squares += step**2
        rate = 0.5 / np.sqrt(squares)
        used -= rate * step
        used[:-1] = np.sign(used[:-1]) * np.maximum(np.abs(used[:-1]) - rate[:-1] * sparsity, 0)
    weights[slot], weights[-1] = used[:-1], used[-1]
    check = _as_units([t for t, h in zip(texts, held) if h])
    z, answer = logits(check, weights), labels[held][check.paragraph]
    loss = lambda t: -np.log(_softmax(z / t)[np.arange(len(z)), answer] + 1e-12).mean()
    return Model(weights, float(min(np.geomspace(0.25, 4, 33), key=loss)))


def _pairs(text: str) -> set[tuple[bytes, ...]]:
    words = plain(np.frombuffer(text.encode(), np.uint8)).tobytes().split()
    return {(w,) for w in words} | set(zip(words, words[1:]))


#: Words and pairs of every template.
NEEDS = {family: [_pairs(template) for template in texts] for family, texts in TEMPLATES.items()}


def _held(have: set, need: set) -> float:
    """The share of a template that a text holds; a short one is held in full or not at all."""
    share = len(have & need) / len(need)
    return share if share == 1 or len(need) > SHORT else 0.0


def _best_need(have: set, family: str) -> set[tuple[bytes, ...]]:
    """The words and pairs of the family's template that is held best, the longest of these."""
    return max(NEEDS[family], key=lambda need: (_held(have, need), len(have & need)))


def best_template(text: str, family: str | None = None) -> tuple[str, float]:
    """The family, of all or of the one given, whose templates the text holds best, and how far."""
    have = _pairs(text)
    share, name = max((_held(have, _best_need(have, name)), name) for name in ([family] if family else FAMILIES))
    return name, share


def confirmed(text: str, family: str, raw: bytes | None = None) -> float:
    """How far the text holds a template of ``family``; 0 if it does not confirm the family.

    It does not where a template of another family is held better, or as well and is longer,
    and has all of the words and pairs that speak for this one. ``raw`` are the bytes of the
    text with its signs, which tell a claim of rights from words within a sentence.
    """
    have = _pairs(text)
    need = _best_need(have, family)
    share, evidence = _held(have, need), have & need
    if share < LEAST_SIMILARITY:
        return 0.0
    for other in FAMILIES:
        if other == family:
            continue
        for rival in NEEDS[other]:
            held = _held(have, rival)
            if held >= share and evidence <= rival and (held > share or len(have & rival) > len(evidence)):
                return 0.0
    if family == "Proprietary" and len(evidence) <= SHORT and raw is not None and not CLAIM.search(raw):
        return 0.0
    return share


def _common(text: bytes, family: str) -> set[tuple[bytes, ...]]:
    """What the text shares with the family's best template."""
    have = _pairs(text.decode("utf-8", "replace"))
    return have & _best_need(have, family)


def _first_met(text: bytes, family: str) -> int:
    """The first word of a pair that the family's best template for the text has too."""
    words, need = text.split(), _best_need(_pairs(text.decode("utf-8", "replace")), family)
    return next((i for i, pair in enumerate(zip(words, words[1:])) if pair in need), 0)


FINDING = "array<struct<paragraph: int, family: string, probability: double, similarity: double>>"


def _scanned_batches(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([
        ("paragraph", pa.int32()), ("family", pa.string()), ("probability", pa.float64()), ("similarity", pa.float64()),
    ]))
    for batch in batches:
        raw, offsets = ta.text_bytes(batch.column("_text"))
        rest = batch.drop_columns(["_text"])
        for a, b in ta.pieces(offsets):
            signed = raw[offsets[a] : offsets[b]]
            data = plain(signed)
            own = offsets[a : b + 1] - offsets[a]
            ends, text = paragraph_ends(data, own)
            parts, line = line_units(data, ends, text)
            chance = _softmax(logits(parts, model.weights) / model.temperature)
            family = chance[:, :UNKNOWN].argmax(1)
            likely = chance[np.arange(len(family)), family]
            first = np.searchsorted(text, np.arange(b - a))
            found: list[dict[int, dict]] = [{} for _ in range(b - a)]
            across, said = [], {}
            for k in np.flatnonzero(likely >= LEAST_PROBABILITY):
                opens, closes = parts.found.start[parts.start[k]], parts.found.end[parts.end[k] - 1]
                words = data[opens:closes]
                name = FAMILIES[family[k]]
                said_here = words.tobytes().decode("utf-8", "replace")
                to_line_end = signed[opens : ends[line[parts.end[k] - 1] + 1]]
                share = confirmed(said_here, name, to_line_end.tobytes())
                if not share:
                    continue
                p = parts.paragraph[k]
                last = line[parts.end[k] - 1]
                if p != last:
                    across.append((text[p], name, p, last, k, share, words))
                    continue
                row = {"paragraph": int(p - first[text[p]]), "family": name, "probability": float(likely[k]), "similarity": share}
                best = found[text[p]].get((row["paragraph"], name))
                if best is None or row["probability"] > best["probability"]:
                    found[text[p]][row["paragraph"], name] = row
                    said[text[p], row["paragraph"], name] = words.tobytes()
            for t, name, p, last, _, share, words in across:
                for (at, other), row in list(found[t].items()):
                    if other != name and p <= at + first[t] <= last and row["similarity"] < share:
                        if _common(said[t, at, other], other) <= _best_need(_pairs(words.tobytes().decode("utf-8", "replace")), name):
                            del found[t][at, other]
            own_lines = [{(row["paragraph"], row["family"]) for row in f.values()} for f in found]
            reached: dict[tuple[int, str], tuple[int, dict]] = {}
            for t, name, p, last, k, share, words in across:
                if any((int(x - first[t]), name) in own_lines[t] for x in range(p, last + 1)):
                    continue
                until, row = reached.get((t, name), (-1, None))
                if parts.start[k] >= until:
                    at = line[parts.start[k] + _first_met(words.tobytes(), name)]
                    row = {"paragraph": int(at - first[t]), "family": name, "probability": 0.0, "similarity": 0.0}
                    row = found[t].setdefault((row["paragraph"], name), row)
                reached[t, name] = (parts.end[k], row)
                if likely[k] > row["probability"]:
                    row.update(probability=float(likely[k]), similarity=share)
            lists = [[f[key] for key in sorted(f)] for f in found]
            yield pa.RecordBatch.from_arrays(
                [*rest.slice(a, b - a).columns, pa.array(lists, kind)], [*rest.schema.names, "licences"]
            )


def sample_paragraphs(df: DataFrame, most: int = MOST_PARAGRAPHS, text: str = "text") -> list[str]:
    """At most ``most`` different paragraphs of the corpus, those of smallest hash, cut to one unit.

    The number of different lines, estimated within a few percent, gives a bound on the
    hash that about four times ``most`` of them pass. Only these are sorted, so what goes
    to the driver is bounded for the whole corpus and not by task, and a line that stands
    in very many documents takes one place.
    """
    lines = df.select(F.explode(F.split(text_or_empty(text), "\n")).alias("line")).select(
        "line", F.xxhash64("line").alias("h")
    )
    different = lines.agg(F.approx_count_distinct("h", 0.02)).first()[0]
    share = min(1.0, 4 * most / max(1, different))
    first = F.regexp_extract("line", rf"^\s*((?:\S+\s*){{1,{UNIT}}})", 1)
    passing = lines.filter(F.col("h") <= int(-(2**63) + share * (2**64 - 2**12)))
    kept = passing.select(first.alias("line"), "h").filter("line <> ''")
    least = kept.groupBy("line").agg(F.min("h").alias("h"))
    return [r["line"] for r in least.orderBy("h", "line").limit(most).collect()]


def scan_licences(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` without its text, with ``licences``: paragraph, family, probability, similarity.

    Lines of the whole text are counted from 0. Long ones are read in overlapping units
    and named once for each family in them. So are rows of lines without a blank one, for
    notices that run over line breaks; these are named by the line they begin on, and a
    line that holds nothing beyond such a notice does not count for another family. A null or empty text has
    an empty list. An input column ``licences`` gives way. Nothing is shuffled.
    """
    others = [c for c in df.columns if c not in (text, "licences")]
    source = df.select(*others, text_or_empty(text).alias("_text"))
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name in others]
    return source.mapInArrow(
        lambda batches: _scanned_batches(batches, shared.value), ", ".join([*schema, f"licences {FINDING}"])
    )
