"""Licence scan: MinHash bands over overlapping text windows retrieve templates, exact shingle containment decides.

Templates and texts are cut into five-word shingles. Templates are grouped by length; for a group with at most s shingles a
text is covered by windows of s + s/4 shingles that start every s/4, so any passage as long as the template lies whole in one
of them. A window that holds at least ``CONTAINED`` of a template of the group has a Jaccard similarity to it of 0.29 or more, and ``BANDS``
bands of one MinHash value each find it with a probability of 1 - 0.71 ** 32 = 0.99998. Groups whose step is one shingle slide over
every position. Whatever the bands find is a hit only if the window holds at least ``CONTAINED`` of the template's shingles; of
overlapping windows the one that holds most counts, the first of equals.

One altered word spoils as many shingles as a shingle has words, so a template of fewer than 29 words is cut into shorter ones, the
longest that leave ``CONTAINED`` of them after one altered word. A template's ``NAMED`` phrases tell it from its kin (the licence
and its version) and have to stand in the passage unaltered. A template of fewer than ``SHORT`` words with one such phrase is looked for
at every place of the phrase: of its words ``CONTAINED`` have to stand around it in their order, with at most one word between them on either side.

Defined results: a null or short text has no hits. A text may hold a template several times. Repeated rows are scanned alike; other
columns are not read. Templates of fewer than five words are refused.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillweave.llm import frames, kernels

CONTAINED = 0.8
BANDS = 32
SHINGLE_WORDS = 5
SHORT = 20
HITS = "doc_id bigint, license string, start bigint, end bigint, containment double, passage string"

# Notices by which public licences are granted.
TEMPLATES = {
    "mit": "Released under the MIT License.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "mit-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions"
    ),
    "apache-2.0-notice": (
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied."
    ),
    "gpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "bsd-notice": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met"
    ),
    "isc": "Released under the ISC License.",
    "isc-notice": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "mpl-2.0": "Licensed under the Mozilla Public License, version 2.0.",
    "mpl-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "lgpl-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "lgpl-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "agpl-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
}
NAMED = {
    "mit": ("MIT License",), "isc": ("ISC License",), "apache-2.0": ("Apache License, Version 2.0",),
    "mpl-2.0": ("Mozilla Public License, version 2.0",), "gpl-3.0-notice": ("GNU General", "version 3"),
    "gpl-2.0": ("GNU General Public License, version 2",), "gpl-3.0": ("GNU General Public License, version 3",),
    "lgpl-2.1": ("GNU Lesser General Public License, version 2.1",), "lgpl-3.0": ("GNU Lesser General Public License, version 3",),
    "agpl-3.0": ("GNU Affero General Public License, version 3",),
}
for _name, _who, _version in (("gpl-2.0", "", "2"), ("lgpl-2.1", "Lesser ", "2.1"), ("lgpl-3.0", "Lesser ", "3"), ("agpl-3.0", "Affero ", "3")):
    TEMPLATES[f"{_name}-notice"] = (
        f"This {'library' if _name == 'lgpl-2.1' else 'program'} is free software: you can redistribute it and/or modify it under the terms of the GNU "
        f"{_who}General Public License as published by the Free Software Foundation, either version {_version} of the License, or (at your option) any later version."
    )
    NAMED[f"{_name}-notice"] = (f"GNU {_who}General", f"version {_version}")
for _short, _long in (
    ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC", "Attribution-NonCommercial"),
    ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
):
    _name = f"cc-{_short.lower()}-4.0"
    TEMPLATES |= {
        _name: f"Licensed under CC {_short} 4.0.",
        f"{_name}-notice": f"This work is licensed under a Creative Commons {_long} 4.0 International License.",
    }
    NAMED |= {_name: (f"CC {_short} 4.0",), f"{_name}-notice": (f"Creative Commons {_long} 4.0",)}
# Full texts are known by their titles.
for _name, _title in (
    ("apache-2.0-text", "Apache License Version 2.0, January 2004"), ("gpl-2.0-text", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("gpl-3.0-text", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"), ("lgpl-2.1-text", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("lgpl-3.0-text", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("agpl-3.0-text", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
):
    TEMPLATES[_name] = _title
    NAMED[_name] = (_title,)


def words_of(text: str) -> np.ndarray:
    return next(kernels.document_words(pa.array([text])))


def places(words: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Where the phrase begins."""
    at = np.flatnonzero(words[: max(len(words) - len(phrase) + 1, 0)] == phrase[0])
    for i in range(1, len(phrase)):
        at = at[words[at + i] == phrase[i]]
    return at


def in_order(wanted: list[int], theirs: list[int]) -> tuple[int, int]:
    """How many of the wanted words stand in ``theirs`` in their order, and the shortest beginning that holds as many."""
    row, most, extent = [0] * (len(wanted) + 1), 0, 0
    for i, word in enumerate(theirs):
        new = [0]
        for j, other in enumerate(wanted):
            new.append(row[j] + 1 if word == other else max(row[j + 1], new[j]))
        row = new
        if row[-1] > most:
            most, extent = row[-1], i + 1
    return most, extent


class Short:
    """A short template: the words before its named phrase, nearest first, the phrase, and the words behind it."""

    def __init__(self, name: str, words: np.ndarray, phrase: np.ndarray):
        at = int(places(words, phrase)[0])
        self.name, self.phrase, self.size = name, phrase, len(words)
        self.within: list[tuple[np.ndarray, int]] = []
        self.before, self.behind = words[:at][::-1].tolist(), words[at + len(phrase) :].tolist()

    def part_of(self, others: list[Short]) -> None:
        """A phrase inside a longer one, like that of a title, stands for the longer one's template there."""
        for other in others:
            if len(other.phrase) > len(self.phrase):
                self.within += [(other.phrase, at) for at in places(other.phrase, self.phrase).tolist()]

    def hits(self, words: np.ndarray) -> list[tuple[str, int, int, float]]:
        found, last = [], 0
        for at in places(words, self.phrase).tolist():
            if any(at >= ahead and np.array_equal(words[at - ahead : at - ahead + len(longer)], longer) for longer, ahead in self.within):
                continue
            after = at + len(self.phrase)
            left, first = in_order(self.before, words[max(at - len(self.before) - 1, last) : at][::-1].tolist())
            right, end = in_order(self.behind, words[after : after + len(self.behind) + 1].tolist())
            share = (left + len(self.phrase) + right) / self.size
            if share >= CONTAINED - 1e-9:
                last = after + end
                found.append((self.name, at - first, last, share))
        return found


class Group:
    """Templates of one length class: their MinHash values and the windows they are looked for in."""

    def __init__(self, words: int, longest: int, templates: list[tuple[str, np.ndarray]], seeds: np.ndarray):
        self.words = words
        self.step = max(longest // 4, 1)
        self.width = longest if self.step == 1 else 5 * self.step
        self.templates = [(name, shingles, [words_of(phrase) for phrase in NAMED.get(name, ())]) for name, shingles in templates]
        self.known = np.unique(np.concatenate([shingles for _, shingles in templates]))
        self.lowest = [(shingles[None, :] * seeds[:, None]).min(axis=1)[:, None] for _, shingles in templates]


def grouped(templates: dict[str, str], seeds: np.ndarray) -> list[Group | Short]:
    by_size: dict[tuple[int, int], list[tuple[str, np.ndarray]]] = {}
    found: list[Short] = []
    for name, text in sorted(templates.items()):
        words = words_of(text)
        if len(words) < SHINGLE_WORDS:
            raise ValueError(f"template {name} has fewer than {SHINGLE_WORDS} words")
        phrases = [words_of(phrase) for phrase in NAMED.get(name, ())]
        if len(words) < SHORT and len(phrases) == 1 and len(places(words, phrases[0])):
            found.append(Short(name, words, phrases[0]))
            continue
        size = min(SHINGLE_WORDS, (len(words) + 1) // (SHINGLE_WORDS + 1))
        shingles = np.unique(kernels.shingles(words, size))
        by_size.setdefault((size, 1 << (len(shingles) - 1).bit_length()), []).append((name, shingles))
    for short in found:
        short.part_of(found)
    return found + [Group(*size, members, seeds) for size, members in sorted(by_size.items())]


def window_minima(hashes: np.ndarray, step: int, width: int) -> np.ndarray:
    """Minimum of every window (rows: hash functions); windows start every ``step`` and the last may be short."""
    if step > 1:
        hashes = np.minimum.reduceat(hashes, np.arange(0, hashes.shape[1], step), axis=1)
    blocks = min(width // step, hashes.shape[1])
    done = 1
    while done * 2 <= blocks:
        hashes = np.minimum(hashes[:, :-done], hashes[:, done:])
        done *= 2
    if done < blocks:
        hashes = np.minimum(hashes[:, : done - blocks], hashes[:, blocks - done :])
    return hashes


def hits(words: np.ndarray, groups: list[Group | Short], seeds: np.ndarray) -> list[tuple[str, int, int, float]]:
    """(template, first word, end word, containment) in one document's words."""
    found = []
    cut: dict[int, np.ndarray] = {}
    for group in groups:
        if isinstance(group, Short):
            found += group.hits(words)
            continue
        if group.words not in cut:
            cut[group.words] = kernels.shingles(words, group.words)
        shingles = cut[group.words]
        # Windows that share no shingle with a template have none of its minima.
        if not len(shingles) or not np.isin(shingles, group.known).any():
            continue
        lowest = window_minima(shingles[None, :] * seeds[:, None], group.step, group.width)
        for (name, wanted, phrases), theirs in zip(group.templates, group.lowest):
            windows = np.flatnonzero((lowest == theirs).any(axis=0))
            best: tuple[float, int, int] | None = None
            last = -1
            for window in windows.tolist():
                start = window * group.step
                part = shingles[start : start + group.width]
                inside = np.flatnonzero(np.isin(part, wanted))
                share = len(np.unique(part[inside])) / len(wanted)
                if share < CONTAINED - 1e-9:
                    continue
                first, end = start + int(inside[0]), start + int(inside[-1]) + group.words
                if not all(len(places(words[first:end], phrase)) for phrase in phrases):
                    continue
                if best and first < last:
                    if share > best[0]:
                        best = (share, first, end)
                else:
                    if best:
                        found.append((name, best[1], best[2], best[0]))
                    best = (share, first, end)
                last = best[2]
            if best:
                found.append((name, best[1], best[2], best[0]))
    return found


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """One row per licence passage found: columns ``HITS``; start and end are byte places in the text."""
    templates = TEMPLATES if templates is None else templates

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = kernels.stream(BANDS, 41) | np.uint64(1)
        groups = grouped(templates, seeds)
        for batch in batches:
            data, offsets = kernels.utf8(batch["text"])
            ids, out = batch["doc_id"].to_pylist(), []
            for first, end in kernels.runs(offsets):
                part = data[offsets[first] : offsets[end]]
                bounds = offsets[first : end + 1] - offsets[first]
                hashes, starts, ends, at = kernels.words(part, bounds)
                for number in range(end - first):
                    a, b = at[number], at[number + 1]
                    for name, word, after, share in hits(hashes[a:b], groups, seeds):
                        low, high = int(starts[a + word]), int(ends[a + after - 1])
                        passage = part[low:high].tobytes().decode("utf-8", "replace")
                        base = int(bounds[number])
                        out.append((ids[first + number], name, low - base, high - base, share, passage))
            if out:
                types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), types)],
                    names=["doc_id", "license", "start", "end", "containment", "passage"])

    return docs.select("doc_id", "text").mapInArrow(work, HITS)


def op9_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan(frames.table(spark, sf_dir, "documents"))
