"""License scans by patience alignment.

A text is aligned to a license template: words that occur once in both are anchors,
the longest increasing subsequence of their positions is kept, and the gaps between
kept anchors are aligned the same way, where other words may now be unique. Where a
gap has no anchor, equal words at its two rims are taken. The share of a template's
words that is aligned is its coverage.

Coverage alone does not tell licenses apart that differ by one word. So the words that
name a license or its version must all be aligned, and what stands between the aligned
words must not name another one. Of the templates that match at one place, the one with
the most aligned words is reported.

Whole license texts are templates as well (`license_texts`). Such a long template is
aligned where word runs that occur once in it say that a copy of it may be.

After a tag of SPDX stands an expression, which is read by its grammar: a row comes out
for each license in it, with the whole expression beside it.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import product
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paywarden.llm.decontaminate import split_words
from paywarden.llm.storage import schema_of, unused
from paywarden.llm.words import text_slices

COVERAGE = 0.8  # of a template's words, from which a license is reported
LONG = 60  # words, from which a template is looked for by its rare word runs
RUN = 4  # words of such a run
TITLE, TITLE_WORDS = 40, 12  # words of a text in which its title stands, and of a template's title
SLACK = 3  # a match may be stretched over so many times the template's words

# Notices by which a text names its license, word by word as their authors ask for.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
    "compliance with the License. You may obtain a copy of the License at",
    "BSD-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "MIT": "Released under the MIT License.",
    "MIT-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}

GNU = "the GNU {} License"
FREE = "This {} is free software; you can redistribute it and/or modify it under the terms of " + GNU + " as published by the Free Software Foundation"
FAMILY = {"GPL": "General Public", "LGPL": "Lesser General Public", "AGPL": "Affero General Public"}
TEMPLATES |= {
    "Apache-1.1": "Licensed under the Apache License, Version 1.1.",
    "BSD": "Released under the BSD License.",
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "CC0-1.0": "This work is released under CC0 1.0 Universal.",
    "CC0-1.0-notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "EPL-1.0-notice": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 "
    "which accompanies this distribution",
    "EPL-2.0-notice": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
    "which is available at",
    "GPL-2.0-only-notice": "under the terms of the GNU General Public License version 2 as published by the Free Software Foundation",
    "ISC-name": "Released under the ISC License.",
    "LGPL-2.0": f"This work is licensed under {GNU.format('Library General Public')}, version 2.",
    "LGPL-2.0-notice": FREE.format("library", "Library General Public") + "; either version 2 of the License, or",
    "LGPL-notice": FREE.format("library", "Lesser General Public"),
    "AGPL-notice": FREE.format("program", "Affero General Public"),
    "MPL-1.1-notice": "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use "
    "this file except in compliance with the License",
    "Unlicense": "Released under the Unlicense.",
    "Unlicense-notice": "This is free and unencumbered software released into the public domain.",
}
for _family, _version in [("GPL", "2.0"), ("GPL", "3.0"), ("LGPL", "2.1"), ("LGPL", "3.0"), ("AGPL", "3.0")]:
    _id, _short = f"{_family}-{_version}", _version.removesuffix(".0")
    TEMPLATES.setdefault(_id, f"This work is licensed under {GNU.format(FAMILY[_family])}, version {_short}.")
    _kind = "library" if _family == "LGPL" else "program"
    TEMPLATES[f"{_id}-notice"] = FREE.format(_kind, FAMILY[_family]) + f"; either version {_short} of the License, or"
    TEMPLATES[f"{_id}-name"] = f"Licensed under the {_family}v{_short}."
for _kind, (_version, _place) in product(
    ("", "-NonCommercial", "-ShareAlike", "-NoDerivatives", "-NonCommercial-ShareAlike", "-NonCommercial-NoDerivatives"),
    (("4.0", "International"), ("3.0", "Unported"), ("2.5", "Generic"), ("2.0", "Generic")),
):
    _short = "BY" + _kind.replace("NonCommercial", "NC").replace("ShareAlike", "SA").replace("NoDerivatives", "ND")
    if _version != "4.0":
        _kind = _kind.replace("NoDerivatives", "NoDerivs")
    _id = f"CC-{_short}-{_version}"
    _long = f"This work is licensed under a Creative Commons Attribution{_kind} {_version} {_place} License."
    TEMPLATES[_id if TEMPLATES.get(_id) == _long else f"{_id}-notice"] = _long
    TEMPLATES[_id if _id == "CC-BY-NC-4.0" else f"{_id}-name"] = f"Licensed under CC {_short} {_version}."
for _id in ("MIT", "BSD", "ISC"):
    TEMPLATES |= {f"{_id}-licensed": f"is {_id} licensed", f"{_id}-under": f"licensed under {_id}"}
TEMPLATES |= {
    "Apache-2.0-licensed": "is Apache 2.0 licensed",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "EUPL-1.1": "Licensed under the EUPL, Version 1.1.",
    "EUPL-1.2": "Licensed under the EUPL, Version 1.2.",
}
TAG = "SPDX"
TEMPLATES[TAG] = "SPDX-License-Identifier:"

# Ids of licenses and exceptions without a number after a hyphen.
PLAIN_IDS = (
    "MIT MIT-0 MIT-CMU ISC 0BSD Zlib Unlicense X11 WTFPL NCSA curl libpng OpenSSL Ruby Beerware PostgreSQL Vim TCL Intel IJG ICU "
    "JSON NTP FTL HPND blessing Artistic-1.0-Perl BSD-1-Clause BSD-2-Clause BSD-2-Clause-Patent BSD-3-Clause BSD-3-Clause-Clear "
    "BSD-4-Clause BSD-4-Clause-UC Linux-syscall-note LLVM-exception Classpath-exception-2.0 Autoconf-exception-generic "
    "OpenSSL-exception Universal-FOSS-exception-1.0 FLTK-exception"
).split()
_IDS = {x.lower(): x for x in PLAIN_IDS}
_VERSIONED_ID = re.compile(r"[A-Za-z][A-Za-z0-9]*(?:-[A-Za-z]+)*-\d+(?:\.\d+)*(?:-[A-Za-z][A-Za-z0-9]*)*")
_REFERENCE = re.compile(r"(?:DocumentRef-[A-Za-z0-9.-]+:)?LicenseRef-[A-Za-z0-9.-]+")
_TOKEN = re.compile(r"[ \t]*([()]|[A-Za-z0-9.:-]+\+?)")

# Words of which one decides between license texts that are otherwise alike: must be aligned, must not stand in a gap.
TELLING = {
    "0BSD-text": ((), ("appear",)),
    "BSD-2-Clause-text": ((), ("endorse", "acknowledgement")),
    "BSD-3-Clause-text": (("endorse",), ("acknowledgement",)),
    "BSD-4-Clause-text": (("endorse", "acknowledgement"), ()),
    "CC0-1.0-notice": ((), ("patent",)),
    "GPL-3.0-text": ((), ("affero",)),
    "ISC-text": (("appear",), ("documentation",)),
    "MIT-0-text": ((), ("included",)),
    "MIT-text": (("included",), ("advertising",)),
}


def whole_texts() -> dict[str, str]:
    """The license texts that come with this package, by the name of their template."""
    return {f"{p.stem}-text": p.read_text("utf-8") for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}


# Words that name a license or one of its kinds; numbers do so as versions.
NAMES = frozenset(
    "mit x11 bsd isc apache gnu gpl gplv2 gplv3 lgpl lgplv2 lgplv3 agpl agplv3 lesser affero mozilla mpl eclipse epl creative commons "
    "cc cc0 0bsd nc noncommercial noncommercially sa sharealike nd noderivatives noderivs unlicense zlib boost wtfpl artistic cddl eupl gfdl".split()
)
DIGITS = frozenset("0123456789")
VERSIONED = NAMES | DIGITS | {"version", "v", "license", "attribution"}  # a number after one of these is a version
# Common words that decide only among the licenses of one family.
KINDS = {
    "gnu": frozenset({"general", "public", "library", "documentation"}),
    "cc": frozenset({"by", "commercial", "share", "alike", "derivatives", "derivs"}),
    "creative": frozenset({"attribution", "commercial", "share", "alike", "derivatives", "derivs"}),
}


def longest_increasing(values: list[int]) -> list[int]:
    """Indexes of a longest increasing subsequence, by patience sorting."""
    piles: list[int] = []  # the value on top of each pile
    tops: list[int] = []  # and its index
    below = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(piles, v)
        if k == len(piles):
            piles.append(v)
            tops.append(i)
        else:
            piles[k], tops[k] = v, i
        below[i] = tops[k - 1] if k else -1
    out, i = [], tops[-1] if tops else -1
    while i >= 0:
        out.append(i)
        i = below[i]
    return out[::-1]


def patience(text: list[int], template: list[int]) -> list[tuple[int, int]]:
    """Pairs of positions (in the text, in the template) of aligned equal words, in order."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(text), 0, len(template))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a >= b or c >= d:
            continue
        in_text, in_template = Counter(text[a:b]), Counter(template[c:d])
        where = {w: k for k, w in enumerate(text[a:b], a) if in_text[w] == 1 and in_template[w] == 1}
        anchors = [(where[w], k) for k, w in enumerate(template[c:d], c) if w in where]
        if not anchors:
            continue
        kept = [anchors[i] for i in longest_increasing([x for x, _ in anchors])]
        out += kept
        rims = [(a - 1, c - 1), *kept, (b, d)]
        todo += [(p + 1, r, q + 1, s) for (p, q), (r, s) in zip(rims, rims[1:])]
    return sorted(out)


def license_id(word: str) -> str | None:
    """The id that a word of an expression stands for, in its usual spelling; None if it is none."""
    word = word.rstrip(".")  # the end of a sentence
    if _REFERENCE.fullmatch(word):
        return word
    return _IDS.get(word.lower(), word if _VERSIONED_ID.fullmatch(word) else None)


def expression(line: str) -> tuple[str, list[tuple[str, int, int]]]:
    """The longest license expression that `line` begins with, and its licenses with their places.

    `OR`, `AND`, `WITH` in any case, `+` and brackets are read. `id WITH exception` and `id+`
    are one license. Without a valid expression both results are empty.
    """
    tokens: list[tuple[str, int, int]] = []
    at = 0
    while m := _TOKEN.match(line, at):
        tokens.append((m[1], m.start(1), m.end(1)))
        at = m.end()
    shown: list[str] = []
    licenses: list[tuple[str, int, int]] = []
    whole = 0, 0  # how much of both lists is an expression
    depth, operand, k = 0, True, 0  # operand: a license or bracket must come next
    while k < len(tokens):
        word, start, end = tokens[k]
        operator = word.upper() if word.upper() in ("AND", "OR") else None
        if operand and word == "(":
            depth += 1
            shown.append("(")
        elif operand:
            more = word.endswith("+")
            known = license_id(word.removesuffix("+"))
            if known is None:
                break
            name = known + "+" * more
            end = start + len(word.rstrip(".")) if not more else end
            exception = license_id(tokens[k + 2][0]) if k + 2 < len(tokens) and tokens[k + 1][0].upper() == "WITH" else None
            if exception:
                name, end, k = f"{name} WITH {exception}", tokens[k + 2][1] + len(tokens[k + 2][0].rstrip(".")), k + 2
            licenses.append((name, start, end))
            shown.append(name)
            operand = False
        elif word == ")" and depth:
            depth -= 1
            shown.append(")")
        elif operator:
            shown.append(f" {operator} ")
            operand = True
        else:
            break
        if not operand and not depth:
            whole = len(shown), len(licenses)
        k += 1
    return "".join(shown[: whole[0]]), licenses[: whole[1]]


class Templates:
    """The templates as numbers of words, with the words that decide."""

    def __init__(self, texts: dict[str, str]):
        self.numbers: dict[bytes, int] = {}
        number = lambda words: {self.numbers.setdefault(w.encode(), len(self.numbers) + 1) for w in sorted(words)}
        names, self.digits, self.versioned = number(NAMES), number(DIGITS), number(VERSIONED)
        kinds = {min(number({first})): number(words) for first, words in KINDS.items()}
        zero = self.numbers[b"0"]
        self.words = {
            name: [self.numbers.setdefault(w, len(self.numbers) + 1) for w in split_words(text.encode("utf-8"))]
            for name, text in sorted(texts.items())
        }
        extra = {name: [number(words) for words in TELLING.get(name, ((), ()))] for name in self.words}
        counts = [np.bincount(words, minlength=len(self.numbers) + 1) for words in self.words.values()]
        self.counts = np.stack(counts, axis=1).astype(np.int32) if counts else np.zeros((len(self.numbers) + 1, 0), np.int32)
        self.required: dict[str, set[int]] = {}  # positions in the template
        self.foreign: dict[str, set[int]] = {}  # words
        self.titles: dict[str, set[int]] = {}  # positions of the version in the title
        self.runs: dict[str, dict[tuple[int, ...], int]] = {}  # of long templates: word runs that occur once, and where
        numerals = {n for w, n in self.numbers.items() if w.isdigit()}
        self.numbered = {name for name, words in self.words.items() if numerals & set(words)}
        for name, words in self.words.items():
            needed, other = extra[name]
            if len(words) > LONG:
                telling, numeral = needed, set()
                runs = list(zip(*(words[k:] for k in range(RUN))))
                often = Counter(runs)
                self.runs[name] = {run: k for k, run in enumerate(runs) if often[run] == 1}
            else:
                telling, numeral = names.union(needed, *(kinds[w] for w in set(words) & set(kinds))), numerals
            self.foreign[name] = (telling - set(words) | other) - needed
            # Version 2 is 2.0: a nought after a number may be missing.
            plain = {k for k in range(1, len(words)) if words[k] == zero and words[k - 1] in numerals}
            self.required[name] = {k for k, w in enumerate(words) if w in telling or w in numeral} - plain
            self.titles[name] = {k for k in range(1, min(TITLE_WORDS, len(words))) if words[k] in self.digits and words[k - 1] in self.versioned} - plain

    def holds(self, name: str, ids: list[int], pairs: list[tuple[int, int]]) -> bool:
        """Whether all deciding words are among the pairs, and no words of other licenses in the gaps."""
        if not self.required[name] <= {k for _, k in pairs}:
            return False
        aligned, foreign = {x for x, _ in pairs}, self.foreign[name]
        first, last = pairs[0][0], pairs[-1][0]
        other_version = lambda x: x not in aligned and ids[x] in self.digits and ids[x - 1] in self.versioned
        if any(x not in aligned and ids[x] in foreign for x in range(first + 1, last)):
            return False
        if name in self.runs:  # a whole text may come without its title, but not with the title of another version
            places = {k for _, k in pairs}
            if self.titles[name] <= places:
                return True
            return 0 not in places and not any(map(other_version, range(max(1, first - TITLE), min(first + TITLE, last))))
        if name in self.numbered and any(map(other_version, range(first + 1, last))):
            return False
        # A template that ends in 2.0, of which the 2 is the last aligned word, and a text with 2.1.
        cut = pairs[-1][1] < len(self.words[name]) - 1 and ids[last] in self.digits
        return not (cut and last + 1 < len(ids) and ids[last + 1] in self.digits)


def copies(ids: list[int], runs: dict[tuple[int, ...], int], size: int) -> list[tuple[int, int]]:
    """Spans of a text that may each hold one copy of a long template, from where its word runs stand."""
    hits = [(t, runs[run]) for t, run in enumerate(zip(*(ids[k:] for k in range(RUN)))) if run in runs]
    parts: list[list[tuple[int, int]]] = []
    far = 0
    for t, q in hits:
        if not parts or q < far - size // 2 or t - parts[-1][0][0] > SLACK * size:
            parts.append([])
            far = 0
        parts[-1].append((t, q))
        far = max(far, q)
    out: list[tuple[int, int]] = []
    for k, part in enumerate(parts):
        (t, q), (u, r) = part[0], part[-1]
        start = max(t - SLACK * q, parts[k - 1][-1][0] + RUN if k else 0, 0)
        end = min(u + SLACK * (size - r), len(ids))
        if k + 1 < len(parts):
            v, w = parts[k + 1][0]
            end = min(end, max(u + RUN, v - w))
        out.append((start, end))
    return out


def regions(ids: np.ndarray, need: int, reach: int) -> list[tuple[int, int]]:
    """Spans of word positions outside of which no `reach` words hold `need` words of the template.

    `ids` are the positions of the template's words in the text, in order.
    """
    if len(ids) < need:
        return []
    full = np.flatnonzero(ids[need - 1 :] - ids[: len(ids) - need + 1] < reach)
    out: list[tuple[int, int]] = []
    for k in full.tolist():
        s, e = int(ids[k]), int(ids[k + need - 1]) + 1
        if out and s <= out[-1][1]:
            out[-1] = out[-1][0], e
        else:
            out.append((s, e))
    return out


def promising(ids: np.ndarray, mine: np.ndarray, template: list[int], required: set[int], need: int, reach: int) -> np.ndarray:
    """For each position in `mine`, whether the next `reach` words can hold `need` words of the template and all required ones."""
    held = np.zeros(len(mine), np.int64)
    whole = np.ones(len(mine), bool)
    here = ids[mine]
    must = Counter(template[k] for k in required)
    for word, most in Counter(template).items():
        at = mine[here == word]
        count = np.searchsorted(at, mine + reach) - np.searchsorted(at, mine)
        held += np.minimum(count, most)
        whole &= count >= must[word]
    return whole & (held >= need)


Found = tuple[str, float, int, int, int, str | None]
TIGHT = 3  # words, up to which a template must stand without other words in it


def tagged(text: bytes, found: list[Found]) -> list[Found]:
    """The licenses of the expressions after the tags in `found`, each with its expression."""
    if not found:
        return []
    marks = [m.end() for m in re.finditer(rb"(?<![0-9A-Za-z\x80-\xff])spdx-license-identifier[ \t]*:", text.lower())]
    ends = {}  # the number of words up to each mark
    words = at = 0
    for m in marks:
        words, at = words + len(split_words(text[at:m])), m
        ends[words] = m
    out = []
    for _, _, _, last, *_ in found:
        if last not in ends:
            continue
        stop = text.find(b"\n", ends[last])
        line = text[ends[last] : stop if stop >= 0 else len(text)].decode("utf-8", "replace")
        whole, licenses = expression(line)
        for name, start, end in licenses:
            a = last + len(split_words(line[:start].encode()))
            b = last + len(split_words(line[:end].encode()))
            out.append((f"{name}-tag", 1.0, a, b, b - a, whole))
    return out


def best_per_place(found: list[Found]) -> list[Found]:
    """Of matches that overlap, the one with the most aligned words, then the highest coverage."""
    kept: list[Found] = []  # in the order of the text
    for x in sorted(found, key=lambda x: (-x[4], -x[1], x[3] - x[2], x[0], x[2])):
        at = bisect_left(kept, x[2], key=lambda y: y[2])
        if (at == 0 or kept[at - 1][3] <= x[2]) and (at == len(kept) or x[3] <= kept[at][2]):
            kept.insert(at, x)
    return kept


def scan_text(text: bytes, templates: Templates, least: float = COVERAGE) -> list[Found]:
    """(template, coverage, first word, end word, aligned words, expression) of each place where a template is covered.

    The expression is that of a tag, else None; a tag gives each license in it as `id-tag`.

    A text may hold a notice more than once, and any other words around and between:
    only stretches that hold enough of a template's words in few enough words are
    aligned, each by itself.
    """
    words = split_words(text)
    ids = np.fromiter(map(lambda w: templates.numbers.get(w, 0), words), np.int64, len(words))
    known = np.flatnonzero(ids)
    out: list[Found] = []
    if not len(known):
        return out
    present, often = np.unique(ids[known], return_counts=True)
    shared = np.minimum(often[:, None], templates.counts[present]).sum(axis=0)
    taken = np.zeros(len(ids) + 1, bool)  # by whole texts: what they quote is not reported by itself
    longest = sorted(zip(templates.words.items(), shared.tolist()), key=lambda x: (-(x[0][0] in templates.runs), x[0][0]))
    for (name, template), most in longest:
        need = max(1, int(np.ceil(least * len(template) - 1e-9)))
        if not template or most < need:
            continue
        if name in templates.runs:
            numbers = ids.tolist()

            def copy_in(s: int, e: int) -> list[Found]:
                pairs = patience(numbers[s:e], template)
                back = min(s, TITLE)  # the title may stand before
                if len(pairs) < need or not templates.holds(name, numbers[s - back : e + 1], [(x + back, k) for x, k in pairs]):
                    return []
                return [(name, len(pairs) / len(template), s + pairs[0][0], s + pairs[-1][0] + 1, len(pairs), None)]

            spans = copies(numbers, templates.runs[name], len(template))
            each = [copy_in(s, e) for s, e in spans]
            for k, found in enumerate(each):
                if k and not found and not each[k - 1]:  # a repeated run in the middle of a copy must not cut it in two
                    found = copy_in(spans[k - 1][0], spans[k][1])
                out += found
                for _, _, first, last, *_ in found:
                    taken[first:last] = True
            continue
        mine = known[np.isin(ids[known], template) & ~taken[known]]
        reach = SLACK * len(template)

        def aligned_from(p: int, e: int) -> list[tuple[int, int]]:
            pairs: list[tuple[int, int]] = []
            # The wide window is for stretched notices; the narrow one for repeated ones, whose words are not unique in the wide.
            for end in (min(e, p + len(template)), min(e, p + reach)):
                trial = patience(ids[p:end].tolist(), template)
                if len(template) <= TIGHT and trial and trial[-1][0] - trial[0][0] >= len(trial):
                    continue
                if len(trial) >= need and len(trial) > len(pairs) and templates.holds(name, ids[p : end + 1].tolist(), trial):
                    pairs = trial
                if len(pairs) == len(template):
                    break
            return pairs

        spans = regions(mine, need, reach)
        if spans:
            starts = mine[promising(ids, mine, template, templates.required[name], need, reach)]
        for s, e in spans:
            at = s
            for p in starts[np.searchsorted(starts, s) : np.searchsorted(starts, e)].tolist():  # one notice after the other, from each word it may begin with
                if p < at:
                    continue
                pairs = aligned_from(p, e)
                if pairs:
                    # Words of the template may stand before the notice, and the narrow window then ends too early.
                    again = aligned_from(p + pairs[0][0], e)
                    p, pairs = (p + pairs[0][0], again) if len(again) > len(pairs) else (p, pairs)
                    first, last = p + pairs[0][0], p + pairs[-1][0] + 1
                    out.append((name, len(pairs) / len(template), first, last, len(pairs), None))
                    at = last
    tags = tagged(text, [x for x in out if x[0] == TAG])
    return sorted(best_per_place([x for x in out if x[0] != TAG]) + tags, key=lambda x: (x[2], x[3]))


def scan(docs: DataFrame, texts: dict[str, str] | None = None, least: float = COVERAGE, kept: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `kept`, then license, coverage, first_word, end_word, n_aligned, expression: a row for each place found.

    A place is reported once, by its best template, and only if all words that name the
    license are there and no words of another one among them. After a tag of SPDX each
    license of its expression is a row, named `id-tag`, with the whole expression; other
    rows have none. A tag without a valid expression gives no row.

    Null and empty texts hold no license; a template without words is never found;
    repeated rows come out repeated; an empty table gives no rows; other columns are
    ignored. `texts` are a bounded list of notices and license texts that every worker
    gets; without it `TEMPLATES` and the texts of this package are taken.
    """
    fields = [f for f in docs.schema.fields if f.name in kept]
    shared = docs.sparkSession.sparkContext.broadcast(Templates(TEMPLATES | whole_texts() if texts is None else texts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = shared.value
        for batch in batches:
            found: list[tuple[int, tuple]] = []
            for first, data, offsets in text_slices(batch.column(batch.num_columns - 1)):
                for k, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
                    found += [(first + k, x) for x in scan_text(data[a:b].tobytes(), templates, least)]
            taken = pa.RecordBatch.from_arrays(batch.columns[:-1], names=batch.schema.names[:-1]).take(pa.array([i for i, _ in found], pa.int64()))
            kinds = [pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, *(pa.array([x[c] for _, x in found], kind) for c, kind in enumerate(kinds))],
                names=[*taken.schema.names, "license", "coverage", "first_word", "end_word", "n_aligned", "expression"],
            )

    schema = schema_of(fields, "license string, coverage double, first_word long, end_word long, n_aligned long, expression string")
    source = docs.select(*(F.col(f"`{f.name}`") for f in fields), docs["text"].cast("string").alias(unused(docs, "_text")))
    return source.mapInArrow(run, schema)
