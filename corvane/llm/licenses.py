"""License detection by ordered signature rules.

A rule is a regular expression with a label, a priority and a confidence, and
stands behind keywords: it is tried only on texts that hold one of them, so a text
without any costs a few substring searches. Detections are ordered by priority and
length; one that lies within the interval of a kept one of at least its priority is
suppressed. So "gnu general public license version 2" gives ``gpl-2.0`` and not
``gpl`` too.

Signatures are written once per family and form; versions are filled in by rule.
The base phrases are found apart from the rules, word by word, and always stay.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corvane.llm.bpe import blocks

# Base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: A gap inside a name, and a version mark before a number.
GAP, VERSION = r"(?:[\s,\-_]{1,4})", r"[\s,(]{0,3}(?:v|ver\.?|version)?[\s.]{0,2}"

#: label, keywords, full name, short form (or None), versions
FAMILIES = [
    ("gpl", "general public|gpl", r"(?:gnu )?general public licen[sc]e", r"gnu gpl|gpl", "1.0 2.0 3.0"),
    ("lgpl", "general public|lgpl", r"(?:gnu )?(?:lesser|library) general public licen[sc]e", r"lgpl", "2.0 2.1 3.0"),
    ("agpl", "affero|agpl", r"(?:gnu )?affero general public licen[sc]e", r"agpl", "1.0 3.0"),
    ("gfdl", "free documentation|gfdl", r"(?:gnu )?free documentation licen[sc]e", r"gfdl", "1.1 1.2 1.3"),
    ("apache", "apache", r"apache(?: software)? licen[sc]e", r"apache", "1.0 1.1 2.0"),
    ("mit", "mit", r"(?:the )?mit licen[sc]e", r"mit", ""),
    ("mit-0", "mit", r"mit no attribution(?: licen[sc]e)?", r"mit-0", ""),
    ("bsd", "bsd", r"(?:the )?(?:new |modified |simplified )?bsd(?: style)? licen[sc]e", r"bsd", ""),
    ("bsd-2-clause", "bsd|clause", r"(?:2|two)[ -]clause bsd(?: licen[sc]e)?", r"bsd[ -]2[ -]clause", ""),
    ("bsd-3-clause", "bsd|clause", r"(?:3|three)[ -]clause bsd(?: licen[sc]e)?", r"bsd[ -]3[ -]clause", ""),
    ("bsd-4-clause", "bsd|clause", r"(?:4|four)[ -]clause bsd(?: licen[sc]e)?", r"bsd[ -]4[ -]clause", ""),
    ("0bsd", "bsd|clause", r"(?:0|zero)[ -]clause bsd(?: licen[sc]e)?", r"0bsd", ""),
    ("isc", "isc", r"isc licen[sc]e", None, ""),
    ("mpl", "mozilla|mpl", r"mozilla public licen[sc]e", r"mpl", "1.0 1.1 2.0"),
    ("epl", "eclipse|epl", r"eclipse public licen[sc]e", r"epl", "1.0 2.0"),
    ("cpl", "common public|cpl", r"common public licen[sc]e", r"cpl", "1.0"),
    ("cddl", "common development|cddl", r"common development and distribution licen[sc]e", r"cddl", "1.0 1.1"),
    ("eupl", "european union|eupl", r"european union public licen[sc]e", r"eupl", "1.0 1.1 1.2"),
    ("artistic", "artistic", r"artistic licen[sc]e", None, "1.0 2.0"),
    ("zlib", "zlib", r"zlib(?:/libpng)? licen[sc]e", None, ""),
    ("bsl", "boost", r"boost software licen[sc]e", None, "1.0"),
    ("unlicense", "unlicense", r"the unlicense|unlicense\.org", None, ""),
    ("wtfpl", "wtfpl|what the f", r"do what the f\S{1,6} you want to public licen[sc]e", r"wtfpl", "1.0 2.0"),
    ("cc0", "cc0|creative commons zero", r"creative commons zero|cc0 public domain", r"cc0", "1.0"),
    ("cc-by", "cc|creative commons", r"creative commons attribution", r"cc[ -]by(?![ -](?:sa|nc|nd))", "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-sa", "cc|creative commons", r"creative commons attribution[ -]share[ -]?alike", r"cc[ -]by[ -]sa", "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-nd", "cc|creative commons", r"creative commons attribution[ -]no[ -]?deriv(?:ative)?s?", r"cc[ -]by[ -]nd", "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-nc", "cc|creative commons", r"creative commons attribution[ -]non[ -]?commercial", r"cc[ -]by[ -]nc(?![ -](?:sa|nd))", "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-nc-sa", "cc|creative commons", r"creative commons attribution[ -]non[ -]?commercial[ -]share[ -]?alike", r"cc[ -]by[ -]nc[ -]sa", "1.0 2.0 2.5 3.0 4.0"),
    ("cc-by-nc-nd", "cc|creative commons", r"creative commons attribution[ -]non[ -]?commercial[ -]no[ -]?deriv(?:ative)?s?", r"cc[ -]by[ -]nc[ -]nd", "1.0 2.0 2.5 3.0 4.0"),
    ("ofl", "open font|ofl", r"(?:sil )?open font licen[sc]e", r"ofl", "1.0 1.1"),
    ("psf", "python software|psf", r"python software foundation licen[sc]e", r"psf", "2.0"),
    ("php", "php", r"php licen[sc]e", None, "3.0 3.01"),
    ("ruby", "ruby", r"ruby licen[sc]e", None, ""),
    ("postgresql", "postgresql", r"postgresql licen[sc]e", None, ""),
    ("ncsa", "ncsa|illinois", r"university of illinois/ncsa open source licen[sc]e|ncsa licen[sc]e", None, ""),
    ("x11", "x11", r"x11 licen[sc]e", None, ""),
    ("openssl", "openssl", r"openssl licen[sc]e", None, ""),
    ("vim", "vim", r"vim licen[sc]e", None, ""),
    ("curl", "curl", r"curl licen[sc]e", None, ""),
    ("apsl", "apple public|apsl", r"apple public source licen[sc]e", r"apsl", "1.0 1.1 1.2 2.0"),
    ("afl", "academic free|afl", r"academic free licen[sc]e", r"afl", "1.1 1.2 2.0 2.1 3.0"),
    ("osl", "open software|osl", r"open software licen[sc]e", r"osl", "1.0 1.1 2.0 2.1 3.0"),
    ("cecill", "cecill", r"cecill(?:-[abc])? (?:free software )?licen[sc]e", r"cecill", "1.0 1.1 2.0 2.1"),
    ("odbl", "open database|odbl|odc", r"open (?:data commons )?(?:open )?database licen[sc]e", r"odbl|odc-odbl", "1.0"),
    ("odc-by", "odc", r"open data commons attribution licen[sc]e", r"odc[ -]by", "1.0"),
    ("pddl", "public domain ded|pddl", r"public domain dedication and licen[sc]e", r"pddl", "1.0"),
    ("mulan-psl", "mulan", r"mulan permissive software licen[sc]e", r"mulan ?psl", "1.0 2.0"),
    ("sspl", "server side|sspl", r"server side public licen[sc]e", r"sspl", "1.0"),
    ("busl", "business source|busl", r"business source licen[sc]e", r"busl", "1.0 1.1"),
    ("elastic", "elastic", r"elastic licen[sc]e", None, "1.0 2.0"),
    ("upl", "universal permissive|upl", r"universal permissive licen[sc]e", r"upl", "1.0"),
    ("qpl", "q public|qpl", r"q public licen[sc]e", r"qpl", "1.0"),
    ("ms-pl", "microsoft|ms-pl", r"microsoft public licen[sc]e", r"ms-pl", ""),
    ("ms-rl", "microsoft|ms-rl", r"microsoft reciprocal licen[sc]e", r"ms-rl", ""),
    ("blueoak", "blue oak", r"blue oak model licen[sc]e", None, "1.0"),
    ("json", "json", r"json licen[sc]e", None, ""),
    ("beerware", "beer", r"beer-?ware licen[sc]e", None, ""),
    ("llama", "llama", r"llama (?:\d(?:\.\d)? )?community licen[sc]e", None, ""),
    ("rail", "rail", r"(?:open)?rail(?:-m|\+\+-m)? licen[sc]e", None, ""),
]

#: label, keywords, sentence of a license's own text or notice
SENTENCES = [
    ("mit", "hereby granted", r"permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("isc", "permission to use", r"permission to use, copy, modify, and(?:/or)? distribute this software for any purpose"),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms"),
    ("gpl", "free software", r"this (?:program|library) is free software[;:,] you can redistribute it"),
    ("gpl", "copyleft", r"everyone is permitted to copy and distribute verbatim copies of this licen[sc]e"),
    ("apache-2.0", "apache.org", r"www\.apache\.org/licenses/license-2\.0"),
    ("mpl-2.0", "mozilla.org", r"mozilla\.org/mpl/2\.0"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("zlib", "as-is", r"this software is provided 'as-is', without any express or implied warranty"),
    ("cc", "creativecommons", r"creativecommons\.org/licenses/[a-z\-]{2,8}"),
    ("cc0", "creativecommons", r"creativecommons\.org/publicdomain/zero"),
    ("gpl", "gnu.org", r"gnu\.org/licenses/(?:old-licenses/)?gpl"),
    ("bsl-1.0", "boost.org", r"boost\.org/license_1_0"),
    ("public-domain", "public domain", r"(?:released|placed|dedicated) (?:in)?to the public domain"),
    ("proprietary", "rights reserved", r"all rights reserved"),
    ("proprietary", "confidential", r"proprietary and confidential"),
]


class Rule(NamedTuple):
    label: str
    keywords: tuple[bytes, ...]
    pattern: re.Pattern
    priority: int
    confidence: float


def _rule(label: str, keywords: str, pattern: str, priority: int, confidence: float) -> Rule:
    whole = rf"(?<![0-9a-z\x80-\xff])(?:{pattern})(?![0-9a-z\x80-\xff])"
    return Rule(label, tuple(k.encode("latin-1") for k in keywords.split("|")), re.compile(whole.encode("latin-1")), priority, confidence)


def _number(version: str) -> str:
    """A version as people write it: a final .0 may be missing."""
    return re.escape(version.removesuffix(".0")) + (r"(?:\.0){0,2}(?!\.?\d)" if version.endswith(".0") else r"(?!\.?\d)")


@lru_cache(1)
def rules() -> tuple[Rule, ...]:
    out = []
    for label, keywords, name, short, versions in FAMILIES:
        named = name.replace("[ -]", " ").replace(" ", GAP)
        out.append(_rule(label, keywords, rf"(?:{named})", 30, 0.8))
        out.append(_rule(label, keywords, rf"(?:licensed|released|distributed|available){GAP}under{GAP}(?:the{GAP})?(?:terms of the{GAP})?(?:{named})", 40, 0.9))
        if short:
            out.append(_rule(label, keywords, rf"(?:{short}){GAP}licen[sc]e[ds]?|licensed{GAP}under{GAP}(?:the{GAP})?(?:{short})", 20, 0.6))
        out.append(_rule(label, "spdx", rf"spdx-license-identifier:\s{{0,3}}{re.escape(label)}", 80, 0.95))
        for version in versions.split():
            tail = r"(?:\+| or later| or newer|-only|-or-later)?"
            full = f"{label}-{version}"
            out.append(_rule(full, keywords, rf"(?:{named}){VERSION}{_number(version)}{tail}", 60, 0.95))
            out.append(_rule(full, "spdx", rf"spdx-license-identifier:\s{{0,3}}{re.escape(full)}{tail}", 90, 1.0))
            if short:
                out.append(_rule(full, keywords, rf"(?:{short})[\s\-]{{0,2}}(?:v|version)?[\s.]{{0,2}}{_number(version)}{tail}", 50, 0.85))
    out += [_rule(label, keywords, text.replace(" ", r"\s{1,4}"), 70, 0.9) for label, keywords, text in SENTENCES]
    return tuple(out)


_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_NOT_WORD = rb"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"
_BASE = [
    (label, phrase.split()[0].encode(), re.compile(rb"(?<![0-9a-z\x80-\xff])" + _NOT_WORD.join(w.encode() for w in phrase.split()) + rb"(?![0-9a-z\x80-\xff])"))
    for phrase, label in BASE.items()
]


def detections(low: bytes) -> list[tuple[int, int, Rule]]:
    """Kept detections in a lower-cased text, in order."""
    there: dict[bytes, bool] = {}
    found = []
    for rule in rules():
        for keyword in rule.keywords:
            if keyword not in there:
                there[keyword] = keyword in low
            if there[keyword]:
                found += [(m.start(), m.end(), rule) for m in rule.pattern.finditer(low)]
                break
    return suppressed(found)


def suppressed(found: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """Those not contained in a kept one that comes before them by priority, then length, then place.

    What is kept is held as intervals none of which contains another, so one binary search decides.
    """
    starts: list[int] = []
    ends: list[int] = []
    kept = []
    for begin, end, rule in sorted(found, key=lambda x: (-x[2].priority, x[0] - x[1], x[0], x[2].label)):
        at = bisect.bisect_right(starts, begin)
        if at and ends[at - 1] >= end:
            continue
        kept.append((begin, end, rule))
        low = at
        while low and starts[low - 1] == begin:
            low -= 1
        high = at
        while high < len(starts) and ends[high] <= end:
            high += 1
        while low and starts[low - 1] >= begin:
            low -= 1
        starts[low:high], ends[low:high] = [begin], [end]
    return sorted(kept, key=lambda x: (x[0], x[1], x[2].label))


def scan(docs: DataFrame) -> DataFrame:
    """License labels of every text.

    Takes ``doc_id`` and ``text`` (null: empty) and returns ``doc_id``, ``n_words``,
    the number and the first and last word of base phrases (null without any),
    ``base_labels`` and ``labels`` (distinct, sorted, joined by commas),
    ``score``: the greatest confidence of what was found, 0 without anything, and
    ``found``: label, begin and end (in bytes) of each kept detection. In place:
    nothing is shuffled.
    """
    kind = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, found array<struct<label: string, begin: long, end: long>>"
    )

    def one(text: str) -> tuple:
        low = text.encode().lower()
        edge = np.diff(_WORD[np.frombuffer(low, np.uint8)].view(np.int8), prepend=0)
        base = []
        for label, first, pattern in _BASE:
            if first in low:
                base += [(m.start(), label) for m in pattern.finditer(low)]
        kept = detections(low)
        starts = np.flatnonzero(edge > 0) if base else None
        words = sorted(int(np.searchsorted(starts, p)) for p, _ in base)
        base_labels = {label for _, label in base}
        score = max([r.confidence for *_, r in kept] + [0.8] * bool(base), default=0.0)
        return (
            int((edge > 0).sum()), len(base), words[0] if words else None, words[-1] if words else None,
            ",".join(sorted(base_labels)), ",".join(sorted(base_labels | {r.label for *_, r in kept})), score,
            [{"label": r.label, "begin": a, "end": b} for a, b, r in kept],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        detection = pa.struct([("label", pa.string()), ("begin", pa.int64()), ("end", pa.int64())])
        kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.float64(), pa.list_(detection)]
        names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "found"]
        for part, texts in blocks(batches):
            columns = zip(*map(one, texts), strict=True)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names
            )

    return docs.select("doc_id", "text").mapInArrow(run, kind)
