"""License scans (operator 3): ordered signature rules with a keyword prefilter and containment suppression.

Rules are regular expressions over the text with A-Z lower-cased. A rule runs only where all its keywords occur; the
keywords of all rules are found in one pass by an Aho-Corasick automaton. Detections are ordered by priority, then
length; one that lies inside a kept detection is suppressed. Beside the rules, four base phrases are located as
consecutive words; their labels always stay.

Defined results: a null text is empty (no words, no labels, score 0, null word places); equal rows give equal results;
extra columns are ignored; an empty table gives an empty result. Texts are scanned whole.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.llm.common import by_value, texts, worker_state

by_value(__name__)

BASE_PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
BASE_SCORE = 0.5

LIC = r"licen[cs]e"
VER = r"(?:[\s,(]*v(?:ersion|\.)?)?[\s.]*"
# Licenses: label, SPDX ids, keyword of the name, name. Written by hand from the licenses' public names.
LICENSES = [
    ("gpl-1.0", ("gpl-1.0",), "gnu", rf"gnu general public {LIC}{VER}1\b"),
    ("gpl-2.0", ("gpl-2.0",), "gnu", rf"gnu general public {LIC}{VER}2\b"),
    ("gpl-3.0", ("gpl-3.0",), "gnu", rf"gnu general public {LIC}{VER}3\b"),
    ("gpl-2.0", (), "gpl", rf"\bgpl[\s-]*v?2(?:\.0)?\b"),
    ("gpl-3.0", (), "gpl", rf"\bgpl[\s-]*v?3(?:\.0)?\b"),
    ("lgpl-2.0", ("lgpl-2.0",), "gnu", rf"gnu library general public {LIC}"),
    ("lgpl-2.1", ("lgpl-2.1",), "gnu", rf"gnu lesser general public {LIC}{VER}2\.1\b"),
    ("lgpl-3.0", ("lgpl-3.0",), "gnu", rf"gnu lesser general public {LIC}{VER}3\b"),
    ("lgpl-2.1", (), "lgpl", r"\blgpl[\s-]*v?2\.1\b"),
    ("lgpl-3.0", (), "lgpl", r"\blgpl[\s-]*v?3(?:\.0)?\b"),
    ("lgpl", (), "gnu", rf"gnu lesser general public {LIC}"),
    ("agpl-3.0", ("agpl-3.0",), "affero", rf"(?:gnu )?affero general public {LIC}{VER}3\b"),
    ("agpl", (), "affero", rf"(?:gnu )?affero general public {LIC}"),
    ("agpl-3.0", (), "agpl", r"\bagpl[\s-]*v?3(?:\.0)?\b"),
    ("gfdl", ("gfdl-1.1", "gfdl-1.2", "gfdl-1.3"), "gnu", rf"gnu free documentation {LIC}"),
    ("apache-1.0", ("apache-1.0",), "apache", rf"apache (?:software )?{LIC}{VER}1\.0\b"),
    ("apache-1.1", ("apache-1.1",), "apache", rf"apache (?:software )?{LIC}{VER}1\.1\b"),
    ("apache-2.0", ("apache-2.0",), "apache", rf"apache (?:software )?{LIC}{VER}2(?:\.0)?\b"),
    ("mit", ("mit",), "mit", rf"\bmit {LIC}\b"),
    ("mit", (), "expat", rf"\bexpat {LIC}\b"),
    ("mit-0", ("mit-0",), "mit-0", rf"\bmit-0\b|\bmit no attribution\b"),
    ("x11", ("x11",), "x11", rf"\bx11 {LIC}\b"),
    ("isc", ("isc",), "isc", rf"\bisc {LIC}\b"),
    ("bsd-2-clause", ("bsd-2-clause",), "bsd", rf"(?:2|two)[\s-]clause bsd\b|simplified bsd\b|\bbsd[\s-](?:2|two)[\s-]clause"),
    ("bsd-3-clause", ("bsd-3-clause",), "bsd", rf"(?:3|three)[\s-]clause bsd\b|(?:new|revised|modified) bsd\b|\bbsd[\s-](?:3|three)[\s-]clause"),
    ("bsd-4-clause", ("bsd-4-clause",), "bsd", rf"(?:4|four)[\s-]clause bsd\b|original bsd\b|\bbsd[\s-](?:4|four)[\s-]clause"),
    ("0bsd", ("0bsd",), "bsd", r"\b0bsd\b|zero[\s-]clause bsd\b"),
    ("bsd", (), "bsd", rf"\bbsd {LIC}\b"),
    ("mpl-1.0", ("mpl-1.0",), "mozilla", rf"mozilla public {LIC}{VER}1\.0\b"),
    ("mpl-1.1", ("mpl-1.1",), "mozilla", rf"mozilla public {LIC}{VER}1\.1\b"),
    ("mpl-2.0", ("mpl-2.0",), "mozilla", rf"mozilla public {LIC}{VER}2(?:\.0)?\b"),
    ("mpl", (), "mozilla", rf"mozilla public {LIC}"),
    ("epl-1.0", ("epl-1.0",), "eclipse", rf"eclipse public {LIC}{VER}1(?:\.0)?\b"),
    ("epl-2.0", ("epl-2.0",), "eclipse", rf"eclipse public {LIC}{VER}2(?:\.0)?\b"),
    ("edl", (), "eclipse", rf"eclipse distribution {LIC}"),
    ("cddl-1.0", ("cddl-1.0",), "cddl", r"\bcddl[\s-]*v?(?:1\.0)?\b"),
    ("cddl-1.0", ("cddl-1.1",), "common development", r"common development and distribution"),
    ("cpl-1.0", ("cpl-1.0",), "common public", rf"common public {LIC}"),
    ("eupl-1.2", ("eupl-1.1", "eupl-1.2"), "european union", rf"european union public {LIC}"),
    ("artistic-1.0", ("artistic-1.0",), "artistic", rf"artistic {LIC}{VER}1(?:\.0)?\b"),
    ("artistic-2.0", ("artistic-2.0",), "artistic", rf"artistic {LIC}{VER}2(?:\.0)?\b"),
    ("artistic", (), "artistic", rf"artistic {LIC}"),
    ("bsl-1.0", ("bsl-1.0",), "boost", rf"boost software {LIC}"),
    ("busl-1.1", ("busl-1.1",), "business source", rf"business source {LIC}"),
    ("sspl-1.0", ("sspl-1.0",), "server side public", rf"server side public {LIC}"),
    ("elastic-2.0", ("elastic-2.0",), "elastic", rf"elastic {LIC}{VER}2(?:\.0)?\b"),
    ("zlib", ("zlib",), "zlib", rf"\bzlib(?:/libpng)? {LIC}\b"),
    ("libpng", ("libpng", "libpng-2.0"), "libpng", rf"\blibpng {LIC}\b"),
    ("unlicense", ("unlicense",), "unlicense", r"\bthe unlicense\b|unlicense\.org"),
    ("wtfpl", ("wtfpl",), "wtfpl", r"\bwtfpl\b"),
    ("wtfpl", (), "do what the", rf"do what the \S+ you want to public {LIC}"),
    ("python-2.0", ("python-2.0", "psf-2.0"), "python", rf"python software foundation {LIC}|\bpsf {LIC}\b"),
    ("php-3.01", ("php-3.0", "php-3.01"), "php", rf"\bphp {LIC}\b"),
    ("ruby", ("ruby",), "ruby", rf"\bruby {LIC}\b"),
    ("openssl", ("openssl",), "openssl", rf"\bopenssl {LIC}\b"),
    ("vim", ("vim",), "vim", rf"\bvim {LIC}\b"),
    ("postgresql", ("postgresql",), "postgresql", rf"\bpostgresql {LIC}\b"),
    ("ncsa", ("ncsa",), "ncsa", rf"\bncsa (?:open source )?{LIC}\b|university of illinois/ncsa"),
    ("ofl-1.1", ("ofl-1.0", "ofl-1.1"), "open font", rf"(?:sil )?open font {LIC}"),
    ("ms-pl", ("ms-pl",), "microsoft", rf"microsoft public {LIC}"),
    ("ms-rl", ("ms-rl",), "microsoft", rf"microsoft reciprocal {LIC}"),
    ("afl-3.0", ("afl-2.1", "afl-3.0"), "academic free", rf"academic free {LIC}"),
    ("osl-3.0", ("osl-2.1", "osl-3.0"), "open software", rf"open software {LIC}"),
    ("upl-1.0", ("upl-1.0",), "universal permissive", rf"universal permissive {LIC}"),
    ("odbl-1.0", ("odbl-1.0",), "open database", rf"open database {LIC}"),
    ("odc-by-1.0", ("odc-by-1.0",), "open data commons", rf"open data commons attribution"),
    ("pddl-1.0", ("pddl-1.0",), "public domain dedication", r"public domain dedication and licen[cs]e"),
    ("cdla-permissive-2.0", ("cdla-permissive-1.0", "cdla-permissive-2.0"), "community data", rf"community data {LIC} agreement"),
    ("openrail", ("openrail",), "rail", r"\b(?:open|creativeml )?rail(?:\+\+)?[\s-]?m?\b licen[cs]e"),
    ("cecill-2.1", ("cecill-2.0", "cecill-2.1"), "cecill", r"\bcecill\b"),
    ("cc0-1.0", ("cc0-1.0",), "cc0", r"\bcc0(?:[\s-]*1\.0)?\b"),
    ("cc0-1.0", (), "creative commons", r"creative commons (?:zero|public domain dedication)"),
    ("public-domain", (), "public domain", r"(?:in|into|to) the public domain"),
    ("proprietary", (), "all rights", r"\ball rights reserved\b"),
]
# Creative Commons: clauses by short and long name; each comes in the versions below.
CC_CLAUSES = {"by": "attribution", "by-sa": "attribution-sharealike", "by-nd": "attribution-noderivs",
              "by-nc": "attribution-noncommercial", "by-nc-sa": "attribution-noncommercial-sharealike",
              "by-nc-nd": "attribution-noncommercial-noderivs"}
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
URLS = [
    ("gpl", "gnu.org", r"gnu\.org/licenses/(?:old-licenses/)?gpl"), ("lgpl", "gnu.org", r"gnu\.org/licenses/lgpl"),
    ("agpl", "gnu.org", r"gnu\.org/licenses/agpl"), ("gfdl", "gnu.org", r"gnu\.org/licenses/fdl"),
    ("apache-2.0", "apache.org", r"apache\.org/licenses/license-2\.0"), ("mit", "opensource.org", r"opensource\.org/licenses/mit\b"),
    ("bsd-3-clause", "opensource.org", r"opensource\.org/licenses/bsd-3-clause"), ("bsd-2-clause", "opensource.org", r"opensource\.org/licenses/bsd-2-clause"),
    ("mpl-2.0", "mozilla.org", r"mozilla\.org/(?:en-us/)?mpl/2\.0"), ("epl-2.0", "eclipse.org", r"eclipse\.org/legal/epl-2\.0"),
    ("bsl-1.0", "boost.org", r"boost\.org/license_1_0"), ("cc0-1.0", "creativecommons.org", r"creativecommons\.org/publicdomain/zero"),
]
# Clauses of the licenses' own texts.
CLAUSES = [
    ("mit", "permission is hereby granted", r"permission is hereby granted,? free of charge,? to any person obtaining a copy"),
    ("isc", "permission to use", r"permission to use,? copy,? modify,? and/or distribute this software for any purpose"),
    ("bsd", "redistribution and use", r"redistribution and use in source and binary forms,? with or without modification"),
    ("gpl", "free software foundation", r"redistribute it and/or modify\s+it under the terms of the gnu general public"),
    ("zlib", "as-is", r"provided 'as-is', without any express or implied warranty"),
    ("unlicense", "unencumbered", r"free and unencumbered software released into the public domain"),
    ("apache-2.0", "apache", r"you may not use this file except in compliance with the license"),
]
GRANT = (r"(?:licen[cs]ed|released|distributed|published|available|provided)\s+under\s+(?:the\s+)?(?:terms\s+of\s+)?"
         r"(?:the\s+)?")


@dataclass(frozen=True)
class Rule:
    """A signature: runs where all keywords occur; a higher priority wins over what lies inside it."""

    label: str
    keywords: tuple[str, ...]
    pattern: str
    priority: int
    score: float


def build_rules() -> list[Rule]:
    """All rules, strongest evidence first: tags, license clauses, grants, links, names."""
    rules = []
    for label, ids, keyword, name in LICENSES:
        name = name.replace(" ", r"\s+")
        rules += [Rule(label, ("spdx", i), rf"spdx-license-identifier:\s*{re.escape(i)}(?:-only|-or-later|\+)?(?![\w.-])", 50, 1.0)
                  for i in ids]
        rules.append(Rule(label, (keyword.split()[0], "under"), rf"{GRANT}(?:{name})", 40, 0.95))
        rules.append(Rule(label, (keyword.split()[0],), rf"(?:{name})", 10, 0.7))
    for clause, words in CC_CLAUSES.items():
        short, long = clause.replace("-", r"[\s-]"), words.replace("-", r"[\s-]+")
        for version in CC_VERSIONS:
            label, v = f"cc-{clause}-{version}", re.escape(version)
            rules += [Rule(label, ("spdx", "cc-by"), rf"spdx-license-identifier:\s*cc-{clause}-{v}(?![\w.-])", 50, 1.0),
                      Rule(label, ("cc", "under"), rf"{GRANT}(?:a\s+)?\bcc[\s-]{short}[\s-]+{v}\b", 40, 0.95),
                      Rule(label, ("cc",), rf"\bcc[\s-]{short}[\s-]+{v}\b", 15, 0.8),
                      Rule(label, ("creative commons", clause.split("-")[0]), rf"creative\s+commons\s+{long}[\s-]+(?:international\s+)?{v}\b", 15, 0.8),
                      Rule(label, ("creativecommons.org",), rf"creativecommons\.org/licenses/{clause}/{v}\b", 30, 0.9)]
        rules += [Rule(f"cc-{clause}", ("cc",), rf"\bcc[\s-]{short}\b", 5, 0.6),
                  Rule(f"cc-{clause}", ("creative commons",), rf"creative\s+commons\s+{long}\b", 5, 0.6)]
    rules += [Rule(label, (keyword,), pattern, 30, 0.9) for label, keyword, pattern in URLS]
    rules += [Rule(label, (keyword,), pattern.replace(" ", r"\s+"), 45, 0.95) for label, keyword, pattern in CLAUSES]
    return rules


class Scanner:
    """Compiled rules behind one keyword automaton."""

    def __init__(self, rules: list[Rule]):
        import ahocorasick

        # keywords of several words may be broken over lines: their first word gates
        self.rules = [(r, re.compile(r.pattern), {k.split()[0] for k in r.keywords}) for r in rules]
        self.automaton = ahocorasick.Automaton()
        for word in {w for _, _, gate in self.rules for w in gate}:
            self.automaton.add_word(word, word)
        self.automaton.make_automaton()

    def detections(self, low: str) -> list[tuple[int, int, str, float]]:
        """Kept detections (start, end, label, score) of a lower-cased text, in text order."""
        present = {word for _, word in self.automaton.iter(low)}
        found = []
        if present:
            for rule, pattern, gate in self.rules:
                if gate <= present:
                    found += [(-rule.priority, m.start() - m.end(), m.start(), m.end(), rule.label, rule.score)
                              for m in pattern.finditer(low)]
        kept: list[tuple[int, int, str, float]] = []
        # kept spans that no other kept span contains: both starts and ends ascend
        starts: list[int] = []
        ends: list[int] = []
        for _, _, start, end, label, score in sorted(found):
            at = bisect.bisect_right(starts, start)
            if at and ends[at - 1] >= end:
                continue
            kept.append((start, end, label, score))
            first = at - (at > 0 and starts[at - 1] == start)
            last = bisect.bisect_right(ends, end)
            starts[first:max(first, last)], ends[first:max(first, last)] = [start], [end]
        return sorted(kept)


_WORD_BYTES = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def words_of(lowered: bytes) -> list[bytes]:
    """Maximal runs of digits, a-z and non-ASCII characters."""
    return lowered.translate(_WORD_BYTES).split()


def phrase_places(words: list[bytes], phrase: list[bytes]) -> list[int]:
    places, at = [], -1
    while True:
        try:
            at = words.index(phrase[0], at + 1)
        except ValueError:
            return places
        if words[at:at + len(phrase)] == phrase:
            places.append(at)


def scan_licenses(docs: DataFrame, rules: list[Rule] | None = None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Per document: word count, base phrase places, base labels, all labels, score and the kept detections."""
    rules = rules or build_rules()
    id_type = docs.schema[id_col].dataType.simpleString()
    phrases = [(p.encode().split(), label) for p, label in BASE_PHRASES.items()]
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("score", pa.float64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = worker_state(f"licenses_{hash(tuple(rules))}", lambda: Scanner(rules))
        for batch in batches:
            out = []
            for text in texts(batch.column(1)):
                low = text.encode().lower()
                words = words_of(low)
                base, places = set(), []
                for phrase, label in phrases:
                    if all(w in low for w in phrase) and (got := phrase_places(words, phrase)):
                        base.add(label)
                        places += got
                kept = scanner.detections(low.decode())
                labels = base | {d[2] for d in kept}
                score = max([BASE_SCORE] * bool(base) + [d[3] for d in kept], default=0.0)
                out.append((len(words), len(places), min(places, default=None), max(places, default=None),
                            ",".join(sorted(base)), ",".join(sorted(labels)), score,
                            [dict(zip(("start", "end", "label", "score"), d, strict=True)) for d in kept]))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(span)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds))],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
                       "detections"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        scan, f"doc_id {id_type}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
              "labels string, score double, "
              "detections array<struct<start: long, end: long, label: string, score: double>>")
