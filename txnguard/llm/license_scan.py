"""License scan by ordered signature rules.

A text's words (lower-cased ASCII letters, digits and anything beyond ASCII) are
joined by blanks, and rules are regexes over that. Hundreds of rules come from a
list of licenses and the ways to state one: an SPDX tag, a notice ("licensed
under ..."), the name, a metadata field. A rule runs only where its keyword (the
identifier, or a part of the name) is in the text. Detections are then taken by priority, longest first; one that lies
inside an interval already taken is dropped.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame

from txnguard.llm.common import arrow_schema, batch_of, id_text, schema_with, text_batches

# The phrases of the base detections and their labels.
BASE_PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Label, SPDX identifier as words, name as a regex over words, keyword of the name.
LICENSES = (
    ("mit", "mit", "mit license", "mit"),
    ("mit-0", "mit 0", "mit no attribution(?: license)?", "mit"),
    ("apache-1.1", "apache 1 1", "apache (?:software )?license (?:version )?1 1", "apache"),
    ("apache-2.0", "apache 2 0", "apache (?:software )?license (?:version )?2(?: 0)?", "apache"),
    ("apache", "apache", "apache (?:software )?license", "apache"),
    ("gpl-1.0", "gpl 1 0", "(?:gnu )?(?:general public license|gpl) (?:version )?v?1(?: 0)?", "g"),
    ("gpl-2.0", "gpl 2 0", "(?:gnu )?(?:general public license|gpl) (?:version )?v?2(?: 0)?", "g"),
    ("gpl-3.0", "gpl 3 0", "(?:gnu )?(?:general public license|gpl) (?:version )?v?3(?: 0)?", "g"),
    ("gpl", "gpl", "(?:gnu )?(?:general public license|gpl)", "g"),
    ("lgpl-2.0", "lgpl 2 0", "(?:gnu )?(?:(?:library|lesser) general public license|lgpl) (?:version )?v?2(?: 0)?", "l"),
    ("lgpl-2.1", "lgpl 2 1", "(?:gnu )?(?:lesser general public license|lgpl) (?:version )?v?2 1", "l"),
    ("lgpl-3.0", "lgpl 3 0", "(?:gnu )?(?:lesser general public license|lgpl) (?:version )?v?3(?: 0)?", "l"),
    ("lgpl", "lgpl", "(?:gnu )?(?:(?:library|lesser) general public license|lgpl)", "l"),
    ("agpl-3.0", "agpl 3 0", "(?:gnu )?(?:affero general public license|agpl) (?:version )?v?3(?: 0)?", "a"),
    ("agpl", "agpl", "(?:gnu )?(?:affero general public license|agpl)", "a"),
    ("gfdl-1.3", "gfdl 1 3", "(?:gnu )?free documentation license (?:version )?1 3", "documentation"),
    ("gfdl", "gfdl", "(?:gnu )?free documentation license", "documentation"),
    ("bsd-2-clause", "bsd 2 clause", "(?:simplified bsd|bsd 2 clause|2 clause bsd|freebsd) license", "bsd"),
    ("bsd-3-clause", "bsd 3 clause", "(?:(?:new|modified|revised) bsd|bsd 3 clause|3 clause bsd) license", "bsd"),
    ("bsd-4-clause", "bsd 4 clause", "(?:original bsd|bsd 4 clause|4 clause bsd) license", "bsd"),
    ("0bsd", "0bsd", "(?:zero clause bsd|0bsd) license", "bsd"),
    ("bsd", "bsd", "bsd(?: style)? license", "bsd"),
    ("mpl-1.1", "mpl 1 1", "mozilla public license (?:version )?1 1", "mozilla"),
    ("mpl-2.0", "mpl 2 0", "mozilla public license (?:version )?2 0", "mozilla"),
    ("mpl", "mpl", "mozilla public license", "mozilla"),
    ("epl-1.0", "epl 1 0", "eclipse public license (?:version )?v?1 0", "eclipse"),
    ("epl-2.0", "epl 2 0", "eclipse public license (?:version )?v?2 0", "eclipse"),
    ("epl", "epl", "eclipse public license", "eclipse"),
    ("edl-1.0", "edl 1 0", "eclipse distribution license", "eclipse"),
    ("cddl-1.0", "cddl 1 0", "common development and distribution license", "distribution"),
    ("cpl-1.0", "cpl 1 0", "common public license", "common"),
    ("ipl-1.0", "ipl 1 0", "ibm public license", "ibm"),
    ("isc", "isc", "isc license", "isc"),
    ("zlib", "zlib", "zlib(?: libpng)? license", "zlib"),
    ("libpng", "libpng", "(?:libpng|png reference library) license", "png"),
    ("bsl-1.0", "bsl 1 0", "boost software license(?: version 1 0)?", "boost"),
    ("busl-1.1", "busl 1 1", "business source license(?: (?:version )?1 1)?", "business"),
    ("artistic-1.0", "artistic 1 0", "artistic license (?:version )?1 0", "artistic"),
    ("artistic-2.0", "artistic 2 0", "artistic license (?:version )?2 0", "artistic"),
    ("artistic", "artistic", "artistic license", "artistic"),
    ("psf-2.0", "psf 2 0", "(?:python software foundation|psf) license(?: (?:version )?2)?", "p"),
    ("python-2.0", "python 2 0", "python license", "python"),
    ("php-3.01", "php 3 01", "php license(?: version 3 01)?", "php"),
    ("ruby", "ruby", "ruby license", "ruby"),
    ("unlicense", "unlicense", "(?:the )?unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "(?:do what the fuck you want to public license|wtfpl)", "w"),
    ("cc0-1.0", "cc0 1 0", "(?:creative commons zero|cc0)(?: 1 0)?(?: universal)?(?: public domain dedication)?(?: license)?", "c"),
    ("cc-by-3.0", "cc by 3 0", "creative commons attribution (?:version )?3 0(?: unported)? license", "creative"),
    ("cc-by-4.0", "cc by 4 0", "creative commons attribution (?:version )?4 0(?: international)?(?: public)? license", "creative"),
    ("cc-by-sa-3.0", "cc by sa 3 0", "creative commons attribution share ?alike (?:version )?3 0(?: unported)? license", "creative"),
    ("cc-by-sa-4.0", "cc by sa 4 0", "creative commons attribution share ?alike (?:version )?4 0(?: international)?(?: public)? license", "creative"),
    ("cc-by-nc-4.0", "cc by nc 4 0", "creative commons attribution non ?commercial (?:version )?4 0(?: international)?(?: public)? license", "creative"),
    ("cc-by-nd-4.0", "cc by nd 4 0", "creative commons attribution no ?deriv(?:ative)?s (?:version )?4 0(?: international)?(?: public)? license", "creative"),
    ("cc-by-nc-sa-4.0", "cc by nc sa 4 0", "creative commons attribution non ?commercial share ?alike (?:version )?4 0(?: international)?(?: public)? license", "creative"),
    ("cc-by-nc-nd-4.0", "cc by nc nd 4 0", "creative commons attribution non ?commercial no ?deriv(?:ative)?s (?:version )?4 0(?: international)?(?: public)? license", "creative"),
    ("creative-commons", "cc", "creative commons(?: attribution)? license", "creative"),
    ("odbl-1.0", "odbl 1 0", "open database license", "database"),
    ("odc-by-1.0", "odc by 1 0", "open data commons attribution license", "data"),
    ("pddl-1.0", "pddl 1 0", "public domain dedication and license", "domain"),
    ("ofl-1.1", "ofl 1 1", "(?:sil )?open font license(?: (?:version )?1 1)?", "font"),
    ("eupl-1.2", "eupl 1 2", "european union public licen[cs]e(?: v ?1 2)?", "european"),
    ("cecill-2.1", "cecill 2 1", "cecill(?: free software)? license(?: agreement)?", "cecill"),
    ("osl-3.0", "osl 3 0", "open software license(?: (?:version )?3 0)?", "open"),
    ("afl-3.0", "afl 3 0", "academic free license(?: (?:version )?3 0)?", "academic"),
    ("ms-pl", "ms pl", "microsoft public license", "microsoft"),
    ("ms-rl", "ms rl", "microsoft reciprocal license", "microsoft"),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa(?: open source)? license", "ncsa"),
    ("x11", "x11", "x11 license", "x11"),
    ("curl", "curl", "curl license", "curl"),
    ("openssl", "openssl", "openssl license", "openssl"),
    ("postgresql", "postgresql", "postgresql licen[cs]e", "postgresql"),
    ("upl-1.0", "upl 1 0", "universal permissive license", "universal"),
    ("vim", "vim", "vim license", "vim"),
    ("w3c", "w3c", "w3c(?: software)?(?: notice and)? license", "w3c"),
    ("sspl-1.0", "sspl 1 0", "server side public license", "server"),
    ("elastic-2.0", "elastic 2 0", "elastic license(?: 2 0)?", "elastic"),
    ("json", "json", "json license", "json"),
    ("beerware", "beerware", "beer ?ware license", "beer"),
    ("tcl", "tcl", "tcl tk license", "tcl"),
    ("qpl-1.0", "qpl 1 0", "q public license", "q"),
    ("sleepycat", "sleepycat", "sleepycat license", "sleepycat"),
    ("hpnd", "hpnd", "historical permission notice and disclaimer", "historical"),
    ("public-domain", "public domain", "(?:(?:released|dedicated) (?:in)?to|in) the public domain", "domain"),
    ("proprietary", "proprietary", "(?:proprietary(?: software)? license|all rights reserved)", "r"),
)

UNDER = "(?:re)?(?:leased|licen[sc]ed|distributed|available|provided|governed)(?: to you)? (?:by|under)(?: the)?(?: terms)?(?: and conditions)?(?: of)?(?: the)?(?: gnu)? "
#: Ways to state a license: priority, confidence, regex around the identifier or the name.
STATED = (
    (100, 1.0, "spdx license identifier {id}(?: only| or later)?"),
    (90, 0.95, UNDER + "{name}(?: or(?: any)? later(?: version)?)?"),
    (70, 0.85, "{name}(?: or(?: any)? later(?: version)?)?"),
    (60, 0.75, "licen[sc]es?(?: type| name| is)? {id}(?: only| or later)?"),
)
#: A word that every statement holds at least one of; texts without any are not looked at closer.
GATE = (b"licen", b"spdx", b"domain", b"cc0", b"wtfpl", b"gpl", b"reserved", b"commons", b"historical", b"attribution")


class Rule(NamedTuple):
    priority: int
    confidence: float
    label: str
    keyword: str
    pattern: re.Pattern


class Hit(NamedTuple):
    start: int  # words, from 0
    end: int  # exclusive
    label: str
    priority: int
    confidence: float


def rules(licenses=LICENSES, stated=STATED) -> list[Rule]:
    """The ordered rules; a license stated with a version ranks before one without."""
    out = [
        Rule(priority + (1 if re.search(r"\d", label) else 0), confidence, label, spdx if "{id}" in form else keyword, re.compile(f"(?<= ){form.format(id=spdx, name=name)}(?= )"))
        for priority, confidence, form in stated
        for label, spdx, name, keyword in licenses
    ]
    return sorted(out, key=lambda r: -r.priority)


WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
IS_WORD = np.ones(256, bool)
IS_WORD[:0x80] = [bool(re.match(r"[0-9A-Za-z]", chr(b))) for b in range(0x80)]


def base_places(joined: str, phrases=BASE_PHRASES):
    """``(position, label)`` of each place of each phrase in words joined and flanked by blanks."""
    for phrase, label in phrases:
        at = joined.find(f" {phrase} ")
        while at >= 0:
            yield at, label
            at = joined.find(f" {phrase} ", at + 1)


def detect(joined: str, word_at: list[int], ordered: list[Rule]) -> list[Hit]:
    """Detections that stand after suppression, by place."""
    found = []
    for rule in ordered:
        if rule.keyword in joined:
            for m in rule.pattern.finditer(joined):
                found.append(Hit(bisect_right(word_at, m.start()) - 1, bisect_right(word_at, m.end() - 1), rule.label, rule.priority, rule.confidence))
    kept: list[Hit] = []
    starts = {x: i + 1 for i, x in enumerate(sorted({h.start for h in found}))}
    reach = [0] * (len(starts) + 1)  # Fenwick tree: the furthest end among starts up to a place
    for hit in sorted(found, key=lambda h: (-h.priority, h.start - h.end, h.start, h.label)):
        i, furthest = starts[hit.start], 0
        while i:
            furthest, i = max(furthest, reach[i]), i & (i - 1)
        if furthest < hit.end:  # no interval taken contains it
            kept.append(hit)
            i = starts[hit.start]
            while i < len(reach):
                reach[i], i = max(reach[i], hit.end), i + (i & -i)
    return sorted(kept)


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_hits: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score``.

    ``n_base`` counts the places of the base phrases, ``first_word`` and ``last_word``
    are their smallest and largest start (null if none); ``labels`` holds the base
    labels and those of the rules; ``score`` is the best confidence of a detection
    that stands, 0 without any. ``with_hits=True`` adds ``hits``, an array of
    (start word, end word, label, confidence).

    A null text counts as empty: 0 words and no labels. A null id stays null;
    repeated rows give repeated rows; an empty table gives none; other columns are
    ignored. Texts are processed whole.
    """
    source = id_text(docs, id_col, text_col)
    hits = ", hits array<struct<start: int, end: int, label: string, confidence: double>>" if with_hits else ""
    schema = schema_with(source, "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double" + hits)
    arrow = arrow_schema(schema)

    def closer(low: bytes):
        words = WORD.findall(low.decode("utf-8", "replace"))
        joined, word_at, at = " " + " ".join(words) + " ", [], 1
        for w in words:
            word_at.append(at)
            at += len(w) + 1
        base = list(base_places(joined))
        starts = [bisect_right(word_at, p + 1) - 1 for p, _ in base]
        found = detect(joined, word_at, ordered)
        base_labels = {x for _, x in base}
        return (
            len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(base_labels)),
            ",".join(sorted(base_labels | {h.label for h in found})),
            max([h.confidence for h in found], default=0.85 if base else 0.0), [(h.start, h.end, h.label, h.confidence) for h in found],
        )

    ordered = rules()
    plain = (0, None, None, "", "", 0.0, [])

    def run(batches):
        for ids, texts in text_batches(batches):
            raw = [t.encode("utf-8", "surrogatepass") for t in texts]
            is_word = IS_WORD[np.frombuffer(b"\0".join(raw) + b"\0", np.uint8)]
            starts = is_word.copy()
            starts[1:] &= ~is_word[:-1]
            ends = np.cumsum([len(r) + 1 for r in raw])
            n_words = np.diff(np.append(0, np.cumsum(starts)[ends - 1]))
            rows = []
            for r in raw:
                low = r.lower()
                rows.append(closer(low) if any(g in low for g in GATE) else plain)
            yield batch_of(arrow, [ids, n_words, *map(list, list(zip(*rows))[: 6 + with_hits])])

    return source.mapInArrow(run, schema)
