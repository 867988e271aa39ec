"""License scans by ordered signature rules (operator 9).

A row of ``NAMES`` is a hand-written signature of one licence: the label, a
literal keyword that every match contains, and a regular expression over
lower-case text in which a space stands for any run of white space. ``IDS`` are
short names that count only where a text states a licence. ``FORMS`` puts these
some 240 signatures into the ways a text states them (an SPDX tag, a further
operand of its expression, a notice, a header, a bare mention); the rules so made
are ordered by priority.

A text is first tried for a dozen anchors, one of which is part of every
keyword; only texts that have one are tried for keywords, and only rules whose
keyword is there are matched. All places of all matching rules are gathered,
and a place that lies inside one of a higher priority is suppressed in one sweep
over the places in their order. Everything is built-in expressions on the row itself: no shuffle, no Python.

Defined results: a null or empty text has no words, no labels and score 0; a
null ``doc_id`` and repeated rows are scanned like any other; texts of any length
are scanned whole; of places that start alike the longest, then the first rule,
goes first; other columns are ignored, whatever their names; an empty table
gives no rows.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Phrases of the base scan and their labels.
PHRASES = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: label | keyword | signature
NAMES = [
    tuple(x.strip() for x in line.split(" | "))
    for line in r"""
mit | mit licen | (?:the )?mit licen[sc]e
mit | mit-style licen | (?:the )?mit-style licen[sc]e
mit | mit style licen | (?:the )?mit style licen[sc]e
mit-0 | mit-0 licen | mit-0 licen[sc]e
mit-no-attribution | mit no attribution licen | mit no attribution licen[sc]e
x11 | x11 licen | x11 licen[sc]e
expat | expat licen | expat licen[sc]e
isc | isc licen | isc licen[sc]e
bsd-2-clause | bsd licen | (?:2|two)[- ]clause bsd licen[sc]e|simplified bsd licen[sc]e
bsd-2-clause | bsd 2-clause licen | bsd 2-clause licen[sc]e
bsd-3-clause | bsd licen | (?:3|three)[- ]clause bsd licen[sc]e|(?:new|revised|modified) bsd licen[sc]e
bsd-3-clause | bsd 3-clause licen | bsd 3-clause licen[sc]e
bsd-4-clause | bsd licen | (?:4|four)[- ]clause bsd licen[sc]e|original bsd licen[sc]e
0bsd | bsd licen | (?:0|zero)[- ]clause bsd licen[sc]e
bsd | bsd licen | bsd licen[sc]e
bsd | bsd-style licen | bsd-style licen[sc]e
apache-1.0 | apache licen | apache licen[sc]e,? (?:version )?v?1\.0
apache-1.1 | apache licen | apache licen[sc]e,? (?:version )?v?1\.1
apache-2.0 | apache licen | apache licen[sc]e,? (?:version )?v?2(?:\.0)?
apache-2.0 | apache-2.0 licen | apache-2\.0 licen[sc]e
apache-2.0 | apache 2.0 licen | apache 2\.0 licen[sc]e
apache | apache licen | apache licen[sc]e
apache | apache software licen | apache software licen[sc]e
agpl-1.0 | affero general public licen | (?:gnu )?affero general public licen[sc]e,? (?:version |v)?1(?:\.0)?
agpl-3.0 | affero general public licen | (?:gnu )?affero general public licen[sc]e,? (?:version |v)?3(?:\.0)?
agpl | affero general public licen | (?:gnu )?affero general public licen[sc]e
agpl-3.0 | agplv3 | agplv3\+?
agpl-3.0 | agpl-3.0 | agpl-3\.0(?:-only|-or-later)?
lgpl-2.0 | general public licen | (?:gnu )?(?:lesser|library) general public licen[sc]e,? (?:version |v)?2(?:\.0)?
lgpl-2.1 | general public licen | (?:gnu )?(?:lesser|library) general public licen[sc]e,? (?:version |v)?2\.1
lgpl-3.0 | general public licen | (?:gnu )?lesser general public licen[sc]e,? (?:version |v)?3(?:\.0)?
lgpl | general public licen | (?:gnu )?(?:lesser|library) general public licen[sc]e
lgpl-2.1 | lgplv2.1 | lgplv2\.1\+?
lgpl-2.1 | lgpl-2.1 | lgpl-2\.1(?:-only|-or-later)?
lgpl-3.0 | lgplv3 | lgplv3\+?
lgpl-3.0 | lgpl-3.0 | lgpl-3\.0(?:-only|-or-later)?
gpl-1.0 | general public licen | (?:gnu )?general public licen[sc]e,? (?:version |v)?1(?:\.0)?
gpl-2.0 | general public licen | (?:gnu )?general public licen[sc]e,? (?:version |v)?2(?:\.0)?
gpl-3.0 | general public licen | (?:gnu )?general public licen[sc]e,? (?:version |v)?3(?:\.0)?
gpl | general public licen | (?:gnu )?general public licen[sc]e
gpl | gnu gpl | gnu gpl
gpl-2.0 | gplv2 | gplv2\+?
gpl-2.0 | gpl-2.0 | gpl-2\.0(?:-only|-or-later)?
gpl-3.0 | gplv3 | gplv3\+?
gpl-3.0 | gpl-3.0 | gpl-3\.0(?:-only|-or-later)?
gfdl-1.1 | free documentation licen | gnu free documentation licen[sc]e,? (?:version |v)?1\.1
gfdl-1.2 | free documentation licen | gnu free documentation licen[sc]e,? (?:version |v)?1\.2
gfdl-1.3 | free documentation licen | gnu free documentation licen[sc]e,? (?:version |v)?1\.3
gfdl | free documentation licen | gnu free documentation licen[sc]e
mpl-1.0 | mozilla public licen | mozilla public licen[sc]e,? (?:version |v)?1\.0
mpl-1.1 | mozilla public licen | mozilla public licen[sc]e,? (?:version |v)?1\.1
mpl-2.0 | mozilla public licen | mozilla public licen[sc]e,? (?:version |v)?2(?:\.0)?
mpl | mozilla public licen | mozilla public licen[sc]e
epl-1.0 | eclipse public licen | eclipse public licen[sc]e,? (?:version |v)?1(?:\.0)?
epl-2.0 | eclipse public licen | eclipse public licen[sc]e,? (?:version |v)?2(?:\.0)?
epl | eclipse public licen | eclipse public licen[sc]e
cpl-1.0 | common public licen | common public licen[sc]e
ipl-1.0 | ibm public licen | ibm public licen[sc]e
cddl-1.0 | common development and distribution licen | common development and distribution licen[sc]e,? (?:version |v)?1\.0
cddl-1.1 | common development and distribution licen | common development and distribution licen[sc]e,? (?:version |v)?1\.1
cddl | common development and distribution licen | common development and distribution licen[sc]e
eupl-1.1 | european union public licen | european union public licen[sc]e,? (?:version |v)?1\.1
eupl-1.2 | european union public licen | european union public licen[sc]e,? (?:version |v)?1\.2
eupl | european union public licen | european union public licen[sc]e
ms-pl | microsoft public licen | microsoft public licen[sc]e
ms-rl | microsoft reciprocal licen | microsoft reciprocal licen[sc]e
osl-3.0 | open software licen | open software licen[sc]e,? (?:version |v)?3\.0
osl | open software licen | open software licen[sc]e
afl-3.0 | academic free licen | academic free licen[sc]e,? (?:version |v)?3\.0
afl | academic free licen | academic free licen[sc]e
artistic-1.0 | artistic licen | artistic licen[sc]e,? (?:version |v)?1(?:\.0)?
artistic-2.0 | artistic licen | artistic licen[sc]e,? (?:version |v)?2(?:\.0)?
artistic | artistic licen | artistic licen[sc]e
bsl-1.0 | boost software licen | boost software licen[sc]e
busl-1.1 | business source licen | business source licen[sc]e
sspl-1.0 | server side public licen | server side public licen[sc]e
elastic-2.0 | elastic licen | elastic licen[sc]e,? (?:version |v)?2(?:\.0)?
elastic | elastic licen | elastic licen[sc]e
zlib | zlib licen | zlib licen[sc]e
zlib | zlib/libpng licen | zlib/libpng licen[sc]e
libpng | libpng licen | libpng licen[sc]e
python-2.0 | python software foundation licen | python software foundation licen[sc]e
php-3.01 | php licen | php licen[sc]e
ruby | ruby licen | ruby licen[sc]e
perl | same terms as perl itself, licen | under the same terms as perl itself, licen[sc]e
postgresql | postgresql licen | postgresql licen[sc]e
openssl | openssl licen | openssl licen[sc]e
unicode | unicode licen | unicode licen[sc]e
unicode | unicode, inc. licen | unicode, inc\. licen[sc]e
unicode | unicode inc. licen | unicode inc\. licen[sc]e
w3c | w3c software | w3c software (?:notice and )?licen[sc]e
ncsa | ncsa open source licen | ncsa open source licen[sc]e
ofl-1.1 | open font licen | (?:sil )?open font licen[sc]e
vim | vim licen | vim licen[sc]e
wtfpl | do what the fuck you want to public licen | do what the fuck you want to public licen[sc]e
beerware | beer-ware licen | beer-ware licen[sc]e
unlicense | unlicense | the unlicense
curl | curl licen | curl licen[sc]e
cecill-2.1 | cecill | cecill(?:[- ]?(?:v|version )?2\.1)? (?:free software )?licen[sc]e
odbl-1.0 | open database licen | open database licen[sc]e
odc-by-1.0 | open data commons attribution licen | open data commons attribution licen[sc]e
pddl-1.0 | public domain dedication and licen | public domain dedication and licen[sc]e
ogl-3.0 | open government licen | open government licen[sc]e
etalab-2.0 | licence ouverte | licence ouverte
dl-de-by-2.0 | datenlizenz deutschland | datenlizenz deutschland
openrail | openrail | (?:bigscience )?openrail(?:-m|\+\+)?
cc0-1.0 | cc0 | cc0(?:[- ]1\.0)?(?: universal)?
cc-by-nc-nd-3.0 | cc by-nc-nd | cc by-nc-nd[- ]3\.0
cc-by-nc-nd-4.0 | cc by-nc-nd | cc by-nc-nd[- ]4\.0
cc-by-nc-nd | cc by-nc-nd | cc by-nc-nd
cc-by-nc-nd | cc-by-nc-nd | cc-by-nc-nd(?:-[234]\.[05])?
cc-by-nc-sa-3.0 | cc by-nc-sa | cc by-nc-sa[- ]3\.0
cc-by-nc-sa-4.0 | cc by-nc-sa | cc by-nc-sa[- ]4\.0
cc-by-nc-sa | cc by-nc-sa | cc by-nc-sa
cc-by-nc-sa | cc-by-nc-sa | cc-by-nc-sa(?:-[234]\.[05])?
cc-by-nc-3.0 | cc by-nc | cc by-nc[- ]3\.0
cc-by-nc-4.0 | cc by-nc | cc by-nc[- ]4\.0
cc-by-nc | cc by-nc | cc by-nc
cc-by-nc | cc-by-nc | cc-by-nc(?:-[234]\.[05])?
cc-by-nd | cc by-nd | cc by-nd(?:[- ][234]\.[05])?
cc-by-nd | cc-by-nd | cc-by-nd(?:-[234]\.[05])?
cc-by-sa-3.0 | cc by-sa | cc by-sa[- ]3\.0
cc-by-sa-4.0 | cc by-sa | cc by-sa[- ]4\.0
cc-by-sa | cc by-sa | cc by-sa
cc-by-sa | cc-by-sa | cc-by-sa(?:-[234]\.[05])?
cc-by-3.0 | cc by | cc by[- ]3\.0
cc-by-4.0 | cc by | cc by[- ]4\.0
cc-by-4.0 | cc-by-4.0 | cc-by-4\.0
cc-by-nc | creative commons | creative commons attribution[- ]non-?commercial
cc-by-nc-sa | creative commons | creative commons attribution[- ]non-?commercial[- ]share-?alike
cc-by-nc-nd | creative commons | creative commons attribution[- ]non-?commercial[- ]no-?deriv(?:atives|s)
cc-by-sa | creative commons | creative commons attribution[- ]share-?alike
cc-by-nd | creative commons | creative commons attribution[- ]no-?deriv(?:atives|s)
cc-by | creative commons | creative commons attribution
cc | creative commons | creative commons(?: licen[sc]e)?
public-domain | public domain | (?:placed |released |dedicated )?(?:in|into|to) the public domain|public domain
mit | permission is hereby granted, free of charge | permission is hereby granted, free of charge, to any person obtaining a copy
isc | permission to use, copy, modify | permission to use, copy, modify,? and(?:/or)? distribute this software
bsd | redistribution and use in source and binary forms | redistribution and use in source and binary forms, with or without modification
apache-2.0 | obtain a copy of the license | you may obtain a copy of the license at https?://www\.apache\.org/licenses/license-2\.0
no-warranty | without warrant | without warranty of any kind
proprietary | proprietary | (?:confidential and proprietary|proprietary and confidential)
no-redistribution | not be copied | (?:may|must) not be copied
no-redistribution | not be reproduced | (?:may|must) not be reproduced
no-redistribution | not be redistributed | (?:may|must) not be redistributed
no-redistribution | unauthorized | unauthorized (?:copying|redistribution)
no-redistribution | unauthorised | unauthorised (?:copying|redistribution)
copyright | copyright | copyright (?:\(c\)|©)? ?(?:19|20)\d\d
copyright | copyright | (?:©|\(c\)) copyright
copyright-reserved | rights reserved | copyright[^\n]{0,80}all rights reserved
""".strip().splitlines()
]

#: label | keyword | SPDX id or short name, which names a licence only behind a tag, a header or "under"
IDS = [
    tuple(x.strip() for x in line.split(" | "))
    for line in r"""
mit | mit | mit
mit-0 | mit-0 | mit-0
x11 | x11 | x11
isc | isc | isc
0bsd | 0bsd | 0bsd
bsd-2-clause | bsd-2-clause | bsd-2-clause
bsd-3-clause | bsd-3-clause | bsd-3-clause
bsd-4-clause | bsd-4-clause | bsd-4-clause
bsd-2-clause | bsd 2-clause | bsd 2-clause
bsd-3-clause | bsd 3-clause | bsd 3-clause
bsd-4-clause | bsd 4-clause | bsd 4-clause
bsd | bsd | bsd
apache-1.0 | apache-1.0 | apache-1\.0
apache-1.1 | apache-1.1 | apache-1\.1
apache-2.0 | apache-2.0 | apache-2\.0
apache-2.0 | apache 2 | apache 2(?:\.0)?
apache-2.0 | apache v2 | apache v2(?:\.0)?
apache | apache | apache
agpl-1.0 | agpl-1.0 | agpl-1\.0(?:-only|-or-later)?
agpl-3.0 | agpl 3 | agpl 3(?:\.0)?
agpl-3.0 | agpl v3 | agpl v3(?:\.0)?
agpl | agpl | agpl
lgpl-2.0 | lgpl-2.0 | lgpl-2\.0(?:-only|-or-later|\+)?
lgpl-2.1 | lgpl 2.1 | lgpl 2\.1
lgpl-2.1 | lgpl v2.1 | lgpl v2\.1
lgpl-3.0 | lgpl 3 | lgpl 3(?:\.0)?
lgpl-3.0 | lgpl v3 | lgpl v3(?:\.0)?
lgpl | lgpl | lgpl
gpl-1.0 | gpl-1.0 | gpl-1\.0(?:-only|-or-later|\+)?
gpl-2.0 | gpl 2 | gpl 2(?:\.0)?
gpl-2.0 | gpl v2 | gpl v2(?:\.0)?
gpl-3.0 | gpl 3 | gpl 3(?:\.0)?
gpl-3.0 | gpl v3 | gpl v3(?:\.0)?
gpl | gpl | gpl
gfdl-1.1 | gfdl-1.1 | gfdl-1\.1(?:-only|-or-later)?
gfdl-1.2 | gfdl-1.2 | gfdl-1\.2(?:-only|-or-later)?
gfdl-1.3 | gfdl-1.3 | gfdl-1\.3(?:-only|-or-later)?
gfdl | gfdl | gfdl
mpl-1.0 | mpl-1.0 | mpl-1\.0
mpl-1.1 | mpl-1.1 | mpl-1\.1
mpl-2.0 | mpl-2.0 | mpl-2\.0
mpl-2.0 | mpl 2 | mpl 2(?:\.0)?
mpl | mpl | mpl
epl-1.0 | epl-1.0 | epl-1\.0
epl-2.0 | epl-2.0 | epl-2\.0
epl | epl | epl
cpl-1.0 | cpl-1.0 | cpl-1\.0
ipl-1.0 | ipl-1.0 | ipl-1\.0
cddl-1.0 | cddl-1.0 | cddl-1\.0
cddl-1.1 | cddl-1.1 | cddl-1\.1
cddl | cddl | cddl
eupl-1.1 | eupl-1.1 | eupl-1\.1
eupl-1.2 | eupl-1.2 | eupl-1\.2
eupl | eupl | eupl
ms-pl | ms-pl | ms-pl
ms-rl | ms-rl | ms-rl
osl-3.0 | osl-3.0 | osl-3\.0
afl-3.0 | afl-3.0 | afl-3\.0
artistic-1.0 | artistic-1.0 | artistic-1\.0
artistic-2.0 | artistic-2.0 | artistic-2\.0
bsl-1.0 | bsl-1.0 | bsl-1\.0
busl-1.1 | busl-1.1 | busl-1\.1
sspl-1.0 | sspl-1.0 | sspl-1\.0
elastic-2.0 | elastic-2.0 | elastic-2\.0
zlib | zlib | zlib
libpng | libpng | libpng(?:-2\.0)?
python-2.0 | python-2.0 | python-2\.0
python-2.0 | psf-2.0 | psf-2\.0
php-3.01 | php-3.01 | php-3\.01
postgresql | postgresql | postgresql
openssl | openssl | openssl
ncsa | ncsa | ncsa
ofl-1.1 | ofl-1.1 | ofl-1\.1
wtfpl | wtfpl | wtfpl
unlicense | unlicense | unlicense
cecill-2.1 | cecill-2.1 | cecill-2\.1
odbl-1.0 | odbl-1.0 | odbl-1\.0
odc-by-1.0 | odc-by-1.0 | odc-by-1\.0
pddl-1.0 | pddl-1.0 | pddl-1\.0
cc-by | cc-by | cc-by(?:-[123]\.[05])?
w3c | w3c | w3c
vim | vim | vim
curl | curl | curl
ruby | ruby | ruby
beerware | beerware | beerware
""".strip().splitlines()
]

#: name, what stands before and after a signature, priority, confidence. No repeat of
#: white space begins inside a run of it or gives any back, so runs of any length are read once.
FORMS = [
    ("tag", r"spdx-licen[sc]e-identifier ?: ?\({0,3} ?", "", 1, 1.0),
    ("operand", r"(?<![a-z0-9])(?:or|and|with) \({0,3} ?", r"(?<=spdx-licen[sc]e-identifier\s{0,9}:[^\n]{0,400})", 2, 1.0),
    ("notice", r"(?:licen[sc]ed|released|distributed|available|published|provided|covered|redistribut\w+)(?: \w+){0,3} (?:under|by|with) (?:the )?(?:terms of )?(?:the |an? )?", "", 3, 0.95),
    ("header", r"(?:^|\n)[^\S\n]*+(?:# ?|// ?|\* ?)?licen[sc]e ?[:=] ?(?:the )?", "", 4, 0.9),
    ("mention", "", "", 5, 0.7),
]
#: One of these is part of every keyword.
_PARTS = ["licen", "lizenz", "copyright", "domain", "reserved", "commons", "cc by", "cc-by", "cc0", "gpl", "permission", "redistribut", "proprietary", "warrant", "openrail", "cecill", "w3c", "not be", "unauthori"]
#: The same for ids; a word of the text begins so.
ID_ANCHORS = sorted({re.split("[- ]", k)[0] for _, k, _ in IDS})
ANCHORS = _PARTS + ID_ANCHORS


def rules() -> list[dict]:
    """All rules, most important first. Longer signatures of a form go first."""
    out = []
    for form, before, after, priority, confidence in FORMS:
        # ids are no mentions, and a tag is followed by an id, not by a sentence
        here = (NAMES if form not in ("tag", "operand") else [x for x in NAMES if len(x[2].split(" ")) == 1 or x[1].startswith("cc")]) + (IDS if form != "mention" else [])
        for rank, (label, keyword, signature) in enumerate(sorted(here, key=lambda x: -len(x[2]))):
            start = before.replace("(?:under|by|with)", "under") if (label, keyword, signature) in IDS else before
            body = rf"{start}(?<![a-z0-9])(?:{signature})(?![a-z0-9]){after}"
            out.append({"label": label, "keyword": keyword, "regex": re.sub(r" (\?)?", lambda m: r"\s*+" if m[1] else r"\s++", body), "priority": priority * 1000 + rank, "confidence": confidence})
    return out


def _lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)


def _spaced(lowered: Column) -> Column:
    """Words, each with a space before and behind."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(lowered, _NOT_WORD, " ")), F.lit(" "))


def _base_places(words: Column, phrase: str) -> Column:
    parts = phrase.split(" ")

    def here(i):
        cond = F.get(words, i) == parts[0]
        for k in range(1, len(parts)):
            cond = cond & (F.coalesce(F.get(words, i + k), F.lit("")) == parts[k])
        return cond

    return F.filter(F.sequence(F.lit(0), F.size(words) - 1), here)


def _places(text: Column, rule: Column) -> Column:
    """Every place of a rule: start and end in characters."""
    found = F.regexp_extract_all(text, rule.regex, F.lit(0))
    gaps = F.split(text, rule.regex, -1)
    steps = F.zip_with(gaps, found, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("len")))
    real = F.filter(steps, lambda x: x["len"].isNotNull())

    def walk(part, begin):
        start = F.struct(begin.alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))
        return F.aggregate(
            part,
            start,
            lambda a, x: F.struct((a.at + x["gap"] + x["len"]).alias("at"), F.array_append(a.out, F.struct((a.at + x["gap"]).alias("start"), (a.at + x["gap"] + x["len"]).alias("end"))).alias("out")),
            lambda a: a.out,
        )

    widths = F.transform(_chunks(real), lambda c: F.aggregate(c, F.lit(0), lambda a, x: a + x["gap"] + x["len"]))
    begins = F.transform(widths, lambda w, i: F.aggregate(F.slice(widths, F.lit(1), i), F.lit(0), lambda a, x: a + x))
    every = F.when(F.size(real) <= CHUNK, walk(real, F.lit(0))).otherwise(F.flatten(F.zip_with(_chunks(real), begins, walk)))
    return F.transform(every, lambda p: F.struct(p.start.alias("start"), (-p.end).alias("minus_end"), rule.priority.alias("priority"), rule.label.alias("label"), rule.confidence.alias("confidence")))


#: Steps that one fold takes: what it appends to is copied each time.
CHUNK = 256
_PLACE = "struct<start:int,minus_end:int,priority:int,label:string,confidence:double>"


def _chunks(items: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.greatest(F.floor((F.size(items) - 1) / CHUNK).cast("int"), F.lit(0))), lambda k: F.slice(items, k * CHUNK + 1, CHUNK))


def _outermost(places: Column) -> Column:
    """Places that lie in none of a higher priority: a sweep from left to right.

    In the order of start, then longest, then priority, what holds a place
    stands before it, and only places that have not ended need be looked at.
    """
    none = F.array().cast(f"array<{_PLACE}>")

    def step(a, d):
        live = F.filter(a.live, lambda h: h.minus_end < -d.start)
        inside = F.exists(live, lambda h: (h.priority < d.priority) & (h.minus_end <= d.minus_end))
        return F.struct(F.array_append(live, d).alias("live"), F.when(inside, a.out).otherwise(F.array_append(a.out, d)).alias("out"))

    def sweep(part, live):
        return F.aggregate(part, F.struct(live.alias("live"), none.alias("out")), step)

    in_order = F.array_sort(places)
    start = F.struct(none.alias("live"), F.array().cast(f"array<array<{_PLACE}>>").alias("out"))
    chunked = F.aggregate(_chunks(in_order), start, lambda a, c: F.transform(F.array(sweep(c, a.live)), lambda x: F.struct(x.live.alias("live"), F.array_append(a.out, x.out).alias("out")))[0], lambda a: F.flatten(a.out))
    kept = F.when(F.size(places) <= 1, places).when(F.size(places) <= CHUNK, sweep(in_order, none).out).otherwise(chunked)
    return F.transform(kept, lambda d: F.struct(d.priority.alias("priority"), d.label.alias("label"), d.confidence.alias("confidence"), d.start.alias("start"), (-d.minus_end).alias("end")))


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``doc_id, n_words``, base places and the detections of the rules."""
    table = F.from_json(F.lit(json.dumps(rules())), "array<struct<label:string,keyword:string,regex:string,priority:int,confidence:double>>")
    low = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _lowered(F.col(f"`{text_col}`").cast("string")).alias("low"))
    spaced = low.withColumn("spaced", _spaced(F.col("low")))
    s = F.col("spaced")
    n_words = F.when(F.length(s) <= 2, 0).otherwise(F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit(""))) - 1).cast("long")
    any_phrase = F.lit(False)
    for p, _ in PHRASES:
        any_phrase = any_phrase | s.contains(f" {p} ")
    any_anchor = F.lit(False)
    for a in _PARTS:  # white space may be a line's end: "cc by" is looked for among the words
        any_anchor = any_anchor | (s.contains(f" {a} ") if " " in a else F.col("low").contains(a))
    stated = F.lit(False)  # an id counts behind a tag or header, which have "licen", or behind "under"
    for a in ID_ANCHORS:
        stated = stated | s.contains(f" {a}")
    any_anchor = any_anchor | (s.contains(" under ") & stated)
    none = F.array().cast("array<int>")
    words = spaced.select("doc_id", n_words.alias("n_words"), F.when(any_anchor, F.col("low")).alias("low"), F.when(any_anchor, F.regexp_replace("low", r"\s+", " ")).alias("flat"), F.when(any_phrase, F.split(F.trim(s), " ")).alias("words"))
    hit = words.select(
        "doc_id",
        "n_words",
        *[F.when(F.col("words").isNotNull(), _base_places(F.col("words"), p)).otherwise(none).alias(f"base_{i}") for i, (p, _) in enumerate(PHRASES)],
        F.when(
            F.col("low").isNotNull(),
            F.flatten(F.transform(F.filter(table, lambda r: F.col("flat").contains(r.keyword) & F.call_function("rlike", F.col("low"), r.regex)), lambda r: _places(F.col("low"), r))),
        ).alias("all"),
    )
    empty = F.array().cast("array<struct<priority:int,label:string,confidence:double,start:int,end:int>>")
    return hit.select("doc_id", "n_words", *[f"base_{i}" for i in range(len(PHRASES))], F.when(F.size("all") > 0, _outermost(F.col("all"))).otherwise(empty).alias("detections"))


def digest(found: DataFrame) -> DataFrame:
    bases = [F.col(f"base_{i}") for i in range(len(PHRASES))]
    places = F.concat(*bases)
    base = F.array_compact(F.array(*[F.when(F.size(b) > 0, F.lit(label)) for b, (_, label) in zip(bases, PHRASES, strict=True)]))
    listed = lambda x: F.array_join(F.array_sort(F.array_distinct(x)), ",")
    score = F.greatest(F.coalesce(F.array_max(F.transform("detections", lambda d: d.confidence)), F.lit(0.0)), F.when(F.size(places) > 0, 0.5).otherwise(0.0))
    return found.select(
        "doc_id",
        "n_words",
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        listed(base).alias("base_labels"),
        listed(F.concat(base, F.transform("detections", lambda d: d.label))).alias("labels"),
        score.cast("double").alias("score"),
    )


def op9_query(spark, sf_dir: str) -> DataFrame:
    return digest(scan(spark.read.parquet(f"{sf_dir}/documents.parquet")))
