"""Signature rules for license names, notices and texts.

A pattern is matched against lower-case words joined by single spaces. Each rule names a keyword that
its match contains, by which rules are picked before any pattern runs, and a rank: 3 for license
texts and tags that name one license exactly, 2 for a name with its version, 1 for a bare name.
"""

from __future__ import annotations

from dataclasses import dataclass

GRANT = r"(?:licen[cs]ed under|under the terms of|released under|distributed under|available under|covered by|subject to)(?: the)?(?: terms of the)?"
LATER = r"(?: or (?:at your option )?(?:any )?later(?: versions?)?)"


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    keyword: str
    pattern: str
    rank: int
    weight: float


def version_pattern(version: str) -> str:
    major, _, minor = version.partition(".")
    tail = "" if not minor else rf"(?: {minor})?" if minor == "0" else rf" {minor}"
    return rf"(?:(?:version|v|ver|revision) )?v?{major}{tail}"


#: Families with numbered versions: label, keyword, name pattern, versions, short form.
VERSIONED = (
    ("apache", "license", r"apache(?: software)? license", ("1.0", "1.1", "2.0"), "apache"),
    ("lgpl", "license", r"(?:gnu )?(?:lesser|library) general public license", ("2.0", "2.1", "3.0"), "lgpl"),
    ("agpl", "license", r"(?:gnu )?affero general public license", ("1.0", "3.0"), "agpl"),
    ("gpl", "license", r"(?:gnu )?general public license", ("1.0", "2.0", "3.0"), "gpl"),
    ("gfdl", "license", r"(?:gnu )?free documentation license", ("1.1", "1.2", "1.3"), "gfdl"),
    ("mpl", "license", r"mozilla public license", ("1.0", "1.1", "2.0"), "mpl"),
    ("epl", "license", r"eclipse public license", ("1.0", "2.0"), "epl"),
    ("cpl", "license", r"common public license", ("1.0",), "cpl"),
    ("ipl", "license", r"ibm public license", ("1.0",), "ipl"),
    ("cddl", "license", r"common development and distribution license", ("1.0", "1.1"), "cddl"),
    ("artistic", "license", r"artistic license", ("1.0", "2.0"), "artistic"),
    ("bsl", "license", r"boost software license", ("1.0",), "bsl"),
    ("ofl", "license", r"(?:sil )?open font license", ("1.0", "1.1"), "ofl"),
    ("osl", "license", r"open software license", ("1.0", "1.1", "2.0", "2.1", "3.0"), "osl"),
    ("afl", "license", r"academic free license", ("1.1", "1.2", "2.0", "2.1", "3.0"), "afl"),
    ("zpl", "license", r"zope public license", ("1.1", "2.0", "2.1"), "zpl"),
    ("php", "license", r"php license", ("3.0", "3.1"), "php"),
    ("w3c", "license", r"w3c software(?: notice and)? license", ("1.0", "2.0"), "w3c"),
    ("lppl", "license", r"latex project public license", ("1.0", "1.1", "1.2", "1.3"), "lppl"),
    ("npl", "license", r"netscape public license", ("1.0", "1.1"), "npl"),
    ("spl", "license", r"sun public license", ("1.0",), "spl"),
    ("upl", "license", r"universal permissive license", ("1.0",), "upl"),
    ("cecill", "license", r"cecill(?: free software)? license", ("1.0", "1.1", "2.0", "2.1"), "cecill"),
    ("sspl", "license", r"server side public license", ("1.0",), "sspl"),
    ("busl", "license", r"business source license", ("1.1",), "busl"),
    ("eupl", "licence", r"european union public licence", ("1.0", "1.1", "1.2"), "eupl"),
    ("ogl", "licence", r"open government licence", ("1.0", "2.0", "3.0"), "ogl"),
    ("odbl", "license", r"(?:open data commons )?open database license", ("1.0",), "odbl"),
    ("python", "license", r"python(?: software foundation)? license", ("2.0",), "psf"),
    ("ecl", "license", r"educational community license", ("1.0", "2.0"), "ecl"),
    ("rpl", "license", r"reciprocal public license", ("1.1", "1.5"), "rpl"),
    ("apsl", "license", r"apple public source license", ("1.0", "1.1", "1.2", "2.0"), "apsl"),
)

#: Families without versions: label, keyword, pattern, rank, weight.
PLAIN = (
    ("mit", "license", r"(?:the )?(?:mit|expat|x11) license", 1, 0.9),
    ("mit", "permission", r"permission is hereby granted free of charge to any person obtaining a copy", 3, 1.0),
    ("mit", "warranty", r"the software is provided as is without warranty of any kind", 2, 0.8),
    ("mit", "licensed", r"licensed under mit", 1, 0.9),
    ("isc", "license", r"(?:the )?isc license", 1, 0.9),
    ("isc", "permission", r"permission to use copy modify and or distribute this software for any purpose", 3, 1.0),
    ("bsd", "license", r"(?:the )?(?:modified |new |simplified |revised )?bsd(?: style)? license", 1, 0.9),
    ("bsd-2-clause", "license", r"(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd)(?: license)", 2, 0.95),
    ("bsd-3-clause", "license", r"(?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|revised bsd)(?: license)", 2, 0.95),
    ("bsd-4-clause", "license", r"(?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd)(?: license)", 2, 0.95),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification", 3, 1.0),
    ("bsd-3-clause", "endorse", r"may be used to endorse or promote products derived from this software", 2, 0.9),
    ("apache-2.0", "apache", r"apache org licenses license 2 0", 3, 1.0),
    ("gpl", "gnu", r"gnu org licenses(?: old licenses)? gpl", 3, 0.9),
    ("lgpl", "gnu", r"gnu org licenses(?: old licenses)? lgpl", 3, 0.9),
    ("agpl", "gnu", r"gnu org licenses agpl", 3, 0.9),
    ("mpl", "mozilla", r"mozilla org mpl", 3, 0.9),
    ("unlicense", "unlicense", r"(?:the )?unlicense", 2, 0.9),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain", 3, 1.0),
    ("wtfpl", "wtfpl", r"wtfpl", 2, 0.9),
    ("zlib", "license", r"zlib(?: libpng)? license", 1, 0.9),
    ("zlib", "warranty", r"provided as is without any express or implied warranty", 2, 0.8),
    ("openssl", "license", r"openssl license", 1, 0.9),
    ("ruby", "license", r"ruby license", 1, 0.8),
    ("postgresql", "license", r"postgresql license", 1, 0.9),
    ("ncsa", "license", r"(?:university of illinois ncsa|ncsa) open source license", 1, 0.9),
    ("ms-pl", "license", r"microsoft public license", 1, 0.9),
    ("ms-rl", "license", r"microsoft reciprocal license", 1, 0.9),
    ("beerware", "license", r"beer ?ware license", 1, 0.9),
    ("json", "license", r"json license", 1, 0.8),
    ("vim", "license", r"vim license", 1, 0.8),
    ("curl", "license", r"curl license", 1, 0.8),
    ("hpnd", "permission", r"permission to use copy modify and distribute this software and its documentation", 3, 0.95),
    ("proprietary", "reserved", r"all rights reserved", 1, 0.4),
    ("proprietary", "license", r"(?:end user license agreement|commercial license|proprietary license)", 1, 0.6),
    ("public-domain", "domain", r"(?:dedicated to|released into|placed in) the public domain", 2, 0.8),
    ("cc0-1.0", "cc0", r"cc0(?: 1 0)?(?: universal)?", 2, 0.9),
    ("cc0-1.0", "publicdomain", r"creativecommons org publicdomain zero 1 0", 3, 1.0),
)

CC_PARTS = {"by": "attribution", "sa": "share ?alike", "nc": "non ?commercial", "nd": "no ?deriv(?:ative)?s?(?: works)?"}
CC_KINDS = (("by",), ("by", "sa"), ("by", "nd"), ("by", "nc"), ("by", "nc", "sa"), ("by", "nc", "nd"))
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")


def rules() -> list[Rule]:
    """All rules: some written out above, the others from families, versions and forms."""
    out: list[Rule] = []

    def add(label: str, keyword: str, pattern: str, rank: int, weight: float) -> None:
        out.append(Rule(f"{label}-{keyword}-{len(out)}", label, keyword, pattern, rank, weight))

    for label, keyword, name, versions, short in VERSIONED:
        add(label, keyword, name, 1, 0.8)
        for version in versions:
            number = version_pattern(version)
            add(f"{label}-{version}", keyword, rf"{name} {number}", 2, 0.95)
            add(f"{label}-{version}-or-later", keyword, rf"{name} {number}{LATER}", 3, 1.0)
            add(f"{label}-{version}", "licensed", rf"licensed under(?: the)? {short} {number}", 2, 0.9)
            add(f"{label}-{version}", "spdx", rf"spdx license identifier {short} {version.replace('.', ' ')}(?: only| or later)?", 3, 1.0)
        add(label, "licensed", rf"licensed under(?: the)? {short}", 1, 0.8)
    for label, keyword, pattern, rank, weight in PLAIN:
        add(label, keyword, pattern, rank, weight)
    for parts in CC_KINDS:
        kind = "-".join(parts)
        short, long_ = " ".join(parts), " ".join(CC_PARTS[p] for p in parts)
        for version in CC_VERSIONS:
            number, label = version.replace(".", " "), f"cc-{kind}-{version}"
            add(label, "cc", rf"cc {short} {number}", 2, 0.95)
            add(label, "commons", rf"creative commons {long_} {number}", 2, 0.95)
            add(label, "creativecommons", rf"creativecommons org licenses {short} {number}", 3, 1.0)
            add(label, "spdx", rf"spdx license identifier cc {short} {number}", 3, 1.0)
        add(f"cc-{kind}", "commons", rf"creative commons {long_}", 1, 0.8)
    for short, label in (("mit", "mit"), ("isc", "isc"), ("bsd 2 clause", "bsd-2-clause"), ("bsd 3 clause", "bsd-3-clause"), ("zlib", "zlib"), ("unlicense", "unlicense")):
        add(label, "spdx", rf"spdx license identifier {short}", 3, 1.0)
    return out
