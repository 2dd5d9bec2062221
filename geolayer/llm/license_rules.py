"""Signature rules of licenses, written over lower-case words with one blank between them.

Families are written by hand; the rules of a family are its tag, grant, name, short and link forms,
with each of its versions. Together with the passages of license texts they make some hundred rules,
ordered by how sure they are. A rule names one word that every match of it holds.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

_LICENSE = "licen[cs]e"
_TERMS = "(?: the)?(?: terms(?: and conditions)? of)?(?: the)?"
_GRANTED = "(?:released|distributed|available|published|provided|covered|governed) (?:under|by)" + _TERMS
#: Confidence of each form, surest first; the place in this order is the first part of the rank.
FORMS = {"tag": 1.0, "text": 0.95, "grant": 0.95, "link": 0.9, "version": 0.9, "name": 0.8, "short": 0.7}


@dataclass(frozen=True)
class Family:
    """A license and its versions: pattern of the name, words of its tag, page below ``link``."""

    label: str
    name: str
    versions: tuple[str, ...] = ()
    tag: str | None = None
    link: str | None = None
    #: Abbreviation that is used without the word license, and the pattern with it.
    short: tuple[str, str] | None = None
    #: Words of which every match of ``name`` holds one, where they are not its first ones.
    words: tuple[str, ...] = ()


@dataclass(frozen=True)
class Rule:
    """``rank`` orders rules. Every match of ``pattern`` holds one of the words ``keywords``, and the
    letters ``stem`` (a pattern over raw text in any case)."""

    rank: int
    label: str
    confidence: float
    keywords: tuple[str, ...]
    stem: str
    pattern: str


_OSI, _GNU, _CC = "opensource org licenses?", "gnu org licenses", "creativecommons org"
_GNU_VERSIONS = {"gpl": ("1", "2", "3"), "lgpl": ("2", "2 1", "3"), "agpl": ("1", "3")}

FAMILIES = [
    Family("mit", "mit(?: x11| expat)?", (), "mit", f"{_OSI} mit"),
    Family("mit-0", "mit no attribution", (), "mit 0", f"{_OSI} mit 0"),
    Family("x11", "x11", (), "x11"),
    Family("apache", "apache(?: software)?", ("1 0", "1 1", "2 0"), "apache", "apache org licenses license",
           ("apache", "apache")),
    Family("gpl", "(?:gnu )?(?:general public|gpl)", _GNU_VERSIONS["gpl"], "gpl", f"{_GNU} gpl",
           ("gpl", "(?:gnu )?gpl")),
    Family("lgpl", "(?:gnu )?(?:(?:lesser|library) general public|lgpl)", _GNU_VERSIONS["lgpl"], "lgpl",
           f"{_GNU} lgpl", ("lgpl", "(?:gnu )?lgpl")),
    Family("agpl", "(?:gnu )?(?:affero general public|agpl)", _GNU_VERSIONS["agpl"], "agpl", f"{_GNU} agpl",
           ("agpl", "(?:gnu )?agpl")),
    Family("gfdl", "(?:gnu )?free documentation", ("1 1", "1 2", "1 3"), "gfdl", f"{_GNU} fdl",
           ("gfdl", "(?:gnu )?gfdl")),
    Family("bsd", "(?:original |modified |new |simplified )?bsd(?: style)?"),
    Family("0bsd", "(?:zero clause bsd|0bsd|bsd zero clause)", (), "0bsd", f"{_OSI} 0bsd"),
    Family("bsd-2-clause", "(?:(?:simplified|freebsd) bsd|bsd 2 clause|2 clause bsd|two clause bsd)", (),
           "bsd 2 clause", f"{_OSI} bsd 2 clause"),
    Family("bsd-3-clause", "(?:(?:modified|revised|new) bsd|bsd 3 clause|3 clause bsd|three clause bsd)",
           (), "bsd 3 clause", f"{_OSI} bsd 3 clause"),
    Family("bsd-4-clause", "(?:bsd 4 clause|4 clause bsd|four clause bsd)", (), "bsd 4 clause"),
    Family("isc", "isc", (), "isc", f"{_OSI} isc"),
    Family("mpl", "(?:mozilla public|mpl)", ("1 0", "1 1", "2 0"), "mpl"),
    Family("epl", "(?:eclipse public|epl)", ("1 0", "2 0"), "epl"),
    Family("edl", "eclipse distribution", ("1 0",)),
    Family("cddl", "common development and distribution", ("1 0", "1 1"), "cddl", f"{_OSI} cddl",
           ("cddl", "cddl")),
    Family("cpl", "common public", ("1 0",), "cpl", f"{_OSI} cpl"),
    Family("ipl", "ibm public", ("1 0",), "ipl"),
    Family("eupl", "european union public", ("1 0", "1 1", "1 2"), "eupl", None, ("eupl", "eupl")),
    Family("cecill", "cecill(?: [bc])?", ("1 0", "2 0", "2 1"), "cecill", "cecill info licences", None, ("cecill",)),
    Family("artistic", "(?:perl )?artistic", ("1 0", "2 0"), "artistic", f"{_OSI} artistic"),
    Family("psf", "python software foundation", ("2 0",), "psf"),
    Family("python", "python", ("2 0", "2 0 1"), "python"),
    Family("zlib", "zlib(?: libpng)?", (), "zlib", f"{_OSI} zlib"),
    Family("libpng", "libpng", ("2 0",), "libpng"),
    Family("bsl", "boost software", ("1 0",), "bsl"),
    Family("busl", "business source", ("1 0", "1 1"), "busl"),
    Family("unlicense", "(?:the )?unlicense", (), "unlicense", None, ("unlicense", "(?:the )?unlicense")),
    Family("wtfpl", "(?:do what the fuck you want to public|wtfpl)", ("2",), "wtfpl", None,
           ("wtfpl", "wtfpl")),
    Family("cc0", "(?:creative commons zero|cc0)", ("1 0",), "cc0", f"{_CC} publicdomain zero",
           ("cc0", "cc0")),
    Family("odbl", "(?:open database|odbl)", ("1 0",), "odbl", "opendatacommons org licenses odbl", ("odbl", "odbl")),
    Family("odc-by", "(?:open data commons attribution|odc by)", ("1 0",), "odc by",
           "opendatacommons org licenses by"),
    Family("pddl", "public domain dedication and", ("1 0",), "pddl", "opendatacommons org licenses pddl"),
    Family("ofl", "(?:sil )?open font", ("1 0", "1 1"), "ofl"),
    Family("ms-pl", "microsoft public", (), "ms pl", f"{_OSI} ms pl"),
    Family("ms-rl", "microsoft reciprocal", (), "ms rl", f"{_OSI} ms rl"),
    Family("ncsa", "(?:university of illinois ncsa|ncsa)(?: open source)?", (), "ncsa", f"{_OSI} ncsa"),
    Family("postgresql", "postgresql", (), "postgresql", f"{_OSI} postgresql"),
    Family("php", "php", ("3 0", "3 01"), "php", None),
    Family("ruby", "ruby", (), "ruby"),
    Family("openssl", "openssl", (), "openssl"),
    Family("curl", "curl", (), "curl"),
    Family("w3c", "w3c(?: software)?(?: notice and)?", (), "w3c"),
    Family("zpl", "zope public", ("2 0", "2 1"), "zpl"),
    Family("osl", "open software", ("1 0", "2 0", "2 1", "3 0"), "osl", f"{_OSI} osl"),
    Family("afl", "academic free", ("1 1", "2 0", "2 1", "3 0"), "afl", f"{_OSI} afl"),
    Family("apsl", "apple public source", ("1 0", "1 1", "1 2", "2 0"), "apsl"),
    Family("qpl", "q public", ("1 0",), "qpl"),
    Family("sspl", "server side public", ("1 0", "1"), "sspl", None, ("sspl", "sspl")),
    Family("elastic", "elastic", ("1 0", "2 0"), "elastic"),
    Family("rpl", "reciprocal public", ("1 1", "1 5"), "rpl"),
    Family("upl", "universal permissive", ("1 0",), "upl", f"{_OSI} upl"),
    Family("ecl", "educational community", ("1 0", "2 0"), "ecl", f"{_OSI} ecl"),
    Family("lppl", "latex project public", ("1 0", "1 2", "1 3c"), "lppl"),
    Family("nasa", "nasa open source", ("1 3",), "nasa"),
    Family("sissl", "sun industry standards source", ("1 1", "1 2"), "sissl"),
    Family("vim", "vim", (), "vim"),
    Family("tcl", "tcl(?: tk)?", (), "tcl"),
    Family("icu", "icu", (), "icu"),
    Family("json", "json", (), "json"),
    Family("beerware", "beer ?ware", (), "beerware", None, None, ("beerware", "beer")),
    Family("bzip2", "bzip2", ("1 0 5", "1 0 6"), "bzip2"),
    Family("info-zip", "info zip", (), "info zip"),
    Family("ijg", "independent jpeg group", (), "ijg"),
    Family("libtiff", "libtiff", (), "libtiff"),
    Family("mulan", "mulan permissive software", ("1", "2"), "mulanpsl"),
    Family("ogl-uk", "open government", ("1 0", "2 0", "3 0"), "ogl uk",
           "nationalarchives gov uk doc open government licence"),
    Family("etalab", "(?:etalab|licence ouverte)", ("1 0", "2 0"), "etalab"),
    Family("openrail", "(?:bigscience |creativeml )?open ?rail(?: m)?", (), "openrail", None, None,
           ("openrail", "open")),
    Family("cal", "cryptographic autonomy", ("1 0",), "cal"),
]

#: Creative Commons conditions by tag: the words they are written out with.
CONDITIONS = {
    "by": "attribution", "by sa": "attribution share ?alike", "by nd": "attribution no ?deriv(?:ative|s)?s?",
    "by nc": "attribution non ?commercial", "by nc sa": "attribution non ?commercial share ?alike",
    "by nc nd": "attribution non ?commercial no ?deriv(?:ative|s)?s?"}
#: The abbreviation in raw text: two words with anything of ASCII between that is no letter or digit.
CC_STEM = r"cc[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+by"
CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")

#: Passages of license texts and notices: label, keyword, stem, pattern.
PASSAGES = [
    ("mit", "hereby", "hereby",
     "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("isc", "hereby", "hereby",
     "permission to use copy modify and or distribute this software for any purpose with or without fee is "
     "hereby granted"),
    ("hpnd", "hereby", "hereby",
     "permission to use copy modify and distribute this software and its documentation for any "
     "purpose(?: and without fee)? is hereby granted"),
    ("bsl-1.0", "hereby", "hereby",
     "permission is hereby granted free of charge to any person or organization obtaining a copy"),
    ("bsd", "redistribution", "redistribution",
     "redistribution and use in source and binary forms with or without modification"),
    ("gpl", "redistribute", "licen",
     "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "redistribute", "licen",
     "you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general "
     "public license"),
    ("agpl", "redistribute", "licen",
     "you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("apache-2.0", "compliance", "licen",
     "you may not use this file except in compliance with the license"),
    ("mpl-2.0", "mozilla", "licen",
     "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("public-domain", "domain", "domain",
     "(?:released|placed|dedicated|put) (?:in|into|to) the public domain"),
    ("public-domain", "domain", "domain",
     "this (?:work|file|software|text|code) is in the public domain"),
    ("all-rights-reserved", "reserved", "reserved", "all rights (?:are )?reserved"),
    ("proprietary", "proprietary", "licen", f"proprietary {_LICENSE}"),
]


def leading_words(pattern: str) -> tuple[str, ...]:
    """First words of what a pattern of words, blanks, groups and optional groups can match."""
    pattern = re.sub(r"^(?:\(\?:[^()]*\)\?)+", "", pattern)
    if not pattern.startswith("(?:"):
        return (re.match(r"\w+", pattern).group(),)
    depth, at, parts = 0, 3, []
    for i, c in enumerate(pattern):
        depth += (c == "(") - (c == ")")
        if depth == 1 and c == "|" or depth == 0:
            parts.append(pattern[at:i])
            at = i + 1
            if depth == 0:
                break
    return tuple(dict.fromkeys(w for part in parts for w in leading_words(part)))


def _version(words: str) -> str:
    more = "(?: 0)?" if " " not in words else ""
    return f"(?: version| ver| v)? v?{words}{more}(?: only| or later)?"


def _built() -> list[Rule]:
    found: list[tuple[str, str, tuple[str, ...], str, str]] = []

    def add(form: str, label: str, keywords: tuple[str, ...], stem: str, pattern: str) -> None:
        found.append((form, label, keywords, stem, pattern))

    for f in FAMILIES:
        words = f.words or leading_words(f.name)
        editions = [(f"{f.label}-{v.replace(' ', '.')}", _version(v), v) for v in f.versions]
        for label, version, v in [(f.label, "", ""), *editions]:
            last = f" {v}" if v else ""
            if f.tag:
                tagged = last + ("(?: 0)?" if v and " " not in v else "") + "(?: only| or later)?"
                add("tag", label, (f.tag.split()[0],), "spdx",
                    f"spdx {_LICENSE} identifier {f.tag}{tagged}")
            if f.link:
                # The first word that is spelt out; pages of licenses hold that word too.
                stem = "licen" if "licen" in f.link else f.link.split()[0]
                add("link", label, (f.link.split()[0],), stem, f.link + last)
            add("version" if v else "name", label, words, "licen", f"{f.name} {_LICENSE}{version}")
            add("grant", label, words, "licen",
                f"(?:(?:dual )?licensed (?:under|by){_TERMS} {f.name}(?: {_LICENSE})?"
                f"|{_GRANTED} {f.name} {_LICENSE}){version}")
            if f.short and (v or f.short[0] != "apache"):
                word, name = f.short
                add("short", label, (word,), word, name + version)
                if v and " " not in v:
                    add("short", label, (f"{word}v{v}",), word, f"{word}v{v}(?: or later| only)?")
    for tag, long in CONDITIONS.items():
        plain = "cc-" + tag.replace(" ", "-")
        for v in ("", *CC_VERSIONS):
            label = plain + (f"-{v.replace(' ', '.')}" if v else "")
            last = f" {v}" if v else ""
            named = f"(?:(?: {_LICENSE})? {v}|{last}(?: international)?(?: public)? {_LICENSE})"
            add("tag", label, ("cc",), "spdx", f"spdx {_LICENSE} identifier cc {tag}{last}")
            add("link", label, ("creativecommons",), "licen", f"{_CC} licenses {tag}{last}")
            add("grant", label, ("cc", "creative"), "licen",
                f"licensed (?:under|by){_TERMS}(?: a)? (?:cc|creative commons) (?:{tag}|{long})"
                f"(?: {_LICENSE})?{last}")
            add("version" if v else "name", label, ("creative",), "licen" if not v else "creative",
                f"creative commons {long}" + (named if v else f"(?: public)? {_LICENSE}"))
            add("short", label, ("cc",), CC_STEM, f"cc {tag}{last}")
    for label, keyword, stem, pattern in PASSAGES:
        add("text", label, (keyword,), stem, pattern)
    forms = list(FORMS)
    found.sort(key=lambda r: forms.index(r[0]))
    return [Rule(k, label, FORMS[form], *rest) for k, (form, label, *rest) in enumerate(found)]


RULES: list[Rule] = _built()
