"""Names of licences: identifiers, the one form a label has, and the phrases of notices.

Identifiers and phrases of versioned families are made from the family's name and
versions; users may pass tables of their own to the scanner instead.
"""

from __future__ import annotations

#: Families with their versions (fixed values).
VERSIONED = {
    "afl": "1.1 1.2 2.0 2.1 3.0",
    "apache": "1.0 1.1 2.0",
    "apsl": "1.0 1.1 1.2 2.0",
    "artistic": "1.0 2.0",
    "bsl": "1.0",
    "busl": "1.1",
    "cddl": "1.0 1.1",
    "cecill": "1.0 1.1 2.0 2.1 b c",
    "cpal": "1.0",
    "cpl": "1.0",
    "ecl": "1.0 2.0",
    "efl": "1.0 2.0",
    "elastic": "2.0",
    "epl": "1.0 2.0",
    "eupl": "1.0 1.1 1.2",
    "ipl": "1.0",
    "lppl": "1.0 1.1 1.2 1.3a 1.3c",
    "mpl": "1.0 1.1 2.0 2.0-no-copyleft-exception",
    "mulanpsl": "1.0 2.0",
    "odbl": "1.0",
    "odc-by": "1.0",
    "ofl": "1.0 1.1",
    "ogl-uk": "1.0 2.0 3.0",
    "osl": "1.0 1.1 2.0 2.1 3.0",
    "pddl": "1.0",
    "php": "3.0 3.01",
    "psf": "2.0",
    "python": "2.0",
    "rpl": "1.1 1.5",
    "sspl": "1.0",
    "unicode-dfs": "2015 2016",
    "upl": "1.0",
    "zend": "2.0",
    "zpl": "1.1 2.0 2.1",
}
#: Families that may be had in their version only or in a later one too (fixed values).
GNU = {"agpl": "1.0 3.0", "gfdl": "1.1 1.2 1.3", "gpl": "1.0 2.0 3.0", "lgpl": "2.0 2.1 3.0"}
CC = ("cc-by", "cc-by-nc", "cc-by-nc-nd", "cc-by-nc-sa", "cc-by-nd", "cc-by-sa")
CC_VERSIONS = "1.0 2.0 2.5 3.0 4.0"
#: Identifiers that belong to no such family (fixed values).
SINGLE = (
    "0bsd aal beerware blueoak-1.0.0 bsd-1-clause bsd-2-clause bsd-2-clause-patent bsd-2-clause-views bsd-3-clause "
    "bsd-3-clause-attribution bsd-3-clause-clear bsd-3-clause-lbnl bsd-4-clause bsd-4-clause-uc bsd-source-code "
    "bzip2-1.0.6 cal-1.0 cc-pddc cc0-1.0 curl fair freeimage ftl hpnd icu ijg imagemagick intel isc json libpng "
    "libpng-2.0 libtiff linux-openib miros mit mit-0 mit-advertising mit-cmu mit-feh ms-pl ms-rl ncsa netcdf ntp "
    "oldap-2.8 openssl postgresql qpl-1.0 ruby sgi-b-2.0 sissl sleepycat tcl unicode-3.0 unlicense vim w3c wtfpl x11 "
    "zlib zlib-acknowledgement"
).split()
#: Licences that allow free use, changes and passing on without the source (fixed values).
PERMISSIVE = frozenset(
    "0bsd afl-3.0 apache apache-1.0 apache-1.1 apache-2 apache-2.0 artistic-2.0 blueoak-1.0.0 bsd bsd-1-clause bsd-2-clause "
    "bsd-2-clause-patent bsd-2-clause-views bsd-3-clause bsd-3-clause-attribution bsd-3-clause-clear bsd-4-clause bsl-1.0 "
    "cc-by cc-by-1.0 cc-by-2.0 cc-by-2.5 cc-by-3.0 cc-by-4.0 cc-pddc cc0-1.0 curl ftl hpnd icu ijg isc libpng libpng-2.0 "
    "libtiff mit mit-0 ms-pl mulanpsl-2.0 ncsa ntp odc-by-1.0 pddl-1.0 php-3.01 postgresql psf-2.0 public-domain python-2.0 "
    "unicode-3.0 unlicense upl-1.0 w3c wtfpl x11 zlib zpl-2.1".split()
)
#: Names that notices use for families: the name, the label, the versions it is written with (fixed values).
NAMES = (
    ("academic free license", "afl"),
    ("apache license", "apache"),
    ("apache software license", "apache"),
    ("artistic license", "artistic"),
    ("boost software license", "bsl"),
    ("business source license", "busl"),
    ("common development and distribution license", "cddl"),
    ("common public license", "cpl"),
    ("eclipse public license", "epl"),
    ("educational community license", "ecl"),
    ("elastic license", "elastic"),
    ("european union public licence", "eupl"),
    ("european union public license", "eupl"),
    ("mozilla public license", "mpl"),
    ("open database license", "odbl"),
    ("open software license", "osl"),
    ("php license", "php"),
    ("python software foundation license", "psf"),
    ("server side public license", "sspl"),
    ("sil open font license", "ofl"),
    ("universal permissive license", "upl"),
    ("zope public license", "zpl"),
)
GNU_NAMES = (
    ("gnu affero general public license", "agpl"),
    ("gnu agpl", "agpl"),
    ("agpl", "agpl"),
    ("gnu free documentation license", "gfdl"),
    ("gnu fdl", "gfdl"),
    ("gnu general public license", "gpl"),
    ("gnu gpl", "gpl"),
    ("gpl", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu library general public license", "lgpl"),
    ("gnu lgpl", "lgpl"),
    ("lgpl", "lgpl"),
)
CC_WORDS = {
    "nc": ("noncommercial", "non commercial"),
    "nd": ("noderivatives", "no derivatives", "noderivs", "no derivs"),
    "sa": ("sharealike", "share alike"),
}
CLAUSES = {"1": "one", "2": "two", "3": "three", "4": "four"}
#: Notices that name or quote one licence (fixed values).
QUOTED = {
    "all rights reserved": "all-rights-reserved",
    "bsd license": "bsd",
    "cc0": "cc0-1.0",
    "cc0 1 0": "cc0-1.0",
    "creative commons zero": "cc0-1.0",
    "do what the fuck you want to public license": "wtfpl",
    "expat license": "mit",
    "isc license": "isc",
    "may be used to endorse or promote products derived from this software": "bsd-3-clause",
    "microsoft public license": "ms-pl",
    "mit license": "mit",
    "modified bsd license": "bsd-3-clause",
    "new bsd license": "bsd-3-clause",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "permission to use copy modify and distribute this software for any purpose with or without fee": "isc",
    "permission to use copy modify and or distribute this software for any purpose with or without fee": "isc",
    "postgresql license": "postgresql",
    "proprietary and confidential": "proprietary",
    "redistribution and use in source and binary forms": "bsd",
    "released into the public domain": "public-domain",
    "revised bsd license": "bsd-3-clause",
    "simplified bsd license": "bsd-2-clause",
    "the unlicense": "unlicense",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "this software is provided as is without any express or implied warranty": "zlib",
    "x11 license": "x11",
    "zlib license": "zlib",
}


def identifiers() -> frozenset[str]:
    """All listed identifiers, in small letters."""
    out = set(SINGLE)
    out |= {f"{family}-{v}" for family, versions in VERSIONED.items() for v in versions.split()}
    out |= {f"{family}-{v}" for family in CC for v in CC_VERSIONS.split()}
    for family, versions in GNU.items():
        out |= {f"{family}-{v}{end}" for v in versions.split() for end in ("", "-only", "-or-later")}
    return frozenset(out)


def label_of(identifier: str, listed: frozenset[str]) -> str | None:
    """The one form of a listed identifier or a reference of the document's own; None for any other word.

    A GNU identifier without an ending means that version only, one with ``+``
    that or a later one. Elsewhere ``+`` leaves the licence as it is. Version 2.0
    of Apache has the label of its notice, ``apache-2``.
    """
    name = identifier.lower()
    if name.startswith(("licenseref-", "documentref-")):
        return name
    plain = name.removesuffix("+")
    if plain not in listed:
        return None
    family, _, version = plain.partition("-")
    if version in GNU.get(family, "").split():
        return plain + ("-or-later" if name.endswith("+") else "-only")
    return "apache-2" if plain == "apache-2.0" else plain


def less_general(labels: set[str], kept: set[str]) -> set[str]:
    """Labels without those of which a versioned or more exact form is there; ``kept`` ones stay."""
    ends = tuple(f"-{d}" for d in "0123456789") + ("-only", "-or-later")
    general = {a for a in labels - kept for b in labels if b.startswith(tuple(a + e for e in ends))}
    return labels - general


def _spoken(version: str) -> list[str]:
    """The words of a version number: 2.0 is also written 2."""
    words = version.replace(".", " ")
    return [words, words.removesuffix(" 0")] if words.endswith(" 0") else [words]


def notices() -> dict[str, str]:
    """Phrases, as words in small letters with one blank between, and their labels."""
    out = dict(QUOTED)
    for name, family in NAMES:
        versions = VERSIONED[family].split()
        out[name] = f"{family}-{versions[0]}" if len(versions) == 1 else family
        for v in versions:
            label = "apache-2" if (family, v) == ("apache", "2.0") else f"{family}-{v}"
            for w in _spoken(v):
                out |= {f"{name}{joint}{w}": label for joint in (" ", " version ", " v", " v ")}
    for name, family in GNU_NAMES:
        short = " " not in name
        if not short:
            out[name] = family
        for v in GNU[family].split():
            for w in _spoken(v):
                forms = [f"{name} version {w}", f"{name} v{w}", f"version {w} of the {name}"]
                forms += [f"{name}v{w}"] if short or name.startswith("gnu ") and len(name.split()) == 2 else []
                out |= {form: f"{family}-{v}" for form in forms}
                later = [f"{form} or {end}" for form in forms for end in ("later", "any later version", "newer")]
                later.append(
                    f"{name} as published by the free software foundation either version {w} of the license "
                    "or at your option any later version"
                )
                out |= {form: f"{family}-{v}-or-later" for form in later}
    for n, spelled in CLAUSES.items():
        for count in (n, spelled):
            out |= {f"bsd {count} clause": f"bsd-{n}-clause", f"{count} clause bsd": f"bsd-{n}-clause"}
    for family in CC:
        names = ["creative commons attribution"]
        for part in family.split("-")[2:]:
            names = [f"{name} {word}" for name in names for word in CC_WORDS[part]]
        short = family.replace("-", " ")
        if family == "cc-by":
            out["cc by license"] = family
        else:
            names.append(short)
        out |= dict.fromkeys(names, family)
        for v in CC_VERSIONS.split():
            words = v.replace(".", " ")
            out |= {f"{name} {words}": f"{family}-{v}" for name in {*names, short}}
    return out
