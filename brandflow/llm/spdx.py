"""SPDX-License-Identifier tags: the longest licence expression after the tag, with known identifiers."""

from __future__ import annotations

import re

# Common identifiers of the SPDX licence list, and of its exceptions.
IDENTIFIERS = """
0BSD AFL-3.0 AGPL-1.0 AGPL-1.0-only AGPL-1.0-or-later AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.0 Apache-1.1 Apache-2.0
APSL-2.0 Artistic-1.0 Artistic-1.0-Perl Artistic-2.0 Beerware BlueOak-1.0.0 BSD-1-Clause BSD-2-Clause BSD-2-Clause-Patent
BSD-3-Clause BSD-3-Clause-Clear BSD-4-Clause BSL-1.0 BUSL-1.1 CC-BY-1.0 CC-BY-2.0 CC-BY-2.5 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-3.0
CC-BY-NC-4.0 CC-BY-NC-ND-3.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-3.0 CC-BY-NC-SA-4.0 CC-BY-ND-3.0 CC-BY-ND-4.0 CC-BY-SA-2.0
CC-BY-SA-2.5 CC-BY-SA-3.0 CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 CDDL-1.1 CECILL-2.1 CECILL-B CECILL-C CPL-1.0 ECL-2.0 EFL-2.0
Elastic-2.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2 FSFAP FTL GFDL-1.1 GFDL-1.2 GFDL-1.3 GFDL-1.3-only GFDL-1.3-or-later GPL-1.0
GPL-1.0-only GPL-1.0-or-later GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0 GPL-3.0-only GPL-3.0-or-later HPND ICU IJG
ImageMagick IPL-1.0 ISC JSON LGPL-2.0 LGPL-2.0-only LGPL-2.0-or-later LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0
LGPL-3.0-only LGPL-3.0-or-later Libpng libtiff LPL-1.02 LPPL-1.3c MirOS MIT MIT-0 MIT-Modern-Variant MPL-1.0 MPL-1.1 MPL-2.0
MPL-2.0-no-copyleft-exception MS-PL MS-RL MulanPSL-2.0 NCSA NTP ODbL-1.0 ODC-By-1.0 OFL-1.0 OFL-1.1 OLDAP-2.8 OpenSSL OSL-3.0
PDDL-1.0 PHP-3.01 PostgreSQL PSF-2.0 Python-2.0 QPL-1.0 Ruby SISSL Sleepycat SPL-1.0 SSPL-1.0 TCL Unicode-3.0 Unicode-DFS-2016
Unlicense UPL-1.0 Vim W3C WTFPL X11 Zend-2.0 Zlib ZPL-2.1
""".split()
EXCEPTIONS = """
Autoconf-exception-3.0 Bison-exception-2.2 Classpath-exception-2.0 FLTK-exception Font-exception-2.0 GCC-exception-2.0
GCC-exception-3.1 GPL-CC-1.0 Libtool-exception Linux-syscall-note LLVM-exception OCaml-LGPL-linking-exception
OpenJDK-assembly-exception-1.0 openvpn-openssl-exception Qt-GPL-exception-1.0 Swift-exception u-boot-exception-2.0
Universal-FOSS-exception-1.0 WxWindows-exception-3.1
""".split()

TAG = re.compile(r"SPDX-License-Identifier:[ \t]*([^\r\n]*)", re.I)
_TOKEN = re.compile(r"[ \t]*([()]|[A-Za-z0-9](?:[\w.:-]*\w)?\+?)")
_REFERENCE = re.compile(r"(?:DocumentRef-[\w.-]+:)?LicenseRef-[\w.-]+\Z")
_KNOWN = {name.lower(): name for name in IDENTIFIERS}
_WITH = {name.lower(): name for name in EXCEPTIONS}


def expression(text: str) -> str | None:
    """The longest licence expression that ``text`` begins with, identifiers as the list spells them; None if there is none.

    Operators are AND, OR and WITH in upper or lower case. What follows the expression, a
    comment's end or more words, is not looked at. An identifier is one of the list, with
    ``+`` or not, or a LicenseRef; NONE, NOASSERTION and unknown words are none.
    """

    def token(at: int) -> tuple[str, int]:
        m = _TOKEN.match(text, at)
        return (m.group(1), m.end()) if m else ("", at)

    def licence(at: int) -> tuple[str, int] | None:
        word, end = token(at)
        if word == "(":
            inner = whole(end)
            closing, after = token(inner[1]) if inner else ("", at)
            return (f"({inner[0]})", after) if closing == ")" else None
        name = word if _REFERENCE.match(word) else _KNOWN.get(word.removesuffix("+").lower())
        if name is None:
            return None
        name += "+" if word.endswith("+") else ""
        operator, after = token(end)
        if operator in ("WITH", "with"):
            exception, last = token(after)
            if exception.lower() in _WITH:
                return f"{name} WITH {_WITH[exception.lower()]}", last
        return name, end

    def whole(at: int) -> tuple[str, int] | None:
        left = licence(at)
        while left:
            operator, after = token(left[1])
            right = licence(after) if operator in ("AND", "and", "OR", "or") else None
            if not right:
                return left
            left = f"{left[0]} {operator.upper()} {right[0]}", right[1]
        return None

    found = whole(0)
    return found[0] if found else None


def identifiers(stated: str) -> list[str]:
    """The licences that an expression names, without exceptions."""
    return [w for w in re.sub(r" WITH \S+|[()]", " ", stated).split() if w not in ("AND", "OR")]
