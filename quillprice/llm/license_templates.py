"""Usual notices of common licences, and the words that tell their versions and kinds apart (fixed values)."""

from __future__ import annotations

import re

TOKEN = "[a-z0-9]+"

_BSD_1 = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided "
          "that the following conditions are met: Redistributions of source code must retain the above copyright "
          "notice, this list of conditions and the following disclaimer. ")
_BSD_2 = ("Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
          "following disclaimer in the documentation and/or other materials provided with the distribution. ")
_BSD_AD = ("All advertising materials mentioning features or use of this software must display the following "
           "acknowledgement: This product includes software developed by the organization. ")
_BSD_3 = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
          "promote products derived from this software without specific prior written permission. ")
_BSD_END = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED "
            "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
            "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR "
            "ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
            "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
            "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
            "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF "
            "ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software")
_ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted")
_ISC_KEEP = ", provided that the above copyright notice and this permission notice appear in all copies"
_ISC_END = (". THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
            "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE "
            "FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM "
            "LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
            "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
_APACHE = ("you may not use this file except in compliance with the License. You may obtain a copy of the License at "
           "http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, "
           "software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR "
           "CONDITIONS OF ANY KIND, either express or implied.")

TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", f"Licensed under the Apache License, Version 2.0 (the License); {_APACHE}"),
    ("Apache-2.0", f"Licensed under the Apache License, Version 2.0 (the License); {_APACHE} See the License for the "
                   "specific language governing permissions and limitations under the License."),
    ("Apache-2.0", "Licensed to the Apache Software Foundation (ASF) under one or more contributor license "
                   "agreements. See the NOTICE file distributed with this work for additional information regarding "
                   "copyright ownership. The ASF licenses this file to you under the Apache License, Version 2.0 "
                   f"(the License); {_APACHE} See the License for the specific language governing permissions and "
                   "limitations under the License."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", "Licensed under the Apache 2.0 license."),
    ("Apache-1.1", "The Apache Software License, Version 1.1"),
    ("BSD-2-Clause", "Licensed under the 2-clause BSD License."),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-2-Clause", "Simplified BSD License"),
    ("BSD-2-Clause", _BSD_1 + _BSD_2),
    ("BSD-2-Clause", _BSD_1 + _BSD_2 + _BSD_END),
    ("BSD-3-Clause", "Licensed under the 3-clause BSD License."),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSD-3-Clause", "New BSD License"),
    ("BSD-3-Clause", _BSD_1 + _BSD_2 + _BSD_3),
    ("BSD-3-Clause", _BSD_1 + _BSD_2 + _BSD_3 + _BSD_END),
    ("BSD-4-Clause", "BSD 4-Clause License"),
    ("BSD-4-Clause", _BSD_1 + _BSD_2 + _BSD_AD + _BSD_3),
    ("BSD-4-Clause", _BSD_1 + _BSD_2 + _BSD_AD + _BSD_3 + _BSD_END),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003"),
    ("CC0-1.0", "Released into the public domain under CC0 1.0."),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
    ("CC0-1.0", "CC0 1.0 Universal"),
    ("CC0-1.0", "http://creativecommons.org/publicdomain/zero/1.0/"),
    ("CC0-1.0", "To the extent possible under law, the authors have dedicated all copyright and related and "
                "neighboring rights to this software to the public domain worldwide. This software is distributed "
                "without any warranty."),
    ("EPL-1.0", "Eclipse Public License - v 1.0"),
    ("EPL-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse "
                "Public License v1.0 which accompanies this distribution."),
    ("EPL-2.0", "Eclipse Public License - v 2.0"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse "
                "Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("GFDL-1.1", "GNU Free Documentation License Version 1.1, March 2000"),
    ("GFDL-1.2", "GNU Free Documentation License Version 1.2, November 2002"),
    ("GFDL-1.3", "GNU Free Documentation License Version 1.3, 3 November 2008"),
    ("ISC", "ISC License"),
    ("ISC", "Licensed under the ISC License."),
    ("ISC", _ISC + _ISC_KEEP),
    ("ISC", _ISC + _ISC_KEEP + _ISC_END),
    ("0BSD", _ISC),
    ("0BSD", _ISC + _ISC_END),
    ("MIT", "Released under the MIT License."),
    ("MIT", f"{_MIT}."),
    ("MIT", f"{_MIT}, and to permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions: The above copyright notice and this permission notice shall be included in all copies or "
            "substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, "
            "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
            "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE "
            "FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING "
            "FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "MIT License"),
    ("MPL-1.1", "Mozilla Public License Version 1.1"),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1 (the License); you "
                "may not use this file except in compliance with the License. You may obtain a copy of the License at "
                "http://www.mozilla.org/MPL/. Software distributed under the License is distributed on an AS IS "
                "basis, WITHOUT WARRANTY OF ANY KIND, either express or implied. See the License for the specific "
                "language governing rights and limitations under the License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
                "the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("Proprietary", "Copyright. All rights reserved."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
                  "modify, publish, use, compile, sell, or distribute this software, either in source code form or "
                  "as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("Zlib", "zlib License"),
    ("Zlib", "This software is provided as-is, without any express or implied warranty. In no event will the authors "
             "be held liable for any damages arising from the use of this software. Permission is granted to anyone "
             "to use this software for any purpose, including commercial applications, and to alter it and "
             "redistribute it freely, subject to the following restrictions"),
]

#: Licence, title in the notices, version, date and years of the text; short name.
for _name, _title, _version, _date, _years, _short in [
    ("GPL-1.0", "General", "1", "February 1989", "1989", "GPL"),
    ("GPL-2.0", "General", "2", "June 1991", "1989, 1991", "GPL"),
    ("GPL-3.0", "General", "3", "29 June 2007", "2007", "GPL"),
    ("LGPL-2.0", "Library General", "2", "June 1991", "1991", "LGPL"),
    ("LGPL-2.1", "Lesser General", "2.1", "February 1999", "1991, 1999", "LGPL"),
    ("LGPL-3.0", "Lesser General", "3", "29 June 2007", "2007", "LGPL"),
    ("AGPL-3.0", "Affero General", "3", "19 November 2007", "2007", "AGPL"),
]:
    _license = f"GNU {_title} Public License"
    for _thing in ("program", "library"):
        _given = (f"This {_thing} is free software: you can redistribute it and/or modify it under the terms of the "
                  f"{_license} as published by the Free Software Foundation, ")
        _useful = (f" This {_thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
                   "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.")
        _more = (f" See the {_license} for more details. You should have received a copy of the {_license} along with "
                 f"this {_thing}")
        for _terms in (f"either version {_version} of the License, or (at your option) any later version.",
                       f"version {_version} of the License."):
            TEMPLATES += [(_name, _given + _terms + _useful + end) for end in (
                "", f"{_more}. If not, see https://www.gnu.org/licenses/.",
                f"{_more}; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, "
                "Boston, MA 02110-1301 USA.")]
    TEMPLATES += [(_name, t) for t in (
        f"This work is licensed under the {_license}, version {_version}.",
        f"Licensed under the {_license}, version {_version}.",
        f"under the terms of the {_license}, version {_version} or any later version",
        f"{_license} Version {_version}, {_date}",
        f"{_license} Version {_version}, {_date} Copyright (C) {_years} Free Software Foundation, Inc. Everyone is "
        "permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
        f"Licensed under the {_short} version {_version}.", f"Licensed under the {_short} v{_version}.",
        f"Licensed under the {_short}v{_version}.",
        f"Licensed under the GNU {_title.replace('General', 'GPL')} v{_version}.")]

TEMPLATES += [(f"GFDL-{v}", "Permission is granted to copy, distribute and/or modify this document under the terms "
               f"of the GNU Free Documentation License, Version {v} or any later version published by the Free Software "
               "Foundation; with no Invariant Sections, no Front-Cover Texts, and no Back-Cover Texts.")
              for v in ("1.1", "1.2", "1.3")]

#: Kinds of Creative Commons licences: the part of the name, and its words.
for _part, _words in [("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
                      ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
                      ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")]:
    for _version, _port in [("2.0", "Generic"), ("2.5", "Generic"), ("3.0", "Unported"), ("4.0", "International")]:
        _old = _words.replace("NoDerivatives", "NoDerivs").replace("ShareAlike", "Share Alike")
        TEMPLATES += [(f"CC-{_part}-{_version}", t) for t in dict.fromkeys((
            f"Licensed under CC {_part} {_version}.",
            f"This work is licensed under a Creative Commons {_words} {_version} {_port} License.",
            f"This work is licensed under a Creative Commons {_old} {_version} {_port} License.",
            f"Creative Commons {_words} {_version} {_port} Public License",
            f"http://creativecommons.org/licenses/{_part.lower()}/{_version}/"))]

_names = dict.fromkeys(n for n, _ in TEMPLATES if n != "Proprietary")
TEMPLATES += [(n, f"SPDX-License-Identifier: {n}{end}") for n in _names
              for end in (("", "-only", "-or-later") if "GPL" in n or "GFDL" in n else ("",))]

_GNU = {"GPL": {"lesser", "affero", "lgpl", "agpl", "documentation"}, "LGPL": {"affero", "agpl"}, "AGPL": {"lesser", "lgpl"}}
_TITLES = {"LGPL-2.0": {"library", "lgpl"}, "AGPL-3.0": {"affero", "agpl"}}
_NAMED = {"apache", "boost", "bsd", "cc", "cc0", "commons", "creativecommons", "eclipse", "general", "gpl", "isc", "mit",
          "mozilla", "reserved", "zlib"}
_CC = [{"sa", "sharealike", "alike"}, {"nc", "noncommercial"}, {"nd", "noderivatives", "noderivs"}]
#: The passage must not name another of the GNU licences than the general one.
OTHER_GNU = "(library|lesser|affero) general"
#: A run that has this word has not this licence: its text would be the beginning of a longer one.
RUN_BARS = {"BSD-2-Clause": "endorse", "BSD-3-Clause": "advertising", "0BSD": "appear"}
BARS = RUN_BARS | {n: "other_gnu" for n in ("GPL-1.0", "GPL-2.0", "GPL-3.0")}


def telling(name: str, text: str) -> tuple[set[str], set[str]]:
    """Words of a template that a passage must have, and words that it must not have."""
    words = set(re.findall(TOKEN, text.lower()))
    digits = {d for d in re.findall(r"\d+", name) if d != "0"}
    needs = {w for w in words if re.sub(r"^([al]?gpl)?v(?=\d)", "", w) in digits} | words & _NAMED
    bars = set()
    if "GPL" in name:
        bars = _GNU[name.split("-")[0]]
        needs |= words & (set() if name.startswith("GPL") else _TITLES.get(name, {"lesser", "lgpl"}))
    elif name.startswith("CC-BY"):
        parts = set(name.lower().split("-"))
        needs |= words & set().union(*_CC)
        bars = set().union(*(kind for kind in _CC if not kind & parts))
    elif name.startswith("GFDL"):
        needs |= words & {"documentation"}
    elif name.startswith("BSD-"):
        needs |= words & {"endorse", "advertising"}
    elif name in ("ISC", "0BSD"):
        needs |= words & {"appear", "fee"}
    return needs, bars
