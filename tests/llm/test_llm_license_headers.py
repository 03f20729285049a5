"""License scans: the usual headers of each licence and version get that licence."""

from quillprice.llm.licenses import scan


def gnu(title, version, thing="program", then="or (at your option) any later version"):
    return f"""/*
 * Foo is free software; you can redistribute it and/or modify
 * it under the terms of the GNU {title} Public License as published by
 * the Free Software Foundation; either version {version} of the License, {then}.
 *
 * This {thing} is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
 * GNU {title} Public License for more details.
 */
int main() {{ return 0; }}"""


def bsd(clauses):
    middle = {2: "", 3: """3. Neither the name of the University nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission.
"""}[clauses]
    return f"""Copyright (c) 2020, Jane Roe

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:

1. Redistributions of source code must retain the above copyright
   notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright
   notice, this list of conditions and the following disclaimer in the
   documentation and/or other materials provided with the distribution.
{middle}
THIS SOFTWARE IS PROVIDED BY THE REGENTS AND CONTRIBUTORS "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED."""


PERMISSION = """Copyright (c) 2020 Jane Roe <jane@example.org>

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted{}.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR
ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT
OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

HEADERS = [
    ("MIT", "SPDX-License-Identifier: MIT"), ("Apache-2.0", "// SPDX-License-Identifier: Apache-2.0"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"), ("GPL-3.0", "/* SPDX-License-Identifier: GPL-3.0-or-later */"),
    ("LGPL-2.1", "# SPDX-License-Identifier: LGPL-2.1-or-later"), ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"), ("MPL-1.1", "SPDX-License-Identifier: MPL-1.1"),
    ("CC-BY-SA-4.0", "SPDX-License-Identifier: CC-BY-SA-4.0"), (None, "SPDX-License-Identifier: LicenseRef-Unheard"),
    ("GPL-2.0", gnu("General", "2")), ("GPL-3.0", gnu("General", "3")), ("LGPL-2.0", gnu("Library General", "2", "library")),
    ("LGPL-2.1", gnu("Lesser General", "2.1", "library")), ("LGPL-3.0", gnu("Lesser General", "3")),
    ("AGPL-3.0", gnu("Affero General", "3")), ("GPL-2.0", gnu("General", "2", "library")),
    ("BSD-2-Clause", bsd(2)), ("BSD-3-Clause", bsd(3)), ("0BSD", PERMISSION.format("")),
    ("ISC", PERMISSION.format(", provided that the above\ncopyright notice and this permission notice appear in all copies")),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-3.0", "This work is licensed under a Creative Commons Attribution-Share Alike 3.0 Unported License."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE\n   Version 2, June 1991\n\nEveryone may read the preamble that follows."),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE\n   Version 3, 19 November 2007\n\nOther words of a preamble."),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE\n\n  Version 2.1, February 1999\n\nOther words of a preamble."),
    ("Apache-2.0", "   Apache License\n  Version 2.0, January 2004\n http://www.apache.org/licenses/\n\n  Some Heading"),
    ("MPL-2.0", "Mozilla Public License Version 2.0\n=======\n\nQuite Different"),
    ("GFDL-1.2", "GNU Free Documentation License\n Version 1.2, November 2002\n\nOther words of a preamble."),
    ("GPL-3.0", "Licensed under the GPLv3."), ("CC0-1.0", "CC0 1.0 Universal"),
]


def test_headers_of_each_licence_and_version(spark):
    files = spark.createDataFrame([(f"f{i}/x", t) for i, (_, t) in enumerate(HEADERS)], "path string, text string")
    got = {r.path: r.license for r in scan(files).collect()}
    assert [(t, got[f"f{i}/x"]) for i, (_, t) in enumerate(HEADERS)] == [(t, name) for name, t in HEADERS]


PROSE = "seven further ordinary words stand right here "


def test_notices_that_share_their_line(spark):
    apache = "Copyright 2020 The Foo Project contributors. Licensed under the Apache License, Version 2.0."
    notices = [("MIT", "Released under the MIT License."), ("Apache-2.0", apache),
               ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
               ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
               ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1."),
               ("GPL-2.0", gnu("General", "2").replace("\n", " ")), ("ISC", HEADERS[20][1].replace("\n", " "))]
    ways = [lambda t: PROSE[:22] + t, lambda t: PROSE + t + " " + PROSE, lambda t: PROSE * 300 + t + " " + PROSE * 300,
            lambda t: PROSE + "\n" + PROSE + t[:len(t) // 2] + t[len(t) // 2:] + " " + PROSE + "\n" + PROSE]
    rows = [(f"n{i}/{j}", way(t), name) for i, (name, t) in enumerate(notices) for j, way in enumerate(ways)]
    rows += [(f"p{i}/x", t, None) for i, t in enumerate([
        PROSE * 9 + "needs a new license to fish and the public general version 2 of it " + PROSE * 9,
        PROSE + "the copyright of all these works is held by the simplified estate 3 " + PROSE])]
    out = scan(spark.createDataFrame(rows, "path string, text string, name string")).collect()
    assert len(out) == len(rows)
    assert [(r.path, r.license) for r in out if r.license != r.name] == []
    # a notice is a part of such a file, so the file is no licence file
    assert all(r.origin == ("own" if r.name else "none") for r in out)
