"""Notices and bodies of licenses: what the license scan looks for."""

from __future__ import annotations

from importlib.resources import files

#: Full texts, without what follows the terms; one file each.
BODIES = (
    "Apache-2.0", "GPL-1.0", "GPL-2.0", "GPL-3.0", "AGPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "MPL-1.1", "MPL-2.0",
    "CC0-1.0", "Artistic-1.0", "GFDL-1.2", "GFDL-1.3", "Unlicense", "BSL-1.0", "Zlib",
)

_AS_IS = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
    "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
_SOURCE = "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
_BINARY = "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
_ENDORSE = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
_ADVERTISE = "3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by the organization. "
_MIT_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"
_MIT_NOTICE = ", subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
_MIT_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
    "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. "
    "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_GNU = "This {what} is free software{sep} you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation"
_GNU_VERSIONS = (
    ("GPL-2.0", "GNU General Public License", "2"), ("GPL-3.0", "GNU General Public License", "3"), ("GPL-1.0", "GNU General Public License", "1"),
    ("AGPL-3.0", "GNU Affero General Public License", "3"),
    ("LGPL-2.0", "GNU Library General Public License", "2"), ("LGPL-2.1", "GNU Lesser General Public License", "2.1"), ("LGPL-3.0", "GNU Lesser General Public License", "3"),
)

#: Names that a line of a few words says, with those of the versions beside them.
_NAMES = (
    ("MIT", "MIT License"), ("MIT", "MIT license (MIT)"), ("MIT-0", "MIT No Attribution License"), ("ISC", "ISC License"), ("Zlib", "zlib License"), ("0BSD", "Zero-Clause BSD License"),
    ("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-2-Clause", "Simplified BSD License"), ("BSD-3-Clause", "BSD 3-Clause License"), ("BSD-3-Clause", "New BSD License"), ("BSD-4-Clause", "BSD 4-Clause License"),
    ("Apache-2.0", "Apache License, Version 2.0"), ("Apache-2.0", "Apache License 2.0"), ("Apache-2.0", "Apache 2.0 License"), ("Apache-1.1", "Apache License, Version 1.1"), ("Apache-1.0", "Apache License, Version 1.0"),
    ("MPL-1.0", "Mozilla Public License, version 1.0"), ("MPL-1.1", "Mozilla Public License, version 1.1"), ("MPL-2.0", "Mozilla Public License, version 2.0"), ("MPL-2.0", "Mozilla Public License 2.0"),
    ("EPL-1.0", "Eclipse Public License, version 1.0"), ("EPL-1.0", "Eclipse Public License v1.0"), ("EPL-2.0", "Eclipse Public License, version 2.0"), ("EPL-2.0", "Eclipse Public License v2.0"), ("EPL-2.0", "Eclipse Public License v. 2.0"), ("EPL-2.0", "Eclipse Public License 2.0"),
    ("CDDL-1.0", "Common Development and Distribution License, version 1.0"), ("CDDL-1.1", "Common Development and Distribution License, version 1.1"),
    ("EUPL-1.1", "European Union Public Licence, version 1.1"), ("EUPL-1.2", "European Union Public Licence, version 1.2"),
    ("BSL-1.0", "Boost Software License, Version 1.0"), ("BUSL-1.1", "Business Source License 1.1"), ("Artistic-1.0", "Artistic License 1.0"), ("Artistic-2.0", "Artistic License 2.0"),
    ("Unlicense", "Unlicense"), ("WTFPL", "WTFPL"), ("PostgreSQL", "PostgreSQL License"), ("PSF-2.0", "Python Software Foundation License Version 2"), ("OFL-1.1", "SIL Open Font License, Version 1.1"),
    ("CC0-1.0", "CC0 1.0"), ("CC0-1.0", "CC0 1.0 Universal"), ("ODbL-1.0", "Open Database License 1.0"), ("GFDL-1.2", "GNU Free Documentation License, Version 1.2"), ("GFDL-1.3", "GNU Free Documentation License, Version 1.3"),
    *((i, f"{name}, version {v}") for i, name, v in _GNU_VERSIONS), *((i, f"{name} v{v}") for i, name, v in _GNU_VERSIONS),
    *((i, f"{i.partition('-')[0]} version {v}") for i, _, v in _GNU_VERSIONS), *((i, f"{i.partition('-')[0]}v{v}") for i, _, v in _GNU_VERSIONS),
)
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives", "BY-NC": "Attribution-NonCommercial", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
_CC_VERSIONS = (("4.0", "International"), ("3.0", "Unported"), ("2.5", "Generic"), ("2.0", "Generic"), ("1.0", "Generic"))
_SAYS = ("Licensed under the", "Released under the", "This work is licensed under the", "Distributed under the", "Available under the terms of the")


def _lines():
    for license_, name in _NAMES:
        for says in _SAYS:
            yield license_, f"{says} {name}."
    for license_ in dict.fromkeys([i for i, _ in _NAMES] + [f"CC-{kind}-{v}" for kind in _CC for v, _ in _CC_VERSIONS]):
        yield license_, f"SPDX-License-Identifier: {license_}"
    for kind, name in _CC.items():
        for v, where in _CC_VERSIONS:
            license_ = f"CC-{kind}-{v}"
            yield license_, f"Licensed under CC {kind} {v}."
            yield license_, f"Released under CC {kind} {v}."
            yield license_, f"This work is licensed under CC {kind} {v}."
            yield license_, f"This work is licensed under a Creative Commons {name} {v} {where} License."
            yield license_, f"Licensed under the Creative Commons {name} {v} License."
            yield license_, f"https://creativecommons.org/licenses/{kind.lower()}/{v}/"
    yield "CC0-1.0", "https://creativecommons.org/publicdomain/zero/1.0/"


def _notices():
    for license_, name, version in _GNU_VERSIONS:
        for what, sep in (("program", ":"), ("library", ";")):
            start = _GNU.format(what=what, sep=sep, name=name)
            yield license_, f"{start}, either version {version} of the License, or (at your option) any later version."
            yield license_, f"{start}, version {version} of the License."
    # Bits of older notices differ in a comma and in "; either".
    mozilla = "This Source Code Form is subject to the terms of the Mozilla Public License, v. {v}. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/{v}/."
    yield "MPL-2.0", mozilla.format(v="2.0")
    for v in ("1.0", "1.1"):
        yield f"MPL-{v}", f"The contents of this file are subject to the Mozilla Public License Version {v} (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.mozilla.org/MPL/"
    for v, url in (("1.0", "v10"), ("2.0", "2.0")):
        yield f"EPL-{v}", f"This program and the accompanying materials are made available under the terms of the Eclipse Public License v{v} which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-{url}"
    yield "EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"
    yield "BSL-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)"
    yield "CC0-1.0", "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty."
    yield "CC0-1.0", "You should have received a copy of the CC0 Public Domain Dedication along with this software. If not, see http://creativecommons.org/publicdomain/zero/1.0/."
    yield "Unlicense", "This is free and unencumbered software released into the public domain."
    yield "CDDL-1.0", "The contents of this file are subject to the terms of the Common Development and Distribution License (the \"License\"). You may not use this file except in compliance with the License."
    yield "OFL-1.1", "This Font Software is licensed under the SIL Open Font License, Version 1.1. This license is copied below, and is also available with a FAQ at: https://scripts.sil.org/OFL"
    yield "GFDL-1.3", "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.3 or any later version published by the Free Software Foundation"
    yield "GFDL-1.2", "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.2 or any later version published by the Free Software Foundation"


def _bodies():
    yield "MIT", _MIT_GRANT + _MIT_NOTICE + _MIT_AS_IS
    yield "MIT-0", _MIT_GRANT + ". " + _MIT_AS_IS
    yield "ISC", _ISC_GRANT + ", provided that the above copyright notice and this permission notice appear in all copies. " + _ISC_AS_IS
    yield "0BSD", _ISC_GRANT + ". " + _ISC_AS_IS
    yield "BSD-2-Clause", _BSD + _SOURCE + _BINARY + _AS_IS
    yield "BSD-3-Clause", _BSD + _SOURCE + _BINARY + "3. " + _ENDORSE + _AS_IS
    yield "BSD-4-Clause", _BSD + _SOURCE + _BINARY + _ADVERTISE + "4. " + _ENDORSE + _AS_IS
    # The terms alone, as files without the disclaimer have them.
    yield "BSD-2-Clause", _BSD + _SOURCE + _BINARY
    yield "BSD-3-Clause", _BSD + _SOURCE + _BINARY + "3. " + _ENDORSE
    yield "BSD-4-Clause", _BSD + _SOURCE + _BINARY + _ADVERTISE + "4. " + _ENDORSE
    for license_ in BODIES:
        yield license_, (files(__name__) / f"{license_}.txt").read_text(encoding="utf-8")


MORE_TEMPLATES: tuple[tuple[str, str], ...] = (*_lines(), *_notices(), *_bodies())
