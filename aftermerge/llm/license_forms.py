"""What licenses look like in a text: whole texts, notices, names and SPDX lines.

Whole texts are those of ``license_texts``. AGPL-3.0's is put together from GPL-3's and its own
section 13; Creative Commons licenses other than CC0 are known by their names only.
"""

from __future__ import annotations

from importlib.resources import files
from itertools import product


def _whole(name: str) -> str:
    return (files(__package__) / "license_texts" / f"{name}.txt").read_text("utf-8")


_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
    " and associated documentation files (the Software), to deal in the Software without"
    " restriction, including without limitation the rights to use, copy, modify, merge, publish,"
    " distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the"
    " Software is furnished to do so, subject to the following conditions: The above copyright"
    " notice and this permission notice shall be included in all copies or substantial portions of"
    " the Software."
)
_MIT_WARRANTY = (
    ' THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT'
    " NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND"
    " NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,"
    " DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT"
    " OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted"
    " provided that the following conditions are met: 1. Redistributions of source code must retain the"
    " above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in"
    " binary form must reproduce the above copyright notice, this list of conditions and the following"
    " disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_ADVERTISING = (
    " 3. All advertising materials mentioning features or use of this software must display the following"
    " acknowledgement: This product includes software developed by the organization."
)
_BSD_NAMES = (
    " Neither the name of the copyright holder nor the names of its contributors may be used to"
    " endorse or promote products derived from this software without specific prior written permission."
)
_BSD_WARRANTY = (
    ' THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED'
    " WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A"
    " PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE"
    " FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT"
    " LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS"
    " INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR"
    " TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF"
    " ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee"
    " is hereby granted, provided that the above copyright notice and this permission notice appear in all"
    ' copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS'
    " SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR"
    " BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER"
    " RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER"
    " TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_APACHE_NOTICE = (
    "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except"
    " in compliance with the License. You may obtain a copy of the License at"
)
_MPL2_NOTICE = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the"
    " MPL was not distributed with this file, You can obtain one at"
)
_MPL1_NOTICE = (
    "The contents of this file are subject to the Mozilla Public License Version 1.1 (the License); you may"
    " not use this file except in compliance with the License."
)
_AGPL_13 = """  13. Remote Network Interaction; Use with the GNU General Public License.

  Notwithstanding any other provision of this License, if you modify the Program, your modified version
must prominently offer all users interacting with it remotely through a computer network (if your version
supports such interaction) an opportunity to receive the Corresponding Source of your version by providing
access to the Corresponding Source from a network server at no charge, through some standard or customary
means of facilitating copying of software. This Corresponding Source shall include the Corresponding Source
for any work covered by version 3 of the GNU General Public License that is incorporated pursuant to the
following paragraph.

"""


def _agpl() -> str:
    head, _, rest = _whole("GPL-3").partition("  13. Use with the GNU Affero General Public License.")
    after = rest[rest.index("  14. Revised Versions") :]
    plain, own = "General Public License", "Affero General Public License"
    swap = lambda s: s.replace(plain, own).replace(plain.upper(), own.upper())
    return swap(head) + _AGPL_13 + swap(after)


def _gnu(family: str, kind: str, version: str, short: str) -> tuple[str, ...]:
    return (
        f"This work is licensed under the GNU {kind}, version {version}.",
        f"This {'library' if short[0] == 'L' else 'program'} is free software: you can redistribute it and/or"
        f" modify it under the terms of the GNU {kind} as published by the Free Software Foundation, either"
        f" version {version} of the License, or (at your option) any later version.",
        f"Licensed under the GNU {kind}, version {version}.",
        f"Licensed under the GNU {kind} v{version}.",
        f"Licensed under the {short} v{version}.",
        f"Licensed under the {short}v{version}.",
        f"Licensed under the {short} version {version}.",
        f"SPDX-License-Identifier: {family}",
    )


def _creative_commons() -> dict[str, tuple[str, ...]]:
    words = {"BY": "Attribution", "NC": "NonCommercial", "ND": "NoDerivatives", "SA": "ShareAlike"}
    out = {}
    kinds = ("BY", "BY-NC", "BY-ND", "BY-SA", "BY-NC-ND", "BY-NC-SA")
    for kind, version in product(kinds, ("1.0", "2.0", "2.5", "3.0", "4.0")):
        title = "-".join(words[k] for k in kind.split("-"))
        scope = {"4.0": "International ", "3.0": "Unported "}.get(version, "Generic ")
        out[f"CC-{kind}-{version}"] = (
            f"Licensed under CC {kind} {version}.",
            f"This work is licensed under a Creative Commons {title} {version} {scope}License.",
            f"Creative Commons {title} {version}",
            f"SPDX-License-Identifier: CC-{kind}-{version}",
        )
    return out


_GPL, _LGPL = "General Public License", "Lesser General Public License"

#: Fixed values. A name without its version is a license of its own, known by as much as it says.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        _MIT_GRANT,
        _MIT_GRANT + _MIT_WARRANTY,
        "SPDX-License-Identifier: MIT",
    ),
    "MIT-0": ("Released under the MIT No Attribution License.", "SPDX-License-Identifier: MIT-0"),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        _APACHE_NOTICE,
        _whole("Apache-2.0"),
        "Licensed under the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "GPL-1.0": (*_gnu("GPL-1.0", _GPL, "1", "GPL"), _whole("GPL-1")),
    "GPL-2.0": (*_gnu("GPL-2.0", _GPL, "2", "GPL"), _whole("GPL-2")),
    "GPL-3.0": (*_gnu("GPL-3.0", _GPL, "3", "GPL"), _whole("GPL-3")),
    "LGPL-2.0": (*_gnu("LGPL-2.0", "Library General Public License", "2", "LGPL"), _whole("LGPL-2")),
    "LGPL-2.1": (*_gnu("LGPL-2.1", _LGPL, "2.1", "LGPL"), _whole("LGPL-2.1")),
    "LGPL-3.0": (*_gnu("LGPL-3.0", _LGPL, "3", "LGPL"), _whole("LGPL-3")),
    "AGPL-3.0": (*_gnu("AGPL-3.0", "Affero General Public License", "3", "AGPL"), _agpl()),
    "GPL": ("Licensed under the GNU General Public License.", "Licensed under the GPL license."),
    "LGPL": ("Licensed under the GNU Lesser General Public License.", "Licensed under the LGPL license."),
    "AGPL": ("Licensed under the GNU Affero General Public License.", "Licensed under the AGPL license."),
    "GFDL-1.2": (_whole("GFDL-1.2"), "Licensed under the GNU Free Documentation License, Version 1.2."),
    "GFDL-1.3": (_whole("GFDL-1.3"), "Licensed under the GNU Free Documentation License, Version 1.3."),
    "MPL-1.1": (
        "Licensed under the Mozilla Public License, Version 1.1.",
        _MPL1_NOTICE,
        _whole("MPL-1.1"),
        "SPDX-License-Identifier: MPL-1.1",
    ),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License, Version 2.0.",
        _MPL2_NOTICE,
        _whole("MPL-2.0"),
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "Artistic": ("Licensed under the Artistic License.", _whole("Artistic")),
    "CC0-1.0": (
        "Licensed under CC0 1.0 Universal.",
        "Licensed under CC0 1.0.",
        "Dedicated to the public domain under Creative Commons Zero 1.0 Universal.",
        _whole("CC0-1.0"),
        "SPDX-License-Identifier: CC0-1.0",
    ),
    **_creative_commons(),
    "ISC": ("Released under the ISC License.", _ISC, "SPDX-License-Identifier: ISC"),
    "BSD": ("Released under the BSD License.", _BSD_HEAD.partition(": 1.")[0]),
    "BSD-2-Clause": (
        "Released under the BSD 2-Clause License.",
        _BSD_HEAD + _BSD_WARRANTY,
        "SPDX-License-Identifier: BSD-2-Clause",
    ),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        _BSD_HEAD + " 3." + _BSD_NAMES + _BSD_WARRANTY,
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "BSD-4-Clause": (
        "Released under the BSD 4-Clause License.",
        _BSD_HEAD + _BSD_ADVERTISING + " 4." + _BSD_NAMES + _BSD_WARRANTY,
        "SPDX-License-Identifier: BSD-4-Clause",
    ),
}

#: Words that tell licenses apart, besides numbers.
NAME_WORDS = frozenset(
    "affero agpl apache artistic attribution bsd cc cc0 commons creative documentation general gnu gpl isc"
    " lesser lgpl library mit mozilla mpl nc nd no noderivatives noncommercial sa sharealike spdx zero".split()
)
