"""Known licences of the licence scan. Public licence texts, and digests of the canonical form of long ones."""

_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so"""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_TAIL = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
_MIT_TERMS = """, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
"""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter
it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software.

3. This notice may not be removed or altered from any source distribution."""

KNOWN = {
    "0BSD": f"{_ISC_GRANT}.\n\n{_ISC_TAIL}",
    "BSD-2-Clause": f"{_BSD_HEAD}\n\n{_BSD_TAIL}",
    "BSD-3-Clause": f"{_BSD_HEAD}\n\n{_BSD_THIRD}\n\n{_BSD_TAIL}",
    "ISC": f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_ISC_TAIL}",
    "MIT": f"{_GRANT}{_MIT_TERMS}\n{_WARRANTY}",
    "MIT (titled)": f"MIT License\n\n{_GRANT}{_MIT_TERMS}\n{_WARRANTY}",
    "MIT-0": f"{_GRANT}.\n\n{_WARRANTY}",
    "Zlib": _ZLIB,
    "Apache-2.0 (notice)": "Licensed under the Apache License, Version 2.0.",
}

#: SHA-256 of the canonical form of the texts that Debian ships in /usr/share/common-licenses.
KNOWN_DIGESTS: dict[str, str] = {
    "Apache-2.0": "e87dea5078ce2faaea46d3475af18d30a5c0ac0f09425b60b3e0c6569f72f8d2",
    "Artistic": "64e91f5cc481723b420f8e1ecf131ec7eba02da96cf0a78bb4b764fb30984f7a",
    "CC0-1.0": "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f",
    "GFDL-1.2": "b6270c129be9b0e0172ebf4f39b974d927f155b0569e6689a4fd15068977ecdd",
    "GFDL-1.3": "7a546845f0b9175c013adbd275ab046668c2cd62fa85809f866f6d3218d6adcd",
    "GPL-1": "37f380f152339f34a15db620545eb53f0b5c7d9e6a9542aa09ed0d22f186920f",
    "GPL-2": "ae2be2aaa68f5e52ef402874fc8c7c691879b445cb12e49d84f88168cc2d7dd6",
    "GPL-3": "ee0d2b91860148fdc6916d4fbea5723c7b0c7330d7a45ee71fabe123ce7175f8",
    "LGPL-2": "bea988245c65edbddad6f43ff12ca2472c232324e916d42648b90eac944d833e",
    "LGPL-2.1": "ed875dac9045cba09a17867210991f3a4a82f80b82096b054560a3a8dae9d692",
    "LGPL-3": "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be",
    "MPL-1.1": "cbbde7eeab9b4d180dc00b34252f800e97fb1cddbab38ed8c0c73b956dc2cbf6",
    "MPL-2.0": "f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a",
}

#: Names by which notices call licences.
NAMES = {
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "GNU AGPL v3", "AGPL v3"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "New BSD License", "Modified BSD License"),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-NC-ND-4.0": ("CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"),
    "CC-BY-NC-SA-4.0": ("CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU GPL v2", "GPL v2"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU GPL v3", "GPL v3"),
    "ISC": ("ISC License",),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "GNU LGPL v2.1", "LGPL v2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "GNU LGPL v3", "LGPL v3"),
    "MIT": ("MIT License", "MIT licence"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0"),
    "Unlicense": ("Unlicense",),
    "Zlib": ("zlib License",),
}
#: What a notice says before the name.
PHRASES = (
    "", "Released under", "Licensed under", "Distributed under", "Available under", "Published under", "This work is licensed under", "This software is licensed under",
    "This project is licensed under", "This file is licensed under", "This text is licensed under", "License:",
)


def notices() -> set[tuple[str, str]]:
    """(identifier, line): every phrase with every name, and the identifier lines of source files."""
    made = {(i, f"{p} {article}{name}") for i, names in NAMES.items() for name in names for p in PHRASES for article in ("", "the ") if p or not article}
    return made | {(i, f"SPDX-License-Identifier: {i}{end}") for i in NAMES for end in ("", "-only", "-or-later")}
