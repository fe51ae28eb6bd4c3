"""Customary file headers and full texts of licences, as templates besides the one-line notices."""

from __future__ import annotations

from functools import cache
from importlib import resources

SPDX = "SPDX-License-Identifier:"
# SPDX identifiers, each with the name its licence has here.
IDENTIFIERS = {
    "MIT": "MIT", "ISC": "ISC", "Unlicense": "Unlicense", "Apache-2.0": "Apache-2.0",
    "BSD-2-Clause": "BSD-2-Clause", "BSD-3-Clause": "BSD-3-Clause", "MPL-2.0": "MPL-2.0",
    "GPL-2.0": "GPL-2.0", "GPL-2.0-only": "GPL-2.0", "GPL-2.0-or-later": "GPL-2.0",
    "GPL-3.0": "GPL-3.0", "GPL-3.0-only": "GPL-3.0", "GPL-3.0-or-later": "GPL-3.0",
    "LGPL-2.1": "LGPL-2.1", "LGPL-2.1-only": "LGPL-2.1", "LGPL-2.1-or-later": "LGPL-2.1",
    "LGPL-3.0": "LGPL-3.0", "LGPL-3.0-only": "LGPL-3.0", "LGPL-3.0-or-later": "LGPL-3.0",
    "AGPL-3.0": "AGPL-3.0", "AGPL-3.0-only": "AGPL-3.0", "AGPL-3.0-or-later": "AGPL-3.0",
    "CC0-1.0": "CC0-1.0", "CC-BY-4.0": "CC-BY-4.0", "CC-BY-SA-4.0": "CC-BY-SA-4.0",
    "CC-BY-NC-4.0": "CC-BY-NC-4.0", "CC-BY-NC-SA-4.0": "CC-BY-NC-SA-4.0",
}
_GNU = ("{this} is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "{kind} as published by the Free Software Foundation; either version {version} of the "
        "License, or (at your option) any later version.")
_WARRANTY = ("{this} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
             "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
             "PURPOSE. See the GNU {kind} for more details. You should have received a copy of the "
             "GNU {kind} along with this program. If not, see <https://www.gnu.org/licenses/>.")
_AS_IS = ('THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, '
          "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
          "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE "
          "FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
          "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
          "DEALINGS IN THE SOFTWARE.")
_MIT = ('Permission is hereby granted, free of charge, to any person obtaining a copy of this software '
        'and associated documentation files (the "Software"), to deal in the Software without '
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions:")
_ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: 1. Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution.")
_BSD_NAME = (" 3. Neither the name of the copyright holder nor the names of its contributors may be used "
             "to endorse or promote products derived from this software without specific prior written "
             "permission.")
_BSD_AS_IS = (' THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY '
              "EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
              "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
              "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
              "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
              "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
              "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
              "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
              "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_APACHE = ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
           "except in compliance with the License. You may obtain a copy of the License at "
           "http://www.apache.org/licenses/LICENSE-2.0")
_APACHE_AS_IS = (' Unless required by applicable law or agreed to in writing, software distributed under '
                 'the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY '
                 "KIND, either express or implied. See the License for the specific language governing "
                 "permissions and limitations under the License.")
# What the AGPL's text has besides the GPL's of the same version.
_REMOTE = (" GNU AFFERO GENERAL PUBLIC LICENSE specifically designed to ensure cooperation with the "
           "community in the case of network server software. Remote Network Interaction; if you "
           "modify the Program, your modified version must prominently offer all users interacting "
           "with it remotely through a computer network an opportunity to receive the Corresponding "
           "Source of your version by providing access from a network server at no charge, through "
           "some standard or customary means of facilitating copying of software.")


@cache
def notices() -> list[tuple[str, str]]:
    """(SPDX identifier, text) of headers, SPDX lines and full texts."""
    out = [("MIT", _MIT), ("MIT", " ".join([
        "MIT License", _MIT, "The above copyright notice and this permission notice shall be included "
        "in all copies or substantial portions of the Software.", _AS_IS]))]
    for this in ("This program", "This library"):
        for name, kind, version in (
                ("GPL-2.0", "General Public License", "2"), ("GPL-3.0", "General Public License", "3"),
                ("LGPL-2.1", "Lesser General Public License", "2.1"),
                ("LGPL-3.0", "Lesser General Public License", "3"),
                ("AGPL-3.0", "Affero General Public License", "3")):
            head = _GNU.format(this=this, kind=kind, version=version)
            out += [(name, head), (name, head + " " + _WARRANTY.format(this=this, kind=kind))]
    out += [("Apache-2.0", _APACHE), ("Apache-2.0", _APACHE + _APACHE_AS_IS),
            ("BSD-2-Clause", _BSD + _BSD_AS_IS), ("BSD-3-Clause", _BSD + _BSD_NAME + _BSD_AS_IS),
            ("ISC", _ISC), ("ISC", "ISC License " + _ISC + " " + _AS_IS.replace("NONINFRINGEMENT", "")),
            ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. "
             "2.0. If a copy of the MPL was not distributed with this file, You can obtain one at "
             "https://mozilla.org/MPL/2.0/."),
            ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone "
             "is free to copy, modify, publish, use, compile, sell, or distribute this software, either in "
             "source code form or as a compiled binary, for any purpose, commercial or non-commercial, "
             "and by any means.")]
    folder = resources.files("adflow.llm") / "license_texts"
    full = {n: (folder / f"{n}.txt").read_text("utf-8") for n in (
        "Apache-2.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0")}
    out += [(name, f"{SPDX} {identifier}") for identifier, name in IDENTIFIERS.items()]
    return [*out, *full.items(), ("AGPL-3.0", full["GPL-3.0"] + _REMOTE)]
