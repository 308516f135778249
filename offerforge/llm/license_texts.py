"""Templates of the licence scan."""

from __future__ import annotations

# Public licence texts, notices and the short statements that name a licence.
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
    "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
    "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
    "is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be "
    "included in all copies or substantial portions of the Software. ")
_MIT_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE "
    "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
    "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met:")
_BSD_SOURCE = (
    " 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
    "in the documentation and/or other materials provided with the distribution. ")
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
    "from this software without specific prior written permission. ")
_BSD_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT "
    "NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL "
    "THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
    "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_GNU = (
    "This {what} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU {name} as published by "
    "the Free Software Foundation{comma} either version {version} of the License, or (at your option) any later version. This {what} is "
    "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
    "FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details.")
_GNU_SHORT = _GNU[: _GNU.index(" This {what} is distributed")]
_GNU_FAMILY = (
    ("agpl-3.0", "program", "Affero General Public License", "3"), ("gpl-2.0", "program", "General Public License", "2"),
    ("gpl-3.0", "program", "General Public License", "3"), ("lgpl-2.1", "library", "Lesser General Public License", "2.1"),
    ("lgpl-3.0", "program", "Lesser General Public License", "3"),
)
_CC_FAMILY = (
    ("by", "Attribution"), ("by-nc", "Attribution-NonCommercial"), ("by-nc-nd", "Attribution-NonCommercial-NoDerivatives"),
    ("by-nc-sa", "Attribution-NonCommercial-ShareAlike"), ("by-nd", "Attribution-NoDerivatives"), ("by-sa", "Attribution-ShareAlike"),
)
_CC_VERSIONS = (("4.0", "International"), ("3.0", "Unported"))

TEMPLATES: tuple[tuple[str, str], ...] = (
    ("apache-2.0 notice", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                          "in compliance with the License. You may obtain a copy of the License at"),
    ("apache-2.0 statement", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0 terms", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                         "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
                         "See the License for the specific language governing permissions and limitations under the License."),
    ("bsd conditions", _BSD),
    ("bsd-2-clause text", _BSD + _BSD_SOURCE + _BSD_WARRANTY),
    ("bsd-3-clause text", _BSD + _BSD_SOURCE + _BSD_NAMES + _BSD_WARRANTY),
    ("bsl-1.0 statement", "Distributed under the Boost Software License, Version 1.0."),
    ("cc0-1.0 statement", "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
                          "to this work."),
    ("epl-2.0 notice", "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
                       "2.0 which is available at"),
    ("gpl-3.0 statement", "This work is licensed under the GNU General Public License, version 3."),
    ("isc text", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
                 "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mit grant", _MIT[: _MIT.index(", including")]),
    ("mit statement", "Released under the MIT License."),
    ("mit text", _MIT + _MIT_WARRANTY),
    ("mpl-2.0 notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
                       "not distributed with this file, You can obtain one at"),
    ("unlicense text", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
                       "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
                       "binary, for any purpose, commercial or non-commercial, and by any means."),
    ("zlib text", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
                  "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
                  "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
                  "following restrictions:"),
    *((f"{code} {kind}", text.format(what=what, name=name, version=version, mark=":" if version == "3" else ";",
                                     comma="," if version == "3" else ";"))
      for code, what, name, version in _GNU_FAMILY for kind, text in (("notice", _GNU_SHORT), ("long notice", _GNU))),
    *((f"cc-{code}-{version} notice", f"This work is licensed under a Creative Commons {name} {version} {kind} License.")
      for code, name in _CC_FAMILY for version, kind in _CC_VERSIONS),
    *((f"cc-{code}-{version} statement", f"Licensed under CC {code.upper()} {version}.")
      for code, _ in _CC_FAMILY for version, _ in _CC_VERSIONS),
)
