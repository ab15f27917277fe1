"""The wording of well-known licences, notices and file headers, by their SPDX identifiers.

Each is (identifier, text, phrases that must occur, so that a version or a variant isn't taken for another).
Licences that are long documents are known by their notices and standard headers, not by their full text.
"""

from __future__ import annotations

_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND '
)
_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
_BSD_ONE = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
_BSD_TWO = "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
_BSD_THREE = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
_BSD_FOUR = "All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by the organization. "
_BSD_TAIL = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND '
    "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
    "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)


def _gnu(name: str, version: str, what: str = "This program") -> str:
    part = "This program" if what == "This program" else "This library"
    return (
        f"{part} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, either version {version} of the License, or "
        f"(at your option) any later version. {part} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        f"PARTICULAR PURPOSE. See the GNU {name} for more details. You should have received a copy of the GNU {name} along with {part.lower()}. If not, see https://www.gnu.org/licenses/."
    )


def _work(name: str) -> str:
    return f"This work is licensed under the {name}."


_NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0.", ("apache license", "version 2")),
    ("MIT", "Released under the MIT License.", ("mit license",)),
    ("MIT", "Licensed under the MIT License.", ("mit license",)),
    ("ISC", "Licensed under the ISC License.", ("isc license",)),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License.", ("bsd 2",)),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License.", ("bsd 3",)),
    ("GPL-2.0", _work("GNU General Public License, version 2"), ("gnu general", "version 2")),
    ("GPL-3.0", _work("GNU General Public License, version 3"), ("gnu general", "version 3")),
    ("LGPL-2.1", _work("GNU Lesser General Public License, version 2.1"), ("lesser general", "version 2")),
    ("LGPL-3.0", _work("GNU Lesser General Public License, version 3"), ("lesser general", "version 3")),
    ("AGPL-3.0", _work("GNU Affero General Public License, version 3"), ("affero general", "version 3")),
    *((f"CC-{x.upper().replace(' ', '-')}-4.0", f"Licensed under CC {x} 4.0.", (f"cc {x.lower()} 4.0".replace("-", " "),)) for x in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")),
    ("CC-BY-4.0", _work("Creative Commons Attribution 4.0 International License"), ("attribution 4",)),
    ("CC-BY-SA-4.0", _work("Creative Commons Attribution-ShareAlike 4.0 International License"), ("attribution sharealike 4",)),
    ("CC-BY-NC-4.0", _work("Creative Commons Attribution-NonCommercial 4.0 International License"), ("attribution noncommercial 4",)),
    ("CC-BY-ND-4.0", _work("Creative Commons Attribution-NoDerivatives 4.0 International License"), ("attribution noderivatives 4",)),
    ("CC-BY-NC-SA-4.0", _work("Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"), ("noncommercial sharealike 4",)),
    ("CC-BY-NC-ND-4.0", _work("Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"), ("noncommercial noderivatives 4",)),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", ("waived all",)),
)

_SPDX = tuple((x, f"SPDX-License-Identifier: {x}", ("identifier " + x.lower().replace("-", " ").replace(".", " "),)) for x in (
    "Apache-2.0", "MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only",
    "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "MPL-2.0", "EPL-2.0", "BSL-1.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "Unlicense", "Zlib",
))

_TEXTS = (
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at '
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
        ("apache license",),
    ),
    (
        "MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without '
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software. " + _AS_IS + "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        (),
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice "
        'appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. '
        "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION "
        "OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
        (),
    ),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_ONE + _BSD_TWO + _BSD_TAIL, ()),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_ONE + _BSD_TWO + _BSD_THREE + _BSD_TAIL, ("endorse or promote",)),
    ("BSD-4-Clause", _BSD_HEAD + _BSD_ONE + _BSD_TWO + _BSD_FOUR + _BSD_THREE + _BSD_TAIL, ("advertising materials",)),
    ("GPL-2.0", _gnu("General Public License", "2"), ("gnu general", "version 2")),
    ("GPL-3.0", _gnu("General Public License", "3"), ("gnu general", "version 3")),
    ("LGPL-2.1", _gnu("Lesser General Public License", "2.1", "This library"), ("lesser general", "version 2")),
    ("LGPL-3.0", _gnu("Lesser General Public License", "3", "This library"), ("lesser general", "version 3")),
    ("AGPL-3.0", _gnu("Affero General Public License", "3"), ("affero general", "version 3")),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        ("mozilla public",),
    ),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
        ("eclipse public",),
    ),
    (
        "BSL-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, "
        "reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all "
        "subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in "
        "all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code "
        "generated by a source language processor. " + _AS_IS + "TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        (),
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted "
        "to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin of this software "
        "must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but "
        "is not required. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. This notice may not be removed or altered from any source "
        "distribution.",
        (),
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a "
        "compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all "
        "copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication "
        "to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. " + _AS_IS + "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR "
        "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. "
        "For more information, please refer to https://unlicense.org",
        (),
    ),
)

TEMPLATES = (*_NOTICES, *_SPDX, *_TEXTS)
