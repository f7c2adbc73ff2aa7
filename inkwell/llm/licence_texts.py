"""Known licence texts and notices, by SPDX identifier.

FIXED VALUES: public licence texts and the notice sentences their authors
recommend.  The longer texts are the files of ``licences``, as their authors
publish them; notices of the usual forms follow from ``NAMES`` by a rule."""

from __future__ import annotations

from importlib.resources import files

_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""

_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted"""

_ISC_NOTICE = """, provided that the above
copyright notice and this permission notice appear in all copies."""

_ISC_WARRANTY = """
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""

_BSD_GRANT = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution.
"""

_BSD_NAME = """
3. Neither the name of the copyright holder nor the names of its contributors
may be used to endorse or promote products derived from this software without
specific prior written permission.
"""

_BSD_WARRANTY = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
claim that you wrote the original software. If you use this software
in a product, an acknowledgment in the product documentation would be
appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be
misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""

_APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""

#: Names that notices give a licence.
NAMES = {
    "MIT": ["MIT License", "MIT Licence (MIT)", "MIT"],
    "ISC": ["ISC License", "ISC"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD License", "0BSD"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License"],
    "Zlib": ["zlib License", "zlib/libpng License"],
    "Unlicense": ["Unlicense"],
    "BSL-1.0": ["Boost Software License 1.0", "Boost Software License, Version 1.0"],
    "Apache-2.0": ["Apache License 2.0", "Apache License, Version 2.0", "Apache 2.0 License", "Apache 2.0"],
    "Artistic-1.0-Perl": ["Perl Artistic License"],
    "Artistic-2.0": ["Artistic License 2.0"],
    "MPL-1.1": ["Mozilla Public License 1.1", "Mozilla Public License, version 1.1", "MPL 1.1"],
    "MPL-2.0": ["Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "Mozilla Public License, v. 2.0", "MPL 2.0"],
    "EPL-1.0": ["Eclipse Public License 1.0", "Eclipse Public License v1.0", "EPL 1.0"],
    "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License v2.0", "EPL 2.0"],
    "EUPL-1.2": ["European Union Public Licence 1.2", "EUPL 1.2"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero 1.0", "Creative Commons Zero v1.0 Universal"],
}
#: GNU licences: the name, its short form, and the versions.
GNU = {"GPL": ("GNU General Public License", "GNU GPL", "123"), "LGPL": ("GNU Lesser General Public License", "GNU LGPL", ("2.1", "3")),
       "AGPL": ("GNU Affero General Public License", "GNU AGPL", "3"), "GFDL": ("GNU Free Documentation License", "GNU FDL", ("1.2", "1.3"))}
#: Creative Commons licences: the code and the name; versions 3.0 and 4.0.
CREATIVE_COMMONS = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
                    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
#: What a notice line says of a licence's name.
SENTENCES = ("Licensed under {}", "Licensed under the {}", "Released under {}", "Released under the {}", "Distributed under the {}", "Published under the {}",
             "Available under the {}", "This work is licensed under {}", "This work is licensed under the {}", "This work is licensed under a {}",
             "This project is licensed under the {}", "This software is licensed under the {}", "This program is licensed under the {}", "License: {}")


def names_by_licence() -> dict[str, list[str]]:
    out = {k: list(v) for k, v in NAMES.items()}
    for code, (long, short, versions) in GNU.items():
        for v in versions:
            forms = ("{} version " + v, "{} v" + v, "{} " + v, *((f"{{}} version {v}.0", f"{{}} v{v}.0") if "." not in v else ()))
            out[f"{code}-{v}{'' if '.' in v else '.0'}-only"] = [f.format(n) for n in (long, short, code) for f in forms]
    for code, name in CREATIVE_COMMONS.items():
        for v in ("3.0", "4.0"):
            kind = "International" if v == "4.0" else "Unported"
            out[f"CC-{code}-{v}"] = [f"CC {code} {v}", f"Creative Commons {name} {v}", f"Creative Commons {name} {v} License",
                                     f"Creative Commons {name} {v} {kind}", f"Creative Commons {name} {v} {kind} License"]
    return out


def notices() -> list[tuple[str, str]]:
    """(SPDX identifier, notice line) of every name in every sentence, and the
    SPDX lines; "or later" forms have their own identifier."""
    out = []
    for licence, names in names_by_licence().items():
        out += [(licence, s.format(n)) for n in names for s in SENTENCES]
        out.append((licence, f"SPDX-License-Identifier: {licence}"))
        if licence.endswith("-only"):
            later, plain = licence.replace("-only", "-or-later"), licence.replace("-only", "")
            out += [(later, f"SPDX-License-Identifier: {later}"), (licence, f"SPDX-License-Identifier: {plain}")]
            out += [(later, s.format(n) + tail) for n in names for s in SENTENCES for tail in (" or later", " or any later version")]
    return out


def whole_texts() -> list[tuple[str, str]]:
    return [(f.name.removesuffix(".txt"), f.read_text(encoding="utf-8")) for f in sorted(files(__package__).joinpath("licences").iterdir(), key=lambda f: f.name)]


#: (SPDX identifier, entire text of a licence or of a notice).
KNOWN_TEXTS: list[tuple[str, str]] = [
    ("MIT", _MIT_GRANT),
    ("MIT", "MIT License\n" + _MIT_GRANT),
    ("MIT", "The MIT License (MIT)\n" + _MIT_GRANT),
    ("ISC", _ISC_GRANT + _ISC_NOTICE + _ISC_WARRANTY),
    ("ISC", "ISC License\n" + _ISC_GRANT + _ISC_NOTICE + _ISC_WARRANTY),
    ("0BSD", _ISC_GRANT + "." + _ISC_WARRANTY),
    ("BSD-2-Clause", _BSD_GRANT + _BSD_WARRANTY),
    ("BSD-2-Clause", "BSD 2-Clause License\n" + _BSD_GRANT + _BSD_WARRANTY),
    ("BSD-3-Clause", _BSD_GRANT + _BSD_NAME + _BSD_WARRANTY),
    ("BSD-3-Clause", "BSD 3-Clause License\n" + _BSD_GRANT + _BSD_NAME + _BSD_WARRANTY),
    ("Zlib", _ZLIB),
    ("Apache-2.0", _APACHE_HEADER),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-only"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0",
     "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0",
     "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    *whole_texts(),
    *notices(),
]

#: (spelling, the spelling it counts as), applied in this order to normalised
#: text; after the list of equivalent words of the SPDX matching guidelines.
EQUIVALENT_SPELLINGS: list[tuple[str, str]] = [
    ("licenc", "licens"),
    ("sub licens", "sublicens"),
    ("organis", "organiz"),
    ("favour", "favor"),
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("authoris", "authoriz"),
    ("behaviour", "behavior"),
    ("catalogue", "catalog"),
    ("centre", "center"),
    ("fulfilment", "fulfillment"),
    ("initialis", "initializ"),
    ("judgement", "judgment"),
    ("labour", "labor"),
    ("maximis", "maximiz"),
    ("minimis", "minimiz"),
    ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"),
    ("owner", "holder"),
    ("per cent", "percent"),
    ("practise", "practice"),
    ("programme", "program"),
    ("recognis", "recogniz"),
    ("utilis", "utiliz"),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("https", "http"),
]
