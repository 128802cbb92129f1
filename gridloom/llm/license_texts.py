"""License wording in template markup: whole texts of short licenses, whole notices of long ones, names and identifiers.

The wording is that of the public license texts as SPDX lists them. ``<<optional>> ... <</optional>>``
may be left out, ``<<var name max>>`` stands for up to ``max`` words; all else is mandatory, so a
text that changes, adds or drops a word of it is not accepted. The texts begin where their grant
does, behind the copyright lines, which differ from copy to copy.
"""

from __future__ import annotations

from itertools import product

#: Whole license texts.
_AS_IS = 'this software is provided by <<var holder 16>> "as is" and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed. in no event shall <<var holder 16>> be liable for any direct, indirect, incidental, special, exemplary, or consequential damages (including, but not limited to, procurement of substitute goods or services; loss of use, data, or profits; or business interruption) however caused and on any theory of liability, whether in contract, strict liability, or tort (including negligence or otherwise) arising in any way out of the use of this software, even if advised of the possibility of such damage.'
_CONDITIONS = "redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: <<optional>>1<</optional>> redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. <<optional>>2<</optional>> redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_NO_ENDORSEMENT = "<<optional>>neither<</optional>> <<optional>>the<</optional>> name<<optional>>s<</optional>> of <<var holder 16>> <<optional>>nor the names of its contributors<</optional>> may <<optional>>not<</optional>> be used to endorse or promote products derived from this software without specific prior written permission."

TEXTS = {
    "mit-text": 'permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "software"), to deal in the software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software, and to permit persons to whom the software is furnished to do so, subject to the following conditions: the above copyright notice and this permission notice <<optional>>(including the next paragraph)<</optional>> shall be included in all copies or substantial portions of the software. the software is provided "as is", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement. in no event shall <<var holder 16>> be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software.',
    "bsd-2-clause-text": f"{_CONDITIONS} {_AS_IS}",
    "bsd-3-clause-text": f"{_CONDITIONS} <<optional>>3<</optional>> {_NO_ENDORSEMENT} {_AS_IS}",
    "bsd-4-clause-text": f"{_CONDITIONS} <<optional>>3<</optional>> all advertising materials mentioning features or use of this software must display the following acknowledgement: this product includes software developed by <<var holder 16>> <<optional>>4<</optional>> {_NO_ENDORSEMENT} {_AS_IS}",
    "isc-text": 'permission to use, copy, modify, and<<optional>>/or<</optional>> distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. the software is provided "as is" and <<var holder 16>> disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness. in no event shall <<var holder 16>> be liable for any special, direct, indirect, or consequential damages or any damages whatsoever resulting from loss of use, data or profits, whether in an action of contract, negligence or other tortious action, arising out of or in connection with the use or performance of this software.',
    "0bsd-text": 'permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. the software is provided "as is" and <<var holder 16>> disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness. in no event shall <<var holder 16>> be liable for any special, direct, indirect, or consequential damages or any damages whatsoever resulting from loss of use, data or profits, whether in an action of contract, negligence or other tortious action, arising out of or in connection with the use or performance of this software.',
    "zlib-text": "this software is provided 'as-is', without any express or implied warranty. in no event will the authors be held liable for any damages arising from the use of this software. permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: <<optional>>1<</optional>> the origin of this software must not be misrepresented; you must not claim that you wrote the original software. if you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. <<optional>>2<</optional>> altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. <<optional>>3<</optional>> this notice may not be removed or altered from any source distribution.",
    "bsl-1.0-text": 'permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "software") to use, reproduce, display, distribute, execute, and transmit the software, and to prepare derivative works of the software, and to permit third-parties to whom the software is furnished to do so, all subject to the following: the copyright notices in the software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the software, in whole or in part, and all derivative works of the software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor. the software is provided "as is", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose, title and non-infringement. in no event shall the copyright holders or anyone distributing the software be liable for any damages or other liability, whether in contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software.',
    "unlicense-text": 'this is free and unencumbered software released into the public domain. anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. in jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. we make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. we intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. the software is provided "as is", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement. in no event shall the authors be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software.',
}

#: Whole notices that put a file under a longer license, and how licenses are named.
_NO_WARRANTY = "<<var program 8>> is distributed in the hope that it will be useful, but without any warranty; without even the implied warranty of merchantability or fitness for a particular purpose. see the"
_FREE = "is free software<<optional>>:<</optional>> you can redistribute it and/or modify it under the terms of the"

NOTICES = {
    "apache-2.0-notice": 'licensed under the apache license, version 2.0 (the "license"); you may not use <<var file 4>> except in compliance with the license. you may obtain a copy of the license at <<optional>>http<</optional>> <<optional>>https<</optional>> www.apache.org/licenses/license-2.0 unless required by applicable law or agreed to in writing, software distributed under the license is distributed on an "as is" basis, without warranties or conditions of any kind, either express or implied. see the license for the specific language governing permissions and limitations under the license.',
    "gpl-notice": f"{_FREE} gnu general public license as published by the free software foundation<<optional>>, either<</optional>> version <<var number 2>> of the license<<optional>>, or (at your option) any later version<</optional>>. {_NO_WARRANTY} gnu general public license for more details.",
    "lgpl-notice": f"{_FREE} gnu lesser general public license as published by the free software foundation<<optional>>, either<</optional>> version <<var number 2>> of the license<<optional>>, or (at your option) any later version<</optional>>. {_NO_WARRANTY} gnu lesser general public license for more details.",
    "agpl-notice": f"{_FREE} gnu affero general public license as published by the free software foundation<<optional>>, either<</optional>> version <<var number 2>> of the license<<optional>>, or (at your option) any later version<</optional>>. {_NO_WARRANTY} gnu affero general public license for more details.",
    "mpl-2.0-notice": "this source code form is subject to the terms of the mozilla public license, v. 2.0. if a copy of the mpl was not distributed with this file, you can obtain one at <<optional>>http<</optional>> <<optional>>https<</optional>> mozilla.org/mpl/2.0/",
}

NAMES = {
    "apache-2.0": ("licensed under the apache license <<optional>>version<</optional>> 2 0", "spdx license identifier apache 2 0"),
    "mit": ("<<optional>>released<</optional>> <<optional>>distributed<</optional>> <<optional>>licensed<</optional>> under the mit license", "spdx license identifier mit"),
    "bsd": ("under the bsd <<var clauses 3>> license", "spdx license identifier bsd <<var clauses 1>> clause"),
    "isc": ("under the isc license", "spdx license identifier isc"),
    "gpl": ("gnu general public license <<optional>>as published by the free software foundation<</optional>> <<optional>>either<</optional>> version <<var number 2>>", "spdx license identifier gpl"),
    "lgpl": ("gnu lesser general public license", "gnu library general public license", "spdx license identifier lgpl"),
    "agpl": ("gnu affero general public license", "spdx license identifier agpl"),
    "mpl-2.0": ("mozilla public license <<optional>>version<</optional>> <<optional>>v<</optional>> 2 0", "spdx license identifier mpl 2 0"),
    "epl-2.0": ("eclipse public license <<optional>>version<</optional>> <<optional>>v<</optional>> 2 0", "spdx license identifier epl 2 0"),
    "cc0-1.0": ("cc0 1 0", "creative commons zero v1 0 universal", "creative commons cc0"),
}

#: The elements of Creative Commons licenses as they are spelled, the licenses made of them, and their versions.
_ELEMENTS = {"by": ("attribution",), "nc": ("noncommercial", "non commercial"), "sa": ("sharealike", "share alike"), "nd": ("noderivatives", "noderivs", "no derivatives")}
_COMMONS = ("by", "by nc", "by sa", "by nd", "by nc sa", "by nc nd")
_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")
_PORTS = ("international", "unported", "generic", "public")


def commons() -> dict[str, tuple[str, ...]]:
    """cc-by-... to its short names with a version and its long names."""
    optional = lambda words: " ".join(f"<<optional>>{w}<</optional>>" for w in words)
    found = {}
    for name in _COMMONS:
        short = tuple(f"cc {name} {v}" for v in _VERSIONS)
        long = tuple(f"creative commons {' '.join(words)} {optional(_VERSIONS)} {optional(_PORTS)} license" for words in product(*(_ELEMENTS[x] for x in name.split())))
        found["cc-" + name.replace(" ", "-") + ("-license" if name == "by" else "")] = short + long
    return found


#: Templates by label; a label may have several.
TEMPLATES: dict[str, tuple[str, ...]] = {k: (v,) for k, v in (TEXTS | NOTICES).items()} | NAMES | commons()
