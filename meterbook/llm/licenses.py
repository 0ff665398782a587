"""License scan: ordered signature rules behind a keyword gate, with suppression of contained detections.

Every rule is a regular expression with a level and a keyword. A text is looked at only if one of the few keywords is
in it, and a rule runs only if its own keyword is. Detections are intervals; one that lies inside a detection of the same or a
better level is dropped (equal intervals: the rule that comes first stays), so that "licensed under the Apache License, Version 2.0"
gives one finding and not also its parts. Everything happens inside the row: no shuffle, no Python.

Null text counts as empty. A text without words or without detections has no labels and score 0. Repeated rows give repeated results.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, functions as F

from .shared import count_parts, fresh, let, running, spans

WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]"
NOT_WORD = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]"

#: The base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Label, its SPDX identifier, and how its name is written. A space stands for any separators; | separates spellings.
NAMES = [
    ("0bsd", "0BSD", "zero clause bsd|bsd zero clause|bsd 0 clause"),
    ("afl-3.0", "AFL-3.0", "academic free license"),
    ("agpl-3.0", "AGPL-3.0(?:-only|-or-later)?", "(?:gnu )?affero general public license|gnu agpl|agpl(?: ?v?3(?:\\.0)?)?"),
    ("apache-1.1", "Apache-1\\.1", "apache (?:software )?license,?(?: version| v)? ?1\\.1"),
    ("apache-2.0", "Apache-2\\.0", "apache (?:software )?license,?(?: version| v)? ?2(?:\\.0)?|apache 2(?:\\.0)?"),
    ("artistic-1.0", "Artistic-1\\.0", "artistic license,?(?: version)? ?1(?:\\.0)?"),
    ("artistic-2.0", "Artistic-2\\.0", "artistic license,?(?: version)? ?2(?:\\.0)?"),
    ("blueoak-1.0.0", "BlueOak-1\\.0\\.0", "blue oak model license"),
    ("bsd-2-clause", "BSD-2-Clause", "(?:simplified|freebsd|two clause|2 clause) bsd|bsd (?:2|two) clause"),
    ("bsd-3-clause", "BSD-3-Clause", "(?:new|modified|revised|three clause|3 clause) bsd|bsd (?:3|three) clause"),
    ("bsd-4-clause", "BSD-4-Clause", "(?:original|four clause|4 clause) bsd|bsd (?:4|four) clause"),
    ("bsd", "BSD", "bsd"),
    ("bsl-1.0", "BSL-1\\.0", "boost software license"),
    ("busl-1.1", "BUSL-1\\.1", "business source license"),
    ("cc0-1.0", "CC0-1\\.0", "cc0(?: 1\\.0)?|creative commons zero"),
    ("cc-by-1.0", "CC-BY-1\\.0", "cc by 1\\.0|creative commons attribution 1\\.0"),
    ("cc-by-2.0", "CC-BY-2\\.0", "cc by 2\\.0|creative commons attribution 2\\.0"),
    ("cc-by-3.0", "CC-BY-3\\.0", "cc by 3\\.0|creative commons attribution 3\\.0"),
    ("cc-by-4.0", "CC-BY-4\\.0", "cc by 4\\.0|creative commons attribution 4\\.0"),
    ("cc-by-sa-3.0", "CC-BY-SA-3\\.0", "cc by sa 3\\.0|creative commons attribution share ?alike 3\\.0"),
    ("cc-by-sa-4.0", "CC-BY-SA-4\\.0", "cc by sa 4\\.0|creative commons attribution share ?alike 4\\.0"),
    ("cc-by-nc-3.0", "CC-BY-NC-3\\.0", "cc by nc 3\\.0|creative commons attribution non ?commercial 3\\.0"),
    ("cc-by-nc-4.0", "CC-BY-NC-4\\.0", "cc by nc 4\\.0|creative commons attribution non ?commercial 4\\.0"),
    ("cc-by-nd-4.0", "CC-BY-ND-4\\.0", "cc by nd 4\\.0|creative commons attribution no ?derivatives 4\\.0"),
    ("cc-by-nc-sa-4.0", "CC-BY-NC-SA-4\\.0", "cc by nc sa 4\\.0|creative commons attribution non ?commercial share ?alike 4\\.0"),
    ("cc-by-nc-nd-4.0", "CC-BY-NC-ND-4\\.0", "cc by nc nd 4\\.0|creative commons attribution non ?commercial no ?derivatives 4\\.0"),
    ("cddl-1.0", "CDDL-1\\.0", "common development and distribution license|cddl"),
    ("cecill-2.1", "CECILL-2\\.1", "cecill"),
    ("cpl-1.0", "CPL-1\\.0", "common public license"),
    ("ecl-2.0", "ECL-2\\.0", "educational community license"),
    ("epl-1.0", "EPL-1\\.0", "eclipse public license,?(?: version| v)? ?1(?:\\.0)?"),
    ("epl-2.0", "EPL-2\\.0", "eclipse public license(?:,?(?: version| v)? ?2(?:\\.0)?)?"),
    ("eupl-1.2", "EUPL-1\\.2", "european union public licen[cs]e"),
    ("gfdl-1.3", "GFDL-1\\.3(?:-only|-or-later)?", "(?:gnu )?free documentation license"),
    ("gpl-2.0", "GPL-2\\.0(?:-only|-or-later)?", "(?:gnu )?general public license,?(?: version| v)? ?2(?:\\.0)?|gpl ?v?2(?:\\.0)?"),
    ("gpl-3.0", "GPL-3\\.0(?:-only|-or-later)?", "(?:gnu )?general public license,?(?: version| v)? ?3(?:\\.0)?|gpl ?v?3(?:\\.0)?"),
    ("gpl", "GPL", "(?:gnu )?general public license|gnu gpl"),
    ("hpnd", "HPND", "historical permission notice and disclaimer"),
    ("isc", "ISC", "isc"),
    ("lgpl-2.1", "LGPL-2\\.1(?:-only|-or-later)?", "(?:gnu )?lesser general public license,?(?: version| v)? ?2\\.1|lgpl ?v?2\\.1"),
    ("lgpl-3.0", "LGPL-3\\.0(?:-only|-or-later)?", "(?:gnu )?lesser general public license(?:,?(?: version| v)? ?3(?:\\.0)?)?|lgpl(?: ?v?3)?"),
    ("lppl-1.3c", "LPPL-1\\.3c", "latex project public license"),
    ("mit", "MIT", "mit|expat"),
    ("mit-0", "MIT-0", "mit no attribution"),
    ("mpl-1.1", "MPL-1\\.1", "mozilla public license,?(?: version| v)? ?1\\.1|mpl ?1\\.1"),
    ("mpl-2.0", "MPL-2\\.0", "mozilla public license(?:,?(?: version| v)? ?2(?:\\.0)?)?|mpl ?2(?:\\.0)?"),
    ("ms-pl", "MS-PL", "microsoft public license"),
    ("ms-rl", "MS-RL", "microsoft reciprocal license"),
    ("mulanpsl-2.0", "MulanPSL-2\\.0", "mulan permissive software license"),
    ("ncsa", "NCSA", "ncsa open source license"),
    ("odbl-1.0", "ODbL-1\\.0", "open database license|odbl"),
    ("odc-by-1.0", "ODC-By-1\\.0", "open data commons attribution license"),
    ("ofl-1.1", "OFL-1\\.1", "sil open font license|open font license"),
    ("osl-3.0", "OSL-3\\.0", "open software license"),
    ("pddl-1.0", "PDDL-1\\.0", "public domain dedication and license"),
    ("php-3.01", "PHP-3\\.01", "php license"),
    ("postgresql", "PostgreSQL", "postgresql license"),
    ("psf-2.0", "PSF-2\\.0", "python software foundation license"),
    ("qpl-1.0", "QPL-1\\.0", "q public license"),
    ("ruby", "Ruby", "ruby license"),
    ("sspl-1.0", "SSPL-1\\.0", "server side public license"),
    ("unlicense", "Unlicense", "unlicense"),
    ("upl-1.0", "UPL-1\\.0", "universal permissive license"),
    ("vim", "Vim", "vim license"),
    ("w3c", "W3C", "w3c software (?:notice and )?license"),
    ("wtfpl", "WTFPL", "do what the fuck you want to public license|wtfpl"),
    ("x11", "X11", "x11 license"),
    ("zlib", "Zlib", "zlib|zlib libpng"),
    ("zpl-2.1", "ZPL-2\\.1", "zope public license"),
]

#: Notices that name no license: label, level, pattern, keyword: one word that every match has, as words may be wrapped.
NOTICES = [
    ("all-rights-reserved", 2, "all rights reserved", "reserved"),
    ("copyright-notice", 2, "copyright (?:\\(c\\) |© )?[12][0-9]{3}", "copyright"),
    ("copyright-notice", 2, "\\(c\\) (?:\\(c\\) |© )?[12][0-9]{3}", "(c)"),
    ("copyright-notice", 2, "© (?:\\(c\\) |© )?[12][0-9]{3}", "©"),
    ("public-domain", 2, "(?:dedicated to|released into|placed in|in) the public domain", "domain"),
    ("permissive-grant", 2, "permission is hereby granted, free of charge", "hereby"),
    ("permissive-grant", 2, "redistribution and use in source and binary forms", "redistribution"),
    ("as-is-disclaimer", 2, "provided \"?as is\"?,? without warranty", "warranty"),
    ("as-is-disclaimer", 2, "provided on an \"?as is\"? basis", "basis"),
    ("proprietary", 2, "proprietary and confidential", "proprietary"),
    ("proprietary", 2, "unauthori[sz]ed (?:copying|reproduction|distribution)", "unauthori"),
]

#: Sentences of license bodies and standard notices, as label and words; whatever stands between words, line ends and comment marks
#: too, is a separator. Each tells its license, or its family where versions share it.
SIGNATURES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("mit", "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise"),
    ("mit-0", "copies of the software and to permit persons to whom the software is furnished to do so the software is provided as is without warranty of any kind"),
    ("x11", "in no event shall the x consortium be liable for any claim damages or other liability"),
    ("x11", "shall not be used in advertising or otherwise to promote the sale use or other dealings in this software without prior written authorization"),
    ("ncsa", "to deal with the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("ncsa", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimers"),
    ("ncsa", "in no event shall the contributors or copyright holders be liable for any claim damages or other liability"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd", "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"),
    ("bsd", "this software is provided by the regents and contributors as is and any express or implied warranties"),
    ("bsd", "this software is provided by the author as is and any express or implied warranties"),
    ("bsd", "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages"),
    ("bsd-2-clause", "should not be interpreted as representing official policies either expressed or implied of the freebsd project"),
    ("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-3-clause", "neither the name of the university nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-3-clause", "the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-3-clause", "the name of the author may not be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("0bsd", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("isc", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("isc", "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"),
    ("isc", "the software is provided as is and isc disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"),
    ("isc", "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits"),
    ("hpnd", "permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted provided that the above copyright notice appear in all copies"),
    ("hpnd", "and that both that copyright notice and this permission notice appear in supporting documentation"),
    ("postgresql", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("postgresql", "in no event shall the university of california be liable to any party for direct indirect special incidental or consequential damages including lost profits"),
    ("apache-1.1", "the end user documentation included with the redistribution if any must include the following acknowledgment"),
    ("apache-1.1", "must not be used to endorse or promote products derived from this software without prior written permission for written permission please contact apache apache org"),
    ("apache-1.1", "products derived from this software may not be called apache nor may apache appear in their name without prior written permission of the apache software foundation"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("apache-2.0", "see the license for the specific language governing permissions and limitations under the license"),
    ("apache-2.0", "license shall mean the terms and conditions for use reproduction and distribution as defined by sections 1 through 9 of this document"),
    ("apache-2.0", "licensor shall mean the copyright owner or entity authorized by the copyright owner that is granting the license"),
    ("apache-2.0", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license to reproduce prepare derivative works of"),
    ("apache-2.0", "irrevocable except as stated in this section patent license to make have made use offer to sell sell import and otherwise transfer the work"),
    ("apache-2.0", "you must give any other recipients of the work or derivative works a copy of this license"),
    ("apache-2.0", "this license does not grant permission to use the trade names trademarks service marks or product names of the licensor"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software"),
    ("zlib", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions"),
    ("zlib", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("zlib", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("zlib", "this notice may not be removed or altered from any source distribution"),
    ("mpl-1.1", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("mpl-1.1", "see the license for the specific language governing rights and limitations under the license"),
    ("mpl-1.1", "the initial developer hereby grants you a world wide royalty free non exclusive license subject to third party intellectual property claims"),
    ("mpl-1.1", "covered code is provided under this license on an as is basis without warranty of any kind either expressed or implied"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-2.0", "covered software means source code form to which the initial contributor has attached the notice in exhibit a"),
    ("mpl-2.0", "any modifications that you create or to which you contribute must be under the terms of this license"),
    ("mpl-2.0", "this source code form is incompatible with secondary licenses as defined by the mozilla public license"),
    ("mpl-2.0", "covered software is provided under this license on an as is basis without warranty of any kind either expressed implied or statutory"),
    ("gpl", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
    ("gpl", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("gpl", "you should have received a copy of the gnu general public license along with this program"),
    ("gpl", "there is no warranty for the program to the extent permitted by applicable law"),
    ("gpl-2.0", "under the terms of the gnu general public license as published by the free software foundation either version 2 of the license"),
    ("gpl-2.0", "under the terms of the gnu general public license version 2 as published by the free software foundation"),
    ("gpl-2.0", "the licenses for most software are designed to take away your freedom to share and change it by contrast the gnu general public license is intended to guarantee your freedom to share and change free software"),
    ("gpl-2.0", "you may copy and distribute verbatim copies of the program s source code as you receive it in any medium provided that you conspicuously and appropriately publish on each copy an appropriate copyright notice and disclaimer of warranty"),
    ("gpl-2.0", "contains or is derived from the program or any part thereof to be licensed as a whole at no charge to all third parties under the terms of this license"),
    ("gpl-2.0", "because the program is licensed free of charge there is no warranty for the program to the extent permitted by applicable law"),
    ("gpl-3.0", "under the terms of the gnu general public license as published by the free software foundation either version 3 of the license"),
    ("gpl-3.0", "the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("gpl-3.0", "designed to take away your freedom to share and change the works by contrast the gnu general public license is intended to guarantee your freedom to share and change all versions of a program"),
    ("gpl", "you may convey verbatim copies of the program s source code as you receive it in any medium provided that you conspicuously and appropriately publish on each copy an appropriate copyright notice"),
    ("lgpl-2.1", "gnu lesser general public license as published by the free software foundation either version 2 1 of the license"),
    ("lgpl-2.1", "the implied warranty of merchantability or fitness for a particular purpose see the gnu lesser general public license for more details"),
    ("lgpl-2.1", "you should have received a copy of the gnu lesser general public license along with this library"),
    ("lgpl-2.1", "a work that contains no derivative of any portion of the library but is designed to work with the library by being compiled or linked with it"),
    ("lgpl-3.0", "gnu lesser general public license as published by the free software foundation either version 3 of the license"),
    ("lgpl-3.0", "this version of the gnu lesser general public license incorporates the terms and conditions of version 3 of the gnu general public license"),
    ("lgpl-3.0", "you may convey a covered work under sections 3 and 4 of this license without being bound by section 3 of the gnu gpl"),
    ("agpl-3.0", "gnu affero general public license as published by the free software foundation either version 3 of the license"),
    ("agpl-3.0", "the gnu affero general public license is a free copyleft license for software and other kinds of works"),
    ("agpl-3.0", "designed to take away your freedom to share and change the works by contrast our general public licenses are intended to guarantee your freedom"),
    ("agpl-3.0", "notwithstanding any other provision of this license if you modify the program your modified version must prominently offer all users interacting with it remotely"),
    ("gfdl-1.3", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license version 1 3"),
    ("epl-1.0", "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0"),
    ("epl-2.0", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0"),
    ("cpl-1.0", "the accompanying program is provided under the terms of this common public license"),
    ("cddl-1.0", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("cddl-1.0", "covered software is provided under this license on an as is basis without warranty of any kind either expressed or implied including without limitation warranties that the covered software is free of defects"),
    ("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("bsl-1.0", "unless such copies or derivative works are solely in the form of machine executable object code generated by a source language processor"),
    ("bsl-1.0", "in no event shall the copyright holders or anyone distributing the software be liable for any damages or other liability whether in contract tort or otherwise"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("unlicense", "dedicate any and all copyright interest in the software to the public domain"),
    ("wtfpl", "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed"),
    ("ofl-1.1", "this font software is licensed under the sil open font license version 1 1"),
    ("ofl-1.1", "must be distributed entirely under this license and must not be distributed under any other license"),
    ("ofl-1.1", "unless explicit written permission is granted by the corresponding copyright holder"),
    ("artistic-1.0", "such that the copyright holder maintains some semblance of artistic control over the development of the package"),
    ("artistic-2.0", "this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed"),
    ("ms-pl", "this license governs use of the accompanying software if you use the software you accept this license"),
    ("ms-rl", "in source code or binary format you must provide recipients the source code to that file along with a copy of this license"),
    ("upl-1.0", "permission is hereby granted to any person obtaining a copy of this software associated documentation and or data collectively the software free of charge"),
    ("blueoak-1.0.0", "this license gives everyone as much permission to work with this software as possible while protecting contributors from liability"),
    ("cc0-1.0", "dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law"),
    ("cc0-1.0", "waives abandons and surrenders all of affirmer s copyright and related rights"),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa-4.0", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc-4.0", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-nd-4.0", "licensed under a creative commons attribution noderivatives 4 0 international license"),
    ("cc-by-nc-sa-4.0", "licensed under a creative commons attribution noncommercial sharealike 4 0 international license"),
    ("cc-by-nc-nd-4.0", "licensed under a creative commons attribution noncommercial noderivatives 4 0 international license"),
    ("cc-by-3.0", "licensed under a creative commons attribution 3 0 unported license"),
    ("cc-by-sa-3.0", "licensed under a creative commons attribution sharealike 3 0 unported license"),
    ("cc-by-nc-3.0", "licensed under a creative commons attribution noncommercial 3 0 unported license"),
    ("psf-2.0", "psf hereby grants licensee a nonexclusive royalty free world wide license to reproduce analyze test perform and or display publicly"),
    ("php-3.01", "the name php must not be used to endorse or promote products derived from this software without prior written permission"),
    ("w3c", "this work is being provided by the copyright holders under the following license"),
    ("zpl-2.1", "names of the copyright holders must not be used to endorse or promote products derived from this software without prior written permission from the copyright holders"),
    ("busl-1.1", "the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work"),
    ("sspl-1.0", "you must make the service source code available via network download to everyone at no charge under the terms of this license"),
    ("eupl-1.2", "applies to the work as defined below which is provided under the terms of this licence"),
    ("odbl-1.0", "license to use the database for the duration of any applicable copyright and database rights"),
    ("lppl-1.3c", "may be distributed and or modified under the conditions of the latex project public license"),
    ("mulanpsl-2.0", "licensed under mulan psl v2 you can use this software according to the terms and conditions of the mulan psl v2"),
]

#: Words of the gate for signatures: each signature has one of them.
SIGNS = ["licen", "copyright", "hereby", "warrant", "redistribut", "liable", "permission", "domain", "advertising", "altered", "misrepresented", "freebsd", "derivative", "exhibit"]

#: Words of the gate; every text with a detection has one of them, a notice's keyword, or a verb before "under".
LICENSED, SPDX, UNDER = "licen", "spdx", "under"
VERBS = "licensed|released|distributed|available|provided|published|redistribute it and or modify it"

#: Words of names that do not tell licenses apart.
COMMON = {"license", "licence", "public", "general", "version", "software", "gnu", "clause", "open", "no", "two", "three", "zero"}

LEVEL_WEIGHT = {1: 0.99, 2: 0.9, 3: 0.6}


def _regex(name: str) -> str:
    """Spaces become runs of separators; the whole is bounded by separators, in either case."""
    body = name.replace(" ?", "\x00").replace(" ", f"{NOT_WORD}++").replace("\x00", f"{NOT_WORD}*+")
    return f"(?i)(?<!{WORD})(?:{body})(?!{WORD})"


def _keyword(spelling: str) -> str:
    """The longest plain word that every text with this spelling must have."""
    plain = re.sub(r"\(\?:[^()]*(?:\([^()]*\)\??[^()]*)*\)\??|.\?", " ", spelling.replace("\\.", "."))
    words = sorted(re.findall(r"[a-z0-9.]{2,}", plain), key=lambda w: (w not in COMMON, len(w)))
    return words[-1].strip(".") if words else LICENSED


def _spellings(name: str) -> list[str]:
    """The alternatives of a name at its top level."""
    out, depth = [""], 0
    for c in name:
        depth += {"(": 1, ")": -1}.get(c, 0)
        if c == "|" and not depth:
            out.append("")
        else:
            out[-1] += c
    return out


def rules() -> list[dict]:
    """All rules in their order: tags, sentences of bodies, notices that say what holds, bare names. A tag per license, three per spelling."""
    out = []
    for label, spdx, _ in NAMES:
        out.append((label, 1, f"(?i)spdx-license-identifier:?[ \t]++{spdx}(?![A-Za-z0-9.+-])", SPDX))
    out += [(label, 2, _regex(words), _keyword(words)) for label, words in SIGNATURES]
    spelled = [(label, s, _keyword(s)) for label, _, name in NAMES for s in _spellings(name)]
    for label, name, keyword in spelled:
        out.append((label, 2, _regex(f"(?:{VERBS}) under (?:the )?(?:terms of (?:the )?)?{name}(?: licen[cs]e)?"), keyword))
    out += [(label, level, _regex(pattern), keyword) for label, level, pattern, keyword in NOTICES]
    for label, name, keyword in spelled:
        out.append((label, 3, _regex(name if "licen" in name else f"{name} licen[cs]e"), keyword))
    for label, name, keyword in spelled:
        out.append((label, 3, _regex(f"licen[cs]e:? (?:the )?{name}"), keyword))
    return [dict(label=a, level=b, pattern=c, keyword=d, rule=i) for i, (a, b, c, d) in enumerate(out)]


RULE_TYPE = "array<struct<label:string,level:int,pattern:string,keyword:string,rule:int>>"


def _rule_array() -> Column:
    return F.from_json(F.lit(json.dumps(rules())), F.lit(RULE_TYPE))


def _detections(text: Column, low: Column) -> Column:
    """All matches of all rules whose keyword is in the text, ordered by start, longest first, best level first."""
    def found(rule: Column) -> Column:
        return F.transform(spans(text, rule["pattern"]), lambda s: F.struct(
            s["start"].alias("start"), (-s["end"]).alias("less_end"), rule["level"].alias("level"),
            rule["rule"].alias("rule"), rule["label"].alias("label")))

    live = F.filter(_rule_array(), lambda r: F.contains(low, r["keyword"]))
    lists = F.filter(F.transform(live, found), lambda x: x.isNotNull())
    return F.array_sort(F.flatten(lists))


def _suppressed(detections: Column) -> Column:
    """Without those that lie inside an earlier one of the same or a better level."""
    def level(kept: int) -> Column:
        def outer(part: Column) -> Column:
            ends = running(F.transform(part, lambda d: -d["less_end"]), F.lit(-1).cast("bigint"), lambda a, x: F.greatest(a, x))
            return let(ends, lambda reach: F.filter(part, lambda d, i: (d["level"] == kept) & (
                (i == 0) | (F.get(reach, i - 1) < -d["less_end"]))))
        return let(F.filter(detections, lambda d: d["level"] <= kept), outer)

    return F.array_sort(F.concat(*[level(k) for k in LEVEL_WEIGHT]))


def scan_licenses(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds to the columns of docs one struct, `license`:

    n_words; base, array of (label, first and last word index, places); detections, array of (start, end, level, label, rule) in
    code points; score, 1 - product of (1 - weight of level) over the kept detections, at least 0.5 where a base phrase stands.
    A column of docs that has this name already comes back as `own_license`, with underscores before it if there is one.
    """
    own, taken = fresh(docs, "_lic_"), fresh(docs, "own_license")
    docs = docs.withColumnsRenamed({c: taken for c in docs.columns if c.lower() == "license"})
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    body = F.coalesce(F.col(text), F.lit(""))
    keywords = list(dict.fromkeys([LICENSED, SPDX, *SIGNS, *(k for *_, k in NOTICES)]))
    gated = docs.withColumn(f"{own}low", low)
    hit = gated[f"{own}low"].contains(keywords[0])
    for word in keywords[1:]:
        hit = hit | gated[f"{own}low"].contains(word)
    hit = hit | (gated[f"{own}low"].contains(UNDER) & body.rlike(_regex(f"(?:{VERBS}) {UNDER}")))
    gated = gated.withColumn(f"{own}gate", hit)
    word_count = lambda s: count_parts(s, NOT_WORD)

    def places(phrase: str) -> Column:
        first = phrase.split(" ")
        pattern = f"(?i)(?<!{WORD})" + f"{NOT_WORD}++".join(first) + f"(?!{WORD})"

        def numbered(gaps: Column) -> Column:
            steps = F.transform(F.slice(gaps, 1, F.size(gaps) - 1), lambda g: word_count(g) + len(first))
            ends = running(steps, F.lit(0).cast("bigint"), lambda a, x: a + x)
            return F.transform(ends, lambda e: e - len(first))

        return let(F.split(body, F.lit(pattern), -1), lambda gaps: F.when(F.size(gaps) > 1, numbered(gaps)))

    base = F.array(*[F.struct(F.lit(label).alias("label"), places(phrase).alias("at")) for phrase, label in BASE.items()])
    found = F.when(gated[f"{own}gate"], F.filter(base, lambda b: b["at"].isNotNull()))
    empty = F.array().cast("array<struct<label:string,at:array<bigint>>>")
    none = F.array().cast("array<struct<start:bigint,less_end:bigint,level:int,rule:int,label:string>>")
    scanned = (
        gated.withColumn(f"{own}base", F.coalesce(found, empty))
        .withColumn(f"{own}found", F.coalesce(F.when(gated[f"{own}gate"], let(_detections(body, F.col(f"{own}low")), _suppressed)), none))
    )
    doubt = F.aggregate(F.col(f"{own}found"), F.lit(1.0), lambda a, d: a * F.when(d["level"] == 1, 1 - LEVEL_WEIGHT[1]).when(
        d["level"] == 2, 1 - LEVEL_WEIGHT[2]).otherwise(1 - LEVEL_WEIGHT[3]))
    score = F.greatest(1 - doubt, F.when(F.size(f"{own}base") > 0, F.lit(0.5)).otherwise(F.lit(0.0)))
    detections = F.transform(F.col(f"{own}found"), lambda d: F.struct(
        d["start"].alias("start"), (-d["less_end"]).alias("end"), d["level"].alias("level"), d["label"].alias("label"), d["rule"].alias("rule")))
    licence = F.struct(
        word_count(body).alias("n_words"), F.col(f"{own}base").alias("base"), detections.alias("detections"), score.alias("score"))
    return scanned.withColumn("license", licence).drop(f"{own}low", f"{own}gate", f"{own}base", f"{own}found")
