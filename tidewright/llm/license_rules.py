"""The signature rules of the licence scan, in order.

A line is ``label | pattern``. Patterns match whole words of the normalised text (lower
case, words of letters and digits, one blank between), so ``2 0`` is "2.0" and ``gpl 3`` is
"GPL-3". A rule is tried only on texts that hold all its words outside brackets and
options, or else all words of an alternative of its first bracket. Sections come by priority: what stands
inside a detection of an earlier section, or inside a longer one of its own, goes.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

#: Confidence that a detection of a section names the text's licence.
SECTIONS: list[tuple[str, float, str]] = [
    (
        "tag", 0.98, r"""
apache-2.0 | spdx license identifier apache 2 0
apache-1.1 | spdx license identifier apache 1 1
mit | spdx license identifier mit
mit-0 | spdx license identifier mit 0
bsd-2-clause | spdx license identifier bsd 2 clause
bsd-3-clause | spdx license identifier bsd 3 clause
bsd-4-clause | spdx license identifier bsd 4 clause
0bsd | spdx license identifier 0bsd
isc | spdx license identifier isc
gpl-1.0 | spdx license identifier gpl 1 0(?: or later| only)?
gpl-2.0-only | spdx license identifier gpl 2 0(?: only)?
gpl-2.0-or-later | spdx license identifier gpl 2 0 or later
gpl-3.0-only | spdx license identifier gpl 3 0(?: only)?
gpl-3.0-or-later | spdx license identifier gpl 3 0 or later
lgpl-2.0 | spdx license identifier lgpl 2 0(?: or later| only)?
lgpl-2.1 | spdx license identifier lgpl 2 1(?: or later| only)?
lgpl-3.0 | spdx license identifier lgpl 3 0(?: or later| only)?
agpl-3.0 | spdx license identifier agpl 3 0(?: or later| only)?
mpl-1.1 | spdx license identifier mpl 1 1
mpl-2.0 | spdx license identifier mpl 2 0(?: no copyleft exception)?
epl-1.0 | spdx license identifier epl 1 0
epl-2.0 | spdx license identifier epl 2 0
cddl-1.0 | spdx license identifier cddl 1 0
cddl-1.1 | spdx license identifier cddl 1 1
eupl-1.1 | spdx license identifier eupl 1 1
eupl-1.2 | spdx license identifier eupl 1 2
unlicense | spdx license identifier unlicense
cc0-1.0 | spdx license identifier cc0 1 0
cc-by-3.0 | spdx license identifier cc by 3 0
cc-by-4.0 | spdx license identifier cc by 4 0
cc-by-sa-4.0 | spdx license identifier cc by sa 4 0
cc-by-nc-4.0 | spdx license identifier cc by nc 4 0
bsl-1.0 | spdx license identifier bsl 1 0
busl-1.1 | spdx license identifier busl 1 1
zlib | spdx license identifier zlib
wtfpl | spdx license identifier wtfpl
artistic-2.0 | spdx license identifier artistic 2 0
ofl-1.1 | spdx license identifier ofl 1 1
psf-2.0 | spdx license identifier (?:psf|python) 2 0
postgresql | spdx license identifier postgresql
""",
    ),
    (
        "text", 0.95, r"""
apache-2.0 | licensed under the apache license,? version 2 0 the license you may not use this file except in compliance with the license
apache-2.0 | unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
apache-2.0 | apache license version 2 0 january 2004
apache-2.0 | subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non exclusive
mit | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | the above copyright notice and this permission notice (?:including the next paragraph )?shall be included in all copies or substantial portions of the software
mit | the software is provided as is without warranty of any kind express or implied
bsd-2-clause | redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution
bsd | redistribution and use in source and binary forms with or without modification are permitted
bsd-3-clause | neither the name of (?:\S+ ){1,12}nor the names of its contributors may be used to endorse or promote products
bsd-4-clause | all advertising materials mentioning features or use of this software must display the following acknowledg?ement
isc | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
0bsd | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided
gpl-2.0-or-later | under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or (?:at your option )?any later version
gpl-3.0-or-later | under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or (?:at your option )?any later version
gpl-2.0-only | under the terms of the gnu general public license version 2 as published by the free software foundation
gpl-2.0 | gnu general public license version 2 june 1991
gpl-3.0 | gnu general public license version 3 29 june 2007
lgpl-2.1 | gnu lesser general public license version 2 1 february 1999
lgpl-2.1-or-later | under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or (?:at your option )?any later version
lgpl-3.0-or-later | under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or (?:at your option )?any later version
lgpl-3.0 | gnu lesser general public license version 3 29 june 2007
agpl-3.0 | gnu affero general public license version 3 19 november 2007
agpl-3.0-or-later | under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or (?:at your option )?any later version
gpl | this program is distributed in the hope that it will be useful but without any warranty
gpl | you should have received a copy of the gnu general public license along with this (?:program|software|file|library)
lgpl | you should have received a copy of the gnu lesser general public license along with this (?:program|software|file|library)
mpl-2.0 | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-1.1 | the contents of this file are subject to the mozilla public license version 1 1
epl-2.0 | this program and the accompanying materials are made available under the terms of the eclipse public license (?:v )?2 0
epl-1.0 | this program and the accompanying materials are made available under the terms of the eclipse public license v1 0
unlicense | this is free and unencumbered software released into the public domain
cc0-1.0 | the person who associated a work with this deed has dedicated the work to the public domain
bsl-1.0 | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
zlib | this software is provided as is without any express or implied warranty in no event will the authors be held liable
wtfpl | everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed
ofl-1.1 | this font software is licensed under the sil open font license version 1 1
artistic-1.0 | the intent of this document is to state the conditions under which a package may be copied
postgresql | permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
beerware | as long as you retain this notice you can do whatever you want with this stuff
json | the software shall be used for good not evil
openssl | this product includes software developed by the openssl project
""",
    ),
    (
        "grant", 0.9, r"""
apache-2.0 | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?apache (?:software )?(?:license )?(?:version |v )?(?:2 0|2)
mit | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?mit licen[cs]e
bsd-2-clause | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?(?:simplified bsd|bsd 2 clause|2 clause bsd)(?: licen[cs]e)?
bsd-3-clause | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?(?:new bsd|modified bsd|bsd 3 clause|3 clause bsd)(?: licen[cs]e)?
bsd | (?:licensed|released|distributed|available|published) under (?:the |a )?(?:terms of )?(?:the )?bsd(?: style)? licen[cs]e
isc | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?isc licen[cs]e
gpl-2.0 | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?(?:gnu general public license|gnu gpl|gpl) (?:version |v )?2(?: 0)?
gpl-3.0 | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?(?:gnu general public license|gnu gpl|gpl) (?:version |v )?3(?: 0)?
gpl-2.0 | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?(?:gplv2|gpl2)
gpl-3.0 | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?(?:gplv3|gpl3)
lgpl-2.1 | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?(?:gnu lesser general public license|gnu lgpl|lgpl) (?:version |v )?2 1
lgpl-3.0 | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?(?:gnu lesser general public license|gnu lgpl|lgpl) (?:version |v )?3(?: 0)?
agpl-3.0 | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?(?:gnu affero general public license|gnu agpl|agpl) (?:version |v )?3(?: 0)?
mpl-2.0 | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?mozilla public license (?:version |v )?2 0
epl-2.0 | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?eclipse public license (?:version |v )?2 0
cddl-1.0 | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?common development and distribution license
eupl-1.2 | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?(?:european union public licen[cs]e|eupl) (?:version |v )?1 2
cc0-1.0 | (?:licensed|released|distributed|available|published|dedicated) (?:under|to) (?:the )?(?:terms of )?(?:the )?(?:cc0|creative commons zero)
cc-by-4.0 | (?:licensed|released|distributed|available|published) under (?:a |the )?(?:terms of )?(?:the )?(?:cc by|creative commons attribution) 4 0(?: international)?
cc-by-3.0 | (?:licensed|released|distributed|available|published) under (?:a |the )?(?:terms of )?(?:the )?(?:cc by|creative commons attribution) 3 0(?: unported)?
cc-by-sa-4.0 | (?:licensed|released|distributed|available|published) under (?:a |the )?(?:terms of )?(?:the )?(?:cc by sa|creative commons attribution share ?alike) 4 0(?: international)?
cc-by-sa-3.0 | (?:licensed|released|distributed|available|published) under (?:a |the )?(?:terms of )?(?:the )?(?:cc by sa|creative commons attribution share ?alike) 3 0(?: unported)?
cc-by-nc-4.0 | (?:licensed|released|distributed|available|published) under (?:a |the )?(?:terms of )?(?:the )?(?:cc by nc|creative commons attribution non ?commercial) 4 0(?: international)?
cc-by-nd-4.0 | (?:licensed|released|distributed|available|published) under (?:a |the )?(?:terms of )?(?:the )?(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s) 4 0(?: international)?
cc-by-nc-sa-4.0 | (?:licensed|released|distributed|available|published) under (?:a |the )?(?:terms of )?(?:the )?(?:cc by nc sa|creative commons attribution non ?commercial share ?alike) 4 0(?: international)?
cc-by-nc-nd-4.0 | (?:licensed|released|distributed|available|published) under (?:a |the )?(?:terms of )?(?:the )?(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s) 4 0(?: international)?
public-domain | (?:released|placed|dedicated) (?:in|into|to) the public domain
unlicense | (?:licensed|released|distributed|available|published) under (?:the )?unlicense
wtfpl | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?wtfpl
zlib | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?zlib(?: libpng)? licen[cs]e
bsl-1.0 | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?boost software license
artistic-2.0 | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?artistic license (?:version |v )?2 0
perl | (?:licensed|released|distributed|available|published|distribute it|modify it) under the same terms as perl
psf-2.0 | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?python software foundation license
ofl-1.1 | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?(?:sil )?open font license
odbl-1.0 | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?open (?:data commons open )?database license
ogl-uk-3.0 | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?open government licen[cs]e
busl-1.1 | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?business source license
sspl-1.0 | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?server side public license
elastic-2.0 | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?elastic license
ms-pl | (?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?microsoft public license
gfdl | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
""",
    ),
    (
        "name", 0.75, r"""
apache-2.0 | apache (?:software )?license (?:version |v )?2(?: 0)?
apache-2.0 | apache 2 0(?: license)?
apache-1.1 | apache (?:software )?license (?:version |v )?1 1
apache-1.0 | apache (?:software )?license (?:version |v )?1 0
apache-2.0 | apache org licenses license 2 0
mit | opensource org licen[cs]es? mit(?: license(?: php)?)?
mit | mit x11 license
mit-0 | mit no attribution
bsd-2-clause | (?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd license)
bsd-3-clause | (?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)
bsd-4-clause | (?:bsd 4 clause|4 clause bsd|original bsd)
bsd-3-clause | opensource org licen[cs]es? bsd 3 clause
gpl-1.0 | (?:gnu general public license|gnu gpl|gpl) (?:version |v )?1 0
gpl-2.0 | (?:gnu general public license|gnu gpl|gpl) (?:version |v )?2(?: 0)?
gpl-3.0 | (?:gnu general public license|gnu gpl|gpl) (?:version |v )?3(?: 0)?
gpl-2.0 | (?:gplv2|gpl2)
gpl-3.0 | (?:gplv3|gpl3)
gpl-2.0 | gnu org licenses (?:old licenses )?gpl 2 0
gpl-3.0 | gnu org licenses gpl 3 0
gpl-2.0 | general public license version 2
gpl-3.0 | general public license version 3
lgpl-2.0 | (?:gnu library general public license|lgpl) (?:version |v )?2(?: 0)?
lgpl-2.1 | (?:gnu lesser general public license|gnu lgpl|lgpl) (?:version |v )?2 1
lgpl-3.0 | (?:gnu lesser general public license|gnu lgpl|lgpl) (?:version |v )?3(?: 0)?
lgpl-2.1 | gnu org licenses (?:old licenses )?lgpl 2 1
lgpl-3.0 | lgplv3
lgpl-2.1 | lgplv2 1
agpl-3.0 | (?:gnu affero general public license|gnu agpl|agpl) (?:version |v )?3(?: 0)?
agpl-3.0 | agplv3
agpl-1.0 | affero general public license (?:version |v )?1(?: 0)?
gfdl-1.1 | gnu free documentation license version 1 1
gfdl-1.2 | gnu free documentation license version 1 2
gfdl-1.3 | gnu free documentation license version 1 3
mpl-1.0 | mozilla public license (?:version |v )?1 0
mpl-1.1 | mozilla public license (?:version |v )?1 1
mpl-2.0 | mozilla public license (?:version |v )?2 0
mpl-2.0 | mozilla org mpl 2 0
epl-1.0 | eclipse public license (?:version |v )?1 0
epl-2.0 | eclipse public license (?:version |v )?2 0
cddl-1.0 | common development and distribution license (?:version |v )?1 0
cddl-1.1 | common development and distribution license (?:version |v )?1 1
cpl-1.0 | common public license (?:version |v )?1 0
eupl-1.1 | european union public licen[cs]e (?:version |v )?1 1
eupl-1.2 | european union public licen[cs]e (?:version |v )?1 2
cecill-2.1 | cecill (?:free software license )?(?:version |v )?2 1
cecill-b | cecill b
cecill-c | cecill c
cc0-1.0 | cc0 (?:1 0|universal)
cc0-1.0 | creativecommons org publicdomain zero 1 0
cc-by-1.0 | (?:cc by|creative commons attribution) 1 0
cc-by-2.0 | (?:cc by|creative commons attribution) 2 0
cc-by-2.5 | (?:cc by|creative commons attribution) 2 5
cc-by-3.0 | (?:cc by|creative commons attribution) 3 0
cc-by-4.0 | (?:cc by|creative commons attribution) 4 0
cc-by-4.0 | creativecommons org licenses by 4 0
cc-by-3.0 | creativecommons org licenses by 3 0
cc-by-sa-2.0 | (?:cc by sa|creative commons attribution share ?alike) 2 0
cc-by-sa-3.0 | (?:cc by sa|creative commons attribution share ?alike) 3 0
cc-by-sa-4.0 | (?:cc by sa|creative commons attribution share ?alike) 4 0
cc-by-sa-4.0 | creativecommons org licenses by sa 4 0
cc-by-sa-3.0 | creativecommons org licenses by sa 3 0
cc-by-nc-2.0 | (?:cc by nc|creative commons attribution non ?commercial) 2 0
cc-by-nc-3.0 | (?:cc by nc|creative commons attribution non ?commercial) 3 0
cc-by-nc-4.0 | (?:cc by nc|creative commons attribution non ?commercial) 4 0
cc-by-nc-4.0 | creativecommons org licenses by nc 4 0
cc-by-nd-3.0 | (?:cc by nd|creative commons attribution no ?deriv(?:ative)?s) 3 0
cc-by-nd-4.0 | (?:cc by nd|creative commons attribution no ?deriv(?:ative)?s) 4 0
cc-by-nd-4.0 | creativecommons org licenses by nd 4 0
cc-by-nc-sa-3.0 | (?:cc by nc sa|creative commons attribution non ?commercial share ?alike) 3 0
cc-by-nc-sa-4.0 | (?:cc by nc sa|creative commons attribution non ?commercial share ?alike) 4 0
cc-by-nc-sa-4.0 | creativecommons org licenses by nc sa 4 0
cc-by-nc-nd-3.0 | (?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s) 3 0
cc-by-nc-nd-4.0 | (?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s) 4 0
cc-by-nc-nd-4.0 | creativecommons org licenses by nc nd 4 0
artistic-1.0 | artistic license (?:version |v )?1 0
artistic-2.0 | artistic license (?:version |v )?2 0
afl-3.0 | academic free license (?:version |v )?3 0
osl-3.0 | open software license (?:version |v )?3 0
ofl-1.0 | open font license (?:version |v )?1 0
ofl-1.1 | open font license (?:version |v )?1 1
bsl-1.0 | boost software license (?:version |v )?1 0
busl-1.1 | business source license (?:version |v )?1 1
sspl-1.0 | server side public license (?:version |v )?1
elastic-2.0 | elastic license (?:version |v )?2(?: 0)?
php-3.01 | php license (?:version |v )?3 01
zpl-2.1 | zope public license (?:version |v )?2 1
psf-2.0 | python software foundation license version 2
ms-pl | ms pl
ms-rl | microsoft reciprocal license
odbl-1.0 | odbl (?:version |v )?1 0
odc-by-1.0 | open data commons attribution license
pddl-1.0 | public domain dedication and license
ogl-uk-3.0 | open government licen[cs]e (?:version |v )?3 0
etalab-2.0 | etalab 2 0
""",
    ),
    (
        "family", 0.5, r"""
apache | apache (?:software )?license
mit | mit licen[cs]e
mit | expat license
x11 | x11 license
bsd | bsd (?:style )?licen[cs]e
isc | isc licen[cs]e
gpl | gnu general public license
gpl | gnu gpl
gpl | gpl
lgpl | (?:gnu )?(?:lesser|library) general public license
lgpl | lgpl
agpl | (?:gnu )?affero general public license
agpl | agpl
gfdl | gnu free documentation license
mpl | mozilla public license
epl | eclipse public license
cddl | cddl
eupl | european union public licen[cs]e
cecill | cecill
cc | creative commons
cc-by-nc | cc by nc
cc-by-sa | cc by sa
cc-by-nd | cc by nd
cc-by-nc-sa | cc by nc sa
cc-by-nc-nd | cc by nc nd
cc-by | creative commons attribution
cc0-1.0 | cc0
artistic | artistic license
afl | academic free license
osl | open software license
ofl | open font license
bsl-1.0 | boost software license
busl | business source license
sspl | server side public license
elastic | elastic license
php | php license
psf | python software foundation license
zlib | zlib license
wtfpl | wtfpl
unlicense | unlicense
beerware | beerware
odbl | open database license
ogl-uk | open government licen[cs]e
ms-pl | microsoft public license
sleepycat | sleepycat license
openssl | openssl license
ncsa | university of illinois ncsa open source license
vim | vim license
""",
    ),
    (
        "hint", 0.25, r"""
public-domain | public domain
copyleft | copyleft
proprietary | proprietary (?:and confidential|software|license)
proprietary | confidential and proprietary
proprietary | do not (?:re)?distribute
no-commercial | (?:not for|no|non) commercial use
no-derivatives | no derivative works
no-warranty | without warranty of any kind
no-warranty | without any warranty
attribution | attribution required
reserved | some rights reserved
reserved | no rights reserved
copyright | copyright (?:c )?(?:19|20)[0-9][0-9]
copyright | (?:19|20)[0-9][0-9] (?:\S+ ){1,6}all rights reserved
unnamed | (?:licensed|released|distributed) under (?:a|the) \S+ licen[cs]e
unnamed | see (?:the )?licen[cs]e (?:file|txt|md)
""",
    ),
]

#: Phrases whose every place counts, whatever covers it. Fixed values.
BASE = (("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved"))
#: Rank of a place of a base phrase among the sections, and its confidence.
BASE_PRIORITY, BASE_WEIGHT = 5, 0.4


@dataclass(frozen=True)
class Rule:
    number: int
    label: str
    priority: int
    weight: float
    words: tuple[frozenset[str], ...]  # sets, one of which a text must hold whole for the rule to be tried
    pattern: re.Pattern[bytes]
    base: bool = False


def _plain_words(pattern: str) -> frozenset[str]:
    """Words that stand in every match: outside brackets, and untouched by an option."""
    depth, flat = 0, ""
    for c in pattern:
        depth += c == "("
        flat += "\0" if depth else c
        depth -= c == ")"
    return frozenset(w for w in flat.split(" ") if re.fullmatch("[a-z0-9]+", w))


def _rule(number: int, label: str, pattern: str, priority: int, weight: float, base: bool = False) -> Rule:
    words = _plain_words(pattern)
    sets = (words,) if words else tuple(_plain_words(p) for p in pattern[3 : pattern.index(")")].split("|"))
    # A place starts after a blank and ends before one; the text is taken with a blank at either end.
    return Rule(number, label, priority, weight, sets, re.compile(f"(?<= )(?:{pattern})(?= )".encode()), base)


def rules() -> list[Rule]:
    """All rules, base phrases first."""
    out = [_rule(k, label, phrase, BASE_PRIORITY, BASE_WEIGHT, True) for k, (label, phrase) in enumerate(BASE)]
    for priority, (_, weight, lines) in enumerate(SECTIONS):
        for line in lines.strip().split("\n"):
            label, pattern = line.split(" | ")
            out.append(_rule(len(out), label, pattern, priority, weight))
    return out
