"""Signature rules for license texts, over lower-case words with one space between them.

Each rule has a priority (1 is strongest), a label, keywords of which every match
holds one, a weight and a regular expression. Keywords start a word. The order of the list
breaks ties.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    priority: int
    label: str
    weight: float
    keyword: str  # one or several, with | between them
    pattern: str
    base: bool = False
    also: str = ""  # a second keyword that every match holds


#: Phrases and labels that are reported as such, whatever else is found. Fixed values.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

#: label | identifier in words | keywords of the name, with / between them | name | address in words
LICENSES = r"""
mit | mit | mit/expat | (?:mit|expat)(?: x11)? licen[cs]e | (?:opensource org licenses mit(?: license)?|choosealicense com licenses mit)
mit-0 | mit 0 | mit | mit no attribution licen[cs]e | opensource org licenses mit 0
apache-1 | apache 1 [01] | apache | apache (?:software )?licen[cs]e(?: version)? 1(?: [01])? | apache org licenses license 1 [01]
apache-2 | apache 2 0 | apache | apache(?: software)? licen[cs]e(?: version)? ?v?2(?: 0)?|apache 2(?: 0)? licen[cs]e | apache org licenses license 2 0
gpl-1 | gpl 1 0(?: only| or later)? | gnu | gnu general public licen[cs]e(?: as published by the free software foundation)?(?: either)?(?: version)? v?1(?: 0)? | gnu org licenses (?:old licenses )?gpl 1 0
gpl-2 | gpl 2 0(?: only| or later)? | gnu | gnu general public licen[cs]e(?: as published by the free software foundation)?(?: either)?(?: version)? v?2(?: 0)? | gnu org licenses (?:old licenses )?gpl 2 0
gpl-3 | gpl 3 0(?: only| or later)? | gnu | gnu general public licen[cs]e(?: as published by the free software foundation)?(?: either)?(?: version)? v?3(?: 0)? | gnu org licenses gpl(?: 3 0)?(?: en)?(?: html)?
gpl | gpl | gnu | gnu (?:gpl|general public licen[cs]e) | gnu org (?:copyleft|licenses) gpl
lgpl-2.1 | lgpl 2 1(?: only| or later)? | gnu | gnu lesser general public licen[cs]e(?: version)? v?2(?: 1)? | gnu org licenses (?:old licenses )?lgpl 2 1
lgpl-3 | lgpl 3 0(?: only| or later)? | gnu | gnu lesser general public licen[cs]e(?: version)? v?3(?: 0)? | gnu org licenses lgpl 3 0
lgpl | lgpl | gnu | gnu (?:lgpl|(?:lesser|library) general public licen[cs]e) | gnu org (?:copyleft lesser|licenses lgpl)
agpl-3 | agpl 3 0(?: only| or later)? | gnu | gnu affero general public licen[cs]e(?: version)?(?: v?3(?: 0)?)? | gnu org licenses agpl(?: 3 0)?
fdl | gfdl 1 [123](?: only| or later)? | gnu | gnu free documentation licen[cs]e(?: version)?(?: 1(?: [123])?)? | gnu org (?:copyleft|licenses) fdl(?: 1 [123])?
bsd-1 | bsd 1 clause | bsd | (?:bsd 1 clause|1 clause bsd) licen[cs]e | opensource org licenses bsd 1 clause
bsd-2 | bsd 2 clause(?: patent| views)? | bsd | (?:bsd 2 clause|2 clause bsd|simplified bsd)(?: licen[cs]e)? | opensource org licenses bsd 2 clause
bsd-3 | bsd 3 clause(?: clear| lbnl)? | bsd | (?:bsd 3 clause|3 clause bsd|(?:new|revised|modified) bsd)(?: licen[cs]e)? | opensource org licenses bsd 3 clause
bsd-4 | bsd 4 clause(?: uc)? | bsd | (?:bsd 4 clause|4 clause bsd|original bsd)(?: licen[cs]e)? | spdx org licenses bsd 4 clause
bsd-0 | 0bsd | bsd | (?:zero clause bsd|bsd zero clause)(?: licen[cs]e)? | opensource org licenses 0bsd
bsd | bsd | bsd | bsd(?: style)? licen[cs]e | opensource org licenses bsd license
isc | isc | isc | isc licen[cs]e | opensource org licenses isc(?: license)?
mpl-1.1 | mpl 1 1 | mozilla | mozilla public licen[cs]e(?: version)? v?1(?: [01])? | mozilla org mpl (?:mpl )?1 1
mpl-2 | mpl 2 0 | mozilla | mozilla public licen[cs]e(?: version)? v?2(?: 0)? | mozilla org mpl 2 0
mpl | mpl | mozilla | mozilla public licen[cs]e | mozilla org mpl
epl-1 | epl 1 0 | eclipse | eclipse public licen[cs]e(?: version)? v?1(?: 0)? | eclipse org legal epl v10
epl-2 | epl 2 0 | eclipse | eclipse public licen[cs]e(?: version)? v?2(?: 0)? | eclipse org legal epl (?:v20|2 0)
edl | bsd 3 clause eclipse | eclipse | eclipse distribution licen[cs]e(?: version)?(?: v?1(?: 0)?)? | eclipse org (?:org )?documents edl v10
cddl | cddl 1 [01] | common development | common development and distribution licen[cs]e(?: version)?(?: 1(?: [01])?)? | opensource org licenses cddl(?: 1 [01])?
cpl | cpl 1 0 | common public | common public licen[cs]e(?: version)?(?: 1(?: 0)?)? | opensource org licenses cpl1 0
artistic-1 | artistic 1 0(?: perl| cl8)? | artistic | artistic licen[cs]e(?: version)? 1(?: 0)? | opensource org licenses artistic license 1 0
artistic-2 | artistic 2 0 | artistic | artistic licen[cs]e(?: version)? 2(?: 0)? | opensource org licenses artistic license 2 0
boost | bsl 1 0 | boost | boost software licen[cs]e(?: version)?(?: 1(?: 0)?)? | boost org license 1 0
bsl-1.1 | busl 1 1 | business source | business source licen[cs]e(?: version)?(?: 1(?: 1)?)? | mariadb com bsl11
zlib | zlib | zlib | zlib(?: libpng)? licen[cs]e | (?:zlib net zlib license|opensource org licenses zlib(?: license)?)
libpng | libpng(?: 2 0)? | libpng/png reference | (?:png reference library|libpng) licen[cs]e(?: version)?(?: 2)? | libpng org pub png src libpng license
unlicense | unlicense | unlicense | (?:the )?unlicense | unlicense org
wtfpl | wtfpl | public licen | do what the f\S* you want to public licen[cs]e | wtfpl net
cc0 | cc0 1 0 | cc0 | (?:creative commons )?cc0(?: 1 0)?(?: universal)?(?: public domain dedication)? | creativecommons org publicdomain zero 1 0
pdm | cc pddc | public domain | (?:public domain mark|released (?:in|into|to) the public domain|dedicated to the public domain) | creativecommons org publicdomain mark 1 0
cc-by | cc by [1234] 0 | creative commons | creative commons attribution(?: (?:[1234] 0|generic|unported|international)){0,6}(?: licen[cs]e)? | creativecommons org licenses by [1234] 0
cc-by-sa | cc by sa [1234] 0 | creative commons | creative commons attribution share ?alike(?: (?:[1234] 0|generic|unported|international)){0,6}(?: licen[cs]e)? | creativecommons org licenses by sa [1234] 0
cc-by-nc | cc by nc [1234] 0 | creative commons | creative commons attribution non ?commercial(?: (?:[1234] 0|generic|unported|international)){0,6}(?: licen[cs]e)? | creativecommons org licenses by nc [1234] 0
cc-by-nd | cc by nd [1234] 0 | creative commons | creative commons attribution no ?deriv(?:ative)?s?(?: works)?(?: (?:[1234] 0|generic|unported|international)){0,6}(?: licen[cs]e)? | creativecommons org licenses by nd [1234] 0
cc-by-nc-sa | cc by nc sa [1234] 0 | creative commons | creative commons attribution non ?commercial share ?alike(?: (?:[1234] 0|generic|unported|international)){0,6}(?: licen[cs]e)? | creativecommons org licenses by nc sa [1234] 0
cc-by-nc-nd | cc by nc nd [1234] 0 | creative commons | creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?(?: (?:[1234] 0|generic|unported|international)){0,6}(?: licen[cs]e)? | creativecommons org licenses by nc nd [1234] 0
odbl | odbl 1 0 | open data | open (?:data commons open )?data(?:base)? licen[cs]e|open data commons open database licen[cs]e | opendatacommons org licenses odbl(?: 1 0)?
odc-by | odc by 1 0 | open data | open data commons attribution licen[cs]e | opendatacommons org licenses by(?: 1 0)?
pddl | pddl 1 0 | public domain | (?:open data commons )?public domain dedication and licen[cs]e | opendatacommons org licenses pddl(?: 1 0)?
ogl | ogl uk [123] 0 | open government | open government licen[cs]e(?: v?[123](?: 0)?)? | nationalarchives gov uk doc open government licence
etalab | etalab 2 0 | etalab | (?:licence ouverte|open licen[cs]e) etalab|etalab open licen[cs]e | etalab gouv fr licence ouverte
eupl | eupl 1 [012] | european union public | european union public licen[cs]e(?: v(?:ersion)?)?(?: 1(?: [012])?)? | joinup ec europa eu (?:software page )?eupl
cecill | cecill(?: [12](?: [01])?| b| c)? | cecill | cecill(?: b| c)?(?: free software)? licen[cs]e | cecill info licences
ms-pl | ms pl | microsoft | microsoft public licen[cs]e | opensource org licenses ms pl
ms-rl | ms rl | microsoft | microsoft reciprocal licen[cs]e | opensource org licenses ms rl
python | psf 2 0|python 2 0(?: 1)? | python software | python software foundation licen[cs]e(?: version)?(?: 2)? | docs python org 3 license
php | php 3 0(?: 1)? | php | php licen[cs]e(?: version)?(?: 3(?: 0(?: 1)?)?)? | php net license 3 0(?: 1)?
ruby | ruby | ruby | ruby licen[cs]e | ruby lang org en about license
postgresql | postgresql | postgresql | postgresql licen[cs]e | postgresql org about licence
openssl | openssl | openssl | openssl licen[cs]e | openssl org source license
ofl | ofl 1 [01](?: rfn| no rfn)? | open font | (?:sil )?open font licen[cs]e(?: version)?(?: 1(?: [01])?)? | scripts sil org ofl
ncsa | ncsa | illinois | (?:university of )?illinois(?: ncsa)? open source licen[cs]e | opensource org licenses ncsa
w3c | w3c(?: 20150513)? | w3c | w3c software(?: notice)?(?: and document)?(?: notice and)? licen[cs]e | w3 org consortium legal copyright software
afl | afl [123] [01] | academic free | academic free licen[cs]e(?: v(?:ersion)? ?[123] [01])? | opensource org licenses afl 3 0
osl | osl [123] [01] | open software | open software licen[cs]e(?: v(?:ersion)? ?[123] [01])? | opensource org licenses osl 3 0
upl | upl 1 0 | universal permissive | universal permissive licen[cs]e(?: v?1(?: 0)?)? | oss oracle com licenses upl
mulan | mulanpsl [12] 0 | mulan | mulan permissive software licen[cs]e(?: v?[12])? | license coscl org cn mulanpsl2
sspl | sspl 1 0 | server side | server side public licen[cs]e(?: version)?(?: 1)? | mongodb com licensing server side public license
elastic | elastic 2 0 | elastic | elastic licen[cs]e(?: version)?(?: 2(?: 0)?)? | elastic co licensing elastic license
polyform | polyform (?:noncommercial|small business) 1 0 0 | polyform | polyform (?:noncommercial|small business|shield|strict) licen[cs]e(?: 1 0 0)? | polyformproject org licenses
openrail | openrail | openrail/open rail | (?:bigscience |creativeml )?open ?rail(?: m)?(?: licen[cs]e)? | huggingface co spaces bigscience license
llama | llama[ 23]* | llama | llama [23] community licen[cs]e(?: agreement)? | llama meta com llama[ 23]* license
"""

#: priority, label, weight, keyword, pattern: wordings that licenses are known by, and weak signs
WORDINGS = (
    (1, "mit", 1.0, "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    (2, "mit", 0.9, "the above copyright notice", r"the above copyright notice and this permission notice shall be included in all"),
    (1, "isc", 1.0, "permission to use", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    (1, "bsd", 1.0, "redistribution and use", r"redistribution and use in source and binary forms with or without modification are permitted"),
    (2, "bsd-3", 0.9, "endorse or promote", r"may be used to endorse or promote products derived from this software"),
    (2, "bsd-4", 0.9, "advertising materials", r"all advertising materials mentioning features or use of this software must display"),
    (1, "zlib", 1.0, "provided as is", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    (1, "gpl", 1.0, "free software", r"this program is free software you can redistribute it and or modify it"),
    (1, "lgpl", 1.0, "free software", r"this library is free software you can redistribute it and or modify it"),
    (1, "apache-2", 1.0, "compliance with the license", r"you may not use this file except in compliance with the license"),
    (2, "apache-2", 0.8, "as is basis", r"distributed on an as is basis without warranties or conditions of any kind"),
    (1, "boost", 1.0, "permission is hereby granted", r"permission is hereby granted free of charge to any person or organization obtaining a copy"),
    (1, "unlicense", 1.0, "unencumbered", r"this is free and unencumbered software released into the public domain"),
    (1, "mpl", 1.0, "source code form", r"this source code form is subject to the terms of the mozilla public licen[cs]e"),
    (2, "ofl", 0.9, "reserved font|font software", r"this font software is licensed under the sil open font licen[cs]e|with reserved font names?"),
    (2, "cc-by-nc", 0.9, "cc by", r"cc by nc(?: [1234] 0)?"),
    (2, "cc-by-nc-sa", 0.9, "cc by", r"cc by nc sa(?: [1234] 0)?"),
    (2, "cc-by-nc-nd", 0.9, "cc by", r"cc by nc nd(?: [1234] 0)?"),
    (2, "cc-by-sa", 0.9, "cc by", r"cc by sa(?: [1234] 0)?"),
    (2, "cc-by-nd", 0.9, "cc by", r"cc by nd(?: [1234] 0)?"),
    (3, "cc-by", 0.8, "cc by", r"cc by(?: [1234] 0)?"),
    (3, "gpl-2", 0.7, "gpl", r"gpl ?v? ?2(?: 0)?(?: or later)?"),
    (3, "gpl-3", 0.7, "gpl", r"gpl ?v? ?3(?: 0)?(?: or later)?"),
    (3, "lgpl", 0.7, "lgpl", r"lgpl(?: ?v?(?:2 1|3(?: 0)?))?"),
    (3, "agpl-3", 0.7, "agpl", r"agpl(?: ?v?3(?: 0)?)?"),
    (4, "gpl", 0.5, "gpl", r"gpl licen[cs]ed?|licen[cs]ed under (?:the )?gpl"),
    (4, "proprietary", 0.7, "all rights reserved", r"all rights reserved"),
    (3, "proprietary", 0.8, "confidential", r"(?:proprietary and confidential|confidential and proprietary)"),
    (4, "proprietary", 0.7, "without permission", r"(?:may not be|no part \S+ \S+ \S+ may be) (?:copied|reproduced|distributed)(?: \S+){0,4} without permission"),
    (5, "copyright", 0.3, "copyright", r"copyright(?: c)? (?:19|20)[0-9]{2}"),
    (5, "other", 0.3, "license agreement", r"(?:end user |software )?license agreement"),
    (5, "other", 0.3, "licen", r"(?:licen[cs]ed|released|distributed) under (?:the )?(?:terms of )?(?:the )?(?:\S+ ){0,4}licen[cs]e"),
)

UNDER = (
    r"(?:licen[cs]ed|released|distributed|available|published|provided|shared|covered)(?: under| by| with| subject to)"
    r"(?: the)?(?: terms)?(?: and conditions)?(?: of)?(?: the)? "
)


def rules() -> list[Rule]:
    """The phrases, then for each license its identifier, its address, its name after a licensing verb and its bare
    name, then the wordings."""
    out = [Rule(1, label, 1.0, phrase, phrase, True) for label, phrase in PHRASES]
    for line in LICENSES.strip().splitlines():
        label, tag, keyword, name, address = (part.strip() for part in line.split(" | "))
        keyword = keyword.replace("/", "|")
        also = "" if label in BARE else "licen"
        host = address.split(" org")[0] if " org" in address else ""
        out += [
            Rule(1, label, 1.0, "spdx", rf"spdx (?:license|licence) identifier (?:{tag})", also="licen"),
            Rule(2, label, 0.95, URL_WORDS.get(label, host.split(" ")[-1] if host and "(" not in host else "licen"), rf"(?:https? )?(?:www )?{address}"),
            Rule(3, label, 0.9, keyword, rf"{UNDER}(?:{name})", also=also),
            Rule(4, label, 0.6, keyword, rf"(?:{name})", also=also),
        ]
    return out + [Rule(*w) for w in WORDINGS]


#: Labels whose name can stand without the word license.
BARE = {
    "bsd-0", "bsd-2", "bsd-3", "bsd-4", "unlicense", "cc0", "pdm", "cc-by", "cc-by-sa", "cc-by-nc", "cc-by-nd", "cc-by-nc-sa",
    "cc-by-nc-nd", "openrail", "gpl", "lgpl",
}

#: A word that every match of the address has, where the site's name isn't one.
URL_WORDS = {
    "mit": "licenses mit",
    "gpl": "gnu org",
    "lgpl": "gnu org",
    "bsl-1.1": "mariadb com",
    "zlib": "zlib",
    "fdl": "gnu org",
    "wtfpl": "wtfpl net",
    "cecill": "cecill info",
    "eupl": "joinup",
    "etalab": "etalab",
    "ogl": "nationalarchives",
    "php": "php net",
    "upl": "oss oracle com",
    "mulan": "coscl",
    "sspl": "mongodb com",
    "elastic": "elastic co",
    "openrail": "huggingface co",
    "llama": "llama meta com",
}
