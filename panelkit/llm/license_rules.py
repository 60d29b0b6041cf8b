"""Signature rules of the license scan: hand-written regexes over normalised text.

Normalised text has lower-case words with one blank between them: whatever is no letter or digit is a blank. A rule
is a regex over whole words. ``TITLES`` has a line for each license: its label, a word that each of its
titles holds, the regex of its titles, the regex of its identifiers, and a word that each identifier holds. A line
gives three rules: the identifier behind an SPDX tag, a notice that puts something under the title, and the bare
title. ``SENTENCES`` has the wording of the licenses themselves and of common notices: tier, label, word, regex.
Tiers: 1 wording or tag, 2 notice, 3 title, 4 loose mention.
"""

from __future__ import annotations

from dataclasses import dataclass

TITLES = r"""
mit | mit | (?:the )?(?:x11 )?mit(?: x11)? licen[cs]es? | mit(?: x11)? | mit
mit-0 | attribution | mit no attribution licen[cs]e | mit 0 | mit
apache-1.0 | apache | apache (?:software )?licen[cs]e (?:version |v )?1 0 | apache 1 0 | apache
apache-1.1 | apache | apache (?:software )?licen[cs]e (?:version |v )?1 1 | apache 1 1 | apache
apache-2.0 | apache | apache (?:software )?licen[cs]e (?:version |v )?v?2(?: 0)? | apache 2 0 | apache
apache | apache | (?:the )?apache (?:software )?(?:foundation )?licen[cs]es? | apache | apache
gpl-1.0 | general | (?:gnu )?general public licen[cs]e (?:version |v )?v?1(?: 0)? | gpl 1 0(?: only| or later)? | gpl
gpl-2.0 | general | (?:gnu )?general public licen[cs]e (?:version |v )?v?2(?: 0)? | gpl 2 0(?: only| or later)? | gpl
gpl-3.0 | general | (?:gnu )?general public licen[cs]e (?:version |v )?v?3(?: 0)? | gpl 3 0(?: only| or later)? | gpl
gpl | general | (?:the )?(?:gnu )?general public licen[cs]es? | gpl | gpl
lgpl-2.0 | library | (?:gnu )?library general public licen[cs]e(?: version 2(?: 0)?)? | lgpl 2 0(?: only| or later)? | lgpl
lgpl-2.1 | lesser | (?:gnu )?lesser general public licen[cs]e (?:version |v )?v?2 1 | lgpl 2 1(?: only| or later)? | lgpl
lgpl-3.0 | lesser | (?:gnu )?lesser general public licen[cs]e (?:version |v )?v?3(?: 0)? | lgpl 3 0(?: only| or later)? | lgpl
lgpl | lesser | (?:the )?(?:gnu )?lesser general public licen[cs]es? | lgpl | lgpl
agpl-3.0 | affero | (?:gnu )?affero general public licen[cs]e (?:version |v )?v?3(?: 0)? | agpl 3 0(?: only| or later)? | agpl
agpl | affero | (?:the )?(?:gnu )?affero general public licen[cs]es? | agpl | agpl
gfdl | documentation | (?:the )?(?:gnu )?free documentation licen[cs]e(?: version 1 [123])? | gfdl 1 [123](?: only| or later)? | gfdl
bsd-2-clause | bsd | (?:the )?(?:2 clause|two clause|simplified|freebsd) bsd licen[cs]e | bsd 2 clause | bsd
bsd-3-clause | bsd | (?:the )?(?:3 clause|three clause|new|modified|revised) bsd licen[cs]e | bsd 3 clause | bsd
bsd-4-clause | bsd | (?:the )?(?:4 clause|four clause|original|old) bsd licen[cs]e | bsd 4 clause | bsd
0bsd | bsd | (?:zero clause|0 clause|free public) bsd licen[cs]e | 0bsd | 0bsd
bsd | bsd | (?:the )?(?:berkeley )?bsd(?: style)? licen[cs]es? | bsd | bsd
isc | isc | (?:the )?isc licen[cs]e | isc | isc
mpl-1.0 | mozilla | mozilla public licen[cs]e (?:version |v )?1 0 | mpl 1 0 | mpl
mpl-1.1 | mozilla | mozilla public licen[cs]e (?:version |v )?1 1 | mpl 1 1 | mpl
mpl-2.0 | mozilla | mozilla public licen[cs]e (?:version |v )?v?2(?: 0)? | mpl 2 0 | mpl
mpl | mozilla | (?:the )?mozilla public licen[cs]es? | mpl | mpl
epl-1.0 | eclipse | eclipse public licen[cs]e (?:version |v )?1 0 | epl 1 0 | epl
epl-2.0 | eclipse | eclipse public licen[cs]e (?:version |v )?v?2(?: 0)? | epl 2 0 | epl
epl | eclipse | (?:the )?eclipse public licen[cs]e | epl | epl
edl | distribution | eclipse distribution licen[cs]e(?: version 1 0)? | edl 1 0 | edl
cddl-1.0 | development | common development and distribution licen[cs]e(?: version)? 1 0 | cddl 1 0 | cddl
cddl-1.1 | development | common development and distribution licen[cs]e(?: version)? 1 1 | cddl 1 1 | cddl
cddl | development | common development and distribution licen[cs]e | cddl | cddl
cpl-1.0 | common | common public licen[cs]e(?: version 1 0)? | cpl 1 0 | cpl
cpal-1.0 | attribution | common public attribution licen[cs]e(?: version 1 0)? | cpal 1 0 | cpal
ipl-1.0 | ibm | ibm public licen[cs]e(?: version 1 0)? | ipl 1 0 | ipl
eupl-1.1 | european | european union public licen[cs]e (?:version |v )?1 1 | eupl 1 1 | eupl
eupl-1.2 | european | european union public licen[cs]e (?:version |v )?1 2 | eupl 1 2 | eupl
eupl | european | european union public licen[cs]e | eupl | eupl
cecill-2.1 | cecill | cecill (?:free software )?licen[cs]e(?: agreement)?(?: version 2 1)? | cecill 2 1 | cecill
cecill-b | cecill | cecill b (?:free software )?licen[cs]e(?: agreement)? | cecill b | cecill
cecill-c | cecill | cecill c (?:free software )?licen[cs]e(?: agreement)? | cecill c | cecill
artistic-1.0 | artistic | (?:perl )?artistic licen[cs]e (?:version )?1 0 | artistic 1 0(?: perl)? | artistic
artistic-2.0 | artistic | (?:perl )?artistic licen[cs]e (?:version )?2 0 | artistic 2 0 | artistic
artistic | artistic | (?:the )?(?:perl |clarified )?artistic licen[cs]e | artistic | artistic
bsl-1.0 | boost | boost software licen[cs]e(?: version 1 0)? | bsl 1 0 | bsl
busl-1.1 | business | business source licen[cs]e(?: version)?(?: 1 1)? | busl 1 1 | busl
elastic-2.0 | elastic | elastic licen[cs]e(?: version)?(?: 2 0)? | elastic 2 0 | elastic
sspl-1.0 | server | server side public licen[cs]e(?: version 1)? | sspl 1 0 | sspl
osl-3.0 | open | open software licen[cs]e (?:version |v )?3 0 | osl 3 0 | osl
afl-3.0 | academic | academic free licen[cs]e(?: version)?(?: v)?(?: 3 0)? | afl 3 0 | afl
ms-pl | microsoft | microsoft public licen[cs]e(?: ms pl)? | ms pl | pl
ms-rl | microsoft | microsoft reciprocal licen[cs]e(?: ms rl)? | ms rl | rl
zlib | zlib | (?:the )?zlib(?: libpng)? licen[cs]e | zlib(?: acknowledgement)? | zlib
libpng | libpng | (?:the )?(?:png reference library )?libpng licen[cs]e(?: version 2)? | libpng(?: 2 0)? | libpng
unlicense | unlicense | (?:the )?unlicense | unlicense | unlicense
wtfpl | want | do what the fuck you want to public licen[cs]e | wtfpl | wtfpl
cc0-1.0 | cc0 | (?:creative commons )?cc0(?: 1 0)?(?: universal)?(?: public domain dedication)? licen[cs]e | cc0 1 0 | cc0
cc-by-4.0 | attribution | (?:creative commons )attribution 4 0(?: international)?(?: public)? licen[cs]e | cc by 4 0 | cc
cc-by-3.0 | attribution | (?:creative commons )attribution 3 0(?: unported)? licen[cs]e | cc by 3 0 | cc
cc-by-2.0 | attribution | (?:creative commons )attribution 2 0(?: generic)? licen[cs]e | cc by 2 0 | cc
cc-by-sa-4.0 | sharealike | (?:creative commons )?attribution sharealike 4 0(?: international)?(?: public)? licen[cs]e | cc by sa 4 0 | cc
cc-by-sa-3.0 | sharealike | (?:creative commons )?attribution sharealike 3 0(?: unported)? licen[cs]e | cc by sa 3 0 | cc
cc-by-nc-4.0 | noncommercial | (?:creative commons )?attribution noncommercial 4 0(?: international)?(?: public)? licen[cs]e | cc by nc 4 0 | cc
cc-by-nd-4.0 | noderivatives | (?:creative commons )?attribution noderivatives 4 0(?: international)?(?: public)? licen[cs]e | cc by nd 4 0 | cc
cc-by-nc-sa-4.0 | noncommercial | (?:creative commons )?attribution noncommercial sharealike 4 0(?: international)?(?: public)? licen[cs]e | cc by nc sa 4 0 | cc
cc-by-nc-nd-4.0 | noncommercial | (?:creative commons )?attribution noncommercial noderivatives 4 0(?: international)?(?: public)? licen[cs]e | cc by nc nd 4 0 | cc
cc | commons | (?:a |the )?creative commons(?: \S+){0,4} licen[cs]es? | cc | cc
odbl-1.0 | database | open (?:data commons open )?database licen[cs]e(?: v?1 0)? | odbl 1 0 | odbl
odc-by-1.0 | commons | open data commons attribution licen[cs]e(?: v?1 0)? | odc by 1 0 | odc
pddl-1.0 | domain | (?:open data commons )?public domain dedication and licen[cs]e | pddl 1 0 | pddl
ofl-1.1 | font | (?:sil )?open font licen[cs]e(?: version)?(?: 1 1)? | ofl 1 1 | ofl
psf-2.0 | python | python software foundation licen[cs]e(?: version 2)? | psf 2 0 | psf
python-2.0 | python | python licen[cs]e (?:version )?2(?: 0)? | python 2 0 | python
php-3.01 | php | php licen[cs]e(?: version)?(?: 3 01)? | php 3 01 | php
ruby | ruby | (?:the )?ruby licen[cs]e | ruby | ruby
openssl | openssl | (?:the )?openssl licen[cs]e | openssl | openssl
ssleay | ssleay | (?:the )?(?:original )?ssleay licen[cs]e | ssleay | ssleay
w3c | w3c | w3c software(?: notice)?(?: and)? licen[cs]e | w3c | w3c
ncsa | illinois | (?:university of )?illinois(?: ncsa)? open source licen[cs]e | ncsa | ncsa
postgresql | postgresql | (?:the )?postgresql licen[cs]e | postgresql | postgresql
curl | curl | (?:the )?curl licen[cs]e | curl | curl
icu | icu | (?:the )?icu licen[cs]e | icu | icu
unicode | unicode | unicode(?: data files and software)?(?: v3)? licen[cs]e(?: agreement)? | unicode dfs 20(?:15|16) | unicode
upl-1.0 | universal | universal permissive licen[cs]e(?: \S+){0,2} 1 0 | upl 1 0 | upl
vim | vim | (?:the )?vim licen[cs]e | vim | vim
qpl-1.0 | q | (?:the )?q public licen[cs]e(?: version 1 0)? | qpl 1 0 | qpl
sleepycat | sleepycat | (?:the )?sleepycat (?:public )?licen[cs]e | sleepycat | sleepycat
tcl | tcl | (?:the )?tcl(?: tk)? licen[cs]e | tcl | tcl
blueoak-1.0.0 | oak | blue oak model licen[cs]e(?: 1 0 0)? | blueoak 1 0 0 | blueoak
llama2 | llama | llama 2 community licen[cs]e(?: agreement)? | llama 2 | llama
openrail | responsible | (?:creative ml |bigscience )?open ?rail m? ?responsible (?:ai )?licen[cs]e | openrail(?: m)? | openrail
"""

SENTENCES = r"""
1 | mit | hereby | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
1 | mit | restriction | to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense
1 | mit | substantial | (?:the above|this) copyright notice and this permission notice shall be included in all copies or substantial portions of the software
1 | isc | hereby | permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted
1 | isc | disclaims | the author disclaims all warranties with regard to this software
1 | bsd | redistribution | redistribution and use in source and binary forms with or without modification are permitted
1 | bsd | redistributions | redistributions of source code must retain the above copyright notice
1 | bsd | reproduce | redistributions in binary form must reproduce the above copyright notice
1 | bsd-3-clause | endorse | neither the name of(?: \S+){1,12} may be used to endorse or promote products derived from this software without specific prior written permission
1 | bsd-4-clause | advertising | all advertising materials mentioning features or use of this software must display the following acknowledg(?:e)?ment
1 | apache-2.0 | apache | (?:you may not use this file except in compliance with the license )?you may obtain a copy of the license at https? (?:www )?apache org licenses license 2 0
1 | apache-2.0 | perpetual | each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license
1 | apache-1.1 | acknowledgment | this product includes software developed by the apache software foundation https? (?:www )?apache org as the acknowledgment of redistribution
1 | gpl | redistribute | this program is free software you can redistribute it and or modify it under the terms of the gnu general public license
1 | gpl-2.0 | either | gnu general public license as published by the free software foundation either version 2 of the license
1 | gpl-3.0 | either | gnu general public license as published by the free software foundation either version 3 of the license
1 | gpl | copyleft | the gnu general public license is a free copyleft license for software and other kinds of works
1 | gpl-2.0 | freedom | the licenses for most software are designed to take away your freedom to share and change it
1 | lgpl | redistribute | this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license
1 | agpl-3.0 | network | if you modify the program your modified version must prominently offer all users interacting with it remotely through a computer network(?: \S+){0,30} license
1 | agpl-3.0 | affero | under the terms of the gnu affero general public license as published by the free software foundation
1 | gfdl | invariant | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license(?: \S+){1,16} invariant sections
1 | mpl-2.0 | mpl | this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file
1 | mpl-1.1 | mozilla | the contents of this file are subject to the mozilla public license version 1 1
1 | epl-2.0 | eclipse | this program and the accompanying materials are made available under the terms of the eclipse public license(?: v)? 2 0
1 | epl-1.0 | eclipse | this program and the accompanying materials are made available under the terms of the eclipse public license(?: v)? 1 0
1 | cddl | cddl | the contents of this file are subject to the terms of the common development and distribution license(?: \S+){0,8} cddl
1 | zlib | misrepresented | the origin of this software must not be misrepresented you must not claim that you wrote the original software(?: \S+){0,60} warranty
1 | zlib | alter | permission is granted to anyone to use this software for any purpose including commercial applications and to alter it
1 | unlicense | unencumbered | this is free and unencumbered software released into the public domain
1 | unlicense | domain | anyone is free to copy modify publish use compile sell or distribute this software(?: \S+){0,60} public domain
1 | wtfpl | fuck | you just do what the fuck you want to public license
1 | cc0-1.0 | waived | has waived all copyright and related or neighboring rights
1 | cc0-1.0 | dedicated | (?:has|have) dedicated (?:the|this) work to the public domain
1 | bsl-1.0 | boost | distributed under the boost software license version 1 0
1 | artistic-2.0 | artistic | you can redistribute it and or modify it under the terms of the artistic license 2 0
1 | ofl-1.1 | font | this font software is licensed under the sil open font license version 1 1
1 | ncsa | illinois | developed by(?: \S+){1,12} university of illinois(?: \S+){0,40} redistributions? of source code
1 | postgresql | paragraphs | permission to use copy modify and distribute this software and its documentation for any purpose without fee(?: \S+){0,30} paragraphs
1 | python-2.0 | psf | the psf is making python available to licensee on an as is basis
1 | psf-2.0 | psf | this license agreement is between the python software foundation psf
1 | openssl | openssl | this product includes software developed by the openssl project for use in the openssl toolkit(?: \S+){0,12} license
1 | ssleay | young | this product includes cryptographic software written by eric young(?: \S+){0,20} redistribution
1 | w3c | w3c | permission to copy modify and distribute this software and its documentation(?: \S+){1,30} w3c
1 | eupl | eupl | licensed under the eupl
1 | sspl-1.0 | service | if you make the functionality of the program or a modified version available to third parties as a service(?: \S+){0,30} license
1 | busl-1.1 | production | the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work
1 | elastic-2.0 | hosted | you may not provide the software to third parties as a hosted or managed service(?: \S+){0,40} licen[cs]es?
1 | odbl-1.0 | database | made available under the open database license
2 | gpl | gpl | (?:licen[cs]ed|released|distributed|available) under (?:the )?(?:gnu )?gpl(?: v?[123](?: 0)?)?
2 | lgpl | lgpl | (?:licen[cs]ed|released|distributed|available) under (?:the )?(?:gnu )?lgpl(?: v?[23](?: [01])?)?
2 | agpl | agpl | (?:licen[cs]ed|released|distributed|available) under (?:the )?(?:gnu )?agpl(?: v?3(?: 0)?)?
2 | dual | dual | (?:is |are )?dual licen[cs]ed under
2 | dual | option | at your option under (?:either|any)(?: \S+){0,6} licen[cs]es?
2 | public-domain | domain | (?:is |are )?(?:hereby )?(?:released|placed|dedicated) (?:in|into|to) the public domain
2 | public-domain | domain | (?:is|are) in the public domain
2 | proprietary | proprietary | (?:this is )?proprietary (?:and confidential )?software(?: \S+){0,8} licen[cs]es?
2 | proprietary | unauthorized | unauthorized (?:copying|use|distribution|reproduction)(?: \S+){0,10} strictly prohibited(?: \S+){0,20} copyright
2 | proprietary | confidential | confidential and proprietary(?: \S+){0,10} copyright
2 | proprietary | evaluation | evaluation licen[cs]e agreement
2 | eula | user | end user licen[cs]e agreement
2 | commercial | commercial | (?:a |the )?commercial licen[cs]es? (?:is|are) (?:required|available)
2 | noncommercial | noncommercial | licen[cs]ed for (?:noncommercial|non noncommercial) use only
2 | research | research | licen[cs]ed for (?:academic|research|academic and research) (?:use|purposes) only(?: \S+){0,4} research|for research (?:use|purposes) only(?: \S+){0,20} licen[cs]es?
3 | copyleft | copyleft | (?:a |the )?(?:strong |weak )?copyleft licen[cs]es?
3 | permissive | permissive | (?:a |the )?permissive (?:software |open source )?licen[cs]es?
3 | open-source | source | (?:an |the )?open source licen[cs]es?
3 | free-software | free | (?:a |the )?free software licen[cs]es?
3 | all-rights-reserved | reserved | copyright(?: \S+){1,8} all rights reserved
3 | disclaimer | warranties | without warranties or conditions of any kind
3 | disclaimer | warranty | without warranty of any kind
3 | disclaimer | merchantability | (?:implied )?warrant(?:y|ies) of merchantability(?: and| or)? (?:fitness for a particular purpose)?
4 | spdx | spdx | spdx license identifier
4 | gpl | gplv2 | (?:licen[cs]e )gplv2|gplv2 licen[cs]e
4 | gpl | gplv3 | (?:licen[cs]e )gplv3|gplv3 licen[cs]e
4 | see-license | file | (?:see )?(?:the )?licen[cs]e file
4 | see-license | copying | (?:see )?(?:the )?file copying(?: \S+){0,6} licen[cs]e
4 | see-license | txt | licen[cs]e txt
4 | see-license | md | licen[cs]e md
4 | license-grant | grants | (?:hereby )?grants(?: \S+){0,8} licen[cs]es?
4 | license-mention | terms | under (?:the )?terms of (?:the|this) licen[cs]e
4 | license-mention | agreement | licen[cs]e agreement
"""

#: Each match of each rule has one of these in a word: a text without them matches nothing.
GATE = ("licen", "spdx", "copyright", "redistribut", "permission", "public domain", "warrant", "gpl",
        "advertising materials")

#: A notice puts something under a title.
NOTICE = r"(?:licen[cs]ed|released|distributed|provided|available|covered)(?: \S+){0,2} (?:under|by)(?: the)?(?: terms of)?(?: the)? "
TAG = "spdx license identifier "


@dataclass(frozen=True)
class Rule:
    """``tier`` 1 is the strongest. ``word`` is in every match. ``pattern`` is for text with doubled blanks."""

    number: int
    tier: int
    label: str
    word: str
    pattern: str


def _widened(regex: str) -> str:
    """The regex for text in which each word has a blank of its own on both sides."""
    return " (?:" + regex.replace(" ", "  ") + ") "


def _lines(text: str) -> list[list[str]]:
    return [[part.strip() for part in line.split(" | ")] for line in text.strip().splitlines()]


def _rules() -> tuple[Rule, ...]:
    made = []
    for label, word, title, identifier, own in _lines(TITLES):
        made += [(1, label, own, f"{TAG}(?:{identifier})"), (2, label, word, f"{NOTICE}(?:{title})"), (3, label, word, title)]
    made += [(int(tier), label, word, regex) for tier, label, word, regex in _lines(SENTENCES)]
    return tuple(Rule(i, tier, label, word, _widened(regex)) for i, (tier, label, word, regex) in enumerate(made))


RULES = _rules()
