"""Signature rules of licenses, written for normalised text: lower-case words with one space between them.

Every license states in order: the words any of which must be in a text (each entry may ask for several words with `+`) where a
pattern has no fixed words of its own, its identifiers, clauses of its notices, addresses, titles and mentions. Each is a rule, `a b` matching the words a, b in a
row; patterns are regular expressions that never cross a word's ends. Versions are words of their own, as `.` and `-` separate words.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

#: Kinds in falling priority, with the confidence that a place of the kind is a license.
KINDS = (("base", 0.6), ("tag", 0.99), ("notice", 0.95), ("address", 0.9), ("title", 0.8), ("mention", 0.5))
PRIORITY = {kind: place for place, (kind, _) in enumerate(KINDS)}
CONFIDENCE = dict(KINDS)

#: The phrases every scan counts, and their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

LIC = "licen[cs]es?"
VER = "(?:v|version|ver)? ?"
GPL = f"(?:gnu )?general public {LIC}"


@dataclass(frozen=True)
class Rule:
    """A rule's place in the list orders rules of one kind."""

    order: int
    label: str
    kind: str
    gates: tuple[tuple[str, ...], ...]
    pattern: re.Pattern


#: label: (keywords, tag identifiers, notices, addresses, titles, mentions)
LICENSES: dict[str, tuple[str, list[str], list[str], list[str], list[str], list[str]]] = {
    "mit": (
        "mit permission+charge expat",
        ["mit", "expat"],
        [
            "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
            "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
            f"(?:released|licensed|distributed|available) under (?:the )?(?:terms of the )?mit {LIC}",
        ],
        [f"opensource org {LIC} mit", f"mit {LIC} org"],
        [f"the mit {LIC}", f"expat {LIC}", f"mit style {LIC}"],
        [f"mit {LIC}"],
    ),
    "mit-0": ("mit mit0", ["mit 0"], ["mit no attribution"], [f"opensource org {LIC} mit 0"], ["mit 0"], ["mit0"]),
    "apache-2.0": (
        "apache",
        ["apache 2 0", "apache2", "apache 2"],
        [
            f"licensed under the apache {LIC} version 2 0 the {LIC} you may not use this file except in compliance with the {LIC}",
            f"(?:released|licensed|distributed|available) under (?:the )?(?:terms of the )?apache (?:software )?{LIC} {VER}2(?: 0)?",
        ],
        [f"apache org {LIC} {LIC} 2 0", f"opensource org {LIC} apache 2 0"],
        [f"apache (?:software )?{LIC} {VER}2(?: 0)?", "apache 2 0 license"],
        ["apache2(?: 0)?", f"apache {VER}2(?: 0)?"],
    ),
    "apache-1.1": (
        "apache",
        ["apache 1 1"],
        ["this product includes software developed by the apache software foundation"],
        [f"apache org {LIC} {LIC} 1 1"],
        [f"apache (?:software )?{LIC} {VER}1 1"],
        [f"apache {VER}1 1"],
    ),
    "apache": ("apache", [], [f"licensed to the apache software foundation asf under one or more contributor {LIC} agreements"], [f"apache org {LIC}"], [f"apache (?:software )?{LIC}"], []),
    "bsd-2-clause": (
        "bsd redistribution+binary",
        ["bsd 2 clause"],
        ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer"],
        [f"opensource org {LIC} bsd 2 clause"],
        [f"(?:2|two) clause bsd(?: {LIC})?", f"(?:simplified|freebsd) bsd {LIC}", f"bsd (?:2|two) clause(?: {LIC})?"],
        ["bsd 2"],
    ),
    "bsd-3-clause": (
        "bsd neither+contributors neither+endorse",
        ["bsd 3 clause"],
        [
            "neither the name of (?:\\S+ ){1,12}nor the names of its contributors may be used to endorse or promote products derived from this software",
            f"use of this source code is governed by a bsd style {LIC}",
        ],
        [f"opensource org {LIC} bsd 3 clause"],
        [f"(?:3|three) clause bsd(?: {LIC})?", f"(?:new|modified|revised) bsd {LIC}", f"bsd (?:3|three) clause(?: {LIC})?"],
        ["bsd 3"],
    ),
    "bsd-4-clause": (
        "bsd advertising+acknowledgement advertising+acknowledgment",
        ["bsd 4 clause"],
        ["all advertising materials mentioning features or use of this software must display the following acknowledge?ment"],
        [],
        [f"(?:original|old) bsd {LIC}", f"(?:4|four) clause bsd(?: {LIC})?"],
        ["bsd 4"],
    ),
    "bsd": ("bsd redistribution+source", ["bsd"], ["redistribution and use in source and binary forms with or without modification are permitted"], [f"opensource org {LIC} bsd(?: {LIC})?"], [f"bsd {LIC}", f"bsd style {LIC}"], []),
    "0bsd": ("0bsd bsd permission+hereby", ["0bsd"], ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided"], [f"opensource org {LIC} 0bsd"], [f"zero clause bsd(?: {LIC})?"], ["0bsd"]),
    "isc": ("isc permission+fee", ["isc"], ["permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted provided that"], [f"opensource org {LIC} isc"], [f"isc {LIC}", f"internet (?:systems|software) consortium {LIC}"], []),
    "gpl-3.0-or-later": (
        "gpl gpl3 gplv3 general+public",
        ["gpl 3 0 or later", "gpl 3 0"],
        [f"{GPL} as published by the free software foundation either version 3 of the {LIC} or (?:at your option )?any later version"],
        [],
        [f"{GPL} {VER}3(?: 0)? or (?:any )?later", f"gpl {VER}3(?: 0)? or (?:any )?later"],
        ["gpl ?v?3 or later"],
    ),
    "gpl-3.0": (
        "gpl gpl3 gplv3 general+public",
        ["gpl 3 0(?: only)?", "gpl 3"],
        [f"{GPL} version 3 29 june 2007", f"(?:released|licensed|distributed|available) under (?:the )?(?:terms of the )?(?:{GPL}|gnu gpl|gpl) {VER}3(?: 0)?"],
        [f"gnu org {LIC} gpl 3 0", f"opensource org {LIC} gpl 3 0"],
        [f"{GPL} {VER}3(?: 0)?", f"gnu gpl {VER}3(?: 0)?"],
        ["gpl ?v?3", f"gpl {VER}3(?: 0)?"],
    ),
    "gpl-2.0-or-later": (
        "gpl gpl2 gplv2 general+public",
        ["gpl 2 0 or later", "gpl 2 0"],
        [f"{GPL} as published by the free software foundation either version 2 of the {LIC} or (?:at your option )?any later version"],
        [],
        [f"{GPL} {VER}2(?: 0)? or (?:any )?later", f"gpl {VER}2(?: 0)? or (?:any )?later"],
        ["gpl ?v?2 or later"],
    ),
    "gpl-2.0": (
        "gpl gpl2 gplv2 general+public",
        ["gpl 2 0(?: only)?", "gpl 2"],
        [f"{GPL} version 2 june 1991", f"(?:released|licensed|distributed|available) under (?:the )?(?:terms of the )?(?:{GPL}|gnu gpl|gpl) {VER}2(?: 0)?"],
        [f"gnu org {LIC} (?:old {LIC} )?gpl 2 0", f"opensource org {LIC} gpl 2 0"],
        [f"{GPL} {VER}2(?: 0)?", f"gnu gpl {VER}2(?: 0)?"],
        ["gpl ?v?2", f"gpl {VER}2(?: 0)?"],
    ),
    "gpl": ("gpl general+public copyleft", ["gpl"], ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"], [f"gnu org (?:copyleft|{LIC}) gpl"], [GPL, "gnu gpl"], ["gpl", "gpled"]),
    "lgpl-3.0": (
        "lgpl lgpl3 lgplv3 lesser",
        ["lgpl 3 0(?: (?:only|or later))?"],
        [f"gnu lesser {GPL[len('(?:gnu )?'):]} version 3 29 june 2007"],
        [f"gnu org {LIC} lgpl 3 0"],
        [f"(?:gnu )?lesser general public {LIC} {VER}3(?: 0)?"],
        ["lgpl ?v?3(?: 0)?"],
    ),
    "lgpl-2.1": (
        "lgpl lgpl2 lgplv2 lesser",
        ["lgpl 2 1(?: (?:only|or later))?"],
        [f"(?:gnu )?lesser general public {LIC} as published by the free software foundation either version 2 1"],
        [f"gnu org {LIC} (?:old {LIC} )?lgpl 2 1"],
        [f"(?:gnu )?lesser general public {LIC} {VER}2 1"],
        ["lgpl ?v?2 1"],
    ),
    "lgpl-2.0": ("lgpl lgpl2 lgplv2 library+public", ["lgpl 2 0(?: (?:only|or later))?"], [f"(?:gnu )?library general public {LIC} as published by the free software foundation"], [f"gnu org {LIC} (?:old {LIC} )?lgpl 2 0"], [f"(?:gnu )?library general public {LIC}"], ["lgpl ?v?2(?: 0)?"]),
    "lgpl": ("lgpl lesser", ["lgpl"], [], [f"gnu org (?:copyleft|{LIC}) (?:lgpl|lesser)"], [f"(?:gnu )?lesser general public {LIC}", f"gnu lesser gpl"], ["lgpl"]),
    "agpl-3.0": (
        "agpl agpl3 agplv3 affero",
        ["agpl 3 0(?: (?:only|or later))?"],
        [f"(?:gnu )?affero general public {LIC} as published by the free software foundation either version 3", f"gnu affero general public {LIC} version 3 19 november 2007"],
        [f"gnu org {LIC} agpl(?: 3 0)?"],
        [f"(?:gnu )?affero general public {LIC}(?: {VER}3(?: 0)?)?"],
        ["agpl", "agpl ?v?3(?: 0)?"],
    ),
    "gfdl": ("gfdl documentation+free", ["gfdl 1 [123](?: (?:only|or later))?"], [f"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation {LIC}"], ["gnu org (?:copyleft|licenses) fdl"], [f"(?:gnu )?free documentation {LIC}"], ["gfdl", "gnu fdl"]),
    "mpl-2.0": (
        "mpl mpl2 mplv2 mozilla",
        ["mpl 2 0"],
        [f"this source code form is subject to the terms of the mozilla public {LIC} v 2 0"],
        ["mozilla org mpl 2 0", f"opensource org {LIC} mpl 2 0"],
        [f"mozilla public {LIC} {VER}2(?: 0)?"],
        ["mpl ?v?2(?: 0)?"],
    ),
    "mpl-1.1": ("mpl mozilla", ["mpl 1 1"], [f"the contents of this file are subject to the mozilla public {LIC} version 1 1"], ["mozilla org mpl mpl 1 1"], [f"mozilla public {LIC} {VER}1 1"], ["mpl 1 1"]),
    "mpl": ("mpl mozilla", ["mpl"], [], ["mozilla org mpl"], [f"mozilla public {LIC}"], []),
    "epl-2.0": ("epl eclipse", ["epl 2 0"], [f"this program and the accompanying materials are made available under the terms of the eclipse public {LIC} (?:v )?2 0"], ["eclipse org legal epl (?:v20|2 0)"], [f"eclipse public {LIC} {VER}2(?: 0)?"], ["epl 2 0"]),
    "epl-1.0": ("epl eclipse", ["epl 1 0"], [f"made available under the terms of the eclipse public {LIC} v1 0"], ["eclipse org legal epl v10"], [f"eclipse public {LIC}(?: {VER}1(?: 0)?)?"], ["epl 1 0"]),
    "cddl-1.0": ("cddl common+development", ["cddl 1 [01]"], [f"the contents of this file are subject to the terms of the common development and distribution {LIC}"], [f"opensource org {LIC} cddl"], [f"common development and distribution {LIC}"], ["cddl(?: 1 [01])?"]),
    "cpl-1.0": ("cpl common+public", ["cpl 1 0"], [f"provided under the terms of this common public {LIC}"], [f"opensource org {LIC} cpl"], [f"common public {LIC}(?: {VER}1(?: 0)?)?"], []),
    "eupl-1.2": ("eupl eupl1 euplv1 union", ["eupl 1 [12]"], [f"licensed under the eupl"], ["joinup ec europa eu (?:\\S+ ){0,4}eupl"], [f"european union public {LIC}"], ["eupl(?: ?v?1 [12])?"]),
    "artistic-2.0": ("artistic", ["artistic 2 0"], [f"everyone is permitted to copy and distribute verbatim copies of this {LIC} document but changing it is not allowed the artistic"], [f"opensource org {LIC} artistic 2 0"], [f"artistic {LIC} {VER}2(?: 0)?"], ["artistic 2 0"]),
    "artistic-1.0": ("artistic", ["artistic 1 0"], [f"the intent of this document is to state the conditions under which a package may be copied"], [f"opensource org {LIC} artistic"], [f"artistic {LIC}"], []),
    "bsl-1.0": ("boost bsl", ["bsl 1 0"], [f"distributed under the boost software {LIC} version 1 0"], [f"boost org license 1 0", f"opensource org {LIC} bsl 1 0"], [f"boost software {LIC}(?: {VER}1(?: 0)?)?"], []),
    "busl-1.1": ("busl business", ["busl 1 1"], ["the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work"], ["mariadb com bsl11"], [f"business source {LIC}(?: {VER}1 1)?"], ["busl(?: 1 1)?"]),
    "sspl-1.0": ("sspl sspl1 ssplv1 server", ["sspl 1 0"], [f"making the functionality of the program or modified version available to third parties as a service"], [f"mongodb com licensing server side public {LIC}"], [f"server side public {LIC}"], ["sspl(?: ?v?1)?"]),
    "elastic-2.0": ("elastic", ["elastic 2 0"], [f"you may not provide the software to third parties as a hosted or managed service"], [f"elastic co licensing elastic {LIC}"], [f"elastic {LIC}(?: {VER}2(?: 0)?)?"], []),
    "zlib": ("zlib provided+express", ["zlib"], ["this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages"], [f"opensource org {LIC} zlib"], [f"zlib(?: libpng)? {LIC}"], []),
    "libpng": ("libpng png", ["libpng(?: 2 0)?"], ["the png reference library is supplied as is"], ["libpng org pub png src libpng license"], [f"libpng {LIC}", f"png reference library {LIC}"], []),
    "openssl": ("openssl ssleay", ["openssl"], ["this product includes software developed by the openssl project for use in the openssl toolkit", "this product includes cryptographic software written by eric young"], ["openssl org source license"], [f"openssl {LIC}", f"original ssleay {LIC}"], []),
    "php-3.01": ("php", ["php 3 01?"], ["this product includes php software freely available from"], ["php net license"], [f"php {LIC}(?: {VER}3 01?)?"], []),
    "python-2.0": ("python psf", ["python 2 0", "psf 2 0"], [f"psf is making python available to licensee on an as is basis"], ["docs python org (?:\\S+ ){0,2}license"], [f"python software foundation {LIC}", f"psf {LIC}"], []),
    "postgresql": ("postgresql", ["postgresql"], ["permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"], [f"opensource org {LIC} postgresql"], [f"postgresql {LIC}"], []),
    "ruby": ("ruby", ["ruby"], ["you may make and give away verbatim copies of the source form of the software without restriction"], ["ruby lang org (?:\\S+ ){0,3}license"], [f"ruby {LIC}", f"ruby s {LIC}"], []),
    "vim": ("vim", ["vim"], ["vim is charityware"], ["vimhelp org uganda"], [f"vim {LIC}"], []),
    "ncsa": ("ncsa illinois", ["ncsa"], ["permission is hereby granted free of charge (?:\\S+ ){0,30}to deal with the software without restriction"], [f"opensource org {LIC} ncsa"], [f"university of illinois (?:ncsa )?open source {LIC}"], []),
    "ofl-1.1": ("ofl sil font", ["ofl 1 [01]"], [f"this font software is licensed under the sil open font {LIC}"], ["scripts sil org ofl", "openfontlicense org"], [f"(?:sil )?open font {LIC}(?: {VER}1 1)?"], ["ofl(?: 1 1)?"]),
    "unlicense": ("unlicense unencumbered", ["unlicense"], ["this is free and unencumbered software released into the public domain"], ["unlicense org"], ["the unlicense"], []),
    "wtfpl": ("wtfpl wtf", ["wtfpl"], [f"do what the fuck you want to public {LIC}"], ["wtfpl net"], [f"wtf public {LIC}"], ["wtfpl"]),
    "cc0-1.0": (
        "cc0 publicdomain+zero waived+copyright",
        ["cc0 1 0"],
        ["to the extent possible under law (?:\\S+ ){1,20}waived all copyright and related or neighboring rights"],
        ["creativecommons org publicdomain zero 1 0"],
        ["cc0 1 0 universal", "creative commons zero"],
        ["cc0"],
    ),
    "public-domain": ("domain", ["public domain"], ["(?:released|dedicated|placed|put)(?: \\S+){0,3} (?:in|into|to) the public domain", "this work is in the public domain"], ["creativecommons org publicdomain mark 1 0"], ["public domain dedication"], ["public domain"]),
    "cc-by-nc-nd": ("creative+commons creativecommons cc", ["cc by nc nd \\d \\d"], ["creative commons attribution non ?commercial no ?deriv(?:atives?|s)"], [f"creativecommons org {LIC} by nc nd \\d \\d"], ["attribution non ?commercial no ?deriv(?:atives?|s) \\d \\d"], ["cc by nc nd"]),
    "cc-by-nc-sa": ("creative+commons creativecommons cc", ["cc by nc sa \\d \\d"], ["creative commons attribution non ?commercial share ?alike"], [f"creativecommons org {LIC} by nc sa \\d \\d"], ["attribution non ?commercial share ?alike \\d \\d"], ["cc by nc sa"]),
    "cc-by-nc": ("creative+commons creativecommons cc", ["cc by nc \\d \\d"], ["creative commons attribution non ?commercial"], [f"creativecommons org {LIC} by nc \\d \\d"], ["attribution non ?commercial \\d \\d"], ["cc by nc"]),
    "cc-by-nd": ("creative+commons creativecommons cc", ["cc by nd \\d \\d"], ["creative commons attribution no ?deriv(?:atives?|s)"], [f"creativecommons org {LIC} by nd \\d \\d"], ["attribution no ?deriv(?:atives?|s) \\d \\d"], ["cc by nd"]),
    "cc-by-sa": ("creative+commons creativecommons cc", ["cc by sa \\d \\d"], ["creative commons attribution share ?alike"], [f"creativecommons org {LIC} by sa \\d \\d"], ["attribution share ?alike \\d \\d"], ["cc by sa"]),
    "cc-by": ("creative+commons creativecommons cc", ["cc by \\d \\d"], [f"creative commons attribution (?:\\d \\d )?(?:international |unported |generic )?{LIC}"], [f"creativecommons org {LIC} by \\d \\d"], ["creative commons attribution(?: \\d \\d)?"], []),
    "creative-commons": ("creative+commons creativecommons", [], [f"(?:licensed|released|available) under a creative commons {LIC}"], [f"creativecommons org {LIC}"], [f"creative commons {LIC}"], ["creative commons"]),
    "odbl-1.0": ("odbl database", ["odbl 1 0"], [f"this database is made available under the open database {LIC}"], [f"opendatacommons org {LIC} odbl"], [f"open database {LIC}"], ["odbl"]),
    "odc-by-1.0": ("odc commons+attribution", ["odc by 1 0"], [f"made available under the open data commons attribution {LIC}"], [f"opendatacommons org {LIC} by"], [f"open data commons attribution {LIC}"], ["odc by"]),
    "pddl-1.0": ("pddl commons+domain", ["pddl 1 0"], [f"made available under the public domain dedication and {LIC}"], [f"opendatacommons org {LIC} pddl"], [f"public domain dedication and {LIC}"], ["pddl"]),
    "ogl-uk-3.0": ("ogl government", ["ogl uk [123] 0"], [f"contains public sector information licensed under the open government {LIC}"], [f"nationalarchives gov uk doc open government {LIC}"], [f"open government {LIC}(?: {VER}[123](?: 0)?)?"], []),
    "ms-pl": ("ms microsoft", ["ms pl"], [f"microsoft public {LIC} ms pl"], [f"opensource org {LIC} ms pl"], [f"microsoft public {LIC}"], []),
    "ms-rl": ("ms microsoft", ["ms rl"], [f"microsoft reciprocal {LIC} ms rl"], [f"opensource org {LIC} ms rl"], [f"microsoft reciprocal {LIC}"], []),
    "osl-3.0": ("osl open+software", ["osl [123] [01]"], [f"licensed under the open software {LIC} version 3 0"], [f"opensource org {LIC} osl 3 0"], [f"open software {LIC}(?: {VER}[123](?: [01])?)?"], []),
    "afl-3.0": ("afl academic", ["afl [123] [01]"], [f"licensed under the academic free {LIC} version 3 0"], [f"opensource org {LIC} afl 3 0"], [f"academic free {LIC}(?: {VER}[123](?: [01])?)?"], []),
    "ecl-2.0": ("ecl educational", ["ecl [12] 0"], [f"licensed under the educational community {LIC} version 2 0"], [f"opensource org {LIC} ecl 2 0"], [f"educational community {LIC}(?: {VER}[12](?: 0)?)?"], []),
    "upl-1.0": ("upl universal", ["upl 1 0"], [f"licensed under the universal permissive {LIC}"], ["oss oracle com licenses upl"], [f"universal permissive {LIC}(?: {VER}1(?: 0)?)?"], []),
    "ipl-1.0": ("ipl ibm", ["ipl 1 0"], [f"provided under the terms of this ibm public {LIC}"], [f"opensource org {LIC} ipl 1 0"], [f"ibm public {LIC}(?: {VER}1(?: 0)?)?"], []),
    "qpl-1.0": ("qpl", ["qpl 1 0"], [f"the q public {LIC} version 1 0"], [f"opensource org {LIC} qpl 1 0"], [f"q public {LIC}"], ["qpl"]),
    "latex-lppl": ("lppl latex", ["lppl 1 (?:3[abc]?|[012])"], [f"this work may be distributed and or modified under the conditions of the latex project public {LIC}"], ["latex project org lppl"], [f"latex project public {LIC}"], ["lppl"]),
    "x11": ("x11 consortium", ["x11"], ["except as contained in this notice the name of the x consortium shall not be used in advertising"], ["xfree86 org (?:\\S+ ){0,3}license"], [f"x11 {LIC}", f"x consortium {LIC}"], []),
    "curl": ("curl", ["curl"], ["permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice (?:\\S+ ){0,10}curl"], ["curl (?:se|haxx se) docs copyright"], [f"curl {LIC}"], []),
    "beerware": ("beerware beer", ["beerware"], ["you can buy me a beer in return"], ["people freebsd org phk"], [f"(?:the )?beer ?ware {LIC}"], ["beerware"]),
    "json": ("json good", ["json"], ["the software shall be used for good not evil"], ["json org license"], [f"json {LIC}"], []),
    "mulan-psl-2.0": ("mulan mulanpsl", ["mulanpsl 2 0"], [f"licensed under mulan psl v2"], [f"{LIC} coscl org cn mulanpsl2"], [f"mulan permissive software {LIC}(?: {VER}2)?"], ["mulan psl ?v?2"]),
    "openrail": ("openrail rail", ["(?:creativeml )?openrail m"], ["use based restrictions as referenced in paragraph 5"], ["huggingface co spaces (?:\\S+ ){1,3}license"], [f"(?:creativeml )?open ?rail(?: m)? {LIC}", f"responsible ai {LIC}"], ["openrail"]),
    "proprietary": (
        "confidential proprietary unauthorized unauthorised commercial+use personal+use",
        [f"{LIC}ref proprietary"],
        [
            "confidential and proprietary",
            "unauthori[sz]ed (?:copying|reproduction|distribution|use)(?: \\S+){0,12} (?:is )?(?:strictly )?prohibited",
            "(?:no part of this|this) (?:publication|work|document|book) may (?:not )?be reproduced",
            "for personal (?:and non ?commercial )?use only",
        ],
        [],
        [f"proprietary {LIC}", f"end user {LIC} agreement", f"commercial {LIC}"],
        [],
    ),
    "reserved": ("rights", [], ["no rights? (?:is|are) granted", "copyright (?:c )?(?:\\d{4} )(?:\\S+ ){0,8}all rights reserved"], [], ["some rights reserved"], []),
}

#: How a tag may be introduced; what follows must be an identifier.
TAG = f"(?:spdx {LIC} identifier|{LIC}|{LIC} expression|dc rights|rel license) "


def _keywords(text: str) -> tuple[tuple[str, ...], ...]:
    return tuple(tuple(part.split("+")) for part in text.split())


def _compiled(pattern: str) -> re.Pattern:
    return re.compile(f"(?<!\\S)(?:{pattern})(?!\\S)".encode())


def build_rules() -> list[Rule]:
    """All rules by falling priority. A rule runs on a text that has all words of any of its gates."""
    found: list[tuple[str, str, str, tuple[tuple[str, ...], ...]]] = [
        (label, "base", phrase, (tuple(phrase.split()),)) for phrase, label in BASE_PHRASES.items()
    ]
    for label, (keywords, tags, notices, addresses, titles, mentions) in LICENSES.items():
        gates = _keywords(keywords)
        found += [(label, "tag", f"spdx {LIC} identifier {tag}", (("spdx",),)) for tag in tags]
        for kind, patterns in (("notice", notices), ("address", addresses), ("title", titles), ("mention", mentions)):
            found += [(label, kind, p, _own_gates(p) or gates) for p in patterns]
    found.sort(key=lambda x: PRIORITY[x[1]])
    return [Rule(order, label, kind, gates, _compiled(pattern)) for order, (label, kind, pattern, gates) in enumerate(found)]


_PLAIN = re.compile(r"(?:(?<= )|^)[a-z0-9]{2,}(?= |$)")
_GROUP = re.compile(r"\((?:\?:)?([^()]*)\)(?:[?*]|\{[^}]*\})?")


def _own_gates(pattern: str) -> tuple[tuple[str, ...], ...]:
    """The pattern's two longest words outside any group: it cannot match without both."""

    def gap(group: re.Match) -> str:
        return " " if group[1].startswith(" ") or group[1].endswith(" ") else "\x00"

    bare = re.sub(r"\[[^\]]*\]", "\x00", pattern.replace(" ?", "\x00"))
    while (less := _GROUP.sub(gap, bare)) != bare:
        bare = less
    words = sorted({m.group() for m in _PLAIN.finditer(bare)}, key=lambda w: (-len(w), w))
    return (tuple(words[:2]),) if words else ()
