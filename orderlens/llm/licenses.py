"""License notices, found by ordered signature rules in Spark's own functions alone.

A text becomes its words, lower-cased and parted by single spaces. Base phrases are counted with their
places. The rules are regular expressions over the words: a rule runs only on texts that hold all of
its keywords. Its matches are intervals; an interval that lies within that of a rule of the same or a
higher priority is suppressed, so that a full notice hides the bare name inside it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases that are always reported, and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

L = "licen[cs]e"
V = "(?: version| v)?"

# Licenses: label, keywords that a text must hold, and what the name looks like among words.
NAMES = [
    ("agpl-1.0", "affero public", rf"affero general public {L}{V} 1(?: 0)?"),
    ("agpl-3.0", "affero public", rf"(?:gnu )?affero general public {L}{V} 3(?: 0)?"),
    ("agpl", "affero public", rf"(?:gnu )?affero general public {L}"),
    ("gpl-1.0", "general public", rf"(?:gnu )?general public {L}{V} 1(?: 0)?"),
    ("gpl-2.0", "general public", rf"(?:gnu )?general public {L}{V} 2(?: 0)?"),
    ("gpl-2.0-or-later", "general public", rf"(?:gnu )?general public {L}{V} 2(?: 0)? or (?:any )?later"),
    ("gpl-3.0", "general public", rf"(?:gnu )?general public {L}{V} 3(?: 0)?"),
    ("gpl-3.0-or-later", "general public", rf"(?:gnu )?general public {L}{V} 3(?: 0)? or (?:any )?later"),
    ("lgpl-2.0", "general public", rf"(?:gnu )?library general public {L}{V} 2(?: 0)?"),
    ("lgpl-2.1", "lesser public", rf"(?:gnu )?lesser general public {L}{V} 2 1"),
    ("lgpl-3.0", "lesser public", rf"(?:gnu )?lesser general public {L}{V} 3(?: 0)?"),
    ("lgpl", "lesser public", rf"(?:gnu )?lesser general public {L}"),
    ("gfdl-1.1", "free documentation", rf"(?:gnu )?free documentation {L}{V} 1 1"),
    ("gfdl-1.2", "free documentation", rf"(?:gnu )?free documentation {L}{V} 1 2"),
    ("gfdl-1.3", "free documentation", rf"(?:gnu )?free documentation {L}{V} 1 3"),
    ("gfdl", "free documentation", rf"(?:gnu )?free documentation {L}"),
    ("apache-1.0", "apache", rf"apache (?:software )?{L}{V} 1 0"),
    ("apache-1.1", "apache", rf"apache (?:software )?{L}{V} 1 1"),
    ("apache-2.0", "apache", rf"apache (?:software )?{L}{V} 2(?: 0)?"),
    ("mit", "mit", rf"(?:the )?mit {L}"),
    ("mit-x11", "mit", rf"mit x11 {L}"),
    ("mit-0", "mit", rf"mit no attribution(?: {L})?"),
    ("expat", "expat", rf"expat {L}"),
    ("bsd-2-clause", "bsd", rf"(?:2 clause|two clause|simplified) bsd {L}"),
    ("bsd-3-clause", "bsd", rf"(?:3 clause|three clause|new|revised|modified) bsd {L}"),
    ("bsd-4-clause", "bsd", rf"(?:4 clause|four clause|original) bsd {L}"),
    ("bsd-0-clause", "0bsd", rf"0bsd(?: {L})?"),
    ("bsd-0-clause", "zero bsd", rf"zero clause bsd(?: {L})?"),
    ("bsd", "bsd", rf"bsd (?:style )?{L}"),
    ("isc", "isc", rf"isc {L}"),
    ("mpl-1.0", "mozilla public", rf"mozilla public {L}{V} 1 0"),
    ("mpl-1.1", "mozilla public", rf"mozilla public {L}{V} 1 1"),
    ("mpl-2.0", "mozilla public", rf"mozilla public {L}{V} 2(?: 0)?"),
    ("mpl", "mozilla public", rf"mozilla public {L}"),
    ("epl-1.0", "eclipse public", rf"eclipse public {L}{V} 1(?: 0)?"),
    ("epl-2.0", "eclipse public", rf"eclipse public {L}{V} 2(?: 0)?"),
    ("edl-1.0", "eclipse distribution", rf"eclipse distribution {L}(?:{V} 1(?: 0)?)?"),
    ("cddl-1.0", "common distribution", rf"common development and distribution {L}(?:{V} 1(?: 0)?)?"),
    ("cddl-1.1", "common distribution", rf"common development and distribution {L}{V} 1 1"),
    ("cpl-1.0", "common public", rf"common public {L}(?:{V} 1(?: 0)?)?"),
    ("eupl-1.1", "european union public", rf"european union public {L}{V} 1 1"),
    ("eupl-1.2", "european union public", rf"european union public {L}{V} 1 2"),
    ("artistic-1.0", "artistic", rf"artistic {L}{V} 1(?: 0)?"),
    ("artistic-2.0", "artistic", rf"artistic {L}{V} 2(?: 0)?"),
    ("bsl-1.0", "boost", rf"boost software {L}(?:{V} 1(?: 0)?)?"),
    ("zlib", "zlib", rf"zlib(?: libpng)? {L}"),
    ("unlicense", "unlicense", r"(?:the )?unlicense"),
    ("wtfpl", "wtfpl", rf"wtfpl(?: {L})?"),
    ("psf-2.0", "python foundation", rf"python software foundation {L}(?:{V} 2(?: 0)?)?"),
    ("ofl-1.1", "open font", rf"(?:sil )?open font {L}(?:{V} 1 1)?"),
    ("odbl-1.0", "open database", rf"open (?:data commons open )?database {L}(?:{V} 1(?: 0)?)?"),
    ("osl-3.0", "open software", rf"open software {L}{V} 3(?: 0)?"),
    ("afl-3.0", "academic free", rf"academic free {L}(?:{V} 3(?: 0)?)?"),
    ("ms-pl", "microsoft public", rf"microsoft public {L}"),
    ("ms-rl", "microsoft reciprocal", rf"microsoft reciprocal {L}"),
    ("cc0-1.0", "cc0", r"cc0(?: 1 0)?"),
    ("cc0-1.0", "creative commons zero", r"creative commons zero(?: v?1 0)?"),
    ("pddl-1.0", "public dedication", rf"(?:open data commons )?public domain dedication(?: and)? {L}"),
    ("busl-1.1", "business source", rf"business source {L}(?:{V} 1 1)?"),
    ("sspl-1.0", "server side public", rf"server side public {L}(?:{V} 1)?"),
    ("elastic-2.0", "elastic", rf"elastic {L}(?:{V} 2(?: 0)?)?"),
]
_CLAUSES = {"": "", "-sa": " sa", "-nd": " nd", "-nc": " nc", "-nc-sa": " nc sa", "-nc-nd": " nc nd"}
_WORDS = {" sa": " share ?alike", " nd": " no ?deriv(?:ative)?s?(?: works)?", " nc": " non ?commercial"}
for _clause, _short in _CLAUSES.items():
    _long = _short
    for _part, _spelled in _WORDS.items():
        _long = _long.replace(_part, _spelled)
    for _version in ("2.0", "2.5", "3.0", "4.0"):
        _number = _version.replace(".", " ")
        NAMES.append((f"cc-by{_clause}-{_version}", "cc by", rf"cc by{_short}(?: {L})? v?{_number}"))
        _spelled = rf"creative commons attribution{_long}(?: {_number})?(?: international| unported| generic)?"
        NAMES.append((f"cc-by{_clause}-{_version}", "creative commons", rf"{_spelled}(?: public)? {L}(?: {_number})?"))
    NAMES.append((f"cc-by{_clause}", "cc by", rf"cc by{_short}"))

_UNDER = rf"(?:licensed|released|distributed|published|available|provided|redistributed) (?:to you )?under (?:the )?"
_TERMS = r"(?:terms (?:and conditions )?of (?:the )?)?"
_RIGHTS = [
    ("all-rights-reserved", "rights reserved", r"all rights reserved", 3),
    ("all-rights-reserved", "rights reserved", r"copyright (?:c )?[0-9]{4}(?: [0-9]{4})? (?:[^ ]+ ){0,8}all rights reserved", 2),
    ("public-domain", "public domain", r"(?:released|dedicated|placed) (?:in|in?to) the public domain", 2),
    ("proprietary", "proprietary confidential", r"proprietary and confidential", 2),
]


_UNDER_EITHER = "(?:dual |dually )?(?:licensed|released|distributed|available) under (?:either )?(?:of )?(?:the )?(?:terms of )?"
_OR = "(?:or|and) (?:the )?"
_GRANT = "permission to use copy modify and(?: or)? distribute this software"
_FSF = "as published by the free software foundation"
_GNU = "free software you can redistribute it and or modify it under the terms of the gnu"
_FILE = "the contents of this file are subject to the(?: terms of the)?"

# Passages that license texts and file headers hold, as their words stand: label, keywords, pattern, priority.
# What only one license says names it exactly; what several share names their family.
BODIES = [
    ("mit", "hereby granted charge", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files(?: the software)? to deal in the software without restriction", 1),
    ("mit", "substantial portions", "the above copyright notice and this permission notice(?: including the next paragraph)? shall be included in all copies or substantial portions of the software", 2),
    ("mit", "merchantability noninfringement", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement", 2),
    ("ncsa", "hereby granted charge", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files(?: the software)? to deal with the software without restriction", 1),
    ("ncsa", "illinois", "university of illinois(?: at urbana champaign)? nor the names of its contributors", 1),
    ("json", "evil", "the software shall be used for good not evil", 1),
    ("x11", "consortium", "except as contained in this notice the name of the x consortium shall not be used in advertising", 1),
    ("isc", "permission fee granted", f"{_GRANT} for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", 1),
    ("isc", "disclaims author", "the software is provided as is and the author disclaims all warranties with regard to this software", 2),
    ("bsd-0-clause", "permission fee granted", f"{_GRANT} for any purpose with or without fee is hereby granted the software is provided as is", 1),
    ("hpnd", "permission fee documentation", f"{_GRANT} and its documentation for any purpose(?: with or)? without fee is hereby granted", 1),
    ("hpnd", "advertising publicity", "not be used in advertising or publicity pertaining to distribution of the software without specific written prior permission", 1),
    ("postgresql", "agreement fee documentation", f"{_GRANT} and its documentation for any purpose without fee and without a written agreement is hereby granted", 1),
    ("postgresql", "maintenance enhancements", "has no obligations? to provide maintenance support updates enhancements or modifications", 2),
    ("bsd", "redistribution binary", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", 2),
    ("bsd", "redistributions retain", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", 2),
    ("bsd", "redistributions reproduce", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer", 2),
    ("bsd", "contributors warranties", "this software is provided by the copyright holders? and contributors as is and any express or implied warranties", 2),
    ("bsd-3-clause", "endorse promote", "neither the names? of (?:[^ ]+ ){1,12}nor the names of (?:its|their|any) contributors may be used to endorse or promote products derived from this software without specific prior written permission", 1),
    ("bsd-3-clause", "endorse promote", "the names? of (?:[^ ]+ ){1,8}may not be used to endorse or promote products derived from this software", 1),
    ("bsd-4-clause", "advertising materials mentioning", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment", 1),
    ("bsd-style", "bsd license found", f"use of this source code is governed by a bsd style {L} that can be found in the license file", 1),
    ("bsd-3-clause-clear", "patent licenses granted", "no express or implied licenses to any party s patent rights are granted by this license", 1),
    ("zlib", "misrepresented origin", "the origin of this software must not be misrepresented you must not claim that you wrote the original software", 1),
    ("zlib", "altered misrepresented", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software", 1),
    ("zlib", "authors liable", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software", 2),
    ("libpng", "png reference", "the png reference library is supplied as is", 1),
    ("ijg", "independent jpeg", "this software is based in part on the work of the independent jpeg group", 1),
    ("apache-2.0", "apache compliance", f"licensed under the apache {L}{V} 2 0 the {L} you may not use this file except in compliance with the {L}", 1),
    ("apache-2.0", "licenses obtain", f"you may obtain a copy of the {L} at https? www apache org licenses license 2 0", 1),
    ("apache-2.0", "january 2004", f"apache {L} version 2 0 january 2004", 1),
    ("apache-2.0", "contributor agreements asf", f"licensed to the apache software foundation asf under one or more contributor {L} agreements", 1),
    ("apache-2.0", "applicable basis", f"unless required by applicable law or agreed to in writing software distributed under the {L} is distributed on an as is basis", 2),
    ("apache-1.1", "apache foundation product", "this product includes software developed by the apache software foundation", 1),
    ("gpl-2.0-or-later", "general public later", f"this (?:program|software|file) is {_GNU} general public {L} {_FSF} either version 2 of the {L} or at your option any later version", 1),
    ("gpl-3.0-or-later", "general public later", f"this (?:program|software|file) is {_GNU} general public {L} {_FSF} either version 3 of the {L} or at your option any later version", 1),
    ("gpl-2.0", "general public redistribute", f"this (?:program|software|file) is {_GNU} general public {L}(?: version 2)? {_FSF}(?: version 2 of the {L})?", 2),
    ("gpl-2.0", "freedom designed", f"the {L}s for most software are designed to take away your freedom to share and change it", 1),
    ("gpl-3.0", "copyleft kinds", f"the gnu general public {L} is a free copyleft {L} for software and other kinds of works", 1),
    ("gpl", "warranty general public", f"this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public {L}", 2),
    ("gpl", "received copy general", f"you should have received a copy of the gnu general public {L}", 2),
    ("gnu-license-text", "verbatim", f"everyone is permitted to copy and distribute verbatim copies of this {L} document but changing it is not allowed", 2),
    ("lgpl-2.1-or-later", "lesser public later", f"this library is {_GNU} lesser general public {L} {_FSF} either version 2 1 of the {L} or at your option any later version", 1),
    ("lgpl-3.0-or-later", "lesser public later", f"this (?:library|program) is {_GNU} lesser general public {L} {_FSF} either version 3 of the {L} or at your option any later version", 1),
    ("lgpl-2.0-or-later", "library public later", f"this library is {_GNU} library general public {L} {_FSF} either version 2 of the {L} or at your option any later version", 1),
    ("lgpl", "received copy lesser", f"you should have received a copy of the gnu lesser general public {L}", 2),
    ("lgpl-2.1", "successor library", f"this is the first released version of the lesser gpl it also counts as the successor of the gnu library public {L}", 1),
    ("agpl-3.0-or-later", "affero public later", f"this program is {_GNU} affero general public {L} {_FSF} either version 3 of the {L} or at your option any later version", 1),
    ("agpl-3.0", "affero copyleft", f"the gnu affero general public {L} is a free copyleft {L} for software and other kinds of works specifically designed to ensure cooperation with the community in the case of network server software", 1),
    ("gfdl", "invariant sections", "with no invariant sections(?: with)? no front cover texts and(?: with)? no back cover texts", 1),
    ("gfdl", "document documentation", f"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation {L}", 1),
    ("classpath-exception", "link exception independent", "as a special exception the copyright holders of this library give you permission to link this library with independent modules to produce an executable", 1),
    ("gcc-exception", "exception runtime", "gcc runtime library exception", 1),
    ("mpl-2.0", "mozilla form", f"this source code form is subject to the terms of the mozilla public {L} v 2 0", 1),
    ("mpl-2.0", "mpl distributed", "if a copy of the mpl was not distributed with this file you can obtain one at", 1),
    ("mpl-2.0", "incompatible secondary", f"this source code form is incompatible with secondary {L}s as defined by the mozilla public {L}", 1),
    ("mpl-1.1", "mozilla contents", f"{_FILE} mozilla public {L}{V} 1 1", 1),
    ("mpl-1.0", "mozilla contents", f"{_FILE} mozilla public {L}{V} 1 0", 1),
    ("npl-1.1", "netscape contents", f"{_FILE} netscape public {L}{V} 1 1", 1),
    ("gpl-2.0 or lgpl-2.1 or mpl-1.1", "begin block", f"begin {L} block version mpl 1 1 gpl 2 0 lgpl 2 1", 1),
    ("epl-1.0", "eclipse accompanying", f"accompanying materials are made available under the terms of the eclipse public {L} v1 0", 1),
    ("epl-2.0", "eclipse accompanying", f"accompanying materials are made available under the terms of the eclipse public {L}(?: v)? 2 0", 1),
    ("epl", "eclipse accompanying", f"the accompanying program is provided under the terms of this eclipse public {L}", 1),
    ("edl-1.0", "eclipse distribution", f"available under the terms of the eclipse distribution {L}", 1),
    ("cpl-1.0", "accompanying common", f"the accompanying program is provided under the terms of this common public {L}", 1),
    ("ipl-1.0", "accompanying ibm", f"the accompanying program is provided under the terms of this ibm public {L}", 1),
    ("cddl-1.0", "common development", f"{_FILE} common development and distribution {L}", 1),
    ("cddl-1.0", "cddl header", "when distributing covered code include this cddl header in each file", 1),
    ("eupl-1.2", "eupl", f"licensed under the eupl(?: {L})?{V} 1 2", 1),
    ("eupl", "eupl", "licensed under the eupl", 2),
    ("artistic-1.0", "package artistic intent", "the intent of this document is to state the conditions under which a package may be copied such that the copyright holder maintains some semblance of artistic control", 1),
    ("artistic-2.0", "establishes package", f"this {L} establishes the terms under which a given free software package may be copied modified distributed and or redistributed", 1),
    ("artistic-1.0 or gpl-1.0-or-later", "perl itself", "redistribute it and or modify it under the same terms as perl(?: 5)?(?: programming language system)? itself", 1),
    ("bsl-1.0", "organization covered", f"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this {L}", 1),
    ("bsl-1.0", "boost distributed", f"distributed under the boost software {L} version 1 0", 1),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain", 1),
    ("unlicense", "compile sell", "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary", 1),
    ("wtfpl", "fuck", f"do what the fuck you want to(?: public {L})?", 1),
    ("beerware", "beer", "you can do whatever you want with this stuff if we meet some day and you think this stuff is worth it you can buy me a beer in return", 1),
    ("cc0-1.0", "waived copyright", "has waived all copyright and related or neighbou?ring rights", 1),
    ("cc0-1.0", "affirmer overtly", "affirmer hereby overtly fully permanently irrevocably and unconditionally waives", 1),
    ("cc-by", "creative attribution", f"this work is licensed under (?:a|the) creative commons attribution(?: [0-9] [0-9])?(?: international| unported)? {L}", 2),
    ("psf-2.0", "python agreement", f"this {L} agreement is between the python software foundation", 1),
    ("cnri-python", "national initiatives", "this license agreement is between the corporation for national research initiatives", 1),
    ("ofl-1.1", "font sil", f"this font software is licensed under the sil open font {L} version 1 1", 1),
    ("ofl-1.1", "font ofl", f"the goals of the open font {L} ofl are to stimulate worldwide development of collaborative font projects", 1),
    ("ofl-1.1", "reserved font", "with reserved font names?", 2),
    ("odbl-1.0", "database open", f"this (?:[^ ]+ )?database is made available under the open database {L}", 1),
    ("odc-by-1.0", "attribution commons", f"open data commons attribution {L}", 1),
    ("ms-pl", "governs accompanying", f"this {L} governs use of the accompanying software if you use the software you accept this {L}", 1),
    ("osl-3.0", "open software licensed", f"licensed under the open software {L} version 3 0", 1),
    ("afl-3.0", "academic licensed", f"licensed under the academic free {L} version 3 0", 1),
    ("busl-1.1", "production licensed", "the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work", 1),
    ("sspl-1.0", "service program", "if you make the functionality of the program or a modified version available to third parties as a service", 1),
    ("elastic-2.0", "hosted managed", "you may not provide the software to third parties as a hosted or managed service", 1),
    ("commons-clause", "commons clause", "commons clause(?: license condition| restriction)", 1),
    ("openssl", "openssl toolkit", "this product includes software developed by the openssl project for use in the openssl toolkit", 1),
    ("ssleay", "young eric", "this product includes cryptographic software written by eric young", 1),
    ("php-3.01", "php freely", "this product includes php(?: software)? freely available from", 1),
    ("vim", "charityware", "vim is charityware", 1),
    ("unicode", "data files documentation", "any person obtaining a copy of (?:the )?(?:unicode )?data files and any associated documentation", 1),
    ("curl", "permission fee warranty", f"{_GRANT} for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is provided as is without warranty of any kind", 1),
    ("sleepycat", "redistributions accompanied", "redistributions in any form must be accompanied by information on how to obtain complete source code", 1),
    ("upl-1.0", "universal permissive", f"universal permissive {L}", 1),
    ("blueoak-1.0.0", "blue oak", f"blue oak model {L}", 1),
    ("mulan-psl-2.0", "mulan", f"mulan (?:psl v2|permissive software {L})", 1),
    ("cecill-2.1", "cecill", f"cecill(?: free software)?(?: license)?(?: agreement)?{V} 2 1", 1),
    ("cecill", "cecill", "governed by the cecill license", 1),
    ("wxwindows", "wxwindows", f"wxwindows library {L}", 1),
    ("ftl", "freetype", f"freetype (?:project )?{L}", 1),
    ("imagemagick", "imagemagick", f"imagemagick {L}", 1),
    ("ruby", "ruby", f"distributed under the ruby {L}", 1),
    ("ruby", "ruby redistribute", "redistribute it and or modify it under the same terms as ruby", 1),
    ("public-domain", "disclaims author", "the author disclaims copyright to this source code", 1),
    ("public-domain", "domain", "this (?:file|work|code|software|program) is (?:hereby )?(?:in|placed in|placed into) the public domain", 1),
    ("proprietary", "unauthorized copying", "unauthorized copying of this file via any medium is strictly prohibited", 1),
    ("proprietary", "contains", "contains (?:confidential|proprietary) (?:and (?:confidential|proprietary) )?(?:information|trade secrets?)", 2),
    ("proprietary", "internal use", "for internal use only", 3),
    ("apache-2.0 or mit", "mit apache", f"{_UNDER_EITHER}(?:the )?mit(?: {L})? {_OR}apache(?: {L})?(?:{V} 2 0)?(?: {L})?", 1),
    ("apache-2.0 or mit", "mit apache", f"{_UNDER_EITHER}(?:the )?apache(?: {L})?(?:{V} 2 0)?(?: {L})? {_OR}mit(?: {L})?", 1),
    ("apache-2.0 or mit", "mit apache option", f"at your option (?:[^ ]+ ){{0,6}}apache {L}{V} 2 0 (?:[^ ]+ ){{0,12}}mit {L}", 1),
    ("apache-2.0 or mit", "spdx mit apache", f"spdx {L} identifier (?:mit or apache 2 0|apache 2 0 or mit)", 1),
    ("gpl or mit", "mit gpl", f"{_UNDER_EITHER}(?:the )?(?:mit(?: {L})? {_OR}(?:gnu )?gpl|gpl(?: {L})? {_OR}mit)(?:{V} [23](?: 0)?)?(?: {L}s?)?", 1),
    ("bsd or gpl", "bsd gpl", f"(?:dual bsd gpl|{_UNDER_EITHER}(?:the )?(?:bsd(?: {L})? {_OR}(?:gnu )?gpl|gpl(?: {L})? {_OR}bsd))(?:{V} [23](?: 0)?)?(?: {L}s?)?", 1),
    ("bsd-3-clause or gpl-2.0", "spdx bsd gpl", f"spdx {L} identifier (?:gpl 2 0(?: only)? or bsd 3 clause|bsd 3 clause or gpl 2 0(?: only)?)", 1),
    ("gpl-2.0 with syscall-note", "spdx syscall", f"spdx {L} identifier gpl 2 0(?: or later| only)? with linux syscall note", 1),
    ("apache-2.0 with llvm-exception", "apache llvm", f"apache(?: {L})?{V} 2 0 with llvm exceptions?", 1),
    ("epl-2.0 or gpl-2.0", "spdx epl gpl", f"spdx {L} identifier epl 2 0 or gpl 2 0", 1),
    ("lgpl or mpl", "lgpl mpl", f"{_UNDER_EITHER}(?:the )?(?:mpl {_OR}lgpl|lgpl {_OR}mpl)", 1),
]


@dataclass(frozen=True)
class Rule:
    label: str
    keywords: tuple[str, ...]
    pattern: str
    priority: int
    """1 is the highest."""


def rules() -> list[Rule]:
    """The rules in order: passages of license texts, then of each name its identifier tag, its notice and
    the bare name, then notices of rights."""
    out = [Rule(label, tuple(words.split()), pattern, priority) for label, words, pattern, priority in BODIES]
    for label, keywords, name in NAMES:
        words = tuple(keywords.split())
        tag = " ".join(label.replace("-", " ").replace(".", " ").split())
        out.append(Rule(label, ("spdx",), rf"spdx {L} identifier {tag}", 1))
        out.append(Rule(label, (*words, "under"), _UNDER + _TERMS + name, 2))
        out.append(Rule(label, words, name, 3))
    out += [Rule(label, tuple(words.split()), pattern, priority) for label, words, pattern, priority in _RIGHTS]
    return list(dict.fromkeys(out))


SCORES = {1: 1.0, 2: 0.9, 3: 0.7}
"""Score of a text by the highest priority of a kept match; a base phrase alone counts as a name."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _placed(phrase: str, padded: Column, n_words: Column) -> Column:
    """Number, first and last word of the places of a phrase; null where there is none.

    The text is split at the phrase between its two spaces. A piece begins and ends with a space, so
    it holds one word less than spaces.
    """
    pieces = F.split(padded, rf"(?<= ){phrase}(?= )", -1)
    length = len(phrase.split())
    first = _spaces(F.element_at(pieces, 1)) - 1
    last = n_words - (_spaces(F.element_at(pieces, -1)) - 1) - length
    places = F.struct(
        (F.size(pieces) - 1).cast("long").alias("n"), first.cast("long").alias("first"), last.cast("long").alias("last")
    )
    return F.when(F.contains(padded, F.lit(f" {phrase} ")), places)


def _matches(rule: Column, padded: Column) -> Column:
    """Intervals of a rule's matches, from the lengths of the pieces between them."""
    found = F.regexp_extract_all(padded, rule["pattern"], F.lit(0))
    pieces = F.split(padded, rule["pattern"], -1)
    empty = F.array().cast("array<struct<s:int,back:int,priority:int,rank:int,label:string>>")

    def step(state: Column, i: Column) -> Column:
        start = state["at"] + F.length(F.get(pieces, i))
        end = start + F.length(F.get(found, i))
        hit = F.struct(
            start.alias("s"), (-end).alias("back"), rule["priority"].alias("priority"), rule["rank"].alias("rank"),
            rule["label"].alias("label"),
        )
        return F.struct(end.alias("at"), F.concat(state["hits"], F.array(hit)).alias("hits"))

    start = F.struct(F.lit(0).alias("at"), empty.alias("hits"))
    indices = F.when(F.size(found) > 0, F.sequence(F.lit(0), F.size(found) - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(indices, start, step, lambda state: state["hits"])


def _kept(hits: Column) -> Column:
    """Labels and highest priority of the intervals that none before them contains.

    In order of start, then of falling end, then of priority and rule, whatever contains an interval
    comes before it; so the farthest end so far of each priority decides, in one pass.
    """

    def step(state: Column, hit: Column) -> Column:
        end = -hit["back"]
        reached = [state[f"end{p}"] >= end for p in SCORES]
        hidden = reduce(lambda a, b: a | b, [r & (hit["priority"] >= p) for p, r in zip(SCORES, reached)])
        ends = [
            F.when(hit["priority"] == p, F.greatest(state[f"end{p}"], end)).otherwise(state[f"end{p}"]).alias(f"end{p}")
            for p in SCORES
        ]
        labels = F.when(hidden, state["labels"]).otherwise(F.array_union(state["labels"], F.array(hit["label"])))
        best = F.when(hidden, state["best"]).otherwise(F.least(state["best"], hit["priority"]))
        return F.struct(*ends, labels.alias("labels"), best.alias("best"))

    start = F.struct(
        *[F.lit(-1).alias(f"end{p}") for p in SCORES],
        F.array().cast("array<string>").alias("labels"),
        F.lit(9).alias("best"),
    )
    return F.aggregate(F.array_sort(hits), start, step, lambda s: F.struct(s["labels"], s["best"]))


def scan(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score.

    ``n_base`` counts all places of the base phrases, the words are the smallest and largest start of
    one. Labels are distinct, sorted and joined by commas; ``labels`` holds the base ones and those of
    the rules' matches that are not suppressed. A null text is empty: no words, no labels, score 0.
    Everything is computed within the row, so repeated rows, null ids and skew change nothing. Further
    columns are not read.
    """
    all_rules = rules()
    keywords = sorted({word for rule in all_rules for word in rule.keywords})
    table = F.array(
        *[
            F.struct(
                F.array(*map(F.lit, r.keywords)).alias("keywords"),
                F.lit(rf"(?<= ){r.pattern}(?= )").alias("pattern"),
                F.lit(r.label).alias("label"),
                F.lit(r.priority).alias("priority"),
                F.lit(i).alias("rank"),
            )
            for i, r in enumerate(all_rules)
        ]
    )
    lowered = F.translate(F.coalesce("text", F.lit("")), _UPPER, _LOWER)
    rows = docs.select("doc_id", F.trim(F.regexp_replace(lowered, SEPARATORS, " ")).alias("plain"))
    words = F.split("plain", " ")
    rows = rows.select(
        "doc_id",
        F.concat(F.lit(" "), "plain", F.lit(" ")).alias("padded"),
        F.when(F.col("plain") == "", F.lit(0)).otherwise(F.size(words)).cast("long").alias("n_words"),
        F.array_intersect(words, F.array(*map(F.lit, keywords))).alias("present"),
    )
    places = [_placed(phrase, F.col("padded"), F.col("n_words")) for phrase in BASE]
    has_all = F.filter(table, lambda rule: F.size(F.array_except(rule["keywords"], F.col("present"))) == 0)
    gated = F.when(F.size("present") > 0, has_all)
    hits = F.flatten(F.transform(gated, lambda rule: _matches(rule, F.col("padded"))))
    rows = rows.select(
        "doc_id", "n_words", *[p.alias(f"base{i}") for i, p in enumerate(places)], _kept(hits).alias("kept")
    )
    bases = [F.col(f"base{i}") for i in range(len(BASE))]
    base_labels = F.array_compact(F.array(*[F.when(b.isNotNull(), F.lit(v)) for b, v in zip(bases, BASE.values())]))
    found = F.coalesce(F.col("kept.labels"), F.array().cast("array<string>"))
    score = F.lit(0.0)
    for priority, value in sorted(SCORES.items(), reverse=True):
        score = F.when(F.col("kept.best") == priority, F.lit(value)).otherwise(score)
    n_base = reduce(lambda a, b: a + b, [F.coalesce(b["n"], F.lit(0)) for b in bases])
    return rows.select(
        "doc_id",
        "n_words",
        n_base.cast("long").alias("n_base"),
        F.least(*[b["first"] for b in bases]).alias("first_word"),
        F.greatest(*[b["last"] for b in bases]).alias("last_word"),
        F.array_join(F.array_sort(base_labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base_labels, found)), ",").alias("labels"),
        F.greatest(score, F.when(n_base > 0, F.lit(SCORES[3])).otherwise(F.lit(0.0))).alias("score"),
    )
