"""License scan by ordered signature rules, in DataFrame functions only.

A text is reduced to its words. Four base phrases are found first. Then some five hundred rules
are tried: signatures of license texts and of notices, written one by one, and five forms of
naming each license. Each rule has a keyword that must occur before its regular expression is
run, a label and a priority. Detections of all rules are sorted by place; one that lies inside a
detection of the same or a better priority is suppressed, so "gnu lesser general public
license v3" is not also reported as a bare mention. The score is the weight of the best
rule left.

Everything about a document is computed in its row: no shuffle, no join. Texts that hold no
keyword run none of the expressions.

Defined results: NULL is empty; without words or hits the labels are empty, places NULL and
the score 0; repeated rows each have their result; other columns are ignored.
"""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salestide.llm.rows import lower_ascii, named
from salestide.llm.spans import spans

NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

# Base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Label, keywords (words that stand side by side, the last may go on), names as regular expressions over words, license tag.
NAMES = [
    ("gpl-1.0", "gpl|gnu|general public", "(?:gnu )?(?:gpl|general public license)(?: version)? v?1(?: 0)?", "gpl 1 0"),
    ("gpl-2.0", "gpl|gnu|general public", "(?:gnu )?(?:gpl|general public license)(?: version)? v?2(?: 0)?", "gpl 2 0"),
    ("gpl-3.0", "gpl|gnu|general public", "(?:gnu )?(?:gpl|general public license)(?: version)? v?3(?: 0)?", "gpl 3 0"),
    ("lgpl-2.0", "lgpl|lesser general|library general", "(?:gnu )?(?:lgpl|library general public license)(?: version)? v?2(?: 0)?", "lgpl 2 0"),
    ("lgpl-2.1", "lgpl|lesser general", "(?:gnu )?(?:lgpl|lesser general public license)(?: version)? v?2 1", "lgpl 2 1"),
    ("lgpl-3.0", "lgpl|lesser general", "(?:gnu )?(?:lgpl|lesser general public license)(?: version)? v?3(?: 0)?", "lgpl 3 0"),
    ("lgpl", "lgpl|lesser general", "(?:gnu )?(?:lgpl|lesser general public license)", "lgpl"),
    ("agpl-3.0", "agpl|affero general", "(?:gnu )?(?:agpl|affero general public license)(?: version)?(?: v?3(?: 0)?)?", "agpl 3 0"),
    ("gfdl", "gfdl|free documentation", "(?:gnu )?(?:gfdl|free documentation license)(?: version)?(?: 1 [123])?", "gfdl 1 3"),
    ("apache-1.1", "apache", "apache(?: software)? license(?: version)? v?1 1", "apache 1 1"),
    ("apache-2.0", "apache", "apache(?: software)?(?: license)?(?: version)? v?2(?: 0)?", "apache 2 0"),
    ("mit-0", "mit no", "mit no attribution", "mit 0"),
    ("mit", "mit lic|mit x11|expat", "(?:mit|expat)(?: x11)? licen[cs]e", "mit"),
    ("bsd-2-clause", "bsd|clause bsd", "(?:simplified bsd|(?:2|two) clause bsd|bsd (?:2|two) clause)(?: licen[cs]e)?", "bsd 2 clause"),
    ("bsd-3-clause", "bsd|clause bsd", "(?:(?:new|revised|modified) bsd|(?:3|three) clause bsd|bsd (?:3|three) clause)(?: licen[cs]e)?", "bsd 3 clause"),
    ("bsd-4-clause", "bsd|clause bsd", "(?:original bsd|(?:4|four) clause bsd|bsd (?:4|four) clause)(?: licen[cs]e)?", "bsd 4 clause"),
    ("0bsd", "0bsd|clause bsd", "(?:zero clause bsd|0bsd)(?: licen[cs]e)?", "0bsd"),
    ("bsd", "bsd|clause bsd", "bsd(?: style)? licen[cs]e", "bsd"),
    ("isc", "isc lic", "isc licen[cs]e", "isc"),
    ("zlib", "zlib", "zlib(?: libpng)? licen[cs]e", "zlib"),
    ("mpl-1.1", "mozilla public|mpl", "(?:mozilla public license|mpl)(?: version)? v?1 1", "mpl 1 1"),
    ("mpl-2.0", "mozilla public|mpl", "(?:mozilla public license|mpl)(?: version)?(?: v?2(?: 0)?)?", "mpl 2 0"),
    ("epl-1.0", "eclipse public|epl", "(?:eclipse public license|epl)(?: version)? v?1(?: 0)?", "epl 1 0"),
    ("epl-2.0", "eclipse public|epl", "(?:eclipse public license|epl)(?: version)?(?: v?2(?: 0)?)?", "epl 2 0"),
    ("cddl-1.0", "cddl|common development", "(?:common development and distribution license|cddl)(?: version)?(?: v?1(?: [01])?)?", "cddl 1 0"),
    ("cpl-1.0", "common public", "common public license(?: version)?(?: v?1(?: 0)?)?", "cpl 1 0"),
    ("eupl-1.2", "eupl|european union", "(?:european union public licen[cs]e|eupl)(?: version)?(?: v?1 [12])?", "eupl 1 2"),
    ("artistic-2.0", "artistic lic", "artistic license(?: version)?(?: v?[12](?: 0)?)?", "artistic 2 0"),
    ("bsl-1.0", "boost software", "boost software license(?: version)?(?: 1(?: 0)?)?", "bsl 1 0"),
    ("busl-1.1", "business source", "business source license(?: version)?(?: 1 1)?", "busl 1 1"),
    ("sspl-1.0", "sspl|server side", "(?:server side public license|sspl)(?: version)?(?: v?1(?: 0)?)?", "sspl 1 0"),
    ("psf-2.0", "python software", "python software foundation license(?: version)?(?: 2(?: 0)?)?", "psf 2 0"),
    ("unlicense", "unlicense", "(?:the )?unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl", "wtfpl"),
    ("openssl", "openssl", "openssl license", "openssl"),
    ("ofl-1.1", "ofl|open font", "(?:sil )?open font license(?: version)?(?: 1 1)?", "ofl 1 1"),
    ("odbl-1.0", "odbl|open database", "(?:open database license|odbl)(?: version)?(?: v?1(?: 0)?)?", "odbl 1 0"),
    ("cc0-1.0", "cc0|creative commons", "(?:cc0|creative commons zero)(?: v?1(?: 0)?)?(?: universal)?", "cc0 1 0"),
    ("public-domain", "public domain", "public domain(?: dedication)?", "public domain"),
    ("proprietary", "proprietary and|confidential and", "(?:proprietary and confidential|confidential and proprietary)", "licenseref proprietary"),
    ("all-rights-reserved", "all rights", "all rights reserved", "licenseref all rights reserved"),
]
# The terms of the Creative Commons licenses and their names.
CREATIVE = {
    "by": "attribution",
    "by sa": "attribution share ?alike",
    "by nd": "attribution no ?derivatives",
    "by nc": "attribution non ?commercial",
    "by nc sa": "attribution non ?commercial share ?alike",
    "by nc nd": "attribution non ?commercial no ?derivatives",
}
VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")
# Signatures of license texts and notices, one by one: priority, weight, label, keywords, words.
SIGNATURES = [
    # Bodies of licenses.
    (1, 1.0, "mit", "permission is hereby", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files(?: the software)? to deal in the software without restriction"),
    (1, 0.9, "mit", "above copyright", "the above copyright notice and this permission notice(?: including the next paragraph)? shall be included in all copies or substantial portions of the software"),
    (1, 1.0, "bsl-1.0", "permission is hereby", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    (1, 1.0, "unicode-dfs", "permission is hereby", "permission is hereby granted free of charge to any person obtaining a copy of the unicode data files and any associated documentation"),
    (1, 1.0, "ncsa", "to deal with", "to deal with the software without restriction including without limitation the rights to use"),
    (1, 1.0, "isc", "permission to use", "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted provided that"),
    (1, 1.0, "0bsd", "permission to use", "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted the software is provided as is"),
    (1, 1.0, "ntp", "permission to use", "permission to use copy modify and distribute this software and its documentation for any purpose with or without fee is hereby granted"),
    (1, 1.0, "hpnd", "permission to use", "permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted"),
    (1, 1.0, "postgresql", "permission to use", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    (1, 1.0, "bsd", "redistribution and", "redistribution and use in source and binary forms with or without modification are permitted(?: subject to the limitations in the disclaimer below)? provided that the following conditions are met"),
    (1, 0.9, "bsd", "redistributions of", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    (1, 0.9, "bsd", "redistributions in", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    (1, 1.0, "bsd-3-clause", "endorse or", "may be used to endorse or promote products derived from this software without(?: specific)? prior written permission"),
    (1, 1.0, "bsd-4-clause", "advertising materials", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    (1, 1.0, "bsd-3-clause-clear", "patent rights", "no express or implied licenses to any party s patent rights are granted by this license"),
    (1, 1.0, "bsd-2-clause-patent", "each copyright", "subject to the terms and conditions of this license each copyright holder and contributor hereby grants to those receiving rights under this license"),
    (1, 1.0, "x11", "x consortium", "the name of the x consortium shall not be used in advertising or otherwise to promote the sale"),
    (1, 1.0, "apache-2.0", "apache license", "apache license version 2 0 january 2004"),
    (1, 1.0, "apache-2.0", "each contributor", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable(?: except as stated in this section)? (?:copyright|patent) license"),
    (1, 1.0, "apache-1.1", "apache software|apache group", "this product includes software developed by the apache (?:software foundation|group)"),
    (1, 1.0, "gpl-1.0", "gnu general", "gnu general public license version 1 february 1989"),
    (1, 1.0, "gpl-2.0", "gnu general", "gnu general public license version 2 june 1991"),
    (1, 1.0, "gpl-3.0", "gnu general", "gnu general public license version 3 29 june 2007"),
    (1, 1.0, "gpl-2.0", "licenses for", "the licenses for most software are designed to take away your freedom to share and change it"),
    (1, 1.0, "gpl-3.0", "copyleft license", "the gnu general public license is a free copyleft license for software and other kinds of works"),
    (1, 1.0, "agpl-3.0", "copyleft license", "the gnu affero general public license is a free copyleft license for software and other kinds of works"),
    (1, 1.0, "agpl-3.0", "gnu affero", "gnu affero general public license version 3 19 november 2007"),
    (1, 1.0, "lgpl-2.0", "gnu library", "gnu library general public license version 2 june 1991"),
    (1, 1.0, "lgpl-2.1", "gnu lesser", "gnu lesser general public license version 2 1 february 1999"),
    (1, 1.0, "lgpl-3.0", "gnu lesser", "gnu lesser general public license version 3 29 june 2007"),
    (1, 1.0, "zlib", "held liable", "in no event will the authors? be held liable for any damages arising from the use of this software"),
    (1, 0.9, "zlib", "altered source", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    (1, 0.9, "zlib", "origin of", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    (1, 1.0, "libpng", "png reference", "the png reference library is supplied as is"),
    (1, 1.0, "epl", "eclipse public", "the accompanying program is provided under the terms of this eclipse public license"),
    (1, 1.0, "cpl-1.0", "common public", "the accompanying program is provided under the terms of this common public license"),
    (1, 1.0, "ipl-1.0", "ibm public", "the accompanying program is provided under the terms of this ibm public license"),
    (1, 1.0, "eupl-1.2", "european union", "this european union public licence the eupl applies to the work"),
    (1, 1.0, "unlicense", "unencumbered software", "this is free and unencumbered software released into the public domain"),
    (1, 0.9, "unlicense", "anyone is", "anyone is free to copy modify publish use compile sell or distribute this software"),
    (1, 1.0, "wtfpl", "do what", "do what the fuck you want to public license"),
    (1, 1.0, "cc0-1.0", "neighboring rights", "waived all copyright and related or neighboring rights"),
    (1, 1.0, "cc0-1.0", "dedicated the", "has dedicated the work to the public domain by waiving all"),
    (1, 1.0, "artistic-1.0", "artistic control", "the copyright holder maintains some semblance of artistic control"),
    (1, 1.0, "artistic-2.0", "free software", "this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed"),
    (1, 1.0, "psf-2.0", "psf is", "psf is making python available to licensee on an as is basis"),
    (1, 1.0, "psf-2.0", "python software", "this license agreement is between the python software foundation"),
    (1, 1.0, "ruby", "verbatim copies", "you may make and give away verbatim copies of the source form of the software without restriction"),
    (1, 1.0, "php-3.01", "php software", "this product includes php software freely available from"),
    (1, 1.0, "openssl", "openssl project", "this product includes software developed by the openssl project for use in the openssl toolkit"),
    (1, 1.0, "ssleay", "cryptographic software", "this product includes cryptographic software written by eric young"),
    (1, 1.0, "json", "for good", "the software shall be used for good not evil"),
    (1, 1.0, "beerware", "retain this", "as long as you retain this notice you can do whatever you want with this stuff"),
    (1, 1.0, "ms-pl", "accompanying software", "this license governs use of the accompanying software if you use the software you accept this license"),
    (1, 1.0, "sspl-1.0", "functionality of", "if you make the functionality of the program or a modified version available to third parties as a service"),
    (1, 1.0, "busl-1.1", "non production", "make non production use of the licensed work"),
    (1, 1.0, "elastic-2.0", "managed service", "you may not provide the software to third parties as a hosted or managed service"),
    (1, 1.0, "commons-clause", "commons clause", "commons clause license condition"),
    (1, 1.0, "sleepycat", "complete source", "must be accompanied by information on how to obtain complete source code for the"),
    (1, 1.0, "odbl-1.0", "open database", "the open database license odbl is a license agreement intended to allow users to freely share modify and use this database"),
    (1, 1.0, "ofl-1.1", "font software", "this font software is licensed under the sil open font license(?: version)? 1 1"),
    # Notices in files.
    (2, 0.95, "apache-2.0", "apache license", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    (2, 0.9, "apache-2.0", "required by", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    (2, 0.95, "gpl-1.0", "gnu general", "gnu general public license as published by the free software foundation either version 1 of the license"),
    (2, 0.95, "gpl-2.0", "gnu general", "gnu general public license as published by the free software foundation either version 2 of the license"),
    (2, 0.95, "gpl-3.0", "gnu general", "gnu general public license as published by the free software foundation either version 3 of the license"),
    (2, 0.95, "gpl-2.0", "gnu general", "gnu general public license version 2(?: only)? as published by the free software foundation"),
    (2, 0.95, "gpl-3.0", "gnu general", "gnu general public license version 3(?: only)? as published by the free software foundation"),
    (2, 0.95, "lgpl-2.0", "gnu library|gnu lesser", "gnu (?:library|lesser) general public license as published by the free software foundation either version 2 of the license"),
    (2, 0.95, "lgpl-2.1", "gnu lesser", "gnu lesser general public license as published by the free software foundation either version 2 1 of the license"),
    (2, 0.95, "lgpl-3.0", "gnu lesser", "gnu lesser general public license as published by the free software foundation either version 3 of the license"),
    (2, 0.95, "agpl-3.0", "gnu affero", "gnu affero general public license as published by the free software foundation either version 3 of the license"),
    (2, 0.9, "gpl", "gnu general", "you should have received a copy of the gnu general public license"),
    (2, 0.9, "lgpl", "gnu lesser|gnu library", "you should have received a copy of the gnu (?:lesser|library) general public license"),
    (2, 0.9, "agpl-3.0", "gnu affero", "you should have received a copy of the gnu affero general public license"),
    (2, 0.9, "gfdl", "gnu free", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    (2, 0.95, "classpath-exception", "independent modules", "give you permission to link this library with independent modules to produce an executable"),
    (2, 0.95, "gcc-exception", "gcc runtime", "gcc runtime library exception"),
    (2, 0.95, "llvm-exception", "llvm exception", "(?:with )?llvm exceptions?"),
    (2, 0.95, "mpl-1.1", "mozilla public", "the contents of this file are subject to the mozilla public license version 1 1"),
    (2, 0.95, "mpl-2.0", "mozilla public", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    (2, 0.9, "mpl-2.0", "the mpl", "if a copy of the mpl was not distributed with this file you can obtain one at"),
    (2, 0.95, "mpl-2.0-no-copyleft-exception", "secondary licenses", "this source code form is incompatible with secondary licenses"),
    (2, 0.95, "npl-1.1", "netscape public", "the contents of this file are subject to the netscape public license"),
    (2, 0.95, "epl-1.0", "eclipse public", "made available under the terms of the eclipse public license v ?1 0"),
    (2, 0.95, "epl-2.0", "eclipse public", "made available under the terms of the eclipse public license (?:v )?2 0"),
    (2, 0.95, "cddl-1.0", "common development", "the contents of this file are subject to the terms of the common development and distribution license"),
    (2, 0.95, "cc-by-4.0", "creative commons", "licensed under (?:a|the) creative commons attribution 4 0 international(?: public)? license"),
    (2, 0.95, "cc-by-sa-4.0", "creative commons", "licensed under (?:a|the) creative commons attribution share ?alike 4 0 international(?: public)? license"),
    (2, 0.95, "cc-by-nd-4.0", "creative commons", "licensed under (?:a|the) creative commons attribution no ?derivatives 4 0 international(?: public)? license"),
    (2, 0.95, "cc-by-nc-4.0", "creative commons", "licensed under (?:a|the) creative commons attribution non ?commercial 4 0 international(?: public)? license"),
    (2, 0.95, "cc-by-nc-sa-4.0", "creative commons", "licensed under (?:a|the) creative commons attribution non ?commercial share ?alike 4 0 international(?: public)? license"),
    (2, 0.95, "cc-by-nc-nd-4.0", "creative commons", "licensed under (?:a|the) creative commons attribution non ?commercial no ?derivatives 4 0 international(?: public)? license"),
    (2, 0.95, "cc-by-3.0", "creative commons", "licensed under (?:a|the) creative commons attribution 3 0 unported license"),
    (2, 0.95, "cc-by-sa-3.0", "creative commons", "licensed under (?:a|the) creative commons attribution share ?alike 3 0 unported license"),
    (2, 0.9, "ofl-1.1", "reserved font", "with reserved font name"),
    (2, 0.95, "perl", "as perl", "under the same terms as perl(?: 5)? itself"),
    (2, 0.95, "cecill", "cecill", "governed by the cecill(?: b| c)? license under french law"),
    (2, 0.95, "lppl", "latex project", "distributed and or modified under the conditions of the latex project public license"),
    (2, 0.95, "ijg", "independent jpeg", "based in part on the work of the independent jpeg group"),
    (2, 0.95, "ftl", "freetype project", "portions of this software are copyright(?: c)?(?: [0-9]+)? the freetype project"),
    (2, 0.95, "proprietary", "unauthorized copying", "unauthorized copying of this file via any medium is strictly prohibited"),
    (2, 0.95, "proprietary", "the confidential", "this software is the confidential and proprietary information of"),
    (2, 0.9, "all-rights-reserved", "retrieval system", "may be reproduced stored in a retrieval system or transmitted"),
    (2, 0.9, "non-commercial", "non commercial|noncommercial", "(?:for|personal and) non ?commercial use only"),
    (2, 0.9, "eula", "end user", "end user licen[cs]e agreement"),
    (2, 0.9, "public-domain", "in the public|into the public", "(?:is|are|been placed|been released|been put) in(?:to)? the public domain"),
    (2, 0.9, "public-domain", "disclaims copyright", "the author disclaims copyright to this source code"),
    (2, 0.9, "us-government-work", "united states government", "work of the united states government"),
    # Names written in one word, pairs of licenses, and licenses without a tag above.
    (3, 0.6, "gpl-2.0", "gplv2|gpl2", "gplv?2(?: 0)?"),
    (3, 0.6, "gpl-3.0", "gplv3|gpl3", "gplv?3(?: 0)?"),
    (3, 0.6, "lgpl-2.1", "lgplv2|lgpl2", "lgplv?2 1"),
    (3, 0.6, "lgpl-2.0", "lgplv2|lgpl2", "lgplv?2(?: 0)?"),
    (3, 0.6, "lgpl-3.0", "lgplv3|lgpl3", "lgplv?3(?: 0)?"),
    (3, 0.6, "agpl-3.0", "agplv3|agpl3", "agplv?3(?: 0)?"),
    (3, 0.6, "apache-2.0", "apachev2|apache2", "apachev?2(?: 0)?(?: licen[cs]e)?"),
    (3, 0.6, "apache-2.0", "asl", "asl v?2(?: 0)?"),
    (3, 0.6, "mpl-2.0", "mplv2|mpl2", "mplv?2(?: 0)?"),
    (3, 0.6, "epl-2.0", "eplv2|epl2", "eplv?2(?: 0)?"),
    (3, 0.6, "mit", "apache", "mit(?: or| and)? apache"),
    (3, 0.6, "mit", "2 0 mit|2 0 or mit", "2 0(?: or)? mit"),
    (3, 0.6, "edl-1.0", "eclipse distribution", "eclipse distribution license(?: v)?(?: 1 0)?"),
    (3, 0.6, "ncsa", "ncsa", "(?:university of illinois )?ncsa open source license"),
    (3, 0.6, "ms-pl", "microsoft public", "microsoft public license"),
    (3, 0.6, "ms-rl", "microsoft reciprocal", "microsoft reciprocal license"),
    (3, 0.6, "afl-3.0", "academic free", "academic free license(?: version)?(?: v?3(?: 0)?)?"),
    (3, 0.6, "osl-3.0", "open software", "open software license(?: version)?(?: v?3(?: 0)?)?"),
    (3, 0.6, "odc-by-1.0", "open data", "open data commons attribution license"),
    (3, 0.6, "pddl-1.0", "open data", "open data commons public domain dedication and license"),
    (3, 0.6, "cdla-permissive", "community data", "community data license agreement permissive"),
    (3, 0.6, "cdla-sharing", "community data", "community data license agreement sharing"),
    (3, 0.6, "elastic-2.0", "elastic license", "elastic license(?: version)?(?: v?2(?: 0)?)?"),
    (3, 0.6, "polyform-noncommercial", "polyform", "polyform noncommercial license"),
    (3, 0.6, "polyform-small-business", "polyform", "polyform small business license"),
    (3, 0.6, "openrail", "creativeml|openrail|bigscience", "(?:creativeml open ?rail(?: m)?|openrail(?: m)?|bigscience (?:open ?)?rail license)"),
    (3, 0.6, "llama-community", "llama", "llama (?:2|3|3 [123]) community license"),
    (3, 0.6, "mulanpsl-2.0", "mulan", "mulan permissive software license"),
    (3, 0.6, "upl-1.0", "universal permissive", "universal permissive license"),
    (3, 0.6, "zpl-2.1", "zope public", "zope public license"),
    (3, 0.6, "qpl-1.0", "q public", "q public license"),
    (3, 0.6, "lppl", "latex project", "latex project public license"),
    (3, 0.6, "w3c", "w3c", "w3c software(?: and document)? notice and license"),
    (3, 0.6, "ogl-uk", "open government", "open government licence"),
]
#: Keywords of the first form, which holds the license tag and may hold no word of the name.
TAGGED = "spdx license"

#: How a rule finds a name: its priority, its weight and what stands around the name.
FORMS = [
    (1, 1.0, "spdx license identifier {tag}(?: only| or later)?"),
    (2, 0.95, "(?:licensed|released|distributed|available|published|provided) under (?:the )?(?:terms of )?(?:the )?{name}"),
    (2, 0.9, "licen[cs]e (?:is )?(?:the )?{name}"),
    (2, 0.9, "(?:subject to|governed by|covered by) (?:the )?(?:terms of )?(?:the )?{name}"),
    (3, 0.6, "{name}"),
]


def rules() -> list[tuple[int, float, str, str, str]]:
    """Priority, weight, label, keywords and expression, the most specific names first."""
    names = list(NAMES)
    for terms, words in reversed(CREATIVE.items()):
        label = "cc-" + terms.replace(" ", "-")
        for version in VERSIONS:
            name = f"(?:cc {terms}|creative commons {words})(?: version)? {version}"
            own = f"{label}-{version.replace(' ', '.')}"
            names.append((own, "cc by|creative commons", name, f"cc {terms} {version}"))
        names.append((label, "cc by|creative commons", f"(?:cc {terms}|creative commons {words})", f"cc {terms}"))
    made = [(*rule[:4], f" (?:{rule[4]})(?= )") for rule in SIGNATURES]
    for priority, weight, form in FORMS:
        for label, keywords, name, tag in names:
            found = form.replace("{name}", f"(?:{name})").replace("{tag}", re.escape(tag).replace("\\ ", " "))
            own = TAGGED if "{tag}" in form else keywords
            made.append((priority, weight, label, own, f" {found}(?= )"))
    return sorted(made, key=lambda rule: rule[0])


def _blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


@cache
def keywords() -> list[str]:
    """All keywords; one that begins another comes before it."""
    return sorted({word for rule in rules() for word in rule[3].split("|")})


def _table() -> Column:
    """All rules as one constant. Written as SQL, which a session reads far faster than it
    builds thousands of columns; the rules hold neither quotes nor backslashes.

    The search for keywords finds the shortest one at each place, which may be the beginning of
    a rule's own; ``keywords`` holds what it can find in place of them.
    """

    def one(number: int, rule: tuple[int, float, str, str, str]) -> str:
        priority, weight, label, words, pattern = rule
        own = tuple(words.split("|"))
        found = ", ".join(f"'{k}'" for k in keywords() if any(w.startswith(k) for w in own))
        return (
            f"named_struct('number', {number}, 'priority', {priority}, 'weight', {weight}D,"
            f" 'label', '{label}', 'keywords', array({found}), 'pattern', '{pattern}')"
        )

    return F.expr(f"array({', '.join(one(*numbered) for numbered in enumerate(rules()))})")


def _detections(said: Column, hits: Column) -> Column:
    """Detections of all rules of which a keyword occurs, by place, longest and best first."""
    tried = F.filter(_table(), lambda rule: F.arrays_overlap(rule["keywords"], hits))

    def found(rule: Column) -> Column:
        return F.transform(
            spans(said, rule["pattern"]),
            lambda s: F.struct(
                s["start"].alias("start"),
                (-s["end"]).alias("last"),
                rule["priority"].alias("priority"),
                rule["number"].alias("number"),
                rule["weight"].alias("weight"),
                rule["label"].alias("label"),
            ),
        )

    return F.sort_array(F.flatten(F.transform(tried, found)))


def _left(detections: Column) -> Column:
    """Labels and best weight of the detections that are not inside one of the same or a
    better priority. In order of place, the furthest end so far tells."""
    start = F.struct(
        F.array(*[F.lit(-1)] * 3).alias("ends"),
        F.array().cast("array<string>").alias("labels"),
        F.lit(0.0).alias("weight"),
    )

    def add(state: Column, one: Column) -> Column:
        end, priority = -one["last"], one["priority"]
        inside = F.get(state["ends"], priority - 1) >= end
        ends = F.transform(
            state["ends"], lambda e, i: F.when(i >= priority - 1, F.greatest(e, end)).otherwise(e)
        )
        with_it = F.struct(
            ends.alias("ends"),
            F.array_union(state["labels"], F.array(one["label"])).alias("labels"),
            F.greatest(state["weight"], one["weight"]).alias("weight"),
        )
        return F.when(inside, state).otherwise(with_it)

    return F.aggregate(detections, start, add)


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n_words, n_base, first_word, last_word, base_labels, labels, score``."""
    own = named(docs, id=id, text=text)
    own = own.select("id", lower_ascii(F.coalesce(F.col("text"), F.lit(""))).alias("low"))
    # The parts between runs of other characters are the words, but for empty ends.
    parts = F.col("parts")
    ends = F.when(parts[0] == "", 1).otherwise(0) + F.when(F.element_at(parts, -1) == "", 1).otherwise(0)
    n_words = F.greatest(F.size(parts) - ends, F.lit(0)).cast("long")
    # Of a keyword, the first word must be there for the text to be looked at.
    rows = own.select("id", F.split("low", NOT_WORD, -1).alias("parts"))
    firsts = sorted({word.split()[0] for word in keywords()})
    some = F.arrays_overlap(parts, F.array(*map(F.lit, firsts)))
    said = F.concat(F.lit(" "), F.array_join(F.filter(parts, lambda w: w != ""), " "), F.lit(" "))
    rows = rows.select("id", n_words.alias("n_words"), F.when(some, said).alias("said"))
    # Every place is looked at, also within a keyword.
    found = F.regexp_extract_all("said", F.lit(" (?=(" + "|".join(keywords()) + "))"), F.lit(1))
    rows = rows.select("*", F.array_distinct(found).alias("hits"))
    phrase = " (?:" + "|".join(BASE) + ")(?= )"
    said = F.col("said")
    rows = rows.select(
        "*",
        F.regexp_extract_all(said, F.lit(phrase), F.lit(0)).alias("base"),
        F.when(F.regexp_like(said, F.lit(phrase)), F.split(said, phrase, -1)).alias("around"),
        F.when(F.size("hits") > 0, _detections(said, F.col("hits"))).alias("detections"),
    )
    rows = rows.select("*", _left(F.col("detections")).alias("left"))
    base, around = F.col("base"), F.col("around")
    n_base = F.coalesce(F.size(F.when(base.isNotNull(), base)), F.lit(0))
    last = F.col("n_words") - (_blanks(F.get(around, n_base)) - 1)
    last = last - _blanks(F.get(base, n_base - 1))
    phrase_label = F.create_map(*[F.lit(x) for p, l in BASE.items() for x in (f" {p}", l)])
    base_labels = F.transform(F.coalesce(base, F.array().cast("array<string>")), lambda p: phrase_label[p])
    nothing = F.array().cast("array<string>")
    all_labels = F.array_union(base_labels, F.coalesce(F.col("left")["labels"], nothing))
    by_base = F.when(n_base > 0, 0.6).otherwise(0.0)
    return rows.select(
        "id",
        "n_words",
        n_base.cast("long").alias("n_base"),
        F.when(n_base > 0, _blanks(F.get(around, F.lit(0)))).cast("long").alias("first_word"),
        F.when(n_base > 0, last).cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.array_distinct(base_labels)), ",").alias("base_labels"),
        F.array_join(F.sort_array(all_labels), ",").alias("labels"),
        F.greatest(F.coalesce(F.col("left")["weight"], F.lit(0.0)), by_base).alias("score"),
    )
