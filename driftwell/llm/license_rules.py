"""Signature rules of license scans, in order of priority: the first of two rules that claim the same words wins.

Texts are lower-cased words joined by single spaces (punctuation is gone: "BSD-3-Clause" reads "bsd 3 clause"). Each rule is a
regex written for one way of stating one license.
"""

# Machine-readable tags.
TAGS = (
    ("gpl-2.0-only", r"spdx license identifier gpl 2 0 only"),
    ("gpl-2.0-or-later", r"spdx license identifier gpl 2 0 or later"),
    ("gpl-2.0", r"spdx license identifier gpl 2 0(?: with linux syscall note)?"),
    ("gpl-3.0-only", r"spdx license identifier gpl 3 0 only"),
    ("gpl-3.0-or-later", r"spdx license identifier gpl 3 0 or later"),
    ("gpl-3.0", r"spdx license identifier gpl 3 0"),
    ("agpl-3.0-only", r"spdx license identifier agpl 3 0 only"),
    ("agpl-3.0-or-later", r"spdx license identifier agpl 3 0 or later"),
    ("agpl-3.0", r"spdx license identifier agpl 3 0"),
    ("lgpl-2.1-only", r"spdx license identifier lgpl 2 1 only"),
    ("lgpl-2.1-or-later", r"spdx license identifier lgpl 2 1 or later"),
    ("lgpl-3.0-or-later", r"spdx license identifier lgpl 3 0 or later"),
    ("lgpl-3.0", r"spdx license identifier lgpl 3 0(?: only)?"),
    ("mit-or-apache-2", r"spdx license identifier (?:mit or apache 2 0|apache 2 0 or mit)"),
    ("mit-0", r"spdx license identifier mit 0"),
    ("mit", r"spdx license identifier mit"),
    ("apache-2", r"spdx license identifier apache 2 0(?: with llvm exception)?"),
    ("apache-1.1", r"spdx license identifier apache 1 1"),
    ("bsd-2-clause", r"spdx license identifier bsd 2 clause(?: patent)?"),
    ("bsd-3-clause", r"spdx license identifier bsd 3 clause(?: clear)?"),
    ("bsd-4-clause", r"spdx license identifier bsd 4 clause(?: uc)?"),
    ("0bsd", r"spdx license identifier 0bsd"),
    ("isc", r"spdx license identifier isc"),
    ("zlib", r"spdx license identifier zlib"),
    ("bsl-1.0", r"spdx license identifier bsl 1 0"),
    ("busl-1.1", r"spdx license identifier busl 1 1"),
    ("mpl-2.0", r"spdx license identifier mpl 2 0(?: no copyleft exception)?"),
    ("mpl-1.1", r"spdx license identifier mpl 1 1"),
    ("epl-2.0", r"spdx license identifier epl 2 0"),
    ("epl-1.0", r"spdx license identifier epl 1 0"),
    ("eupl-1.2", r"spdx license identifier eupl 1 2"),
    ("cddl-1.0", r"spdx license identifier cddl 1 [01]"),
    ("unlicense", r"spdx license identifier unlicense"),
    ("wtfpl", r"spdx license identifier wtfpl"),
    ("cc0-1.0", r"spdx license identifier cc0 1 0"),
    ("cc-by-sa-4.0", r"spdx license identifier cc by sa 4 0"),
    ("cc-by-nc-4.0", r"spdx license identifier cc by nc 4 0"),
    ("cc-by-4.0", r"spdx license identifier cc by 4 0"),
    ("artistic-2.0", r"spdx license identifier artistic 2 0"),
    ("postgresql", r"spdx license identifier postgresql"),
    ("python-2.0", r"spdx license identifier (?:python|psf) 2 0"),
    ("ofl-1.1", r"spdx license identifier ofl 1 1"),
    ("proprietary", r"spdx license identifier licenseref proprietary"),
    ("mit", r"licen[sc]e osi approved mit licen[sc]e"),
    ("apache-2", r"licen[sc]e osi approved apache software licen[sc]e"),
    ("bsd", r"licen[sc]e osi approved bsd licen[sc]e"),
    ("gpl-3.0", r"licen[sc]e osi approved gnu general public licen[sc]e v3(?: or later)? gplv3"),
    ("proprietary", r"licen[sc]e other proprietary licen[sc]e"),
)

# Sentences of the licenses' own texts.
BODIES = (
    ("bsl-1.0", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("ncsa", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal with the software without restriction"),
    ("mit-modern", r"permission is hereby granted without written agreement and without license or royalty fees to use"),
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", r"to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("ofl-1.1", r"permission is hereby granted free of charge to any person obtaining a copy of the font software"),
    ("ofl-1.1", r"the font software may be modified altered or added to"),
    ("ofl-1.1", r"with reserved font name"),
    ("unicode", r"permission is hereby granted free of charge to any person obtaining a copy of the unicode data files"),
    ("upl-1.0", r"subject to the condition set forth below permission is hereby granted to any person obtaining a copy of this software"),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", r"permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided"),
    ("0bsd", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is"),
    ("hpnd", r"permission to use copy modify (?:and )?distribute and sell this software and its documentation for any purpose is hereby granted"),
    ("postgresql", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement"),
    ("curl", r"permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies except as contained in this notice"),
    ("ntp", r"permission to use copy modify and distribute this software and its documentation for any purpose with or without fee is hereby granted"),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd-3-clause-clear", r"no express or implied licenses to any party s patent rights are granted by this license"),
    ("bsd-3-clause", r"neither the names? of .{1,120}? (?:nor|or) the names of (?:its|their|any) contributors may be used to endorse"),
    ("bsd-3-clause", r"the names? of the authors? may not be used to endorse or promote products derived from this software"),
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", r"redistributions of source code must retain the above copyright notice this list of conditions"),
    ("bsd", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-source-code", r"redistribution and use of this software in source and binary forms with or without modification are permitted"),
    ("apache-1.1", r"the end user documentation included with the redistribution if any must include the following acknowledge?ment"),
    ("apache-1.1", r"this product includes software developed by the apache (?:software foundation|group)"),
    ("apache-2", r"you may not use this file except in compliance with the licen[sc]e"),
    ("apache-2", r"unless required by applicable law or agreed to in writing software distributed under the licen[sc]e is distributed on an as is basis"),
    ("apache-2", r"terms and conditions for use reproduction and distribution 1 definitions"),
    ("apache-2", r"you may obtain a copy of the licen[sc]e at http www apache org licen[sc]es licen[sc]e 2 0"),
    ("gpl-3.0", r"gnu general public license version 3 29 june 2007"),
    ("gpl-2.0", r"gnu general public license version 2 june 1991"),
    ("agpl-3.0", r"gnu affero general public license version 3 19 november 2007"),
    ("lgpl-2.1", r"gnu lesser general public license version 2 1 february 1999"),
    ("lgpl-3.0", r"gnu lesser general public license version 3 29 june 2007"),
    ("gpl-3.0-or-later", r"under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl-2.0-or-later", r"under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("lgpl-2.1-or-later", r"under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version"),
    ("lgpl-3.0-or-later", r"under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("agpl-3.0-or-later", r"under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl-2.0-only", r"under the terms of the gnu general public license version 2 as published by the free software foundation"),
    ("lgpl", r"this library is free software you can redistribute it and or modify"),
    ("gpl", r"this program is free software you can redistribute it and or modify"),
    ("gpl", r"this program is distributed in the hope that it will be useful but without any warranty"),
    ("gpl", r"you should have received a copy of the gnu general public licen[sc]e along with"),
    ("gpl", r"everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
    ("gfdl", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[sc]e"),
    ("mpl-2.0", r"this source code form is subject to the terms of the mozilla public licen[sc]e"),
    ("mpl-1.1", r"the contents of this file are subject to the mozilla public licen[sc]e version 1 1"),
    ("cddl-1.0", r"the contents of this file are subject to the terms of the common development and distribution licen[sc]e"),
    ("cpal-1.0", r"the contents of this file are subject to the common public attribution licen[sc]e"),
    ("epl-2.0", r"this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e (?:v|version )?2 0"),
    ("epl-1.0", r"this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e (?:v|version )?1 0"),
    ("epl", r"the accompanying program is provided under the terms of this eclipse public licen[sc]e"),
    ("eupl-1.2", r"licensed under the eupl version 1 2 or as soon they will be approved"),
    ("artistic-2.0", r"everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed preamble this license establishes the terms"),
    ("artistic-1.0", r"the intent of this document is to state the conditions under which a package may be copied"),
    ("zlib", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("zlib", r"altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("libpng", r"this copy of the libpng notices is provided for your convenience"),
    ("unlicense", r"this is free and unencumbered software released into the public domain"),
    ("wtfpl", r"you just do what the \w+ you want to"),
    ("beerware", r"as long as you retain this notice you can do whatever you want with this stuff"),
    ("openssl", r"this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("ssleay", r"this product includes cryptographic software written by eric young"),
    ("php-3.01", r"this product includes php software freely available from"),
    ("python-2.0", r"this license agreement is between the python software foundation psf"),
    ("ruby", r"you may make and give away verbatim copies of the source form of the software without restriction"),
    ("tcl", r"the authors hereby grant permission to use copy modify distribute and license this software and its documentation"),
    ("x11", r"except as contained in this notice the name of the x consortium shall not be used"),
    ("ms-pl", r"this license governs use of the accompanying software if you use the software you accept this license"),
    ("cc0-1.0", r"the person who associated a work with this deed has dedicated the work to the public domain"),
    ("cc0-1.0", r"to the extent possible under law .{1,120}? waived all copyright and related or neighboring rights"),
    ("cc-by", r"you are free to share copy and redistribute the material in any medium or format(?: for any purpose even commercially)?"),
    ("busl-1.1", r"the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work"),
    ("elastic-2.0", r"you may not provide the software to third parties as a hosted or managed service"),
    ("sspl-1.0", r"if you make the functionality of the program or a modified version available to third parties as a service"),
    ("commons-clause", r"the license does not grant to you the right to sell the software"),
    ("json", r"the software shall be used for good not evil"),
    ("fair", r"usage of the works is permitted provided that this instrument is retained with the works"),
    ("blueoak-1.0.0", r"each contributor licenses you to do everything with this software that would otherwise infringe"),
    ("openrail", r"you agree not to use the model or derivatives of the model in any way that violates"),
    ("llama", r"you are granted a non exclusive worldwide non transferable and royalty free limited license under meta s intellectual property"),
    ("proprietary", r"unauthori[sz]ed (?:copying|reproduction|use|distribution) of this file via any medium is strictly prohibited"),
    ("proprietary", r"this software is the confidential and proprietary information of"),
    ("proprietary", r"no part of this (?:publication|document|work|book) may be reproduced (?:stored|distributed|copied|in any form)"),
)

# How a work says which license it has.
NOTICES = (
    ("gpl-3.0-or-later", r"gnu general public licen[sc]e (?:v|version )?3(?: 0)? or (?:at your option )?(?:any )?later"),
    ("gpl-2.0-or-later", r"gnu general public licen[sc]e (?:v|version )?2(?: 0)? or (?:at your option )?(?:any )?later"),
    ("lgpl-2.1-or-later", r"gnu lesser general public licen[sc]e (?:v|version )?2 1 or (?:at your option )?(?:any )?later"),
    ("agpl-3.0-or-later", r"gnu affero general public licen[sc]e (?:v|version )?3(?: 0)? or (?:at your option )?(?:any )?later"),
    ("gpl-3.0-or-later", r"gpl ?v?3(?: 0)? or (?:any )?later"),
    ("gpl-2.0-or-later", r"gpl ?v?2(?: 0)? or (?:any )?later"),
    ("lgpl-3.0-or-later", r"lgpl ?v?3(?: 0)? or (?:any )?later"),
    ("lgpl-2.1-or-later", r"lgpl ?v?2 1 or (?:any )?later"),
    ("agpl-3.0-or-later", r"agpl ?v?3(?: 0)? or (?:any )?later"),
    ("gpl-3.0-only", r"gpl ?v?3(?: 0)? only"),
    ("gpl-2.0-only", r"gpl ?v?2(?: 0)? only"),
    ("mit-or-apache-2", r"(?:dual )?licen[sc]ed under (?:either (?:of )?)?(?:the )?(?:mit (?:and|or) apache|apache 2 0 (?:and|or) mit)(?: \w+){0,4}? licen[sc]es?"),
    ("artistic-or-gpl", r"under the same terms as perl itself"),
    ("apache-2", r"(?:licen[sc]ed|released|distributed|available|published|provided) under the apache licen[sc]e(?: version| v)? ?2(?: 0)?"),
    ("apache-2", r"licensed to the apache software foundation asf under one or more contributor licen[sc]e agreements"),
    ("apache", r"(?:licen[sc]ed|released|distributed|available|published|provided) under the apache(?: software)? licen[sc]e"),
    ("mit-0", r"(?:licen[sc]ed|released|distributed|available) under the mit 0 licen[sc]e"),
    ("mit", r"(?:licen[sc]ed|released|distributed|available|published|provided|covered|governed) (?:under|by)(?: the)?(?: terms of)?(?: the)? mit(?: licen[sc]e)?"),
    ("mit", r"use of this source code is governed by an mit style licen[sc]e"),
    ("bsd-3-clause", r"(?:licen[sc]ed|released|distributed|available) under (?:the|a) (?:new|modified|revised|3 clause|three clause) bsd licen[sc]e"),
    ("bsd-2-clause", r"(?:licen[sc]ed|released|distributed|available) under (?:the|a) (?:simplified|freebsd|2 clause|two clause)(?: bsd)? licen[sc]e"),
    ("bsd", r"use of this source code is governed by a bsd style licen[sc]e"),
    ("bsd", r"(?:licen[sc]ed|released|distributed|available|published|provided) under (?:the|a) bsd(?: style)? licen[sc]e"),
    ("isc", r"(?:licen[sc]ed|released|distributed|available) under the isc licen[sc]e"),
    ("zlib", r"(?:licen[sc]ed|released|distributed|available) under the zlib(?: libpng)? licen[sc]e"),
    ("bsl-1.0", r"distributed under the boost software licen[sc]e version 1 0"),
    ("mpl-2.0", r"(?:licen[sc]ed|released|distributed|available) under the (?:terms of the )?(?:mozilla public licen[sc]e(?: version| v)?|mpl) ?2(?: 0)?"),
    ("epl-2.0", r"(?:licen[sc]ed|released|distributed|available) under the (?:terms of the )?eclipse public licen[sc]e(?: version| v)? ?2 0"),
    ("agpl-3.0", r"(?:licen[sc]ed|released|distributed|available) under the (?:terms of the )?(?:gnu )?(?:affero general public licen[sc]e|agpl)(?: version| v)? ?3"),
    ("lgpl-3.0", r"(?:licen[sc]ed|released|distributed|available) under the (?:terms of the )?(?:gnu )?(?:lesser general public licen[sc]e|lgpl)(?: version| v)? ?3"),
    ("lgpl-2.1", r"(?:licen[sc]ed|released|distributed|available) under the (?:terms of the )?(?:gnu )?(?:lesser general public licen[sc]e|lgpl)(?: version| v)? ?2 1"),
    ("gpl-3.0", r"(?:licen[sc]ed|released|distributed|available) under the (?:terms of the )?(?:gnu )?(?:general public licen[sc]e|gpl)(?: version| v)? ?3"),
    ("gpl-2.0", r"(?:licen[sc]ed|released|distributed|available) under the (?:terms of the )?(?:gnu )?(?:general public licen[sc]e|gpl)(?: version| v)? ?2"),
    ("gpl", r"(?:licen[sc]ed|released|distributed|available) under the (?:terms of the )?(?:gnu )?(?:general public licen[sc]e|gpl)"),
    ("wtfpl", r"(?:licen[sc]ed|released|distributed|available) under the wtfpl"),
    ("unlicense", r"(?:licen[sc]ed|released|distributed|available) under the unlicen[sc]e"),
    ("cc0-1.0", r"(?:licen[sc]ed|released|distributed|available|dedicated) (?:under|using|via) (?:the )?(?:creative commons )?cc0"),
    ("cc-by-sa", r"text is available under the creative commons attribution share ?alike licen[sc]e"),
    ("public-domain", r"(?:is|are|released|placed|dedicated|put) (?:in|into|to) the public domain"),
    ("proprietary", r"(?:proprietary and confidential|confidential and proprietary)"),
    ("proprietary", r"for internal use only not for (?:re)?distribution"),
    ("proprietary", r"do not (?:copy|distribute|reproduce)(?: or (?:copy|distribute|reproduce))? without (?:prior )?(?:written )?permission"),
    ("cc-by-nc-nd", r"creativecommons org licen[sc]es by nc nd"),
    ("cc-by-nc-sa", r"creativecommons org licen[sc]es by nc sa"),
    ("cc-by-nc", r"creativecommons org licen[sc]es by nc"),
    ("cc-by-nd", r"creativecommons org licen[sc]es by nd"),
    ("cc-by-sa", r"creativecommons org licen[sc]es by sa"),
    ("cc-by", r"creativecommons org licen[sc]es by"),
    ("cc0-1.0", r"creativecommons org publicdomain zero"),
    ("public-domain", r"creativecommons org publicdomain mark"),
    ("apache-2", r"apache org licen[sc]es licen[sc]e 2 0"),
    ("gpl", r"gnu org licen[sc]es (?:old licen[sc]es )?gpl"),
    ("lgpl", r"gnu org licen[sc]es (?:old licen[sc]es )?lgpl"),
    ("agpl", r"gnu org licen[sc]es agpl"),
    ("mit", r"opensource org licen[sc]es? mit"),
    ("bsd", r"opensource org licen[sc]es? bsd"),
    ("mpl-2.0", r"mozilla org mpl 2 0"),
    ("epl", r"eclipse org legal epl"),
    ("unlicense", r"unlicense org"),
    ("ofl-1.1", r"scripts sil org ofl"),
)

# The licenses' names; a more specific name stands before a less specific one.
NAMES = (
    ("cc-by-nc-nd-4.0", r"cc by nc nd 4 0|creative commons attribution non ?commercial no ?deriv\w* 4 0"),
    ("cc-by-nc-nd-3.0", r"cc by nc nd 3 0|creative commons attribution non ?commercial no ?deriv\w* 3 0"),
    ("cc-by-nc-sa-4.0", r"cc by nc sa 4 0|creative commons attribution non ?commercial share ?alike 4 0"),
    ("cc-by-nc-sa-3.0", r"cc by nc sa 3 0|creative commons attribution non ?commercial share ?alike 3 0"),
    ("cc-by-nc-4.0", r"cc by nc 4 0|creative commons attribution non ?commercial 4 0"),
    ("cc-by-nc-3.0", r"cc by nc 3 0|creative commons attribution non ?commercial 3 0"),
    ("cc-by-nd-4.0", r"cc by nd 4 0|creative commons attribution no ?deriv\w* 4 0"),
    ("cc-by-sa-4.0", r"cc by sa 4 0|creative commons attribution share ?alike 4 0"),
    ("cc-by-sa-3.0", r"cc by sa 3 0|creative commons attribution share ?alike 3 0"),
    ("cc-by-sa-2.5", r"cc by sa 2 5|creative commons attribution share ?alike 2 5"),
    ("cc-by-4.0", r"cc by 4 0|creative commons attribution 4 0"),
    ("cc-by-3.0", r"cc by 3 0|creative commons attribution 3 0"),
    ("cc-by-2.0", r"cc by 2 0|creative commons attribution 2 0"),
    ("cc-by-nc-nd", r"cc by nc nd|creative commons attribution non ?commercial no ?deriv\w*"),
    ("cc-by-nc-sa", r"cc by nc sa|creative commons attribution non ?commercial share ?alike"),
    ("cc-by-nc", r"cc by nc|creative commons attribution non ?commercial"),
    ("cc-by-nd", r"cc by nd|creative commons attribution no ?deriv\w*"),
    ("cc-by-sa", r"cc by sa|creative commons attribution share ?alike"),
    ("cc-by", r"cc by (?:licen[sc]e|international)|creative commons attribution(?: licen[sc]e)?"),
    ("cc0-1.0", r"cc0 1 0|cc0|creative commons zero|cc zero"),
    ("agpl-3.0", r"(?:gnu )?affero general public licen[sc]e(?: version| v)? ?3(?: 0)?|agpl ?v?3(?: 0)?"),
    ("agpl", r"(?:gnu )?affero general public licen[sc]e|agpl"),
    ("lgpl-3.0", r"(?:gnu )?lesser general public licen[sc]e(?: version| v)? ?3(?: 0)?|lgpl ?v?3(?: 0)?"),
    ("lgpl-2.1", r"(?:gnu )?lesser general public licen[sc]e(?: version| v)? ?2 1|lgpl ?v?2 1"),
    ("lgpl-2.0", r"(?:gnu )?library general public licen[sc]e(?: version| v)? ?2|lgpl ?v?2 0"),
    ("lgpl", r"(?:gnu )?(?:lesser|library) general public licen[sc]e|lgpl"),
    ("gpl-2.0-with-classpath", r"gpl ?v?2(?: 0)? with (?:the )?classpath exception"),
    ("gpl-3.0", r"(?:gnu )?general public licen[sc]e(?: version| v)? ?3(?: 0)?|gpl ?v?3(?: 0)?"),
    ("gpl-2.0", r"(?:gnu )?general public licen[sc]e(?: version| v)? ?2(?: 0)?|gpl ?v?2(?: 0)?"),
    ("gpl-1.0", r"(?:gnu )?general public licen[sc]e(?: version| v)? ?1(?: 0)?|gpl ?v?1(?: 0)?"),
    ("gpl", r"gnu general public licen[sc]e|gnu gpl"),
    ("gfdl-1.3", r"(?:gnu )?free documentation licen[sc]e(?: version| v)? ?1 3"),
    ("gfdl", r"(?:gnu )?free documentation licen[sc]e|gfdl"),
    ("apache-2", r"apache(?: software)? licen[sc]e(?: version| v)? ?2(?: 0)?|apache ?v?2 0"),
    ("apache-1.1", r"apache(?: software)? licen[sc]e(?: version| v)? ?1 1"),
    ("apache-1.0", r"apache(?: software)? licen[sc]e(?: version| v)? ?1 0"),
    ("apache", r"apache(?: software)? licen[sc]e"),
    ("mpl-2.0", r"mozilla public licen[sc]e(?: version| v)? ?2(?: 0)?|mpl ?v?2 0"),
    ("mpl-1.1", r"mozilla public licen[sc]e(?: version| v)? ?1 1|mpl ?v?1 1"),
    ("mpl-1.0", r"mozilla public licen[sc]e(?: version| v)? ?1 0"),
    ("mpl", r"mozilla public licen[sc]e"),
    ("npl-1.1", r"netscape public licen[sc]e"),
    ("epl-2.0", r"eclipse public licen[sc]e(?: version| v)? ?2(?: 0)?"),
    ("epl-1.0", r"eclipse public licen[sc]e(?: version| v)? ?1(?: 0)?"),
    ("epl", r"eclipse public licen[sc]e"),
    ("edl-1.0", r"eclipse distribution licen[sc]e(?: version| v)?(?: ?1 0)?"),
    ("eupl-1.2", r"european union public licen[sc]e(?: version| v)? ?1 2|eupl 1 2"),
    ("eupl-1.1", r"european union public licen[sc]e(?: version| v)? ?1 1|eupl 1 1"),
    ("eupl", r"european union public licen[sc]e"),
    ("cddl-1.1", r"common development and distribution licen[sc]e(?: version| v)? ?1 1|cddl 1 1"),
    ("cddl-1.0", r"common development and distribution licen[sc]e|cddl(?: 1 0)?"),
    ("cpal-1.0", r"common public attribution licen[sc]e"),
    ("cpl-1.0", r"common public licen[sc]e"),
    ("ipl-1.0", r"ibm public licen[sc]e"),
    ("osl-3.0", r"open software licen[sc]e(?: version| v)?(?: ?3 0)?"),
    ("afl-3.0", r"academic free licen[sc]e(?: version| v)?(?: ?3 0)?"),
    ("ecl-2.0", r"educational community licen[sc]e"),
    ("artistic-2.0", r"artistic licen[sc]e(?: version| v)? ?2(?: 0)?"),
    ("artistic-1.0", r"(?:perl )?artistic licen[sc]e"),
    ("bsd-4-clause", r"(?:4|four) clause bsd|bsd 4 clause|original bsd licen[sc]e|old style bsd"),
    ("bsd-3-clause-clear", r"bsd 3 clause clear|clear bsd licen[sc]e"),
    ("bsd-3-clause", r"(?:3|three) clause bsd|bsd 3 clause|(?:new|modified|revised) bsd licen[sc]e"),
    ("bsd-2-clause-patent", r"bsd 2 clause (?:plus )?patent|bsd plus patent"),
    ("bsd-2-clause", r"(?:2|two) clause bsd|bsd 2 clause|simplified bsd licen[sc]e|freebsd licen[sc]e"),
    ("bsd-1-clause", r"(?:1|one) clause bsd|bsd 1 clause"),
    ("0bsd", r"zero clause bsd|bsd zero clause|0bsd"),
    ("bsd", r"bsd(?: style)? licen[sc]e"),
    ("mit-0", r"mit no attribution|mit 0 licen[sc]e"),
    ("mit", r"(?:the )?mit(?: x11| expat)? licen[sc]e|expat licen[sc]e|under (?:the )?mit|licen[sc]e mit"),
    ("x11", r"x11 licen[sc]e|x consortium licen[sc]e"),
    ("isc", r"isc licen[sc]e"),
    ("zlib", r"zlib(?: libpng)? licen[sc]e"),
    ("libpng", r"libpng licen[sc]e"),
    ("bsl-1.0", r"boost(?: software)? licen[sc]e"),
    ("busl-1.1", r"business source licen[sc]e|busl 1 1"),
    ("elastic-2.0", r"elastic licen[sc]e(?: version| v)?(?: ?2 0)?"),
    ("sspl-1.0", r"server side public licen[sc]e|sspl"),
    ("polyform-noncommercial", r"polyform non ?commercial licen[sc]e"),
    ("polyform-shield", r"polyform shield licen[sc]e"),
    ("commons-clause", r"commons clause(?: licen[sc]e)? condition|with commons clause"),
    ("parity-7.0", r"parity public licen[sc]e"),
    ("prosperity-3.0", r"prosperity public licen[sc]e"),
    ("unlicense", r"(?:the )?unlicen[sc]e"),
    ("wtfpl", r"do what the \w+ you want to public licen[sc]e|wtfpl"),
    ("beerware", r"beerware(?: licen[sc]e)?|beer ware licen[sc]e"),
    ("python-2.0", r"python(?: software foundation)? licen[sc]e|psf licen[sc]e"),
    ("php-3.01", r"php licen[sc]e"),
    ("ruby", r"ruby s? ?licen[sc]e"),
    ("perl", r"perl 5 licen[sc]e"),
    ("tcl", r"tcl(?: tk)? licen[sc]e"),
    ("postgresql", r"postgresql licen[sc]e"),
    ("openssl", r"openssl(?: ssleay)? licen[sc]e"),
    ("ncsa", r"(?:university of illinois )?ncsa(?: open source)? licen[sc]e"),
    ("ofl-1.1", r"(?:sil )?open font licen[sc]e|sil ofl"),
    ("ufl-1.0", r"ubuntu font licen[sc]e"),
    ("bitstream-vera", r"bitstream vera(?: fonts?)? (?:copyright|licen[sc]e)"),
    ("upl-1.0", r"universal permissive licen[sc]e"),
    ("ms-pl", r"microsoft public licen[sc]e|ms pl"),
    ("ms-rl", r"microsoft reciprocal licen[sc]e|ms rl"),
    ("cecill-b", r"cecill b(?: licen[sc]e)?"),
    ("cecill-c", r"cecill c(?: licen[sc]e)?"),
    ("cecill-2.1", r"cecill(?: free software)?(?: licen[sc]e)?"),
    ("odbl-1.0", r"open database licen[sc]e|odbl"),
    ("odc-by-1.0", r"open data commons attribution(?: licen[sc]e)?|odc by"),
    ("pddl-1.0", r"public domain dedication and licen[sc]e|pddl"),
    ("cdla-permissive", r"community data licen[sc]e agreement permissive|cdla permissive"),
    ("cdla-sharing", r"community data licen[sc]e agreement sharing|cdla sharing"),
    ("ogl-uk-3.0", r"open government licen[sc]e"),
    ("etalab-2.0", r"licence ouverte|etalab open licen[sc]e"),
    ("dl-de-by-2.0", r"datenlizenz deutschland"),
    ("openrail", r"(?:creative ml |bigscience )?openrail(?: m)?(?: licen[sc]e)?"),
    ("llama", r"llama \d(?: \d)? community licen[sc]e"),
    ("gemma", r"gemma terms of use"),
    ("vim", r"vim licen[sc]e"),
    ("curl", r"curl licen[sc]e"),
    ("intel", r"intel open source licen[sc]e"),
    ("nasa-1.3", r"nasa open source agreement"),
    ("w3c", r"w3c (?:software (?:and document )?notice and )?licen[sc]e"),
    ("unicode", r"unicode (?:data files and software )?licen[sc]e|unicode terms of use"),
    ("icu", r"icu licen[sc]e"),
    ("ijg", r"independent jpeg group s licen[sc]e|ijg licen[sc]e"),
    ("freetype", r"freetype (?:project )?licen[sc]e"),
    ("imagemagick", r"imagemagick licen[sc]e"),
    ("sleepycat", r"sleepycat licen[sc]e"),
    ("rpsl", r"realnetworks public source licen[sc]e"),
    ("apsl-2.0", r"apple public source licen[sc]e"),
    ("qpl-1.0", r"q public licen[sc]e"),
    ("zpl-2.1", r"zope public licen[sc]e"),
    ("sunpl", r"sun public licen[sc]e"),
    ("lppl-1.3c", r"latex project public licen[sc]e|lppl"),
    ("json", r"json licen[sc]e"),
    ("hpnd", r"historical permission notice and disclaimer"),
    ("blueoak-1.0.0", r"blue oak model licen[sc]e"),
    ("mulanpsl-2.0", r"mulan p(?:ermissive software licen[sc]e|sl)"),
    ("fair", r"fair licen[sc]e"),
    ("hippocratic-2.1", r"hippocratic licen[sc]e"),
    ("public-domain", r"(?:in|into|to) the public domain|public domain (?:software|work|text)"),
    ("all-rights-reserved", r"all rights reserved"),
    ("unspecified", r"licen[sc]ed under(?: the)?(?: \S+){0,3}? licen[sc]e|see (?:the )?(?:file )?licen[sc]e"),
)

#: (rules, confidence) by kind, the first kind before the second, and so on.
KINDS = ((TAGS, 1.0), (BODIES, 0.95), (NOTICES, 0.9), (NAMES, 0.7))
#: Labels that name no license by themselves.
WEAK = {"unspecified": 0.3, "all-rights-reserved": 0.5}
