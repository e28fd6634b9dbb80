"""Signature rules for licence texts, over texts reduced to lower-case words with single spaces.

Every licence is a hand-written pattern of its names; three forms of it (tag, notice, bare name) make its rules. Texts that
licences contain have rules of their own. A rule is (label, priority, keyword, pattern, confidence): the pattern is tried only
where the text has the keyword. A lower priority number wins where two rules match the same words.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass

# Every pattern matches text that has one of these, so a text without them needs no rule at all.
ANCHORS = ("licen", "copyleft", "spdx", "public domain", "creative commons", "gpl", "rights reserved", "warranty", "copyright", "redistribution", "mozilla org")


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    keyword: str
    pattern: str
    confidence: float


_L = "licen[cs]e"
_GNU = "(?:gnu )?"
_V = "(?: version| v)?"
_LATER = "(?: or (?:\\(at your option\\) )?(?:any )?later(?: version)?)?"

# Label, keyword, names. The names end in the word licence or hold another anchor.
LICENSES = [
    ("mit", "mit", rf"mit(?: x11)? {_L}"),
    ("mit-0", "mit", rf"mit (?:no attribution|0) {_L}"),
    ("x11", "x11", rf"x11 {_L}"),
    ("expat", "expat", rf"expat {_L}"),
    ("isc", "isc", rf"isc {_L}"),
    ("isc", "consortium", rf"internet (?:systems|software) consortium {_L}"),
    ("apache-1.0", "apache", rf"apache(?: software)? {_L}{_V} 1 0"),
    ("apache-1.1", "apache", rf"apache(?: software)? {_L}{_V} 1 1"),
    ("apache-2.0", "apache", rf"apache(?: software)? {_L}{_V} ?2(?: 0)?|apache 2(?: 0)? {_L}"),
    ("apache", "apache", rf"apache(?: software)?(?: foundation)? {_L}"),
    ("bsd-0-clause", "bsd", rf"(?:zero clause|0 clause|free public) bsd {_L}|bsd (?:zero|0) clause {_L}"),
    ("bsd-1-clause", "bsd", rf"(?:1|one) clause bsd {_L}|bsd (?:1|one) clause {_L}"),
    ("bsd-2-clause", "bsd", rf"(?:simplified|freebsd|(?:2|two) clause) bsd {_L}|bsd (?:2|two) clause(?: simplified)? {_L}"),
    ("bsd-3-clause", "bsd", rf"(?:new|revised|modified|(?:3|three) clause) bsd {_L}|bsd (?:3|three) clause(?: new| revised)? {_L}"),
    ("bsd-4-clause", "bsd", rf"(?:original|old|(?:4|four) clause) bsd {_L}|bsd (?:4|four) clause {_L}"),
    ("bsd", "bsd", rf"bsd(?: style| type)? {_L}"),
    ("gpl-1.0", "gpl", rf"gplv1|gpl{_V} 1(?: 0)?"),
    ("gpl-2.0", "gpl", rf"gplv2|gpl{_V} 2(?: 0)?{_LATER}"),
    ("gpl-3.0", "gpl", rf"gplv3|gpl{_V} 3(?: 0)?{_LATER}"),
    ("gpl-1.0", "general public", rf"{_GNU}general public {_L}{_V} 1(?: 0)?"),
    ("gpl-2.0", "general public", rf"{_GNU}general public {_L}{_V} 2(?: 0)?{_LATER}"),
    ("gpl-3.0", "general public", rf"{_GNU}general public {_L}{_V} 3(?: 0)?{_LATER}"),
    ("gpl", "general public", rf"{_GNU}general public {_L}"),
    ("gpl", "gpl", "gnu gpl"),
    ("lgpl-2.0", "general public", rf"{_GNU}library general public {_L}(?:{_V} 2(?: 0)?{_LATER})?"),
    ("lgpl-2.1", "general public", rf"{_GNU}lesser general public {_L}{_V} 2 1{_LATER}"),
    ("lgpl-3.0", "general public", rf"{_GNU}lesser general public {_L}{_V} 3(?: 0)?{_LATER}"),
    ("lgpl", "general public", rf"{_GNU}lesser general public {_L}"),
    ("lgpl-2.1", "lgpl", rf"lgplv2 1|lgpl{_V} 2 1{_LATER}"),
    ("lgpl-3.0", "lgpl", rf"lgplv3|lgpl{_V} 3(?: 0)?{_LATER}"),
    ("lgpl", "lgpl", "gnu lgpl"),
    ("agpl-1.0", "affero", rf"affero general public {_L}{_V} 1(?: 0)?"),
    ("agpl-3.0", "affero", rf"{_GNU}affero general public {_L}{_V} 3(?: 0)?{_LATER}"),
    ("agpl", "affero", rf"{_GNU}affero general public {_L}"),
    ("agpl-3.0", "agpl", rf"agplv3|agpl{_V} 3(?: 0)?{_LATER}"),
    ("gfdl-1.1", "free documentation", rf"{_GNU}free documentation {_L}{_V} 1 1"),
    ("gfdl-1.2", "free documentation", rf"{_GNU}free documentation {_L}{_V} 1 2"),
    ("gfdl-1.3", "free documentation", rf"{_GNU}free documentation {_L}{_V} 1 3"),
    ("gfdl", "free documentation", rf"{_GNU}free documentation {_L}"),
    ("mpl-1.0", "mozilla", rf"mozilla public {_L}{_V} 1 0"),
    ("mpl-1.1", "mozilla", rf"mozilla public {_L}{_V} 1 1"),
    ("mpl-2.0", "mozilla", rf"mozilla public {_L}{_V} 2(?: 0)?"),
    ("mpl", "mozilla", rf"mozilla public {_L}"),
    ("npl", "netscape", rf"netscape public {_L}"),
    ("epl-1.0", "eclipse", rf"eclipse public {_L}{_V} 1(?: 0)?"),
    ("epl-2.0", "eclipse", rf"eclipse public {_L}{_V} 2(?: 0)?"),
    ("epl", "eclipse", rf"eclipse public {_L}"),
    ("edl-1.0", "eclipse", rf"eclipse distribution {_L}"),
    ("cpl-1.0", "common public", rf"common public {_L}"),
    ("ipl-1.0", "ibm", rf"ibm public {_L}"),
    ("cddl-1.0", "common development", rf"common development and distribution {_L}{_V} 1 0"),
    ("cddl-1.1", "common development", rf"common development and distribution {_L}{_V} 1 1"),
    ("cddl", "common development", rf"common development and distribution {_L}"),
    ("artistic-1.0", "artistic", rf"artistic {_L}{_V} 1(?: 0)?"),
    ("artistic-2.0", "artistic", rf"artistic {_L}{_V} 2(?: 0)?"),
    ("artistic", "artistic", rf"artistic {_L}"),
    ("boost-1.0", "boost", rf"boost software {_L}(?:{_V} 1 0)?"),
    ("zlib", "zlib", rf"zlib(?: libpng)? {_L}"),
    ("libpng", "libpng", rf"libpng {_L}"),
    ("python-2.0", "python", rf"python(?: software foundation)? {_L}(?:{_V} 2(?: 0)?)?"),
    ("psf", "psf", rf"psf {_L}"),
    ("ruby", "ruby", rf"ruby {_L}"),
    ("php-3.01", "php", rf"php {_L}(?:{_V} 3 0?1)?"),
    ("perl", "perl", rf"same terms as perl itself under .{{0,40}}{_L}|perl 5 {_L}"),
    ("tcl", "tcl", rf"tcl tk {_L}"),
    ("openssl", "openssl", rf"openssl {_L}"),
    ("openldap", "openldap", rf"openldap public {_L}"),
    ("postgresql", "postgresql", rf"postgresql {_L}"),
    ("unicode", "unicode", rf"unicode(?: inc)? {_L}(?: agreement)?"),
    ("ncsa", "ncsa", rf"(?:university of illinois )?(?:ncsa )?open source {_L} ncsa|ncsa(?: open source)? {_L}"),
    ("w3c", "w3c", rf"w3c(?: software)?(?: notice)?(?: and)? {_L}"),
    ("unlicense", "unlicense", "(?:the )?unlicense"),
    ("wtfpl", "what the", rf"do what the .{{2,6}} you want to public {_L}"),
    ("beerware", "beer", rf"beer ?ware {_L}"),
    ("eupl-1.1", "european union", rf"european union public {_L}{_V} 1 1"),
    ("eupl-1.2", "european union", rf"european union public {_L}{_V} 1 2"),
    ("eupl", "european union", rf"european union public {_L}"),
    ("osl-3.0", "open software", rf"open software {_L}(?:{_V} 3(?: 0)?)?"),
    ("afl-3.0", "academic free", rf"academic free {_L}(?:{_V} 3(?: 0)?)?"),
    ("ms-pl", "microsoft", rf"microsoft public {_L}"),
    ("ms-rl", "microsoft", rf"microsoft reciprocal {_L}"),
    ("apsl-2.0", "apple", rf"apple public source {_L}(?:{_V} 2(?: 0)?)?"),
    ("qpl-1.0", "q public", rf"q public {_L}"),
    ("lppl-1.3", "latex", rf"latex project public {_L}(?:{_V} 1 3c?)?"),
    ("ofl-1.1", "font", rf"(?:sil )?open font {_L}(?:{_V} 1 1)?"),
    ("sleepycat", "sleepycat", rf"sleepycat {_L}"),
    ("vim", "vim", rf"vim {_L}"),
    ("json", "json", rf"json {_L}"),
    ("bsl-1.1", "business source", rf"business source {_L}(?:{_V} 1 1)?"),
    ("sspl-1.0", "server side", rf"server side public {_L}(?:{_V} 1)?"),
    ("elastic-2.0", "elastic", rf"elastic {_L}(?:{_V} 2(?: 0)?)?"),
    ("cecill", "cecill", rf"cecill(?: [bc])? {_L}|cecill free software {_L}"),
    ("odbl-1.0", "open data", rf"open data commons open database {_L}|open database {_L}"),
    ("odc-by-1.0", "open data", rf"open data commons attribution {_L}"),
    ("pddl-1.0", "public domain", rf"public domain dedication and {_L}"),
    ("cdla-permissive", "community data", rf"community data {_L} agreement permissive"),
    ("cdla-sharing", "community data", rf"community data {_L} agreement sharing"),
    ("mulan-psl-2", "mulan", rf"mulan permissive software {_L}(?: v2| version 2)?"),
    ("upl-1.0", "universal permissive", rf"universal permissive {_L}"),
    ("cc0-1.0", "creative commons", "creative commons (?:cc0|zero)(?: 1 0)?(?: universal)?"),
    ("cc-by-nc-nd", "creative commons", "creative commons attribution non ?commercial no ?deriv(?:s|ative|atives|ative works)?(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "creative commons", "creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?"),
    ("cc-by-nc", "creative commons", "creative commons attribution non ?commercial(?: [1-4] [05])?"),
    ("cc-by-nd", "creative commons", "creative commons attribution no ?deriv(?:s|ative|atives|ative works)?(?: [1-4] [05])?"),
    ("cc-by-sa", "creative commons", "creative commons attribution share ?alike(?: [1-4] [05])?"),
    ("cc-by", "creative commons", "creative commons attribution(?: [1-4] [05])?"),
    ("creative-commons", "creative commons", f"creative commons {_L}"),
    ("proprietary", "proprietary", rf"proprietary(?: software)? {_L}|{_L} is proprietary"),
    ("commercial", "commercial", rf"commercial {_L}"),
    ("dual", "dual", rf"dual {_L}d?"),
]

# Label, keyword, pattern, confidence: addresses, and sentences that licence texts and notices have.
SENTENCES = [
    ("apache-2.0", "apache org", r"apache org licenses license 2 0(?: txt| html)?", 0.95),
    ("apache-1.1", "apache org", r"apache org licenses license 1 1", 0.95),
    ("mit", "opensource org", r"opensource org licenses mit(?: license)?(?: php| html)?", 0.95),
    ("bsd-2-clause", "opensource org", r"opensource org licenses bsd 2 clause", 0.95),
    ("bsd-3-clause", "opensource org", r"opensource org licenses bsd 3 clause", 0.95),
    ("isc", "opensource org", r"opensource org licenses isc", 0.95),
    ("gpl-2.0", "gnu org", r"gnu org licenses (?:old licenses )?gpl 2 0", 0.95),
    ("gpl-3.0", "gnu org", r"gnu org licenses gpl 3 0", 0.95),
    ("gpl", "gnu org", r"gnu org licenses gpl", 0.85),
    ("lgpl-2.1", "gnu org", r"gnu org licenses (?:old licenses )?lgpl 2 1", 0.95),
    ("lgpl-3.0", "gnu org", r"gnu org licenses lgpl 3 0", 0.95),
    ("agpl-3.0", "gnu org", r"gnu org licenses agpl 3 0", 0.95),
    ("gnu-address", "gnu org", r"gnu org licenses", 0.6),
    ("mpl-2.0", "mozilla org", r"mozilla org mpl 2 0|mozilla org en us mpl 2 0", 0.95),
    ("cc-by", "creativecommons org", r"creativecommons org licenses by [1-4] [05]", 0.95),
    ("cc-by-sa", "creativecommons org", r"creativecommons org licenses by sa [1-4] [05]", 0.95),
    ("cc-by-nc", "creativecommons org", r"creativecommons org licenses by nc [1-4] [05]", 0.95),
    ("cc-by-nd", "creativecommons org", r"creativecommons org licenses by nd [1-4] [05]", 0.95),
    ("cc-by-nc-sa", "creativecommons org", r"creativecommons org licenses by nc sa [1-4] [05]", 0.95),
    ("cc-by-nc-nd", "creativecommons org", r"creativecommons org licenses by nc nd [1-4] [05]", 0.95),
    ("mit", "permission is hereby", r"permission is hereby granted free of charge to any person obtaining a copy .{0,200}?without restriction.{0,1000}?license", 0.98),
    ("mit", "permission is hereby", r"permission is hereby granted free of charge to any person obtaining a copy of this software(?=.{0,2000}copyright)", 0.9),
    ("isc", "permission to use", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted provided that the above copyright", 0.98),
    ("bsd", "redistribution and use", r"redistribution and use in source and binary forms with or without modification are permitted provided", 0.9),
    ("bsd-3-clause", "neither the name", r"redistribution and use in source and binary forms .{0,1200}?neither the name", 0.97),
    ("bsd-4-clause", "advertising materials", r"redistribution and use in source and binary forms .{0,1200}?all advertising materials mentioning", 0.97),
    ("apache-2.0", "licensed under the apache", r"licensed under the apache license version 2 0 the license you may not use this file except in compliance", 0.99),
    ("gpl", "free software you can", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", 0.97),
    ("lgpl", "free software you can", r"this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license", 0.97),
    ("gpl", "without even the implied", r"without even the implied warranty of merchantability", 0.5),
    ("mpl-2.0", "source code form", r"this source code form is subject to the terms of the mozilla public license v 2 0", 0.99),
    ("unlicense", "released into the public", r"free and unencumbered software released into the public domain", 0.97),
    ("zlib", "provided as is without any express", r"provided as is without any express or implied warranty in no event will the authors be held liable", 0.9),
    ("boost-1.0", "boost", r"distributed under the boost software license version 1 0", 0.99),
    ("public-domain", "public domain", r"(?:placed|released|dedicated|is) (?:in|into|to) the public domain", 0.8),
    ("public-domain", "public domain", r"public domain", 0.4),
    ("all-rights-reserved", "rights reserved", r"all rights reserved", 0.5),
    ("proprietary", "confidential", r"confidential and proprietary.{0,100}rights reserved", 0.8),
    ("proprietary", "without prior written", r"may not be (?:reproduced|copied|distributed).{0,100}without prior written permission.{0,100}copyright", 0.8),
    ("copyright", "copyright", r"copyright(?: c)? (?:19|20)[0-9][0-9](?: (?:19|20)?[0-9][0-9])?", 0.3),
    ("copyleft", "copyleft", r"copyleft", 0.3),
    ("no-warranty", "warranty", r"(?:comes with )?absolutely no warranty", 0.3),
    ("as-is", "as is", r"provided as is without warranty of any kind", 0.4),
    ("free-documentation", "permission is granted", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", 0.97),
    ("unknown-license", "licensed under", r"licensed under (?:the )?(?:\S+ ){1,4}?licen[cs]e", 0.4),
    ("unknown-spdx", "spdx", r"spdx license identifier \S+(?: \S+)?", 0.5),
]


def rules() -> list[Rule]:
    """All rules in order. Tags come before notices, notices before sentences, sentences before bare names; and what is
    unknown or general comes last."""
    out = []
    for label, keyword, names in LICENSES:
        out.append(Rule(label, 1, keyword, rf"(?<!\S)spdx license identifier (?:the )?(?:{names})(?!\S)", 1.0))
        out.append(Rule(
            label, 2, keyword,
            rf"(?<!\S)(?:(?:dual |re)?licensed|released|distributed|available|published|provided|covered)(?: \S+){{0,3}}? (?:under|by)(?: the)?(?: terms of(?: the)?)? (?:{names})(?!\S)", 0.95,
        ))
        out.append(Rule(label, 4, keyword, rf"(?<!\S)(?:{names})(?!\S)", 0.8))
    for label, keyword, pattern, confidence in SENTENCES:
        out.append(Rule(label, 3 if confidence >= 0.5 else 5, keyword, rf"(?<!\S)(?:{pattern})(?!\S)", confidence))
    return out


def as_rows() -> list[dict]:
    return [{"rule": k, **asdict(rule)} for k, rule in enumerate(rules())]
