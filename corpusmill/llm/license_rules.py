"""The signature rules of ``licenses.py``: ordered, hand-written, one a line.

A rule is ``label ; tier ; keyword ; pattern``.  Patterns are over lower-case
words of ASCII letters, digits and non-ASCII characters; one space stands between words, and a group that
holds a word holds its space too, as in ``license( version)? 2`` and ``(gnu )?affero``.  ``W`` is any
word.  The keyword is a word that every match holds; a rule runs only on texts with it.

Tiers, strongest first: 1 names a license by tag or address, 2 by title and
version or by its own sentences, 3 by title, 4 is a hint.  Earlier lines win ties.
"""

from __future__ import annotations

# SPDX-style identifiers; each makes a tag rule and a "license: ID" field rule.
IDENTIFIERS = """
0bsd aal afl-1.1 afl-1.2 afl-2.0 afl-2.1 afl-3.0 agpl-1.0 agpl-3.0 agpl-3.0-only agpl-3.0-or-later apache-1.0
apache-1.1 apache-2.0 apsl-1.0 apsl-2.0 artistic-1.0 artistic-2.0 beerware blueoak-1.0.0 bsd-1-clause bsd-2-clause
bsd-3-clause bsd-4-clause bsl-1.0 bsl-1.1 cc0-1.0 cc-by-1.0 cc-by-2.0 cc-by-2.5 cc-by-3.0 cc-by-4.0 cc-by-nc-3.0
cc-by-nc-4.0 cc-by-nc-nd-3.0 cc-by-nc-nd-4.0 cc-by-nc-sa-3.0 cc-by-nc-sa-4.0 cc-by-nd-3.0 cc-by-nd-4.0 cc-by-sa-2.0
cc-by-sa-2.5 cc-by-sa-3.0 cc-by-sa-4.0 cddl-1.0 cddl-1.1 cecill-2.0 cecill-2.1 cecill-b cecill-c cpal-1.0 cpl-1.0
ecl-2.0 efl-2.0 epl-1.0 epl-2.0 eupl-1.1 eupl-1.2 ftl gfdl-1.2 gfdl-1.3 gpl-1.0 gpl-2.0 gpl-2.0-only
gpl-2.0-or-later gpl-3.0 gpl-3.0-only gpl-3.0-or-later hpnd icu ijg ipl-1.0 isc lgpl-2.0 lgpl-2.1 lgpl-2.1-only
lgpl-2.1-or-later lgpl-3.0 lgpl-3.0-only lgpl-3.0-or-later libpng lppl-1.3c mit mit-0 mpl-1.0 mpl-1.1 mpl-2.0 ms-pl
ms-rl mulanpsl-2.0 ncsa odbl-1.0 odc-by-1.0 ofl-1.0 ofl-1.1 openssl osl-2.1 osl-3.0 pddl-1.0 php-3.01
postgresql psf-2.0 python-2.0 qpl-1.0 ruby sgi-b-2.0 sissl sleepycat unicode-dfs-2016 unlicense upl-1.0 vim w3c wtfpl x11
xnet zlib zpl-2.0 zpl-2.1
""".split()

RULES_TEXT = r"""
agpl-3.0-or-later ; 2 ; affero ; gnu affero general public license( as published by the free software foundation)? (either )?version 3( of the license)? or( at your option)? any later version
agpl-3.0 ; 2 ; affero ; gnu affero general public license( as published by W W W W)?( version| v)? 3( 0)?
agpl-3.0 ; 1 ; agpl ; gnu org licenses agpl 3 0
agpl-3.0 ; 2 ; agpl ; agpl( v| version)? 3( 0)?
agpl-3.0 ; 2 ; agplv3 ; agplv3
agpl ; 3 ; affero ; (gnu )?affero( general)? public licen[cs]e
agpl ; 4 ; agpl ; agpl
lgpl-2.1-or-later ; 2 ; lesser ; gnu lesser general public license( as published by the free software foundation)?( either)? version 2 1( of the license)? or( at your option)? any later version
lgpl-2.1 ; 2 ; lesser ; gnu lesser general public license( version| v)? 2 1
lgpl-3.0 ; 2 ; lesser ; gnu lesser general public license( version| v)? 3( 0)?
lgpl-2.0 ; 2 ; library ; gnu library general public license( version| v)? 2( 0)?
lgpl-2.1 ; 1 ; lgpl ; gnu org licenses( old licenses)? lgpl 2 1
lgpl-3.0 ; 1 ; lgpl ; gnu org licenses lgpl 3 0
lgpl-2.1 ; 2 ; lgpl ; lgpl( v| version)? 2 1
lgpl-3.0 ; 2 ; lgpl ; lgpl( v| version)? 3( 0)?
lgpl-2.1 ; 2 ; lgplv2 ; lgplv2 1
lgpl-3.0 ; 2 ; lgplv3 ; lgplv3
lgpl ; 3 ; lesser ; (gnu )?lesser general public licen[cs]e
lgpl ; 3 ; library ; gnu library general public licen[cs]e
lgpl ; 4 ; lgpl ; lgpl
gpl-2.0-or-later ; 2 ; gnu ; gnu general public license as published by the free software foundation either version 2( of the license)? or( at your option)? any later version
gpl-3.0-or-later ; 2 ; gnu ; gnu general public license as published by the free software foundation either version 3( of the license)? or( at your option)? any later version
gpl-2.0-only ; 2 ; gnu ; gnu general public license version 2 only
gpl-3.0-only ; 2 ; gnu ; gnu general public license version 3 only
gpl-1.0 ; 2 ; gnu ; gnu general public license( version| v)? 1( 0)?
gpl-2.0 ; 2 ; gnu ; gnu general public license( version| v)? 2( 0)?
gpl-3.0 ; 2 ; gnu ; gnu general public license( version| v)? 3( 0)?
gpl-2.0 ; 1 ; gpl ; gnu org licenses( old licenses)? gpl 2 0
gpl-3.0 ; 1 ; gpl ; gnu org licenses gpl 3 0
gpl ; 1 ; gpl ; gnu org (copyleft|licenses) gpl
gpl-2.0 ; 2 ; gpl ; gpl( v| version)? 2( 0)?
gpl-3.0 ; 2 ; gpl ; gpl( v| version)? 3( 0)?
gpl-2.0-or-later ; 2 ; gplv2 ; gplv2 or later
gpl-3.0-or-later ; 2 ; gplv3 ; gplv3 or later
gpl-2.0 ; 2 ; gplv2 ; gplv2
gpl-3.0 ; 2 ; gplv3 ; gplv3
gpl-2.0 ; 2 ; gpl2 ; gpl2
gpl-3.0 ; 2 ; gpl3 ; gpl3
gpl ; 3 ; gnu ; gnu general public licen[cs]e
gpl ; 3 ; gnu ; gnu gpl
gpl ; 3 ; gpl ; (under|of) the( terms of the)? gpl
gpl ; 4 ; gpl ; gpl
gpl-classpath ; 2 ; classpath ; (with|gpl) classpath exception
gcc-exception ; 2 ; gcc ; gcc runtime library exception
gfdl-1.3 ; 2 ; documentation ; gnu free documentation license( version| v)? 1 3
gfdl-1.2 ; 2 ; documentation ; gnu free documentation license( version| v)? 1 2
gfdl ; 3 ; documentation ; (gnu )?free documentation licen[cs]e
gfdl ; 4 ; gfdl ; gfdl
apache-2.0 ; 1 ; apache ; apache org licenses license 2 0
apache-2.0 ; 2 ; apache ; apache( software)? license( version| v)? 2( 0)?
apache-1.1 ; 2 ; apache ; apache( software)? license( version| v)? 1 1
apache-1.0 ; 2 ; apache ; apache( software)? license( version| v)? 1 0
apache-2.0 ; 2 ; apache ; apache 2( 0)?( license)?
apache-2.0 ; 2 ; asl ; asl 2 0
apache-2.0 ; 2 ; alv2 ; alv2
apache ; 3 ; apache ; apache software licen[cs]e
apache ; 3 ; apache ; apache license
apache ; 3 ; apache ; licensed( to the apache software foundation)? under( one or more contributor license agreements| the apache)
apache ; 4 ; apache ; the apache software foundation
mit ; 1 ; mit ; opensource org licen[cs]es? mit( license)?
mit-0 ; 2 ; mit ; mit( license)? no attribution
mit ; 2 ; charge ; permission is hereby granted free of charge to any person obtaining a copy
mit ; 2 ; merchantability ; the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
mit ; 2 ; substantial ; the above copyright notice and this permission notice shall be included in all copies or substantial portions
mit ; 3 ; mit ; mit x11
mit ; 3 ; mit ; (the )?mit license
mit ; 3 ; mit ; mit licen[cs]ed?
mit ; 3 ; mit ; under mit
mit ; 3 ; expat ; expat license
x11 ; 3 ; x11 ; x11 license
bsd-2-clause ; 2 ; bsd ; bsd 2 clause( simplified| freebsd)?( license)?
bsd-3-clause ; 2 ; bsd ; bsd 3 clause( new| revised| modified)?( license)?
bsd-4-clause ; 2 ; bsd ; bsd 4 clause( original| old)?( license)?
bsd-2-clause ; 2 ; clause ; (2|two) clause bsd( license)?
bsd-3-clause ; 2 ; clause ; (3|three) clause bsd( license)?
bsd-4-clause ; 2 ; clause ; (4|four) clause bsd( license)?
bsd-2-clause ; 3 ; bsd ; (simplified|freebsd) bsd( license)?
bsd-3-clause ; 3 ; bsd ; (new|revised|modified) bsd( license)?
0bsd ; 2 ; bsd ; (zero|0) clause bsd( license)?
0bsd ; 2 ; 0bsd ; 0bsd
bsd ; 2 ; redistribution ; redistribution and use in source and binary forms with or without modification are permitted
bsd-3-clause ; 2 ; endorse ; may( not)? be used to endorse or promote products derived from this software
bsd-4-clause ; 2 ; advertising ; all advertising materials mentioning features or use of this software must display
bsd ; 1 ; bsd ; opensource org licen[cs]es? bsd( license)?
bsd ; 3 ; bsd ; bsd( style)? licen[cs]ed?
bsd ; 3 ; bsd ; berkeley software distribution bsd
bsd ; 4 ; bsd ; under bsd
isc ; 2 ; isc ; isc license
isc ; 2 ; permission ; permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
ncsa ; 3 ; ncsa ; (university of illinois )?ncsa( open source)? license
mpl-2.0 ; 1 ; mpl ; mozilla org mpl 2 0
mpl-1.1 ; 1 ; mpl ; mozilla org mpl( mpl)? 1 1
mpl-2.0 ; 2 ; mozilla ; mozilla public license( version| v)? 2( 0)?
mpl-1.1 ; 2 ; mozilla ; mozilla public license( version| v)? 1 1
mpl-1.0 ; 2 ; mozilla ; mozilla public license( version| v)? 1 0
mpl-2.0 ; 2 ; mpl ; mpl( version| v)? 2( 0)?
mpl-1.1 ; 2 ; mpl ; mpl( version| v)? 1 1
mpl-2.0 ; 2 ; mplv2 ; mplv2( 0)?
mpl ; 3 ; mozilla ; mozilla public licen[cs]e
mpl ; 4 ; mpl ; mpl
epl-2.0 ; 1 ; epl ; eclipse org legal epl( v)? 2 0
epl-1.0 ; 1 ; epl ; eclipse org legal epl( v| v10)?( 1 0)?
epl-2.0 ; 2 ; eclipse ; eclipse public license( version| v)? 2( 0)?
epl-1.0 ; 2 ; eclipse ; eclipse public license( version| v)? 1 0
edl-1.0 ; 2 ; eclipse ; eclipse distribution license( version| v)?( 1 0)?
epl ; 3 ; eclipse ; eclipse public licen[cs]e
epl ; 4 ; epl ; epl
cddl-1.1 ; 2 ; cddl ; cddl( version| v)? 1 1
cddl-1.0 ; 2 ; cddl ; cddl( version| v)? 1 0
cddl-1.0 ; 2 ; development ; common development and distribution license( cddl)?( version| v)? 1 0
cddl ; 3 ; development ; common development and distribution licen[cs]e
cddl ; 4 ; cddl ; cddl
cpl-1.0 ; 2 ; common ; common public license( version| v)? 1 0
cpl ; 3 ; common ; common public licen[cs]e
cpal-1.0 ; 3 ; attribution ; common public attribution license( version)?( 1 0)?
ipl-1.0 ; 3 ; ibm ; ibm public license( version)?( 1 0)?
apsl-2.0 ; 2 ; apple ; apple public source license( version)? 2 0
apsl ; 3 ; apple ; apple public source licen[cs]e
eupl-1.2 ; 2 ; eupl ; eupl( version| v)? 1 2
eupl-1.1 ; 2 ; eupl ; eupl( version| v)? 1 1
eupl ; 3 ; union ; european union public licen[cs]e
eupl ; 4 ; eupl ; eupl
cecill-2.1 ; 2 ; cecill ; cecill( version| v)? 2 1
cecill-b ; 2 ; cecill ; cecill b
cecill-c ; 2 ; cecill ; cecill c
cecill ; 3 ; cecill ; (licence )?cecill
artistic-2.0 ; 2 ; artistic ; artistic license( version| v)? 2( 0)?
artistic-1.0 ; 2 ; artistic ; artistic license( version| v)? 1 0
artistic ; 3 ; artistic ; (the )?artistic licen[cs]e
artistic-or-gpl ; 2 ; perl ; (under )?the same terms as perl( itself)?
cc0-1.0 ; 1 ; zero ; creativecommons org publicdomain zero 1 0
cc0-1.0 ; 2 ; cc0 ; cc0( version)? 1 0( universal)?
cc0 ; 3 ; cc0 ; cc0
cc-pdm ; 1 ; publicdomain ; creativecommons org publicdomain mark 1 0
cc-by-nc-nd ; 1 ; creativecommons ; creativecommons org licenses by nc nd( [1-4] [05])?
cc-by-nc-sa ; 1 ; creativecommons ; creativecommons org licenses by nc sa( [1-4] [05])?
cc-by-nc ; 1 ; creativecommons ; creativecommons org licenses by nc( [1-4] [05])?
cc-by-nd ; 1 ; creativecommons ; creativecommons org licenses by nd( [1-4] [05])?
cc-by-sa ; 1 ; creativecommons ; creativecommons org licenses by sa( [1-4] [05])?
cc-by ; 1 ; creativecommons ; creativecommons org licenses by( [1-4] [05])?
cc-by-nc-nd-4.0 ; 2 ; cc ; cc by nc nd 4 0
cc-by-nc-sa-4.0 ; 2 ; cc ; cc by nc sa 4 0
cc-by-nc-4.0 ; 2 ; cc ; cc by nc 4 0
cc-by-nd-4.0 ; 2 ; cc ; cc by nd 4 0
cc-by-sa-4.0 ; 2 ; cc ; cc by sa 4 0
cc-by-4.0 ; 2 ; cc ; cc by 4 0
cc-by-sa-3.0 ; 2 ; cc ; cc by sa 3 0
cc-by-nc-3.0 ; 2 ; cc ; cc by nc 3 0
cc-by-3.0 ; 2 ; cc ; cc by 3 0
cc-by-nc-nd ; 3 ; cc ; cc by nc nd
cc-by-nc-sa ; 3 ; cc ; cc by nc sa
cc-by-nc ; 3 ; cc ; cc by nc
cc-by-nd ; 3 ; cc ; cc by nd
cc-by-sa ; 3 ; cc ; cc by sa
cc-by ; 3 ; cc ; cc by
cc-by-nc-nd ; 2 ; creative ; creative commons attribution non ?commercial no ?deriv(s|atives|ativeworks)
cc-by-nc-nd ; 2 ; noncommercial ; (creative commons )?attribution noncommercial no ?derivatives
cc-by-nc-sa ; 2 ; noncommercial ; (creative commons )?attribution noncommercial share ?alike
cc-by-nc ; 2 ; noncommercial ; (creative commons )?attribution noncommercial
cc-by-sa ; 2 ; sharealike ; (creative commons )?attribution sharealike
cc-by-nd ; 2 ; noderivatives ; (creative commons )?attribution noderivatives
cc-by-4.0 ; 2 ; creative ; creative commons attribution( license)? 4 0( international)?
cc-by-3.0 ; 2 ; creative ; creative commons attribution( license)? 3 0( unported)?
cc-by ; 3 ; creative ; creative commons attribution( license)?
cc ; 4 ; creative ; creative commons( license)?
odbl-1.0 ; 2 ; odbl ; odbl( version| v)?( 1 0)?
odbl-1.0 ; 3 ; database ; open (data commons open )?database licen[cs]e
odc-by-1.0 ; 3 ; commons ; open data commons attribution license
pddl-1.0 ; 3 ; commons ; open data commons public domain dedication
ofl-1.1 ; 2 ; sil ; sil open font license( version| v)? 1 1
ofl ; 3 ; font ; open font licen[cs]e
bsl-1.0 ; 1 ; boost ; boost org license 1 0( txt)?
bsl-1.0 ; 2 ; boost ; boost software license( version| v)?( 1 0)?
busl-1.1 ; 2 ; business ; business source license( version)?( 1 1)?
sspl-1.0 ; 2 ; server ; server side public license( version| v)?( 1)?
elastic-2.0 ; 2 ; elastic ; elastic license( version| v)?( 2 0)?
polyform ; 2 ; polyform ; polyform( noncommercial| small business| perimeter| shield)( license)?( 1 0 0)?
commons-clause ; 2 ; clause ; commons clause( license condition)?
hippocratic ; 3 ; hippocratic ; hippocratic license( 2 1)?
openrail ; 3 ; openrail ; (creativeml |bigscience )?openrail( m)?
llama-community ; 3 ; llama ; llama [0-9]( [0-9])? community license
postgresql ; 3 ; postgresql ; postgresql license
php-3.01 ; 2 ; php ; php license( version| v)? 3 01
php ; 3 ; php ; (the )?php license
psf-2.0 ; 3 ; python ; python software foundation license( version)?( 2)?
python-2.0 ; 3 ; python ; python license( 2 0)?
ruby ; 3 ; ruby ; (the )?ruby license
openssl ; 3 ; openssl ; openssl license
zlib ; 3 ; zlib ; zlib( libpng)? license
zlib ; 2 ; misrepresented ; the origin of this software must not be misrepresented
libpng ; 3 ; libpng ; libpng license
unlicense ; 1 ; unlicense ; unlicense org
unlicense ; 2 ; unencumbered ; this is free and unencumbered software released into the public domain
unlicense ; 3 ; unlicense ; (the )?unlicense
wtfpl ; 2 ; want ; do what the W you want to public license
wtfpl ; 3 ; wtfpl ; wtfpl
beerware ; 3 ; beerware ; beerware( license)?
beerware ; 3 ; beer ; beer ware license
vim ; 3 ; vim ; vim license
w3c ; 3 ; w3c ; w3c software( notice and)? license
upl-1.0 ; 3 ; universal ; universal permissive license( version| v)?( 1 0)?
ms-pl ; 3 ; microsoft ; microsoft public license
ms-rl ; 3 ; microsoft ; microsoft reciprocal license
osl-3.0 ; 3 ; open ; open software license( version| v)? 3 0
afl-3.0 ; 3 ; academic ; academic free license( version| v)? 3 0
ecl-2.0 ; 3 ; educational ; educational community license( version)?( 2 0)?
lppl-1.3c ; 3 ; latex ; latex project public license( version)?( 1 3c)?
qpl-1.0 ; 3 ; q ; q public license( version)?( 1 0)?
sleepycat ; 3 ; sleepycat ; sleepycat license
zpl-2.1 ; 3 ; zope ; zope public license( version)?( 2 1)?
mulanpsl-2.0 ; 3 ; mulan ; mulan( permissive software)? license( version| v)?( 2)?
hpnd ; 3 ; historical ; historical permission notice and disclaimer
fair ; 3 ; fair ; (the )?fair license
ngpl ; 3 ; nethack ; nethack general public license
public-domain ; 2 ; domain ; (released|placed|dedicated|put) (in|into|to) the public domain
public-domain ; 3 ; domain ; (is|are) in the public domain
public-domain ; 4 ; domain ; public domain
proprietary ; 2 ; proprietary ; (confidential and )?proprietary( and confidential)? (software|information)
proprietary ; 3 ; reserved ; all rights reserved
proprietary ; 3 ; unauthorized ; unauthorized (copying|use|reproduction)( or distribution)?( of this W)? is( strictly)? prohibited
commercial ; 3 ; commercial ; commercial licen[cs]e
eula ; 3 ; eula ; eula
eula ; 2 ; agreement ; end user licen[cs]e agreement
non-commercial ; 3 ; commercial ; (for )?non commercial (use|purposes) only
research-only ; 3 ; research ; (for )?research (use|purposes) only
no-derivatives ; 4 ; derivatives ; no derivatives
copyright-notice ; 4 ; copyright ; copyright( c| ©)? (19|20)[0-9][0-9]( W)?
license-file ; 4 ; licence ; licence (see|in) (the )?(file|project root)
license-file ; 4 ; license ; license (see|in) (the )?(file|project root)
license-file ; 4 ; license ; see( the)?( file)? (license|copying)( file| txt| md)? for( the)?( full)?( license)? (details|terms|text|information)
license-ref ; 4 ; licensed ; licensed under( the)?( terms of)?( the)? W( license)?
dual-license ; 3 ; dual ; dual licensed( under)?
"""

WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def _identifier_words(name: str) -> str:
    return name.replace("-", " ").replace(".", " ")


def compiled(pattern: str) -> str:
    """The regex over texts where each word stands between its own two spaces."""
    return " " + pattern.replace(" ?", "\0").replace("W", WORD).replace(" ", "  ").replace("\0", "(?:  )?") + " "


def rules() -> list:
    """(number, label, tier, keyword, regex), strongest first."""
    out = []
    for name in IDENTIFIERS:
        words = _identifier_words(name)
        keyword = words.split()[0]
        out.append((name, 1, keyword, f"spdx license identifier {words}"))
        out.append((name, 1, keyword, f"license( expression| id| name)? {words}"))
    for line in RULES_TEXT.strip().splitlines():
        label, tier, keyword, pattern = (x.strip() for x in line.split(" ; "))
        out.append((label, int(tier), keyword, pattern))
    out.sort(key=lambda r: r[1])
    return [(i, label, tier, keyword, compiled(pattern)) for i, (label, tier, keyword, pattern) in enumerate(out)]
