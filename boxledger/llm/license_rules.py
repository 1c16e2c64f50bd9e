"""Signature rules of the license scan, by hand.

One rule per line: ``label | priority | keywords | pattern``.  Patterns are matched against a text's words in lower case
(runs of digits, a-z and characters beyond ASCII) joined by single spaces, and only at word boundaries.  A rule is tried
only on texts that hold one of its keywords.  Priorities: 9 identifiers, 8 a license with its version, 7 a license by
name, 6 a clause that only this license has, 5 a grant that names a family, 4 ownership, 3 general terms, 2 hints.  Among
equal priorities the earlier line wins.
"""

from __future__ import annotations

import re
from typing import NamedTuple

TABLE = r"""
# Identifiers as tools write them
mit | 9 | spdx | spdx license identifier mit( 0)?
apache-2.0 | 9 | spdx | spdx license identifier apache 2 0
apache-1.1 | 9 | spdx | spdx license identifier apache 1 1
bsd-2-clause | 9 | spdx | spdx license identifier bsd 2 clause( patent| views)?
bsd-3-clause | 9 | spdx | spdx license identifier bsd 3 clause( clear| lbnl| modification)?
bsd-4-clause | 9 | spdx | spdx license identifier bsd 4 clause( uc)?
0bsd | 9 | spdx | spdx license identifier 0bsd
isc | 9 | spdx | spdx license identifier isc
zlib | 9 | spdx | spdx license identifier zlib
gpl-1.0 | 9 | spdx | spdx license identifier gpl 1 0( only| or later)?
gpl-2.0-only | 9 | spdx | spdx license identifier gpl 2 0( only)?
gpl-2.0-or-later | 9 | spdx | spdx license identifier gpl 2 0 or later
gpl-3.0-only | 9 | spdx | spdx license identifier gpl 3 0( only)?
gpl-3.0-or-later | 9 | spdx | spdx license identifier gpl 3 0 or later
lgpl-2.0 | 9 | spdx | spdx license identifier lgpl 2 0( only| or later)?
lgpl-2.1 | 9 | spdx | spdx license identifier lgpl 2 1( only| or later)?
lgpl-3.0 | 9 | spdx | spdx license identifier lgpl 3 0( only| or later)?
agpl-3.0 | 9 | spdx | spdx license identifier agpl 3 0( only| or later)?
mpl-1.1 | 9 | spdx | spdx license identifier mpl 1 1
mpl-2.0 | 9 | spdx | spdx license identifier mpl 2 0( no copyleft exception)?
epl-1.0 | 9 | spdx | spdx license identifier epl 1 0
epl-2.0 | 9 | spdx | spdx license identifier epl 2 0
cddl-1.0 | 9 | spdx | spdx license identifier cddl 1 0
cddl-1.1 | 9 | spdx | spdx license identifier cddl 1 1
eupl-1.1 | 9 | spdx | spdx license identifier eupl 1 1
eupl-1.2 | 9 | spdx | spdx license identifier eupl 1 2
artistic-1.0 | 9 | spdx | spdx license identifier artistic 1 0( perl| cl8)?
artistic-2.0 | 9 | spdx | spdx license identifier artistic 2 0
bsl-1.0 | 9 | spdx | spdx license identifier bsl 1 0
busl-1.1 | 9 | spdx | spdx license identifier busl 1 1
unlicense | 9 | spdx | spdx license identifier unlicense
wtfpl | 9 | spdx | spdx license identifier wtfpl
cc0-1.0 | 9 | spdx | spdx license identifier cc0 1 0
cc-by-3.0 | 9 | spdx | spdx license identifier cc by 3 0
cc-by-4.0 | 9 | spdx | spdx license identifier cc by 4 0
cc-by-sa-3.0 | 9 | spdx | spdx license identifier cc by sa 3 0
cc-by-sa-4.0 | 9 | spdx | spdx license identifier cc by sa 4 0
cc-by-nc-4.0 | 9 | spdx | spdx license identifier cc by nc 4 0
cc-by-nc-sa-4.0 | 9 | spdx | spdx license identifier cc by nc sa 4 0
cc-by-nd-4.0 | 9 | spdx | spdx license identifier cc by nd 4 0
cc-by-nc-nd-4.0 | 9 | spdx | spdx license identifier cc by nc nd 4 0
odbl-1.0 | 9 | spdx | spdx license identifier odbl 1 0
ofl-1.1 | 9 | spdx | spdx license identifier ofl 1 1( rfn| no rfn)?
ms-pl | 9 | spdx | spdx license identifier ms pl
ms-rl | 9 | spdx | spdx license identifier ms rl
ncsa | 9 | spdx | spdx license identifier ncsa
postgresql | 9 | spdx | spdx license identifier postgresql
psf-2.0 | 9 | spdx | spdx license identifier (psf|python) 2 0
upl-1.0 | 9 | spdx | spdx license identifier upl 1 0
mulanpsl-2.0 | 9 | spdx | spdx license identifier mulanpsl 2 0
sspl-1.0 | 9 | spdx | spdx license identifier sspl 1 0
other-spdx | 8 | spdx | spdx license identifier

# Creative Commons
cc-by-nc-nd-4.0 | 8 | cc | cc by nc nd (version )?4( 0)?
cc-by-nc-nd-3.0 | 8 | cc | cc by nc nd (version )?3( 0)?
cc-by-nc-nd | 7 | cc | cc by nc nd
cc-by-nc-sa-4.0 | 8 | cc | cc by nc sa (version )?4( 0)?
cc-by-nc-sa-3.0 | 8 | cc | cc by nc sa (version )?3( 0)?
cc-by-nc-sa-2.5 | 8 | cc | cc by nc sa (version )?2 5
cc-by-nc-sa | 7 | cc | cc by nc sa
cc-by-nc-4.0 | 8 | cc | cc by nc (version )?4( 0)?
cc-by-nc-3.0 | 8 | cc | cc by nc (version )?3( 0)?
cc-by-nc | 7 | cc | cc by nc
cc-by-nd-4.0 | 8 | cc | cc by nd (version )?4( 0)?
cc-by-nd-3.0 | 8 | cc | cc by nd (version )?3( 0)?
cc-by-nd | 7 | cc | cc by nd
cc-by-sa-4.0 | 8 | cc | cc by sa (version )?4( 0)?
cc-by-sa-3.0 | 8 | cc | cc by sa (version )?3( 0)?
cc-by-sa-2.5 | 8 | cc | cc by sa (version )?2 5
cc-by-sa-2.0 | 8 | cc | cc by sa (version )?2 0
cc-by-sa | 7 | cc | cc by sa
cc-by-4.0 | 8 | cc | cc by (version )?4( 0)?
cc-by-3.0 | 8 | cc | cc by (version )?3( 0)?
cc-by-2.5 | 8 | cc | cc by (version )?2 5
cc-by-2.0 | 8 | cc | cc by (version )?2 0
cc-by-1.0 | 8 | cc | cc by (version )?1 0
cc0-1.0 | 8 | cc0 | cc0 (version )?1( 0)?( universal)?
cc0-1.0 | 7 | cc0 | cc0
cc-by-nc-nd | 7 | attribution | (creative commons )?attribution non ?commercial no ?deriv(s|ative|atives)( works)?
cc-by-nc-sa | 7 | attribution | (creative commons )?attribution non ?commercial share ?alike
cc-by-nc | 7 | attribution | (creative commons )?attribution non ?commercial
cc-by-nd | 7 | attribution | (creative commons )?attribution no ?deriv(s|ative|atives)( works)?
cc-by-sa | 7 | attribution | (creative commons )?attribution share ?alike
cc-by-4.0 | 8 | attribution | creative commons attribution (license )?(version )?4 0( international)?
cc-by-3.0 | 8 | attribution | creative commons attribution (license )?(version )?3 0( unported)?
cc-by-2.0 | 8 | attribution | creative commons attribution (license )?(version )?2 0( generic)?
cc-by | 7 | attribution | creative commons attribution( license)?
cc-sampling | 7 | sampling | creative commons sampling( plus)?( 1 0)?
cc-pddc | 7 | commons | creative commons public domain( dedication| mark)?
cc0-1.0 | 8 | creativecommons | creativecommons org publicdomain zero 1 0
cc-pddc | 8 | creativecommons | creativecommons org publicdomain mark 1 0
cc-by-nc-nd | 8 | creativecommons | creativecommons org licenses by nc nd( [1-4] [05])?
cc-by-nc-sa | 8 | creativecommons | creativecommons org licenses by nc sa( [1-4] [05])?
cc-by-nc | 8 | creativecommons | creativecommons org licenses by nc( [1-4] [05])?
cc-by-nd | 8 | creativecommons | creativecommons org licenses by nd( [1-4] [05])?
cc-by-sa | 8 | creativecommons | creativecommons org licenses by sa( [1-4] [05])?
cc-by | 8 | creativecommons | creativecommons org licenses by( [1-4] [05])?
cc-unspecified | 5 | commons | (licensed|released|available|distributed|published|shared) under (a|the) creative commons( license| licence)?
cc-unspecified | 3 | commons | creative commons( license| licence)?

# GNU family
agpl-3.0 | 8 | affero | (gnu )?affero general public (license|licence) (version |v)?3( 0)?
agpl-1.0 | 8 | affero | affero general public (license|licence) (version |v)?1( 0)?
agpl | 7 | affero | (gnu )?affero (general public (license|licence)|gpl)
agpl-3.0 | 8 | agpl,agplv3 | (gnu )?agpl ?v?(version )?3( 0)?( only| or later)?
agpl | 7 | agpl | (gnu )?agpl
lgpl-2.1 | 8 | lesser | (gnu )?lesser general public (license|licence) (version |v)?2 1
lgpl-3.0 | 8 | lesser | (gnu )?lesser general public (license|licence) (version |v)?3( 0)?
lgpl | 7 | lesser | (gnu )?lesser (general public (license|licence)|gpl)
lgpl-2.0 | 8 | library | (gnu )?library general public (license|licence) (version |v)?2( 0)?
lgpl-2.0 | 7 | library | gnu library general public (license|licence)
lgpl-2.1 | 8 | lgpl,lgplv2 | (gnu )?lgpl ?v?(version )?2 1( only| or later)?
lgpl-3.0 | 8 | lgpl,lgplv3 | (gnu )?lgpl ?v?(version )?3( 0)?( only| or later)?
lgpl | 7 | lgpl | (gnu )?lgpl
gpl-1.0 | 8 | general | (gnu )?general public (license|licence) (version |v)1( 0)?
gpl-2.0 | 8 | general | (gnu )?general public (license|licence) (version |v)?2( 0)?
gpl-3.0 | 8 | general | (gnu )?general public (license|licence) (version |v)?3( 0)?
gpl-2.0-or-later | 8 | later | general public license as published by the free software foundation either version 2 of the license or at your option any later version
gpl-3.0-or-later | 8 | later | general public license as published by the free software foundation either version 3 of the license or at your option any later version
lgpl-2.1-or-later | 8 | later | lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version
gpl-2.0 | 8 | gplv2 | (gnu )?gplv2( only| or later)?
gpl-3.0 | 8 | gplv3 | (gnu )?gplv3( only| or later)?
gpl-2.0-only | 8 | gpl | (gnu )?gpl (version |v)?2( 0)? only
gpl-2.0-or-later | 8 | gpl | (gnu )?gpl (version |v)?2( 0)? or (any )?later
gpl-2.0 | 8 | gpl | (gnu )?gpl (version |v)?2( 0)?
gpl-3.0-only | 8 | gpl | (gnu )?gpl (version |v)?3( 0)? only
gpl-3.0-or-later | 8 | gpl | (gnu )?gpl (version |v)?3( 0)? or (any )?later
gpl-3.0 | 8 | gpl | (gnu )?gpl (version |v)?3( 0)?
gpl | 7 | gpl | (gnu )?gpl( license| licence)?
gfdl-1.1 | 8 | documentation | (gnu )?free documentation (license|licence) (version |v)?1 1
gfdl-1.2 | 8 | documentation | (gnu )?free documentation (license|licence) (version |v)?1 2
gfdl-1.3 | 8 | documentation | (gnu )?free documentation (license|licence) (version |v)?1 3
gfdl | 7 | documentation | gnu free documentation (license|licence)
gfdl | 7 | gfdl | (gnu )?gfdl
classpath-exception | 6 | classpath | (gpl )?(with )?(the )?classpath exception( 2 0)?
gcc-exception | 6 | gcc | gcc runtime library exception( 3 1)?
linking-exception | 6 | linking | (as a special exception )?linking exception
gpl-clause | 6 | redistribute | this program is free software you can redistribute it and or modify it
gpl-clause | 6 | fitness | without even the implied warranty of merchantability or fitness for a particular purpose see the gnu
copyleft | 2 | copyleft | copyleft

# Permissive
apache-2.0 | 8 | apache | (the )?apache (software )?(license|licence) (version |v)?2( 0)?
apache-1.1 | 8 | apache | (the )?apache (software )?(license|licence) (version |v)?1 1
apache-1.0 | 8 | apache | (the )?apache (software )?(license|licence) (version |v)?1 0
apache-2.0 | 8 | apache | apache 2( 0)?( license| licence)?
apache-2.0 | 8 | apache | apache org licenses license 2 0
apache | 7 | apache | apache (software )?(license|licence)
asl-2.0 | 7 | asl | asl (version |v)?2( 0)?
mit | 7 | mit | (the )?mit (license|licence)
mit | 7 | mit | (licensed|released|available|distributed|published|covered) under( the)? mit
mit | 7 | mit | license mit
mit | 7 | expat | expat (license|licence)
mit-0 | 8 | mit | mit no attribution
mit | 6 | permission | permission is hereby granted free of charge to any person obtaining a copy of this software
mit | 6 | sublicense | use copy modify merge publish distribute sublicense and or sell copies of the software
mit | 8 | opensource | opensource org licenses mit( license)?
x11 | 7 | x11 | (mit )?x11 (license|licence)
bsd-2-clause | 8 | bsd | (bsd 2|2 clause bsd|two clause bsd|simplified bsd|freebsd bsd)( clause)?( license| licence)?
bsd-3-clause | 8 | bsd | (bsd 3|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)( clause)?( license| licence)?
bsd-4-clause | 8 | bsd | (bsd 4|4 clause bsd|four clause bsd|original bsd)( clause)?( license| licence)?
0bsd | 8 | bsd | (zero clause bsd|bsd zero clause)( license| licence)?
0bsd | 8 | 0bsd | 0bsd
bsd | 7 | bsd | bsd( style)? (license|licence)
bsd | 6 | redistribution,redistributions | redistributions? and use in source and binary forms with or without modification are permitted
bsd-3-clause | 6 | endorse | may be used to endorse or promote products derived from this software without specific prior written permission
bsd-4-clause | 6 | advertising | all advertising materials mentioning features or use of this software must display
bsd-2-clause | 6 | redistributions | redistributions of source code must retain the above copyright notice
bsd-2-clause | 6 | redistributions | redistributions in binary form must reproduce the above copyright notice
isc | 7 | isc | (the )?isc (license|licence)
isc | 6 | permission | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
zlib | 7 | zlib | (the )?zlib( libpng)? (license|licence)
zlib | 6 | altered | altered source versions must be plainly marked as such
libpng | 7 | libpng | libpng (license|licence)( version 2)?
bsl-1.0 | 7 | boost | boost software (license|licence)( version| v)?( 1 0)?
ncsa | 7 | ncsa | (university of illinois )?ncsa (open source )?(license|licence)
postgresql | 7 | postgresql | postgresql (license|licence)
psf-2.0 | 7 | python | (python software foundation|psf) (license|licence)( agreement)?( version 2)?
psf-2.0 | 7 | psf | psf (license|licence)( agreement)?
ruby | 7 | ruby | ruby (license|licence)
php-3.01 | 8 | php | php (license|licence) (version |v)?3 0?1
php | 7 | php | php (license|licence)
perl | 5 | perl | (under )?the same terms as perl( itself)?
artistic-2.0 | 8 | artistic | (the )?artistic (license|licence) (version |v)?2( 0)?
artistic-1.0 | 8 | artistic | (the )?artistic (license|licence) (version |v)?1( 0)?
artistic | 7 | artistic | (the )?artistic (license|licence)
curl | 7 | curl | curl (license|licence)
openssl | 7 | openssl | openssl (license|licence)
ssleay | 7 | ssleay | ssleay (license|licence)
w3c | 7 | w3c | w3c software (notice and )?(license|licence)
unicode | 7 | unicode | unicode (license|licence)( agreement)?( v3)?
icu | 7 | icu | icu (license|licence)
afl-3.0 | 7 | academic | academic free (license|licence)( version| v)?( 3 0| 2 1)?
ecl-2.0 | 7 | educational | educational community (license|licence)( version| v)?( 2 0)?
upl-1.0 | 7 | universal | universal permissive (license|licence)( version| v)?( 1 0)?
mulanpsl-2.0 | 7 | mulan | mulan (permissive software license|psl)( version| v2| v)?( 2)?
blueoak-1.0 | 7 | oak | blue oak model (license|licence)( 1 0 0)?
beerware | 7 | beerware | beerware( license| licence)?
beerware | 7 | beer | beer ware (license|licence)
wtfpl | 7 | wtfpl | wtfpl( version| v)?( 2)?
wtfpl | 7 | fuck | do what the fuck you want to public license
fair | 7 | fair | fair license
naumen | 7 | naumen | naumen public license
hpnd | 7 | historical | historical permission notice and disclaimer
vim | 7 | vim | vim license
tcl | 7 | tcl | tcl( tk)? license
json | 7 | json | json license
json | 6 | evil | the software shall be used for good not evil
ftl | 7 | freetype | freetype (project )?license
ijg | 7 | jpeg | independent jpeg group( s)? license
imagemagick | 7 | imagemagick | imagemagick license
zpl-2.1 | 7 | zope | zope public license( version| v)?( 2 1| 2 0)?

# Weak copyleft and corporate
mpl-2.0 | 8 | mozilla | mozilla public (license|licence) (version |v)?2( 0)?
mpl-1.1 | 8 | mozilla | mozilla public (license|licence) (version |v)?1 1
mpl-1.0 | 8 | mozilla | mozilla public (license|licence) (version |v)?1 0
mpl | 7 | mozilla | mozilla public (license|licence)
mpl-2.0 | 8 | mpl,mplv2 | mpl ?v?(version )?2( 0)?
mpl | 7 | mpl | mpl( license| licence)
npl-1.1 | 7 | netscape | netscape public (license|licence)( version)?( 1 [01])?
epl-2.0 | 8 | eclipse | eclipse public (license|licence) (version |v)?2( 0)?
epl-1.0 | 8 | eclipse | eclipse public (license|licence) (version |v)?1( 0)?
epl | 7 | eclipse | eclipse public (license|licence)
edl-1.0 | 7 | eclipse | eclipse distribution license( v)?( 1 0)?
cpl-1.0 | 7 | common | common public (license|licence)( version| v)?( 1 0)?
cpal-1.0 | 7 | attribution | common public attribution license( version)?( 1 0)?
cddl-1.1 | 8 | cddl | cddl (version |v)?1 1
cddl-1.0 | 8 | cddl | cddl (version |v)?1 0
cddl | 7 | cddl | cddl
cddl | 7 | common | common development and distribution (license|licence)( version)?( 1 [01])?
ipl-1.0 | 7 | ibm | ibm public (license|licence)( version)?( 1 0)?
apsl-2.0 | 7 | apple | apple public source (license|licence)( version)?( 2 0| 1 [012])?
spl-1.0 | 7 | sun | sun public (license|licence)( version| v)?( 1 0)?
sissl | 7 | sun | sun industry standards source (license|licence)
qpl-1.0 | 7 | q | (the )?q public (license|licence)( version)?( 1 0)?
ms-pl | 7 | microsoft | microsoft public (license|licence)
ms-rl | 7 | microsoft | microsoft reciprocal (license|licence)
ms-eula | 7 | microsoft | microsoft software license terms
osl-3.0 | 7 | open | open software (license|licence)( version| v)?( 3 0| 2 1)?
eupl-1.2 | 8 | eupl | eupl (version |v)?1 2
eupl | 7 | eupl | eupl
eupl | 7 | union | european union public (license|licence)( version| v)?( 1 [012])?
cecill-2.1 | 7 | cecill | (licence )?cecill( version| v)?( 2 1| 2 0)?
lppl-1.3c | 7 | latex | latex project public (license|licence)( version)?( 1 3c?)?
ofl-1.1 | 7 | sil | sil open font (license|licence)( version| v)?( 1 [01])?
ofl-1.1 | 7 | font | open font (license|licence)( version| v)?( 1 1)?
rpl-1.5 | 7 | reciprocal | reciprocal public (license|licence)( version)?( 1 5)?
sleepycat | 7 | sleepycat | sleepycat (license|licence)
catosl-1.1 | 7 | computer | computer associates trusted open source license( 1 1)?
vostrom | 7 | vostrom | vostrom public license
watcom-1.0 | 7 | sybase | sybase open watcom public license( version)?( 1 0)?
nasa-1.3 | 7 | nasa | nasa open source agreement( version)?( 1 3)?

# Data, government and model licenses
odbl-1.0 | 7 | odbl | odbl( version| v)?( 1 0)?
odbl-1.0 | 7 | database | open (data commons open )?database (license|licence)( version| v)?( 1 0)?
odc-by-1.0 | 7 | commons | open data commons attribution (license|licence)( version| v)?( 1 0)?
pddl-1.0 | 7 | commons | open data commons public domain dedication( and license)?
pddl-1.0 | 7 | pddl | pddl( 1 0)?
cdla-permissive | 7 | community | community data (license|licence) agreement permissive( version)?( [12] 0)?
cdla-sharing | 7 | community | community data (license|licence) agreement sharing( version)?( 1 0)?
ogl-uk-3.0 | 7 | government | open government (license|licence)( version| v)?( [123] 0)?
etalab-2.0 | 7 | etalab | (licence ouverte )?etalab( 2 0)?
etalab-2.0 | 7 | ouverte | licence ouverte( open licence)?( version)?( 2 0)?
dl-de-by-2.0 | 7 | datenlizenz | datenlizenz deutschland( namensnennung)?( version)?( 2 0)?
openrail | 7 | openrail | (bigscience |creativeml )?openrail( m)?( license)?
openrail | 7 | rail | responsible ai license
llama | 7 | llama | llama [234]( [123])? community license( agreement)?

# Public domain
unlicense | 7 | unlicense | (the )?unlicense
unlicense | 6 | encumbered,unencumbered | this is free and unencumbered software released into the public domain
public-domain | 5 | domain | (dedicated|released|placed|belongs?|is|are|put) (to|into|in) the public domain
public-domain | 3 | domain | public domain
no-copyright | 5 | copyright | no (copyright|rights reserved)( is)?( claimed| asserted)?
public-domain | 5 | gemeinfrei | gemeinfrei(e|es|er)?
public-domain | 5 | publico,público | dominio p[uú]blico
public-domain | 5 | domaine | domaine public

# Source available and closed terms
busl-1.1 | 7 | business | business source (license|licence)( version)?( 1 1)?
sspl-1.0 | 7 | sspl | sspl( version| v)?( 1( 0)?)?
sspl-1.0 | 7 | server | server side public (license|licence)( version| v)?( 1( 0)?)?
elastic-2.0 | 7 | elastic | elastic (license|licence)( version| v)?( 2( 0)?)?
polyform | 7 | polyform | polyform (noncommercial|small business|free trial|internal use|perimeter|shield|strict)( license)?( 1 0 0)?
commons-clause | 7 | commons | commons clause( license condition)?
confluent-1.0 | 7 | confluent | confluent community license( agreement)?( version)?( 1 0)?
shareware | 5 | shareware | shareware
freeware | 5 | freeware | freeware
eula | 5 | eula | (end user license agreement )?eula
eula | 5 | end | end user (license|licence) agreement
proprietary | 5 | proprietary | proprietary (and confidential|software|license|licence|information)
confidential | 4 | confidential | (strictly )?confidential (information|property|and proprietary)
trade-secret | 4 | secret,secrets | trade secrets?
commercial | 5 | commercial | (requires a |under a )?commercial (license|licence)
non-commercial | 4 | commercial,noncommercial | (for )?non ?commercial (use|purposes?)( only)?
personal-use | 4 | personal | (for )?personal (and non commercial )?use only
educational-use | 4 | educational | (for )?educational (use|purposes?) only
research-only | 4 | research | (for )?research (use|purposes?) only
no-redistribution | 4 | redistribution,redistribute,redistributed | (no redistribution|may not be (copied|redistributed|reproduced)|do not redistribute)
no-derivatives | 4 | derivative,derivatives | no derivatives?( works?)?
permission-required | 4 | permission | without (the )?(prior |express |explicit )*(written )?(permission|consent)( of)?
terms-of-use | 3 | terms | terms (of|and conditions of) (use|service)
evaluation | 4 | evaluation | (for )?evaluation (use|purposes?) only

# Ownership
reserved | 4 | rights | all rights (are )?(strictly )?reserved( worldwide)?
reserved | 4 | droits | tous droits r[eé]serv[eé]s
reserved | 4 | rechte | alle rechte vorbehalten
reserved | 4 | derechos | todos los derechos reservados
some-reserved | 4 | rights | some rights reserved
copyright | 4 | copyright | copyright (c |© )?(19|20)[0-9]{2}( (19|20)[0-9]{2}){0,4}
copyright | 4 | copyright | copyright (c|notice|holders?|owners?|by)
copyright | 4 | © | © ?(19|20)[0-9]{2}
copyright | 4 | copyrighted | copyrighted( material| work)?( by)?
copyright | 2 | copyright | copyright
trademark | 4 | trademark,trademarks | (registered )?trademarks? of
patent | 4 | patent | patent (grant|pending|license|licence)

# General terms
attribution-required | 3 | attribution | (with|requires?|provide|give) (proper |appropriate )?(attribution|credit)
as-is | 3 | as | (provided|distributed|licensed|delivered) (on an )?as is( basis)?( without warrant(y|ies))?
no-warranty | 3 | warranty,warranties | without (any )?warrant(y|ies)( of any kind)?
no-warranty | 3 | warranty,warranties | (no|disclaims? all) (express or implied )?warrant(y|ies)
no-liability | 3 | liable | in no event (shall|will) (the )?([a-z]+ ){1,8}be liable
licensed-under | 3 | licensed | (dual )?licensed under( the)?
licensed-under | 3 | released | released under( the)?( terms of( the)?)?
licensed-under | 3 | distributed | distributed under( the)?( terms of( the)?)?
license-file | 3 | license,licence | see (the )?(accompanying )?(license|licence)( txt| md)?( file)?( for details)?
license-agreement | 3 | license,licence | (license|licence) agreement
open-source | 2 | source | open source( software| license| initiative)?
dual-license | 3 | dual | dual licen[sc]ed
license-mention | 2 | lizenz,lizenziert | (lizenziert unter|unter der lizenz)
license-mention | 2 | licencia | (bajo la licencia|con licencia)
license-mention | 2 | licence | (sous la licence|sous licence)
license-mention | 2 | license,licence,licensed | licen[sc]ed?
"""

#: How sure a detection of each priority is that the text carries a license, for the score.
SURENESS = {9: 0.99, 8: 0.95, 7: 0.85, 6: 0.75, 5: 0.6, 4: 0.4, 3: 0.2, 2: 0.05}


class Rule(NamedTuple):
    number: int
    label: str
    priority: int
    keywords: tuple[str, ...]
    pattern: str


def rules(table: str = TABLE) -> list[Rule]:
    """The rules of a table in its order."""
    lines = (line for line in table.splitlines() if line.strip() and not line.startswith("#"))
    out = []
    for number, line in enumerate(lines):
        label, priority, keywords, pattern = (x.strip() for x in line.split(" | ", 3))
        out.append(Rule(number, label, int(priority), tuple(keywords.split(",")), pattern))
    return out


def whole_words(pattern: str) -> re.Pattern:
    """The pattern between word boundaries of a text whose words are joined by single spaces."""
    return re.compile(f"(?<![^ ])(?:{pattern})(?![^ ])")
