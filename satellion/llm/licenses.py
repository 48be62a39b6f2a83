"""License scans by ordered signature rules.

DataFrame functions only. Rules are regular expressions over the lower-cased words of a text, one blank between, written one by
one. A rule runs only in texts that hold its keyword. A detection is dropped when one of an earlier or equal priority contains its
interval (equal intervals: the earlier rule stays); a sorted sweep with a running maximum a priority finds these. Base phrases always
stand. A null text is empty.
"""

from __future__ import annotations

import functools
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satellion.llm.common import count_words, set_aside
from satellion.llm.spans import let, placed, running_max, running_sum

#: What stands between words; words are digits, letters (A-Z still in either case) and everything beyond ASCII.
GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Fixed values of the contract.
PHRASES = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}

#: One rule a line: label, priority, keyword, pattern. @ stands for licence in either spelling, # for what may stand between a name and its
#: version, as in "gpl 2", "gpl version 2", "gpl v 2" and "gplv2". Priorities: 1 a named choice, 2 a grant or a full name, 3 a name with its
#: version or a name that is clear alone, 4 a family, 5 a hint, 6 no licence. A keyword begins at a word and every match holds it.
SIGNATURES = """
mit | 2 | mit licen | under the mit @
mit | 2 | mit licen | terms of the mit @
mit | 2 | free of charge | permission is hereby granted free of charge to any person obtaining a copy
mit | 3 | mit licen | mit @
mit | 3 | expat licen | expat @
mit | 4 | mit style | mit style @
mit-0 | 2 | mit no attribution | mit no attribution(?: @)?
mit-0 | 3 | mit 0 | mit 0 @
mit-cmu | 3 | cmu licen | (?:mit )?cmu @
x11 | 3 | x11 licen | (?:mit )?x11 @
isc | 2 | any purpose | permission to use copy modify and or distribute this software for any purpose with or without fee
isc | 3 | isc licen | isc @
hpnd | 2 | any purpose | permission to use copy modify and distribute this software and its documentation for any purpose
hpnd | 3 | historical permission | historical permission notice and disclaimer
0bsd | 2 | zero clause | (?:bsd zero clause|zero clause bsd)(?: @)?
0bsd | 3 | 0bsd | 0bsd
bsd | 2 | redistribution and use | redistribution and use in source and binary forms with or without modification are permitted
bsd-1 | 2 | bsd 1 | bsd 1 clause(?: @)?
bsd-2 | 2 | bsd 2 | bsd 2 clause(?: @)?
bsd-2 | 2 | 2 clause | 2 clause bsd(?: @)?
bsd-2 | 2 | two clause | two clause bsd(?: @)?
bsd-2 | 3 | simplified bsd | simplified bsd(?: @)?
bsd-2 | 3 | freebsd licen | freebsd @
bsd-2-patent | 1 | bsd 2 | bsd 2 clause plus patent(?: @)?
bsd-3 | 2 | bsd 3 | bsd 3 clause(?: @)?
bsd-3 | 2 | 3 clause | 3 clause bsd(?: @)?
bsd-3 | 2 | three clause | three clause bsd(?: @)?
bsd-3 | 3 | new bsd | new bsd(?: @)?
bsd-3 | 3 | modified bsd | modified bsd(?: @)?
bsd-3 | 3 | revised bsd | revised bsd(?: @)?
bsd-3-clear | 1 | bsd 3 | bsd 3 clause clear(?: @)?
bsd-4 | 2 | bsd 4 | bsd 4 clause(?: @)?
bsd-4 | 2 | 4 clause | 4 clause bsd(?: @)?
bsd-4 | 3 | original bsd | original bsd(?: @)?
bsd-4 | 3 | advertising materials | all advertising materials mentioning features or use of this software must display
bsd | 4 | bsd licen | bsd @
bsd | 4 | bsd style | bsd style @
gpl-1+ | 1 | gpl | gpl#1(?: 0)? (?:or|and) (?:any )?later(?: version)?
gpl-2+ | 1 | gpl | gpl#2(?: 0)? (?:or|and) (?:any )?later(?: version)?
gpl-3+ | 1 | gpl | gpl#3(?: 0)? (?:or|and) (?:any )?later(?: version)?
gpl-1+ | 1 | general public | general public @#1(?: 0)? or (?:at your option )?(?:any )?later(?: version)?
gpl-2+ | 1 | general public | general public @#2(?: 0)? or (?:at your option )?(?:any )?later(?: version)?
gpl-3+ | 1 | general public | general public @#3(?: 0)? or (?:at your option )?(?:any )?later(?: version)?
gpl-2+ | 1 | either version 2 | either version 2 of the @ or at your option any later version
gpl-3+ | 1 | either version 3 | either version 3 of the @ or at your option any later version
gpl-2-classpath | 1 | gpl | gpl#2(?: 0)? with (?:the )?classpath exception
gpl-3-gcc | 1 | gcc runtime | gcc runtime library exception
gpl-1 | 3 | gpl | gpl#1(?: 0)?(?: only)?
gpl-2 | 3 | gpl | gpl#2(?: 0)?(?: only)?
gpl-3 | 3 | gpl | gpl#3(?: 0)?(?: only)?
gpl-1 | 3 | general public | general public @#1(?: 0)?(?: only)?
gpl-2 | 3 | general public | general public @#2(?: 0)?(?: only)?
gpl-3 | 3 | general public | general public @#3(?: 0)?(?: only)?
gpl | 4 | general public | (?:gnu )?general public @
gpl | 5 | gpl | (?:gnu )?gpl
lgpl-2+ | 1 | lgpl | lgpl#2(?: 0)? (?:or|and) (?:any )?later(?: version)?
lgpl-2.1+ | 1 | lgpl | lgpl#2 1 (?:or|and) (?:any )?later(?: version)?
lgpl-3+ | 1 | lgpl | lgpl#3(?: 0)? (?:or|and) (?:any )?later(?: version)?
lgpl-2+ | 1 | library general | library general public @#2(?: 0)? or (?:at your option )?(?:any )?later(?: version)?
lgpl-2.1+ | 1 | lesser general | lesser general public @#2 1 or (?:at your option )?(?:any )?later(?: version)?
lgpl-3+ | 1 | lesser general | lesser general public @#3(?: 0)? or (?:at your option )?(?:any )?later(?: version)?
lgpl-2.1 | 2 | lgpl | lgpl#2 1(?: only)?
lgpl-2 | 3 | lgpl | lgpl#2(?: 0)?(?: only)?
lgpl-3 | 3 | lgpl | lgpl#3(?: 0)?(?: only)?
lgpl-2 | 2 | library general | library general public @#2(?: 0)?(?: only)?
lgpl-2.1 | 2 | lesser general | lesser general public @#2 1(?: only)?
lgpl-3 | 2 | lesser general | lesser general public @#3(?: 0)?(?: only)?
lgpl | 3 | lesser general | (?:gnu )?lesser general public @
lgpl | 3 | library general | (?:gnu )?library general public @
lgpl | 5 | lgpl | (?:gnu )?lgpl
agpl-1+ | 1 | agpl | agpl#1(?: 0)? (?:or|and) (?:any )?later(?: version)?
agpl-3+ | 1 | agpl | agpl#3(?: 0)? (?:or|and) (?:any )?later(?: version)?
agpl-3+ | 1 | affero general | affero general public @#3(?: 0)? or (?:at your option )?(?:any )?later(?: version)?
agpl-1 | 3 | agpl | agpl#1(?: 0)?(?: only)?
agpl-3 | 3 | agpl | agpl#3(?: 0)?(?: only)?
agpl-1 | 2 | affero general | affero general public @#1(?: 0)?(?: only)?
agpl-3 | 2 | affero general | affero general public @#3(?: 0)?(?: only)?
agpl | 3 | affero general | (?:gnu )?affero general public @
agpl | 5 | agpl | (?:gnu )?agpl
gfdl-1.1 | 2 | free documentation | free documentation @#1 1
gfdl-1.2 | 2 | free documentation | free documentation @#1 2
gfdl-1.3 | 2 | free documentation | free documentation @#1 3
gfdl | 3 | free documentation | (?:gnu )?free documentation @
gfdl | 4 | gfdl | (?:gnu )?gfdl
apache-1 | 3 | apache licen | apache @#1(?: 0)?
apache-1.1 | 2 | apache licen | apache @#1 1
apache-2 | 2 | apache licen | apache @#2(?: 0)?
apache-1 | 3 | apache software | apache software @#1(?: 0)?
apache-1.1 | 2 | apache software | apache software @#1 1
apache-2 | 2 | apache software | apache software @#2(?: 0)?
apache-2 | 3 | apache 2 | apache 2(?: 0)?(?: @)?
apache-2 | 3 | asl 2 | asl 2(?: 0)?
apache-2-llvm | 1 | apache 2 | apache 2 0 with llvm exceptions?
apache-2 | 2 | may not use this file | you may not use this file except in compliance with the @
apache | 4 | apache licen | apache @
apache | 4 | apache software | apache software @
mpl-1 | 3 | mozilla public | mozilla public @#1(?: 0)?
mpl-1.1 | 2 | mozilla public | mozilla public @#1 1
mpl-2 | 2 | mozilla public | mozilla public @#2(?: 0)?
mpl-2-no-copyleft | 1 | incompatible with secondary | incompatible with secondary licen[cs]es
mpl-1 | 3 | mpl | mpl#1(?: 0)?
mpl-1.1 | 2 | mpl | mpl#1 1
mpl-2 | 3 | mpl | mpl#2(?: 0)?
mpl | 4 | mozilla public | mozilla public @
npl-1 | 3 | netscape public | netscape public @#1(?: 0| 1)?
npl | 4 | netscape public | netscape public @
epl-1 | 2 | eclipse public | eclipse public @#1(?: 0)?
epl-2 | 2 | eclipse public | eclipse public @#2(?: 0)?
epl-1 | 3 | epl | epl#1(?: 0)?
epl-2 | 3 | epl | epl#2(?: 0)?
epl | 4 | eclipse public | eclipse public @
edl-1 | 3 | eclipse distribution | eclipse distribution @(?:#1(?: 0)?)?
cpl-1 | 3 | common public | common public @#1(?: 0)?
cpl | 4 | common public | common public @
cpal-1 | 3 | common public attribution | common public attribution @(?:#1(?: 0)?)?
ipl-1 | 3 | ibm public | ibm public @(?:#1(?: 0)?)?
cddl-1 | 2 | common development | common development and distribution @#1(?: 0)?
cddl-1.1 | 1 | common development | common development and distribution @#1 1
cddl | 3 | common development | common development and distribution @
cddl-1.1 | 2 | cddl | cddl#1 1
cddl-1 | 3 | cddl | cddl#1(?: 0)?
cddl | 5 | cddl | cddl
ms-pl | 3 | microsoft public | microsoft public @
ms-pl | 3 | ms pl | ms pl
ms-rl | 3 | microsoft reciprocal | microsoft reciprocal @
ms-rl | 3 | ms rl | ms rl
artistic-1 | 3 | artistic licen | artistic @#1(?: 0)?
artistic-2 | 3 | artistic licen | artistic @#2(?: 0)?
artistic-perl | 3 | same terms as perl | under the same terms as perl(?: itself)?
artistic | 4 | artistic licen | artistic @
boost-1 | 3 | boost software | boost software @(?:#1(?: 0)?)?
bsl-1.1 | 3 | business source | business source @(?:#1 1)?
sspl-1 | 3 | server side public | server side public @(?:#1(?: 0)?)?
elastic-2 | 3 | elastic licen | elastic @#2(?: 0)?
elastic | 4 | elastic licen | elastic @
polyform-nc | 2 | polyform noncommercial | polyform noncommercial @(?: 1 0 0)?
polyform | 4 | polyform | polyform
commons-clause | 3 | commons clause | commons clause
eupl-1.1 | 2 | european union public | european union public @#1 1
eupl-1.2 | 2 | european union public | european union public @#1 2
eupl | 3 | european union public | european union public @
eupl-1.1 | 3 | eupl | eupl#1 1
eupl-1.2 | 3 | eupl | eupl#1 2
eupl | 5 | eupl | eupl
cecill-2 | 3 | cecill | cecill#2(?: 0| 1)?
cecill-b | 3 | cecill b | cecill b
cecill-c | 3 | cecill c | cecill c
cecill | 4 | cecill | cecill
osl-1 | 3 | open software licen | open software @#1(?: 0)?
osl-2 | 3 | open software licen | open software @#2(?: 0| 1)?
osl-3 | 3 | open software licen | open software @#3(?: 0)?
osl | 4 | open software licen | open software @
afl-2 | 3 | academic free | academic free @#2(?: 0| 1)?
afl-3 | 3 | academic free | academic free @#3(?: 0)?
afl | 4 | academic free | academic free @
ecl-2 | 3 | educational community | educational community @#2(?: 0)?
ecl | 4 | educational community | educational community @
ofl-1 | 2 | open font | (?:sil )?open font @#1(?: 0)?
ofl-1.1 | 1 | open font | (?:sil )?open font @#1 1
ofl | 3 | open font | (?:sil )?open font @
ofl-1.1 | 3 | ofl | ofl#1 1
ufl-1 | 3 | ubuntu font | ubuntu font licen[cs]e(?:#1(?: 0)?)?
lppl-1.3 | 2 | latex project public | latex project public @#1 3[abc]?
lppl | 3 | latex project public | latex project public @
zpl-2 | 3 | zope public | zope public @#2(?: 0| 1)?
zpl | 4 | zope public | zope public @
python-2 | 2 | python software foundation | python software foundation @#2
python | 3 | python software foundation | python software foundation @
python | 3 | psf licen | psf @
python | 4 | python licen | python @
php-3 | 3 | php licen | php @#3(?: 0| 01)?
php | 4 | php licen | php @
ruby | 4 | ruby licen | ruby @
tcl | 4 | tcl | tcl(?: tk)? @
vim | 3 | vim licen | vim @
curl | 3 | curl licen | curl @
openssl | 3 | openssl | openssl(?: ssleay)? @
ssleay | 3 | ssleay licen | ssleay @
zlib | 2 | as is without any express | this software is provided as is without any express or implied warranty
zlib | 3 | zlib licen | zlib @
zlib-libpng | 2 | zlib libpng | zlib libpng @
libpng | 3 | libpng licen | libpng @
libtiff | 3 | libtiff licen | libtiff @
ijg | 3 | independent jpeg group | independent jpeg group(?: @)?
ftl | 3 | freetype | freetype(?: project)? @
imagemagick | 3 | imagemagick licen | imagemagick @
info-zip | 3 | info zip | info zip @
bzip2 | 3 | bzip2 | bzip2(?: and libbzip2)? @
ncsa | 3 | ncsa | (?:university of illinois )?ncsa(?: open source)? @
ntp | 3 | ntp licen | ntp @
w3c | 3 | w3c | w3c(?: software(?: notice and)?)? @
unicode | 3 | unicode licen | unicode @(?: agreement)?(?: v3)?
icu | 3 | icu licen | icu @
postgresql | 3 | postgresql licen | postgresql @
sleepycat | 3 | sleepycat licen | sleepycat @
json | 3 | good not evil | shall be used for good not evil
json | 4 | json licen | json @
beerware | 3 | beer ware | (?:the )?beer ware @
wtfpl | 2 | do what the | do what the (?:fuck|f) you want to public @
wtfpl | 3 | wtfpl | wtfpl
unlicense | 2 | free and unencumbered | free and unencumbered software released into the public domain
unlicense | 3 | unlicense | (?:the )?unlicense
cc0 | 2 | cc0 | cc0(?: 1 0)? universal
cc0 | 3 | cc0 | cc0(?: 1 0)?
cc0 | 4 | public domain dedication | public domain dedication
public-domain-mark | 3 | public domain mark | public domain mark(?: 1 0)?
public-domain | 5 | public domain | (?:in|to|into) the public domain
pddl-1 | 3 | open data commons public | open data commons public domain dedication(?: and @)?
odc-by-1 | 3 | open data commons attribution | open data commons attribution @
odbl-1 | 3 | open database licen | open database @(?:#1(?: 0)?)?
odbl-1 | 4 | odbl | odbl
cdla-permissive | 3 | community data | community data @ agreement permissive
cdla-sharing | 3 | community data | community data @ agreement sharing
ogl-3 | 3 | open government licen | open government @#3(?: 0)?
ogl | 4 | open government licen | open government @
cc-by-1 | 3 | cc by | cc by#1(?: 0)?
cc-by-2 | 3 | cc by | cc by#2(?: 0)?
cc-by-2.5 | 2 | cc by | cc by#2 5
cc-by-3 | 3 | cc by | cc by#3(?: 0)?
cc-by-4 | 3 | cc by | cc by#4(?: 0)?
cc-by-sa-1 | 2 | cc by sa | cc by sa#1(?: 0)?
cc-by-sa-2 | 2 | cc by sa | cc by sa#2(?: 0)?
cc-by-sa-2.5 | 1 | cc by sa | cc by sa#2 5
cc-by-sa-3 | 2 | cc by sa | cc by sa#3(?: 0)?
cc-by-sa-4 | 2 | cc by sa | cc by sa#4(?: 0)?
cc-by-nd-3 | 2 | cc by nd | cc by nd#3(?: 0)?
cc-by-nd-4 | 2 | cc by nd | cc by nd#4(?: 0)?
cc-by-nc-1 | 2 | cc by nc | cc by nc#1(?: 0)?
cc-by-nc-2 | 2 | cc by nc | cc by nc#2(?: 0)?
cc-by-nc-2.5 | 1 | cc by nc | cc by nc#2 5
cc-by-nc-3 | 2 | cc by nc | cc by nc#3(?: 0)?
cc-by-nc-4 | 2 | cc by nc | cc by nc#4(?: 0)?
cc-by-nc-sa-3 | 1 | cc by nc sa | cc by nc sa#3(?: 0)?
cc-by-nc-sa-4 | 1 | cc by nc sa | cc by nc sa#4(?: 0)?
cc-by-nc-nd-3 | 1 | cc by nc nd | cc by nc nd#3(?: 0)?
cc-by-nc-nd-4 | 1 | cc by nc nd | cc by nc nd#4(?: 0)?
cc-by-sa | 3 | cc by sa | cc by sa
cc-by-nd | 3 | cc by nd | cc by nd
cc-by-nc | 3 | cc by nc | cc by nc
cc-by-nc-sa | 2 | cc by nc sa | cc by nc sa
cc-by-nc-nd | 2 | cc by nc nd | cc by nc nd
cc-by | 4 | cc by | cc by
cc-by-3 | 2 | creative commons attribution | creative commons attribution#3(?: 0)?
cc-by-4 | 2 | creative commons attribution | creative commons attribution#4(?: 0)?
cc-by-sa-3 | 1 | creative commons attribution | creative commons attribution share ?alike#3(?: 0)?
cc-by-sa-4 | 1 | creative commons attribution | creative commons attribution share ?alike#4(?: 0)?
cc-by-nc-4 | 1 | creative commons attribution | creative commons attribution non ?commercial#4(?: 0)?
cc-by-nc-sa-4 | 1 | creative commons attribution | creative commons attribution non ?commercial share ?alike#4(?: 0)?
cc-by-nc-nd-4 | 1 | creative commons attribution | creative commons attribution non ?commercial no ?deriv(?:ative)?s#4(?: 0)?
cc-by-sa | 2 | creative commons attribution | creative commons attribution share ?alike
cc-by-nc | 2 | creative commons attribution | creative commons attribution non ?commercial
cc-by-nd | 2 | creative commons attribution | creative commons attribution no ?deriv(?:ative)?s
cc-by | 4 | creative commons attribution | creative commons attribution
cc | 5 | creative commons | creative commons(?: @)?
blueoak-1 | 3 | blue oak | blue oak model @(?: 1 0 0)?
upl-1 | 3 | universal permissive | universal permissive @(?:#1(?: 0)?)?
apsl-2 | 3 | apple public source | apple public source @(?:#2(?: 0)?)?
qpl-1 | 3 | q public | q public @(?:#1(?: 0)?)?
rpl-1.5 | 3 | reciprocal public | reciprocal public @(?:#1 5)?
sissl | 3 | sun industry standards | sun industry standards source @
spl-1 | 3 | sun public | sun public @(?:#1(?: 0)?)?
wxwindows | 3 | wxwindows | wxwindows library licen[cs]e
mulan-2 | 3 | mulan | mulan psl#2
naist | 3 | naist | naist @
openrail | 3 | openrail | (?:creativeml )?openrail(?: m)?(?: @)?
llama | 4 | llama | llama (?:2 |3 )?community @
spdx | 5 | spdx licen | spdx @ identifier
proprietary | 6 | all rights reserved | all rights reserved
proprietary | 6 | proprietary and confidential | proprietary and confidential
proprietary | 6 | trade secret | contains (?:confidential|proprietary) (?:and )?trade secrets?
"""

_SPELLED = {"@": "licen[cs]e", "#": "(?: version |(?: ?v)? ?)"}


@functools.cache
def rules() -> list[tuple[int, str, str, str]]:
    """(priority, label, keyword, pattern) of all rules, by priority and then as written."""
    out = []
    for line in SIGNATURES.strip().splitlines():
        label, priority, key, pattern = line.split(" | ")
        for mark, spelled in _SPELLED.items():
            pattern = pattern.replace(mark, spelled)
        out.append((int(priority), label, key, pattern))
    return sorted(out, key=lambda r: r[0])


#: Words too common in any prose to tell a licence.
_COMMON = set("the of and or in to any use not this you may for with all be new by is as same at version public general software".split())


def anchors() -> list[str]:
    """A small set of words such that every match of a rule or phrase holds one: greedily, those that most rules need. Words of four letters or more may be parts of words; gpl may have one letter before it."""
    open_ = []
    for _, _, key, rx in rules():
        sure, was = rx.replace(_SPELLED["@"], "licen").replace(_SPELLED["#"], " "), ""
        while sure != was:  # what is not in a group, a class or optional stands in every match
            sure, was = re.sub(r"\(\?:[^()]*\)\??|\[[^]]*\]\??|[^ )\]]\?| \?", " ", sure), sure
        open_.append({*key.split(), *sure.split()})
    open_ = [{w for w in r if len(w) > 1} - _COMMON for r in [*open_, *(set(p.split()) for p in PHRASES.values())]]
    out = []
    while open_:
        hits = {w: [any(w == x or (len(w) > 3 and w in x) or (w == "gpl" and x in ("lgpl", "agpl")) for x in r) for r in open_] for w in {w for r in open_ for w in r}}
        best = max(sorted(hits), key=lambda w: (sum(hits[w]), len(w)))
        out.append(best)
        open_ = [r for r, hit in zip(open_, hits[best]) if not hit]
    return out


def _gate(low: str) -> Column:
    """Whether a lower-cased text holds an anchor: plain substring tests, and for the shortest ones a test of the letters around."""
    out = F.lit(False)
    for w in anchors():
        test = F.contains(F.col(low), F.lit(w))
        if len(w) <= 3:
            test = test & F.col(low).rlike(f"(?<![a-z0-9]){'[al]?' if w == 'gpl' else ''}{w}v?(?:[0-9]|(?![a-z0-9]))")
        out = out | test
    return out


def find_licenses(documents: DataFrame) -> DataFrame:
    """documents with n_words, base (starts of phrases, by label), base_labels, labels and licenses (label, priority, start, end in normalized words' characters) and a score.

    The score is 1 where a base phrase or a versioned rule speaks, less for vaguer rules, 0 without a detection.
    Extra columns stay; those of the added names are replaced. Rows are taken one by one, so repeated rows and null ids are scanned
    each; an empty table stays empty. Long texts, and many detections in one, cost time nearly in proportion.
    """
    plain, back = set_aside(documents, ("doc_id", "text"), ("n_words", "base", "base_labels", "labels", "licenses", "score"))
    raw = F.coalesce("text", F.lit(""))
    df = plain.withColumn("_raw", raw).withColumn("n_words", count_words(F.col("_raw"), GAPS)).withColumn("_low", F.lower("_raw"))
    upper, lower = "".join(map(chr, range(65, 91))), "".join(map(chr, range(97, 123)))
    norm = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.translate("_raw", upper, lower), GAPS, " ")), F.lit(" "))
    df = df.withColumn("_norm", F.when(_gate("_low"), norm)).drop("_low")
    # every place of a phrase: words before it are the blanks before it, less one
    empty = F.array().cast("array<struct<label:string,at:bigint>>")

    def places(label: str, phrase: str) -> Column:
        # a look-ahead leaves the closing blank to the next match
        n = len(phrase.split())

        def found(parts: Column) -> Column:
            ends = running_sum(F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda p: F.length(p) - F.length(F.replace(p, F.lit(" "), F.lit(""))) + n))
            return F.transform(ends, lambda e: F.struct(F.lit(label).alias("label"), (e - n).cast("bigint").alias("at")))

        return F.when(F.col("_norm").contains(f" {phrase} "), let(F.split("_norm", rf" {phrase}(?= )", -1), found)).otherwise(empty)

    df = df.withColumn("base", F.concat(*[places(k, p) for k, p in PHRASES.items()]))
    table = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(p).alias("priority"), F.lit(label).alias("label"), F.lit(key).alias("key"), F.lit(f" {rx}(?= )").alias("rx")) for i, (p, label, key, rx) in enumerate(rules())])
    keys = F.array(*[F.lit(k) for k in sorted({k for _, _, k, _ in rules()})])
    df = df.withColumn("_keys", F.when(F.col("_norm").isNotNull(), F.filter(keys, lambda k: F.contains(F.col("_norm"), F.concat(F.lit(" "), k)))))
    live = F.filter(table, lambda r: F.array_contains("_keys", r["key"]) & F.regexp_like(F.col("_norm"), r["rx"]))

    def detections(r: Column) -> Column:
        hits = placed(F.split(F.col("_norm"), r["rx"], -1), F.regexp_extract_all(F.col("_norm"), r["rx"], F.lit(0)))
        return F.transform(hits, lambda h: F.struct(h["start"].alias("start"), (-h["end"]).alias("back"), r["i"].alias("i"), r["priority"].alias("priority"), h["end"].alias("end"), r["label"].alias("label")))

    kind = "array<struct<start:int,back:int,i:int,priority:int,end:int,label:string>>"
    df = df.withColumn("_found", F.when(F.size("_keys") > 0, F.sort_array(F.flatten(F.transform(live, detections)))).otherwise(F.array()).cast(kind))
    last = max(p for p, _, _, _ in rules())

    def unbeaten(found: Column) -> Column:
        # sorted by start, longest first, earlier rules first: what contains a detection comes before it
        def upto(p: int) -> Column:
            return running_max(F.transform(found, lambda d: F.when(d["priority"] <= p, d["end"])))

        return let(F.array(*[upto(p) for p in range(1, last + 1)]), lambda reach: F.filter(found, lambda d, k: F.coalesce(F.get(F.get(reach, d["priority"] - 1), k - 1) < d["end"], F.lit(True))))

    kept = F.transform(F.when(F.size("_found") > 0, let(F.col("_found"), unbeaten)).otherwise(F.array()).cast(kind), lambda d: F.struct(*[d[c].alias(c) for c in ("priority", "i", "start", "end", "label")]))
    df = df.withColumn("licenses", kept)
    base_labels = F.array_sort(F.array_distinct(F.transform("base", lambda b: b["label"])))
    labels = F.array_sort(F.array_distinct(F.concat(F.transform("base", lambda b: b["label"]), F.transform("licenses", lambda d: d["label"]))))
    best = F.array_max(F.transform("licenses", lambda d: F.lit(1.0) - F.greatest(d["priority"] - 3, F.lit(0)) * 0.2))
    df = df.withColumns({"base_labels": F.array_join(base_labels, ","), "labels": F.array_join(labels, ","), "score": F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).cast("double")})
    return back(df)
