"""License scans by sentence rules.

A text is cut into sentences, each normalised (A-Z in lower case, white space and quotation marks made plain, comment signs and
closing punctuation taken off). Sentences end at line breaks too, but lines of a paragraph that are no known sentence by
themselves are also read together, as hard-wrapped texts and file headers are. An SPDX expression of several licences is one
sentence for each of them; the exceptions that it names are left out. Sentences that match a known licence sentence as a whole
get its identifier. The sequence of identifiers is then held against ordered licence rules, patterns over identifiers: each rule
takes out what it matches, so a longer licence comes before the shorter ones that it contains. Identifiers that no rule takes are
reported as they are.

Everything is a projection of one scan: no shuffle. Texts without any of the words that every known sentence holds one of are
not cut at all.

Edge cases. Null and empty texts have no sentences and no licence. A licence that stands several times is named once, in the
order of the rules. Repeated rows give equal results; an empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Repetitions of groups are possessive: Java follows others by recursion, and thousands of turns overflow its stack.
# Sentences of public licences, normalised, as patterns; and what every one of them holds at least one of (single
# words, as white space and line breaks may stand between two).
CUE = r"(?i)licen[sc]e|copyright|redistribut|warrant|permission|domain|reserved|liable"
SENTENCES = (
    ("spdx_mit", r"spdx-license-identifier: mit"),
    ("spdx_apache2", r"spdx-license-identifier: apache-2\.0"),
    ("spdx_bsd3", r"spdx-license-identifier: bsd-3-clause"),
    ("spdx_gpl3", r"spdx-license-identifier: gpl-3\.0(-only|-or-later|\+)?"),
    ("spdx_gpl2", r"spdx-license-identifier: gpl-2\.0(-only|-or-later|\+)?"),
    ("spdx_lgpl", r"spdx-license-identifier: lgpl-(2\.1|3\.0)(-only|-or-later|\+)?"),
    ("spdx_agpl3", r"spdx-license-identifier: agpl-3\.0(-only|-or-later)?"),
    ("spdx_mpl2", r"spdx-license-identifier: mpl-2\.0"),
    ("spdx_epl2", r"spdx-license-identifier: epl-2\.0"),
    ("spdx_isc", r"spdx-license-identifier: isc"),
    ("spdx_boost", r"spdx-license-identifier: bsl-1\.0"),
    ("spdx_zlib", r"spdx-license-identifier: zlib"),
    ("spdx_unlicense", r"spdx-license-identifier: unlicense"),
    ("spdx_bsd2", r"spdx-license-identifier: bsd-2-clause"),
    ("copyright", r"copyright (\(c\)|©)? ?[0-9][^,]*(, [0-9]+)*+ .{1,100}|copyright (\(c\)|©) .{1,100}"),
    ("all_rights", r"all rights reserved"),
    ("mit_named", r"(this (work|software|project|program|code) is )?(released|licensed|distributed|available) under (the )?(terms of )?(the )?mit( licen[sc]e)?|licen[sc]e: mit( licen[sc]e)?"),
    ("mit_grant", r"permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files \(the 'software'\), to deal in the software without restriction.*"),
    ("mit_notice", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit_as_is", r"the software is provided 'as is', without warranty of any kind.*"),
    ("mit_liable", r"in no event shall the authors or copyright holders be liable for any claim.*"),
    ("apache2_named", r"(this (work|software|project|program|file|code) is )?(released|licensed|distributed|available) under (the )?(terms of )?(the )?apache licen[sc]e,? version 2(\.0)?( \(the 'license'\))?"),
    ("apache2_comply", r"you may not use this file except in compliance with the license"),
    ("apache2_copy", r"you may obtain a copy of the license at.*"),
    ("apache2_unless", r"unless required by applicable law or agreed to in writing, software distributed under the license is distributed on an 'as is' basis.*"),
    ("apache2_see", r"see the license for the specific language governing permissions and limitations under the license"),
    ("bsd_named", r"(this (work|software|project|program|code) is )?(released|licensed|distributed|available) under (the )?(terms of )?(the )?(new |modified |simplified |3-clause |2-clause )?bsd( 3-clause| 2-clause)? licen[sc]e"),
    ("bsd_grant", r"redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:?"),
    ("bsd_source", r"([0-9]\.? )?redistributions of source code must retain the above copyright notice.*"),
    ("bsd_binary", r"([0-9]\.? )?redistributions in binary form must reproduce the above copyright notice.*"),
    ("bsd_names", r"([0-9]\.? )?neither the name of .{1,100} may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("gpl3_named", r"(this (work|software|project|program|code) is )?(released|licensed|distributed|available) under (the )?(terms of )?(the )?gnu general public licen[sc]e,? (version |v)3(\.0)?( or later)?"),
    ("gpl2_named", r"(this (work|software|project|program|code) is )?(released|licensed|distributed|available) under (the )?(terms of )?(the )?gnu general public licen[sc]e,? (version |v)2(\.0)?( or later)?"),
    ("gpl3_grant", r"this program is free software:? you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation, either version 3 of the license, or \(at your option\) any later version"),
    ("gpl2_grant", r"this program is free software[:;]? you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation[;,] either version 2 of the license, or \(at your option\) any later version"),
    ("gpl_warranty", r"this program is distributed in the hope that it will be useful, but without any warranty.*"),
    ("gpl_see", r"see the gnu general public license for more details"),
    ("gpl_copy", r"you should have received a copy of the gnu general public license along with this program.*"),
    ("lgpl_named", r"(this (work|software|project|program|file|code) is )?(released|licensed|distributed|available) under (the )?(terms of )?(the )?(gnu )?(lgpl|lesser general public licen[sc]e),? ?((version |v)?(2\.1|3)(\.0)?)?( or later)?"),
    ("lgpl_grant", r"this (library|program) is free software[:;]? you can redistribute it and/or modify it under the terms of the gnu lesser general public license as published by the free software foundation[;,] either version (2\.1|3) of the license, or \(at your option\) any later version"),
    ("agpl3_named", r"(this (work|software|project|program|file|code) is )?(released|licensed|distributed|available) under (the )?(terms of )?(the )?(gnu )?(agpl|affero general public licen[sc]e),? ?((version |v)?3(\.0)?)?( or later)?"),
    ("agpl3_grant", r"this program is free software:? you can redistribute it and/or modify it under the terms of the gnu affero general public license as published by the free software foundation, either version 3 of the license, or \(at your option\) any later version"),
    ("mpl2_named", r"(this (work|software|project|program|file|code) is )?(released|licensed|distributed|available) under (the )?(terms of )?(the )?mozilla public licen[sc]e(,? (version |v\.? ?)?2(\.0)?|, v)?"),
    ("mpl2_notice", r"this source code form is subject to the terms of the mozilla public license,? v(\. 2\.0)?"),
    ("epl2_named", r"(this (work|software|project|program|file|code) is )?(released|licensed|distributed|available) under (the )?(terms of )?(the )?eclipse public licen[sc]e,? ?((version |v\.? ?)?2(\.0)?|- v 2\.0)?"),
    ("isc_named", r"(this (work|software|project|program|file|code) is )?(released|licensed|distributed|available) under (the )?(terms of )?(the )?isc licen[sc]e"),
    ("isc_grant", r"permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("isc_as_is", r"the software is provided 'as is' and the author disclaims all warranties with regard to this software.*"),
    ("boost_named", r"(this (work|software|project|program|file|code) is )?(released|licensed|distributed|available) under (the )?(terms of )?(the )?boost software licen[sc]e,? ?(version 1\.0)?|boost software license - version 1\.0.*"),
    ("boost_grant", r"permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license.*"),
    ("zlib_as_is", r"this software is provided 'as-is', without any express or implied warranty"),
    ("zlib_grant", r"permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:?"),
    ("unlicense_free", r"this is free and unencumbered software released into the public domain"),
    ("spdx_other", r"spdx-license-identifier: [a-z0-9.+-]+"),
    ("mit_title", r"(the )?mit licen[sc]e( \(mit\))?"),
    ("apache2_title", r"apache licen[sc]e,? (version )?2\.0(, january 2004.{0,60})?"),
    ("bsd3_title", r"(the )?(bsd 3-clause|3-clause bsd|new bsd|modified bsd) licen[sc]e"),
    ("bsd2_title", r"(the )?(bsd 2-clause|2-clause bsd|simplified bsd) licen[sc]e"),
    ("gpl3_title", r"gnu general public licen[sc]e,? version 3(, 29 june 2007.{0,60})?"),
    ("gpl2_title", r"gnu general public licen[sc]e,? version 2(, june 1991.{0,60})?"),
    ("mpl2_title", r"mozilla public licen[sc]e,? (version )?2\.0"),
    ("isc_title", r"(the )?isc licen[sc]e"),
    ("unlicense_title", r"the unlicense"),
    ("cc_by_nc4", r"(this (work|text|article|page|content) is )?licensed under (a )?(the )?(cc by-nc|creative commons attribution-noncommercial)( international)? 4\.0( international)?( license)?"),
    ("cc_by_nc_nd4", r"(this (work|text|article|page|content) is )?licensed under (a )?(the )?(cc by-nc-nd|creative commons attribution-noncommercial-noderivatives)( international)? 4\.0( international)?( license)?"),
    ("cc_by_sa4", r"(this (work|text|article|page|content) is )?licensed under (a )?(the )?(cc by-sa|creative commons attribution-sharealike)( international)? 4\.0( international)?( license)?"),
    ("cc_by4", r"(this (work|text|article|page|content) is )?licensed under (a )?(the )?(cc by|creative commons attribution)( international)? 4\.0( international)?( license)?"),
    ("cc0", r"(this (work|text|data) is )?(released|dedicated|placed) (in|in)?to the public domain.*"),
)
# Licence rules in order; each is a pattern over identifiers, which all end in a comma.
RULES = (
    ("MIT", r"(mit_title,)?(copyright,)?(all_rights,)?(mit_named,)?(mit_grant,)(mit_notice,)(mit_as_is,)(mit_liable,)?"),
    ("BSD-3-Clause", r"(bsd3_title,)?(copyright,)?(all_rights,)?(bsd_grant,)(bsd_source,)(bsd_binary,)(bsd_names,)|bsd3_title,"),
    ("BSD-2-Clause", r"(bsd2_title,)?(copyright,)?(all_rights,)?(bsd_grant,)(bsd_source,)(bsd_binary,)|bsd2_title,"),
    ("Apache-2.0", r"(copyright,)?(apache2_named,)(apache2_comply,)?(apache2_copy,)?(apache2_unless,)?(apache2_see,)?|apache2_title,|spdx_apache2,"),
    ("GPL-3.0", r"(copyright,)?(gpl3_grant,)(gpl_warranty,)?(gpl_see,)?(gpl_copy,)?|gpl3_named,|gpl3_title,|spdx_gpl3,"),
    ("GPL-2.0", r"(copyright,)?(gpl2_grant,)(gpl_warranty,)?(gpl_see,)?(gpl_copy,)?|gpl2_named,|gpl2_title,|spdx_gpl2,"),
    ("MIT", r"mit_title,|mit_named,|spdx_mit,|(mit_grant,)(mit_notice,)?"),
    ("BSD", r"bsd_named,|bsd_grant,|spdx_bsd3,|spdx_bsd2,"),
    ("LGPL", r"(copyright,)?(lgpl_grant,)(gpl_warranty,)?|lgpl_named,|spdx_lgpl,"),
    ("AGPL-3.0", r"(copyright,)?(agpl3_grant,)(gpl_warranty,)?|agpl3_named,|spdx_agpl3,"),
    ("MPL-2.0", r"mpl2_notice,|mpl2_title,|mpl2_named,|spdx_mpl2,"),
    ("EPL-2.0", r"epl2_named,|spdx_epl2,"),
    ("ISC", r"(isc_title,)?(isc_named,)?(copyright,)?(isc_grant,)(isc_as_is,)?|isc_title,|isc_named,|spdx_isc,"),
    ("BSL-1.0", r"(boost_named,)?(boost_grant,)|boost_named,|spdx_boost,"),
    ("Zlib", r"(copyright,)?(zlib_as_is,)(zlib_grant,)|spdx_zlib,"),
    ("Unlicense", r"unlicense_title,|unlicense_free,|spdx_unlicense,"),
    ("CC-BY-NC-4.0", r"cc_by_nc4,"),
    ("CC-BY-NC-ND-4.0", r"cc_by_nc_nd4,"),
    ("CC-BY-SA-4.0", r"cc_by_sa4,"),
    ("CC-BY-4.0", r"cc_by4,"),
    ("Public-Domain", r"cc0,"),
    ("Proprietary", r"(copyright,)?all_rights,"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ“”\"‘’`", "abcdefghijklmnopqrstuvwxyz''''''"
_CUT = r"([.!?])[\x20\x09-\x0D]+"
_SPACE = r"[\x20\x09-\x0D]+"
_BEFORE, _AFTER = " *#/;<>|-", " .!?*/#;<>|-"


#: A line that begins an item of a list.
_ITEM = r"^(?:[0-9]{1,3}[.)]?$|(?:[0-9]{1,3}|[a-z])[.)] |\([0-9a-z]{1,3}\) )"
_BREAK = r"\x0D\x0A|[\x0A\x0D]"
# an SPDX expression: what comes before it, what goes, and what stands between its licences
_SPDX = "spdx-license-identifier: "
_SPDX_GOES, _SPDX_BETWEEN = r"[()]| with [a-z0-9.+-]+", r" (and|or) "


def pieces(text: Column) -> Column:
    """Array of the normalised sentences and lines; an empty one stands wherever more than one line ends."""
    plain = F.regexp_replace(F.translate(text, _UPPER, _LOWER), _BREAK, "\n")
    cut = F.split(F.regexp_replace(plain, _CUT, "$1\n\n"), "\n", -1)
    clean = F.transform(cut, lambda s: F.rtrim(F.ltrim(F.regexp_replace(s, _SPACE, " "), F.lit(_BEFORE)), F.lit(_AFTER)))
    named = lambda s: F.split(F.regexp_replace(F.regexp_replace(s, _SPDX_GOES, ""), _SPDX_BETWEEN, "\n" + _SPDX), "\n", -1)
    return F.flatten(F.transform(clean, lambda s: F.when(s.startswith(_SPDX), named(s)).otherwise(F.array(s))))


def _name(s: Column) -> Column:
    out = F
    for key, pattern in SENTENCES:
        out = out.when(s.rlike(f"^(?:{pattern})$"), key)
    return out


def identifiers(text: Column) -> Column:
    """Identifiers of the licence sentences, in order, each with a comma after it.

    A piece that is a known sentence is one. Those between are joined, but not over an empty one, a colon or the beginning of
    a list item, and sought again. In the text that is put together capitals are marks, as sentences have none.
    """

    def placed(p: Column) -> Column:
        item = F.when(p == "", "\n").when(p.rlike(_ITEM), F.concat(F.lit("\n"), p)).when(p.endswith(":"), F.concat(F.lit("J"), p, F.lit("\n")))
        return F.coalesce(F.concat(F.lit("\nI"), _name(p), F.lit("\n")), item.otherwise(F.concat(F.lit("J"), p)))

    units = F.split(F.array_join(F.transform(pieces(text), placed), ""), "\n", -1)
    joined = lambda u: F.when(u.rlike("[^J]J"), _name(F.ltrim(F.translate(u, "J", " "))))
    found = F.transform(units, lambda u: F.when(u.startswith("I"), F.substr(u, F.lit(2))).otherwise(joined(u)))
    return F.concat_ws("", F.transform(F.filter(found, lambda x: x.isNotNull()), lambda x: F.concat(x, F.lit(","))))


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, sentences (identifiers), licenses, unmatched (identifiers that no rule took) of each row; lists are comma-joined."""
    ids = F.when(F.col("text").rlike(CUE), identifiers(F.col("text"))).otherwise("")
    out = docs.select("doc_id", F.coalesce(ids, F.lit("")).alias("ids"))
    named, rest = [], F.concat(F.lit(","), F.col("ids"))
    out = out.withColumn("rest0", rest)
    for i, (license, pattern) in enumerate(RULES):
        whole = f",({pattern})++"
        named.append(F.when(F.col(f"rest{i}").rlike(whole), license))
        out = out.withColumn(f"rest{i + 1}", F.regexp_replace(f"rest{i}", whole, ",#,"))
    unmatched = F.array_compact(F.transform(F.split(f"rest{len(RULES)}", ",", -1), lambda x: F.when(~x.isin("", "#"), x)))
    licenses = F.array_distinct(F.array_compact(F.array(*named)))
    return out.select("doc_id", F.regexp_replace("ids", ",$", "").alias("sentences"), F.concat_ws(",", licenses).alias("licenses"), F.concat_ws(",", unmatched).alias("unmatched"))


def oracle() -> str:
    """The same in DuckDB SQL, from the same fixed values."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    name = lambda s: "CASE " + " ".join(f"WHEN regexp_full_match({s}, {quote(p.replace(')*+', ')*'))}) THEN {quote(k)}" for k, p in SENTENCES) + " END"
    rests = "".join(f", x{i + 1} AS (SELECT *, regexp_replace(rest{i}, {quote(f',({p})+')}, ',#,', 'g') AS rest{i + 1} FROM x{i})" for i, (_, p) in enumerate(RULES))
    names = ", ".join(f"CASE WHEN regexp_matches(rest{i}, {quote(f',({p})+')}) THEN {quote(n)} END" for i, (n, p) in enumerate(RULES))
    first = " ".join(f"WHEN {quote(n)} THEN {i}" for i, n in reversed(list(enumerate(n for n, _ in RULES))))
    return rf"""
WITH c AS (SELECT doc_id, list_transform(string_split(regexp_replace(regexp_replace(translate(coalesce(text, ''), {quote(_UPPER)}, {quote(_LOWER)}), '{_BREAK}', chr(10), 'g'),
    '{_CUT}', '\1' || chr(10) || chr(10), 'g'), chr(10)), lambda s: rtrim(ltrim(regexp_replace(s, '{_SPACE}', ' ', 'g'), '{_BEFORE}'), '{_AFTER}')) AS lines FROM documents),
p AS (SELECT doc_id, flatten(list_transform(lines, lambda s: CASE WHEN starts_with(s, '{_SPDX}')
    THEN string_split(regexp_replace(regexp_replace(s, '{_SPDX_GOES}', '', 'g'), '{_SPDX_BETWEEN}', chr(10) || '{_SPDX}', 'g'), chr(10)) ELSE [s] END)) AS lines FROM c),
u AS (SELECT doc_id, string_split(array_to_string(list_transform(lines, lambda s: coalesce(chr(10) || 'I' || {name('s')} || chr(10),
    CASE WHEN s = '' THEN chr(10) WHEN regexp_matches(s, '{_ITEM}') THEN chr(10) || s WHEN ends_with(s, ':') THEN 'J' || s || chr(10) ELSE 'J' || s END)), ''), chr(10)) AS units FROM p),
j AS (SELECT doc_id, list_transform(units, lambda u: CASE WHEN starts_with(u, 'I') THEN u WHEN regexp_matches(u, '[^J]J') THEN 'N' || ltrim(replace(u, 'J', ' '), ' ') END) AS units FROM u),
i AS (SELECT doc_id, list_filter(list_transform(units, lambda u: CASE WHEN starts_with(u, 'I') THEN u[2:] ELSE {name('u[2:]')} END), lambda s: s IS NOT NULL) AS ids FROM j),
x0 AS (SELECT doc_id, array_to_string(ids, ',') AS sentences, ',' || CASE WHEN len(ids) > 0 THEN array_to_string(ids, ',') || ',' ELSE '' END AS rest0 FROM i){rests},
n AS (SELECT *, list_sort(list_distinct(list_transform(list_filter([{names}], lambda s: s IS NOT NULL), lambda s: {{'place': CASE s {first} END, 'name': s}}))) AS names FROM x{len(RULES)})
SELECT doc_id, sentences, coalesce(array_to_string(list_transform(names, lambda s: s.name), ','), '') AS licenses,
  array_to_string(list_filter(string_split(rest{len(RULES)}, ','), lambda s: s NOT IN ('', '#')), ',') AS unmatched FROM n"""
