"""Licence scans by sentence rules (DataFrame functions only).

A text becomes a line of normal words (ASCII lower case, everything but letters and digits is a gap) with
boundaries between them: hard ones at ``.``, ``!`` or ``?`` before white space and at empty lines, soft ones at
line breaks and at ``:`` or ``;`` before white space. List numbers ("1.", "(a)") become hard boundaries. Known
sentences start and end at a boundary of either kind and may go over soft ones, so wrapped, commented and
numbered texts match as well as plain ones; each is replaced by its identifier, longest sentences first.

The identifiers found, in text order, form a sequence in which any run of other words leaves a gap; ordered
rules (longest first) consume runs of that sequence, and each run that a rule consumes names a licence. A rule
may allow a gap where licence texts have a line of their own, such as the copyright line.

The scan is one projection over the texts: no shuffle, no Python. Every known sentence has one of a few
stems, derived from the table of sentences; texts with none of them have no known sentence, and are passed
over by plain substring tests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licence texts and notices, with an identifier each.
SENTENCES = {
    "apache_ref": "Licensed under the Apache License, Version 2.0",
    "apache_ref_the_license": 'Licensed under the Apache License, Version 2.0 (the "License")',
    "apache_title": "Apache License Version 2.0, January 2004",
    "apache_no_use": "you may not use this file except in compliance with the License",
    "apache_copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache_copy_https": "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0",
    "apache_as_is": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied',
    "apache_see": "See the License for the specific language governing permissions and limitations under the License",
    "mit_released": "Released under the MIT License",
    "mit_licensed": "Licensed under the MIT License",
    "mit_project": "This project is licensed under the MIT License",
    "mit_title": "MIT License",
    "mit_the_title": "The MIT License (MIT)",
    "mit_grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit_notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit_as_is": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT',
    "isc_title": "ISC License",
    "isc_grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "isc_grant_and": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "zero_bsd_grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "gpl2_free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    "gpl3_ref": "This work is licensed under the GNU General Public License, version 3",
    "gpl3_licensed": "Licensed under the GNU General Public License, version 3",
    "gpl_free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl_hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "gpl_hope_whole": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    "gpl_details": "See the GNU General Public License for more details",
    "gpl_received": "You should have received a copy of the GNU General Public License along with this program",
    "gpl2_received": "You should have received a copy of the GNU General Public License along with this program; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA",
    "lgpl21_free": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version",
    "lgpl3_free": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "agpl3_free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "ccbync4_ref": "Licensed under CC BY-NC 4.0",
    "ccbync4_work": "This work is licensed under CC BY-NC 4.0",
    "ccbync4_long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "ccby4_ref": "Licensed under CC BY 4.0",
    "ccby4_work": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "ccbysa4_ref": "Licensed under CC BY-SA 4.0",
    "ccbysa4_long": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "ccbysa3_long": "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License",
    "cc0_title": "CC0 1.0 Universal",
    "cc0_waived": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide",
    "bsd_redist": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd2_ref": "Licensed under the BSD 2-Clause License",
    "bsd3_ref": "Licensed under the BSD 3-Clause License",
    "bsd2_title": "BSD 2-Clause License",
    "bsd3_title": "BSD 3-Clause License",
    "bsd_source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd_binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd_endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "mpl2_form": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "mpl2_copy": "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/",
    "mpl2_copy_https": "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/",
    "epl2_terms": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0",
    "bsl_distributed": "Distributed under the Boost Software License, Version 1.0",
    "bsl_title": "Boost Software License Version 1.0 August 17th, 2003",
    "unlicense_free": "This is free and unencumbered software released into the public domain",
    "zlib_as_is": "This software is provided 'as-is', without any express or implied warranty",
    "zlib_grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "wtfpl_terms": "You can redistribute it and/or modify it under the terms of the Do What The Fuck You Want To Public License, Version 2, as published by Sam Hocevar",
}
# Licence identifiers that a line "SPDX-License-Identifier: ..." names.
SPDX = "MIT Apache-2.0 BSD-2-Clause BSD-3-Clause ISC 0BSD Zlib MPL-2.0 EPL-2.0 BSL-1.0 Unlicense CC0-1.0 CC-BY-4.0 CC-BY-SA-4.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later AGPL-3.0-only AGPL-3.0-or-later".split()


def spdx_name(licence: str) -> str:
    return "spdx_" + "".join(c if c.isalnum() else "_" for c in licence.lower())


SENTENCES |= {spdx_name(x): f"SPDX-License-Identifier: {x}" for x in SPDX}
#: In a rule, a gap that may stand between two identifiers.
GAP = "~"
RULES = [
    ("Apache-2.0", ["apache_ref_the_license", "apache_no_use", "apache_copy", "apache_as_is", "apache_see"]),
    ("Apache-2.0", ["apache_ref_the_license", "apache_no_use", "apache_copy_https", "apache_as_is", "apache_see"]),
    ("BSD-3-Clause", ["bsd3_title", GAP, "bsd_redist", "bsd_source", "bsd_binary", "bsd_endorse"]),
    ("BSD-3-Clause", ["bsd_redist", "bsd_source", "bsd_binary", "bsd_endorse"]),
    ("BSD-2-Clause", ["bsd2_title", GAP, "bsd_redist", "bsd_source", "bsd_binary"]),
    ("GPL-3.0-or-later", ["gpl_free", "gpl_hope_whole", "gpl_details", "gpl_received"]),
    ("GPL-3.0-or-later", ["gpl_free", "gpl_hope", "gpl_received"]),
    ("GPL-2.0-or-later", ["gpl2_free", "gpl_hope_whole", "gpl_details", "gpl2_received"]),
    ("BSD-2-Clause", ["bsd_redist", "bsd_source", "bsd_binary"]),
    ("MIT", ["mit_title", GAP, "mit_grant", "mit_notice", "mit_as_is"]),
    ("MIT", ["mit_the_title", GAP, "mit_grant", "mit_notice", "mit_as_is"]),
    ("MIT", ["mit_title", GAP, "mit_grant", "mit_notice"]),
    ("MIT", ["mit_the_title", GAP, "mit_grant", "mit_notice"]),
    ("MIT", ["mit_grant", "mit_notice", "mit_as_is"]),
    ("MIT", ["mit_grant", "mit_notice"]),
    ("ISC", ["isc_title", GAP, "isc_grant"]),
    ("Zlib", ["zlib_as_is", GAP, "zlib_grant"]),
    ("MPL-2.0", ["mpl2_form", "mpl2_copy"]),
    ("MPL-2.0", ["mpl2_form", "mpl2_copy_https"]),
    ("GPL-3.0-or-later", ["gpl_free"]),
    ("GPL-2.0-or-later", ["gpl2_free"]),
    ("LGPL-2.1-or-later", ["lgpl21_free"]),
    ("LGPL-3.0-or-later", ["lgpl3_free"]),
    ("AGPL-3.0-or-later", ["agpl3_free"]),
    ("Apache-2.0", ["apache_title"]),
    ("Apache-2.0", ["apache_ref_the_license"]),
    ("Apache-2.0", ["apache_ref"]),
    ("MIT", ["mit_released"]),
    ("MIT", ["mit_licensed"]),
    ("MIT", ["mit_project"]),
    ("MIT", ["mit_the_title"]),
    ("MIT", ["mit_grant"]),
    ("ISC", ["isc_grant"]),
    ("ISC", ["isc_grant_and"]),
    ("0BSD", ["zero_bsd_grant"]),
    ("GPL-3.0-only", ["gpl3_ref"]),
    ("GPL-3.0-only", ["gpl3_licensed"]),
    ("CC-BY-NC-4.0", ["ccbync4_ref"]),
    ("CC-BY-NC-4.0", ["ccbync4_work"]),
    ("CC-BY-NC-4.0", ["ccbync4_long"]),
    ("CC-BY-4.0", ["ccby4_ref"]),
    ("CC-BY-4.0", ["ccby4_work"]),
    ("CC-BY-SA-4.0", ["ccbysa4_ref"]),
    ("CC-BY-SA-4.0", ["ccbysa4_long"]),
    ("CC-BY-SA-3.0", ["ccbysa3_long"]),
    ("CC0-1.0", ["cc0_title"]),
    ("CC0-1.0", ["cc0_waived"]),
    ("BSD-2-Clause", ["bsd2_ref"]),
    ("BSD-2-Clause", ["bsd2_title"]),
    ("BSD-3-Clause", ["bsd3_ref"]),
    ("BSD-3-Clause", ["bsd3_title"]),
    ("MPL-2.0", ["mpl2_form"]),
    ("EPL-2.0", ["epl2_terms"]),
    ("BSL-1.0", ["bsl_distributed"]),
    ("BSL-1.0", ["bsl_title"]),
    ("Unlicense", ["unlicense_free"]),
    ("Zlib", ["zlib_grant"]),
    ("WTFPL", ["wtfpl_terms"]),
    *[(x, [spdx_name(x)]) for x in SPDX],
]
#: Stems tried first; a sentence that has none of them adds its longest word.
COMMON_STEMS = ["licen", "permission", "redistribut", "warrant"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Marks of a hard boundary while a text is put into normal form.
END = "\x01"
_SPACE, _NUMBER = r"[ \t\r\f\n]", "(?:[0-9]{1,2}|[a-z]|[ivx]{1,4})"
#: (pattern, replacement with $1 for the first group) in order; understood alike by Java and RE2.
NORMAL_FORM = [
    (END, " "),
    # An address that is set apart belongs to the sentence before it; "v." is no sentence end.
    (r"\n[^a-z0-9]*(https?:)", " $1"),
    (rf"([^a-z0-9]v)\.({_SPACE}[^a-z0-9]*[0-9])", "$1$2"),
    (rf"(^|\n|[.!?:;]{_SPACE})([^a-z0-9\n]*){_NUMBER}[.)][ \t]", f"$1$2{END}"),
    (rf"[.!?]({_SPACE})", f"{END}$1"),
    (r"\n[^a-z0-9\n]*\n", f"{END}"),
    (r"[:;][ \t]", "\n"),
    (f"[^a-z0-9\n{END}]+", " "),
    # Every boundary is written twice, so that the sentences on both of its sides have one to themselves.
    (END, " ; ; "),
    ("\n", " / / "),
    (" +", " "),
]


def normal(sentence: str) -> str:
    """The normal words of a sentence."""
    low = sentence.translate(str.maketrans(UPPER, LOWER))
    return " ".join("".join(c if c.isascii() and c.isalnum() else " " for c in low).split())


def stems(sentences: dict[str, str]) -> list[str]:
    """Strings of which every sentence with any words has one."""
    found = [s for s in COMMON_STEMS if any(s in normal(x) for x in sentences.values())]
    for x in sentences.values():
        if normal(x) and not any(s in normal(x) for s in found):
            found.append(max(normal(x).split(), key=len))
    return found


def marking(sentences: dict[str, str]) -> str:
    """The pattern, over the normal form, of a boundary, a known sentence and a boundary; long sentences are tried first."""
    known = sorted({tuple(normal(s).split()) for s in sentences.values() if normal(s)}, key=lambda w: (-len(w), w))
    return "([;/]) (" + "|".join(" (?:/ )*".join(words) for words in known) + ") ([;/])"


def by_words(sentences: dict[str, str]) -> dict[str, str]:
    """The identifier, as ``<id>``, of each sentence's normal words; of equal sentences the first counts."""
    found: dict[str, str] = {}
    for name, s in sentences.items():
        found.setdefault(normal(s), f"<{name}>")
    return found


def split_rules(rules: list[tuple[str, list[str]]]) -> tuple[list[tuple[str, str]], dict[str, str]]:
    """(licence, pattern) of the rules of several sentences, longest first, and the licence by identifier of the others."""
    several = sorted((r for r in rules if len(r[1]) > 1), key=lambda r: -sum(p != GAP for p in r[1]))
    single: dict[str, str] = {}
    for name, parts in rules:
        if len(parts) == 1:
            single.setdefault(parts[0], name)
    return [(name, "".join("~?" if p == GAP else f"<{p}>" for p in parts)) for name, parts in several], single


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text", sentences: dict[str, str] = SENTENCES, rules: list[tuple[str, list[str]]] = RULES) -> DataFrame:
    """One row per input row: key, n_known, sequence, licenses, n_matches.

    ``sequence`` has the known sentences' identifiers in text order, ``<id>`` each, with one ``~`` for any
    run of other words (empty if none is known); ``licenses`` the licences of the rules that matched, sorted and
    comma-joined; ``n_matches`` the number of rule matches. Rules of more sentences come first, equal ones in the
    order given. Identifiers are of ``a-z``, ``0-9`` and ``_``. Null and empty texts have no known sentence; very
    long texts are read whole; of sentences that start alike the longest is taken, and repeated ones each count;
    repeated rows give repeated results; an empty table gives no rows; other columns are ignored, whatever
    their names.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    low, worth = F.lower(whole), F.lit(False)
    for stem in stems(sentences):
        worth = worth | low.contains(stem)
    out = F.translate(whole, UPPER, LOWER)
    for pattern, by in NORMAL_FORM:
        out = F.regexp_replace(out, pattern, by)
    out = F.regexp_replace(F.concat(F.lit("; ; "), out, F.lit(" ; ;")), " +", " ")
    marked = F.split(F.regexp_replace(out, marking(sentences), "$1 <$2> $3"), "[<>]")
    known = F.create_map(*[F.lit(x) for pair in by_words(sentences).items() for x in pair])
    told = F.transform(marked, lambda x, i: F.when(i % 2 == 1, F.element_at(known, F.replace(x, F.lit("/ "), F.lit("")))).otherwise(F.when(x.rlike("[a-z0-9]"), F.lit("~")).otherwise(F.lit(""))))
    found = docs.select(F.col(key).alias("doc_id"), F.when(worth, F.array_join(told, "")).otherwise(F.lit("")).alias("found"))
    found = found.select("doc_id", F.when(F.col("found").contains("<"), F.col("found")).otherwise(F.lit("")).alias("sequence"))
    several, single = split_rules(rules)
    counts, names, rest = [F.lit(0)], [], F.col("sequence")
    for i, (name, pattern) in enumerate(several):
        found = found.withColumns({f"m{i}": F.regexp_count(rest, F.lit(pattern)), f"r{i}": F.regexp_replace(rest, pattern, "|")})
        rest = F.col(f"r{i}")
        counts.append(F.col(f"m{i}"))
        names.append(F.when(F.col(f"m{i}") > 0, F.lit(name)))
    licence = F.create_map(*[F.lit(x) for pair in single.items() for x in pair]) if single else F.lit(None).cast("map<string,string>")
    found = found.withColumn("singles", F.array_compact(F.transform(F.regexp_extract_all(rest, F.lit("<([a-z0-9_]+)>"), F.lit(1)), lambda x: F.element_at(licence, x))))
    return found.select(
        "doc_id",
        F.expr("length(sequence) - length(replace(sequence, '<', ''))").cast("long").alias("n_known"),
        "sequence",
        F.array_join(F.array_sort(F.array_distinct(F.concat(F.array_compact(F.array(F.lit(None).cast("string"), *names)), "singles"))), ",").alias("licenses"),
        (sum(counts[1:], counts[0]) + F.size("singles")).cast("long").alias("n_matches"),
    )


def licenses_sql() -> str:
    """DuckDB SQL for ``scan_licenses`` over ``documents``, of every text."""
    quote = lambda s: s.replace("'", "''")
    table = lambda pairs: "MAP {" + ", ".join(f"'{quote(k)}': '{quote(v)}'" for k, v in pairs.items()) + "}"
    replaced = lambda x, p, by: f"regexp_replace({x}, '{quote(p)}', '{by.replace('$', chr(92))}', 'g')"
    several, single = split_rules(RULES)
    steps = [f"s0 AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents)"]
    then = lambda select: steps.append(f"s{len(steps)} AS (SELECT {select} FROM s{len(steps) - 1})")
    for pattern, by in NORMAL_FORM:
        then(f"doc_id, {replaced('t', pattern, by)} AS t")
    outer = "'; ; ' || t || ' ; ;'"
    then(f"doc_id, {replaced(outer, ' +', ' ')} AS t")
    then(f"doc_id, string_split_regex({replaced('t', marking(SENTENCES), '$1 <$2> $3')}, '[<>]') AS parts")
    then(f"doc_id, array_to_string(list_transform(parts, lambda x, i: CASE WHEN i % 2 = 0 THEN map_extract_value({table(by_words(SENTENCES))}, replace(x, '/ ', '')) WHEN regexp_matches(x, '[a-z0-9]') THEN '~' ELSE '' END), '') AS t")
    then("doc_id, CASE WHEN contains(t, '<') THEN t ELSE '' END AS sequence, CASE WHEN contains(t, '<') THEN t ELSE '' END AS t")
    for i, (_, pattern) in enumerate(several):
        then(f"* EXCLUDE (t), {replaced('t', pattern, '|')} AS t, len(regexp_extract_all(t, '{pattern}')) AS m{i}")
    then(f"*, list_filter(list_transform(regexp_extract_all(t, '<([a-z0-9_]+)>', 1), lambda x: map_extract_value({table(single)}, x)), lambda x: x IS NOT NULL) AS singles")
    names = ", ".join(f"CASE WHEN m{i} > 0 THEN '{name}' END" for i, (name, _) in enumerate(several))
    total = " + ".join(f"m{i}" for i in range(len(several)))
    return f"""
WITH {", ".join(steps)}
SELECT doc_id, CAST(length(sequence) - length(replace(sequence, '<', '')) AS BIGINT) AS n_known, sequence,
  array_to_string(list_sort(list_distinct(list_concat(list_filter([{names}], lambda x: x IS NOT NULL), singles))), ',') AS licenses,
  CAST({total} + len(singles) AS BIGINT) AS n_matches
FROM s{len(steps) - 1}
"""
