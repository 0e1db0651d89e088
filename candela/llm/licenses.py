"""Licence scans by sentence rules.

A text is split into sentences (at ``.``, ``!``, ``?``, ``;`` or ``:`` before
white space, and at lines without letters or digits); a single line end is
white space, so wrapped texts are read like unwrapped ones. Where a sentence of
several lines isn't known, each of its lines is one, as notices often stand on
a line of their own without a point. A sentence is normalised (lower case, runs of
anything but letters, digits, ``+`` and inner points to one space, trimmed)
and looked up among known licence sentences. The sequence of identifiers found
in a document, in order and with other sentences left out, is matched against
licence rules: ordered lists of identifiers that must stand next to each other
in that sequence. A rule wins over the shorter rules it contains.

The two tables below are literals of fixed size inside the plan, so nothing is
shuffled or broadcast: every document is judged where it is read.

Defined results: a null or empty text has no sentence and no licence; texts
without a known sentence give empty arrays; repeated rows are judged alike;
null ids pass through; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Known licence sentences, normalised, and their identifiers.
SENTENCES = {
    "released under the mit license": "mit-notice",
    "licensed under the mit license": "mit-notice",
    "this project is licensed under the mit license": "mit-notice",
    "the mit license": "mit-title",
    "mit license": "mit-title",
    "the mit license mit": "mit-title",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction": "mit-grant",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-condition",
    "the software is provided as is without warranty of any kind express or implied": "as-is",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "as-is",
    "licensed under the apache license version 2.0": "apache-2-notice",
    "licensed under the apache license version 2.0 the license": "apache-2-notice",
    "released under the apache license version 2.0": "apache-2-notice",
    "you may not use this file except in compliance with the license": "apache-2-compliance",
    "you may obtain a copy of the license at": "apache-2-copy",
    "you may obtain a copy of the license at http www apache org licenses license 2.0": "apache-2-copy",
    "you may obtain a copy of the license at https www apache org licenses license 2.0": "apache-2-copy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache-2-warranty",
    "this work is licensed under the gnu general public license version 3": "gpl-3-notice",
    "licensed under the gnu general public license version 3": "gpl-3-notice",
    "released under the gnu general public license version 3": "gpl-3-notice",
    "this work is licensed under the gnu general public license version 2": "gpl-2-notice",
    "licensed under the gnu general public license version 2": "gpl-2-notice",
    "this program is free software": "gpl-free",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl-terms",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl-3-terms",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl-2-terms",
    "either version 3 of the license or at your option any later version": "gpl-3-later",
    "either version 2 of the license or at your option any later version": "gpl-2-later",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-endorse",
    "licensed under the bsd license": "bsd-notice",
    "released under the bsd license": "bsd-notice",
    "licensed under cc by 4.0": "cc-by-notice",
    "this work is licensed under a creative commons attribution 4.0 international license": "cc-by-notice",
    "licensed under cc by sa 4.0": "cc-by-sa-notice",
    "this work is licensed under a creative commons attribution sharealike 4.0 international license": "cc-by-sa-notice",
    "licensed under cc by nc 4.0": "cc-by-nc-notice",
    "this work is licensed under a creative commons attribution noncommercial 4.0 international license": "cc-by-nc-notice",
    "licensed under cc by nd 4.0": "cc-by-nd-notice",
    "licensed under cc0 1.0": "cc0-notice",
    "this work is dedicated to the public domain": "public-domain",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "bsd-warranty",
    "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage": "bsd-liability",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "no-claim",
    "isc license": "isc-title",
    "the isc license": "isc-title",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness": "isc-warranty",
    "this source code form is subject to the terms of the mozilla public license v": "mpl-2-header",
    "this source code form is subject to the terms of the mozilla public license version 2.0": "mpl-2-header",
    "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2.0": "mpl-2-copy",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2.0": "mpl-2-copy",
    "licensed under the mozilla public license version 2.0": "mpl-2-notice",
    "released under the mozilla public license version 2.0": "mpl-2-notice",
    "this library is free software": "lgpl-free",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2.1 of the license or at your option any later version": "lgpl-2.1-terms",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "lgpl-3-terms",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation": "lgpl-terms",
    "either version 2.1 of the license or at your option any later version": "lgpl-2.1-later",
    "licensed under the gnu lesser general public license version 2.1": "lgpl-2.1-notice",
    "licensed under the gnu lesser general public license version 3": "lgpl-3-notice",
    "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "agpl-3-terms",
    "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation": "agpl-terms",
    "licensed under the gnu affero general public license version 3": "agpl-3-notice",
    "this program and the accompanying materials are made available under the terms of the eclipse public license v1.0 which accompanies this distribution and is available at http www eclipse org legal epl v10 html": "epl-1-header",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2.0 which is available at https www eclipse org legal epl 2.0": "epl-2-header",
    "this is free and unencumbered software released into the public domain": "unlicense-title",
    "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means": "unlicense-grant",
    "this software is provided as is without any express or implied warranty": "zlib-warranty",
    "in no event will the authors be held liable for any damages arising from the use of this software": "zlib-liability",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "zlib-grant",
    "boost software license version 1.0": "bsl-1-title",
    "boost software license version 1.0 august 17th 2003": "bsl-1-title",
    "distributed under the boost software license version 1.0": "bsl-1-notice",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following": "bsl-1-grant",
    "all rights reserved": "reserved",
}

# Ordered rules, licence and the identifiers in order.
RULES = (
    ("MIT", ("mit-title", "mit-grant", "mit-condition", "as-is")),
    ("MIT", ("mit-title", "mit-grant", "mit-condition")),
    ("MIT", ("mit-grant", "mit-condition", "as-is")),
    ("MIT", ("mit-grant", "mit-condition")),
    ("MIT", ("mit-notice",)),
    ("MIT", ("mit-title",)),
    ("Apache-2.0", ("apache-2-notice", "apache-2-compliance", "apache-2-copy", "apache-2-warranty")),
    ("Apache-2.0", ("apache-2-notice", "apache-2-compliance")),
    ("Apache-2.0", ("apache-2-notice",)),
    ("GPL-3.0", ("gpl-free", "gpl-terms", "gpl-3-later")),
    ("GPL-3.0", ("gpl-free", "gpl-3-terms")),
    ("GPL-3.0", ("gpl-3-notice",)),
    ("GPL-2.0", ("gpl-free", "gpl-terms", "gpl-2-later")),
    ("GPL-2.0", ("gpl-free", "gpl-2-terms")),
    ("GPL-2.0", ("gpl-2-notice",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("BSD", ("bsd-notice",)),
    ("ISC", ("isc-title", "isc-grant", "isc-warranty")),
    ("ISC", ("isc-grant", "isc-warranty")),
    ("ISC", ("isc-grant",)),
    ("ISC", ("isc-title",)),
    ("MPL-2.0", ("mpl-2-header", "mpl-2-copy")),
    ("MPL-2.0", ("mpl-2-header",)),
    ("MPL-2.0", ("mpl-2-notice",)),
    ("LGPL-2.1", ("lgpl-free", "lgpl-terms", "lgpl-2.1-later")),
    ("LGPL-2.1", ("lgpl-free", "lgpl-2.1-terms")),
    ("LGPL-2.1", ("lgpl-2.1-terms",)),
    ("LGPL-2.1", ("lgpl-2.1-notice",)),
    ("LGPL-3.0", ("lgpl-free", "lgpl-terms", "gpl-3-later")),
    ("LGPL-3.0", ("lgpl-free", "lgpl-3-terms")),
    ("LGPL-3.0", ("lgpl-3-terms",)),
    ("LGPL-3.0", ("lgpl-3-notice",)),
    ("AGPL-3.0", ("gpl-free", "agpl-terms", "gpl-3-later")),
    ("AGPL-3.0", ("gpl-free", "agpl-3-terms")),
    ("AGPL-3.0", ("agpl-3-notice",)),
    ("EPL-1.0", ("epl-1-header",)),
    ("EPL-2.0", ("epl-2-header",)),
    ("Unlicense", ("unlicense-title", "unlicense-grant")),
    ("Unlicense", ("unlicense-title",)),
    ("Zlib", ("zlib-warranty", "zlib-liability", "zlib-grant")),
    ("Zlib", ("zlib-grant",)),
    ("BSL-1.0", ("bsl-1-title", "bsl-1-grant")),
    ("BSL-1.0", ("bsl-1-grant",)),
    ("BSL-1.0", ("bsl-1-title",)),
    ("BSL-1.0", ("bsl-1-notice",)),
    ("CC-BY-4.0", ("cc-by-notice",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-notice",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-notice",)),
    ("CC-BY-ND-4.0", ("cc-by-nd-notice",)),
    ("CC0-1.0", ("cc0-notice",)),
    ("Public-Domain", ("public-domain",)),
    ("Proprietary", ("reserved",)),
)

#: Where sentences part, lines left whole; one class for all that may follow, as Java recurses on repeated groups.
SENTENCE_BREAK = r"\n[^A-Za-z0-9]*\n|[.!?;:][ \t\r\n]+"
#: Lines and sentences of a sentence that isn't known as a whole. Java and RE2 read all of these patterns alike.
BREAK = r"\n+|[.!?;:][ \t\r\n]+"
JUNK = r"[^a-z0-9.+]+"
POINTS = r"(^|[^0-9])[.]+|[.]+($|[^0-9])"


def normalised(sentence: Column) -> Column:
    lower = F.lower(sentence)
    words = F.regexp_replace(F.regexp_replace(lower, JUNK, " "), POINTS, "$1 $2")
    return F.trim(F.regexp_replace(words, " +", " "))


def sentence_ids(text: Column, sentences: dict[str, str] = SENTENCES) -> Column:
    """The identifiers of the known sentences of ``text``, in order."""
    known = F.create_map(*[F.lit(x) for pair in sentences.items() for x in pair])
    # Normalising adds nothing to a sentence, so shorter ones can't be known. Nearly all sentences are unknown: a hash
    # set tells, and the map, which is searched key by key, is only asked for the others.
    shortest = min(map(len, sentences))
    none = F.array().cast("array<string>")

    def parts(whole: Column, at: str) -> Column:
        return F.transform(F.filter(F.split(whole, at), lambda s: F.length(s) >= shortest), lambda s: F.struct(s.alias("s"), normalised(s).alias("n")))

    def lines(sentence: Column) -> Column:
        hits = F.filter(parts(sentence, BREAK), lambda p: p["n"].isin(*sentences))
        return F.when(F.contains(sentence, F.lit("\n")), F.transform(hits, lambda p: known[p["n"]])).otherwise(none)

    hits = F.transform(parts(text, SENTENCE_BREAK), lambda p: F.when(p["n"].isin(*sentences), F.array(known[p["n"]])).otherwise(lines(p["s"])))
    return F.flatten(hits)


def marked(sequence) -> str:
    return "".join(f"<{i}>" for i in sequence)


def rule_matches(ids: Column, rules=RULES) -> Column:
    """The rules met, as ``licence:length`` strings, those contained in a met longer rule of the licence left out."""
    line = F.array_join(F.transform(ids, lambda i: F.concat(F.lit("<"), i, F.lit(">"))), "")
    found = []
    for licence, sequence in rules:
        own = marked(sequence)
        longer = {marked(s) for _, s in rules if len(s) > len(sequence) and own in marked(s)}
        rest = line
        for text in sorted(longer, key=lambda x: (-len(x), x)):
            rest = F.replace(rest, F.lit(text), F.lit("|"))
        found.append(F.when(F.contains(rest, F.lit(own)), F.lit(f"{licence}:{len(sequence)}")))
    return F.filter(F.array(*found), lambda r: r.isNotNull())


def license_scan(docs: DataFrame, sentences: dict[str, str] = SENTENCES, rules=RULES) -> DataFrame:
    """Per document the known sentences in order, the rules met and the licences (sorted, distinct)."""
    ids = docs.select("doc_id", sentence_ids(F.coalesce("text", F.lit("")), sentences).alias("sentence_ids"))
    met = ids.withColumn("rules", rule_matches(F.col("sentence_ids"), rules))
    licences = F.array_sort(F.array_distinct(F.transform("rules", lambda r: F.split_part(r, F.lit(":"), F.lit(1)))))
    return met.withColumn("licenses", licences)


def license_scan_digest(docs: DataFrame) -> DataFrame:
    """The scan with its arrays as comma-joined strings."""
    scan = license_scan(docs)
    joined = [F.array_join(c, ",").alias(c) for c in ("sentence_ids", "rules", "licenses")]
    return scan.select("doc_id", F.size("sentence_ids").cast("long").alias("n_known"), *joined)


def license_scan_sql() -> str:
    """The digest in DuckDB SQL."""

    def text(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    known = f"MAP([{', '.join(map(text, SENTENCES))}], [{', '.join(map(text, SENTENCES.values()))}])"
    shortest = min(map(len, SENTENCES))

    def norm(x: str) -> str:
        lower = f"regexp_replace(regexp_replace(lower({x}), {text(JUNK)}, ' ', 'g'), {text(POINTS)}, '\\1 \\2', 'g')"
        return f"trim(regexp_replace({lower}, ' +', ' ', 'g'))"

    def parts(x: str, at: str, name: str) -> str:
        return f"list_filter(string_split_regex({x}, {text(at)}), lambda {name}: length({name}) >= {shortest})"

    # A sentence that isn't known and holds line ends is read line by line.
    lines = f"list_transform({parts('s', BREAK, 'v')}, lambda t: {known}[{norm('t')}])"
    sentence = f"CASE WHEN {known}[{norm('s')}] IS NOT NULL THEN [{known}[{norm('s')}]] WHEN contains(s, chr(10)) THEN {lines} ELSE []::VARCHAR[] END"
    whole = "coalesce(text, '')"
    found = f"flatten(list_transform({parts(whole, SENTENCE_BREAK, 'u')}, lambda s: {sentence}))"
    cases = []
    for licence, sequence in RULES:
        rest, own = "line", marked(sequence)
        for longer in sorted({marked(s) for _, s in RULES if len(s) > len(sequence) and own in marked(s)}, key=lambda x: (-len(x), x)):
            rest = f"replace({rest}, {text(longer)}, '|')"
        cases.append(f"CASE WHEN contains({rest}, {text(own)}) THEN {text(f'{licence}:{len(sequence)}')} END")
    return f"""
WITH ids AS (
  SELECT doc_id, list_filter({found}, lambda i: i IS NOT NULL) AS ids FROM documents),
lines AS (SELECT *, coalesce(array_to_string(list_transform(ids, lambda i: '<' || i || '>'), ''), '') AS line FROM ids),
met AS (SELECT *, list_filter([{', '.join(cases)}], lambda r: r IS NOT NULL) AS rules FROM lines)
SELECT doc_id, len(ids)::BIGINT AS n_known, array_to_string(ids, ',') AS sentence_ids,
  array_to_string(rules, ',') AS rules,
  array_to_string(list_sort(list_distinct(list_transform(rules, lambda r: split_part(r, ':', 1)))), ',') AS licenses
FROM met"""
