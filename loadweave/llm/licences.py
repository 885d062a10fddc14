"""Licence scans by sentences and ordered rules, in DataFrame operations only.

A text is cut into sentences three times: at sentence ends and line breaks, at sentence ends and blank lines (for wrapped
text), and at sentence ends, colons and blank lines (for text that goes on after "the following conditions:"). Sentences are normalised (ASCII lower case, runs of other characters as one space) and mapped to identifiers of known
licence sentences through a small constant table. A document's identifiers, in order, are then matched against rules: a
rule names sentences that must follow each other, with other sentences between them as long as none of the steps between
known sentences exceeds MAX_GAP.

Documents without any of the table's key words cannot match and are not cut; each known sentence has such a word.

Cases: null and empty texts match nothing; every row of documents gives one row; rows that share a doc_id but not a text are
told apart by a hash of the text; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table

#: Sentences from one known sentence to the next within a rule, at most.
MAX_GAP = 12
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Names of licences as statements give them.
NAMES = {
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"],
    "MIT": ["MIT License", "MIT Licence"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License", "2-clause BSD license", "FreeBSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License", "Modified BSD License", "3-clause BSD license", "Revised BSD License"],
    "0BSD": ["Zero-Clause BSD License", "BSD Zero Clause License"],
    "ISC": ["ISC License"],
    "MPL-2.0": ["Mozilla Public License, Version 2.0", "Mozilla Public License, v. 2.0", "Mozilla Public License 2.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL v2", "GPLv2", "GPL version 2"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL v3", "GPLv3", "GPL version 3"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "GNU LGPL v2.1", "LGPLv2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "GNU LGPL v3", "LGPLv3"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "GNU AGPL v3", "AGPLv3"],
    "EPL-1.0": ["Eclipse Public License 1.0", "Eclipse Public License v1.0", "Eclipse Public License - v 1.0"],
    "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License v2.0", "Eclipse Public License - v 2.0", "Eclipse Public License v. 2.0"],
    "EUPL-1.2": ["European Union Public Licence 1.2", "European Union Public License 1.2", "EUPL v1.2", "EUPL, Version 1.2"],
    "BSL-1.0": ["Boost Software License 1.0", "Boost Software License, Version 1.0"],
    "Zlib": ["zlib License"],
    "Artistic-2.0": ["Artistic License 2.0"],
    "PostgreSQL": ["PostgreSQL License"],
    "CC0-1.0": ["CC0 1.0", "CC0 1.0 Universal"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC-BY-NC-SA-4.0": ["CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"],
    "Unlicense": ["Unlicense"],
}
# Identifiers that are given in tags only, beside the names above.
TAGS = ("GPL-1.0", "LGPL-2.0", "MPL-1.1", "Apache-1.1", "BSD-4-Clause", "CC-BY-3.0", "CC-BY-SA-3.0", "CC-BY-NC-ND-4.0", "MIT-0", "WTFPL", "Python-2.0", "Ruby", "OFL-1.1", "CDDL-1.0", "NCSA", "BlueOak-1.0.0")
# Endings of identifiers of the GNU family.
ENDINGS = ("-only", "-or-later", "+")
# How statements begin.
LEADS = ("Licensed under", "Released under", "Distributed under", "Published under", "Available under", "This work is licensed under", "This project is licensed under", "This software is licensed under", "This file is licensed under", "This code is licensed under", "This program is licensed under", "This work is released under", "This project is released under", "This software is released under")
# Sentences of licence texts and notices.
SENTENCES = {
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "isc-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-as-is": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    "apache-notice": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache-comply": "you may not use this file except in compliance with the License.",
    "apache-law": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "apache-see": "See the License for the specific language governing permissions and limitations under the License.",
    "gpl-free": "This program is free software:",
    "gpl-free-2": "This program is free software;",
    "gpl3-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl3-whole": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2-either": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation;",
    "gpl2-version": "either version 2 of the License, or (at your option) any later version.",
    "lgpl-either": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation;",
    "lgpl21-version": "either version 2.1 of the License, or (at your option) any later version.",
    "lgpl3-terms": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "lgpl3-whole": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl3-terms": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl3-whole": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "epl2-terms": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "bsl-grant": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "zlib-origin": "The origin of this software must not be misrepresented;",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "mpl-terms": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense-free": "This is free and unencumbered software released into the public domain.",
    "cc0-dedicate": "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law.",
}
# Rules over the sentences, in order.
RULES = [
    ("MIT", ["mit-grant", "mit-notice", "mit-as-is"]),
    ("ISC", ["isc-grant", "isc-as-is"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names", "bsd-as-is"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is"]),
    ("Apache-2.0", ["apache-notice", "apache-comply"]),
    ("Apache-2.0", ["apache-law", "apache-see"]),
    ("GPL-3.0", ["gpl3-terms"]),
    ("GPL-3.0", ["gpl3-whole"]),
    ("GPL-2.0", ["gpl2-either", "gpl2-version"]),
    ("LGPL-2.1", ["lgpl-either", "lgpl21-version"]),
    ("LGPL-3.0", ["lgpl3-terms"]),
    ("LGPL-3.0", ["lgpl3-whole"]),
    ("AGPL-3.0", ["agpl3-terms"]),
    ("AGPL-3.0", ["agpl3-whole"]),
    ("EPL-2.0", ["epl2-terms"]),
    ("BSL-1.0", ["bsl-grant"]),
    ("Zlib", ["zlib-grant", "zlib-origin"]),
    ("MPL-2.0", ["mpl-terms"]),
    ("Unlicense", ["unlicense-free"]),
    ("CC0-1.0", ["cc0-dedicate"]),
]
KEY_WORDS = ("licen", "permission", "copyright", "warrant", "redistribut", "free software", "unencumbered", "public domain", "any later version", "misrepresented", "eupl", "gpl", "cc by", "cc0")


def normalised(sentence: str) -> str:
    return re.sub("[^a-z0-9]+", " ", "".join(_SMALL[_CAPITALS.index(c)] if c in _CAPITALS else c for c in sentence)).strip()


def known_sentences() -> dict[str, str]:
    """Identifier by normalised sentence: the texts above, and each lead before each name, with and without an article."""
    out = {normalised(s): k for k, s in SENTENCES.items()}
    for licence, names in NAMES.items():
        for name in names:
            for lead in LEADS:
                for article in ("", "the ", "a "):
                    out.setdefault(normalised(f"{lead} {article}{name}"), f"says-{licence}")
    for tag in tags():
        # "+" would be lost among other signs.
        out.setdefault(f"{TAG} {normalised(tag.replace('+', ' plus'))}", f"says-{tag}")
    return out


def tags() -> list[str]:
    """Identifiers that a tag may give, alone or joined by OR, AND and WITH."""
    plain = [*NAMES, *TAGS]
    return plain + [x + end for x in plain if re.match("[AL]?GPL-", x) for end in ENDINGS]


def rules() -> list[tuple[str, list[str]]]:
    return [*RULES, *((licence, [f"says-{licence}"]) for licence in dict.fromkeys([*NAMES, *tags()]))]


def _rule_pattern(ids: list[str]) -> str:
    """Matches " id id id # id ": # stands where more than MAX_GAP sentences lie between two known ones."""
    return " " + " ([^#]* )?".join(map(re.escape, ids)).replace("\\-", "-") + " "


# Sentence marks are followed by this sign, which then also stands for line breaks or blank lines.
_CUT = "\x02"
#: The stop of "v. 2.0" ends no sentence: the space after it goes before texts are cut.
_VERSION = "([^A-Za-z0-9][vV]\\.)[ \\t\\r\\n\\f]+([0-9])"
_ENDS, _SPACE = "([.!?;])[ \\t\\r\\n\\f]+", "[ \\t\\r\\f]"
_SPLITS = {"line": "\\n", "paragraph": f"\\n{_SPACE}*\\n"}
#: What stands before each identifier of a tag, in known sentences (where no other has it) and while texts are cut; what a tag's expression is, and what joins its parts.
TAG, _MARK = "#", "\x03"
_TAGGED, _JOINTS = "(?i:spdx-license-identifier:)[ \\t]*([^\\r\\n]*)", "[ \\t()]+(?:OR|AND|WITH)[ \\t()]+"
#: Ends of statements that say where the text is.
_TAIL = " (see|as found in|as described in|refer to|a copy of which is in) (the )?(file )?(license|licence|copying|notice)( file| txt| md)*( for (details|more details|more information|the full text))?$"
#: Sentence ends and breaks of each way of cutting.
_WAYS = {way: (_ENDS, at) for way, at in _SPLITS.items()} | {"colon": (_ENDS.replace(";", ";:"), _SPLITS["paragraph"])}


def _key(text: Column) -> Column:
    return F.struct(F.xxhash64(text).alias("hash"), F.length(text).alias("size"))


def sentences(docs: DataFrame) -> DataFrame:
    """(doc_id, key, way, at, id): the known sentences of each text, by all ways of cutting."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    small = lambda c: F.translate(c, _CAPITALS, _SMALL)
    has = small(F.regexp_replace(text, "[^A-Za-z0-9]+", " ")).rlike("|".join(KEY_WORDS))
    rows = docs.where(small(text).rlike("licen|permission|copyright|warrant|redistribut|software|unencumbered|domain|version|eupl|gpl|cc")).where(has)
    rows = rows.select("doc_id", _key(text).alias("key"), text.alias("text"))
    # Rows repeated in full give the same sentences; they count once here.
    ways = F.explode(F.array(*[F.struct(F.lit(way).alias("way"), F.split(F.regexp_replace(F.regexp_replace(F.regexp_replace("text", _VERSION, "$1$2"), ends, "$1" + _CUT), at, _CUT), _CUT).alias("parts")) for way, (ends, at) in _WAYS.items()]))
    each = rows.select("doc_id", "key", ways.alias("w")).select("doc_id", "key", "w.way", F.posexplode("w.parts").alias("at", "part"))
    # A constant table of some 3000 rows.
    known = spark.createDataFrame(list(known_sentences().items()), T.StructType([T.StructField("sentence", T.StringType()), T.StructField("id", T.StringType())]))
    # A tag is a sentence for each of its identifiers; other parts are one.
    parts = F.transform(F.split(F.regexp_extract("part", _TAGGED, 1), _JOINTS), lambda x: F.concat(F.lit(_MARK), F.replace(x, F.lit("+"), F.lit(" plus"))))
    each = each.select("doc_id", "key", "way", "at", F.explode(F.when(F.col("part").rlike(_TAGGED), parts).otherwise(F.array("part"))).alias("part"))
    sentence = F.regexp_replace(F.trim(F.regexp_replace(small(F.col("part")), "[^a-z0-9]+", " ")), _TAIL, "")
    sentence = F.when(F.col("part").startswith(_MARK), F.concat(F.lit(f"{TAG} "), sentence)).otherwise(sentence)
    return each.withColumn("sentence", sentence).join(F.broadcast(known), "sentence").select("doc_id", "key", "way", "at", "id").distinct()


def scan(docs: DataFrame) -> DataFrame:
    """One row for each row of docs: doc_id, licences (sorted array), n_sentences (known sentences by the way of cutting that found most)."""
    found = sentences(docs).groupBy("doc_id", "key", "way").agg(F.array_sort(F.collect_list(F.struct("at", "id"))).alias("s"))
    size = F.size("s")
    ids = F.transform(F.sequence(F.lit(1), size), lambda k: F.concat(F.when((k > 1) & (F.element_at("s", k)["at"] - F.element_at("s", F.greatest(k - 1, F.lit(1)))["at"] > MAX_GAP), F.lit("# ")).otherwise(F.lit("")), F.element_at("s", k)["id"]))
    line = F.concat(F.lit(" "), F.array_join(ids, " "), F.lit(" "))
    matched = F.array_compact(F.array(*[F.when(F.col("line").rlike(_rule_pattern(r)), F.lit(licence)) for licence, r in rules()]))
    each = found.select("doc_id", "key", size.alias("n"), line.alias("line")).withColumn("m", matched)
    whole = each.groupBy("doc_id", "key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("m")))).alias("licences"), F.max("n").alias("n"))
    whole = whole.select(F.col("doc_id").alias("d"), F.col("key").alias("k"), "licences", "n")
    rows = docs.select("doc_id", _key(F.coalesce(F.col("text"), F.lit(""))).alias("key"))
    joined = rows.join(whole, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")), "left")
    return joined.select("doc_id", F.coalesce("licences", F.array().cast("array<string>")).alias("licences"), F.coalesce("n", F.lit(0)).cast("long").alias("n_sentences"))


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).select("doc_id", F.array_join("licences", ",").alias("licences"), "n_sentences")


_quoted = lambda s: "'" + s.replace("'", "''") + "'"
ORACLE = f"""
WITH known(sentence, id) AS (VALUES {', '.join(f'({_quoted(s)}, {_quoted(k)})' for s, k in known_sentences().items())}),
rule(licence, pattern) AS (VALUES {', '.join(f'({_quoted(licence)}, {_quoted(_rule_pattern(r))})' for licence, r in rules())}),
docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
cut AS ({' UNION ALL '.join(f"SELECT r, '{way}' AS way, string_split(regexp_replace(regexp_replace(regexp_replace(t, '{_VERSION}', '\\1\\2', 'g'), '{ends}', '\\1' || chr(2), 'g'), '{at}', chr(2), 'g'), chr(2)) AS parts FROM docs" for way, (ends, at) in _WAYS.items())}),
whole AS (SELECT r, way, unnest(parts) AS part, unnest(range(len(parts))) AS place FROM cut),
each AS (SELECT r, way, place, unnest(CASE WHEN regexp_matches(part, '{_TAGGED}') THEN list_transform(string_split_regex(regexp_extract(part, '{_TAGGED}', 1), '{_JOINTS}'), lambda x: chr(3) || replace(x, '+', ' plus')) ELSE [part] END) AS part FROM whole),
found AS (SELECT DISTINCT r, way, place, id FROM each JOIN known ON sentence = CASE WHEN starts_with(part, chr(3)) THEN '{TAG} ' ELSE '' END || regexp_replace(trim(regexp_replace(translate(part, '{_CAPITALS}', '{_SMALL}'), '[^a-z0-9]+', ' ', 'g')), '{_TAIL}', '')),
gaps AS (SELECT *, place - lag(place) OVER (PARTITION BY r, way ORDER BY place, id) AS gap FROM found),
lines AS (SELECT r, way, count(*) AS n, ' ' || string_agg(CASE WHEN gap > {MAX_GAP} THEN '# ' ELSE '' END || id, ' ' ORDER BY place, id) || ' ' AS line FROM gaps GROUP BY r, way),
hits AS (SELECT r, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences FROM lines JOIN rule ON regexp_matches(line, pattern) GROUP BY r),
sizes AS (SELECT r, max(n) AS n FROM lines GROUP BY r)
SELECT doc_id, coalesce(licences, '') AS licences, coalesce(n, 0)::BIGINT AS n_sentences FROM docs LEFT JOIN hits USING (r) LEFT JOIN sizes USING (r)
"""

QUERIES = {"op7_licences": op7_licences}
ORACLES = {"op7_licences": ORACLE}
