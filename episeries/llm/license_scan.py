"""Licence recognition by sentence rules.

A text is cut into pieces: at line ends, and after a full stop, exclamation or question mark
before white space, but not after abbreviations. List marks at the start of a line go, and
pieces are normalised (letters and digits in lower case, one space between words), so that
comment marks vanish. A sentence begins where a piece begins and ends where one ends, and may
run over any number of pieces: wrapped lines are joined as far as a known sentence reaches.
Sentences are looked up among known licence sentences, each with an identifier; of those that
begin at one piece the longest counts, and one that lies within another does not.

A document's identifiers, in order, are matched against licence rules in their order: a rule is
a sequence of identifiers with nothing else known between them, and a place that one rule has
taken is not free for later ones. Known sentences that no rule takes are reported as unmatched.

Both tables are fixed values of this module, about a hundred entries, so the lookup is a
broadcast of proven size. Pieces are looked up where they lie by the first two words; only
pieces that begin like a known sentence move.

Defined cases: NULL and empty texts have no finding. Repeated rows are distinct documents if their
ids differ; rows that share an id are reported together, each sentence at each position once. An
empty table gives no rows. A wrapped line that begins with a number and a stop loses both as a
list mark. Other columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from episeries.functions.textnum import bind

# Identifiers of sentences and the sentences, normalised.
SENTENCES = [
    ("apache-short", "licensed under the apache license version 2 0"),
    ("apache-grant", "licensed under the apache license version 2 0 the license"),
    ("apache-use", "you may not use this file except in compliance with the license"),
    ("apache-copy", "you may obtain a copy of the license at"),
    ("apache-asis", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("apache-see", "see the license for the specific language governing permissions and limitations under the license"),
    ("mit-short", "released under the mit license"),
    ("mit-short", "licensed under the mit license"),
    ("mit-title", "mit license"),
    ("mit-title", "the mit license"),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("mit-notice", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit-asis", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("gpl3-short", "this work is licensed under the gnu general public license version 3"),
    ("gpl3-short", "licensed under the gnu general public license version 3"),
    ("gpl-free", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl2-free", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("gpl-hope", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("gpl-see", "see the gnu general public license for more details"),
    ("bsd-grant", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-notice", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd-binary", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd-name", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("mit-liable", "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("gpl-copy", "you should have received a copy of the gnu general public license along with this program"),
    ("lgpl21-free", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version"),
    ("lgpl3-free", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("lgpl-hope", "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("lgpl-see", "see the gnu lesser general public license for more details"),
    ("lgpl-copy", "you should have received a copy of the gnu lesser general public license along with this library"),
    ("agpl-free", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("agpl-see", "see the gnu affero general public license for more details"),
    ("agpl-copy", "you should have received a copy of the gnu affero general public license along with this program"),
    ("bsd-asis", "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"),
    ("bsd-liable", "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"),
    ("isc-grant", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("isc-asis", "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"),
    ("isc-liable", "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software"),
    ("isc-title", "isc license"),
    ("mpl-terms", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-copy", "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0"),
    ("mpl-copy", "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0"),
    ("epl-terms", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0"),
    ("epl-terms", "this program and the accompanying materials are made available under the terms of the eclipse public license v 2 0 which is available at https www eclipse org legal epl 2 0"),
    ("unlicense-free", "this is free and unencumbered software released into the public domain"),
    ("unlicense-anyone", "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"),
    ("zlib-asis", "this software is provided as is without any express or implied warranty"),
    ("zlib-liable", "in no event will the authors be held liable for any damages arising from the use of this software"),
    ("zlib-grant", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions"),
    ("zlib-origin", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("zlib-product", "if you use this software in a product an acknowledgment in the product documentation would be appreciated but is not required"),
    ("zlib-altered", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("zlib-notice", "this notice may not be removed or altered from any source distribution"),
    ("bsl-title", "boost software license version 1 0"),
    ("bsl-short", "distributed under the boost software license version 1 0"),
    ("bsl-grant", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following"),
    ("ccbysa-short", "licensed under cc by sa 4 0"),
    ("ccbysa-work", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("ccby-work", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("ccbync-work", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("ccbync-short", "licensed under cc by nc 4 0"),
    ("ccby-short", "licensed under cc by 4 0"),
    ("cc0-short", "this work is dedicated to the public domain under cc0 1 0"),
]

# Licences and the sequences that stand for them, the most telling first.
RULES = [
    ("Apache-2.0", ["apache-grant", "apache-use", "apache-copy", "apache-asis", "apache-see"]),
    ("Apache-2.0", ["apache-grant", "apache-use"]),
    ("Apache-2.0", ["apache-asis", "apache-see"]),
    ("Apache-2.0", ["apache-short"]),
    ("MIT", ["mit-title", "mit-grant", "mit-notice", "mit-asis", "mit-liable"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-asis", "mit-liable"]),
    ("MIT", ["mit-title", "mit-grant", "mit-notice", "mit-asis"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-asis"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("MIT", ["mit-short"]),
    ("MIT", ["mit-title"]),
    ("AGPL-3.0-or-later", ["agpl-free", "gpl-hope", "agpl-see", "agpl-copy"]),
    ("AGPL-3.0-or-later", ["agpl-free", "gpl-hope", "agpl-see"]),
    ("AGPL-3.0-or-later", ["agpl-free"]),
    ("LGPL-2.1-or-later", ["lgpl21-free", "lgpl-hope", "lgpl-see", "lgpl-copy"]),
    ("LGPL-2.1-or-later", ["lgpl21-free", "lgpl-hope", "lgpl-see"]),
    ("LGPL-2.1-or-later", ["lgpl21-free"]),
    ("LGPL-3.0-or-later", ["lgpl3-free", "lgpl-hope", "lgpl-see", "lgpl-copy"]),
    ("LGPL-3.0-or-later", ["lgpl3-free", "lgpl-hope", "lgpl-see"]),
    ("LGPL-3.0-or-later", ["lgpl3-free"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-hope", "gpl-see", "gpl-copy"]),
    ("GPL-2.0-or-later", ["gpl2-free", "gpl-hope", "gpl-see", "gpl-copy"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-hope", "gpl-see"]),
    ("GPL-3.0-or-later", ["gpl-free"]),
    ("GPL-2.0-or-later", ["gpl2-free", "gpl-hope", "gpl-see"]),
    ("GPL-2.0-or-later", ["gpl2-free"]),
    ("GPL-3.0", ["gpl3-short"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-notice", "bsd-binary", "bsd-name", "bsd-asis", "bsd-liable"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-notice", "bsd-binary", "bsd-asis", "bsd-liable"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-notice", "bsd-binary", "bsd-name"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-notice", "bsd-binary"]),
    ("ISC", ["isc-title", "isc-grant", "isc-asis", "isc-liable"]),
    ("ISC", ["isc-grant", "isc-asis", "isc-liable"]),
    ("ISC", ["isc-grant"]),
    ("ISC", ["isc-title"]),
    ("MPL-2.0", ["mpl-terms", "mpl-copy"]),
    ("MPL-2.0", ["mpl-terms"]),
    ("EPL-2.0", ["epl-terms"]),
    ("Unlicense", ["unlicense-free", "unlicense-anyone"]),
    ("Unlicense", ["unlicense-free"]),
    ("Zlib", ["zlib-asis", "zlib-liable", "zlib-grant", "zlib-origin", "zlib-product", "zlib-altered", "zlib-notice"]),
    ("Zlib", ["zlib-asis", "zlib-liable", "zlib-grant"]),
    ("BSL-1.0", ["bsl-title", "bsl-grant"]),
    ("BSL-1.0", ["bsl-grant"]),
    ("BSL-1.0", ["bsl-short"]),
    ("BSL-1.0", ["bsl-title"]),
    ("CC-BY-NC-4.0", ["ccbync-short"]),
    ("CC-BY-NC-4.0", ["ccbync-work"]),
    ("CC-BY-SA-4.0", ["ccbysa-short"]),
    ("CC-BY-SA-4.0", ["ccbysa-work"]),
    ("CC-BY-4.0", ["ccby-short"]),
    ("CC-BY-4.0", ["ccby-work"]),
    ("CC0-1.0", ["cc0-short"]),
]

# Every licence may also be named by its tag.
_NAMES = sorted({name for name, _ in RULES})
SENTENCES += [(f"tag-{name}", "spdx license identifier " + re.sub("[^a-z0-9]+", " ", name.lower()))
              for name in _NAMES]
RULES += [(name, [f"tag-{name}"]) for name in _NAMES]

#: Words of the longest known sentence: it runs over at most as many pieces.
LONGEST = max(len(sentence.split()) for _, sentence in SENTENCES)
#: Each known sentence has one of these; texts without any need not be cut.
TELLING = r"(?i)licen|permission|software|redistribution|copyright|public|program|cc|the mpl|warrant|notice|liable"

# What is replaced, in this order, to normalise a text; line ends stay as cuts. No part looks
# behind or ahead, so that other engines read them alike.
CUTS = [
    # list and comment marks at the start of a line
    (r"(^|\n)[^a-z0-9\n]*((([0-9]{1,2}|[a-h]|i{1,3}|iv)[.)]|rem|dnl)[\x20\t]+)?", r"\n"),
    # stops after abbreviations
    (r"([^a-z0-9])(v|ver|vs|cf|e\.g|i\.e)\.", "{1}{2} "),
    (r"[.!?][\x20\t\r]+", r"\n"),
    (r"[^a-z0-9\n]+", " "),
]


def pieces_of(text: Column) -> Column:
    """The normalised pieces of a text, in order, none empty."""
    for pattern, with_ in CUTS:
        text = F.regexp_replace(F.lower(text) if pattern == CUTS[0][0] else text, pattern,
                                with_.replace(r"\n", "\n").replace("{", "$").replace("}", ""))
    return F.filter(F.transform(F.split(text, "\n"), lambda piece: F.trim(piece)), lambda piece: piece != "")


def known_sentences(spark: SparkSession, sentences: list = SENTENCES) -> DataFrame:
    values = ", ".join(f"('{i}', '{s}', '{' '.join(s.split()[:2])}', {len(s.split())})"
                       for i, s in sentences)
    return spark.sql(f"SELECT DISTINCT * FROM VALUES {values} AS t(identifier, sentence, opening, words)")


def found_sentences(docs: DataFrame) -> DataFrame:
    """(doc_id, pos, end, identifier): known sentences from piece ``pos`` up to before ``end``."""
    openings = sorted({" ".join(s.split()[:2]) for _, s in SENTENCES})

    def opened(pieces: Column) -> Column:
        at = F.transform(pieces, lambda piece, i: F.struct(
            i.alias("pos"), F.substring_index(F.concat_ws(" ", piece, F.get(pieces, i + 1)), " ", 2)
            .alias("opening")))
        return F.transform(
            F.filter(at, lambda x: x["opening"].isin(openings)),
            lambda x: F.struct(x["pos"].alias("pos"), x["opening"].alias("opening"),
                               F.slice(pieces, x["pos"] + 1, LONGEST).alias("near")))

    begun = docs.filter(F.col("text").rlike(TELLING)).select(
        "doc_id", F.inline(bind(pieces_of(F.col("text")), opened)))
    met = begun.join(F.broadcast(known_sentences(docs.sparkSession)), "opening").filter(
        F.array_join("near", " ").startswith(F.col("sentence")))
    sized = met.withColumn("size", F.expr(
        "get(filter(sequence(1, size(near)), k -> array_join(slice(near, 1, k), ' ') = sentence), 0)"))
    longest = sized.filter("size IS NOT NULL").groupBy("doc_id", "pos").agg(
        F.max(F.struct("words", "identifier", "size")).alias("best"))
    ends = longest.select("doc_id", "pos", (F.col("pos") + F.col("best.size")).alias("end"),
                          F.col("best.identifier").alias("identifier"))
    # a document's known sentences; bounded by the document
    before = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return ends.withColumn("reached", F.max("end").over(before)).filter(
        "reached IS NULL OR reached < end").drop("reached")


def matched(identifiers: Column, rules: list = RULES) -> Column:
    """``identifiers`` as text with each rule's places replaced by its licence.

    The text is ' a b c '; a licence found is written as ' =Name '.
    """
    out = identifiers
    for licence, sequence in rules:
        out = F.regexp_replace(out, f" (?:{' '.join(sequence)})(?= )", f" ={licence}")
    return out


def licenses(docs: DataFrame) -> DataFrame:
    """One row per document with a finding: doc_id, identifiers, licenses (distinct, in order
    of first place), n_sentences, n_unmatched (known sentences that no rule took)."""
    listed = found_sentences(docs).groupBy("doc_id").agg(F.array_sort(F.collect_list(
        F.struct("pos", "identifier"))).alias("found"))
    ordered = listed.select("doc_id", F.col("found.identifier").alias("identifiers"))
    text = F.concat(F.lit(" "), F.array_join("identifiers", " "), F.lit(" "))
    parts = ordered.withColumn("parts", F.split(F.trim(matched(text)), " "))
    return parts.select(
        "doc_id", F.array_join("identifiers", ",").alias("identifiers"),
        F.expr("array_join(array_distinct(transform(filter(parts, p -> p LIKE '=%'), "
               "p -> substr(p, 2))), ',')").alias("licenses"),
        F.size("identifiers").cast("long").alias("n_sentences"),
        F.expr("CAST(size(filter(parts, p -> NOT p LIKE '=%')) AS bigint)").alias("n_unmatched"),
    )


def licenses_sql() -> str:
    """SQL of ``licenses`` over ``documents``."""
    values = ", ".join(f"('{i}', '{s}', '{' '.join(s.split()[:2])}', {len(s.split())})"
                       for i, s in SENTENCES)
    cut = "lower(text)"
    for pattern, with_ in CUTS:
        with_ = "chr(10)" if with_ == r"\n" else "'" + re.sub("[{](.)[}]", r"\\\1", with_) + "'"
        cut = f"regexp_replace({cut}, '{pattern}', {with_}, 'g')"
    text = "' ' || array_to_string(ids, ' ') || ' '"
    for licence, sequence in RULES:
        # no lookahead there: the space behind is written back, twice for neighbours
        for _ in range(2):
            text = f"regexp_replace({text}, ' (?:{' '.join(sequence)}) ', ' ={licence} ', 'g')"
    return f"""
    WITH known AS (SELECT DISTINCT * FROM (VALUES {values}) t(identifier, sentence, opening, words)),
    cut AS (SELECT doc_id, [trim(p) for p in string_split({cut}, chr(10)) if trim(p) <> ''] AS pieces FROM documents WHERE text IS NOT NULL),
    placed AS (SELECT doc_id, pieces, unnest(range(len(pieces))) AS pos FROM cut),
    opened AS (SELECT doc_id, pieces, pos, regexp_extract(
        concat_ws(' ', pieces[pos + 1], pieces[pos + 2]), '^[^ ]+ [^ ]+') AS opening FROM placed),
    sized AS (SELECT doc_id, pos, words, identifier, [k for k in range(1, {LONGEST} + 1)
            if array_to_string(pieces[pos + 1:pos + k], ' ') = sentence][1] AS size
        FROM opened JOIN known USING (opening)),
    longest AS (SELECT doc_id, pos, max({{'words': words, 'identifier': identifier, 'size': size}}) AS best
        FROM sized WHERE size IS NOT NULL GROUP BY doc_id, pos),
    ends AS (SELECT doc_id, pos, pos + best.size AS stop, best.identifier AS identifier FROM longest),
    found AS (SELECT * FROM ends QUALIFY coalesce(max(stop) OVER (PARTITION BY doc_id ORDER BY pos
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) < stop),
    listed AS (SELECT doc_id, list(identifier ORDER BY pos) AS ids FROM found GROUP BY doc_id),
    parted AS (SELECT doc_id, ids, string_split(trim({text}), ' ') AS parts FROM listed)
    SELECT doc_id, array_to_string(ids, ',') AS identifiers,
        array_to_string([p[2:] for p, i in parts
            if p[1] = '=' AND list_position(parts, p) = i], ',') AS licenses,
        len(ids) AS n_sentences,
        len([p for p in parts if p[1] <> '=']) AS n_unmatched FROM parted"""
