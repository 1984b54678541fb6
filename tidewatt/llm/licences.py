"""License scans (operator 7), with DataFrame functions only.

Every whole text is cut into lines and sentences. Candidate headers are windows of one to eight of
them in a row that begin at one with a cue word of the templates, or just before it, so that wrapped
headers are compared whole and long lines in parts. Longer headers are met by windows of 16, 32 and so
on, up to the whole text; of these, the first cue in each eighth of a window's length begins one, so
that all of a length have eight times the text at most. Of a file that is named like a licence file
the whole text is one more candidate. Candidates and templates, headers, titles and whole licences,
are sparse TF-IDF vectors, with the logarithm of a term's count; the document frequencies count the whole texts of all files. Where a
candidate's cosine to a template reaches the threshold, the part of its vector that the template
explains, cosine times length, is what it weighs: of all candidates of a file the heaviest decides, so a
line that is equal to a short template yields to a whole licence around it. A directory has the licence
of the licence files in it. A file without a licence of its own inherits from its nearest ancestor
directory that has one, by joins on paths. Only directories are expanded into their ancestors, never files.

A null text has no licence of its own; a null path belongs to no directory and inherits nothing.
Ties go to the licence, then path, that sorts first. Rows that repeat a path are files of their own
with equal results for equal texts. Tables without rows give none; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatt.llm.lasting import lasting

_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code "
    "must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this "
    "list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD3 = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
_FREE = "This program is free software: you can redistribute it and/or modify it under the terms of the {0} as published by the Free Software Foundation, either version {1} of the License, or (at your option) any later version."
_LIBRARY = "This library is free software; you can redistribute it and/or modify it under the terms of the {0} as published by the Free Software Foundation; either version {1} of the License, or (at your option) any later version."
_DOCUMENT = "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version {0} or any later version published by the Free Software Foundation; with no Invariant Sections, no Front-Cover Texts, and no Back-Cover Texts."
_TITLE = "{0} Version {1} Copyright (C) Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."
#: Fixed texts: what headers, titles and whole licences say, by SPDX identifier.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License.",
    ],
    "MIT": [
        "Released under the MIT License", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS "
        "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES "
        "OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "GPL-1.0": [
        "This work is licensed under the GNU General Public License, version 1", _FREE.format("GNU General Public License", 1), _TITLE.format("GNU GENERAL PUBLIC LICENSE", "1, February 1989"), "GNU GENERAL PUBLIC LICENSE Version 1, February 1989",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2", _FREE.format("GNU General Public License", 2), _TITLE.format("GNU GENERAL PUBLIC LICENSE", "2, June 1991"), "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3", _FREE.format("GNU General Public License", 3), _TITLE.format("GNU GENERAL PUBLIC LICENSE", "3, 29 June 2007"), "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    ],
    "LGPL-2.0": [
        "Licensed under the GNU Library General Public License, version 2", _LIBRARY.format("GNU Library General Public License", 2), _TITLE.format("GNU LIBRARY GENERAL PUBLIC LICENSE", "2, June 1991"), "GNU LIBRARY GENERAL PUBLIC LICENSE Version 2, June 1991",
    ],
    "LGPL-2.1": [
        "Licensed under the GNU Lesser General Public License, version 2.1", _LIBRARY.format("GNU Lesser General Public License", 2.1), _TITLE.format("GNU LESSER GENERAL PUBLIC LICENSE", "2.1, February 1999"), "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    ],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3", _LIBRARY.format("GNU Lesser General Public License", 3), "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007", _FREE.format("GNU Lesser General Public License", 3), _TITLE.format("GNU LESSER GENERAL PUBLIC LICENSE", "3, 29 June 2007")],
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3", _FREE.format("GNU Affero General Public License", 3), _TITLE.format("GNU AFFERO GENERAL PUBLIC LICENSE", "3, 19 November 2007")],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "MPL-1.1": [
        "MOZILLA PUBLIC LICENSE Version 1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1",
        "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "https://www.mozilla.org/MPL/ Software distributed under the License is distributed on an \"AS IS\" basis, WITHOUT WARRANTY OF ANY KIND, either express or implied. See the License for the specific language "
        "governing rights and limitations under the License.",
    ],
    "GFDL-1.2": ["GNU Free Documentation License Version 1.2, November 2002", _TITLE.format("GNU Free Documentation License", "1.2, November 2002"), _DOCUMENT.format("1.2")],
    "GFDL-1.3": ["GNU Free Documentation License Version 1.3, 3 November 2008", _TITLE.format("GNU Free Documentation License", "1.3, 3 November 2008"), _DOCUMENT.format("1.3")],
    "Artistic-1.0": [
        "The \"Artistic License\" Preamble The intent of this document is to state the conditions under which a Package may be copied, such that the Copyright Holder maintains some semblance of artistic control over the "
        "development of the package, while giving the users of the package the right to use and distribute the Package in a more-or-less customary fashion, plus the right to make reasonable modifications.",
        "Released under the Artistic License",
    ],
    "CC0-1.0": [
        "Creative Commons Legal Code CC0 1.0 Universal", "Creative Commons CC0 1.0 Universal Public Domain Dedication", "To the extent possible under law, the author has dedicated all copyright and related rights to the public domain under CC0 1.0",
        "The laws of most jurisdictions throughout the world automatically confer exclusive Copyright and Related Rights (defined below) upon the creator and subsequent owner(s) (each and all, an \"owner\") of an original work of "
        "authorship and/or a database (each, a \"Work\").",
    ],
    "BSD-2-Clause": [_BSD2 + _WARRANTY],
    "BSD-3-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", _BSD2 + _BSD3 + _WARRANTY],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License, CC BY 4.0"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0, Creative Commons Attribution ShareAlike"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0"],
    "Proprietary": ["All rights reserved"],
}
#: Words of which every template has one; windows begin at them.
CUES = ("license", "licensed", "licence", "licenced", "permission", "redistribution", "rights")
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)([._-].*)?$"
THRESHOLD = 0.6
#: Windows: how many lines before a cue they begin, and how many they have; longer ones double from LONGER on.
WINDOWS = ((0, 1), (0, 2), (0, 4), (0, 8), (1, 2), (1, 4))
LONGER = 16
WORD = r"[a-z0-9]+(?:[.][0-9]+)*"


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def candidates(text: Column, is_licence: Column) -> Column:
    """The distinct texts of a file that are compared with the templates."""
    cue = "(?i)" + "|".join(CUES)
    lines = F.filter(F.split(F.regexp_replace(text, "([.;]) +", "$1\n"), "\n"), lambda x: x != "")

    def windows(own: Column) -> Column:
        starts = F.filter(F.transform(own, lambda x, i: F.when(x.rlike(cue), i)), lambda i: i.isNotNull())
        each = lambda i: F.array(*[F.array_join(F.slice(own, F.greatest(i - back, F.lit(0)) + 1, n), " ") for back, n in WINDOWS])
        joined = lambda first, n: F.array_join(F.slice(own, first + 1, n), " ")
        lengths = F.filter(F.array(*[F.lit(LONGER << k) for k in range(24)]), lambda n: n < 2 * F.size(own))

        def long(n: Column) -> Column:
            part = lambda i: F.floor(i / (n / 8))
            first = F.filter(starts, lambda i, k: (k == 0) | (part(i) > part(F.get(starts, k - 1))))
            return F.transform(first, lambda i: joined(i, n))

        headers = F.concat(F.flatten(F.transform(starts, each)), F.flatten(F.transform(lengths, long)))
        return F.array_distinct(F.when(is_licence & (F.size(own) > 0), F.array_append(headers, F.array_join(own, " "))).otherwise(headers))

    return F.transform(F.array(lines), windows)[0]


def scan(files: DataFrame, templates: dict[str, list[str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """id, path, own_license, score (cosine), license, inherited_from (a directory, or null).

    files: id, path, text. Templates are few and short, so their weights and the frequencies of
    their terms are bounded and broadcast.
    """
    spark = files.sparkSession
    templates = TEMPLATES if templates is None else templates
    files = files.select("id", "path", "text")
    shelf = spark.createDataFrame([(k, i, t) for k, texts in templates.items() for i, t in enumerate(texts)], "license string, template int, text string")
    counted = shelf.select("license", "template", F.explode(terms(F.col("text"))).alias("term")).groupBy("license", "template", "term").agg(F.count("*").alias("tf"))
    vocabulary = sorted({r["term"] for r in counted.select("term").distinct().collect()})
    is_licence = F.coalesce(F.substring_index("path", "/", -1).rlike(LICENCE_FILE), F.lit(False))
    # Checkpointed, so that the numbers of the rows stay.
    units = lasting(files.select(F.monotonically_increasing_id().alias("_u"), "id", "path", is_licence.alias("_is"), candidates(F.col("text"), is_licence).alias("_lines")))
    n = units.count()
    # How many files have a term of the templates, of whole texts.
    seen = files.select(F.explode(F.array_distinct(terms(F.col("text")))).alias("term"))
    seen = seen.join(F.broadcast(spark.createDataFrame([(v,) for v in vocabulary], "term string")), "term", "left_semi").groupBy("term").agg(F.count("*").alias("df"))
    idf = lasting(F.broadcast(spark.createDataFrame([(v,) for v in vocabulary], "term string")).join(seen, "term", "left").select("term", (F.log((n + 1.0) / (F.coalesce("df", F.lit(0)) + 1.0)) + 1.0).alias("idf")))
    rare = float(_ln(n + 1.0) + 1.0)
    weights = counted.join(F.broadcast(idf), "term").withColumn("w", (1 + F.log("tf")) * F.col("idf"))
    norms = weights.groupBy("license", "template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    weights = lasting(weights.join(norms, ["license", "template"]).select("license", "template", "term", (F.col("w") / F.col("norm")).alias("share")).coalesce(1))

    tf = units.select("_u", F.posexplode("_lines").alias("_k", "line")).select("_u", "_k", F.explode(terms(F.col("line"))).alias("term")).groupBy("_u", "_k", "term").agg(F.count("*").alias("tf"))
    tf = tf.join(F.broadcast(idf), "term", "left").withColumn("w", (1 + F.log("tf")) * F.coalesce("idf", F.lit(rare)))
    length = tf.groupBy("_u", "_k").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
    dots = tf.where("idf is not null").join(F.broadcast(weights), "term").groupBy("_u", "_k", "license", "template").agg(F.sum(F.col("w") * F.col("share")).alias("dot"))
    score = F.round(F.col("dot") / F.col("length"), 6)
    # The heaviest of those that reach the threshold; without any, the nearest.
    weight = F.when(score >= threshold, F.round("dot", 6)).otherwise(-1.0)
    scored = dots.join(length, ["_u", "_k"]).select("_u", "license", (-weight).alias("w"), (-score).alias("s"))
    own = scored.groupBy("_u").agg(F.min(F.struct("w", "s", "license")).alias("m")).select("_u", F.col("m.license").alias("license"), (-F.col("m.s")).alias("score"))
    marked = units.select("_u", "id", "path", "_is", _directory(F.col("path")).alias("dir")).join(own, "_u", "left")
    marked = marked.withColumn("own_license", F.when(F.col("score") >= threshold, F.col("license"))).drop("license")
    marked = lasting(marked)

    declared = marked.where("_is and own_license is not null and dir is not null")
    declared = declared.groupBy("dir").agg(F.min(F.struct((-F.col("score")).alias("s"), "path", "own_license")).alias("m")).select("dir", F.col("m.own_license").alias("given"))
    parts = F.split("dir", "/")
    ladder = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    steps = marked.where("dir is not null").select("dir").distinct().select("dir", F.explode(F.when(F.col("dir") == "", F.array(F.lit(""))).otherwise(ladder)).alias("above"))
    nearest = steps.join(declared.withColumnRenamed("dir", "above"), "above")
    nearest = nearest.groupBy("dir").agg(F.max(F.struct(F.length("above").alias("l"), "above", "given")).alias("m")).select("dir", F.col("m.above").alias("from"), F.col("m.given").alias("given"))
    # Written, so that the files of a directory that has very many can be split in the join.
    out = marked.join(lasting(nearest), "dir", "left")
    inherits = F.col("own_license").isNull() & F.col("given").isNotNull()
    return out.select("id", "path", "own_license", F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("own_license", "given").alias("license"), F.when(inherits, F.when(F.col("from") == "", "/").otherwise(F.col("from"))).alias("inherited_from"))


def _directory(path: Column) -> Column:
    """All before the last /; "" is the root."""
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, "/[^/]*$", "")).when(path.isNotNull(), "")


def _ln(x: float) -> float:
    import math

    return math.log(x)


def oracle(threshold: float = THRESHOLD) -> str:
    """The query of the catalogue as DuckDB SQL."""
    shelf = ", ".join("('{}', {}, '{}')".format(k, i, t.replace("'", "''")) for k, texts in TEMPLATES.items() for i, t in enumerate(texts))
    cue = "(?i)" + "|".join(CUES)
    words = f"unnest(regexp_extract_all(lower({{}}), '{WORD}'))".format
    windows = ", ".join(map(str, WINDOWS))
    return f"""with f as (select doc_id, text, '/' || coalesce(source, 'none') || '/' || coalesce(lang, 'none') dir, coalesce(regexp_matches(lower(list_last(string_split(text, chr(10)))), 'licen[cs]e|rights'), false) is_file, list_filter(string_split(regexp_replace(text, '([.;]) +', '\\1' || chr(10), 'g'), chr(10)), lambda x: x <> '') lines from documents),
 shelf(license, template, body) as (values {shelf}), counted as (select license, template, term, count(*) tf from (select license, template, {words("body")} term from shelf) group by all),
 cues as (select doc_id, lines, i from (select doc_id, lines, unnest(range(len(lines))) i from f) where regexp_matches(lines[i + 1], '{cue}')),
 texts as (select doc_id, array_to_string(lines[greatest(i - back, 0) + 1 : greatest(i - back, 0) + n], ' ') line from cues, (values {windows}) w(back, n)
  union select doc_id, array_to_string(any_value(lines)[min(i) + 1 : min(i) + n], ' ') from cues join (select cast({LONGER} * pow(2, range) as bigint) n from range(24)) on n < 2 * len(lines) group by doc_id, n, i // (n // 8) union select doc_id, array_to_string(lines, ' ') from f where is_file and len(lines) > 0),
 units as (select doc_id, line, row_number() over () k from texts), n as (select count(*) n from documents),
 tf as (select doc_id, k, term, count(*) tf from (select doc_id, k, {words("line")} term from units) group by all),
 seen as (select term, count(distinct doc_id) df from (select doc_id, {words("text")} term from f) where term in (select term from counted) group by 1),
 idf as (select term, ln((n.n + 1.0) / (coalesce(df, 0) + 1.0)) + 1.0 idf from (select distinct term from counted) v left join seen using (term) cross join n),
 w as (select license, template, term, (1 + ln(c.tf)) * i.idf w from counted c join idf i using (term)), share as (select license, template, term, w / sqrt(sum(w * w) over (partition by license, template)) share from w),
 tw as (select doc_id, k, term, (1 + ln(tf.tf)) * coalesce(idf, ln(n.n + 1.0) + 1.0) w from tf left join idf using (term) cross join n), long as (select k, sqrt(sum(w * w)) l from tw group by all),
 scored as (select t.doc_id, s.license, round(sum(t.w * s.share) / any_value(long.l), 6) score, round(sum(t.w * s.share), 6) dot from tw t join share s using (term) join long on long.k = t.k group by t.doc_id, t.k, s.license, s.template),
 own as (select doc_id, license, score from scored qualify row_number() over (partition by doc_id order by case when score >= {threshold} then dot else -1 end desc, score desc, license) = 1),
 marked as (select f.doc_id, dir, is_file, dir || '/' || case when is_file then 'LICENSE' else f.doc_id || '.txt' end path, case when score >= {threshold} then license end own_license, coalesce(score, 0.0) score from f left join own using (doc_id)),
 given as (select dir, own_license given from marked where is_file and own_license is not null qualify row_number() over (partition by dir order by score desc, path, own_license) = 1),
 near as (select m.dir, g.dir "from", g.given from (select distinct dir from marked) m join given g on g.dir = m.dir or g.dir = '' or starts_with(m.dir, g.dir || '/') qualify row_number() over (partition by m.dir order by length(g.dir) desc) = 1)
 select doc_id, path, own_license, score, coalesce(own_license, given) license, case when own_license is null and given is not null then case when "from" = '' then '/' else "from" end end inherited_from from marked left join near using (dir)"""
