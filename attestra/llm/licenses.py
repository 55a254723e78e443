"""License scan by canonical digest lookup, in DataFrame functions only.

A text is brought to canonical form (ASCII case, copyright lines, equivalent spellings, punctuation and white space) and its
SHA-256 is joined to the digests of known licence texts in the same form. Whole texts are compared, so a licence inside a
longer text is no match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A line that only states copyright: the word with a year, sign, name mark or placeholder behind it, or a sign or reservation first.
COPYRIGHT_LINE = r"\n[ \t]*(?:copyright[ \t]*(?:[:<\[{]|\(c\)|©|by |[12][0-9][0-9][0-9]|[^\n]* (?:\(c\)|©|[12][0-9][0-9][0-9]))|\(c\)|©|all rights reserved)[^\n]*"
#: A first line that names a licence and is no sentence.
TITLE = r"^\s*[^\n.;,]{0,60}\blicen[sc]e\b[^\n.;,]{0,40}\n"
#: What separates words: ASCII white space, control characters and punctuation, and typographic marks.
BETWEEN = r"[\x00-\x2f\x3a-\x60\x7b-\x7f“”‘’«»–—…•·©]+"
#: Equivalent spellings (fixed values, after the matching guidelines for licence lists).
SPELLINGS = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact", "authorisation": "authorization",
    "authorised": "authorized", "calibre": "caliber", "cancelled": "canceled", "capitalisations": "capitalizations", "catalogue": "catalog",
    "categorise": "categorize", "centre": "center", "emphasised": "emphasized", "favour": "favor", "favourite": "favorite", "fulfil": "fulfill",
    "fulfilment": "fulfillment", "initialise": "initialize", "judgement": "judgment", "labelling": "labeling", "labour": "labor", "licence": "license",
    "maximise": "maximize", "modelled": "modeled", "modelling": "modeling", "offence": "offense", "optimise": "optimize", "organisation": "organization",
    "organise": "organize", "practise": "practice", "programme": "program", "realise": "realize", "recognise": "recognize", "signalling": "signaling",
    "sublicence": "sublicense", "sub license": "sublicense", "sub licence": "sublicense", "utilisation": "utilization", "whilst": "while",
    "wilful": "willful", "non commercial": "noncommercial", "per cent": "percent", "copyright owner": "copyright holder", "http": "https",
}

_PERMISSION = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
_ISC_WARRANTY = 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n\n"
_BSD_THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n\n"
_BSD_WARRANTY = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
#: Known licence texts, without titles and copyright lines (fixed values).
KNOWN = {
    "MIT": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n' + _PERMISSION,
    "MIT-0": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.\n\n' + _PERMISSION,
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _ISC_WARRANTY,
    "0BSD": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\n" + _ISC_WARRANTY,
    "BSD-2-Clause": _BSD_HEAD + _BSD_WARRANTY,
    "BSD-3-Clause": _BSD_HEAD + _BSD_THIRD + _BSD_WARRANTY,
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:\n\n1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.\n2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.\n3. This notice may not be removed or altered from any source distribution.",
    "Apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
}
#: SHA-256 of the canonical form of whole licence texts as published, with titles and appendices (fixed values).
WHOLE = {
    "Apache-2.0": "2e160e5652ce5a1f586de36d7986bcb913eddac7957af216c0d8f809113d4a8d",
    "Artistic-1.0-Perl": "4eaaa9e33aeef0af0ff83ab5edac0ad421a1da9cc861c564630460107b4b772c",
    "CC0-1.0": "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f",
    "GFDL-1.2": "16018093d4eae05ac163ded9a99e3cee0c34973aff5e3ed77adfc4da5f190986",
    "GFDL-1.3": "24483827fdcab070dc64c6a0befe6fe64bdb823b040af911820bc5b81121dfe3",
    "GPL-1.0": "9132a605811c9f9a51621da0e0708f46e408e3507a3c1a9d16a5f48291082b8c",
    "GPL-2.0": "29507662ad31f55a5ac02f26a5d8cca21add440b2dff4a9ce97e458a0ca43f7f",
    "GPL-3.0": "25c090443e3540e3493172ea88c9181108effea290e12e68da7dcd1c51b4cd7a",
    "LGPL-2.0": "f17ebefdba4ae01060494f3396c1bc854578b6eaafaa6fe8abcf7a94e7fc2a6e",
    "LGPL-2.1": "50866b22e296e073a398813dc84c4c9dec94ed1ee7d617c063eb6851a562b9d4",
    "LGPL-3.0": "e1c7b25e9116bcad127297bbfb82e6a89822822ba6bfa3af9eae995aad877765",
    "MPL-1.1": "64a49d83bd8fd7a03e3441cca62f1c189748f458c0dcc541f24fe62524b4d833",
    "MPL-2.0": "3dacd2c104719e7227969cbdcc7d581518827199e830b9379627eec0a32f8ab7",
}
#: More known texts than this are joined by a shuffle instead of a broadcast.
BROADCAST_ROWS = 10_000


def _spaced(words: str) -> str:
    return " " + words.replace(" ", "  ") + " "


def canonical(text: Column) -> Column:
    """The canonical form of a text; empty for null and for texts that only state copyright."""
    t = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    t = F.regexp_replace(F.regexp_replace(F.concat(F.lit("\n"), t), COPYRIGHT_LINE, "\n"), TITLE, "\n")
    # Two spaces between words: each word has its own on both sides, so neighbours are replaced alike.
    t = F.concat(F.lit(" "), F.regexp_replace(t, BETWEEN, "  "), F.lit(" "))
    for other, usual in SPELLINGS.items():
        t = F.replace(t, F.lit(_spaced(other)), F.lit(_spaced(usual)))
    return F.trim(F.replace(t, F.lit("  "), F.lit(" ")))


def known_licenses(spark: SparkSession, texts: dict[str, str] | None = None) -> DataFrame:
    """license_id, digest of the given texts, or else of those in KNOWN and WHOLE; of several with one canonical form the first id stays."""
    rows = list((texts or KNOWN).items())
    found = spark.createDataFrame(rows, "license_id string, text string").select("license_id", F.sha2(canonical(F.col("text")), 256).alias("digest"))
    if not texts:
        found = found.unionByName(spark.createDataFrame(list(WHOLE.items()), "license_id string, digest string"))
    found = found.groupBy("digest").agg(F.min("license_id").alias("license_id"))
    return F.broadcast(found) if len(rows) <= BROADCAST_ROWS else found


def scan(docs: DataFrame, texts: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_canonical (characters), canonical_sha256, license_id (null: no known licence) of every row.

    A null text counts as empty and matches nothing, as does a text without words; a null id is carried, repeated rows are
    each looked up, an empty table gives no rows, other columns are ignored, very long texts are hashed whole.
    """
    form = docs.select(F.col(id_col).cast("long").alias("doc_id"), canonical(F.col(text_col)).alias("__form"))
    keyed = form.select("doc_id", F.length("__form").cast("long").alias("n_canonical"), F.sha2("__form", 256).alias("canonical_sha256"))
    known = known_licenses(docs.sparkSession, texts)
    return keyed.join(known, (keyed.canonical_sha256 == known.digest) & (keyed.n_canonical > 0), "left").drop("digest")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(common.table(spark, sf_dir, "documents"))


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def _canonical_sql(text: str) -> str:
    t = f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"
    t = f"regexp_replace(regexp_replace(chr(10) || {t}, '{COPYRIGHT_LINE}', chr(10), 'g'), '{TITLE}', chr(10))"
    t = f"' ' || regexp_replace({t}, '{BETWEEN}', '  ', 'g') || ' '"
    for other, usual in SPELLINGS.items():
        t = f"replace({t}, '{_spaced(other)}', '{_spaced(usual)}')"
    return f"trim(replace({t}, '  ', ' '))"


_KNOWN_SQL = f"""k AS (SELECT min(id) AS license_id, digest FROM (SELECT id, sha256({_canonical_sql('t')}) AS digest FROM (VALUES {', '.join(f'({_quoted(k)}, {_quoted(v)})' for k, v in KNOWN.items())}) AS v(id, t)
  UNION ALL VALUES {', '.join(f"('{k}', '{v}')" for k, v in WHOLE.items())}) GROUP BY digest)"""

ORACLE = f"""
WITH {_KNOWN_SQL},
d AS (SELECT doc_id, {_canonical_sql('text')} AS c FROM documents)
SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(length(c) AS BIGINT) AS n_canonical, sha256(c) AS canonical_sha256, license_id
FROM d LEFT JOIN k ON sha256(c) = digest AND length(c) > 0"""

#: Ways in which a licence file differs from the text as published: {0} stands for the text.
FORMS = ("{0}", "MIT License\n\nCopyright (c) 2020 Somebody\n\n{0}", "The licence\n\n© 2021, 2022 A. Person. All rights reserved.\n{0}\n", "  {0} \n\nCopyright <YEAR> <HOLDER>")


def known_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scan of every known text in each of FORMS, upper-cased and with a line for each word too, and of all documents' first lines."""
    texts = spark.createDataFrame(list(KNOWN.items()), "name string, t string")
    forms = texts.select(F.explode(F.array(*[F.replace(F.lit(f), F.lit("{0}"), F.col("t")) for f in FORMS], F.upper("t"), F.replace(F.col("t"), F.lit(" "), F.lit("\n")))).alias("text"))
    lines = common.table(spark, sf_dir, "documents").select(F.explode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("text"))
    found = scan(forms.unionByName(lines).withColumn("doc_id", F.lit(0)))
    return found.groupBy("license_id").agg(F.count("*").alias("n_texts"), F.countDistinct("canonical_sha256").alias("n_forms"))


FORMS_ORACLE = f"""
WITH {_KNOWN_SQL},
t AS (SELECT * FROM (VALUES {', '.join(f'({_quoted(v)})' for v in KNOWN.values())}) AS v(t)),
f AS ({' UNION ALL '.join(f"SELECT replace({_quoted(x)}, '{{0}}', t) AS text FROM t" for x in FORMS)} UNION ALL SELECT upper(t) FROM t UNION ALL SELECT replace(t, ' ', chr(10)) FROM t
  UNION ALL SELECT unnest(string_split(coalesce(text, ''), chr(10))) FROM documents),
c AS (SELECT {_canonical_sql('text')} AS c FROM f)
SELECT license_id, count(*) AS n_texts, count(DISTINCT sha256(c)) AS n_forms FROM c LEFT JOIN k ON sha256(c) = digest AND length(c) > 0 GROUP BY license_id"""
