"""Licence scan: canonical texts hash-joined as wholes to known licence digests.

The units of a document are the whole text and each run of adjacent lines, over blank lines too.
Of the runs only those are digested that start with the first words of a known text, are as
long as it and end with a line, so the work is linear in the text however a licence is broken.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from importlib import resources

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.session import small_frame, stage

# Equivalent spellings, by the form that is kept.
SPELLINGS = {
    "licence": "license", "licences": "licenses", "licenced": "licensed",
    "licencing": "licensing", "licencor": "licensor", "sublicence": "sublicense",
    "acknowledgement": "acknowledgment", "analyse": "analyze", "authorisation": "authorization",
    "authorised": "authorized", "colour": "color", "favour": "favor", "fulfil": "fulfill",
    "initialise": "initialize", "judgement": "judgment", "labour": "labor",
    "merchantability": "merchantability", "noninfringement": "non infringement",
    "organisation": "organization", "owner": "holder", "owners": "holders",
    "programme": "program", "recognised": "recognized", "wilful": "willful", "v2": "version 2",
    "v3": "version 3", "http": "https",
}
# Known licence notices and short texts, by identifier; long texts are in files.
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met: {0}Redistributions of source code "
    "must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. {1}Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution. {2}THIS SOFTWARE IS PROVIDED BY {3} \"AS IS\" AND "
    "ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL {4} "
    "BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, "
    "DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN "
    "ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_BSD_THIRD = ("Neither the name of {0} nor the names of its contributors may be used to endorse or "
              "promote products derived from this software without specific prior written "
              "permission. ")
_BSD_BY = [("THE COPYRIGHT HOLDERS AND CONTRIBUTORS", f"THE COPYRIGHT {x} OR CONTRIBUTORS")
           for x in ("HOLDER", "HOLDERS")] + [
    ("THE REGENTS AND CONTRIBUTORS", "THE REGENTS OR CONTRIBUTORS")]


def _bsd(third: str | None) -> list[str]:
    """The text with numbered and with plain conditions, for each usual name of the holders."""
    return [_BSD.format(*marks[:2], marks[2] + third if third else "", *by)
            for marks in (("1. ", "2. ", "3. "), ("* ",) * 3) for by in _BSD_BY]


KNOWN = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the "
        "Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
        "and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be "
        "included in all copies or substantial portions of the Software. THE SOFTWARE IS "
        "PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT "
        "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
        "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
        "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
        "OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE "
        "AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER "
        "RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
        "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or "
        "agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or "
        "implied. See the License for the specific language governing permissions and "
        "limitations under the License.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the "
        "terms of the GNU General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
    ],
    **{name: [
        "This program is free software{0} you can redistribute it and/or modify it under the terms "
        f"of the GNU {kind} as published by the Free Software Foundation{{1}} either version "
        f"{version} of the License, or (at your option) any later version.".format(*marks)
        for marks in ((":", ","), (";", ";"))]
       for name, kind, version in (("AGPL-3.0", "Affero General Public License", "3"),
                                   ("GPL-2.0", "General Public License", "2"),
                                   ("LGPL-2.1", "Lesser General Public License", "2.1"),
                                   ("LGPL-3.0", "Lesser General Public License", "3"))},
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/.",
    ],
    "BSD-2-Clause": _bsd(None),
    "BSD-3-Clause": [text for name in ("the copyright holder", "the copyright holders",
                                       "the University")
                     for text in _bsd(_BSD_THIRD.format(name))],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
    ],
}
_WORD = re.compile(r"[^\W_]+")
# A copyright line names a year or a holder; other lines that start so are text ("Copyright
# holders be liable", "(c) You must retain").
_COPYRIGHT = re.compile(
    r"^[\W_]*(?:all rights reserved[\W_]*$|©"
    r"|(?:copyright\b|\(c\)).*?(?:\b(?:19|20)[0-9]{2}\b|[\[<{(](?:yyyy|year)\b)"
    r"|copyright[\W_]*\(c\)|copyright\W+(?:by\W+)?"
    r"(?!(?:holders?|owners?|licen[cs]es?|laws?|notices?|acts?|statements?|interests?|and|or|in|"
    r"to|is|as|of|on|for|by|disclaimers?|protections?|treaty|treaties|rights?|status|ownership|"
    r"infringement)\b)(?-i:[A-Z]\w*(?:[a-z.]|$)|[A-Z]{2,}\W+[A-Z][a-z]))", re.I)
# Title lines, in canonical form; removable before a text.
_TITLE = re.compile(
    r"(?:the )?(?:software )?license(?: agreement)?"
    r"|(?:the )?(?:mit|x11|expat|isc|apache|mozilla public|gnu (?:affero |lesser |library )?"
    r"general public|(?:new |modified |simplified |revised |original )?bsd(?: [234] clause)?)"
    r"(?: [234] clause)?(?: (?:new|simplified|revised|modified)(?: or (?:new|simplified|revised|"
    r"modified))?)?(?: software)? license(?: (?:mit|isc|expat|x11|bsd))?"
    r"(?: (?:version )?[0-9 ]+(?: [a-z]+(?: [0-9]+)? [0-9]{4})?)?"
    r"|bsd [234] clause|version [0-9]+(?: [0-9]+)*(?: [a-z]+(?: [0-9]+)? [0-9]{4})?"
    r"|(?:https )?www apache org licenses(?: license 2 0(?: txt)?)?")
#: First words of a known text that a run of lines must start with to be digested.
HEAD = 4


def _line(line: str) -> str:
    if _COPYRIGHT.match(line):
        return ""
    return " ".join([SPELLINGS.get(w, w) for w in _WORD.findall(line.lower())])


#: Lines repeat across a text's blocks and its copies; only short ones are remembered.
_SHORT = 400
_short_line = lru_cache(maxsize=1 << 14)(_line)


def _lines(lines: list[str]) -> list[str]:
    return [(_short_line if len(line) <= _SHORT else _line)(line) for line in lines]


def _joined(lines: list[str]) -> str:
    """Canonical lines as a text, without the titles before it (if it is not titles alone)."""
    left = [line for line in lines if line]
    at = next((i for i, line in enumerate(left) if not _TITLE.fullmatch(line)), 0)
    return " ".join(left[at:])


def canonical(text: str) -> str:
    """Lower case, words only, equivalent spellings, no copyright or title lines, single spaces."""
    return _joined(_lines(text.splitlines()))


def _sha(plain: str) -> str | None:
    return hashlib.sha256(plain.encode("utf-8", "surrogatepass")).hexdigest() if plain else None


def digest(text: str) -> str | None:
    """Digest of the canonical text; none if nothing is left of it."""
    return _sha(canonical(text))


def known_texts() -> dict[str, list[str]]:
    """``KNOWN`` and the long texts, whole and up to the end of their terms."""
    out = {name: list(texts) for name, texts in KNOWN.items()}
    for file in resources.files("churnlake.llm").joinpath("licence_texts").iterdir():
        if file.name.endswith(".txt"):
            text = file.read_text(encoding="utf-8")
            terms = re.split(r"(?m)^.*END OF TERMS AND CONDITIONS.*$|^Exhibit A - .*$", text)[0]
            out.setdefault(file.name.removesuffix(".txt"), []).extend(
                [text, terms, text[:text.index("END OF TERMS AND CONDITIONS") + 27]]
                if "END OF TERMS AND CONDITIONS" in text else [text, terms])
    return out


def known_digests(spark, known: dict[str, list[str]] | None = None) -> DataFrame:
    """A row per known text: digest, licence, its first ``HEAD`` words and its number of words."""
    rows = set()
    for name, texts in (known if known is not None else known_texts()).items():
        for plain in map(canonical, texts):
            words = plain.split()
            rows.add((_sha(plain), name, " ".join(words[:HEAD]), len(words)))
    return small_frame(spark, sorted(rows),
                       "digest STRING, licence STRING, head STRING, n_words INT")


def _runs(text: str, raw: list[str], lines: list[str],
          heads: dict[str, list[int]], sizes: list[int]) -> set[str]:
    """Digests of the runs of lines that start and are as long as a known text."""
    first = {h.partition(" ")[0] for h in heads}
    if not any(line.partition(" ")[0] in first for line in lines):
        return set()
    words, starts, ends = [], [], {}
    for i, line in enumerate(lines):
        if line:
            starts.append((len(words), i))
            words += line.split(" ")
            ends[len(words)] = i
    found = set()
    for start, i in starts:
        if words[start] in first:
            for n in sizes:
                for length in heads.get(" ".join(words[start:start + n]), ()):
                    j = ends.get(start + length)
                    if j is not None and (j - i + 1 < len(raw) or text != "\n".join(raw)):
                        found.add(_sha(" ".join(words[start:start + length])))
    return found


def _units(heads: dict[str, list[int]]):
    """Digests of the whole text and of its runs of lines, each as (row, unit, digest)."""
    sizes = sorted({len(h.split(" ")) for h in heads})

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, kinds, digests = [], [], []
            for at, text in enumerate(batch.column(2).to_pylist()):
                raw = (text or "").splitlines()
                lines = _lines(raw)
                whole = _sha(_joined(lines))
                found = sorted(_runs(text, raw, lines, heads, sizes)) if whole else []
                rows += [at] * (1 + len(found))
                kinds += ["text"] + ["part"] * len(found)
                digests += [whole, *found]
            rows = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows),
                 pa.array(kinds, pa.string()), pa.array(digests, pa.string())],
                names=["doc_id", "key", "unit", "digest"])

    return units


def scan(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Licence of each whole text, and licences that runs of its lines are in full.

    Returns a row per document: doc_id, digest, licence (of the whole text) and part_licences
    (sorted, distinct). ``known`` is a table as from ``known_digests``, all known texts by default;
    the first words and lengths of its texts are sent to every task.
    A null or empty text, or one of copyright lines only, has a null digest and matches
    nothing. Rows that repeat an id, or have none, are told apart by a 64-bit hash of the text, so
    each has the matches of its own text. Only the two named columns are read.
    """
    known = known if known is not None else known_digests(docs.sparkSession)
    heads = defaultdict(list)
    for head, length in known.select("head", "n_words").distinct().collect():
        heads[head].append(length)
    known = known.groupBy("digest").agg(F.min("licence").alias("licence"))
    base = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("key"),
                       F.col(text_col).alias("text"))
    kind = dict(base.dtypes)["doc_id"]
    units = base.mapInArrow(_units(dict(heads)),
                            f"doc_id {kind}, key BIGINT, unit STRING, digest STRING")
    # texts are read once: whole texts and the few parts that match are written and read back
    found = stage(units.join(known, "digest", "left")
                  .filter("unit = 'text' OR licence IS NOT NULL"), "licence-matches")
    parts = (found.filter("unit = 'part'").groupBy(F.col("doc_id").alias("of"), F.col("key").alias("of_key"))
             .agg(F.array_sort(F.collect_set("licence")).alias("part_licences")))
    return (found.filter("unit = 'text'")
            .join(parts, F.col("doc_id").eqNullSafe(F.col("of"))
                  & (F.col("key") == F.col("of_key")), "left")
            .select("doc_id", "digest", "licence",
                    F.coalesce("part_licences", F.array().cast("array<string>"))
                    .alias("part_licences")))
