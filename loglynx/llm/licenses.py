"""License scans by sentence rules.

Texts are cut into sentences; normalised sentences (A-Z lower-cased, every other run of
characters than a-z and 0-9 one space) are mapped to the identifiers of known licence
sentences; a document's sequence of identifiers is matched against ordered licence rules.
A rule fits where its identifiers follow one another in the sequence (sentences that are
not known do not count); a rule whose sequence is part of another rule that fits is
subsumed by it.

Licence texts are found as they are wrapped: sentences are read twice, once with a line
break as an end of sentence and once without (only empty lines end one).

All of it is array expressions on one row: no shuffle, no Python.  The tables are fixed
and small.  Every rule has a sentence with one of ``KEYWORDS`` (checked), so texts
without any are left out before they are cut: a necessary condition.

Defined cases: null and empty texts have no row; texts are read whole; repeated rows are
reported as often as they occur; null ids are reported as they are; an empty table gives
an empty result; other columns do not matter.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYWORDS = "licen[sc]e|copyright|permission|warrant|redistribut|unencumbered"

# Sentences of common licences and notices, and rules over their names.
SENTENCES = {
    "mit-title": "The MIT License", "mit-title-2": "MIT License", "mit-paren": "The MIT License (MIT)",
    "mit-released": "Released under the MIT License", "mit-licensed": "Licensed under the MIT License",
    "mit-project": "This project is licensed under the MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
                 "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
                 "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
                 "Software is furnished to do so, subject to the following conditions",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
                 "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "apache-title": "Apache License Version 2.0", "apache-title-2": "Apache License, Version 2.0, January 2004",
    "apache-licensed": "Licensed under the Apache License, Version 2.0",
    "apache-licensed-the": "Licensed under the Apache License, Version 2.0 (the \"License\")",
    "apache-may-not": "you may not use this file except in compliance with the License",
    "apache-obtain": "You may obtain a copy of the License at",
    "apache-unless": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
                     "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    "apache-see": "See the License for the specific language governing permissions and limitations under the License",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                          "following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
                  "disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-neither": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
                   "derived from this software without specific prior written permission",
    "bsd-as-is": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
                 "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED",
    "gpl3-work": "This work is licensed under the GNU General Public License, version 3",
    "gpl2-work": "This work is licensed under the GNU General Public License, version 2",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    "gpl-warranty": "but WITHOUT ANY WARRANTY",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "gpl-received": "You should have received a copy of the GNU General Public License along with this program",
    "cc-by-nc": "Licensed under CC BY-NC 4.0", "cc-by": "Licensed under CC BY 4.0", "cc-by-sa": "Licensed under CC BY-SA 4.0",
    "cc-by-work": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-sa-work": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "cc-by-nc-work": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "mpl": "This Source Code Form is subject to the terms of the Mozilla Public License, v",
    "unlicense": "This is free and unencumbered software released into the public domain",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
                 "provided that the above copyright notice and this permission notice appear in all copies",
    "spdx-mit": "SPDX-License-Identifier: MIT", "spdx-apache": "SPDX-License-Identifier: Apache-2.0",
    "spdx-gpl3": "SPDX-License-Identifier: GPL-3.0-only",
}
RULES = [  # rule, licence, sentences in order
    ("mit-released", "MIT", ["mit-released"]), ("mit-licensed", "MIT", ["mit-licensed"]), ("mit-project", "MIT", ["mit-project"]),
    ("mit-grant", "MIT", ["mit-grant"]), ("mit-body", "MIT", ["mit-grant", "mit-notice", "mit-as-is"]),
    ("mit-text", "MIT", ["mit-title", "mit-grant", "mit-notice", "mit-as-is"]),
    ("mit-text-2", "MIT", ["mit-title-2", "mit-grant", "mit-notice", "mit-as-is"]),
    ("mit-text-3", "MIT", ["mit-paren", "mit-grant", "mit-notice", "mit-as-is"]),
    ("apache-2.0-licensed", "Apache-2.0", ["apache-licensed"]), ("apache-2.0-title", "Apache-2.0", ["apache-title"]),
    ("apache-2.0-title-2", "Apache-2.0", ["apache-title-2"]), ("apache-2.0-the", "Apache-2.0", ["apache-licensed-the"]),
    ("apache-2.0-header", "Apache-2.0", ["apache-licensed-the", "apache-may-not", "apache-obtain", "apache-unless", "apache-see"]),
    ("bsd-2-clause", "BSD-2-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-as-is"]),
    ("bsd-3-clause", "BSD-3-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-neither", "bsd-as-is"]),
    ("gpl-3.0-work", "GPL-3.0", ["gpl3-work"]), ("gpl-2.0-work", "GPL-2.0", ["gpl2-work"]),
    ("gpl-3.0-free", "GPL-3.0-or-later", ["gpl-free"]), ("gpl-3.0-header", "GPL-3.0-or-later", ["gpl-free", "gpl-hope", "gpl-received"]),
    ("cc-by-nc-4.0", "CC-BY-NC-4.0", ["cc-by-nc"]), ("cc-by-4.0", "CC-BY-4.0", ["cc-by"]), ("cc-by-sa-4.0", "CC-BY-SA-4.0", ["cc-by-sa"]),
    ("cc-by-4.0-work", "CC-BY-4.0", ["cc-by-work"]), ("cc-by-sa-4.0-work", "CC-BY-SA-4.0", ["cc-by-sa-work"]),
    ("cc-by-nc-4.0-work", "CC-BY-NC-4.0", ["cc-by-nc-work"]),
    ("mpl-2.0", "MPL-2.0", ["mpl"]), ("unlicense", "Unlicense", ["unlicense"]),
    ("isc", "ISC", ["isc-grant"]), ("spdx-mit", "MIT", ["spdx-mit"]), ("spdx-apache-2.0", "Apache-2.0", ["spdx-apache"]),
    ("spdx-gpl-3.0", "GPL-3.0", ["spdx-gpl3"]),
]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BY_LINE = r"[.!?]+[\x09-\x0D\x20]+|\n+"
BY_PARAGRAPH = r"[.!?]+[\x09-\x0D\x20]+|\n[\x09-\x0D\x20]*\n"


def normalised(sentence: str) -> str:
    return re.sub("[^a-z0-9]+", " ", sentence.translate(str.maketrans(UPPER, LOWER))).strip(" ")


def tables(sentences: dict[str, str], rules: list) -> tuple[dict[str, int], list[tuple[str, str, str, int]]]:
    """({normalised sentence: identifier}, [(rule, licence, ",1,2,", number of sentences)])."""
    number = {name: i + 1 for i, name in enumerate(sentences)}
    ids = {normalised(s): number[name] for name, s in sentences.items()}
    return ids, [(rule, lic, "," + ",".join(str(number[s]) for s in seq) + ",", len(seq)) for rule, lic, seq in rules]


def _sequence(text: Column, end: str, ids: dict[str, int]) -> Column:
    """The identifiers of the known sentences, in order, as ",1,,2,"-like text: each with its own commas."""
    known = F.create_map(*[x for s, i in ids.items() for x in (F.lit(s), F.lit(str(i)))])
    plain = F.transform(F.split(text, end), lambda s: F.trim(F.regexp_replace(F.translate(s, UPPER, LOWER), "[^a-z0-9]+", " ")))
    found = F.filter(F.transform(plain, lambda s: F.try_element_at(known, s)), lambda i: i.isNotNull())
    return F.concat(F.lit(","), F.array_join(found, ","), F.lit(","))


def scan(docs: DataFrame, sentences: dict[str, str] | None = None, rules: list | None = None, key: str = "doc_id", text: str = "text",
         keywords: str = KEYWORDS) -> DataFrame:
    """One row per document and licence rule that fits and is not subsumed: key, rule, license, n_sentences."""
    ids, flat = tables(sentences or SENTENCES, rules or RULES)
    named = {f",{i}," for s, i in ids.items() if re.search(keywords, s)}
    if lost := [rule for rule, _, p, _ in flat if not any(i in p for i in named)]:
        raise ValueError(f"rules without a keyword: {lost}")
    own = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    some = own.where(F.col("_text").rlike("(?i)" + keywords))
    seqs = some.select("_key", _sequence(F.col("_text"), BY_LINE, ids).alias("a"), _sequence(F.col("_text"), BY_PARAGRAPH, ids).alias("b"))
    seqs = seqs.where("a <> ',,' or b <> ',,'")
    known = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(lic).alias("license"), F.lit(p).alias("seq"), F.lit(n).alias("n")) for r, lic, p, n in flat])
    fit = F.filter(known, lambda r: F.contains(F.col("a"), r["seq"]) | F.contains(F.col("b"), r["seq"]))
    rows = seqs.select("_key", fit.alias("fit"))
    top = F.filter("fit", lambda r: ~F.exists("fit", lambda q: (q["seq"] != r["seq"]) & F.contains(q["seq"], r["seq"])))
    out = rows.select("_key", F.explode(top).alias("r"))
    return out.select(F.col("_key").alias(key), F.col("r.rule").alias("rule"), F.col("r.license").alias("license"), F.col("r.n").alias("n_sentences"))
