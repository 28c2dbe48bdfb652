"""Licence recognition by sentences and rules.

A text is cut into sentences, each sentence is normalised and looked up among known
licence sentences, and what remains of the text is a sequence of identifiers. Ordered
rules then replace runs of identifiers by licence names, the longest and most special
first, so that a full licence text is recognised as a whole before any of its sentences
can count for less. Everything is built from SQL expressions on one row: no shuffle, no
join, no Python.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from siltworks.llm.common import col

# Sentences of public licence texts, normalised (see `normalised`), by identifier.
SENTENCES: dict[str, str] = {
    # short notices
    "ReleasedMIT": "released under the mit license",
    "LicensedMIT": "licensed under the mit license",
    "LicensedApache2": "licensed under the apache license version 2 0",
    "LicensedApache2The": "licensed under the apache license version 2 0 the license",
    "WorkGPL3": "this work is licensed under the gnu general public license version 3",
    "WorkGPL2": "this work is licensed under the gnu general public license version 2",
    "WorkLGPL3": "this work is licensed under the gnu lesser general public license version 3",
    "WorkAGPL3": "this work is licensed under the gnu affero general public license version 3",
    "LicensedCCBYNC4": "licensed under cc by nc 4 0",
    "LicensedCCBY4": "licensed under cc by 4 0",
    "LicensedCCBYSA4": "licensed under cc by sa 4 0",
    "LicensedCC0": "licensed under cc0 1 0",
    "LicensedBSD2": "licensed under the bsd 2 clause license",
    "LicensedBSD3": "licensed under the bsd 3 clause license",
    "LicensedMPL2": "licensed under the mozilla public license version 2 0",
    "SourceMPL2": "this source code form is subject to the terms of the mozilla public license v 2 0",
    # the notice as it is wrapped, and on one line; "v. " ends a sentence
    "SourceMPL2Wrapped": "this source code form is subject to the terms of the mozilla public",
    "SourceMPL2Line": "this source code form is subject to the terms of the mozilla public license v",
    "LicenseV": "license v",
    "CopyMPL2": "if a copy of the mpl was not distributed with this file you can obtain one at",
    "CopyMPL2Http": "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    "CopyMPL2Https": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "SpdxMIT": "spdx license identifier mit",
    "SpdxApache2": "spdx license identifier apache 2 0",
    "SpdxGPL3": "spdx license identifier gpl 3 0 or later",
    "SpdxBSD3": "spdx license identifier bsd 3 clause",
    "AllRights": "all rights reserved",
    # Apache notice
    "ApacheNotUse": "you may not use this file except in compliance with the license",
    "ApacheCopy": "you may obtain a copy of the license at",
    "ApacheAsIs": (
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed "
        "on an as is basis without warranties or conditions of any kind either express or implied"
    ),
    "ApacheSee": "see the license for the specific language governing permissions and limitations under the license",
    # MIT
    "MITGrant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following conditions"
    ),
    "MITNotice": (
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the software"
    ),
    "MITAsIs": (
        "the software is provided as is without warranty of any kind express or implied including but not limited to the "
        "warranties of merchantability fitness for a particular purpose and noninfringement"
    ),
    "MITLiability": (
        "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in "
        "an action of contract tort or otherwise arising from out of or in connection with the software or the use or "
        "other dealings in the software"
    ),
    # ISC
    "ISCGrant": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies"
    ),
    # BSD
    "BSDGrant": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met"
    ),
    "BSDSource": (
        "redistributions of source code must retain the above copyright notice this list of conditions and the following "
        "disclaimer"
    ),
    "BSDBinary": (
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
        "following disclaimer in the documentation and or other materials provided with the distribution"
    ),
    "BSDEndorse": (
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission"
    ),
    # GPL notice; a semicolon ends a sentence
    "GPL2Grant": (
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
        "free software foundation"
    ),
    "GPL2Either": "either version 2 of the license or at your option any later version",
    "LGPL2Grant": (
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by "
        "the free software foundation"
    ),
    "LGPL21Either": "either version 2 1 of the license or at your option any later version",
    "LGPL3Grant": (
        "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by "
        "the free software foundation either version 3 of the license or at your option any later version"
    ),
    "AGPL3Grant": (
        "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by "
        "the free software foundation either version 3 of the license or at your option any later version"
    ),
    "GPL3Grant": (
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
        "free software foundation either version 3 of the license or at your option any later version"
    ),
    "GPLFree": "this program is free software",
    "GPLHope": "this program is distributed in the hope that it will be useful but without any warranty",
    "GPLEven": "without even the implied warranty of merchantability or fitness for a particular purpose",
    "GPLMore": "see the gnu general public license for more details",
    "LGPLMore": "see the gnu lesser general public license for more details",
    "AGPLMore": "see the gnu affero general public license for more details",
    # Unlicense
    "UnlicenseFree": "this is free and unencumbered software released into the public domain",
    "UnlicenseAnyone": (
        "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or "
        "as a compiled binary for any purpose commercial or non commercial and by any means"
    ),
}

#: in a rule, stands for text that is not known, such as the address of a licence
ANYTHING = ""

# Licences as sequences of identifiers, in the order in which they are tried.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("MIT", ("MITGrant", "MITNotice", "MITAsIs", "MITLiability")),
    ("Apache-2.0", ("LicensedApache2The", "ApacheNotUse", "ApacheCopy", ANYTHING, "ApacheAsIs", "ApacheSee")),
    ("Apache-2.0", ("LicensedApache2The", "ApacheNotUse", "ApacheCopy", "ApacheAsIs", "ApacheSee")),
    ("Apache-2.0", ("LicensedApache2The", "ApacheNotUse", "ApacheCopy")),
    ("BSD-3-Clause", ("BSDGrant", "BSDSource", "BSDBinary", "BSDEndorse")),
    ("BSD-2-Clause", ("BSDGrant", "BSDSource", "BSDBinary")),
    ("GPL-3.0-or-later", ("GPLFree", "GPL3Grant", "GPLHope", "GPLEven", "GPLMore")),
    ("GPL-2.0-or-later", ("GPLFree", "GPL2Grant", "GPL2Either", "GPLHope", "GPLEven", "GPLMore")),
    ("AGPL-3.0-or-later", ("GPLFree", "AGPL3Grant", "GPLHope", "GPLEven", "AGPLMore")),
    ("LGPL-3.0-or-later", ("GPLFree", "LGPL3Grant", "GPLHope", "GPLEven", "LGPLMore")),
    ("LGPL-2.1-or-later", ("GPLFree", "LGPL2Grant", "LGPL21Either", "GPLHope", "GPLEven", "LGPLMore")),
    ("GPL-3.0-or-later", ("GPLFree", "GPL3Grant")),
    ("GPL-2.0-or-later", ("GPLFree", "GPL2Grant", "GPL2Either")),
    ("AGPL-3.0-or-later", ("GPLFree", "AGPL3Grant")),
    ("LGPL-3.0-or-later", ("GPLFree", "LGPL3Grant")),
    ("LGPL-2.1-or-later", ("GPLFree", "LGPL2Grant", "LGPL21Either")),
    ("Unlicense", ("UnlicenseFree", "UnlicenseAnyone")),
    ("Unlicense", ("UnlicenseFree",)),
    ("MPL-2.0", ("SourceMPL2Wrapped", "LicenseV", "CopyMPL2Https")),
    ("MPL-2.0", ("SourceMPL2Wrapped", "LicenseV", "CopyMPL2Http")),
    ("MPL-2.0", ("SourceMPL2Line", "CopyMPL2Https")),
    ("MPL-2.0", ("SourceMPL2Line", "CopyMPL2Http")),
    ("MPL-2.0", ("SourceMPL2Wrapped", "LicenseV")),
    ("MPL-2.0", ("SourceMPL2Line",)),
    ("MPL-2.0", ("SourceMPL2", "CopyMPL2")),
    ("MPL-2.0", ("SourceMPL2",)),
    ("MPL-2.0", ("LicensedMPL2",)),
    ("ISC", ("ISCGrant",)),
    ("MIT", ("MITGrant", "MITNotice")),
    ("MIT", ("ReleasedMIT",)),
    ("MIT", ("LicensedMIT",)),
    ("MIT", ("SpdxMIT",)),
    ("Apache-2.0", ("LicensedApache2The",)),
    ("Apache-2.0", ("LicensedApache2",)),
    ("Apache-2.0", ("SpdxApache2",)),
    ("AGPL-3.0", ("WorkAGPL3",)),
    ("LGPL-3.0", ("WorkLGPL3",)),
    ("GPL-3.0", ("WorkGPL3",)),
    ("GPL-2.0", ("WorkGPL2",)),
    ("GPL-3.0-or-later", ("SpdxGPL3",)),
    ("CC-BY-NC-4.0", ("LicensedCCBYNC4",)),
    ("CC-BY-SA-4.0", ("LicensedCCBYSA4",)),
    ("CC-BY-4.0", ("LicensedCCBY4",)),
    ("CC0-1.0", ("LicensedCC0",)),
    ("BSD-3-Clause", ("LicensedBSD3",)),
    ("BSD-2-Clause", ("LicensedBSD2",)),
    ("BSD-3-Clause", ("SpdxBSD3",)),
    ("Proprietary", ("AllRights",)),
)

#: a sentence ends after one of these marks and white space, or at a line break; a mark inside a number ends nothing
SENTENCE_END = r"[.!?:;]+[ \t\r\n]+|[\r\n]+"
# Line breaks, with a comment mark of source code, that only wrap a sentence: those between two
# words in capitals, behind a word that no sentence ends with, and before a small letter. Each
# pattern has what stands before the break and what stands behind it.
_BREAK = r"[ \t]*\r?\n[ \t]*[#*/;-]*[ \t]*"
WRAPPED = (
    r"([A-Z]{2}[,\"']*)" + _BREAK + r"([A-Z]{2})",
    r"(\b(?:a|an|and|as|by|for|in|of|or|the|to|under|with))" + _BREAK + r"([A-Za-z(\"'])",
    r"()" + _BREAK + r"([a-z(\"'])",
)
#: what is kept of a sentence: ASCII letters and digits; anything else is one space
NOT_KEPT = r"[^a-z0-9]+"
#: list numbers and the like are no sentences
LEAST = r"[a-z]{2}"


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), NOT_KEPT, " "))


def sentence_ids(text: Column, sentences: Mapping[str, str] = SENTENCES) -> Column:
    """The identifiers of all known sentences of a text, in order, each as ``<identifier>``.

    Sentences that are not known become ``<>`` between known ones, once for a run of them.
    """
    known = F.create_map(*[F.lit(x) for name, said in sentences.items() for x in (said, f"<{name}>")])
    joined = F.coalesce(text, F.lit(""))
    for pattern in WRAPPED:
        joined = F.regexp_replace(joined, pattern, "$1 $2")
    parts = F.split(joined, SENTENCE_END)
    said = F.filter(F.transform(parts, normalised), lambda s: s.rlike(LEAST))
    return F.regexp_replace(F.array_join(F.transform(said, lambda s: F.coalesce(known[s], F.lit("<>"))), ""), "(<>)+", "<>")


def scan(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    sentences: Mapping[str, str] = SENTENCES,
    rules: Sequence[tuple[str, tuple[str, ...]]] = RULES,
) -> DataFrame:
    """(id, n_known, sequence, licenses, n_licenses, unmatched) of every row.

    ``sequence`` are the identifiers in order, ``licenses`` the licence names found by
    the rules, in the order of the text and as often as they occur, joined by a space;
    ``unmatched`` the identifiers that no rule used. Null and empty texts have none of them.
    Every row is scanned for itself, whole texts of any length; repeated rows and ids give
    repeated results, an empty table none; other columns are not read.
    """
    found = docs.select(col(id_column).cast("long").alias("id"), sentence_ids(col(text_column), sentences).alias("sequence"))
    matched = F.col("sequence")
    for name, wanted in rules:
        matched = F.replace(matched, F.lit("".join(f"<{w}>" for w in wanted)), F.lit(f"[{name}]"))
    found = found.withColumn("matched", matched)
    names = F.regexp_extract_all(F.col("matched"), F.lit(r"\[([^\]]+)\]"), F.lit(1))
    rest = F.regexp_extract_all(F.col("matched"), F.lit(r"<(\w+)>"), F.lit(1))
    known = F.regexp_extract_all(F.col("sequence"), F.lit(r"<(\w+)>"), F.lit(1))
    return found.select(
        "id",
        F.size(known).cast("long").alias("n_known"),
        F.array_join(known, " ").alias("sequence"),
        F.array_join(names, " ").alias("licenses"),
        F.size(names).cast("long").alias("n_licenses"),
        F.array_join(rest, " ").alias("unmatched"),
    )
