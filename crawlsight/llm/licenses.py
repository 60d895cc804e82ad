"""Licences in documents, by the sentences they are made of.

A text becomes normalised sentences, sentences that occur in known licences become identifiers,
and the sequence of identifiers is matched against ordered rules. Column functions only: a
document's sentences never leave its row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licences, normalised: lower case, single spaces, letters and digits only.
SENTENCES = {
    "released under the mit license": "mit-notice",
    "licensed under the mit license": "mit-notice",
    "spdx license identifier mit": "mit-notice",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice-kept",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "as-is",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "no-liability",
    "licensed under the apache license version 2 0": "apache-notice",
    "licensed under the apache license version 2 0 the license": "apache-notice",
    "spdx license identifier apache 2 0": "apache-notice",
    "you may not use this file except in compliance with the license": "apache-compliance",
    "you may obtain a copy of the license at": "apache-copy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache-as-is",
    "this work is licensed under the gnu general public license version 3": "gpl3-notice",
    "licensed under the gnu general public license version 3": "gpl3-notice",
    "this work is licensed under the gnu general public license version 2": "gpl2-notice",
    "licensed under the gnu general public license version 2": "gpl2-notice",
    "this program is free software": "gpl-free",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3-terms",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2-terms",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-names",
    "licensed under cc by 4 0": "cc-by",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by nd 4 0": "cc-by-nd",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "cc-by-sa",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "cc-by-nc",
    "all rights reserved": "reserved",
}
# Rules in order; the first that fits takes its sentences. Names are SPDX identifiers.
RULES = (
    ("MIT", ("mit-notice", "mit-grant", "mit-notice-kept", "as-is", "no-liability")),
    ("MIT", ("mit-grant", "mit-notice-kept", "as-is", "no-liability")),
    ("Apache-2.0", ("apache-notice", "apache-compliance", "apache-copy", "apache-as-is")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl3-terms")),
    ("GPL-2.0-or-later", ("gpl-free", "gpl2-terms")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("MIT", ("mit-notice",)),
    ("Apache-2.0", ("apache-notice",)),
    ("GPL-3.0-only", ("gpl3-notice",)),
    ("GPL-2.0-only", ("gpl2-notice",)),
    ("CC-BY-4.0", ("cc-by",)),
    ("CC-BY-SA-4.0", ("cc-by-sa",)),
    ("CC-BY-NC-4.0", ("cc-by-nc",)),
    ("CC-BY-ND-4.0", ("cc-by-nd",)),
)
# A sentence ends at one of these marks before white space, or at a line without letters and digits.
ENDS, OTHER = r"[.!?:;][ \t\r\n]+", r"[^a-z0-9\n]+"


def normalised(text: Column) -> Column:
    """Words by single spaces; a line end within a sentence is one line feed, the end of a sentence two or more."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(text), ENDS, "\n\n"), OTHER, " ")
    return F.trim(F.regexp_replace(plain, " ?\n ?", "\n"))


def recognised(text: Column, known: list[str]) -> Column:
    """The ``known`` sentences in a text, in order, the longest first where several begin. NULL: none.

    They may be wrapped at any words. They begin and end with a sentence or a line, so that a notice on a
    line of its own needs no mark, nor does the line before a wrapped sentence.
    """
    # Longest first, as an alternative that is tried first wins.
    each = "|".join("[ \n]".join(re.escape(w) for w in k.split(" ")) for k in sorted(known, key=lambda k: (-len(k), k)))
    found = F.regexp_extract_all(normalised(text), F.lit(rf"(?<![^\n])(?:{each})(?![^\n])"), F.lit(0))
    return F.coalesce(F.transform(found, lambda s: F.translate(s, "\n", " ")), F.array().cast("array<string>"))


def _wrapped(ids: tuple[str, ...]) -> str:
    return "".join(f"<{each}>" for each in ids)


def find_licenses(
    docs: DataFrame,
    sentence_ids: dict[str, str] | None = None,
    rules: tuple[tuple[str, tuple[str, ...]], ...] = RULES,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
) -> DataFrame:
    """One row per document: ``keep``, n_recognised (known sentences), sequence (their identifiers), licenses.

    Sentences that no licence has are passed over; the others, in order, are the sequence. Rules are
    tried in their order; what one has matched is no longer there for the next. ``licenses`` is the
    sorted list of distinct names. Text that is NULL, empty or without known sentences: 0, empty
    and an empty list. Repeated rows are answered one by one; an empty table gives no rows. Tables
    of sentences and rules are parameters and part of the plan.
    """
    known = SENTENCES if sentence_ids is None else sentence_ids
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    found = recognised(F.col(text), list(known))
    marked = docs.select(*keep, F.transform(found, lambda s: table[s]).alias("ids"))
    sequence = F.concat(
        F.lit(""), F.array_join(F.transform("ids", lambda i: F.concat(F.lit("<"), i, F.lit(">"))), "")
    )
    ordered = F.array(
        *[F.struct(F.lit(name).alias("name"), F.lit(_wrapped(ids)).alias("ids")) for name, ids in rules]
    )
    none = F.array().cast("array<string>")

    def tried(state: Column, rule: Column) -> Column:
        hit = F.contains(state["rest"], rule["ids"])
        return F.struct(
            F.when(hit, F.replace(state["rest"], rule["ids"], F.lit("|"))).otherwise(state["rest"]).alias("rest"),
            F.when(hit, F.array_append(state["names"], rule["name"])).otherwise(state["names"]).alias("names"),
        )

    matched = F.aggregate(
        ordered, F.struct(sequence.alias("rest"), none.alias("names")), tried, lambda s: F.array_sort(F.array_distinct(s["names"]))
    )
    return marked.select(
        *keep,
        F.size("ids").cast("long").alias("n_recognised"),
        sequence.alias("sequence"),
        F.when(F.size("ids") > 0, matched).otherwise(none).alias("licenses"),
    )
