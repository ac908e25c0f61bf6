"""Licence scans: known sentences, then rules on their order."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventflow.llm.common import text_or_empty

# Known licence sentences, normalised, and their identifiers.
SENTENCES = {
    "licensed under the apache license version 2.0": "apache2-ref",
    "licensed under the apache license version 2.0 the license": "apache2-ref",
    "apache license": "apache-title",
    "version 2.0 january 2004": "apache2-date",
    "licensed under the apache license 2.0": "apache2-ref",
    "licensed under the apache 2.0 license": "apache2-ref",
    "you may not use this file except in compliance with the license": "apache2-comply",
    "you may obtain a copy of the license at": "apache2-obtain",
    "released under the mit license": "mit-ref",
    "licensed under the mit license": "mit-ref",
    "the mit license": "mit-ref",
    "the mit license mit": "mit-ref",
    "mit license": "mit-ref",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit-warranty",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-endorse",
    "this work is licensed under the gnu general public license version 3": "gpl3-ref",
    "licensed under the gnu general public license version 3": "gpl3-ref",
    "licensed under the gnu general public license version 2": "gpl2-ref",
    "gnu general public license": "gpl-title",
    "version 3 29 june 2007": "gpl3-date",
    "version 2 june 1991": "gpl2-date",
    "this program is free software": "gpl-free",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl-terms",
    "either version 3 of the license or at your option any later version": "gpl3-later",
    "either version 2 of the license or at your option any later version": "gpl2-later",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3-terms-later",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2-terms-later",
    "licensed under the gnu general public license v3.0": "gpl3-ref",
    "licensed under the gnu general public license v2.0": "gpl2-ref",
    "licensed under cc by nc 4.0": "cc-by-nc4-ref",
    "licensed under cc by 4.0": "cc-by4-ref",
    "licensed under cc by sa 4.0": "cc-by-sa4-ref",
    "licensed under cc0 1.0": "cc0-ref",
    "this work is licensed under a creative commons attribution 4.0 international license": "cc-by4-ref",
    "this work is licensed under a creative commons attribution noncommercial 4.0 international license": "cc-by-nc4-ref",
    "licensed under a creative commons attribution 4.0 international license": "cc-by4-ref",
    "licensed under the creative commons attribution 4.0 international license": "cc-by4-ref",
    "licensed under a creative commons attribution noncommercial 4.0 international license": "cc-by-nc4-ref",
    "licensed under the creative commons attribution noncommercial 4.0 international license": "cc-by-nc4-ref",
    "licensed under a creative commons attribution sharealike 4.0 international license": "cc-by-sa4-ref",
    "licensed under the creative commons attribution sharealike 4.0 international license": "cc-by-sa4-ref",
    "this source code form is subject to the terms of the mozilla public license v. 2.0": "mpl2-ref",
    "licensed under the mozilla public license 2.0": "mpl2-ref",
    "licensed under the mozilla public license v. 2.0": "mpl2-ref",
    "this source code form is subject to the terms of the mozilla public license v 2.0": "mpl2-ref",
    "licensed under the mozilla public license version 2.0": "mpl2-ref",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "this is free and unencumbered software released into the public domain": "unlicense-grant",
}
# Rules in order of precedence: a licence and the sentences that make it, in their order.
RULES = [
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-terms", "gpl3-later"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl3-terms-later"]),
    ("GPL-3.0-or-later", ["gpl3-terms-later"]),
    ("GPL-2.0-or-later", ["gpl-free", "gpl2-terms-later"]),
    ("GPL-2.0-or-later", ["gpl2-terms-later"]),
    ("GPL-2.0-or-later", ["gpl-free", "gpl-terms", "gpl2-later"]),
    ("GPL-3.0", ["gpl-title", "gpl3-date"]),
    ("GPL-2.0", ["gpl-title", "gpl2-date"]),
    ("Apache-2.0", ["apache2-ref", "apache2-comply", "apache2-obtain"]),
    ("Apache-2.0", ["apache-title", "apache2-date"]),
    ("Apache-2.0", ["apache2-ref"]),
    ("MIT", ["mit-ref"]),
    ("GPL-3.0", ["gpl3-ref"]),
    ("GPL-2.0", ["gpl2-ref"]),
    ("CC-BY-NC-4.0", ["cc-by-nc4-ref"]),
    ("CC-BY-SA-4.0", ["cc-by-sa4-ref"]),
    ("CC-BY-4.0", ["cc-by4-ref"]),
    ("CC0-1.0", ["cc0-ref"]),
    ("MPL-2.0", ["mpl2-ref"]),
    ("ISC", ["isc-grant"]),
    ("Unlicense", ["unlicense-grant"]),
]
# Each known sentence has a word that begins like one of these; a text without them has no known sentence.
TRIGGERS = "(?i)licen|redistribut|permission|software|january|june"

MARK = "\x01"
# How a sentence may say what is licensed, and where more is to be read.
SAID = "^(?:(?:this|the) [a-z]+ is )?(?:licensed|released|distributed) under (?:the terms of )?"
SEE = " (?:please )?see (?:the )?(?:file )?licen[cs]e[a-z0-9. ]*$"


def normalise(sentence: Column) -> Column:
    """Lower-case words and version numbers, single spaces between, no stop at the end."""
    lower = F.translate(sentence, ascii_uppercase, ascii_lowercase)
    return F.regexp_replace(F.regexp_replace(lower, "[^a-z0-9.]+", " "), "^[ .]+|[ .]+$", "")


def plain(normalised: Column) -> Column:
    """A reference to a licence without what is licensed and where to read more."""
    return F.regexp_replace(F.regexp_replace(normalised, SAID, "licensed under "), SEE, "")


def sentences(text: Column) -> Column:
    """Sentences in their order. One over several lines is followed by its lines.

    A sentence ends with a stop and white space, or with an empty line; the stop of "v." or
    "ver." before a number ends none.
    """
    ended = F.regexp_replace(text, r"((?<!\b[vV]|\b[vV]er)\.|\.(?![\x20\x09-\x0D]+[0-9])|[!?;:])[\x20\x09-\x0D]+|\n[\x20\x09-\x0D]*\n", "$1" + MARK)
    return F.flatten(F.transform(
        F.split(ended, MARK), lambda s: F.when(s.contains("\n"), F.concat(F.array(s), F.split(s, "\n"))).otherwise(F.array(s))
    ))


def pattern(rule: list[str]) -> str:
    """A rule on the list of identifiers, commas around each: those in this order, others between."""
    return "," + "(?:[^,]+,)*?".join(f"{name}," for name in rule)


def scan(docs: DataFrame) -> DataFrame:
    """The licences of each text.

    Returns a row per input row: doc_id, sentence_ids (known sentences in their order) and
    licenses (names, sorted, each once). Sentences are normalised and looked up; rules are
    then tried in order of precedence, each takes its sentences away, so that parts of a
    licence do not count as another. Everything happens inside of the row, nothing is
    shuffled. Null and empty texts have neither; repeated rows get equal results, and other
    columns are not looked at. Very long texts are read whole, an empty table gives no rows; of
    rules that would fit the same sentences the first one listed takes them.
    """
    text = text_or_empty()
    known = F.create_map(*[F.lit(x) for pair in SENTENCES.items() for x in pair])
    may = text.rlike(TRIGGERS)
    none = F.array().cast("array<string>")

    def look_up(sentence: Column) -> Column:
        return F.coalesce(F.try_element_at(known, sentence), F.try_element_at(known, plain(sentence)))

    found = F.when(
        may, F.filter(F.transform(F.transform(sentences(text), normalise), look_up), lambda x: x.isNotNull())
    ).otherwise(none)
    rules = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(pattern(r)).alias("pattern")) for name, r in RULES])
    start = F.struct(
        F.concat(F.lit(","), F.array_join("sentence_ids", ","), F.lit(",")).alias("rest"), none.alias("names")
    )
    applied = F.aggregate(
        rules, start,
        lambda state, rule: F.when(
            F.rlike(state["rest"], rule["pattern"]),
            F.struct(
                F.regexp_replace(state["rest"], rule["pattern"], F.lit(",")).alias("rest"),
                F.array_append(state["names"], rule["name"]).alias("names"),
            ),
        ).otherwise(state),
        lambda state: F.array_sort(F.array_distinct(state["names"])),
    )
    return docs.select("doc_id", found.alias("sentence_ids")).withColumn(
        "licenses", F.when(F.size("sentence_ids") > 0, applied).otherwise(none)
    )
