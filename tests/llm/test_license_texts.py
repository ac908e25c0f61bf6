import re

import duckdb
import pyarrow as pa
import pytest
from compare import difference
from pyspark.sql import functions as F
from tables import EDGES, documents

from eventflow.llm.licenses import SENTENCES, TRIGGERS, scan
from eventflow.llm.queries import ORACLE_SQL

MIT = """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
BSD = [
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
]
GPL = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
    "as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version."
)


@pytest.mark.parametrize("text, names", [
    ("x y.\nReleased under the MIT License.", ["MIT"]),
    ("no stop before\nLICENSED under the\tApache License, Version 2.0.\nmore", ["Apache-2.0"]),
    (MIT, ["MIT"]),
    ("\n".join(BSD), ["BSD-3-Clause"]),
    ("\n".join(BSD[:3]), ["BSD-2-Clause"]),
    ("\n".join(BSD[::-1]), []),
    (GPL, ["GPL-3.0-or-later"]),
    ("Licensed under CC BY-NC 4.0. Licensed under CC BY-NC 4.0! And released under the MIT license.", ["CC-BY-NC-4.0"]),
    ("Licensed under CC BY 4.0. Released under the MIT License.", ["CC-BY-4.0", "MIT"]),
    ("The licence of the software is none of these.", []),
])
def test_rules(spark, text, names):
    assert scan(documents(spark, [text])).first().licenses == names


NOTICES = {
    "MPL-2.0": """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */""",
    "GPL-3.0-or-later": """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,""",
    "GPL-2.0-or-later": """    This program is free software; you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation; either version 2 of the License, or
    (at your option) any later version.""",
    "GPL-3.0": """                    GNU GENERAL PUBLIC LICENSE
                       Version 3, 29 June 2007

 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>""",
    "GPL-2.0": """                    GNU GENERAL PUBLIC LICENSE
                       Version 2, June 1991

 Copyright (C) 1989, 1991 Free Software Foundation, Inc.,""",
    "Apache-2.0": """   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at

       http://www.apache.org/licenses/LICENSE-2.0""",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""",
    "Unlicense": "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy,",
}
PHRASES = {
    "This project is licensed under the MIT License - see the [LICENSE.md](LICENSE.md) file for details.": ["MIT"],
    "This project is licensed under the MIT License": ["MIT"],
    "Distributed under the MIT License. See `LICENSE.txt` for more information.": ["MIT"],
    "This project is licensed under the Apache License, Version 2.0.": ["Apache-2.0"],
    "This software is licensed under the Apache License 2.0.": ["Apache-2.0"],
    "This work is licensed under CC BY-SA 4.0. To view a copy, visit the site.": ["CC-BY-SA-4.0"],
    "Set to level v. Released under the MIT License.": ["MIT"],
    "This project is not licensed under the MIT License.": [],
}


def test_standard_notices_as_they_are(spark):
    names = [*NOTICES, *PHRASES.values()]
    rows = scan(documents(spark, [*NOTICES.values(), *PHRASES])).orderBy("doc_id").collect()
    assert [r.licenses for r in rows] == [n if isinstance(n, list) else [n] for n in names]


def test_sql_says_what_the_query_says(spark):
    """On all notices, alone and among other text, with stops after "v." and "ver." in several places."""
    texts = [*NOTICES.values(), *PHRASES]
    texts += [f"Some text v. 2 here, see ver. 3. {t} More ver. x.\n\nv.\n\n2. End" for t in texts]
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": range(len(texts)), "text": texts}))
    found = scan(documents(spark, texts)).select(
        "doc_id", F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licenses", ",").alias("licenses")
    )
    assert difference(found, con.sql(ORACLE_SQL["op8_licenses"])) is None
    assert found.where("licenses <> ''").count() > len(texts) / 2


def test_edges_and_repeated_rows(spark):
    rows = scan(documents(spark, EDGES + ["MIT License"] * 2, [*range(len(EDGES)), 70, 70])).collect()
    assert [r.licenses for r in rows] == [[]] * len(EDGES) + [["MIT"], ["MIT"]]
    assert scan(documents(spark, [])).count() == 0


def test_each_known_sentence_has_a_trigger():
    assert all(re.search(TRIGGERS, s) for s in SENTENCES)
