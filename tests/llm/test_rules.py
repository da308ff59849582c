import os

import duckdb
import numpy as np
import pytest

from scoremill.llm import decontamination as D
from scoremill.llm import host_rules as H
from scoremill.llm import licenses as L

CASES = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t\x0b ", "en", None), (4, "w " * 60, "en", "a"),
    (5, "\n".join(f"line {i} of many" for i in range(30)) + "\nline 1 of many" * 40, "en", "b"),
    (6, " ".join(f"x{i}" for i in range(60)) + " $$$ %%%", "en", "b"), (6, "same id", "en", "b"),
    (7, " ".join(f"y{i}" for i in range(60)) + " y3 y4 y5 y9", "en", "a"), (None, "no id here", "en", None),
    (8, "a b a b a", "en", "a"), (9, " ".join(f"z{i}" for i in range(30_000)), "en", "a"),
    (10, " ".join(f"{i}%%%%" for i in range(80)), "en", "b"), (11, " ".join(f"{i}%%%%" for i in range(80)), "en", "b"),
]


def as_sql(frame, sql, tmp_path):
    path = os.path.join(tmp_path, "documents")
    frame.write.mode("overwrite").parquet(path)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/*.parquet')")
    return connection.execute(sql).fetchall()


def ordered(rows):
    return sorted(map(tuple, rows), key=str)


def test_rules_match_sql(docs, tmp_path):
    frame = docs(CASES)
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert ordered(H.judge(frame).select(columns).collect()) == ordered(as_sql(frame, H.SQL, tmp_path))


def test_filter_is_the_verdict(docs):
    frame = docs(CASES).withColumnRenamed("lang", "n_words")
    kept = H.filter_documents(frame)
    assert kept.columns == frame.columns
    judged = H.judge(docs(CASES)).where("kept").select("doc_id").collect()
    assert ordered(kept.select("doc_id").collect()) == ordered(judged)
    assert H.filter_documents(docs([])).count() == 0 == H.judge(docs([])).count()


def test_distrusted_host_drops_soft_failures_only(docs, prose):
    rows = [(i, prose(i) + " %%%%" * 80, "en", "bad") for i in range(20)]
    rows += [(100 + i, prose(i), "en", "good") for i in range(20)]
    rows += [(200, prose(50) + " %%%%" * 80, "en", "good"), (201, prose(51), "en", "bad")]
    kept = {r["doc_id"] for r in H.filter_documents(docs(rows)).collect()}
    assert kept == {*range(100, 120), 200, 201}


def test_prior_takes_chance_out(docs, prose):
    """A failure on a host of one document says nothing about the host."""
    rows = [(i, prose(i) + (" ###" * 60 if i < 20 else ""), "en", f"h{i}") for i in range(200)]
    assert all(r["kept"] for r in H.judge(docs(rows)).collect())


def test_prior_is_found_again():
    """Moments of hosts drawn from a beta distribution give its weight back."""
    draw = np.random.default_rng(1)
    for weight in (3.0, 12.0, 60.0):
        size = draw.integers(1, 60, 6000)
        bad = draw.binomial(size, draw.beta(0.3 * weight, 0.7 * weight, 6000))
        n, mean = size.sum(), bad.sum() / size.sum()
        spread = (size * (bad / size - mean) ** 2).sum()
        assert H.prior_weight(mean, spread, n, 6000, (size**2).sum()) == pytest.approx(weight, rel=0.15)
    alike = draw.binomial(size, 0.2)
    mean = alike.sum() / n
    assert H.prior_weight(mean, (size * (alike / size - mean) ** 2).sum(), n, 6000, (size**2).sum()) > 1000


LICENSED = [
    (1, "x.\nReleased under the MIT License.\ny"), (2, "Licensed under the Apache License, Version 2.0."), (3, None), (4, ""),
    (5, "All rights reserved. Licensed under CC BY-NC 4.0!  All rights reserved."), (5, "no licence"),
    (6, "Redistribution and use in source and binary forms, with or without modification, are permitted:\n"
        "Redistributions of source code must retain the above copyright notice.\n"
        "Redistributions in binary form must reproduce the above copyright notice."),
    (7, "Redistributions of source code must retain the above copyright notice."),
    (8, "Licensed under the Apache License, Version 2.0.\nYou may not use this file except in compliance with the License.\n"
        "You may obtain a copy of the License at"), (None, "w " * 50_000 + "\nAll rights reserved."),
]


def test_licenses(docs, tmp_path):
    frame = docs(LICENSED).withColumnRenamed("lang", "licenses")
    found = L.scan(frame)
    assert ordered(found.select("doc_id", "sentences", "licenses").collect()) == ordered(as_sql(docs(LICENSED), L.SQL, tmp_path))
    by_id = {r["doc_id"]: r["licenses"] for r in found.where("n_chars != 10").collect()}
    assert by_id[8] == "Apache-2.0" and by_id[6] == "BSD-2-Clause" and by_id[7] == "" and by_id[3] == ""
    assert by_id[5] == "CC-BY-NC-4.0, All-Rights-Reserved"


MIT = """MIT License

Copyright (c) 2020 Some Author
Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE."""

BSD = """Copyright (c) 2020, Some Author

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_3 = """3. Neither the name of {} nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""

APACHE = """ * Copyright 2020 Some Author
 *
 * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at
 *
 *     http://www.apache.org/licenses/LICENSE-2.0
 *
 * Unless required by applicable law or agreed to in writing, software"""

GPL = """This program is free software{0} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation{1} either version {2} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,"""


def test_unabridged_licenses(docs):
    texts = {
        1: (MIT, "MIT", "mit_grant > mit_notice > as_is"),
        2: (BSD, "BSD-2-Clause", "bsd_grant > bsd_source > bsd_binary"),
        3: (BSD + BSD_3.format("the copyright holder"), "BSD-3-Clause", "bsd_grant > bsd_source > bsd_binary > bsd_endorse"),
        4: (BSD + BSD_3.format("Example Inc."), "BSD-3-Clause", "bsd_grant > bsd_source > bsd_binary > bsd_endorse"),
        5: (BSD.replace("1. ", "(a) ").replace("2. ", "(b) "), "BSD-2-Clause", "bsd_grant > bsd_source > bsd_binary"),
        6: (APACHE, "Apache-2.0", "apache_under > apache_comply > apache_copy"),
        7: (GPL.format(":", ",", 3), "GPL-3.0", "gpl3_under"),
        8: (GPL.format(";", ";", 2), "GPL-2.0", "gpl_terms > gpl2_either"),
        9: ("This project is licensed\nunder the MIT License.", "MIT", "mit_under"),
        10: (GPL.format(";", ";", 2).replace("General", "Library General"), "", "gpl2_either"),
        11: ("All rights reserved\n" + BSD.split("\n\n")[1] + "\n", "All-Rights-Reserved", "reserved > bsd_grant"),
        12: ("# GNU GENERAL PUBLIC LICENSE\r\n#  Version 3, 29 June 2007\r\n#\r\n# Everyone", "GPL-3.0", "gpl3_under"),
        13: ("This work is licensed under a Creative Commons\nAttribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0", "ccbysa_under"),
    }
    found = L.scan(docs([(i, "Some prose before.\n\n" + t[0]) for i, t in texts.items()])).collect()
    assert {r["doc_id"]: (r["licenses"], r["sentences"]) for r in found} == {i: t[1:] for i, t in texts.items()}


FURTHER = {
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this file""",
    "LGPL-2.1": GPL.replace("General", "Lesser General").format(";", ";", 2.1),
    "LGPL-3.0": GPL.replace("General", "Lesser General").format(":", ",", 3),
    "AGPL-3.0": "GNU AFFERO GENERAL PUBLIC LICENSE\nVersion 3, 19 November 2007\n\nCopyright",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""",
    "CC0-1.0": "CC0 1.0 Universal\n\n    CREATIVE COMMONS CORPORATION IS NOT A LAW FIRM",
    "Zlib": """This software is provided 'as-is', without any express or implied
warranty.  In no event will the authors be held liable.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:""",
    "EPL-2.0": "Eclipse Public License - v 2.0\n\n    THE ACCOMPANYING PROGRAM IS PROVIDED",
    "BSL-1.0": "Boost Software License - Version 1.0 - August 17th, 2003\n\nPermission is hereby granted",
}


def test_further_licenses_and_identifier_lines(docs):
    rows = list(enumerate(f"Some prose before.\n\n{text}\n\nand after" for text in FURTHER.values()))
    lines = {"MIT": "MIT", "GPL-2.0-or-later": "GPL-2.0", "LGPL-2.1-only": "LGPL-2.1", "BSD-3-Clause": "BSD-3-Clause",
             "Unlicense": "Public-Domain", "Apache-2.0": "Apache-2.0", "Unknown-1.0": ""}
    settings = ["// SPDX-License-Identifier: {}\n#include <x>", "# SPDX-License-Identifier: {}", "x = 1\n/* SPDX-License-Identifier: {} */\n"]
    expected = dict(enumerate(FURTHER))
    for name, licence in lines.items():
        for setting in settings:
            expected[len(rows)] = licence
            rows.append((len(rows), setting.format(name)))
    found = {r["doc_id"]: r["licenses"] for r in L.scan(docs(rows)).collect()}
    assert found == expected


ITEMS = [
    (1, "If a farmer sells 12 eggs for 3.50 dollars and buys 12 hens, how many eggs can be sold for the hens"),
    (2, "Name the capital city of the largest country that lies wholly in the southern half of the world"),
    (3, None), (4, ""), (5, "too short"), (6, "six words make a short item"),
    (None, "a nameless item with enough words in it to be found again somewhere else"),
]


@pytest.fixture
def items(spark):
    return spark.createDataFrame([(*r, "x") for r in ITEMS], "item_id long, text string, lang string")


def test_finds_copies_and_other_values(docs, items, prose):
    changed = ITEMS[0][1].replace("12", "40").replace("3.50 dollars", "9 euros")
    contradictory = ITEMS[0][1].replace("12 eggs", "40 eggs").replace("3.50", "9")
    rows = [
        (1, f"{prose(1)} {ITEMS[0][1].upper()}! {prose(2)}"), (2, f"{prose(3)}\n{changed}? {prose(4)}"), (3, contradictory),
        (4, ITEMS[1][1].replace(" ", "\n ")), (5, prose(5)), (6, None), (7, ""), (8, "well: six words make a short item ."),
        (9, ITEMS[6][1]), (None, ITEMS[1][1]), (4, ITEMS[1][1].replace(" ", "\n ")), (10, "too short"),
        (11, f"{prose(6, 20_000)} {ITEMS[1][1]}"),
    ]
    found = {(r["doc_id"], r["item_id"]) for r in D.find(docs(rows), items).collect()}
    assert {(1, 1), (2, 1), (4, 2), (8, 6), (9, None), (None, 2), (11, 2)} <= found
    assert (10, 5) in found
    assert not {d for d, _ in found} & {5, 6, 7}
    share = {r["doc_id"]: r["n_found"] for r in D.find(docs(rows), items).where("item_id = 1").collect()}
    assert share.get(3, 0) < share[2]
    kept = [r["doc_id"] for r in D.decontaminate(docs(rows), items).collect()]
    assert {5, 6, 7} <= set(kept) and not {1, 2, 4, 8, 9, 10, 11, None} & set(kept)


def test_joins_beyond_the_broadcast_bound(docs, items, monkeypatch):
    monkeypatch.setattr(D, "BROADCAST_ROWS", 0)
    assert [r["doc_id"] for r in D.find(docs([(4, ITEMS[1][1])]), items).collect()] == [4]


def test_empty_tables(docs, items):
    assert D.find(docs([]), items).count() == 0
    assert D.decontaminate(docs([(1, ITEMS[1][1])]), items.limit(0)).count() == 1


def found_in(spark, docs, items, texts):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    return {(r["doc_id"], r["item_id"]) for r in D.find(docs(texts), benchmark).collect()}


def test_finds_items_without_literal_runs(spark, docs, prose):
    items = [
        (1, "Compute 12 + 7 * 3 - 4 / 2"), (2, "Who wrote Hamlet?"), (3, "\u65e5\u672c\u306e\u9996\u90fd\u306f\u3069\u3053\u3067\u3059\u304b\u3002"),
        (4, "12 + 7 = ?"), (5, ITEMS[0][1]), (5, "3 cats, 4 dogs, 5 hens, 6 pigs?"), (None, "What is love"), (None, ITEMS[1][1]),
    ]
    texts = [(i, f"{prose(i)}. {text} {prose(40 + i)}") for i, (_, text) in enumerate(items)]
    texts += [(10, "compute 12 + 7 * 3 - 5 / 2"), (11, "12 - 7 = 5"), (12, "Who wrote it?"), (13, "\u65e5\u672c\u3067\u3059"), (14, prose(14))]
    assert found_in(spark, docs, items, texts) == {(i, item) for i, (item, _) in enumerate(items)}


def test_slots_are_refused_one_by_one(spark, docs, prose):
    apples = "A boy has 3 apples and 5 pears, then how many fruits are there"
    hours = "The train takes 1 hour to reach us and then 3 hours to go back"
    long_ = f"Take 7 eggs and then 7 more eggs from the box, {prose(60, 30)} and for 2 euros buy some bread and milk there today"
    items = [(1, apples), (2, hours), (3, long_)]
    texts = [
        (1, apples.replace("3", "4").replace("5", "4")), (2, hours.replace("1 hour", "2 hours").replace("3 hours", "4 h")),
        (3, hours.replace("1 hour", "2 hours").replace("3 hours", "4 days")), (4, long_.replace("7 eggs", "8 eggs").replace("2 euros", "6 dollars")),
    ]
    assert found_in(spark, docs, items, texts) == {(1, 1), (2, 2), (4, 3)}
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = {r["doc_id"]: (r["n_found"], r["n_runs"]) for r in D.find(docs(texts), benchmark).collect()}
    runs = D.benchmark_runs(benchmark).where("item_id = 3")
    held = runs.where("place <= 5").count()
    assert whole[4] == (whole[4][1] - held, runs.select("run").distinct().count())


SHORT = ["What is the largest planet in the system", "Compute the sum of all odd numbers", "Why now",
         "Name the capital city of France", "Paris is the capital of France", "Zugzwang"]
SETTINGS = ["{}", "some prose here {} and so on", "as said, {}; then more", "First. {}. Last", "x\n{}\ny"]


def test_items_of_any_length_are_found_in_any_setting(spark, docs, prose):
    """Against a plain search for the item's words, one to twenty of them, as they stand and in capitals."""
    items = [*SHORT, *(" ".join(prose(50 + n, n).split()) for n in range(1, 21)),
             *("The " + prose(90 + n, n).capitalize() for n in range(2, 9))]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts, expected = [], set()
    for i, item in enumerate(items):
        for k, setting in enumerate(SETTINGS):
            texts.append((100 * i + k, setting.format(item)))
            expected.add((100 * i + k, i))
            if len(item.split()) <= D.WINDOW:
                texts.append((100 * i + 50 + k, setting.format(item.upper())))
                expected.add((100 * i + 50 + k, i))
    letters = np.random.default_rng(7)
    clean = [" ".join("".join(letters.choice(list("abcdefgh"), 5)) for _ in range(60)) for _ in range(20)]
    texts += [(9000 + i, text) for i, text in enumerate(clean)]
    found = {(r["doc_id"], r["item_id"]) for r in D.find(docs(texts), benchmark).collect()}
    assert expected <= found
    # What else is found holds the words of a shorter item, or another value in the same template.
    words = {d: t.lower().replace(".", " ").replace(",", " ").replace(";", " ").split() for d, t in texts}
    for d, i in found - expected:
        item = items[i].lower().split()
        runs = [words[d][a : a + len(item)] for a in range(len(words[d]))]
        assert item in runs or 2 * len(item) >= D.SHORTEST, (d, i)  # a word with a number in it is two
    assert not {d for d, _ in found if d >= 9000}
