"""Licence recognition by sentences: known sentences become identifiers, rules match their order.

A text is cut into sentences, over line ends within a paragraph; each is normalised and, if it is a known
licence sentence, replaced by its identifier. Lines of a sentence that isn't known are looked up one by one. What is left is a short sequence of identifiers. Licence rules are tried on it in order,
longer ones first; a rule that matches takes its identifiers away, so a header is not counted again by
the rule for one of its sentences. All of it happens within the row, in built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoremill.llm.common import table

#: Identifiers of licence sentences in normal form (lower case, letters and digits).
SENTENCES = {
    "licensed under the apache license version 2 0": "apache_under",
    "licensed under the apache license version 2 0 the license": "apache_under",
    "you may not use this file except in compliance with the license": "apache_comply",
    "you may obtain a copy of the license at": "apache_copy",
    "released under the mit license": "mit_under",
    "licensed under the mit license": "mit_under",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit_grant",
    "the above copyright notice and this permission notice shall be included in all copies": "mit_notice",
    "the software is provided as is without warranty of any kind": "as_is",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd_grant",
    "redistributions of source code must retain the above copyright notice": "bsd_source",
    "redistributions in binary form must reproduce the above copyright notice": "bsd_binary",
    "neither the name of the copyright holder may be used to endorse or promote products": "bsd_endorse",
    "this work is licensed under the gnu general public license version 3": "gpl3_under",
    "licensed under the gnu general public license version 3": "gpl3_under",
    "licensed under the gnu general public license version 2": "gpl2_under",
    "licensed under cc by 4 0": "ccby_under",
    "licensed under cc by sa 4 0": "ccbysa_under",
    "licensed under cc by nc 4 0": "ccbync_under",
    "this work is in the public domain": "public_domain",
    "all rights reserved": "reserved",
}

#: Fixed values: (licence, the identifiers that follow each other), in the order they are tried.
RULES = [
    ("BSD-3-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_endorse"]),
    ("BSD-2-Clause", ["bsd_grant", "bsd_source", "bsd_binary"]),
    ("Apache-2.0", ["apache_under", "apache_comply", "apache_copy"]),
    ("MIT", ["mit_grant", "mit_notice", "as_is"]),
    ("MIT", ["mit_grant", "mit_notice"]),
    ("Apache-2.0", ["apache_under"]),
    ("MIT", ["mit_under"]),
    ("GPL-3.0", ["gpl3_under"]),
    ("GPL-2.0", ["gpl2_under"]),
    ("CC-BY-4.0", ["ccby_under"]),
    ("CC-BY-SA-4.0", ["ccbysa_under"]),
    ("CC-BY-NC-4.0", ["ccbync_under"]),
    ("Public-Domain", ["public_domain"]),
    ("All-Rights-Reserved", ["reserved"]),
]

#: The sentences of the unabridged licences and their notices, in normal form; ``SENTENCES`` has short ones.
FULL_SENTENCES = {
    "the asf licenses this file to you under the apache license version 2 0 the license": "apache_under",
    "apache license version 2 0 january 2004 http www apache org licenses": "apache_under",
    "apache license version 2 0 january 2004 https www apache org licenses": "apache_under",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "apache_copy",
    "you may obtain a copy of the license at https www apache org licenses license 2 0": "apache_copy",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation the "
    "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
    "persons to whom the software is furnished to do so subject to the following conditions": "mit_grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions "
    "of the software": "mit_notice",
    "the above copyright notice and this permission notice including the next paragraph shall be included in all "
    "copies or substantial portions of the software": "mit_notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the "
    "warranties of merchantability fitness for a particular purpose and noninfringement": "as_is",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met": "bsd_grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following "
    "disclaimer": "bsd_source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
    "following disclaimer in the documentation and or other materials provided with the distribution": "bsd_binary",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
    "free software foundation": "gpl_terms",
    "gnu general public license version 3 29 june 2007": "gpl3_under",
    "gnu general public license version 2 june 1991": "gpl2_under",
    "this is free and unencumbered software released into the public domain": "public_domain",
}
for _n in "23":
    _terms = "you can redistribute it and or modify it under the terms of the gnu general public license "
    _by = "as published by the free software foundation"
    _later = f"either version {_n} of the license or at your option any later version"
    FULL_SENTENCES |= {
        f"{_terms}version {_n} {_by}": f"gpl{_n}_under",
        f"{_terms}{_by} version {_n} of the license": f"gpl{_n}_under",
        f"{_terms}{_by} version {_n}": f"gpl{_n}_under",
        f"{_terms}{_by} {_later}": f"gpl{_n}_under",
        _later: f"gpl{_n}_either",
        f"version {_n} of the license": f"gpl{_n}_either",
    }
for _kind, _id in (("attribution", "ccby"), ("attribution sharealike", "ccbysa"), ("attribution noncommercial", "ccbync")):
    FULL_SENTENCES |= {
        f"licensed under {_the} creative commons {_kind} 4 0 international license{_short}": f"{_id}_under"
        for _the in ("a", "the")
        for _short in ("", f" {'cc by' + (_id[4:] and ' ' + _id[4:])} 4 0")
    }

#: The other GNU licences as (name, licence, identifier, version, date of its title).
GNU = [
    ("lesser", "LGPL-3.0", "lgpl", "3", "29 june 2007"),
    ("lesser", "LGPL-2.1", "lgpl", "2 1", "february 1999"),
    ("affero", "AGPL-3.0", "agpl", "3", "19 november 2007"),
]
_gnu_rules = []
for _name, _licence, _id, _n, _date in GNU:
    _title = f"gnu {_name} general public license"
    _terms = f"you can redistribute it and or modify it under the terms of the {_title}"
    _by = "as published by the free software foundation"
    _later = f"either version {_n} of the license or at your option any later version"
    _whole, _either = f"{_id}{_n.replace(' ', '')}_under", f"gpl{_n.replace(' ', '')}_either"
    FULL_SENTENCES |= {
        f"{_title} version {_n} {_date}": _whole,
        f"licensed under the {_title} version {_n}": _whole,
        f"{_terms} {_by}": f"{_id}_terms",
        f"{_terms} {_by} {_later}": _whole,
        f"{_terms} {_by} version {_n} of the license": _whole,
        f"{_terms} {_by} version {_n}": _whole,
        _later: _either,
        f"version {_n} of the license": _either,
    }
    _gnu_rules += [(_licence, [f"{_id}_terms", _either]), (_licence, [_whole])]

#: Sentences of further licences, each of which names its licence alone or with the next one.
FULL_SENTENCES |= {
    "mozilla public license version 2 0": "mpl_under",
    "this source code form is subject to the terms of the mozilla public license v": "mpl_under",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
    "provided that the above copyright notice and this permission notice appear in all copies": "isc_grant",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted "
    "provided that the above copyright notice and this permission notice appear in all copies": "isc_grant",
    "cc0 1 0 universal": "cc0_under",
    "creative commons legal code cc0 1 0 universal": "cc0_under",
    "to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to "
    "this software to the public domain worldwide": "cc0_under",
    "this software is provided as is without any express or implied warranty": "zlib_as_is",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter "
    "it and redistribute it freely subject to the following restrictions": "zlib_grant",
    "eclipse public license v 2 0": "epl_under",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 "
    "which is available at https www eclipse org legal epl 2 0": "epl_under",
    "this program and the accompanying materials are made available under the terms of the eclipse public license v2 0 "
    "which accompanies this distribution": "epl_under",
    "boost software license version 1 0 august 17th 2003": "boost_under",
    "distributed under the boost software license version 1 0": "boost_under",
    "licensed under the mozilla public license version 2 0": "mpl_under",
    "licensed under the isc license": "isc_grant",
}

#: Short names of licences in identifier lines, beside the licence that rules call them by.
SPDX = {
    "MIT": "MIT", "Apache-2.0": "Apache-2.0", "BSD-2-Clause": "BSD-2-Clause", "BSD-3-Clause": "BSD-3-Clause",
    "MPL-2.0": "MPL-2.0", "ISC": "ISC", "CC0-1.0": "CC0-1.0", "Zlib": "Zlib", "EPL-2.0": "EPL-2.0", "BSL-1.0": "BSL-1.0",
    "Unlicense": "Public-Domain", "CC-BY-4.0": "CC-BY-4.0", "CC-BY-SA-4.0": "CC-BY-SA-4.0", "CC-BY-NC-4.0": "CC-BY-NC-4.0",
}
for _gpl in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0"):
    SPDX |= {_gpl + _ending: _gpl for _ending in ("", "-only", "-or-later")}
IDENTIFIER = "spdx license identifier "
SPDX_SENTENCES = {
    IDENTIFIER + name.lower().replace("-", " ").replace(".", " "): f"spdx_{licence}" for name, licence in SPDX.items()
}

#: Rules of identifiers that ``SENTENCES`` doesn't have, tried after ``RULES``.
FULL_RULES = [
    ("GPL-3.0", ["gpl_terms", "gpl3_either"]),
    ("GPL-2.0", ["gpl_terms", "gpl2_either"]),
    *_gnu_rules,
    ("MPL-2.0", ["mpl_under"]),
    ("ISC", ["isc_grant"]),
    ("CC0-1.0", ["cc0_under"]),
    ("Zlib", ["zlib_as_is", "zlib_grant"]),
    ("EPL-2.0", ["epl_under"]),
    ("BSL-1.0", ["boost_under"]),
    *((licence, [f"spdx_{licence}"]) for licence in dict.fromkeys(SPDX.values())),
]

#: The BSD endorsement clause has a name in it, which may end its first half with a full stop (``Inc.``).
ENDORSEMENT = (
    r"^(neither the names? of .+ |)nor the names? of (its|the|their|any|other) contributors (may|can) be used to endorse or "
    r"promote products derived from this software without (specific )?prior written permission$|"
    r"^the names? of .+ (may not|must not) be used to endorse or promote products derived from this software without "
    r"(specific )?prior written permission$"
)

#: What may stand before a known sentence: its number in a list, or what is licensed.
LEAD_IN = (
    r"^[0-9a-z]{1,2} (?=redistributions |neither |the names? of )|"
    r"^(?:this|the) (?:[a-z0-9]+ ){1,6}(?:is|are) (?=licensed under |released under )"
)

#: Copyright lines at the head of a paragraph.
HEAD = r"^(?:[^a-z0-9\n]*(?:copyright|\(c\)|\u00a9|all rights reserved)[^\n]*\n)+"

#: No known sentence is shorter.
SHORTEST = min(map(len, SENTENCES | FULL_SENTENCES))

#: Sentences end at blank lines (of a comment, too) and at a full stop, question or exclamation mark before white space.
SENTENCE_END = r"\n(?:[ \t\r\x0b\f*#/;%|-]*\n)+|[.!?:;]+(?=\s|$)"


def _plain(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(sentence, "[^a-z0-9]+", " "))


def sentence_ids(text: Column) -> Column:
    """Identifiers of a text's licence sentences, in order; empty for null."""
    short, known = (
        F.create_map(*[F.lit(x) for pair in sentences.items() for x in pair])
        for sentences in (SENTENCES | SPDX_SENTENCES, SENTENCES | FULL_SENTENCES | SPDX_SENTENCES)
    )

    def of_lines(part: Column) -> Column:
        lines = F.filter(F.split(part, "\n"), lambda s: F.length(s) >= SHORTEST)
        return F.filter(F.transform(lines, lambda s: short[_plain(s)]), lambda x: x.isNotNull())

    def of_plain(plain: Column) -> Column:
        rest = F.regexp_replace(plain, LEAD_IN, "")
        endorsement = plain.endswith("prior written permission") & rest.rlike(ENDORSEMENT)
        return F.coalesce(known[plain], known[rest], F.when(endorsement, "bsd_endorse"))

    def of_sentence(sentence: Column) -> Column:
        own = of_plain(_plain(F.regexp_replace(sentence, HEAD, "")))
        found = F.transform(F.array(own), lambda x: F.struct(x.alias("id")))
        head = F.when(sentence.contains("\n"), of_lines(F.regexp_extract(sentence, HEAD, 0))).otherwise(F.array().cast("array<string>"))
        return F.flatten(
            F.transform(found, lambda x: F.when(x["id"].isNotNull(), F.concat(head, F.array(x["id"]))).otherwise(of_lines(sentence)))
        )

    # The colon of an identifier line ends no sentence.
    plain = F.replace(F.lower(F.coalesce(text, F.lit(""))), F.lit("spdx-license-identifier: "), F.lit(IDENTIFIER))
    sentences = F.split(plain, SENTENCE_END)
    long_enough = F.filter(sentences, lambda s: F.length(s) >= SHORTEST)
    return F.flatten(F.transform(long_enough, of_sentence))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, with ``sentences`` (identifiers in order, `` > `` between) and ``licenses``.

    ``licenses`` lists each licence whose rule matched, in the order of the rules, ``, `` between. Both are
    empty strings for texts without licence sentences, null and empty ones included. Repeated rows each
    give a row; columns of these names are replaced.
    """
    rest = [c for c in docs.columns if c not in (text, "sentences", "licenses", "_left", "_found")]
    out = docs.select(*rest, sentence_ids(F.col(text)).alias("_ids"))
    out = out.select(
        *rest,
        F.array_join("_ids", " > ").alias("sentences"),
        F.concat(F.lit(">"), F.array_join(F.transform("_ids", lambda x: F.concat(x, F.lit(">"))), "")).alias("_left"),
        F.array().cast("array<string>").alias("_found"),
    )
    has_any = F.col("sentences") != ""
    for licence, ids in RULES + FULL_RULES:
        hit = has_any & F.contains("_left", F.lit(">" + ">".join(ids) + ">"))
        out = out.select(
            *rest,
            "sentences",
            F.when(hit, F.replace("_left", F.lit(">" + ">".join(ids) + ">"), F.lit(">|>"))).otherwise(F.col("_left")).alias("_left"),
            F.when(hit, F.array_append("_found", F.lit(licence))).otherwise(F.col("_found")).alias("_found"),
        )
    return out.select(*rest, "sentences", F.array_join(F.array_distinct("_found"), ", ").alias("licenses"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence sentences and licences of all ``documents``; nulls, repeats and empty tables as in ``scan``."""
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _sql() -> str:
    rows = ", ".join(f"('{s}', '{i}')" for s, i in SENTENCES.items())
    steps = []
    for n, (licence, ids) in enumerate(RULES):
        mark = ">" + ">".join(ids) + ">"
        before = f"step{n - 1}" if n else "marked"
        steps.append(
            f"step{n} AS (SELECT k, doc_id, sentences, replace(rest, '{mark}', '>|>') AS rest, CASE WHEN contains(rest, '{mark}') "
            f"AND NOT list_contains(found, '{licence}') THEN list_append(found, '{licence}') ELSE found END AS found FROM {before})"
        )
    return f"""
WITH known(sentence, id) AS (VALUES {rows}),
texts AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
cut AS (
  SELECT k, list_transform(string_split_regex(regexp_replace(lower(text), '[.!?:;]+([ \\t\\n\\x0b\\x0c\\r]|$)', chr(10) || '\\1', 'g'), chr(10)),
         lambda s: trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g'))) AS parts FROM texts
),
placed AS (SELECT k, unnest(parts) AS sentence, generate_subscripts(parts, 1) AS i FROM cut),
ids AS (SELECT k, string_agg(id, ' > ' ORDER BY i) AS sentences, '>' || string_agg(id, '>' ORDER BY i) || '>' AS rest
        FROM placed JOIN known USING (sentence) GROUP BY k),
marked AS (SELECT k, doc_id, coalesce(sentences, '') AS sentences, coalesce(rest, '>') AS rest, []::VARCHAR[] AS found
           FROM texts LEFT JOIN ids USING (k)),
{", ".join(steps)}
SELECT doc_id, sentences, coalesce(array_to_string(found, ', '), '') AS licenses FROM step{len(RULES) - 1}
"""


SQL = _sql()
