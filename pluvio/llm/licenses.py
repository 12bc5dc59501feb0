"""Licence statements in texts: known sentences by their normalised wording, then ordered rules over their identifiers.

DataFrame functions only. A text is cut at line ends and after sentence marks; neighbouring pieces are also tried
together, as many as a known sentence has words, as licence texts wrap. Normalised pieces are looked up among the known
sentences, and the identifiers found, in text order, are matched against the rules in rule order: a rule takes the identifiers that it matches away from
the later rules, so that the longer text of a licence is not also reported as the shorter one that it contains.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of licences as statements spell them, normalised.
NAMES = {
    "Apache-2.0": ["apache license version 2.0", "apache license 2.0", "apache 2.0 license", "apache-2.0"],
    "MIT": ["mit license", "mit licence", "expat license", "mit/x11 license"],
    "GPL-2.0": ["gnu general public license version 2", "gnu general public license v2", "gnu general public license version 2.0", "gpl version 2 license", "gplv2 license", "gplv2", "gpl v2", "gpl-2.0", "gnu gpl v2", "gnu gpl version 2", "gnu gplv2"],
    "GPL-3.0": ["gnu general public license version 3", "gnu general public license v3", "gnu general public license version 3.0", "gpl version 3 license", "gplv3 license", "gplv3", "gpl v3", "gpl-3.0", "gnu gpl v3", "gnu gpl version 3", "gnu gplv3"],
    "AGPL-3.0": ["gnu affero general public license version 3", "gnu affero general public license v3", "agplv3 license", "agplv3", "agpl v3", "gnu agpl v3"],
    "LGPL-2.1": ["gnu lesser general public license version 2.1", "gnu lesser general public license v2.1", "lgpl 2.1 license", "lgplv2.1", "gnu lgpl v2.1"],
    "LGPL-3.0": ["gnu lesser general public license version 3", "gnu lesser general public license v3", "lgplv3 license", "lgplv3", "gnu lgpl v3"],
    "MPL-2.0": ["mozilla public license version 2.0", "mozilla public license 2.0", "mpl 2.0 license"],
    "BSD-2-Clause": ["bsd 2-clause license", "simplified bsd license"],
    "BSD-3-Clause": ["bsd 3-clause license", "new bsd license", "bsd license"],
    "ISC": ["isc license"],
    "EPL-2.0": ["eclipse public license 2.0", "eclipse public license version 2.0"],
    "CC0-1.0": ["cc0 1.0", "cc0 1.0 universal license"],
    "CC-BY-4.0": ["cc by 4.0", "creative commons attribution 4.0 international license"],
    "CC-BY-SA-4.0": ["cc by-sa 4.0", "creative commons attribution-sharealike 4.0 international license"],
    "CC-BY-NC-4.0": ["cc by-nc 4.0", "creative commons attribution-noncommercial 4.0 international license"],
    "CC-BY-ND-4.0": ["cc by-nd 4.0", "creative commons attribution-noderivatives 4.0 international license"],
    "CC-BY-NC-SA-4.0": ["cc by-nc-sa 4.0", "creative commons attribution-noncommercial-sharealike 4.0 international license"],
}
# How a statement names a licence.
STATEMENTS = [
    "licensed under {}",
    "released under {}",
    "distributed under {}",
    "available under {}",
    "distributed under the terms of {}",
    "released under the terms of {}",
    "available under the terms of {}",
    "this project is licensed under the terms of {}",
    "this software is licensed under the terms of {}",
    "this program is licensed under the terms of {}",
    "this software is distributed under the terms of {}",
    "this software is distributed under {}",
    "this project is released under {}",
    "this library is licensed under {}",
    "this package is licensed under {}",
    "licensed under the terms of {}",
    "this work is licensed under {}",
    "this software is licensed under {}",
    "this project is licensed under {}",
    "this program is licensed under {}",
    "this file is licensed under {}",
    "this code is released under {}",
    "this software is released under {}",
    "this document is licensed under {}",
]
# Endings of identifiers in tags, for licences that have them.
TAG_ENDINGS = {"GPL-2.0": ["", "-only", "-or-later", "+"], "GPL-3.0": ["", "-only", "-or-later", "+"], "AGPL-3.0": ["", "-only", "-or-later"], "LGPL-2.1": ["", "-only", "-or-later"], "LGPL-3.0": ["", "-only", "-or-later"]}
# Sentences of licence headers and short licences, normalised.
SENTENCES = {
    "APACHE-COMPLY": "you may not use this file except in compliance with the license",
    "APACHE-COPY": "you may obtain a copy of the license at",
    "APACHE-AS-IS": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "APACHE-SEE": "see the license for the specific language governing permissions and limitations under the license",
    "MIT-GRANT": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and/or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "MIT-NOTICE": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "MIT-AS-IS": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "BSD-GRANT": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "BSD-SOURCE": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "BSD-BINARY": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "BSD-NAMES": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "ISC-GRANT": "permission to use copy modify and/or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "GPL-2-OR-LATER": "this program is free software you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "GPL-3-OR-LATER": "this program is free software you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "GPL-HOPE": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "MPL-FORM": "this source code form is subject to the terms of the mozilla public license v. 2.0",
    "UNLICENSE": "this is free and unencumbered software released into the public domain",
}
# Rules in order; each names the identifiers that must stand one after another.
RULES = [
    ("BSD-3-Clause", ["BSD-GRANT", "BSD-SOURCE", "BSD-BINARY", "BSD-NAMES"]),
    ("BSD-2-Clause", ["BSD-GRANT", "BSD-SOURCE", "BSD-BINARY"]),
    ("MIT", ["MIT-GRANT", "MIT-NOTICE", "MIT-AS-IS"]),
    ("MIT", ["MIT-GRANT", "MIT-NOTICE"]),
    ("Apache-2.0", ["IS-Apache-2.0", "APACHE-COMPLY", "APACHE-COPY", "APACHE-AS-IS", "APACHE-SEE"]),
    ("Apache-2.0", ["IS-Apache-2.0", "APACHE-COMPLY", "APACHE-COPY"]),
    ("GPL-2.0-or-later", ["GPL-2-OR-LATER", "GPL-HOPE"]),
    ("GPL-3.0-or-later", ["GPL-3-OR-LATER", "GPL-HOPE"]),
    ("GPL-2.0-or-later", ["GPL-2-OR-LATER"]),
    ("GPL-3.0-or-later", ["GPL-3-OR-LATER"]),
    ("ISC", ["ISC-GRANT"]),
    ("MPL-2.0", ["MPL-FORM"]),
    ("Unlicense", ["UNLICENSE"]),
]
#: Every known sentence holds one of these; other texts have none.
KEYWORDS = ("licen", "copyright", "redistribut", "permission", "warrant", "unencumbered")
#: Pieces that the SQL in sql.py tries together; license_scan has no such bound.
WRAP = 5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def known_sentences() -> dict[str, str]:
    """Normalised sentence to identifier: headers, and every statement form with every name.

    A name may have an article before it, and (the "License") behind it. It is a statement by itself, as a heading, and in
    a tag; all statements of a licence have one identifier.
    """
    out = {text.replace("v. 2.0", "v 2.0"): name for name, text in SENTENCES.items()}
    for licence, names in NAMES.items():
        for form in STATEMENTS:
            for name in names:
                for article in ("", "the ", "a "):
                    out[form.format(article + name)] = out[form.format(article + name) + " the license"] = f"IS-{licence}"
        # A name by itself is a heading, where it says that it is a licence.
        for name in names:
            if name.endswith(("license", "licence")) or " license " in name:
                out[name] = out["the " + name] = f"IS-{licence}"
        for ending in TAG_ENDINGS.get(licence, [""]):
            out[f"spdx-license-identifier {(licence + ending).lower().rstrip('+')}"] = f"IS-{licence}"
    return {s: i for s, i in out.items() if any(k in s for k in KEYWORDS)}


def all_rules() -> list[tuple[str, str]]:
    """(licence, identifiers) in order, the identifiers written <A><B>; the plain statements come last."""
    return [(licence, "".join(f"<{x}>" for x in ids)) for licence, ids in RULES] + [(licence, f"<IS-{licence}>") for licence in NAMES]


def _by_head() -> Column:
    """A map from the first two words of known sentences to the most words of any of them, and them, longest first."""
    heads: dict[str, dict] = {}
    for s, name in sorted(known_sentences().items(), key=lambda pair: (-len(pair[0]), pair[0])):
        words = s.split(" ")
        head = heads.setdefault(" ".join(words[:2]), {"most": 0, "known": []})
        head["most"] = max(head["most"], len(words))
        head["known"].append({"s": s, "n": len(words), "id": name})
    return F.from_json(F.lit(json.dumps(heads)), "map<string, struct<most: int, known: array<struct<s: string, n: int, id: string>>>>")


def _found(all_: Column, i: Column, by_head: Column) -> Column:
    """The identifier of the longest known sentence that is the pieces from the i-th on, joined by single spaces, or null.

    Every piece has a word, so that a sentence has no more pieces than words.
    """
    joined = lambda k: F.array_join(F.slice(all_, i + 1, k), " ")
    whole = lambda x: F.exists(F.sequence(F.lit(1), x["n"]), lambda k: joined(k) == x["s"])
    ids = lambda head: F.transform(F.array(joined(head["most"])), lambda ahead: F.get(F.filter(head["known"], lambda x: ahead.startswith(x["s"]) & whole(x)), F.lit(0))["id"])
    return F.flatten(F.transform(F.array(F.try_element_at(by_head, F.substring_index(joined(2), " ", 2))), ids))[0]


def pieces(text: Column) -> Column:
    """Normalised pieces between line ends and sentence marks: lower case, single spaces, points only inside numbers."""
    t = F.translate(text, _UPPER, _LOWER)
    t = F.regexp_replace(t, r"[.!?;:]+(\s|$)", "\n")
    t = F.regexp_replace(t, r"[^a-z0-9.+/\n-]+", " ")
    t = F.regexp_replace(t, r"([0-9])\.([0-9])", "$1_$2")
    t = F.regexp_replace(F.translate(t, ".", ""), "_", ".")
    return F.filter(F.transform(F.split(t, "\n"), lambda p: F.regexp_replace(p, r"^[ +/-]+|[ +/-]+$", "")), lambda p: p != "")


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, sentence_ids, licences, unmatched) of every row, all strings.

    sentence_ids: identifiers of the known sentences as <A><B>, in text order; the longest of the wrapped readings counts
    where several start at one piece. licences: those of the rules that matched, each once, in rule order, comma-joined.
    unmatched: identifiers that no rule took, "|" where a rule took some. A null, empty or very long text is treated as any
    other, by its own pieces; texts without a keyword have empty strings. Rows stay as they are; nothing is shuffled.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    low = F.translate(text, _UPPER, _LOWER)
    may = F.lit(False)
    for word in KEYWORDS:
        may = may | low.contains(word)
    by_head = _by_head()
    likely = lambda p: F.exists(F.array(*map(F.lit, sorted({s.split(" ")[0] for s in known_sentences()}))), lambda w: p.startswith(w))
    ids = F.filter(F.transform("pieces", lambda p, i: F.when(likely(p), _found(F.col("pieces"), i, by_head))), lambda x: x.isNotNull())
    rules = F.array(*[F.struct(F.lit(a).alias("licence"), F.lit(b).alias("ids")) for a, b in all_rules()])
    start = F.struct(F.col("sentence_ids").alias("rest"), F.array().cast("array<string>").alias("got"))
    taken = F.aggregate(
        rules,
        start,
        lambda acc, r: F.when(
            acc["rest"].contains(r["ids"]),
            F.struct(F.replace(acc["rest"], r["ids"], F.lit("|")).alias("rest"), F.array_union(acc["got"], F.array(r["licence"])).alias("got")),
        ).otherwise(acc),
    )
    scanned = (
        docs.select(F.col(id_col).alias("id"), F.when(may, pieces(text)).alias("pieces"))
        .select("id", F.when(F.col("pieces").isNotNull(), F.array_join(F.transform(ids, lambda x: F.concat(F.lit("<"), x, F.lit(">"))), "")).alias("sentence_ids"))
        .withColumn("taken", F.when(F.col("sentence_ids") != "", taken))
    )
    return scanned.select(
        "id",
        F.coalesce("sentence_ids", F.lit("")).alias("sentence_ids"),
        F.coalesce(F.array_join("taken.got", ","), F.lit("")).alias("licences"),
        F.coalesce("taken.rest", F.lit("")).alias("unmatched"),
    )
