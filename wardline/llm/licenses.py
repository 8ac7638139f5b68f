"""Licence scan by sentence rules.

A text is cut into sentences, which are normalised (letters and digits in lower case, one space between) and mapped
to identifiers of known licence sentences. The document's sequence of identifiers is then matched, from left to right,
against ordered rules, each a sequence of identifiers for one licence; longer and more specific rules stand first.
Between the sentences of a rule up to ``GAP`` unknown ones may stand (numbers of a list, an address). "All rights
reserved" is a licence only where no other rule matches. A tag 'SPDX-License-Identifier: (MIT OR GPL-2.0+)' is a
sentence for each licence of its expression, which also comes as it is written. Only DataFrame functions; nothing
leaves its row.

Edge cases: null and empty texts have no sentences; a document without a known sentence has empty strings;
ids may repeat or be null; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import text_or_empty

# Sentences of public licences and notices, normalised, by identifier.
SENTENCES: dict[str, str] = {
    "APACHE_NOTICE": "licensed under the apache license version 2.0",
    "APACHE_MAY_NOT": "you may not use this file except in compliance with the license",
    "APACHE_COPY": "you may obtain a copy of the license at http www.apache.org licenses license 2.0",
    "APACHE_AS_IS": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "APACHE_SEE": "see the license for the specific language governing permissions and limitations under the license",
    "APACHE_ANY": "this work is licensed under the apache license version 2.0",
    "MIT_TITLE": "the mit license",
    "MIT_TITLE_SHORT": "mit license",
    "MIT_RELEASED": "released under the mit license",
    "MIT_LICENSED": "licensed under the mit license",
    "MIT_WORK": "this work is licensed under the mit license",
    "MIT_GRANT": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "MIT_NOTICE": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "AS_IS": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "GPL3_WORK": "this work is licensed under the gnu general public license version 3",
    "GPL3_SHORT": "licensed under the gnu general public license version 3",
    "GPL2_WORK": "this work is licensed under the gnu general public license version 2",
    "GPL2_SHORT": "licensed under the gnu general public license version 2",
    "LGPL_WORK": "this work is licensed under the gnu lesser general public license version 3",
    "AGPL_WORK": "this work is licensed under the gnu affero general public license version 3",
    "GPL_FREE": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "GPL2_FREE": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "GPL_HOPE": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "GPL_SEE": "see the gnu general public license for more details",
    "GPL_COPY": "you should have received a copy of the gnu general public license along with this program",
    "BSD_RELEASED": "released under the bsd license",
    "BSD_LICENSED": "licensed under the bsd license",
    "BSD3_LICENSED": "licensed under the bsd 3 clause license",
    "BSD2_LICENSED": "licensed under the bsd 2 clause license",
    "BSD_REDISTRIBUTION": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "BSD_NEITHER": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "MPL_NOTICE": "this source code form is subject to the terms of the mozilla public license v",
    "MPL_SHORT": "licensed under the mozilla public license version 2.0",
    "CCBY_WORK": "this work is licensed under a creative commons attribution 4.0 international license",
    "CCBY_SHORT": "licensed under cc by 4.0",
    "CCBYSA_WORK": "this work is licensed under a creative commons attribution sharealike 4.0 international license",
    "CCBYNC_WORK": "this work is licensed under a creative commons attribution noncommercial 4.0 international license",
    "CC0_WORK": "this work is dedicated to the public domain under cc0 1.0 universal",
    "UNLICENSE": "this is free and unencumbered software released into the public domain",
    "ISC_GRANT": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "RESERVED": "all rights reserved",
    # the public texts as the splitter cuts them
    "APACHE_HEADER": "licensed under the apache license version 2.0 the license",
    "APACHE_AT": "you may obtain a copy of the license at",
    "APACHE_URL": "http www.apache.org licenses license 2.0",
    "FREE_PROGRAM": "this program is free software",
    "FREE_V3": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "FREE_V2": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "HOPE_USEFUL": "this program is distributed in the hope that it will be useful but without any warranty",
    "HOPE_IMPLIED": "without even the implied warranty of merchantability or fitness for a particular purpose",
    "FREE_LIBRARY": "this library is free software",
    "FREE_FILE": "this file is free software",
    "HOPE_LIBRARY": "this library is distributed in the hope that it will be useful but without any warranty",
    "LGPL_SEE": "see the gnu lesser general public license for more details",
    "AGPL_SEE": "see the gnu affero general public license for more details",
    "LGPL_COPY": "you should have received a copy of the gnu lesser general public license along with this library",
    "AGPL_COPY": "you should have received a copy of the gnu affero general public license along with this program",
    "BSD_SOURCE": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "BSD_BINARY": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "EPL2_NOTICE": "this program and the accompanying materials are made available under the terms of the eclipse public license 2.0 which is available at http www.eclipse.org legal epl 2.0",
    "EPL1_NOTICE": "this program and the accompanying materials are made available under the terms of the eclipse public license v1.0 which accompanies this distribution and is available at http www.eclipse.org legal epl v10.html",
    "ZLIB_GRANT": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "BOOST_NOTICE": "distributed under the boost software license version 1.0",
}
#: Families of the licences that one header text names: identifier, name in the text, versions.
FREE = (("GPL", "general", ("2", "3")), ("LGPL", "lesser general", ("2.1", "3")), ("AGPL", "affero general", ("3",)))
for _family, _name, _ in FREE:
    SENTENCES[f"{_family}_REDISTRIBUTE"] = f"you can redistribute it and or modify it under the terms of the gnu {_name} public license as published by the free software foundation"
for _v in ("2", "2.1", "3"):
    SENTENCES[f"EITHER_V{_v}"] = f"either version {_v} of the license or at your option any later version"
    SENTENCES[f"ONLY_V{_v}"] = f"version {_v} of the license"
for _family, _name, _versions in FREE:
    for _v in _versions:
        for _kind in ("EITHER", "ONLY"):
            if (_family, _kind) != ("GPL", "EITHER"):  # named above
                SENTENCES[f"{_family}_REDISTRIBUTE_{_kind}_V{_v}"] = SENTENCES[f"{_family}_REDISTRIBUTE"] + " " + SENTENCES[f"{_kind}_V{_v}"]
#: Licences by SPDX identifier.
SPDX: tuple[str, ...] = (
    "MIT", "Apache-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later",
    "AGPL-3.0-only", "AGPL-3.0-or-later", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "ISC", "Unlicense", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC-BY-ND-4.0", "CC-BY-NC-SA-4.0", "CC-BY-NC-ND-4.0", "EPL-1.0", "EPL-2.0", "BSL-1.0", "Zlib", "0BSD",
)
#: Older identifiers; with a closing + they name later versions too.
SPDX_OLD = ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0")
_named = lambda name: "SPDX_" + name.upper().replace("-", "_").replace(".", "_")
_tagged = lambda name: "spdx license identifier " + name.lower().replace("-", " ")
SPDX_NAMES = {n: n for n in (*SPDX, *SPDX_OLD)} | {f"{n}-plus": f"{n}-or-later" for n in SPDX_OLD}
SENTENCES |= {_named(n): _tagged(n) for n in SPDX_NAMES}
#: Creative Commons licences besides CC BY: short and long names.
CC = {"SA": "sharealike", "NC": "noncommercial", "ND": "noderivatives", "NC-SA": "noncommercial sharealike", "NC-ND": "noncommercial noderivatives"}
SENTENCES |= {f"CC_{k.replace('-', '_')}_SHORT": f"licensed under cc by {k.lower().replace('-', ' ')} 4.0" for k in CC}
SENTENCES |= {f"CC_{k.replace('-', '_')}_WORK": f"this work is licensed under a creative commons attribution {v} 4.0 international license" for k, v in CC.items() if k not in ("SA", "NC")}

#: Ordered rules: the first that matches at a place takes its sentences.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    *(("Apache-2.0", (notice, "APACHE_MAY_NOT", *copy, *rest)) for rest in (("APACHE_AS_IS", "APACHE_SEE"), ()) for notice in ("APACHE_HEADER", "APACHE_NOTICE") for copy in (("APACHE_AT", "APACHE_URL"), ("APACHE_COPY",)) if (notice, copy) != ("APACHE_NOTICE", ("APACHE_COPY",))),
    *((f"GPL-{v}.0-or-later", ("FREE_PROGRAM", f"FREE_V{v}", *rest)) for v in (3, 2) for rest in (("HOPE_USEFUL", "HOPE_IMPLIED", "GPL_SEE", "GPL_COPY"), ("HOPE_USEFUL", "HOPE_IMPLIED"), ())),
    *((f"{family}-{v if '.' in v else v + '.0'}-{end}", (*free, *terms)) for free in (("FREE_PROGRAM",), ("FREE_LIBRARY",), ("FREE_FILE",)) for family, _, versions in FREE for v in versions for end, kind in (("or-later", "EITHER"), ("only", "ONLY"))
      for terms in ((f"{family}_REDISTRIBUTE", f"{kind}_V{v}"), (f"{family}_REDISTRIBUTE_{kind}_V{v}",)) if terms[0] in SENTENCES),
    *((name, (_named(n),)) for n, name in SPDX_NAMES.items()),
    ("Apache-2.0", ("APACHE_NOTICE", "APACHE_MAY_NOT", "APACHE_COPY", "APACHE_AS_IS", "APACHE_SEE")),
    ("Apache-2.0", ("APACHE_NOTICE", "APACHE_MAY_NOT", "APACHE_COPY")),
    ("MIT", ("MIT_TITLE", "MIT_GRANT", "MIT_NOTICE", "AS_IS")),
    ("MIT", ("MIT_TITLE_SHORT", "MIT_GRANT", "MIT_NOTICE", "AS_IS")),
    ("MIT", ("MIT_GRANT", "MIT_NOTICE", "AS_IS")),
    ("MIT", ("MIT_GRANT", "MIT_NOTICE")),
    ("GPL-3.0-or-later", ("GPL_FREE", "GPL_HOPE", "GPL_SEE", "GPL_COPY")),
    ("GPL-3.0-or-later", ("GPL_FREE", "GPL_HOPE")),
    ("GPL-2.0-or-later", ("GPL2_FREE", "GPL_HOPE", "GPL_SEE", "GPL_COPY")),
    ("GPL-2.0-or-later", ("GPL2_FREE", "GPL_HOPE")),
    ("BSD-3-Clause", ("BSD_REDISTRIBUTION", "BSD_SOURCE", "BSD_BINARY", "BSD_NEITHER")),
    ("BSD-2-Clause", ("BSD_REDISTRIBUTION", "BSD_SOURCE", "BSD_BINARY")),
    ("BSD-3-Clause", ("BSD_REDISTRIBUTION", "BSD_NEITHER")),
    ("BSD-2-Clause", ("BSD_REDISTRIBUTION",)),
    ("ISC", ("ISC_GRANT", "AS_IS")),
    ("ISC", ("ISC_GRANT",)),
    ("Apache-2.0", ("APACHE_HEADER",)),
    ("Apache-2.0", ("APACHE_NOTICE",)),
    ("Apache-2.0", ("APACHE_ANY",)),
    ("MIT", ("MIT_RELEASED",)),
    ("MIT", ("MIT_LICENSED",)),
    ("MIT", ("MIT_WORK",)),
    ("MIT", ("MIT_TITLE",)),
    ("MIT", ("MIT_TITLE_SHORT",)),
    ("GPL-3.0-only", ("GPL3_WORK",)),
    ("GPL-3.0-only", ("GPL3_SHORT",)),
    ("GPL-3.0-or-later", ("GPL_FREE",)),
    ("GPL-2.0-only", ("GPL2_WORK",)),
    ("GPL-2.0-only", ("GPL2_SHORT",)),
    ("GPL-2.0-or-later", ("GPL2_FREE",)),
    ("LGPL-3.0-only", ("LGPL_WORK",)),
    ("AGPL-3.0-only", ("AGPL_WORK",)),
    ("BSD", ("BSD_RELEASED",)),
    ("BSD", ("BSD_LICENSED",)),
    ("BSD-3-Clause", ("BSD3_LICENSED",)),
    ("BSD-2-Clause", ("BSD2_LICENSED",)),
    ("MPL-2.0", ("MPL_NOTICE",)),
    ("MPL-2.0", ("MPL_SHORT",)),
    ("CC-BY-4.0", ("CCBY_WORK",)),
    ("CC-BY-4.0", ("CCBY_SHORT",)),
    ("CC-BY-SA-4.0", ("CCBYSA_WORK",)),
    ("CC-BY-NC-4.0", ("CCBYNC_WORK",)),
    *((f"CC-BY-{k}-4.0", (f"CC_{k.replace('-', '_')}_{form}",)) for k in CC for form in ("SHORT", "WORK") if (k, form) not in (("SA", "WORK"), ("NC", "WORK"))),
    ("CC0-1.0", ("CC0_WORK",)),
    ("EPL-2.0", ("EPL2_NOTICE",)),
    ("EPL-1.0", ("EPL1_NOTICE",)),
    ("Zlib", ("ZLIB_GRANT",)),
    ("BSL-1.0", ("BOOST_NOTICE",)),
    ("Unlicense", ("UNLICENSE",)),
    ("Proprietary", ("RESERVED",)),
)
#: Each known sentence has one of these, so other texts need no cutting.
HINTS = ("licen", "spdx", "redistribut", "warrant", "permission", "domain", "reserved", "software")
#: Lines that begin like a known sentence begin a sentence, whatever stands before, but for beginnings that public texts break lines at.
STARTS = sorted({" ".join(s.split()[:2]) for i, s in SENTENCES.items() if not i.startswith(("SPDX_", "EITHER_", "ONLY_", "BOOST_"))} | {"copyright c", "copyright 19", "copyright 20"})
LINE = r"\n([^A-Za-z0-9\n]*(?i:" + "|".join(s.replace(" ", r"[^A-Za-z0-9\n]+") for s in STARTS) + "))"
BREAK = r"[.!?:;](?:\s+|$)|\n\s*\n|,\s+see\s+"
#: Unknown sentences that may stand between two sentences of a rule; a longer run ends every rule.
GAP = 3
NAME = r"\(*[A-Za-z0-9](?:[A-Za-z0-9.+-]*[A-Za-z0-9+])?\)*"
TAG = rf"(?i:SPDX-License-Identifier):[ \t]*({NAME}(?:[ \t]+(?:OR|AND|WITH)[ \t]+{NAME})*)"
RULE = "|".join(f"(?:{f'(?:_ ){{0,{GAP}}}'.join(i + ' ' for i in ids)})" for _, ids in RULES)
PROPRIETARY = "Proprietary"


def known_sentences(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order, with nulls for others; pieces without a letter or digit are none."""
    table = F.create_map(*(F.lit(x) for i, s in SENTENCES.items() for x in (s, i)))
    tagged = F.regexp_replace(text, TAG, ". SPDX-License-Identifier=$1. ")
    pieces = F.split(F.regexp_replace(tagged, LINE, ". $1"), BREAK, -1)
    declared = lambda s: F.transform(F.split(F.regexp_replace(F.regexp_replace(F.element_at(F.split(s, "="), -1), "[()]", ""), r"\+", "-plus"), r"\s+(?:OR|AND|WITH)\s+"), lambda x: F.concat(F.lit("spdx license identifier "), x))
    sentences = F.flatten(F.transform(pieces, lambda s: F.when(s.rlike(r"^\W*SPDX-License-Identifier="), declared(s)).otherwise(F.array(s))))
    return F.transform(F.filter(F.transform(sentences, _plain), lambda s: s != ""), lambda s: F.try_element_at(table, s))


def _plain(s: Column) -> Column:
    """Letters, digits and points in lower case; one spelling of licence and of addresses, and one holder of a name."""
    s = F.regexp_replace(F.regexp_replace(F.lower(s), r"[^a-z0-9.]+", " "), r"^[ .]+|[ .]+$", "")
    s = F.regexp_replace(F.regexp_replace(s, "licence", "license"), "(^| )https ", "$1http ")
    return F.regexp_replace(s, "^neither the names? of .* nor the names of its contributors may", "neither the name of the copyright holder nor the names of its contributors may")


def scan(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (doc_id, sentence_ids, licenses, n_sentences, expressions), one for each input row.

    ``licenses`` are the rules' names in the order of the text, comma-joined, ``expressions`` the SPDX expressions as written, joined by semicolons.
    """
    names = F.create_map(*(F.lit(x) for name, ids in reversed(RULES) for x in ("".join(i + " " for i in ids), name)))
    lowered = docs.select(F.col(id_column).alias("doc_id"), text_or_empty(text_column).alias("text"), F.lower(text_or_empty(text_column)).alias("_low"))
    texts = lowered.select("doc_id", "text", reduce(lambda a, b: a | b, (F.contains("_low", F.lit(h)) for h in HINTS)).alias("_hinted"))
    known = F.when(F.col("_hinted"), known_sentences(F.col("text"))).otherwise(F.array().cast("array<string>"))
    expressions = F.regexp_extract_all("text", F.lit(TAG), F.lit(1))
    found = texts.select("doc_id", known.alias("_known"), F.when(F.col("_hinted"), F.array_join(expressions, ";")).otherwise("").alias("expressions"))
    marks = F.concat(F.array_join(F.transform("_known", lambda i: F.coalesce(i, F.lit("_"))), " "), F.lit(" "))
    hits = F.regexp_extract_all(F.regexp_replace(marks, f"(?:_ ){{{GAP + 1},}}", "| "), F.lit(RULE), F.lit(0))
    named = F.transform(hits, lambda m: names[F.replace(m, F.lit("_ "), F.lit(""))])
    told = found.select("doc_id", F.array_compact("_known").alias("_ids"), named.alias("_names"), "expressions")
    others = F.filter("_names", lambda n: n != PROPRIETARY)
    return told.select("doc_id", F.array_join("_ids", " ").alias("sentence_ids"), F.array_join(F.when(F.size(others) > 0, others).otherwise(F.col("_names")), ",").alias("licenses"), F.size("_ids").cast("long").alias("n_sentences"), "expressions")


def sql() -> str:
    """DuckDB SQL of ``scan`` over documents: the same tables of sentences and rules, its own patterns and order of steps."""
    known = ", ".join(f"('{s}', '{i}')" for i, s in SENTENCES.items())
    rules = ", ".join(f"({k}, '{' '.join(ids)}', '{name}')" for k, (name, ids) in enumerate(RULES))
    sequences = "|".join(" ([_] ){0,3}".join(ids) + " " for _, ids in RULES)
    starts = "|".join("[^a-zA-Z0-9\n]+".join(s.split()) for s in STARTS)
    name = "[(]*[0-9A-Za-z]([0-9A-Za-z.+-]*[0-9A-Za-z+])?[)]*"
    tag = f"(?i:spdx-license-identifier):[\t ]*({name}([\t ]+(AND|OR|WITH)[\t ]+{name})*)"
    return rf"""with known(s, id) as (values {known}), rules(k, seq, name) as (values {rules}),
d as (select row_number() over () r, doc_id, coalesce(text, '') t from documents),
lines as (select r, unnest(p) s, generate_subscripts(p, 1) i from (select r, string_split_regex(regexp_replace(regexp_replace(t, '{tag}', '. SPDX-License-Identifier=\1. ', 'g'), '\n([^a-zA-Z0-9\n]*(?i:{starts}))', '. \1', 'g'), '(?:[:;.?!](?:\s+|$))|(?:\n\s*\n)|(?:,\s+see\s+)') p from d)),
parts as (select r, i, unnest(q) s, generate_subscripts(q, 1) j from (select r, i, case when regexp_matches(s, '^\W*SPDX-License-Identifier=') then list_transform(string_split_regex(replace(translate(regexp_extract(s, '[^=]*$'), '()', ''), '+', '-plus'), '\s+(?:AND|WITH|OR)\s+'), lambda x: 'spdx license identifier ' || x) else [s] end q from lines)),
plain as (select r, i, j, regexp_replace(replace(regexp_replace(regexp_replace(lower(s), '[^0-9a-z.]+', ' ', 'g'), '(^[. ]+)|([. ]+$)', '', 'g'), 'licence', 'license'), '(^| )https ', '\1http ', 'g') s from parts),
cut as (select r, i, j, case when regexp_matches(s, '^neither the names? of .* nor the names of its contributors may') then regexp_replace(s, '^neither the names? of .* nor the names', 'neither the name of the copyright holder nor the names') else s end s from plain where s <> ''),
ids as (select r, string_agg(id, ' ' order by i, j) ids, count(id) n, string_agg(coalesce(id, '_'), ' ' order by i, j) || ' ' marks from cut left join known using (s) group by r),
hits as (select r, unnest(m) hit, generate_subscripts(m, 1) k from (select r, regexp_extract_all(regexp_replace(marks, '([_] ){{4,}}', '# ', 'g'), '{sequences}') m from ids where n > 0)),
first_rule as (select seq, arg_min(name, k) name from rules group by seq),
named as (select r, k, name from hits join first_rule on seq = trim(replace(hit, '_ ', ''))),
kept as (select r, string_agg(name, ',' order by k) names from named where name <> 'Proprietary' or r not in (select r from named where name <> 'Proprietary') group by r)
select doc_id, coalesce(ids, '') sentence_ids, coalesce(names, '') licenses, coalesce(n, 0)::bigint n_sentences, array_to_string(regexp_extract_all(t, '{tag}', 1), ';') expressions from d left join ids using (r) left join kept using (r)"""
