"""Licence recognition by sentence rules.

A text is cut into sentences (line ends, and stops followed by white space); each is
lower-cased, and everything but letters, digits and inner dots becomes one space. Lines of
one paragraph that make up a known sentence together, without a stop at a line end, are
joined before (the longest known sentence first) and count as one sentence. A
sentence that equals a known one gets that sentence's identifier. The identifiers of a
document, in order, are matched against ordered rules: a rule is a sequence of
identifiers that stand together for a licence; earlier rules take theirs first, and what
no rule takes is reported as left over. DataFrame functions only; sentences and rules
are parameters.

Defined results: a null or empty text has no sentences; ids may be null or repeated (each
row is judged by itself); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Statements by which public licences are commonly declared, normalised; the
# licences' own sentences stand as STOP cuts them from the published texts.
SENTENCES = {
    "released under the mit license": "mit.ref",
    "licensed under the mit license": "mit.ref",
    "this project is licensed under the mit license": "mit.ref",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit.grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit.notice",
    "the software is provided as is without warranty of any kind express or implied": "asis",
    "licensed under the apache license version 2.0": "apache2.ref",
    "licensed under the apache license version 2.0 the license": "apache2.ref",
    "you may not use this file except in compliance with the license": "apache2.comply",
    "you may obtain a copy of the license at": "apache2.copy",
    "this work is licensed under the gnu general public license version 3": "gpl3.ref",
    "licensed under the gnu general public license version 3": "gpl3.ref",
    "licensed under the gnu general public license version 2": "gpl2.ref",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl.free",
    "either version 3 of the license or at your option any later version": "gpl3.later",
    "either version 2 of the license or at your option any later version": "gpl2.later",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd.source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd.binary",
    "licensed under cc by nc 4.0": "ccbync4.ref",
    "licensed under cc by 4.0": "ccby4.ref",
    "licensed under cc by sa 4.0": "ccbysa4.ref",
    "all rights reserved": "reserved",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit.grant",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "asis",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "mit.liable",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc.grant",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc.grant",
    "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness": "isc.asis",
    "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software": "isc.liable",
    "licensed under the isc license": "isc.ref",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd.grant",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd.name",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "bsd.asis",
    "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services": "bsd.liable",
    "in no event shall the copyright owner or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services": "bsd.liable",
    "in no event shall the copyright holders or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services": "bsd.liable",
    "loss of use data or profits": "bsd.loss",
    "or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage": "bsd.caused",
    "licensed under the bsd 3 clause license": "bsd3.ref",
    "licensed under the bsd 2 clause license": "bsd2.ref",
    "this program is free software": "free",
    "this library is free software": "free",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl.terms",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3.terms",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2.terms",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation": "lgpl.terms",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "lgpl3.terms",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2.1 of the license or at your option any later version": "lgpl21.terms",
    "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "agpl3.terms",
    "either version 2.1 of the license or at your option any later version": "lgpl21.later",
    "this source code form is subject to the terms of the mozilla public license v": "mpl.form",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla.org mpl 2.0": "mpl2.copy",
    "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla.org mpl 2.0": "mpl2.copy",
    "licensed under the mozilla public license version 2.0": "mpl2.ref",
    "cc0 1.0 universal": "cc0.ref",
    "licensed under cc0 1.0": "cc0.ref",
    "licensed under cc0 1.0 universal": "cc0.ref",
    "the laws of most jurisdictions throughout the world automatically confer exclusive copyright and related rights defined below upon the creator and subsequent owner s each and all an owner of an original work of authorship and or a database each a work": "cc0.laws",
}
_BSD_END = ["bsd.asis", "bsd.liable", "bsd.loss", "bsd.caused"]
# Licences and the sentence identifiers that declare them, longest first.
RULES = [
    ("BSD-3-Clause", ["bsd.grant", "bsd.source", "bsd.binary", "bsd.name", *_BSD_END]),
    ("BSD-2-Clause", ["bsd.grant", "bsd.source", "bsd.binary", *_BSD_END]),
    ("BSD-3-Clause", ["bsd.grant", "bsd.source", "bsd.binary", "bsd.name"]),
    ("MIT", ["mit.grant", "mit.notice", "asis", "mit.liable"]),
    ("BSD-3-Clause", ["bsd.source", "bsd.binary", "bsd.name"]),
    ("BSD-2-Clause", ["bsd.grant", "bsd.source", "bsd.binary"]),
    ("ISC", ["isc.grant", "isc.asis", "isc.liable"]),
    ("GPL-3.0-or-later", ["free", "gpl.terms", "gpl3.later"]),
    ("GPL-2.0-or-later", ["free", "gpl.terms", "gpl2.later"]),
    ("LGPL-3.0-or-later", ["free", "lgpl.terms", "gpl3.later"]),
    ("LGPL-2.1-or-later", ["free", "lgpl.terms", "lgpl21.later"]),
    ("GPL-3.0-or-later", ["free", "gpl3.terms"]),
    ("GPL-2.0-or-later", ["free", "gpl2.terms"]),
    ("LGPL-3.0-or-later", ["free", "lgpl3.terms"]),
    ("LGPL-2.1-or-later", ["free", "lgpl21.terms"]),
    ("AGPL-3.0-or-later", ["free", "agpl3.terms"]),
    ("MPL-2.0", ["mpl.form", "mpl2.copy"]),
    ("CC0-1.0", ["cc0.ref", "cc0.laws"]),
    ("MIT", ["mit.grant", "mit.notice", "asis"]),
    ("MIT", ["mit.grant", "mit.notice"]),
    ("Apache-2.0", ["apache2.ref", "apache2.comply", "apache2.copy"]),
    ("Apache-2.0", ["apache2.ref", "apache2.comply"]),
    ("GPL-3.0-or-later", ["gpl.free", "gpl3.later"]),
    ("GPL-2.0-or-later", ["gpl.free", "gpl2.later"]),
    ("BSD-2-Clause", ["bsd.source", "bsd.binary"]),
    ("MIT", ["mit.ref"]),
    ("Apache-2.0", ["apache2.ref"]),
    ("GPL-3.0-only", ["gpl3.ref"]),
    ("GPL-2.0-only", ["gpl2.ref"]),
    ("CC-BY-NC-4.0", ["ccbync4.ref"]),
    ("CC-BY-4.0", ["ccby4.ref"]),
    ("CC-BY-SA-4.0", ["ccbysa4.ref"]),
    ("ISC", ["isc.grant"]),
    ("ISC", ["isc.ref"]),
    ("BSD-3-Clause", ["bsd3.ref"]),
    ("BSD-2-Clause", ["bsd2.ref"]),
    ("MPL-2.0", ["mpl2.ref"]),
    ("CC0-1.0", ["cc0.ref"]),
    ("CC0-1.0", ["cc0.laws"]),
    ("AllRightsReserved", ["reserved"]),
]

STOP = r"[.!?;:](?:[ \t\r]+|(?=\n))"
NOISE = r"[^\p{L}\p{N}.]+"


def _sequence(ids: list[str]) -> str:
    return "".join(f"<{i}>" for i in ids)


def _joined(plain: Column, known: dict[str, str]) -> Column:
    """The normalised lines, where lines in a row that make up a known sentence are one. An
    empty line stands after each stop, so nothing is joined over it."""
    several = sorted((k for k in known if " " in k), key=len, reverse=True)
    if not several:
        return plain
    wrapped = "|".join(r"[ \n]".join(re.escape(w) for w in k.split(" ")) for k in several)
    marked = F.regexp_replace(F.concat(F.lit("\n"), F.array_join(plain, "\n"), F.lit("\n")), rf"(?<=\n)(?:{wrapped})(?=\n)", "\x01$0\x01")
    parts = F.transform(F.split(marked, "\x01", -1), lambda x, i: F.when(i % 2 == 1, F.translate(x, "\n", " ")).otherwise(x))
    return F.split(F.array_join(parts, ""), "\n", -1)


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  sentences: dict[str, str] | None = None, rules: list[tuple[str, list[str]]] | None = None) -> DataFrame:
    """One row per document: id, ``n_sentences`` (those with a letter or digit), ``n_known``,
    ``sentence_ids`` as ``<id><id>...``, ``licenses`` by place, joined by commas, and
    ``left_over`` identifiers in the same form as ``sentence_ids``."""
    known = SENTENCES if sentences is None else sentences
    rules = RULES if rules is None else rules
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair]) if known else F.create_map().cast("map<string,string>")
    longest = max(map(len, known), default=0)
    lines = F.split(F.regexp_replace(F.lower(F.coalesce(F.col(text_col), F.lit(""))), STOP, "\n\n"), "\n", -1)
    plain = F.transform(lines, lambda s: F.btrim(F.regexp_replace(s, NOISE, " "), F.lit(" .")))
    out = df.select(F.col(id_col).alias(id_col), plain.alias("__plain"))
    out = out.select(id_col, _joined(F.col("__plain"), known).alias("__plain"))
    out = out.select(id_col, F.filter("__plain", lambda s: s != "").alias("__plain"))
    ids = F.transform(F.filter("__plain", lambda s: F.length(s) <= longest), lambda s: table[s])
    out = out.select(id_col, F.size("__plain").cast("long").alias("n_sentences"), F.filter(ids, lambda i: i.isNotNull()).alias("__ids"))
    seq = F.concat_ws("", F.transform("__ids", lambda i: F.concat(F.lit("<"), i, F.lit(">"))))
    out = out.select(id_col, "n_sentences", F.size("__ids").cast("long").alias("n_known"), seq.alias("sentence_ids"))
    taken = reduce(lambda s, rule: F.replace(s, F.lit(_sequence(rule[1])), F.lit("{" + rule[0] + "}")), rules, F.col("sentence_ids"))
    out = out.select("*", taken.alias("__taken"))
    return out.select(id_col, "n_sentences", "n_known", "sentence_ids",
                      F.concat_ws(",", F.regexp_extract_all("__taken", F.lit(r"\{([^}]+)\}"), 1)).alias("licenses"),
                      F.regexp_replace("__taken", r"\{[^}]+\}", "").alias("left_over"))
