"""License scans by sentence rules, in DataFrame functions only.

A document's text is cut into sentences, which may be wrapped over lines, and sentences with a licence word are
normalised: A-Z in lower case, everything but letters, digits and dots to one
blank.  ``SENTENCES`` names the known ones (the first pattern that matches a
whole sentence counts); a licence sentence that none matches is unknown.  The
identifiers of a document, in text order, are matched against ``RULES``: a rule
asks for identifiers in its order, other sentences may stand between, and does
not apply if one of its exceptions is there.

One pass without a shuffle; documents without a licence word go through one
regular expression only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .workspace import documents

#: Words of the SQL's filter.
WORDS = "licen[sc]e|copyright|spdx|permission|warrant|redistribut|all rights reserved|public domain|liable|copyleft|creative commons"
#: Texts without any of these have no licence sentence; each pattern below contains one.
FILTER = (WORDS + r"|\bcc by\b|\bcc0\b|\bapache 2[.]0").replace(" ", "[^a-z0-9.]+")
_CUT = "\x01"
#: Newlines that end a sentence: after a colon, at a blank line, before a list item or the start of a known sentence.
_ENDS = (
    r"(?<=:)[ \t\r]*\n", r"\n[^\p{L}\p{N}]*\n", r"\n(?=[* ][ \t*#/>]*(?:[0-9]{1,2}[.)]|[a-i][.)]|\([0-9a-i]{1,3}\)|[-+•])[ \t]|(?:[0-9]{1,2}[.)]|[a-i][.)]|\([0-9a-i]{1,3}\)|[-+*•])[ \t])",
    r"\n(?=[^a-z0-9\n]*(?:spdx|copyright (?:\(c\)|©|[12][0-9]{3})|all rights reserved|permission is hereby|permission to use|redistributions? |unless required by|you may not use this|the above copyright notice and this|the software is provided|in no event|this program is|neither the name))",
    r"(?<=identifier: [a-z0-9.+-]{2,40})[ \t\r]*\n",
)
#: Identifiers of patterns that match almost any text around a few words.
_LOOSE = ("unknown", "copyright", "public-domain", "rights-reserved", "spdx-other")
_S = "(?:this (?:work|software|program|file|code|document|text|project|content) is |released |distributed |provided |available |it is )*"
_L = "(?:licen[sc]ed |released |distributed |available |provided |published )"
_U = "(?:under |by |per )?(?:the )?(?:terms of )?(?:the )?"

#: Identifier and pattern of known licence sentences, most specific first.
SENTENCES = (
    ("spdx-mit", "(?:.* )?spdx license identifier:? mit"),
    ("spdx-apache-2.0", "(?:.* )?spdx license identifier:? apache 2.0"),
    ("spdx-gpl-3.0-or-later", "(?:.* )?spdx license identifier:? gpl 3.0 or later"),
    ("spdx-gpl-3.0", "(?:.* )?spdx license identifier:? gpl 3.0(?: only)?"),
    ("spdx-gpl-2.0", "(?:.* )?spdx license identifier:? gpl 2.0(?: only| or later)?"),
    ("spdx-bsd-3-clause", "(?:.* )?spdx license identifier:? bsd 3 clause"),
    ("spdx-bsd-2-clause", "(?:.* )?spdx license identifier:? bsd 2 clause"),
    ("spdx-mpl-2.0", "(?:.* )?spdx license identifier:? mpl 2.0"),
    ("spdx-isc", "(?:.* )?spdx license identifier:? isc"),
    ("spdx-other", "(?:.* )?spdx license identifier:? .+"),
    ("cc-by-nc-sa", f"{_S}{_L}{_U}(?:cc by nc sa|creative commons attribution noncommercial sharealike)(?: [0-9.]+)?(?: international)?(?: license)?"),
    ("cc-by-nc-nd", f"{_S}{_L}{_U}(?:cc by nc nd|creative commons attribution noncommercial noderivatives)(?: [0-9.]+)?(?: international)?(?: license)?"),
    ("cc-by-nc", f"{_S}{_L}{_U}(?:cc by nc|creative commons attribution noncommercial)(?: [0-9.]+)?(?: international)?(?: license)?"),
    ("cc-by-sa", f"{_S}{_L}{_U}(?:cc by sa|creative commons attribution sharealike)(?: [0-9.]+)?(?: international)?(?: license)?"),
    ("cc-by-nd", f"{_S}{_L}{_U}(?:cc by nd|creative commons attribution noderivatives)(?: [0-9.]+)?(?: international)?(?: license)?"),
    ("cc-by", f"{_S}{_L}{_U}(?:cc by|creative commons attribution)(?: [0-9.]+)?(?: international)?(?: license)?"),
    ("cc0", f"{_S}(?:{_L}{_U})?(?:cc0|creative commons zero)(?: [0-9.]+)?.*"),
    ("apache-2.0-notice", f"{_S}{_L}{_U}apache license,? version 2.0(?: the license)?"),
    ("apache-2.0-notice", f"{_S}{_L}{_U}apache 2.0(?: license)?"),
    ("apache-2.0-compliance", "you may not use this file except in compliance with the license"),
    ("apache-2.0-warranty", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis.*"),
    ("agpl-3.0-notice", f"{_S}{_L}?{_U}gnu affero general public license(?: version 3)?.*"),
    ("lgpl-notice", f"{_S}{_L}?{_U}gnu (?:lesser|library) general public license(?: version [0-9.]+)?.*"),
    ("gpl-3.0-or-later-notice", f"{_S}{_L}?{_U}gnu general public license version 3 or (?:at your option )?any later version"),
    ("gpl-3.0-notice", f"{_S}{_L}{_U}gnu general public license version 3(?:.0)?"),
    ("gpl-2.0-or-later-notice", f"{_S}{_L}?{_U}gnu general public license version 2 or (?:at your option )?any later version"),
    ("gpl-2.0-notice", f"{_S}{_L}{_U}gnu general public license version 2(?:.0)?"),
    ("gpl-grant", "(?:this program is free software )?you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation.*"),
    ("gpl-warranty", "this program is distributed in the hope that it will be useful but without any warranty.*"),
    ("gpl-notice", f"{_S}{_L}{_U}gnu general public license"),
    ("mit-notice", f"{_S}{_L}{_U}(?:mit|expat) license"),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software.*"),
    ("mit-condition", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit-warranty", "the software is provided as is without warranty of any kind.*"),
    ("liability", "in no event shall the (?:authors or )?copyright holders? .*liable.*"),
    ("bsd-grant", "redistribution and use in source and binary forms with or without modification are permitted.*"),
    ("bsd-source", "(?:[0-9.]+ )?redistributions of source code must retain the above copyright notice.*"),
    ("bsd-binary", "(?:[0-9.]+ )?redistributions in binary form must reproduce the above copyright notice.*"),
    ("bsd-endorse", "(?:[0-9.]+ )?neither the name of .* may be used to endorse or promote products.*without.*permission"),
    ("bsd-notice", f"{_S}{_L}{_U}(?:new |modified |[23] clause )?bsd(?: [23] clause)? license"),
    ("isc-grant", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted.*"),
    ("mpl-2.0-notice", "this source code form is subject to the terms of the mozilla public license v. 2.0"),
    ("mpl-2.0-notice", f"{_S}{_L}{_U}mozilla public license(?: version)? 2.0"),
    ("public-domain", "(?:.* )?(?:public domain|unlicense).*"),
    ("rights-reserved", "(?:.* )?all rights reserved"),
    ("copyright", "(?:.* )?copyright (?:c )?.*"),
)
#: Licence, identifiers in order, and identifiers that rule it out.
RULES = (
    ("Apache-2.0", ("spdx-apache-2.0",), ()), ("MIT", ("spdx-mit",), ()), ("GPL-3.0-or-later", ("spdx-gpl-3.0-or-later",), ()),
    ("GPL-3.0", ("spdx-gpl-3.0",), ()), ("GPL-2.0", ("spdx-gpl-2.0",), ()), ("BSD-3-Clause", ("spdx-bsd-3-clause",), ()),
    ("BSD-2-Clause", ("spdx-bsd-2-clause",), ()), ("MPL-2.0", ("spdx-mpl-2.0",), ()), ("ISC", ("spdx-isc",), ()),
    ("Other-SPDX", ("spdx-other",), ()), ("CC-BY-NC-SA", ("cc-by-nc-sa",), ()), ("CC-BY-NC-ND", ("cc-by-nc-nd",), ()),
    ("CC-BY-NC", ("cc-by-nc",), ()), ("CC-BY-SA", ("cc-by-sa",), ()), ("CC-BY-ND", ("cc-by-nd",), ()), ("CC-BY", ("cc-by",), ()), ("CC0-1.0", ("cc0",), ()),
    ("Apache-2.0", ("apache-2.0-notice",), ("spdx-apache-2.0",)), ("Apache-2.0", ("apache-2.0-compliance", "apache-2.0-warranty"), ("apache-2.0-notice", "spdx-apache-2.0")),
    ("AGPL-3.0", ("agpl-3.0-notice",), ()), ("LGPL", ("lgpl-notice",), ()), ("GPL-3.0-or-later", ("gpl-3.0-or-later-notice",), ("spdx-gpl-3.0-or-later",)),
    ("GPL-3.0", ("gpl-3.0-notice",), ("spdx-gpl-3.0", "gpl-3.0-or-later-notice")), ("GPL-2.0-or-later", ("gpl-2.0-or-later-notice",), ()),
    ("GPL-2.0", ("gpl-2.0-notice",), ("spdx-gpl-2.0", "gpl-2.0-or-later-notice")), ("GPL", ("gpl-grant", "gpl-warranty"), ("gpl-3.0-notice", "gpl-2.0-notice", "gpl-3.0-or-later-notice", "gpl-2.0-or-later-notice")),
    ("GPL", ("gpl-notice",), ("gpl-grant",)), ("MIT", ("mit-notice",), ("spdx-mit",)), ("MIT", ("mit-grant", "mit-condition", "mit-warranty"), ("mit-notice", "spdx-mit")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"), ("spdx-bsd-3-clause",)),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary"), ("bsd-endorse", "spdx-bsd-2-clause")), ("BSD", ("bsd-notice",), ("bsd-grant",)),
    ("ISC", ("isc-grant",), ("spdx-isc",)), ("MPL-2.0", ("mpl-2.0-notice",), ("spdx-mpl-2.0",)), ("Public-Domain", ("public-domain",), ()),
    ("Proprietary", ("rights-reserved",), ("mit-notice", "mit-grant", "bsd-grant", "apache-2.0-notice", "gpl-grant", "isc-grant")),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rule_pattern(ids: tuple[str, ...]) -> str:
    return ";" + ";(?:.*;)?".join(x.replace(".", "[.]") for x in ids) + ";"


def any_pattern(ids: tuple[str, ...]) -> str:
    return ";(?:" + "|".join(x.replace(".", "[.]") for x in ids) + ");"


def normalise(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(sentence, "[^a-z0-9.]+", " "), "[.]+( |$)", " "))


def pieces(text: Column) -> Column:
    """Sentences with a licence word, in lower case, whose lines may be wrapped; in text order."""
    low = F.translate(text, _UPPER, _LOWER)
    for end in _ENDS:
        low = F.regexp_replace(low, end, _CUT)
    cut = F.split(F.regexp_replace(low, f"([.;!?])[ \\t\\r\\n{_CUT}]+", f"$1{_CUT}"), _CUT)
    return F.filter(cut, lambda x: F.rlike(x, F.lit(FILTER)))


def identifiers(text: Column) -> Column:
    """Identifiers of a text's licence sentences, in text order.

    A sentence over several lines is read as one, unless its lines by themselves
    are known sentences of another kind, or are known where the whole is not.
    """
    has = lambda x: F.rlike(x, F.lit(FILTER))
    lines = lambda x: F.when(F.contains(x, F.lit("\n")), F.transform(F.filter(F.transform(F.filter(F.split(x, "\n"), has), normalise), has), identify)).otherwise(F.array().cast("array<string>"))
    both = F.transform(pieces(text), lambda x: F.struct(normalise(x).alias("s"), lines(x).alias("parts")))
    both = F.transform(F.filter(both, lambda x: has(x.s)), lambda x: F.struct(identify(x.s).alias("whole"), x.parts.alias("parts")))

    def pick(x: Column) -> Column:
        apart = F.exists(x.parts, lambda p: ~p.isin(*_LOOSE) & (p != x.whole)) | (x.whole.isin(*_LOOSE) & F.exists(x.parts, lambda p: p != "unknown"))
        return F.when(apart, x.parts).otherwise(F.array(x.whole))

    return F.flatten(F.transform(both, pick))


def identify(sentence: Column) -> Column:
    out = None
    for name, pattern in SENTENCES:
        hit = F.rlike(sentence, F.lit(f"^(?:{pattern})$"))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("unknown")


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_sentences, n_unknown, sentence_ids, licenses) of documents with a licence sentence.

    sentence_ids and licenses are joined by semicolons and commas; licenses is
    empty where no rule applies.  Repeated rows are each returned, also those
    without a key; null and empty texts, and empty tables, give no row.  Texts
    of any length are read whole, other columns are not read.
    """
    hit = docs.select(F.col(key), F.translate(F.col(text).cast("string"), _UPPER, _LOWER).alias("__text")).where(F.rlike("__text", F.lit(FILTER)))
    ids = hit.select(key, identifiers(F.col("__text")).alias("ids")).where(F.size("ids") > 0)
    seq = F.concat(F.lit(";"), F.array_join("ids", ";"), F.lit(";"))
    found = []
    for name, wants, unless in RULES:
        ok = F.rlike("seq", F.lit(rule_pattern(wants)))
        if unless:
            ok = ok & ~F.rlike("seq", F.lit(any_pattern(unless)))
        found.append(F.when(ok, F.lit(name)))
    return ids.withColumn("seq", seq).select(
        key, F.size("ids").cast("bigint").alias("n_sentences"), F.size(F.filter("ids", lambda x: x == "unknown")).cast("bigint").alias("n_unknown"),
        F.array_join("ids", ";").alias("sentence_ids"), F.array_join(F.array_compact(F.array(*found)), ",").alias("licenses"),
    )


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))


def _sql() -> str:
    case = " ".join(f"WHEN regexp_full_match(s, '{p}') THEN '{n}'" for n, p in SENTENCES)
    rules = ", ".join(
        f"CASE WHEN regexp_matches(seq, '{rule_pattern(w)}')" + (f" AND NOT regexp_matches(seq, '{any_pattern(u)}')" if u else "") + f" THEN '{n}' END" for n, w, u in RULES
    )
    return f"""
WITH low AS (SELECT doc_id, translate(text, '{_UPPER}', '{_LOWER}') AS t FROM documents),
cut AS (SELECT doc_id, list_filter(string_split(regexp_replace(t, '([.;!?])[ \\t\\r\\n]+', '\\1' || chr(10), 'g'), chr(10)), lambda x: regexp_matches(x, '{WORDS}')) AS c FROM low WHERE regexp_matches(t, '{WORDS}')),
norm AS (SELECT doc_id, list_filter(list_transform(c, lambda x: trim(regexp_replace(regexp_replace(x, '[^a-z0-9.]+', ' ', 'g'), '[.]+( |$)', ' ', 'g'))), lambda x: regexp_matches(x, '{WORDS}')) AS c FROM cut),
ids AS (SELECT doc_id, list_transform(c, lambda s: CASE {case} ELSE 'unknown' END) AS ids FROM norm WHERE len(c) > 0),
seqs AS (SELECT *, ';' || array_to_string(ids, ';') || ';' AS seq FROM ids)
SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_sentences, CAST(len(list_filter(ids, lambda x: x = 'unknown')) AS BIGINT) AS n_unknown,
  array_to_string(ids, ';') AS sentence_ids, array_to_string(list_filter([{rules}], lambda x: x IS NOT NULL), ',') AS licenses FROM seqs
"""


QUERIES = {"op2_license_scan": op2_licenses}
ORACLES = {"op2_license_scan": _sql()}
