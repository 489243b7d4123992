"""Licence scans by sentence rules: known sentences become identifiers, ordered rules read their sequence.

Texts are cut into sentences, normalised (lower case, anything but letters and digits as one space) and mapped to
the one-letter identifiers of known licence sentences. A document is then a short string of identifiers in
text order, where a full stop stands for any other sentence; each rule is a sequence of identifiers that has to
occur in that order with at most ``GAP`` unknown sentences in between. Notices and full texts of the same licence
are different rules of one licence, and a rule that asks for more sentences outranks a shorter one it contains.

Row-local DataFrame work on the JVM. Texts without any cue word, most of them, are settled by one scan; every known
sentence contains a cue (checked below), so nothing is missed.

Defined cases: NULL and empty texts have no sentence and no licence; rows are judged alone, so repeated rows and
ties agree; a licence named twice is listed once; only id and text are read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import whole

CUES = "licen|copyright|rights reserved|warrant|permission|redistribut|public domain|spdx"
GAP = 2

#: Sentences of public licence texts and notices, normalised, each with its identifier.
SENTENCES = {
    "a": "released under the mit license",
    "b": "licensed under the mit license",
    "c": "this project is licensed under the mit license",
    "d": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",
    "e": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "f": "the software is provided as is without warranty of any kind express or implied",
    "g": "licensed under the apache license version 2 0",
    "h": "licensed under the apache license version 2 0 the license",
    "i": "you may not use this file except in compliance with the license",
    "j": "you may obtain a copy of the license at",
    "k": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "l": "this work is licensed under the gnu general public license version 3",
    "m": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "n": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "o": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "p": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "q": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "r": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission redistribution",
    "s": "this is free and unencumbered software released into the public domain",
    "t": "this work is licensed under a creative commons attribution 4 0 international license",
    "u": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "v": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "w": "all rights reserved",
    "x": "spdx license identifier mit",
    "y": "spdx license identifier apache 2 0",
    "z": "spdx license identifier gpl 3 0 or later",
    "A": "licensed under cc by nc 4 0",
}
#: Licence, then the alternatives of identifiers at each place of the sequence.
RULES = (
    ("mit", "d", "e", "f"), ("mit", "d", "e"), ("mit", "abcx"),
    ("apache-2.0", "gh", "i", "j", "k"), ("apache-2.0", "ghy"),
    ("gpl-3.0", "m", "n"), ("gpl-3.0", "lmz"),
    ("bsd-3-clause", "o", "p", "q", "r"), ("bsd-2-clause", "o", "p", "q"),
    ("unlicense", "s"), ("cc-by-4.0", "t"), ("cc-by-nc-4.0", "A"), ("mpl-2.0", "u"), ("isc", "v"),
    ("proprietary", "w"),
)
#: A licence whose rule contains another licence's, and that other.
CONTAINS = {"bsd-3-clause": "bsd-2-clause"}

if not all(re.search(CUES, s) for s in SENTENCES.values()):
    raise ValueError("a known sentence lacks a cue word")


def pattern(places: tuple[str, ...]) -> str:
    """The rule as a pattern over a document's identifiers."""
    return ("[.]{0,%d}" % GAP).join(f"[{p}]" for p in places)


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_sentences (of texts with a cue), codes (identifiers in order), n_known, rules and licences (comma-joined)."""
    df = docs.select(F.col(key).alias("doc_id"), whole(F.col(text)).alias("_t"))
    cued = F.col("_t").rlike(f"(?i)(?:{CUES})")
    plain = F.transform(F.split("_t", "\n+|(?<=[.!?;]) +"), lambda s: F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " ")))
    df = df.withColumn("_s", F.when(cued, F.array_remove(plain, "")).otherwise(F.expr("cast(array() as array<string>)")))
    table = F.create_map(*[F.lit(x) for code, sentence in SENTENCES.items() for x in (sentence, code)])
    df = df.withColumn("codes", F.array_join(F.transform("_s", lambda s: F.coalesce(F.try_element_at(table, s), F.lit("."))), ""))
    hits = F.array(*[F.when(F.col("codes").rlike(pattern(places)), F.lit(k)) for k, (_, *places) in enumerate(RULES)])
    df = df.withColumn("_r", F.array_compact(hits))
    names = F.array(*[F.lit(name) for name, *_ in RULES])
    found = F.array_sort(F.array_distinct(F.transform("_r", lambda k: F.get(names, k))))
    df = df.withColumn("_l", found)
    for more, less in CONTAINS.items():
        df = df.withColumn("_l", F.when(F.array_contains("_l", more), F.array_remove("_l", less)).otherwise(F.col("_l")))
    return df.select(
        "doc_id", F.size("_s").cast("long").alias("n_sentences"), "codes", F.length(F.translate("codes", ".", "")).cast("long").alias("n_known"),
        F.array_join(F.transform("_r", lambda k: k.cast("string")), ",").alias("rules"), F.array_join("_l", ",").alias("licences"))


def query(spark, sf_dir: str) -> DataFrame:
    """op10: the licences that every document names."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_CASE = " ".join(f"when '{s}' then '{c}'" for c, s in SENTENCES.items())
_HITS = ", ".join(f"case when regexp_matches(codes, '{pattern(tuple(places))}') then {k} end" for k, (_, *places) in enumerate(RULES))
_NAMES = ", ".join(f"'{name}'" for name, *_ in RULES)
SQL = f"""
with d as (select doc_id, coalesce(text, '') as t from documents),
s as (select doc_id, case when regexp_matches(t, '(?i)(?:{CUES})')
          then list_filter(list_transform(string_split_regex(regexp_replace(t, '([.!?;]) +', '\\1' || chr(10), 'g'), chr(10) || '+'),
                                          lambda x: trim(regexp_replace(lower(x), '[^a-z0-9]+', ' ', 'g'))), lambda x: x <> '')
          else cast([] as varchar[]) end as s from d),
c as (select doc_id, len(s)::bigint as n_sentences, array_to_string(list_transform(s, lambda x: case x {_CASE} else '.' end), '') as codes from s),
r as (select *, list_filter([{_HITS}], lambda x: x is not null) as r from c),
l as (select *, list_sort(list_distinct(list_transform(r, lambda k: ([{_NAMES}])[k + 1]))) as l from r)
select doc_id, n_sentences, coalesce(codes, '') as codes, length(replace(coalesce(codes, ''), '.', ''))::bigint as n_known, coalesce(array_to_string(r, ','), '') as rules,
       coalesce(array_to_string(list_filter(l, lambda x: not (x = 'bsd-2-clause' and list_contains(l, 'bsd-3-clause'))), ','), '') as licences
from l
"""
