"""License notices in documents: MinHash bands over overlapping windows, then exact shingle containment."""

from pyspark.sql import DataFrame, SparkSession

from pagemill.llm.minhash import CONTAINMENT, SHINGLE_WORDS, contained

#: Notices as their publishers word them, short forms first. A table of the same two columns
#: can be given instead.
TEMPLATES = [
    ("mit-short", "Released under the MIT License."),
    ("mit-licensed", "Licensed under the MIT License."),
    ("apache-2.0-short", "Licensed under the Apache License, Version 2.0."),
    ("gpl-3.0-short", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-2.0-short", "This work is licensed under the GNU General Public License, version 2."),
    ("cc-by-nc-4.0-short", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa-4.0-short", "Licensed under CC BY-SA 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
                "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
            "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions: The above copyright notice and this permission notice shall be included in all copies or "
            "substantial portions of the Software."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
            "list of conditions and the following disclaimer."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
                "your option) any later version."),
]


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TEMPLATES, "license string, template string")


def license_matches(docs: DataFrame, known: DataFrame | None = None, size: int = SHINGLE_WORDS,
                    containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, license, n_found, n_item, containment for each document that holds a notice.

    A notice counts if at least 0.8 of its different five-word shingles stand in the document; a longer notice and
    a shorter one within it are both given. See minhash.contained for nulls, empty texts, repeated rows and
    empty tables, and for what the windows guarantee. `known` has columns license and template.
    """
    known = templates(docs.sparkSession) if known is None else known
    return contained(docs, known, "doc_id", "license", item_text="template", size=size,
                     containment=containment, bands=None).withColumnRenamed("item", "license")


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


#: The same by definition, for DuckDB.
SQL = r"""
with templates(license, template) as (values """ + ", ".join(f"({_literal(a)}, {_literal(b)})" for a, b in TEMPLATES) + r"""),
worded as (select license, list_filter(string_split(trim(regexp_replace(lower(template), '[^\p{L}\p{N}]+', ' ', 'g')), ' '), lambda x: x <> '') as w from templates),
known as (select distinct license, array_to_string(w[i:i + 4], ' ') as s
          from (select license, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from worded)),
sizes as (select license, count(*) as n_item from known group by license),
docs as (select doc_id, list_filter(string_split(trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')), ' '), lambda x: x <> '') as w from documents),
found as (select distinct doc_id, array_to_string(w[i:i + 4], ' ') as s
          from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from docs where len(w) > 0)),
hits as (select doc_id, license, count(*) as n_found from found join known using (s) group by all)
select doc_id, license, n_found, n_item, n_found / n_item as containment
from hits join sizes using (license) where n_found >= n_item * 0.8
"""
