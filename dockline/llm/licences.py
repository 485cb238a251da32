"""Licence scans: lines and windows of a text against licence templates by word bigrams.

All of it is DataFrame functions. A line is normalised to words; its multiset
of word bigrams is compared with that of each template whose size the wanted
Dice coefficient allows at all. Windows of a template's length are compared
over the whole text, line breaks as blanks, so wrapped licences and notices
inside longer lines are found too.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Notices by which texts and files state their licence, from the licences' own pages.
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", "SPDX-License-Identifier: MIT",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-only",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-2.0-only"],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3.", "SPDX-License-Identifier: LGPL-3.0-only"],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-only"],
    "BSD-3-Clause": ["Released under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause",
                     "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "SPDX-License-Identifier: MPL-2.0"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["Licensed under CC0 1.0 Universal.", "SPDX-License-Identifier: CC0-1.0"],
}
# Whole licences, where short, and the headers and openings of long ones; they come besides the notices.
for _name, _texts in {
    "MIT": [
        (
            'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
            'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
            'rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit '
            'persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice '
            'and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS '
            'PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
            'MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT '
            'HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, '
            'ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
        ),
    ],
    "Apache-2.0": [
        (
            'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
            'the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by '
            'applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
            'WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language '
            'governing permissions and limitations under the License.'
        ),
        (
            'Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, '
            'AND DISTRIBUTION'
        ),
    ],
    "GPL-3.0": [
        'GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007',
    ],
    "GPL-2.0": [
        'GNU GENERAL PUBLIC LICENSE Version 2, June 1991',
        (
            'This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public '
            'License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later '
            'version.'
        ),
    ],
    "LGPL-3.0": [
        'GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007',
        (
            'This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General '
            'Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any '
            'later version.'
        ),
    ],
    "AGPL-3.0": [
        'GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007',
        (
            'This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General '
            'Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any '
            'later version.'
        ),
    ],
    "BSD-3-Clause": [
        (
            'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the '
            'following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of '
            'conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, '
            'this list of conditions and the following disclaimer in the documentation and/or other materials provided with the '
            'distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or '
            'promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY '
            'THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, '
            'THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE '
            'COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL '
            'DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR '
            'BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT '
            '(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE '
            'POSSIBILITY OF SUCH DAMAGE.'
        ),
    ],
    "MPL-2.0": [
        (
            'This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not '
            'distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.'
        ),
    ],
    "BSD-2-Clause": [
        'Released under the BSD 2-Clause License.',
        'SPDX-License-Identifier: BSD-2-Clause',
        (
            'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the '
            'following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of '
            'conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, '
            'this list of conditions and the following disclaimer in the documentation and/or other materials provided with the '
            'distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
            'WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR '
            'PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, '
            'INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE '
            'GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF '
            'LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT '
            'OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
        ),
    ],
    "ISC": [
        'Released under the ISC License.',
        'Licensed under the ISC License.',
        'SPDX-License-Identifier: ISC',
        (
            'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby '
            'granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS '
            'PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES '
            'OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR '
            'CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF '
            'CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS '
            'SOFTWARE.'
        ),
    ],
    "EPL-2.0": [
        (
            'This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which '
            'is available at https://www.eclipse.org/legal/epl-2.0/'
        ),
        'SPDX-License-Identifier: EPL-2.0',
    ],
    "LGPL-2.1": [
        'GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999',
        'This work is licensed under the GNU Lesser General Public License, version 2.1.',
        'SPDX-License-Identifier: LGPL-2.1-only',
        (
            'This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General '
            'Public License as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) '
            'any later version.'
        ),
    ],
    "Unlicense": [
        (
            'This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, '
            'compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, '
            'commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors '
            'of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication '
            'for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to '
            'be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. '
            'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
            'WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE '
            'LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, '
            'OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
        ),
        'SPDX-License-Identifier: Unlicense',
    ],
}.items():
    TEMPLATES[_name] = TEMPLATES.get(_name, []) + _texts
DICE = 0.8

_WORD = r"[a-z0-9]+"


def _bigrams(words: list[str]) -> list[str]:
    """Sorted bigrams, numbered where one occurs again, so that sets act as multisets."""
    seen: dict[str, int] = {}
    out = []
    for a, b in zip(["", *words], [*words, ""], strict=True):
        pair = f"{a} {b}"
        seen[pair] = seen.get(pair, 0) + 1
        out.append(pair if seen[pair] == 1 else f"{pair} {seen[pair]}")
    return sorted(out)


def template_rows(templates: dict[str, list[str]] = TEMPLATES) -> list[tuple[str, list[str]]]:
    """(licence, bigrams) of every template with words."""
    split = [(name, re.findall(_WORD, text.lower())) for name, texts in templates.items() for text in texts]
    return [(name, _bigrams(words)) for name, words in split if words]


def bounds(size: int, dice: float = DICE) -> tuple[int, int]:
    """The sizes another multiset can have for the Dice coefficient to be reached."""
    low, high = dice / (2 - dice) * size, (2 - dice) / dice * size
    return int(-(-low // 1)), int(high // 1)


def _line_bigrams(words: Column) -> Column:
    """The multiset of a line's bigrams, with a mark at either end; sorted, repeats numbered."""
    pairs = F.transform(
        F.sequence(F.lit(0), F.size(words)),
        lambda i: F.concat_ws(" ", F.when(i > 0, F.get(words, i - 1)).otherwise(""), F.when(i < F.size(words), F.get(words, i)).otherwise("")),
    )
    sorted_ = F.array_sort(pairs)
    return F.transform(sorted_, lambda p, i: F.when(
        F.get(sorted_, i - 1) == p, F.concat_ws(" ", p, (i - F.array_position(sorted_, p) + 2).cast("string"))).otherwise(p))


def scan(docs: DataFrame, keep: list[str], text: str = "text", templates: dict[str, list[str]] = TEMPLATES, dice: float = DICE) -> DataFrame:
    """Columns `keep` and `licences`: per licence found its name, best Dice and first line, by name.

    Only lines whose number of bigrams suits a template, and that hold one of
    the words without which no template can be reached, are compared; windows
    are those of `_windows`. A window that shares words with a line that was
    found counts if it reaches beyond the line and is as near; it then stands
    for the line. Windows count in order of their shared bigrams, if they share
    no words with one before. A null or empty text has no lines and
    an empty list, as all texts have without templates. Repeated rows stay.
    """
    rows = template_rows(templates)
    own = docs.select(*(docs[c] for c in keep if c != "licences"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("_text"))
    kind = "array<struct<licence:string,dice:double,line:int>>"
    if not rows:
        return own.select(*keep, F.expr(f"cast(array() as {kind})").alias("licences"))
    lows, highs = zip(*(bounds(len(b), dice) for _, b in rows), strict=True)
    # a line that reaches the coefficient shares words with a template, so texts without any licence word are done
    words = hint_words(rows, dice)
    hint = F.regexp_like("_text", F.lit(f"(?i:{'|'.join(words)})"))
    own = own.withColumn("_lines", F.when(hint, F.transform(
        F.split("_text", "\n"), lambda t: F.regexp_extract_all(F.lower(t), F.lit(f"({_WORD})"), F.lit(1)))))
    lines = F.transform("_lines", lambda x, i: F.struct(i.alias("line"), x.alias("words")))
    fit = F.filter(lines, lambda x: (F.size(x["words"]) + 1 >= min(lows)) & (F.size(x["words"]) + 1 <= max(highs)) & F.exists(
        x["words"], lambda w: w.isin(words)))
    sized = F.transform(fit, lambda x: F.struct(x["line"].alias("line"), _line_bigrams(x["words"]).alias("bigrams")))

    def compare(x):
        found = []
        for (name, bigrams), low, high in zip(rows, lows, highs, strict=True):
            n = F.size(x["bigrams"])
            value = F.lit(2.0) * F.size(F.array_intersect(x["bigrams"], F.array(*(F.lit(b) for b in bigrams)))) / (n + len(bigrams))
            hit = F.when(n.between(low, high), value).otherwise(0.0)
            found.append(F.struct(F.lit(name).alias("licence"), hit.alias("dice"), x["line"].cast("int").alias("line")))
        good = F.filter(F.array(*found), lambda h: h["dice"] >= dice)
        # of templates that reach it, a line counts for the nearest; ties go to the first by name
        best = F.array_max(F.transform(good, lambda h: h["dice"]))
        return F.slice(F.array_sort(F.filter(good, lambda h: h["dice"] == best)), 1, 1)

    before = lambda line: F.aggregate(F.slice("_lines", 1, line), F.lit(0), lambda n, x: n + F.size(x))
    line_at = lambda at: F.aggregate(
        "_lines", F.struct(F.lit(0).alias("n"), F.lit(0).alias("line")),
        lambda acc, x: F.struct((acc["n"] + F.size(x)).alias("n"), (acc["line"] + (acc["n"] + F.size(x) <= at).cast("int")).alias("line")),
        lambda acc: acc["line"])
    found = F.transform(F.flatten(F.transform(sized, compare)), lambda h: F.struct(
        h["licence"].alias("licence"), h["dice"].alias("dice"), h["line"].alias("line"),
        before(h["line"]).alias("from"), before(h["line"] + 1).alias("to")))
    own = own.withColumn("_found", found).withColumn("_windows", _windows(templates, dice))
    overlap = lambda x, y: (x["from"] < y["to"]) & (y["from"] < x["to"])
    # the line stays unless the window holds all of it and more, and is as near
    good = F.filter("_windows", lambda w: ~F.exists("_found", lambda h: overlap(w, h) & (
        (h["dice"] > w["dice"]) | (w["from"] > h["from"]) | (w["to"] < h["to"]) | (w["to"] - w["from"] == h["to"] - h["from"]))))
    ranked = F.array_sort(F.transform(good, lambda w: F.struct(
        (-w["shared"]).alias("less"), (-w["dice"]).alias("far"), w["licence"].alias("licence"), w["from"].alias("from"), w["to"].alias("to"),
        w["dice"].alias("dice"))))
    own = own.withColumn("_ranked", ranked).withColumn("_good", F.aggregate(
        "_ranked", F.slice("_ranked", 1, 0), lambda acc, w: F.when(F.exists(acc, lambda o: overlap(w, o)), acc).otherwise(F.array_append(acc, w))))
    alone = F.filter("_found", lambda h: ~F.exists("_good", lambda w: overlap(w, h) & (w["licence"] != h["licence"])))
    plain = lambda h, line: F.struct(h["licence"].alias("licence"), h["dice"].alias("dice"), line.cast("int").alias("line"))
    hits = F.concat(F.transform(alone, lambda h: plain(h, h["line"])), F.transform("_good", lambda w: plain(w, line_at(w["from"]))))
    names = F.array_sort(F.array_distinct(F.transform("_hits", lambda h: h["licence"])))

    def summary(name):
        mine = F.filter("_hits", lambda h: h["licence"] == name)
        return F.struct(name.alias("licence"), F.array_max(F.transform(mine, lambda h: h["dice"])).alias("dice"),
                        F.array_min(F.transform(mine, lambda h: h["line"])).alias("line"))

    hits = F.coalesce(hits, F.expr(f"cast(array() as {kind})"))
    return own.withColumn("_hits", hits).select(
        *(c for c in keep if c != "licences"), F.transform(names, summary).cast(kind).alias("licences"))


def _windows(templates: dict[str, list[str]], dice: float) -> Column:
    """Windows of the words of `_lines` that reach a template: licence, dice, shared, from, to (places of words).

    A window has the template's number of words, fewer at the end of the text,
    and its ends marked like those of a line. It starts at a bigram of the
    template or up to two words before. Templates of one word have none.
    """
    kind = "array<struct<licence:string,dice:double,shared:int,from:int,to:int>>"
    empty = F.expr(f"cast(array() as {kind})")
    all_ = [(name, re.findall(_WORD, text.lower())) for name, texts in templates.items() for text in texts]
    all_ = [(name, words) for name, words in all_ if len(words) > 1]
    if not all_:
        return empty
    listed = lambda values: F.split(F.lit("|".join(values)), r"\|")
    rows, every = [], set()
    for name, words in all_:
        pairs = [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]
        every.update(pairs)
        need = max(math.ceil(dice * (len(words) + 1) - 1e-9) - 2, 1)
        rows.append(F.struct(
            F.lit(name).alias("licence"), F.lit(len(words)).alias("n"), F.lit(need).alias("need"), F.lit(words[0]).alias("first"),
            F.lit(words[-1]).alias("last"), listed(sorted(set(pairs))).alias("pairs"),
            listed([b for b in _bigrams(words) if not b.startswith(" ") and b.split(" ")[1]]).alias("bigrams")))
    words = F.flatten("_lines")
    let = lambda value, then: F.get(F.transform(F.array(value), then), F.lit(0))

    def numbered(pairs):
        return let(F.array_sort(pairs), lambda p: F.transform(p, lambda x, i: F.when(
            F.get(p, i - 1) == x, F.concat_ws(" ", x, (i - F.array_position(p, x) + 2).cast("string"))).otherwise(x)))

    def of_text(words):
        count = F.size(words)
        pairs = F.filter(
            F.transform(F.sequence(F.lit(0), count - 2), lambda i: F.struct(
                i.alias("at"), F.concat_ws(" ", F.get(words, i), F.get(words, i + 1)).alias("pair"))),
            lambda x: x["pair"].isin(sorted(every)))

        def of_template(t, pairs):
            def of_hits(hits):
                starts = F.flatten(F.transform(hits, lambda h, k: F.when(
                    F.get(hits, k + t["need"] - 1)["at"] < h["at"] + t["n"] - 1,
                    F.array(h["at"] - 2, h["at"] - 1, h["at"])).otherwise(F.expr("cast(array() as array<int>)"))))

                def window(start):
                    to = F.least(start + t["n"], count)
                    inside = F.transform(
                        F.filter(hits, lambda h: (h["at"] >= start) & (h["at"] < to - 1)), lambda h: h["pair"])
                    shared = F.size(F.array_intersect(numbered(inside), t["bigrams"])) + (F.get(words, start) == t["first"]).cast("int") + (
                        F.get(words, to - 1) == t["last"]).cast("int")
                    return let(shared, lambda n: F.struct(
                        t["licence"].alias("licence"), (n / (t["n"] + 1)).alias("dice"), n.cast("int").alias("shared"),
                        start.cast("int").alias("from"), to.cast("int").alias("to")))

                return F.filter(F.transform(
                    F.filter(F.array_distinct(starts), lambda a: a >= 0), window), lambda w: w["dice"] >= dice)

            return let(F.filter(pairs, lambda x: F.array_contains(t["pairs"], x["pair"])), of_hits)

        return let(pairs, lambda p: F.flatten(F.transform(
            F.filter(F.array(*rows), lambda t: F.size(p) >= t["need"]), lambda t: of_template(t, p))))

    return F.when(F.size(words) > 1, let(words, of_text)).otherwise(empty).cast(kind)


def hint_words(rows: list[tuple[str, list[str]]], dice: float = DICE) -> list[str]:
    """Words such that every text that reaches the coefficient with a template holds one.

    A template's bigrams that lack a word of it bound what a line without that
    word can share, so the fewest words are chosen that cover every template.
    """
    chosen: list[str] = []
    words = [sorted({w for b in bigrams for w in b.split()[:2]}) for _, bigrams in rows]
    for own, (_, bigrams) in sorted(zip(words, rows, strict=True), key=lambda x: len(x[0])):
        lost = sum(any(w in b.split()[:2] for w in chosen) for b in bigrams)
        order = sorted((w for w in own if w not in chosen), key=lambda w: (-min(len(w), 7), -sum(w in ws for ws in words)))
        while _reachable(len(bigrams), lost) >= dice and order:
            chosen.append(order.pop(0))
            lost = sum(any(w in b.split()[:2] for w in chosen) for b in bigrams)
    return chosen


def _reachable(size: int, lost: int) -> float:
    """The best Dice of a multiset that holds none of `lost` of `size` bigrams."""
    return 2 * (size - lost) / (2 * size - lost) if size else 0.0
