"""Licence scan: Dice coefficient over word bigrams against licence templates (native).

Units of a document are the runs of consecutive lines: a one-line stamp, a wrapped notice above code, a full licence
text. A unit and a template are compared by the sets of word bigrams of their normalised words (lower case, letters and
digits; comment signs and line ends don't count). Dice >= t implies t / (2 - t) <= |unit| / |template| <= (2 - t) / t, so a
run is a unit for a template only if its number of bigrams lies within these bounds, and a template is a candidate for a
document only if they share t / (2 - t) of the template's bigrams, which every match needs; documents without a candidate, nearly
all, end there. Runs begin and end with lines that share a bigram with the template, as others only lower the score.

Every document gets a row; without a match licence is null and dice 0. Null and empty texts match nothing, a unit of one word has
no bigram, and equal scores go to the first template by name, then to the first and shortest run. Rows are judged one by one.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

THRESHOLD = 0.8
# Stamps, notices and texts of widely used public licences.
TEMPLATES = {
    "agpl-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "agpl-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "bsd-2-clause": "Released under the BSD 2-Clause License.",
    "bsd-2-clause-text": 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    "bsd-3-clause": "Released under the BSD 3-Clause License.",
    "bsd-3-clause-text": 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-2.0-notice": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-grant": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "isc-text": 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    "lgpl-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "mit": "Released under the MIT License.",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.",
    "mit-text": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "unlicense-text": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "zlib-text": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
}
WORD = r"[\p{L}\p{N}]+"


def bigrams(text: str) -> list[str]:
    w = re.findall(r"[^\W_]+", text.lower())
    return sorted({f"{a} {b}" for a, b in zip(w, w[1:], strict=False)})


def gram_hash(gram: str) -> int:
    """As F.xxhash64 hashes the two words."""
    import xxhash

    a, b = (x.encode() for x in gram.split(" "))
    h = xxhash.xxh64_intdigest(b, xxhash.xxh64_intdigest(a, 42))
    return h - (1 << 64) if h >> 63 else h


def bounds(n: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """Sizes that a set can have if its Dice coefficient with a set of n can reach the threshold."""
    return math.ceil(n * threshold / (2 - threshold) - 1e-9), math.floor(n * (2 - threshold) / threshold + 1e-9)


def longs(values) -> Column:
    """A literal array."""
    return F.array(*map(F.lit, values)).cast("array<bigint>")


def scan_licenses(documents: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, license, dice, first_line, last_line (from 0, of the best match), n_licenses (templates that match)."""
    spark = documents.sparkSession
    scratch = Scratch(spark, "license")
    sets = {k: sorted(map(gram_hash, bigrams(v))) for k, v in sorted((templates or TEMPLATES).items())}
    limits = {k: bounds(len(v), threshold) for k, v in sets.items()}
    split = lambda text: F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    pairs = F.when(F.size("w") > 1, F.expr("transform(sequence(0, size(w) - 2), i -> xxhash64(w[i], w[i + 1]))")).otherwise(F.array().cast("array<bigint>"))
    every = longs(sorted(set().union(*sets.values())))
    # what a match needs of the template's bigrams is the lower bound of its own size too
    fits = [F.when(F.size(F.array_intersect("near", longs(v))) >= limits[k][0], F.lit(k)) for k, v in sets.items() if v]
    least = min((a for k, (a, _) in limits.items() if sets[k]), default=1)
    d = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    d = d.select("row", "doc_id", "text", split(F.col("text")).alias("w")).select("row", "doc_id", "text", F.array_intersect(pairs, every).alias("near"))
    may = F.when(F.size("near") >= least, F.filter(F.array(*fits), lambda k: k.isNotNull())).otherwise(F.array().cast("array<string>"))
    d = d.select("row", "doc_id", "text", may.alias("may")).select("row", "doc_id", "may", F.when(F.size("may") > 0, F.col("text")).alias("text"))
    # written, as row numbers must be the same wherever they are used
    d = scratch.write(d, "candidates")

    listed = [(k, *limits[k], v) for k, v in sets.items()]
    table = F.broadcast(spark.createDataFrame(listed, "license string, low int, high int, grams array<bigint>"))  # as many rows as templates
    met = d.filter(F.size("may") > 0).select("row", "text", F.explode("may").alias("license")).join(table, "license")
    met = met.select("*", split(F.col("text")).alias("w"), F.transform(F.split("text", "\n", -1), lambda x: F.size(split(x))).alias("lines"))
    met = met.select("*", pairs.alias("g"), F.aggregate("lines", F.array(F.lit(0)), lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n))).alias("off"))
    met = met.select("row", "license", "low", "high", "grams", "g", "lines", "off", F.transform("g", lambda x: F.array_contains("grams", x)).alias("hit"))
    # written, as a plan would work out the words again for every use of what follows from them
    met = scratch.write(met, "met")
    hit_in = lambda first, last: f"exists(slice(hit, greatest({first}, 0) + 1, greatest(least({last}, size(hit) - 1) - greatest({first}, 0) + 1, 0)), x -> x)"
    rows = "filter(sequence(0, size(lines) - 1), i -> lines[i] > 0 and {})"
    met = met.withColumn("begins", F.expr(rows.format(hit_in("off[i]", "off[i + 1] - 1")))).withColumn("ends", F.expr(rows.format(hit_in("off[i] - 1", "off[i + 1] - 2"))))
    runs = met.select("*", F.explode("begins").alias("a")).select("*", F.explode(F.expr("filter(ends, b -> b >= a and off[b + 1] - off[a] - 1 between low and high)")).alias("b"))
    runs = runs.select("row", "license", "grams", "a", "b", F.expr("array_distinct(slice(g, off[a] + 1, off[b + 1] - off[a] - 1))").alias("unit"))
    dice = 2.0 * F.size(F.array_intersect("unit", "grams")) / (F.size("unit") + F.size("grams"))
    found = runs.select("row", "license", "a", "b", dice.alias("dice")).filter(F.col("dice") >= threshold)
    order = F.struct("dice", (-F.lit(1) * F.element_at(F.create_map(*[F.lit(x) for i, k in enumerate(sets) for x in (k, i)]), F.col("license"))).alias("r"), (-F.col("a")).alias("a"), (-F.col("b")).alias("b"))
    best = found.groupBy(F.col("row").alias("row_")).agg(F.max_by(F.struct("license", "dice", "a", "b"), order).alias("m"), F.count_distinct("license").alias("n"))
    return d.select("row", "doc_id").join(best, F.col("row") == F.col("row_"), "left").select(
        "doc_id",
        F.col("m.license").alias("license"),
        F.coalesce("m.dice", F.lit(0.0)).alias("dice"),
        F.col("m.a").alias("first_line"),
        F.col("m.b").alias("last_line"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_licenses"),
    )


def op10_license_scan(spark, sf_dir):
    from .common import read_table

    return scan_licenses(read_table(spark, sf_dir, "documents")).select("doc_id", "license", "dice", "n_licenses")
