"""License scans: word-bigram Dice against license templates, with size bounds that prune templates.

Text is normalised to its words: runs of letters, digits and non-ASCII characters, A-Z lower-cased.
Every run of consecutive lines that begins and ends in a line with a bigram of the template is
compared with it, from a notice of one line to a whole license within a longer text.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkit as K

DICE = 0.8  # least Dice coefficient of a match

# Short license texts, headers, and the notices that stand for them.
SHORT: tuple[tuple[str, str], ...] = (
    ("AGPL-3.0", 'This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details. You should have received a copy of the GNU Affero General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.'),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0.'),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("BSD-2-Clause", 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'),
    ("BSD-3-Clause", 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'),
    ("BSL-1.0", 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.'),
    ("CC-BY-4.0", 'Licensed under CC BY 4.0.'),
    ("CC-BY-NC-4.0", 'Licensed under CC BY-NC 4.0.'),
    ("CC-BY-SA-4.0", 'Licensed under CC BY-SA 4.0.'),
    ("GPL-2.0", 'This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.'),
    ("GPL-3.0", 'This work is licensed under the GNU General Public License, version 3.'),
    ("GPL-3.0", 'This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.'),
    ("GPL-3.0", 'This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.'),
    ("ISC", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'),
    ("LGPL-2.1", 'This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details. You should have received a copy of the GNU Lesser General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.'),
    ("LGPL-3.0", 'This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details. You should have received a copy of the GNU Lesser General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.'),
    ("MIT", 'Released under the MIT License.'),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("MPL-2.0", 'This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.'),
    ("Unlicense", 'This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("Zlib", 'This software is provided "as-is", without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.'),
)
# Fixed values as well: whole texts of the long licenses, in files by this name.
LONG = ("Apache-2.0", "CC0-1.0", "GPL-2", "GPL-3", "LGPL-2.1", "LGPL-3", "MPL-2.0")
_NAMES = {"GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-3": "LGPL-3.0"}
TEMPLATES = SHORT + tuple((_NAMES.get(n, n), (Path(__file__).parent / "license_texts" / f"{n}.txt").read_text()) for n in LONG)
_WORD = np.zeros(256, bool)
_WORD[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True


def _bigrams(texts: K.Texts) -> list[np.ndarray]:
    w = K.words(texts, True, _WORD)
    h, owner = K.windows(w.hash, w.first, 2)
    return [np.unique(h[owner == i]) for i in range(len(texts))]


class Scanner:
    def __init__(self, templates: tuple[tuple[str, str], ...], least: float):
        self.names, self.least = [t[0] for t in templates], least
        self.sets = _bigrams(K.Texts.of(pa.array([t[1] for t in templates])))
        self.size = np.array([len(s) for s in self.sets])
        self.all = np.unique(np.concatenate(self.sets))
        self.inside = np.stack([np.isin(self.all, s) for s in self.sets])
        # 2 |A and B| / (|A| + |B|) >= least needs |A| within these bounds of |B|
        self.low, self.high = self.size * least / (2 - least), self.size * (2 - least) / least

    def scan(self, texts: K.Texts) -> list[tuple[str | None, float, int, int]]:
        """Best template of each text, its Dice coefficient, the first line and the number of lines. Ties: earlier lines, fewer lines, earlier templates."""
        best: list[tuple[str | None, float, int, int]] = [(None, 0.0, -1, 0)] * len(texts)
        w = K.words(texts, True, _WORD)
        start, _, first = K.lines(texts)
        h, owner = K.windows(w.hash, w.first, 2)
        at = np.minimum(np.searchsorted(self.all, h), len(self.all) - 1)
        hit = self.all[at] == h
        bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
        for i in np.unique(owner[hit]):
            a, b = bounds[i], bounds[i + 1]
            found = np.unique(at[a:b][hit[a:b]])
            # a match holds this share of the template's bigrams at least
            likely = np.flatnonzero(self.inside[:, found].sum(1) >= self.low)
            if not len(likely):
                continue
            word = w.first[i] + np.arange(b - a)
            line = np.searchsorted(start, w.start[word], "right") - 1 - first[i]
            until = np.searchsorted(start, w.start[word + 1], "right") - 1 - first[i]
            bigrams, place = h[a:b].tolist(), at[a:b]
            for t in likely:
                own = np.flatnonzero(hit[a:b] & self.inside[t, place])
                got = self._best_run(bigrams, line, until, own, int(t))
                if got is not None and (got[0], -got[1], -got[2]) > (best[i][1], -best[i][2], -best[i][3]):
                    best[i] = (self.names[t], *got)
        return best

    def _best_run(self, bigrams: list[int], line: np.ndarray, until: np.ndarray, own: np.ndarray, t: int) -> tuple[float, int, int] | None:
        """Greatest Dice of runs of lines with template t, first line and lines; own: places of its bigrams."""
        top, ours = None, {bigrams[k] for k in own}
        ends = np.unique(until[own]).tolist()
        steps = np.searchsorted(until, np.arange(ends[-1] + 2))  # first bigram that ends in a line or after it
        for begin in np.unique(line[own]).tolist():
            k = int(np.searchsorted(line, begin))
            whole = len({bigrams[x] for x in own[np.searchsorted(own, k) :]})
            if whole < self.low[t]:
                break
            seen: set[int] = set()
            shared = 0
            for end in ends:
                if end < begin:
                    continue
                for x in bigrams[k : steps[end + 1]]:
                    if x not in seen:
                        seen.add(x)
                        shared += x in ours
                k = max(k, int(steps[end + 1]))
                if len(seen) > self.high[t]:
                    break
                dice = 2 * shared / (len(seen) + int(self.size[t]))
                if len(seen) >= self.low[t] and dice >= self.least and (top is None or dice > top[0]):
                    top = (dice, begin, end - begin + 1)
                if shared == whole:  # more lines only dilute
                    break
        return top


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES, least: float = DICE) -> DataFrame:
    """doc_id, license, dice, line, n_lines of the best match; license is null, dice 0, line -1 and n_lines 0 without one.

    The run of lines with the greatest Dice coefficient counts; of equals the one that begins first,
    then the shortest, then the first template. A null or empty text matches nothing. Repeated rows
    and null ids are scanned each. An empty table gives an empty result. templates: name and text.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, least)
        for batch in batches:
            for part, texts in K.Texts.of(batch.column(1)).chunks():
                name, dice, line, n = zip(*scanner.scan(texts), strict=True)
                columns = [pa.array(name, pa.string()), pa.array(dice, pa.float64()), pa.array(line, pa.int64()), pa.array(n, pa.int64())]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.start, len(texts)), *columns], ["doc_id", "license", "dice", "line", "n_lines"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, license string, dice double, line long, n_lines long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql_words(text: str) -> str:
    lower = f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_extract_all({lower}, '[a-z0-9\\x{{80}}-\\x{{10FFFF}}]+')"


def _sql_text(text: str) -> str:
    return text.replace("'", "''")


ORACLE_SQL = f"""
WITH t(tid, name, body) AS (VALUES {", ".join(f"({i}, '{n}', '{_sql_text(t)}')" for i, (n, t) in enumerate(TEMPLATES))}),
tw AS (SELECT tid, name, {_sql_words("body")} AS ws FROM t),
y AS MATERIALIZED (SELECT DISTINCT tid, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS g FROM tw),
size AS (SELECT tid, count(*) AS n FROM y GROUP BY tid),
d AS MATERIALIZED (SELECT row_number() OVER () AS rk, doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT rk, string_split(text, chr(10)) AS ls FROM d),
u AS (SELECT rk, i - 1 AS line, {_sql_words("ls[i]")} AS ws FROM (SELECT rk, ls, unnest(range(1, len(ls) + 1)) AS i FROM l)),
w AS (SELECT rk, line, k, ws[k] AS word FROM (SELECT rk, line, ws, unnest(range(1, len(ws) + 1)) AS k FROM u)),
b AS MATERIALIZED (SELECT rk, l0, l1, g FROM (SELECT rk, line AS l0, lead(line) OVER o AS l1, word || ' ' || lead(word) OVER o AS g FROM w WINDOW o AS (PARTITION BY rk ORDER BY line, k)) WHERE l1 IS NOT NULL),
hit AS MATERIALIZED (SELECT DISTINCT rk, tid, l0, l1, g FROM b JOIN y USING (g)),
enough AS (SELECT rk, tid FROM hit JOIN size USING (tid) GROUP BY rk, tid, n HAVING count(DISTINCT g) >= {DICE}::DOUBLE / (2 - {DICE}::DOUBLE) * n),
run AS MATERIALIZED (SELECT DISTINCT p.rk, p.tid, p.l0 AS a, q.l1 AS z FROM hit p JOIN hit q ON p.rk = q.rk AND p.tid = q.tid AND p.l0 <= q.l1 JOIN enough e ON e.rk = p.rk AND e.tid = p.tid),
span AS (SELECT DISTINCT rk, a, z FROM run),
own AS (SELECT s.rk, a, z, count(DISTINCT g) AS n FROM span s JOIN b ON b.rk = s.rk AND l0 >= a AND l1 <= z GROUP BY ALL),
common AS (SELECT r.rk, r.tid, a, z, count(DISTINCT g) AS m FROM run r JOIN hit h ON h.rk = r.rk AND h.tid = r.tid AND l0 >= a AND l1 <= z GROUP BY ALL),
s AS (SELECT rk, tid, a, z, 2 * m::DOUBLE / (own.n + size.n) AS dice FROM common JOIN own USING (rk, a, z) JOIN size USING (tid)),
m AS (SELECT *, row_number() OVER (PARTITION BY rk ORDER BY dice DESC, a, z, tid) AS r FROM s WHERE dice >= {DICE}::DOUBLE)
SELECT doc_id, name AS license, coalesce(dice, 0) AS dice, coalesce(a, -1)::BIGINT AS line, coalesce(z - a + 1, 0)::BIGINT AS n_lines FROM d LEFT JOIN (SELECT * FROM m JOIN t USING (tid) WHERE r = 1) USING (rk)
"""
