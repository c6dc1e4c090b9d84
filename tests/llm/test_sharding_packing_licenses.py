import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from lodestone.llm import licenses, packing, sharding


def test_shards(docs, rows, empty):
    got = sharding.interleaved_shards(docs, n_shards=4).collect()
    sizes = Counter(r.shard for r in got)
    assert len(got) == len(rows) and max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) == {0, 1, 2, 3}
    for s, n in sizes.items():
        assert sorted(r.slot for r in got if r.shard == s) == list(range(n))
    want = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    by = Counter((r.shard, r.stratum) for r in got)
    for stratum, n in Counter(r.stratum for r in got).items():
        assert all(abs(by[s, stratum] - n / 4) <= 1.5 for s in range(4))
    assert sharding.interleaved_shards(empty, 4).count() == 0


def test_shards_by_brute_force(spark, rows):
    import hashlib

    plain = [r for r in rows if r[0] is not None]
    plain = list({r[0]: r for r in plain}.values())
    df = spark.createDataFrame([(r[0], r[1], r[3]) for r in plain], "doc_id long, text string, source string")
    got = {r.doc_id: (r.shard, r.slot) for r in sharding.interleaved_shards(df, 5, seed=3).collect()}
    strata = defaultdict(list)
    for r in plain:
        strata[r[3] or ""].append((hashlib.md5(f"3:{r[0]}".encode()).hexdigest(), r[0]))
    order = sorted((((2 * k + 1) / (2 * len(v))), s, h, i) for s, v in strata.items() for k, (h, i) in enumerate(sorted(v)))
    n = len(order)
    want = {i: (g * 5 // n, g - -(-(g * 5 // n) * n // 5)) for g, (_, _, _, i) in enumerate(order)}
    assert got == want


def test_packing(docs, rows, empty):
    got = packing.pack(docs, capacity=1000, per_source=2).collect()
    total = Counter()
    for r in got:
        total[r.doc_id] += r.length
    want = Counter()
    for r in rows:
        want[r[0]] += len((r[1] or "").encode()) + 1
    assert total == want
    bins = defaultdict(list)
    for r in got:
        bins[r.bin].append(r)
    texts, sources = {r[0]: r[1] or "" for r in rows}, {r[0]: r[3] for r in rows}
    for own in bins.values():
        assert sum(r.length for r in own) + own[0].residual == 1000 and own[0].residual >= 0
        assert max(Counter((texts[r.doc_id], r.piece) for r in own).values()) == 1
        assert max(Counter(sources[r.doc_id] for r in own).values()) <= 2
    assert packing.pack(empty).count() == 0


def test_best_fit_walks_to_the_tightest_compatible_bin():
    # The two tightest bins hold a copy or the source already; the third is taken.
    placed = packing.best_fit([(90, 1, 7), (85, 2, 8), (60, 3, 9), (10, 2, 7), (5, 1, 10)], 100, 1)
    assert [b for b, _ in placed] == [0, 1, 2, 2, 1]
    assert placed[3][1] == 30


def brute_pack(pieces, capacity, per_source):
    bins, out = [], []
    for length, source, cluster in pieces:
        fits = [(b[0], i) for i, b in enumerate(bins) if b[0] >= length and cluster not in b[2] and b[1].count(source) < per_source]
        i = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append([capacity, [], set()])
        bins[i][0] -= length
        bins[i][1].append(source)
        bins[i][2].add(cluster)
        out.append((i, bins[i][0]))
    return out


def test_best_fit_by_brute_force():
    import random

    rng = random.Random(2)
    for _ in range(50):
        pieces = [(rng.randint(1, 60), rng.randint(0, 3), rng.randint(0, 20)) for _ in range(80)]
        assert packing.best_fit(pieces, 100, 2) == brute_pack(pieces, 100, 2)


def test_cluster_column(docs):
    got = packing.pack(docs.withColumn("c", F.lit("same")), capacity=1 << 20, cluster="c").collect()
    assert max(Counter((r.bin, r.piece) for r in got).values()) == 1


def test_licenses(spark, docs, empty):
    assert all(any(s in licenses.normal(x) for s in licenses.stems(licenses.SENTENCES)) for x in licenses.SENTENCES.values())
    S = licenses.SENTENCES
    apache = ". ".join(S[k] for k in ("apache_ref_the_license", "apache_no_use", "apache_copy", "apache_as_is", "apache_see")) + "."
    texts = [
        ("Hello there. Licensed under the Apache License, Version 2.0. Bye", "Apache-2.0", 1), (apache, "Apache-2.0", 1), ("RELEASED under the  MIT License!\nLicensed under CC BY-NC 4.0.", "CC-BY-NC-4.0,MIT", 2),
        ("MIT License\n" + S["mit_grant"] + "\n" + S["mit_notice"] + ".", "MIT", 1), ("The licence is lichen", "", 0), (None, "", 0), ("", "", 0), ("Released under the MIT License. " * 3, "MIT", 3), ("x " * 50_000 + "\nReleased under the MIT License.", "MIT", 1),
    ]
    df = spark.createDataFrame([(i, t, "clash") for i, (t, _, _) in enumerate(texts)], "doc_id long, text string, sequence string")
    got = {r.doc_id: (r.licenses, r.n_matches) for r in licenses.scan_licenses(df).collect()}
    assert got == {i: (names, n) for i, (_, names, n) in enumerate(texts)}
    assert licenses.scan_licenses(docs).count() == docs.count() and licenses.scan_licenses(empty).count() == 0


MIT = """MIT License

Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND."""
BSD2 = """Copyright (c) 2020, Somebody. All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = BSD2 + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""


def test_wrapped_licence_texts(spark):
    texts, want = [], []
    for text, name in ((MIT, "MIT"), (BSD2, "BSD-2-Clause"), (BSD3, "BSD-3-Clause"), (GPL, "GPL-3.0-or-later"), (APACHE, "Apache-2.0")):
        for prefix in ("", "# ", " * ", "// "):
            texts.append("import x\n\n" + "\n".join(prefix + line for line in text.split("\n")) + "\n\nand more.")
            want.append((name, 1))
    texts += [BSD2.replace("\n", " "), BSD2.replace("\n", "\r\n"), "Released under\n\nthe MIT License", "Released under. The MIT License", "Released under the\nMIT License or not", "It was\nReleased under the MIT License\nand so on"]
    want += [("BSD-2-Clause", 1)] * 2 + [("", 0)] * 3 + [("MIT", 1)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.licenses, r.n_matches) for r in licenses.scan_licenses(df).collect()}
    assert got == dict(enumerate(want))


def test_every_rule_by_its_published_sentences(spark):
    S = licenses.SENTENCES
    text = lambda parts, gap: "".join(S[p] + ("\n\n" if S[p].endswith(":") else ".\n") for p in parts if p != licenses.GAP).replace(" ", gap)
    rows = [(i, text(parts, gap) + " And more.") for i, (_, parts) in enumerate(licenses.RULES) for gap in (" ", "\n", "\n# ")]
    rows += [(1000, "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/.")]
    names = {i: name for i, (name, _) in enumerate(licenses.RULES)} | {1000: "MPL-2.0"}
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r.doc_id, r.licenses) for r in got if r.licenses != names[r.doc_id]] == [] and len(got) == len(rows)
