import re
from collections import defaultdict

import numpy as np
import xxhash

from lodestone.llm import simhash, suffix_dedup


def plain_fingerprint(text, n=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + n]).encode(), 42) for i in range(max(1, len(w) - n + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(points, radius):
    label = list(range(len(points)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(points)):
        for j in range(i):
            if bin(points[i] ^ points[j]).count("1") <= radius:
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(points))]


def test_components_of_documents(docs, rows, empty):
    got = simhash.near_duplicates(docs).collect()
    fps = {r[0]: plain_fingerprint(r[1]) for r in rows}
    assert len(got) == len(rows) and all(r.fp % (1 << 64) == fps[r.doc_id] for r in got)
    points = [plain_fingerprint(r[1]) for r in rows]
    least = defaultdict(lambda: 1 << 60)
    roots = plain_components(points, 4)
    for r, k in zip(rows, roots):
        least[k] = min(least[k], r[0] if r[0] is not None else 1 << 60)
    want = sorted((r[0] if r[0] is not None else -1, least[k]) for r, k in zip(rows, roots))
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.component_id) for r in got) == want
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.one_of_each(docs)
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    named = {(r.doc_id, r.text): r for r in docs.collect()}
    assert all(named[r.doc_id, r.text] == r for r in kept.collect())
    assert kept.columns == docs.columns and len(ids) == len(set(ids)) and 4 in ids and not {5, 6, 7, None} & set(ids) and 0 in ids and 1 not in ids and 20 in ids


def clustered(n, seed):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    out = list(centres)
    for c in centres[: n // 3]:
        for _ in range(4):
            c = c ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 6), replace=False)))
            out.append(c)
    return np.unique(np.array(out, np.uint64))


def test_shard_search_by_brute_force():
    for n, radius in ((30, 4), (300, 4), (120, 7)):
        points = clustered(n, n)
        want = plain_components([int(p) for p in points], radius)
        assert simhash.within(points, radius).tolist() == want
    more = np.zeros((2, 3), np.uint64)
    more[1] = (1 << 64) - 1
    assert simhash.within(np.array([1, 3], np.uint64), 4, more, 10).tolist() == [0, 1] and simhash.within(np.array([1, 3], np.uint64), 4, more, 200).tolist() == [0, 0]


def test_trees_find_all_links(spark, monkeypatch):
    points = clustered(150, 5)
    want = plain_components([int(p) for p in points], 4)
    fps = spark.createDataFrame([(int(p), int(p), b"") for p in points.view(np.int64)], "node long, fp long, more binary")
    label = {int(p): k for p, k in zip(points.view(np.int64), want)}
    groups = defaultdict(set)
    for p, k in label.items():
        groups[k].add(p)
    for overlap, most in ((0, 20_000), (1, 20_000), (0, 5)):
        monkeypatch.setattr(simhash, "MAX_SHARD", most)
        found = {r.node: r.component for r in simhash.components(simhash.links(fps, 4, overlap=overlap)).collect()}
        got = defaultdict(set)
        for p in label:
            got[found.get(p, p)].add(p)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))


def test_shards_split_at_their_own_vantage_points(spark, monkeypatch):
    rng = np.random.default_rng(3)
    points = np.unique(np.concatenate([clustered(200, 9), rng.integers(0, 1 << 63, 400, dtype=np.uint64)]))
    fps = spark.createDataFrame([(int(p), int(p), b"", 7) for p in points.view(np.int64)], "node long, fp long, more binary, path long")
    split = simhash.split_shards(fps, 4, most=300).collect()
    shards = defaultdict(set)
    for r in split:
        shards[r.path].add(r.node)
    # Smaller shards, overlapping ones, and every pair within the radius in some shard.
    assert len(shards) > 2 and max(map(len, shards.values())) < len(points) and len(points) < sum(map(len, shards.values())) < 4 * len(points)
    signed = [int(p) for p in points.view(np.int64)]
    for i, p in enumerate(signed):
        for q in signed[:i]:
            if bin((p ^ q) & (1 << 64) - 1).count("1") <= 4:
                assert any(p in s and q in s for s in shards.values())
    # One value of distance cannot be split; the shard stays whole.
    same = spark.createDataFrame([(i, 5, b"", 1) for i in range(40)], "node long, fp long, more binary, path long")
    assert {r.path for r in simhash.split_shards(same, 4, most=10).collect()} == {1}


def test_block_masks_cover_and_scale():
    for n in (10, 10**6, 10**9):
        for radius in (4, 12):
            masks, _ = simhash.block_masks(n, radius)
            every = 0
            for m in masks:
                every |= m
            assert every == (1 << 64) - 1 and len(masks) <= simhash.MAX_TREES


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (5, 5)], "a long, b long")
    found = {r.node: r.component for r in simhash.components(edges).collect()}
    assert found == {i: 0 for i in range(1, 41)} | {100: 90}
    assert simhash.components(edges.limit(0)).count() == 0


def plain_removal(rows):
    first = {}
    for i, t in rows:
        for k in range(len(t) - 49):
            first[t[k : k + 50]] = min(first.get(t[k : k + 50], 1 << 63), i)
    out = []
    for i, t in rows:
        gone = bytearray(len(t))
        for k in range(len(t) - 49):
            if first[t[k : k + 50]] < i:
                gone[k : k + 50] = b"\x01" * 50
        out.append((i, bytes(b for b, g in zip(t, gone) if not g), len(re.findall(b"\x01+", bytes(gone)))))
    return sorted(out)


def test_suffix_removal_by_brute_force(docs, rows, empty, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 40_000)
    last = suffix_dedup.LAST
    want = plain_removal([(last if r[0] is None else r[0], (r[1] or "").encode()) for r in rows])
    got = suffix_dedup.remove_repeats(docs).collect()
    assert sorted((last if r.doc_id is None else r.doc_id, bytes(r.kept), len(r.starts)) for r in got) == want
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_hot_anchors_and_chunks_give_the_same():
    import random

    import pandas as pd

    rng = random.Random(1)
    base = ["".join(rng.choice("ab é") for _ in range(n)) for n in (60, 90, 200, 400)]
    rows = []
    for i in range(30):
        parts = [x[rng.randint(0, 40) :][: rng.randint(0, 300)] for x in rng.choices(base, k=2)]
        rows.append((i % 25, "|".join(parts)))
    want = plain_removal([(i, t.encode()) for i, t in rows])
    keep = suffix_dedup.HOT, suffix_dedup.CHUNK, suffix_dedup.SLICE
    for suffix_dedup.HOT, suffix_dedup.CHUNK, suffix_dedup.SLICE in ((1, 100, 3), (20_000, 1 << 18, 5), (4, 1000, 4096)):
        df = pd.DataFrame(rows, columns=["doc_id", "text"]).assign(is_null=False)
        df["block"] = [len(t) % 3 for _, t in rows]
        by = lambda f, d, k: pd.concat([f(g) for _, g in d.groupby(k)] or [suffix_dedup._rows([])])
        a = by(lambda g: suffix_dedup.first_digits(g, 4), df, "block")
        b = by(suffix_dedup.repeated_digits, a, "bucket")
        own = lambda rows_, n: rows_[rows_["block"] == n]
        c = by(lambda g: suffix_dedup.send_contexts(g, own(b, g["block"].iloc[0]), 4), df, "block")
        d = pd.concat([b, by(suffix_dedup.sort_bucket, c, "bucket")])
        got = by(lambda g: suffix_dedup.remove(g, own(d, g["block"].iloc[0]), 4), df, "block")
        assert sorted((r.doc_id, r.kept, len(r.starts)) for r in got.itertuples()) == want
    suffix_dedup.HOT, suffix_dedup.CHUNK, suffix_dedup.SLICE = keep


def test_byte_passes_and_exact_contexts(monkeypatch):
    rng = np.random.default_rng(2)
    width, reach = 2 * suffix_dedup.WINDOW - suffix_dedup.GRAM, suffix_dedup.WINDOW - suffix_dedup.GRAM
    # Windows that share long beginnings, ends or all but one byte; the anchors are not looked at here.
    base = rng.integers(97, 99, (4, width), dtype=np.uint8)
    context = base[rng.integers(0, 4, 300)]
    spots = rng.integers(0, width, 300)
    context[np.arange(300), spots] ^= rng.integers(0, 2, 300, dtype=np.uint8)
    first = rng.integers(0, reach, 300, dtype=np.uint8)
    last = (first + rng.integers(0, reach + 1 - first)).astype(np.uint8)
    doc = rng.integers(0, 90, 300)
    least = {}
    window = lambda i, k: context[i, k : k + suffix_dedup.WINDOW].tobytes()
    for i in range(300):
        for k in range(first[i], last[i] + 1):
            least[window(i, k)] = min(least.get(window(i, k), 1 << 60), doc[i])
    want = [sum(1 << k for k in range(first[i], last[i] + 1) if doc[i] > least[window(i, k)]) for i in range(300)]
    assert suffix_dedup.sorted_windows(context, first, last, doc).tolist() == want and 0 < sum(map(bool, want)) < 300
    one, inverse = suffix_dedup._distinct(context, first, last)
    monkeypatch.setattr(suffix_dedup, "_context_key", lambda c, f, g: c[:, 0].astype(np.uint64))  # hashes that collide
    two, other = suffix_dedup._distinct(context, first, last)
    same = lambda inv: {frozenset(np.flatnonzero(inv == x).tolist()) for x in range(inv.max() + 1)}
    assert same(inverse) == same(other) and len(one) == len(two) == len({(window(i, 0), context[i].tobytes(), first[i], last[i]) for i in range(300)})


def test_radix_passes():
    d1, d2, doc = np.array([1, 1, 1, 2], np.uint64), np.array([5, 5, 6, 5], np.uint64), np.array([4, 3, 1, 0])
    assert suffix_dedup.radix(d1, d2, doc).tolist() == [True, False, False, False]


def test_near_duplicates_by_shingle_sets(spark):
    import random

    rng = random.Random(4)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    line, base = words(14), words(400)
    texts = [base, base[:380] + words(20), base[:310] + words(90), base[:322] + words(78)]
    # Two texts that share one line only, twenty times over: SimHash with repeats takes them for copies.
    texts += [words(150) + line * 20 for _ in range(6)]
    for _ in range(30):
        t = words(rng.randint(60, 300))
        cut = rng.randint(1, len(t) // 8)
        texts += [t, t[:-cut] + words(cut)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    sets = [{tuple(t[k : k + 5]) for k in range(len(t) - 4)} for t in texts]
    label = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 5, 16, 0.8).collect()
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(label))


def test_set_search_in_chunks(spark, monkeypatch):
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(base[:i] + [f"x{i}"] + base[i + 1 :])) for i in range(0, 200, 5)] + [(None, "a b"), (None, "a c")]
    monkeypatch.setattr(simhash, "MAX_SETS", 7)
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 5, 16, 0.8).collect()
    assert {r.component_id for r in got if r.doc_id is not None} == {0} and len({r.root for r in got}) == 3


def test_sets_meet_by_their_shingles(spark, monkeypatch):
    import random

    rng = random.Random(11)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    sets_of = lambda t: {tuple(t[k : k + 5]) for k in range(max(1, len(t) - 4))}
    alike = lambda a, b: 10 * len(sets_of(a) & sets_of(b)) >= 8 * len(sets_of(a) | sets_of(b))
    bits = lambda t: simhash._majorities(np.unique(simhash.shingles(" ".join(t), 5)), 1)[0]
    line = words(12)
    texts = [line + words(rng.randint(15, 60)) for _ in range(400)]
    texts += [t[:-cut] + words(cut) for t in texts[:100] for cut in [rng.randint(1, 6)]]
    far = []
    while len(far) < 6:
        one = line + words(48)
        two = one[:-6] + words(6)
        if alike(one, two) and bin(bits(one) ^ bits(two)).count("1") > 16:
            far += [one, two]
    texts += [*far, ["a"], ["a"], [], ["a", "b"]]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if label[i] != label[j] and (alike(texts[i], texts[j]) if texts[i] and texts[j] else texts[i] == texts[j]):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    made, dealt = simhash._shards, []

    def counted(placed, key, most):
        out = made(placed, key, most)
        dealt.append(out.count())
        return out

    monkeypatch.setattr(simhash, "_shards", counted)
    rows = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    for most in (20_000, 40):
        monkeypatch.setattr(simhash, "MAX_SHARD", most)
        got = simhash.near_duplicates(rows, 5, 16, 0.8).collect()
        assert {r.doc_id: r.component_id for r in got} == dict(enumerate(label))
    # With shards of 40 the line that all texts share deals out no text to many shards, however many texts there are.
    assert max(dealt[-2:]) < 2 * len(texts)


def test_alike_sets_share_a_prefix():
    rng = np.random.default_rng(6)
    for n in [1, 2, 4, 5, 9, 10, 50, 400] * 20:
        common = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        both = [np.unique(np.concatenate([common, rng.integers(0, 1 << 63, k, dtype=np.uint64)])) for k in rng.integers(0, n // 8 + 2, 2)]
        frequent = np.unique(np.concatenate([rng.choice(common, n // 2), rng.integers(0, 1 << 63, 9, dtype=np.uint64)]))
        for late in (frequent, common[:0], np.unique(common)):
            if simhash.jaccard(*both, 0.8):
                one, two = (simhash.prefix(h, 0.8, late) for h in both)
                assert set(one.tolist()) & set(two.tolist()) and len(one) <= 0.2 * len(both[0]) + 1
    assert len(simhash.prefix(common[:0], 0.8, frequent)) == 0
