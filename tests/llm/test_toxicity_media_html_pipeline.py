import random
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from lodestone.llm import html_extract, media, toxicity


def labelled(n, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["th", "er", "on", "an"]) for _ in range(rng.randint(1, 3)))
    out = []
    for i in range(n):
        parts = [" ".join(word() for _ in range(8)) for _ in range(rng.randint(1, 6))]
        toxic = i % 4 == 0
        if toxic:
            k = rng.randrange(len(parts))
            parts[k] += " " + rng.choice(["moron", "idiot", "scumbag"])
        out.append((i, ". ".join(parts), int(toxic)))
    return out


def test_noisy_or_learns_and_locates():
    data = labelled(400, 1)
    model = toxicity.train([t for _, t, _ in data[:300]], [y for _, _, y in data[:300]])
    own = toxicity.SentenceModel(*model)
    scored = [(toxicity.judged(t, own), y, t) for _, t, y in data[300:]]
    assert sum((s[0] >= 0.5) == bool(y) for s, y, _ in scored) >= 97
    for s, y, t in scored:
        if y and s[0] >= 0.5:
            assert any(x in t.split(".")[s[2]] for x in ("moron", "idiot", "scumbag"))
    p, worst, at, *_ = toxicity.judged("a moron. fine words", own)
    assert abs(p - plain_score("a moron. fine words", *model)) < 1e-9 and at == 0 and worst <= p
    assert toxicity.judged("", own) == (0.0, 0.0, -1, 0, [])
    assert toxicity.train([], []) == ({}, -20.0) and toxicity.train(["a"], [1])[1] == 20.0


def plain_score(text, weights, bias):
    """Noisy-or of sentences, each the sum of its distinct features' weights, written out by the definitions."""
    keep = 1.0
    for sentence in re.split(r"[.!?\n\r]", text.lower()):
        words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", sentence)
        found = set()
        for raw in (w.encode() for w in words):
            found |= {zlib.crc32(raw) % (1 << 20)} | {zlib.crc32(str(n).encode() + b":" + raw[:n]) % (1 << 20) for n in (4, 5, 6) if len(raw) > n}
        if words:
            keep *= 1 - 1 / (1 + np.exp(-(bias + sum(weights.get(f, 0.0) for f in found))))
    return 1 - keep


def test_training_and_scoring_see_the_same_features():
    text = "Stupid stupidity, stupidly; a été! Übel? one\nlast one"
    weights = {f: 0.1 + k % 7 for k, f in enumerate(sorted({f for s in toxicity.sentences(text) for w in s for f in toxicity.features(w)}))}
    assert abs(toxicity.judged(text, toxicity.SentenceModel(weights, -12.0))[0] - plain_score(text, weights, -12.0)) < 1e-12
    assert toxicity.SentenceModel(dict.fromkeys(weights, 1.0), 0.0).logit([b"stupid", b"stupidity", b"stupidly"]) == 6.0


def test_training_sample_is_bounded_by_bytes(spark):
    docs = spark.createDataFrame([(i, "x" * (10 + i)) for i in range(50)] + [(3, "short")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, toxic int")
    whole, _ = toxicity.training_sample(docs, labels)
    part, _ = toxicity.training_sample(docs, labels, max_bytes=300)
    assert "short" in whole and sum(map(len, part)) <= 300 and 0 < len(part) < len(whole) and set(part) < set(whole)


def test_scores_use_text_alone(spark, docs, rows, empty):
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(30)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    texts, ys = toxicity.training_sample(docs, labels)
    allowed = [i for i in range(30) if zlib.crc32(str(i).encode()) % 5]
    assert len(texts) == len(allowed) and sum(ys) == sum(i % 5 == 0 for i in allowed)
    assert len(toxicity.training_sample(docs, labels, max_train=5)[0]) == 5
    got = toxicity.score_documents(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got) and all(r.score == 0 for r in got if r.doc_id in (0, 1, 2))
    assert len({r.score for r in got if r.doc_id in (4, 5, 6, None)}) == 1
    assert toxicity.score_documents(empty, labels).count() == 0
    kept = toxicity.keep_clean(docs, labels.limit(0))
    assert kept.columns == docs.columns and kept.count() == len(rows)


def test_media_round_trip(docs, rows, empty):
    got = media.media_columns(docs).collect()
    assert len(got) == len(rows)
    texts = {r[0]: (r[1] or "").encode() for r in rows}
    for r in got:
        own = texts[r.doc_id]
        assert r.payload == own + b" " * (max(192, -(-len(own) // 192) * 192) - len(own)) and r.n_bytes == len(own) and len(r.rgb) == r.height * r.width * 3
    assert len({(r.media, r.rgb) for r in got if r.doc_id in (4, 5, 6)}) == 1
    assert media.media_columns(empty).count() == 0


def test_every_byte_and_wide_files():
    for payload in (bytes(range(256)) * 3, b"\xff" * 192, b"\x00" * 384, bytes(random.Random(1).randbytes(192 * 1500))):
        image = media.decode(media.encode(payload))
        assert image.payload() == payload


def test_own_files_by_the_general_decoder(monkeypatch):
    rng = random.Random(8)
    payloads = [rng.randbytes(192 * n) for n in (1, 2, 3, 7)] + [b"\xff" * 192, b"\x00" * 384, "Prose, with words. ".encode() * 192]
    monkeypatch.setattr(media, "MAX_COLUMNS", 2)
    quick = [media.decode(media.encode(p)) for p in payloads]
    monkeypatch.setattr(media.Image, "_fixed", lambda *a: False)
    for payload, image in zip(payloads, quick):
        plain = media.decode(media.encode(payload))
        assert plain.payload() == payload and (plain.rgb() == image.rgb()).all() and (plain.h, plain.v) == (2, 2)
        assert all((a.coefficients == b.coefficients).all() for a, b in zip(plain.components, image.components))


def test_feature_by_hand():
    image = media.decode(media.encode(b"\x80" * 64 + b"\x00" * 128))
    rgb = image.rgb()
    told = list(map(int, media.feature(image, rgb).split(",")))
    values = [[int(v) for v in rgb[:, :, c].ravel()] for c in range(3)]
    assert told[:2] == [16, 16] and told[2:5] == [sum(v) // 256 for v in values]
    assert told[5:8] == [sum(x * x for x in v) // 256 - (sum(v) // 256) ** 2 for v in values]
    assert told[8:32] == [sum(x >> 5 == b for x in v) for v in values for b in range(8)]
    energy = [sum(int(x) ** 2 for x in image.components[0].coefficients[:, k]) for k in range(64)]
    assert told[32:] == [sum(energy[a:b]) // 256 for a, b in ((0, 1), (1, 6), (6, 28), (28, 64))]


class Writer:
    """A scalar encoder of progressive scans with ordinary Huffman tables, for tests."""

    def __init__(self):
        self.bits = []

    def put(self, value, n):
        self.bits += [value >> (n - 1 - i) & 1 for i in range(n)]

    def done(self):
        self.bits += [1] * (-len(self.bits) % 8)
        raw = bytes(int("".join(map(str, self.bits[i : i + 8])), 2) for i in range(0, len(self.bits), 8))
        return raw.replace(b"\xff", b"\xff\x00")


def extra(v):
    n = abs(v).bit_length()
    return n, v if v > 0 else v + (1 << n) - 1


def progressive(components, width, height, restart=0):
    """components: {id: (h, v, blocks [n, 64] in zigzag order in raster order of blocks)}; all symbols get 8-bit codes."""
    body = media._segment(0xDB, b"\x00" + bytes(range(1, 65)))
    frame = bytes([len(components)]) + b"".join(bytes([i, h << 4 | v, 0]) for i, (h, v, _) in components.items())
    body += media._segment(0xC2, b"\x08" + height.to_bytes(2, "big") + width.to_bytes(2, "big") + frame)
    table = bytes([0] * 7 + [255] + [0] * 8) + bytes(range(255))
    body += media._segment(0xC4, b"\x00" + table + b"\x10" + table)
    hmax, vmax = max(h for h, _, _ in components.values()), max(v for _, v, _ in components.values())
    across, down = -(-width // (8 * hmax)), -(-height // (8 * vmax))
    if restart:
        body += media._segment(0xDD, restart.to_bytes(2, "big"))

    def dc(high, low):
        out, w, last, count = b"", Writer(), {i: 0 for i in components}, 0
        for y in range(down):
            for x in range(across):
                if restart and count and count % restart == 0:
                    out += w.done() + bytes([0xFF, 0xD0 + (count // restart - 1) % 8])
                    w, last = Writer(), {i: 0 for i in components}
                count += 1
                for i, (h, v, b) in components.items():
                    for q in range(v):
                        for p in range(h):
                            c = int(b[(y * v + q) * across * h + x * h + p][0])
                            if high:
                                w.put(c >> low & 1, 1)
                            else:
                                n, e = extra((c >> low) - last[i])
                                w.put(n, 8)
                                w.put(e, n) if n else None
                                last[i] = c >> low
        return media._scan([(i, 0) for i in components], 0, 0, high, low) + out + w.done()

    def ac(i, first, last, high, low):
        h, v, blocks = components[i]
        own_across, own_down, w = -(-width * h // (8 * hmax)), -(-height * v // (8 * vmax)), Writer()
        shift = lambda c, n: (abs(c) >> n) * (1 if c > 0 else -1)
        runs = 0

        def flush(n):
            if n:
                size = n.bit_length() - 1
                w.put(size << 4, 8)
                w.put(n - (1 << size), size) if size else None

        for y in range(own_down):
            for x in range(own_across):
                block = [int(c) for c in blocks[y * across * h + x]]
                now = [shift(c, low) for c in block]
                if not high:
                    end = max([k for k in range(first, last + 1) if now[k]], default=first - 1)
                    if end >= first:
                        flush(runs)
                        runs = 0
                    zeros = 0
                    for k in range(first, end + 1):
                        if not now[k]:
                            zeros += 1
                            continue
                        while zeros > 15:
                            w.put(0xF0, 8)
                            zeros -= 16
                        n, e = extra(now[k])
                        w.put(zeros << 4 | n, 8)
                        w.put(e, n)
                        zeros = 0
                    runs += end < last
                    continue
                zeros, pending = 0, []
                end = max([k for k in range(first, last + 1) if abs(now[k]) == 1], default=first - 1)
                for k in range(first, end + 1):
                    if not now[k]:
                        zeros += 1
                        if zeros == 16:
                            w.put(0xF0, 8)
                            for b in pending:
                                w.put(b, 1)
                            zeros, pending = 0, []
                    elif abs(now[k]) > 1:
                        pending.append(abs(now[k]) & 1)
                    else:
                        w.put(zeros << 4 | 1, 8)
                        w.put(int(now[k] > 0), 1)
                        for b in pending:
                            w.put(b, 1)
                        zeros, pending = 0, []
                if end < last:
                    w.put(0, 8)
                    for b in pending + [abs(now[k]) & 1 for k in range(end + 1, last + 1) if abs(now[k]) > 1]:
                        w.put(b, 1)
        flush(runs)
        return media._scan([(i, 0)], first, last, high, low) + w.done()

    body += dc(0, 1)
    if restart:
        body += media._segment(0xDD, b"\x00\x00")
    for i in components:
        body += ac(i, 1, 5, 0, 2) + ac(i, 6, 63, 0, 2) + ac(i, 1, 63, 2, 1)
    if restart:
        body += media._segment(0xDD, restart.to_bytes(2, "big"))
    body += dc(1, 0)
    if restart:
        body += media._segment(0xDD, b"\x00\x00")
    for i in components:
        body += ac(i, 1, 63, 1, 0)
    return b"\xff\xd8" + body + b"\xff\xd9"


@pytest.mark.parametrize(("restart", "sampling"), [(0, (2, 2)), (2, (2, 1)), (0, (1, 1))])
def test_general_progressive_scans(restart, sampling):
    rng = np.random.default_rng(restart + sampling[0])
    width, height, (h, v) = 37, 21, sampling
    across, down = -(-width // (8 * h)), -(-height // (8 * v))
    make = lambda a, b: np.where(rng.random((across * a * down * b, 64)) < 0.2, rng.integers(-40, 41, (across * a * down * b, 64)), 0)
    components = {1: (h, v, make(h, v)), 2: (1, 1, make(1, 1)), 3: (1, 1, make(1, 1))}
    for i, (a, b, blocks) in components.items():
        own_across, own_down = -(-width * a // (8 * h)), -(-height * b // (8 * v))
        grid = blocks.reshape(down * b, across * a, 64)
        grid[own_down:, :, 1:] = 0  # blocks beyond the picture have no AC scans of their own
        grid[:, own_across:, 1:] = 0
    image = media.decode(progressive(components, width, height, restart))
    for c in image.components:
        assert (c.coefficients == components[c.ident][2]).all()
    rgb = image.rgb()
    assert rgb.shape == (height, width, 3)
    # One sample by the definition of the inverse transform.
    natural = np.zeros(64)
    natural[media.ZIGZAG] = components[1][2][0] * np.arange(1, 65)
    cu = lambda k: np.sqrt(0.5) if k == 0 else 1.0
    y0 = sum(cu(a) * cu(b) / 4 * natural[8 * b + a] * np.cos(np.pi * a / 16) * np.cos(np.pi * b / 16) for a in range(8) for b in range(8)) + 128
    plane = np.floor((natural @ media.BASIS + (1 << 12)) / (1 << 13))[0] + 128
    assert abs(plane - y0) <= 2


def test_decode_column(spark):
    rows = spark.createDataFrame([(1, media.encode(b"a" * 192)), (2, b"junk"), (3, None)], "id int, media binary")
    got = {r.id: r for r in media.decode_column(rows, "id").collect()}
    assert got[1].height == 16 and got[1].error is None and "ValueError" in got[2].error and got[3].rgb is None


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header class="site"><a href="/">Home</a> Welcome to the site</header><nav><ul><li><a href="/a">A</a></li></ul></nav>
<div class="ad">Buy now, the best of all the things you can buy in this world for so little that it is a wonder.</div>
<article><header><h1>Title &amp; more</h1></header><p>First &lt;para&gt;
 with   <b>bold</b> text<br>and a break.</p><p>Short.</p><aside>Also read this</aside><p><a href="x">linked words only in a paragraph of text</a></p>
<ul><li>One<li>Two</ul></article><section id="comments"><p>Nice post, and it is the best that I have read in a long time, for sure, thanks to all of you.</p></section>
<div class="cookie-consent">We use cookies</div><form><p>Name of the form</p></form><footer>&copy; 2020 Someone</footer></body></html>"""


def test_article_alone():
    assert html_extract.main_text(PAGE) == "Title & more\n\nFirst <para> with bold text and a break.\n\nShort.\n\nlinked words only in a paragraph of text\n\nOne\n\nTwo"


def test_pages_without_an_article():
    long = "This is the text of the page and it has all the words that are in the language, so that it can be seen as text. " * 3
    page = f"<body><div><a href='/a'>Home</a> <a href='/b'>News</a></div><h2>A heading</h2><p>{long}</p><p>Short one.</p><p>{long}</p><div><a href='/c'>Impressum</a></div><p>© someone</p></body>"
    one = " ".join(long.split())
    assert html_extract.main_text(page) == f"A heading\n\n{one}\n\nShort one.\n\n{one}"
    for empty in ("", "<html></html>", "<script>x", "<!-- a", "<nav>only a menu"):
        assert html_extract.main_text(empty) == ""
    assert html_extract.main_text("plain text & nothing else") == "plain text & nothing else"
    assert html_extract.main_text("<p>a &#233; &#x1F600; &nbsp; &unknown; b</p>") == "a é 😀 &unknown; b"
    assert html_extract.main_text("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>") == "deep"
    assert html_extract.main_text("<article><p>one<br><br>two<br>three</p></article>") == "one\n\ntwo three"


def test_extract_table(spark):
    rows = spark.createDataFrame([(1, "u", PAGE, "c"), (2, None, None, "c"), (2, None, None, "c"), (3, "v", "<article><p>" + "word " * 100_000 + "</p></article>", None)], "page_id long, url string, html string, text string")
    got = html_extract.extract(rows).collect()
    assert sorted((r.page_id, r.n_chars) for r in got) == [(1, len(html_extract.main_text(PAGE))), (2, 0), (2, 0), (3, 499_999)]
    assert html_extract.extract(rows.limit(0)).count() == 0


def test_pipeline_decisions(spark, tmp_path):
    data = labelled(200, 4)
    bench = [(1, data[1][1])]
    clean = "The quick brown fox jumps over the lazy dog and runs far away into the deep green forest again"
    extra_rows = [(1000, clean), (1001, clean), (1002, clean + " token=abcdef123456"), (1003, None), (1004, "before " + data[1][1] + " after")]
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in [(i, t) for i, t, _ in data] + extra_rows], "doc_id long, text string, lang string, source string, n_chars long")
    d = str(tmp_path / "sf")
    docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, y) for i, _, y in data], "doc_id long, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    now = docs
    left = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, d).write.parquet(f"{d}/out{k}")
        now = spark.read.parquet(f"{d}/out{k}")
        left.append(now)
        if k < 4:
            assert now.columns == docs.columns
    toxic = {i for i, _, y in data if y}
    after = [{r.doc_id for r in x.select("doc_id").collect()} for x in left]
    assert len(toxic & after[0]) <= 2 and {i for i, _, y in data if not y} - after[0] <= set(range(200)) and len({i for i, _, y in data if not y} - after[0]) <= 2
    assert 1000 in after[1] and 1001 not in after[1] and 1003 in after[1]
    assert 1 not in after[2] and 1004 not in after[2] and 1000 in after[2] and after[3] == after[2] == after[4]
    texts = {r.doc_id: r.text for r in left[3].collect()}
    assert all("abcdef123456" not in (t or "") for t in texts.values())
    pieces = left[4].groupBy("doc_id").sum("length").collect()
    assert {r[0]: r[1] for r in pieces} == {i: len((t or "").encode()) + 1 for i, t in texts.items()}
    assert corpus_pipeline.run(spark, d).count() == left[4].count()


def test_every_offending_sentence_is_located(spark):
    labelled = [(i, "you moron" if i % 2 else "fine words here", i % 2) for i in range(200)]
    labels = spark.createDataFrame([(i, y) for i, _, y in labelled], "doc_id long, toxic int")
    docs = spark.createDataFrame([(i, t) for i, t, _ in labelled] + [(1000, "Fine words here. You moron. Fine words. A moron you."), (1001, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.score_documents(docs, labels).where("doc_id >= 1000").collect()}
    assert [s.sentence for s in got[1000].offending] == [1, 3] and got[1000].n_offending == 2 and got[1001].offending == []
    assert max(s.score for s in got[1000].offending) == got[1000].worst_score and min(s.score for s in got[1000].offending) >= 0.5
