"""Every ``opN`` query, column by column, against plain code over a folder of small tables with every odd case."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from html.parser import HTMLParser

import duckdb
import pytest
from test_decontam_secrets import brute, brute_near
from test_simhash_suffix import plain_components, plain_fingerprint, plain_removal
from test_toxicity_media_html_pipeline import PAGE, plain_score

from lodestone.llm import decontam, html_extract, licenses, media, queries, toxicity

LINES = ["Released under the MIT License.", "password = hunter2hunter2", "Licensed under\n# CC BY 4.0\n", "you moron, go away. Fine words here."]


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    texts = [(r[0], r[1], r[2], r[3], r[4], "clash", 1) for r in rows]
    texts += [(2000 + i, f"{rows[20 + i][1]}. {LINES[i % 4]}", "en", "hot", None, None, None) for i in range(40)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, fp string, shard int"
    spark.createDataFrame(texts, schema).repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(2000 + i, 1, int(i % 4 == 3)) for i in range(40)] + [(None, 1, 1), (2001, 1, None)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    long = rows[8][1].split()
    items = [(1, " ".join(long[100:130])), (12, "One"), (3, rows[4][1][:300].upper()), (4, ""), (5, None), (None, " ".join(long[200:211])), (1, " ".join(long[50:80]))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    pages = [(1, "u", PAGE), (2, None, None), (2, None, None), (3, "v", ""), (4, "w", plain_page(["Only one line", "and <i>more</i> of it &amp; so on"] * 30))]
    spark.createDataFrame([(*p, "text") for p in pages], "page_id long, url string, html string, text string").write.parquet(f"{at}/pages.parquet")
    return at


@pytest.fixture(scope="module")
def documents(spark, folder):
    return [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]


def run(spark, name, folder):
    return queries.queries()[name](spark, folder).collect()


def plain_page(paragraphs):
    return "<html><body><nav><a href='/'>Home</a></nav><article><h1>Heading</h1>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</article><footer>&copy; 2020</footer></body></html>"


def same(got, want):
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_op1(spark, folder, documents):
    got = run(spark, "op1_toxicity", folder)
    model = toxicity.fit(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    same([(r.doc_id, r.held_out, round(r.score, 9)) for r in got], [(i, zlib.crc32(str("" if i is None else i).encode()) % 5 == 0, round(float(plain_score(t or "", *model)), 9)) for i, t, _ in documents])
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in got)
    assert {r.predicted for r in got if r.doc_id and r.doc_id >= 2000 and r.doc_id % 4 == 3} == {1}


def test_op2(spark, folder, documents):
    last = (1 << 63) - 1
    plain = plain_removal([(last if i is None else i, (t or "").encode()) for i, t, _ in documents])
    sizes = Counter((i, len((t or "").encode())) for i, t, _ in documents)
    got = run(spark, "op2_suffix_dedup", folder)
    same([(last if r.doc_id is None else r.doc_id, r.n_bytes - r.n_removed, r.n_spans, r.kept_sha256) for r in got], [(i, len(k), n, hashlib.sha256(k).hexdigest()) for i, k, n in plain])
    assert Counter((r.doc_id, r.n_bytes) for r in got) == sizes and any(r.n_removed for r in got)


def test_op3(spark, folder, documents):
    got = run(spark, "op3_sharding", folder)
    same([(r.doc_id, r["size"], r.text_crc32) for r in got], [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in documents])
    shards = defaultdict(list)
    for r in got:
        shards[r.shard].append(r.slot)
    counts = [len(shards[s]) for s in range(16)]
    assert max(counts) - min(counts) <= 1 and all(sorted(v) == list(range(len(v))) for v in shards.values()) and set(shards) == set(range(16))
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}


def test_op4(spark, folder, documents):
    items = [("" if r.item_id is None else str(r.item_id), r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    want = []
    for i, t, _ in documents:
        n, hit, found = brute(t, items, 10)
        want.append((i, n, hit, len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), hit > 0, len(brute_near(t, items, 10, 20))))
    got = run(spark, "op4_decontamination", folder)
    same([(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated, r.n_near_items) for r in got], want)
    assert any(w[5] for w in want)


def test_op4_with_more_pairs_than_are_broadcast(spark, folder, monkeypatch):
    want = run(spark, "op4_decontamination", folder)
    monkeypatch.setattr(decontam, "BROADCAST_PAIRS", 0)
    query = queries.op4_decontamination(spark, folder)
    assert "SortMergeJoin" in query._jdf.queryExecution().executedPlan().toString()
    same(query.collect(), want)


class PlainArticle(HTMLParser):
    """The article's blocks of a well-formed page without any boilerplate inside its article."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks, self.parts = False, [], []

    def cut(self):
        if text := " ".join("".join(self.parts).split()):
            self.blocks.append(text)
        self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag in ("p", "h1", "h2", "li", "article"):
            self.cut()
        self.inside |= tag == "article"
        if tag == "br":
            self.parts.append(" ")

    def handle_endtag(self, tag):
        if tag in ("p", "h1", "h2", "li", "article"):
            self.cut()
        self.inside &= tag != "article"

    def handle_data(self, data):
        if self.inside:
            self.parts.append(data)


def by_plain_parser(page):
    parser = PlainArticle()
    parser.feed(page)
    parser.cut()
    return "\n\n".join(parser.blocks)


def test_op5(spark, folder):
    pages = {r.page_id: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    got = run(spark, "op5_html_extraction", folder)
    want = {1: html_extract.main_text(PAGE), 2: "", 3: "", 4: by_plain_parser(pages[4].html)}
    same([(r.page_id, r.url, r.text, r.n_chars) for r in got], [(i, pages[i].url, want[i], len(want[i])) for i in (1, 2, 2, 3, 4)])


def test_op5_on_the_given_pages_against_a_plain_parser():
    """Every page of the smallest given table whose article is closed and free of menus."""
    pages = [r[0] for r in duckdb.sql("SELECT html FROM '/root/testdata/sf0.001/pages.parquet'").fetchall()]
    plain = [p for p in pages if p.count("<article>") == 1 == p.count("</article>")]
    assert plain
    for p in plain:
        assert html_extract.main_text(p) == by_plain_parser(p)
    told = html_extract.decisions(pages)
    good = {by: sum(n for (region, kind, b), n in told.items() if region == "good" and b == by) for by in ("density", "neighbour", "default")}
    # Inside articles both passes decide; the region alone only what has no decided neighbour.
    assert good["density"] and good["neighbour"] and good["default"] < 0.2 * sum(good.values())


def test_op6(spark, folder, documents):
    got = run(spark, "op6_best_fit_packing", folder)
    total, bins = Counter(), defaultdict(list)
    for r in got:
        total[r.doc_id] += r.length
        bins[r.bin].append(r)
    want = Counter()
    for i, t, _ in documents:
        want[i] += len((t or "").encode()) + 1
    assert total == want
    texts, sources = {i: t or "" for i, t, _ in documents}, {i: s for i, _, s in documents}
    for own in bins.values():
        assert sum(r.length for r in own) + own[0].residual == 16_384 and own[0].residual >= 0 and sorted(r.slot for r in own) == list(range(len(own)))
        assert max(Counter((texts[r.doc_id], r.piece) for r in own).values()) == 1 and max(Counter(sources[r.doc_id] for r in own).values()) <= 4


def test_op7(spark, folder, documents):
    points = [plain_fingerprint(t) for _, t, _ in documents]
    roots, least = plain_components(points, 4), {}
    for (i, _, _), k in zip(documents, roots):
        least[k] = min(least.get(k, 1 << 60), 1 << 60 if i is None else i)
    got = run(spark, "op7_simhash", folder)
    same([(r.doc_id, r.fingerprint, r.component_id) for r in got], [(i, f"{p:016x}", least[k]) for (i, _, _), p, k in zip(documents, points, roots)])


def plain_base(text):
    """The three base patterns as they are dealt: every leftmost non-overlapping match, of which short ones are dropped."""
    letters = "(?:" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token")) + "|[aA][pP][iI]_?[kK][eE][yY])"
    found = [(m.start(), 0, m.end()) for m in re.finditer(letters + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[1]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def test_op8(spark, folder, documents):
    want, spans = [], {}
    for i, t, _ in documents:
        base = plain_base(t or "")
        told = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in base)
        want.append((i, *(sum(k == kind for _, k, _ in base) for kind in range(3)), hashlib.sha256(told.encode()).hexdigest()))
        spans[i] = {f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in base}
    got = run(spark, "op8_secret_scan", folder)
    same([(r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got], want)
    assert all({s for s in r.spans.split(",") if s and not s.startswith("novel")} == spans[r.doc_id] for r in got) and any(w[1] for w in want)


def test_base_patterns_by_the_dealt_expressions():
    import random

    from lodestone.llm import secrets

    rng, c = random.Random(12), secrets.primed()
    pool = ["password", "PassWd", "secret", "TOKEN", "api_key", "apikey", "=", ":", " ", '"', "'", "AKIA", "ABC123DEF456GHI789", "0f" * 12, "abcdef", "hunter2", "-", "é", "\n", "K", "ſecret"]
    for _ in range(3000):
        text = "".join(rng.choice(pool) for _ in range(rng.randint(1, 14)))
        assert [s for s in secrets.find(text, c) if s[1] < 3] == plain_base(text), text


def test_op9(spark, folder, documents):
    want = []
    for i, t, _ in documents:
        raw = (t or "").encode()
        payload = raw + b" " * (-len(raw) % 192 if raw else 192)
        stored = media.encode(payload)
        want.append((i, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(stored), hashlib.sha256(stored).hexdigest()))
    got = run(spark, "op9_media_columns", folder)
    same([(r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.media_bytes, r.media_sha256) for r in got], want)
    features = defaultdict(set)
    for r in got:
        features[r.payload_sha256].add(r.feature)
    assert all(len(f) == 1 for f in features.values()) and all(r.feature.count(",") == 35 for r in got)


def test_op10_against_duckdb(spark, folder, documents):
    got = run(spark, "op10_license_scan", folder)
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS FROM '{folder}/documents.parquet/*.parquet'")
    same([tuple(r) for r in got], db.sql(licenses.licenses_sql()).fetchall())
    assert {r.licenses for r in got} >= {"", "MIT", "CC-BY-4.0"}


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_duckdb_twin(spark, folder, name):
    """Over the odd cases: nulls in every column, empty and very long texts, ties and repeated rows."""
    db = duckdb.connect()
    for t in ("documents", "benchmark"):
        db.sql(f"CREATE VIEW {t} AS FROM '{folder}/{t}.parquet/*.parquet'")
    want = db.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, folder)
    assert sorted(got.columns) == sorted(want.columns)
    same(map(tuple, got.select(*want.columns).collect()), want.fetchall())


def test_xxh64_of_the_twin():
    """Every length from 0 to 200 bytes, one-byte and two-byte characters."""
    import random

    import pandas as pd
    import xxhash

    from lodestone.llm import twins

    rng = random.Random(4)
    d = pd.DataFrame({"words": ["".join(rng.choice("abc é") for _ in range(n)) for n in range(201)]})
    db, steps = duckdb.connect(), ["known AS (SELECT words, octet_length(encode(words)) AS n, list_transform(regexp_extract_all(hex(encode(words)), '..'), lambda x: CAST('0x' || x AS UTINYINT)) AS bytes FROM d)"]
    db.register("d", d)
    for k, select in enumerate(twins._xxh64(42)):
        steps.append(f"x{k} AS (SELECT {select} FROM {f'x{k - 1}' if k else 'known'})")
    got = db.sql(f"WITH {', '.join(steps)} SELECT words, h FROM x{len(steps) - 2}").fetchall()
    assert len(got) == 201 and all(h == xxhash.xxh64_intdigest(w.encode(), 42) for w, h in got)


def test_license_form_against_duckdb(spark):
    import random

    import pandas as pd
    from test_sharding_packing_licenses import APACHE, BSD2, BSD3, GPL, MIT

    rng, texts = random.Random(1), []
    for own in (MIT, BSD2, BSD3, GPL, APACHE):
        for prefix in ("", "# ", " * ", "// "):
            texts.append("import x\n\n" + "\n".join(prefix + line for line in own.split("\n")) + "\n\nand more.")
        texts += [own.replace("\n", " "), own.replace("\n", "\r\n")]
    for _ in range(600):
        x, y = rng.choice(texts[:30]), rng.choice(texts[:30])
        texts.append(x[: rng.randrange(len(x))] + rng.choice([" ", "\n", "\n\n", ". ", ": 1. ", "\x01", "; ", "\t* ", "ı İ É"]) + y[rng.randrange(len(y)) :])
    got = licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    db = duckdb.connect()
    db.register("documents", pd.DataFrame({"doc_id": range(len(texts)), "text": texts}))
    same([tuple(r) for r in got], db.sql(licenses.licenses_sql()).fetchall())
    assert sum(bool(r.licenses) for r in got) > 100


def test_custom_licence_tables(spark):
    docs = spark.createDataFrame([(1, "Use it as you like"), (2, "Use it\nas you like. Copyright someone. Do no harm."), (3, "something else")], "doc_id long, text string")
    got = {r.doc_id: (r.n_known, r.sequence, r.licenses) for r in licenses.scan_licenses(docs, sentences={"like": "Use it as you like", "harm": "Do no harm"}, rules=[("L", ["like"]), ("LH", ["like", licenses.GAP, "harm"])]).collect()}
    assert got == {1: (1, "<like>", "L"), 2: (2, "<like>~<harm>", "LH"), 3: (0, "", "")}


def test_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark", "pages"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    for name, query in queries.queries().items():
        assert query(spark, str(tmp_path)).count() == 0, name
