"""The classifier cascade over records, in one projection.

A classifier is a nullable proposal struct (source, class_name, priority, confidence, reasons) computed from
the record alone; all configured classifiers become one array column, in classifier order. Narrowing and
conflict resolution work on that array with higher-order functions: the cascade needs no shuffle, no
window and no Python. Within a classifier the highest priority wins, and the first in configuration order
among equals.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions.iri import local_name, pascal_case
from lodestone.functions.plan import cut, once, settled
from lodestone.functions.pointer import kind, string_at, value_at
from lodestone.plans.predicate import looked_up
from lodestone.plans.schema import compile_schema

PROPOSAL = "struct<source:string,class_name:string,priority:double,confidence:double,reasons:array<string>>"
SENTINELS = ("__source__", "__validation__", "__narrowing_applied__", "unknown")
GENERIC = "Generic"


def proposal(source: str, class_name: Column, priority: Column | float, confidence: Column | float, reasons: Column) -> Column:
    """A proposal struct."""
    number = lambda x: (F.lit(float(x)) if isinstance(x, (int, float)) else x.cast("double"))
    return F.struct(F.lit(source).alias("source"), class_name.alias("class_name"), number(priority).alias("priority"), number(confidence).alias("confidence"), reasons.alias("reasons"))


def _present(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def discriminator(rec: Column, from_: str, fallback: str | None = None, sanitize: str = "verbatim", priority: float = 50) -> Column:
    """The class is the text at a pointer, else at the fallback."""
    raw = _present(string_at(rec, from_))
    if fallback:
        raw = F.coalesce(raw, _present(string_at(rec, fallback)))
    name = pascal_case if sanitize in ("pascalCase", "kebabToPascal") else lambda x: x
    return once(raw, lambda x: F.when(x.isNotNull(), proposal("classify:discriminator", name(x), priority, 1, F.array(F.concat(F.lit(f'discriminator at "{from_}" resolved to "'), x, F.lit('"'))))))


def source_sentinel(rec: Column) -> Column:
    """A sentinel that records the source block."""
    told = [F.concat(F.lit(f"{k}="), v) for k in ("target", "plugin", "schemaId") if (v := string_at(rec, f"/_source/{k}")) is not None]
    reasons = F.array_compact(F.array(*told))
    return F.when(F.size(reasons) > 0, proposal("classify:source", F.lit("__source__"), 0, 1, reasons))


def _strongest(matches: list[tuple[Column, str, float, list]], source: str, more: Column | None = None) -> Column:
    """The proposal of the strongest match; all matches give their reasons, in order."""
    if not matches:
        return F.lit(None).cast(PROPOSAL)
    hits = F.array_compact(F.array(*[
        F.when(test, F.struct(F.lit(float(priority)).alias("p"), F.lit(-i).alias("i"), F.lit(name).alias("c"), F.array(*[F.lit(r) for r in reasons]).cast("array<string>").alias("r")))
        for i, (test, name, priority, reasons) in enumerate(matches)
    ]))

    def told(hits: Column) -> Column:
        # The greatest (priority, earliest) pair; names and reasons never decide.
        best = F.reduce(hits, F.element_at(hits, 1), lambda a, x: F.when(x["p"] > a["p"], x).otherwise(a))
        reasons = F.flatten(F.transform(hits, lambda x: x["r"]))
        if more is not None:
            reasons = F.concat(reasons, more)
        return F.when(F.size(hits) > 0, once(best, lambda b: proposal(source, b["c"], b["p"], 1, reasons)))

    return once(hits, told)


def url_pattern(rec: Column, patterns: list[dict]) -> Column:
    """Unanchored patterns over the record's URL: ``{match, className, priority}``."""
    url = F.coalesce(_present(string_at(rec, "/_source/url")), _present(string_at(rec, "/url")))

    def told(url: Column) -> Column:
        matches = [(F.coalesce(url.rlike(p["match"]), F.lit(False)), p["className"], p.get("priority", 35), [f"engine=url-pattern,regex={p['match']} → {p['className']}"]) for p in patterns]
        return _strongest(matches, "classify:url-pattern", F.array(F.concat(F.lit("url="), url)))

    return once(url, told)


def rules(rec: Column, specs: list[dict], source: str = "classify:rules") -> Column:
    """Predicate rules: ``{className, priority, predicate, reasons}``; also the structural classifier."""
    return looked_up(rec, [s["predicate"] for s in specs], lambda tests: _strongest([(t, s["className"], s["priority"], s.get("reasons", [])) for t, s in zip(tests, specs)], source))


def schema(rec: Column, specs: list[dict]) -> Column:
    """JSON Schemas: ``{schemaId, schema, className, priority}``."""
    return _strongest([(compile_schema(rec, s["schema"]), s["className"], s.get("priority", 40), [f"schema:{s['schemaId']} matched"]) for s in specs], "classify:schema")


def shacl_shape(rec: Column, shapes: list[dict], priority: float = 45) -> Column:
    """The first shape that the record's own keys conform to (order decides, not priority).

    A shape is ``{iri, targetClass?, schemaId?, properties: [{path, minCount?, maxCount?, datatype?, pattern?, in?}]}``.
    """
    hits = []
    for s in shapes:
        tests = [_shape_property(rec, p) for p in s["properties"]]
        target = s.get("targetClass") or s.get("schemaId") or s["iri"]
        name = target.rstrip("/#").replace("#", "/").rsplit("/", 1)[-1] if s.get("targetClass") or not s.get("schemaId") else target
        hits.append(F.when(reduce(lambda a, b: a & b, tests, F.lit(True)), proposal("classify:shacl-shape", F.lit(name), priority, 1, F.array(F.lit(f"shacl:{s['iri']} conforms")))))
    return F.coalesce(*hits) if hits else F.lit(None).cast(PROPOSAL)


def _shape_property(rec: Column, spec: dict) -> Column:
    name = spec["path"].replace("#", "/").rsplit("/", 1)[-1].replace("~", "~0")
    value = value_at(rec, f"/{name}")
    own = kind(value)
    items = F.when(own == "array", F.try_variant_get(value, "$", "array<variant>")).when(value.isNull() | (own == "null"), F.array().cast("array<variant>")).otherwise(F.array(value))
    n = F.size(items)
    tests = []
    if "minCount" in spec:
        tests.append(n >= spec["minCount"])
    if "maxCount" in spec:
        tests.append(n <= spec["maxCount"])
    kinds = {"string": "string", "integer": "number", "decimal": "number", "double": "number", "boolean": "boolean"}
    if "datatype" in spec:
        wanted = spec["datatype"].replace("#", "/").rsplit("/", 1)[-1].split(":")[-1]
        whole = lambda v: F.try_variant_get(v, "$", "double") == F.floor(F.try_variant_get(v, "$", "double"))
        tests.append(F.forall(items, lambda v: (kind(v) == kinds.get(wanted, "string")) & (F.coalesce(whole(v), F.lit(False)) if wanted == "integer" else F.lit(True))))
    text = lambda v: F.coalesce(F.try_variant_get(v, "$", "string"), F.to_json(v))
    if "pattern" in spec:
        tests.append(F.forall(items, lambda v: text(v).rlike(spec["pattern"])))
    if "in" in spec:
        tests.append(F.forall(items, lambda v: text(v).isin(*[str(x) for x in spec["in"]])))
    return reduce(lambda a, b: a & b, [F.coalesce(t, F.lit(False)) for t in tests], F.lit(True))


def record_keys(rec: Column) -> Column:
    """The record's own keys, sorted, without the source block."""
    return F.array_sort(F.array_except(F.json_object_keys(F.to_json(rec)), F.array(F.lit("_source"))))


def jaccard(a: Column, b: Column) -> Column:
    """Jaccard similarity of two key sets; two empty ones have none in common."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def fingerprint(rec: Column, fingerprints: dict[str, list[str]], least: float = 0.85, priority: float = 32) -> Column:
    """The class whose key set is nearest to the record's keys (the first of equals), from ``least`` on."""
    keys = record_keys(rec)
    scored = F.array(*[F.struct(jaccard(keys, F.array(*[F.lit(k) for k in sorted(set(ks))])).alias("s"), F.lit(c).alias("c")) for c, ks in fingerprints.items()])
    hits = F.filter(scored, lambda x: x["s"] >= least)
    best = F.reduce(hits, F.element_at(hits, 1), lambda a, x: F.when(x["s"] > a["s"], x).otherwise(a))
    reasons = F.transform(hits, lambda x: F.format_string("fingerprint:%s jaccard=%.3f", x["c"], x["s"]))
    return F.when(F.size(hits) > 0, proposal("classify:property-fingerprint", best["c"], priority, best["s"], reasons))


def entities(rec: Column, patterns: list[dict], fields: tuple[str, ...] = ("/description",), priority: float = 28) -> Column:
    """Phrases in text fields: ``{className, patterns, priority?}``, a pattern being words and ``[a,b]`` alternations."""
    def told(text: Column) -> Column:
        matches = []
        for p in patterns:
            tests = []
            for phrase in p["patterns"]:
                parts = ["(?:" + "|".join(_quoted(x.strip()) for x in w[1:-1].split(",")) + ")" if w.startswith("[") else _quoted(w) for w in phrase.lower().split()]
                tests.append(text.rlike("(?<![\\p{L}\\p{N}])" + "\\s+".join(parts) + "(?![\\p{L}\\p{N}])"))
            matches.append((F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False)), p["className"], p.get("priority", priority), [f"entity:{p['className']}"]))
        return _strongest(matches, "classify:entities", F.array(F.concat(F.lit("snippet="), F.substring(text, 1, 80))))

    return once(F.lower(F.concat_ws(" ", *[string_at(rec, f) for f in fields])), told)


def _quoted(word: str) -> str:
    return "\\Q" + word.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def real(proposals: Column) -> Column:
    """The proposals that name a class."""
    return F.filter(proposals, lambda p: ~p["class_name"].isin(*SENTINELS))


def check_classes(proposals: Column, known: list[str]) -> Column:
    """A sentinel that lists proposed classes missing from the class map."""
    missing = F.array_distinct(F.transform(F.filter(real(proposals), lambda p: ~p["class_name"].isin(*known) if known else F.lit(True)), lambda p: p["class_name"]))
    return F.when(F.size(missing) > 0, proposal("classify:ontology", F.lit("__validation__"), 0, 1, F.transform(missing, lambda c: F.concat(F.lit("unknown class: "), c))))


def closure(edges: list[tuple[str, str]]) -> dict[str, set[str]]:
    """All ancestors of each class, by local name; no class is its own ancestor by a self edge."""
    name = lambda iri: iri.replace("#", "/").rsplit("/", 1)[-1]
    up: dict[str, set[str]] = {}
    for a, b in edges:
        if name(a) != name(b):
            up.setdefault(name(a), set()).add(name(b))
    found = {}
    for c in up:
        seen, todo = set(), list(up[c])
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += up.get(x, ())
        found[c] = seen
    return found


def closure_table(edges: DataFrame, depth: int = 64) -> DataFrame:
    """(sub, sup) of the transitive closure of (sub, sup) edges, for hierarchies that are data.

    Every round doubles the path length, so log2(depth) joins suffice; self pairs are dropped.
    """
    found = cut(edges.select("sub", "sup").where("sub <> sup").distinct())
    n, size = 1, found.count()
    while n < depth:
        longer = found.alias("a").join(found.alias("b"), F.col("a.sup") == F.col("b.sub")).select(F.col("a.sub"), F.col("b.sup"))
        found = cut(found.unionByName(longer).where("sub <> sup").distinct())
        n, before, size = 2 * n, size, found.count()
        if size == before:
            break
    return found


def narrowed(proposals: Column, ancestors: dict[str, set[str]]) -> Column:
    """Drops every class that is a proper ancestor of another proposed one, and says so in a sentinel."""
    if not ancestors:
        return proposals
    above = F.map_from_arrays(
        F.array(*[F.lit(c) for c in sorted(ancestors)]), F.array(*[F.array(*[F.lit(u) for u in sorted(ancestors[c])]) for c in sorted(ancestors)]))
    up = lambda c: F.coalesce(F.element_at(above, c), F.array().cast("array<string>"))
    own = real(proposals)
    names = F.array_distinct(F.transform(own, lambda p: p["class_name"]))
    gone = F.filter(names, lambda c: F.exists(names, lambda o: (o != c) & F.array_contains(up(o), c)))
    kept = F.array_except(names, gone)
    reasons = F.flatten(F.transform(F.filter(own, lambda p: F.array_contains(gone, p["class_name"])), lambda p: F.transform(
        F.filter(kept, lambda k: F.array_contains(up(k), p["class_name"])), lambda k: F.concat(F.lit("narrowed: "), k, F.lit(" subClassOf "), p["class_name"], F.lit("; dropped "), p["class_name"]))))
    left = F.filter(proposals, lambda p: ~F.array_contains(gone, p["class_name"]))
    sentinel = F.array(proposal("classify:taxonomic-narrowing", F.lit("__narrowing_applied__"), 0, 1, reasons))
    return F.when((F.size(own) >= 2) & (F.size(gone) > 0), F.concat(left, sentinel)).otherwise(proposals)


def resolve(df: DataFrame, on_conflict: str = "quarantine", evidence: bool = True) -> DataFrame:
    """``df`` with classification: struct<type, confidence, engine, reasons, candidates, bucket, warnings>.

    No class: Generic. One class, or one of highest priority: that one. A tie between classes goes to the
    bucket ``conflicts``, or with ``on_conflict`` other than quarantine to the first class by name, with
    the candidates. The steps are columns of their own, so that each is computed once.
    """
    own, names, leaders, winner, votes = (F.col(c) for c in ("_own", "_names", "_leaders", "_winner", "_votes"))
    out = df.withColumn("_own", real(F.col("proposals")))
    out = out.withColumns({"_names": F.array_distinct(F.transform(own, lambda p: p["class_name"])), "_top": F.array_max(F.transform(own, lambda p: p["priority"]))})
    out = out.withColumn("_leaders", F.array_distinct(F.transform(F.filter(own, lambda p: p["priority"] == F.col("_top")), lambda p: p["class_name"])))
    tie = (F.size(names) > 1) & (F.size(leaders) > 1)
    out = out.withColumn("_winner", F.when(F.size(names) == 0, F.lit(GENERIC)).when(F.size(names) == 1, F.element_at(names, 1)).otherwise(F.array_min(leaders)))
    out = out.withColumn("_votes", F.filter(own, lambda p: p["class_name"] == winner))
    out = out.withColumn("_best", F.reduce(votes, F.try_element_at(votes, F.lit(1)), lambda a, x: F.when(x["priority"] > a["priority"], x).otherwise(a)))
    told = F.flatten(F.transform(votes, lambda p: p["reasons"])) if evidence else F.array(F.coalesce(F.try_element_at(F.col("_best")["reasons"], F.lit(1)), winner))
    none, quarantine = F.size(names) == 0, tie if on_conflict == "quarantine" else F.lit(False)
    made = F.struct(
        F.when(~quarantine, winner).alias("type"),
        F.when(none, F.lit(0.0)).when(~quarantine, F.col("_best")["confidence"]).alias("confidence"),
        F.when(none, F.lit("classify:generic-fallback")).when(~quarantine, F.array_join(F.array_distinct(F.transform(votes, lambda p: p["source"])), ",")).alias("engine"),
        F.when(none, F.array(F.lit("classify:generic-fallback"))).when(~quarantine, told).alias("reasons"),
        F.when(tie, F.array_sort(leaders)).alias("candidates"),
        F.when(quarantine, F.lit("conflicts")).alias("bucket"),
        F.when(none, F.array(F.lit("CLASSIFY_GENERIC_FALLBACK"))).otherwise(F.array().cast("array<string>")).alias("warnings"),
    )
    return out.withColumn("classification", settled(made)).drop("_own", "_names", "_top", "_leaders", "_winner", "_votes", "_best")


def cascade(records: DataFrame, config: dict, rec: str = "rec") -> DataFrame:
    """``records`` with the columns proposals and classification.

    ``config`` has a key for each classifier that takes part: discriminator, source, urlPattern, structural,
    rules, schema, shaclShape, fingerprint, entities, then ontology (known classes), narrowing (subclass
    edges), onConflict and evidence.
    """
    r, made = F.col(rec), []
    if (c := config.get("discriminator")) is not None:
        made.append(discriminator(r, c["from"], c.get("fallback"), c.get("sanitize", "verbatim"), c.get("priority", 50)))
    if config.get("source", True):
        made.append(source_sentinel(r))
    for name, build in (("urlPattern", url_pattern), ("schema", schema), ("shaclShape", shacl_shape), ("entities", entities)):
        if config.get(name):
            made.append(build(r, config[name]))
    for name in ("structural", "rules"):
        if config.get(name):
            made.append(rules(r, config[name], f"classify:{name}"))
    if (c := config.get("fingerprint")) is not None:
        made.append(fingerprint(r, c["classes"], c.get("minMatchScore", 0.85), c.get("priority", 32)))
    out = records.withColumn("proposals", settled(F.array_compact(F.array(*[m.cast(PROPOSAL) for m in made]))) if made else F.array().cast(f"array<{PROPOSAL}>"))
    if config.get("ontology") is not None:
        out = out.withColumn("proposals", F.concat("proposals", F.array_compact(F.array(check_classes(F.col("proposals"), config["ontology"]).cast(PROPOSAL)))))
    if config.get("narrowing"):
        out = out.withColumn("proposals", settled(F.col("proposals")))
        out = out.withColumn("proposals", narrowed(F.col("proposals"), closure(config["narrowing"])))
    return resolve(out.withColumn("proposals", settled(F.col("proposals"))), config.get("onConflict", "quarantine"), config.get("evidence", True))


def build_fingerprints(records: DataFrame, class_name: Column, rec: str = "rec") -> DataFrame:
    """(class_name, keys): the union of the top-level keys of each class's records."""
    keys = records.select(class_name.alias("class_name"), F.explode(record_keys(F.col(rec))).alias("key")).distinct()
    return keys.groupBy("class_name").agg(F.array_sort(F.collect_list("key")).alias("keys"))


def last_segment(iri: Column) -> Column:
    """The local name of an IRI."""
    return local_name(iri)
