"""RDF formats: N-Quads and N-Triples as plain Spark text, Turtle, TriG and JSON-LD through small parsers.

N-Quads and N-Triples files are split by lines and parsed by one regular expression, applied once a line, so they
scale like any text source and stream as well. Turtle, TriG and JSON-LD documents are parsed whole, one
document a row. Quoted triples (RDF-star) are terms of the kind ``triple`` whose value is their text,
``<< s p o >>``; only the formats that end in ``-star`` write them.
"""

from __future__ import annotations

import itertools
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.iri import LANG_STRING, PREFIXES, RDF_TYPE, XSD, XSD_STRING, compact_iri
from lodestone.functions.plan import settled
from lodestone.operators.project import TERMS

# Formats with their extensions, media types and whether they hold named graphs.
FORMATS = {
    "nquads": ((".nq",), "application/n-quads", True),
    "ntriples": ((".nt",), "application/n-triples", False),
    "trig": ((".trig",), "application/trig", True),
    "turtle": ((".ttl", ".turtle"), "text/turtle", False),
    "jsonld": ((".jsonld",), "application/ld+json", True),
}
# The formats that hold quoted triples.
STAR_FORMATS = {"trig-star": ("trig", "application/trig-star"), "turtle-star": ("turtle", "text/turtle-star"), "nquads-star": ("nquads", "application/n-quads-star")}
QUAD_FORMATS = tuple(n for n, (_, _, quads) in FORMATS.items() if quads) + ("trig-star", "nquads-star")

#: A literal reaches to the line's last quote (nothing after it has one); what is inside is checked apart, as a
#: pattern of alternatives would recurse over long texts.
_UCHAR = r"\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}"
_IRI, _LITERAL = rf"<((?:[^<>\x22{{}}|^`\\\x00-\x20]++|{_UCHAR})*+)>", r'"(.*)"'
_BLANK, _QUOTED = r"(_:\S+?)", r"(<<\s*(?:<[^<>\s]*>|_:\S+)\s*<[^<>\s]*>\s*(?:<[^<>\s]*>|_:\S+)\s*>>)"
NQUAD = rf"(?s)^\s*(?:{_IRI}|{_BLANK}|{_QUOTED})\s*{_IRI}\s*(?:{_IRI}|{_BLANK}|{_LITERAL}(?:\^\^{_IRI}|@([A-Za-z]+(?:-[A-Za-z0-9]+)*))?|{_QUOTED})\s*(?:{_IRI}|{_BLANK})?\s*\.\s*(?:#.*)?$"
#: The groups of NQUAD, in order.
_GROUPS = ["s_iri", "s_blank", "s_triple", "p", "o_iri", "o_blank", "literal", "datatype", "lang", "o_triple", "g_iri", "g_blank"]

#: Quads of documents that are handed on together.
QUADS = 10_000


class FormatError(ValueError):
    """An unknown format, or one that cannot hold the data."""


def resolve_format(path: str | None = None, fmt: str | None = None) -> str:
    """The format by name, else by the path's extension."""
    if fmt is not None:
        if fmt not in FORMATS and fmt not in STAR_FORMATS:
            raise FormatError(f"unknown format {fmt!r}; known: {', '.join(FORMATS)}")
        return fmt
    for name, (extensions, _, _) in FORMATS.items():
        if path and path.lower().endswith(extensions):
            return name
    raise FormatError(f"no format for {path!r}")


# N-Quads and N-Triples.


def escaped(text: Column) -> Column:
    """A literal's lexical form with the five escapes."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for raw, told in (('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        out = F.replace(out, F.lit(raw), F.lit(told))
    return out


def unescaped(text: Column) -> Column:
    """The text of an escaped literal or IRI: named escapes and numeric ones of four and eight digits."""
    pairs = F.replace(F.replace(text, F.lit("\\\\"), F.lit("\\u005c")), F.lit("\\'"), F.lit("'"))
    # Numeric escapes of eight digits: within the first plane as four digits, else as the character itself.
    low = F.regexp_replace(pairs, r"\\U0000([0-9A-Fa-f]{4})", r"\\u$1")
    parts = F.split(low, r"(?=\\U[0-9A-Fa-f]{8})")
    wide = F.transform(parts, lambda x: F.when(x.startswith("\\U"), F.concat(F.decode(F.unhex(F.substring(x, 3, 8)), "UTF-32"), x.substr(F.lit(11), F.length(x)))).otherwise(x))
    # What is left is JSON's own set of escapes.
    options = {"allowUnquotedControlChars": "true", "maxStringLen": "2000000000"}
    read = F.from_json(F.concat(F.lit('["'), F.array_join(F.when(low.contains("\\U"), wide).otherwise(parts), ""), F.lit('"]')), "array<string>", options)
    return F.when(text.contains("\\"), read[0]).otherwise(text)


def nquads_line(graphs: bool = True) -> Column:
    """A quad's line; ``xsd:string`` and the default graph go unsaid, languages are kept."""
    resource = lambda kind, value: F.when(F.col(kind) == "blank", F.concat(F.lit("_:"), F.col(value))).when(F.col(kind) == "triple", F.col(value)).otherwise(F.concat(F.lit("<"), F.col(value), F.lit(">")))
    suffix = F.when(F.col("o_lang").isNotNull(), F.concat(F.lit("@"), F.col("o_lang"))).when(
        F.col("o_datatype").isNotNull() & (F.col("o_datatype") != XSD_STRING), F.concat(F.lit("^^<"), F.col("o_datatype"), F.lit(">"))).otherwise(F.lit(""))
    obj = F.when(F.col("o_type") == "literal", F.concat(F.lit('"'), escaped(F.col("o")), F.lit('"'), suffix)).otherwise(resource("o_type", "o"))
    g = F.when(F.col("g").isNotNull(), F.concat(F.lit("<"), F.col("g"), F.lit("> "))).otherwise(F.lit("")) if graphs else F.lit("")
    return F.concat(resource("s_type", "s"), F.lit(" <"), F.col("p"), F.lit("> "), obj, F.lit(" "), g, F.lit("."))


def quoted_triple(s: Column, p: Column, o: Column, s_type: Column | None = None, o_type: Column | None = None) -> Column:
    """The value of a term of the kind ``triple``."""
    term = lambda kind, value: F.concat(F.lit("<"), value, F.lit(">")) if kind is None else F.when(kind == "blank", F.concat(F.lit("_:"), value)).otherwise(F.concat(F.lit("<"), value, F.lit(">")))
    return F.concat(F.lit("<< "), term(s_type, s), F.lit(" <"), p, F.lit("> "), term(o_type, o), F.lit(" >>"))


def parse_nquads(lines: DataFrame, line: str = "value") -> DataFrame:
    """Quads of N-Quads or N-Triples lines, with an ``error`` column for lines that are neither.

    Blank lines and comments give no row. Each line is matched once: the pattern rewrites it to its groups,
    one a line, and the line is split there (a line holds no line feed of its own).
    """
    own = lines.where(F.trim(F.col(line)) != "").where(~F.col(line).rlike("^\\s*#"))
    own = own.withColumn("_parts", settled(F.split(F.regexp_replace(F.col(line), NQUAD, "\n".join(f"${i}" for i in range(1, len(_GROUPS) + 1))), "\n")))
    part = {name: F.nullif(F.try_element_at("_parts", F.lit(i + 1)), F.lit("")) for i, name in enumerate(_GROUPS)}
    literal = F.try_element_at("_parts", F.lit(_GROUPS.index("literal") + 1))
    # A literal may hold escapes that exist, and no quote or backslash besides.
    singles = F.replace(literal, F.lit("\\\\"), F.lit(""))
    bad = F.regexp_replace(singles, r"\\(?:[tbnrf\"']|u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8})", "").rlike('["\\\\]')
    ok = (F.size("_parts") == len(_GROUPS)) & ~bad
    blank = lambda c: c.substr(F.lit(3), F.length(c))
    is_literal = ok & part["o_iri"].isNull() & part["o_blank"].isNull() & part["o_triple"].isNull()
    kind = lambda b, t: F.when(b.isNotNull(), F.lit("blank")).when(t.isNotNull(), F.lit("triple"))
    return own.select(
        F.when(ok, kind(part["s_blank"], part["s_triple"]).otherwise(F.lit("iri"))).alias("s_type"),
        F.when(ok, F.coalesce(unescaped(part["s_iri"]), blank(part["s_blank"]), part["s_triple"])).alias("s"),
        F.when(ok, unescaped(part["p"])).alias("p"),
        F.when(is_literal, F.lit("literal")).when(ok, kind(part["o_blank"], part["o_triple"]).otherwise(F.lit("iri"))).alias("o_type"),
        F.when(is_literal, unescaped(literal)).when(ok, F.coalesce(unescaped(part["o_iri"]), blank(part["o_blank"]), part["o_triple"])).alias("o"),
        F.when(is_literal, F.coalesce(unescaped(part["datatype"]), F.when(part["lang"].isNotNull(), F.lit(LANG_STRING)).otherwise(F.lit(XSD_STRING)))).alias("o_datatype"),
        F.when(is_literal, part["lang"]).alias("o_lang"),
        F.when(ok, F.coalesce(unescaped(part["g_iri"]), part["g_blank"])).alias("g"),
        F.when(~ok, F.col(line)).alias("error"),
    )


def read_nquads(spark: SparkSession, path: str) -> DataFrame:
    """The quads of line-based files; lines that fail raise when read."""
    out = parse_nquads(spark.read.text(path))
    return out.select(*[F.when(F.col("error").isNotNull(), F.raise_error(F.concat(F.lit("no quad: "), F.col("error")))).otherwise(F.col(t)).alias(t) for t in TERMS])


# Turtle and TriG.

_TOKEN = re.compile(
    r"""(?P<ws>\s+|\#[^\n]*)|(?P<star><<|>>)|(?P<iri><[^<>"{}|^`\x00-\x20]*>)|(?P<long>\"{3}(?:"{0,2}(?:[^"\\]|\\.))*\"{3}|'{3}(?:'{0,2}(?:[^'\\]|\\.))*'{3})"""
    r"""|(?P<string>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')|(?P<lang>@[A-Za-z]+(?:-[A-Za-z0-9]+)*)|(?P<dt>\^\^)|(?P<blank>_:[\w][\w.-]*(?<!\.))"""
    r"""|(?P<number>[+-]?(?:\d+\.\d+|\.\d+|\d+)(?:[eE][+-]?\d+)?)|(?P<name>[\w-]*(?:\.[\w-]+)*:(?:[\w%:-]|\\.|\.(?=[\w%:-]))*)|(?P<word>[A-Za-z]\w*)|(?P<punct>[.;,\[\](){}])""",
    re.DOTALL,
)


class ParseError(ValueError):
    """A document that is not well formed, with where it went wrong."""

    def __init__(self, message: str, line: int, column: int):
        super().__init__(f"{message} at line {line}, column {column}")
        self.message, self.line, self.column = message, line, column


def _unescape(text: str) -> str:
    named = {"t": "\t", "b": "\b", "n": "\n", "r": "\r", "f": "\f"}
    return re.sub(r"\\(?:u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|(.))", lambda m: chr(int(m[1] or m[2], 16)) if m[1] or m[2] else named.get(m[3], m[3]), text, flags=re.DOTALL)


class _Turtle:
    """Turtle and TriG by recursive descent over tokens."""

    def __init__(self, text: str, base: str = ""):
        self.text, self.at, self.base, self.prefixes = text, 0, base, {}
        self.quads: list[tuple] = []
        self.graph: str | None = None
        self.count = 0
        self.kind, self.token = "", ""
        self.next()

    def fail(self, message: str) -> ParseError:
        start = self.at - len(self.token)
        return ParseError(message, self.text.count("\n", 0, start) + 1, start - self.text.rfind("\n", 0, start))

    def next(self) -> None:
        while self.at < len(self.text):
            m = _TOKEN.match(self.text, self.at)
            if m is None:
                self.token = ""
                raise self.fail(f"unexpected {self.text[self.at]!r}")
            self.at = m.end()
            if m.lastgroup != "ws":
                self.kind, self.token = m.lastgroup, m[0]
                return
        self.kind, self.token = "end", ""

    def take(self, token: str) -> bool:
        if self.kind in ("punct", "word", "dt") and self.token == token:
            self.next()
            return True
        return False

    def need(self, token: str) -> None:
        if not self.take(token):
            raise self.fail(f"expected {token!r}, found {self.token!r}")

    def iri(self) -> str:
        token, kind = self.token, self.kind
        if kind == "iri":
            self.next()
            found = _unescape(token[1:-1])
            return found if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", found) else self.base + found
        if kind == "name":
            prefix, local = token.split(":", 1)
            if prefix not in self.prefixes:
                raise self.fail(f"unknown prefix {prefix!r}")
            self.next()
            return self.prefixes[prefix] + re.sub(r"\\(.)", r"\1", local)
        raise self.fail(f"expected an IRI, found {token!r}")

    def new(self) -> tuple[str, str]:
        self.count += 1
        return "blank", f"b{self.count}"

    def resource(self) -> tuple[str, str]:
        if self.kind == "blank":
            label = self.token[2:]
            self.next()
            return "blank", label
        if self.take("["):
            own = self.new()
            if not self.take("]"):
                self.properties(own)
                self.need("]")
            return own
        if self.take("("):
            return self.collection()
        if self.kind == "star" and self.token == "<<":
            self.next()
            s, p, o = self.resource(), RDF_TYPE if self.take("a") else self.iri(), self.resource()
            if self.kind != "star" or self.token != ">>":
                raise self.fail("expected '>>'")
            self.next()
            told = [f"_:{v}" if kind == "blank" else v if kind == "triple" else f"<{v}>" for kind, v in (s, o)]
            return "triple", f"<< {told[0]} <{p}> {told[1]} >>"
        return "iri", self.iri()

    def collection(self) -> tuple[str, str]:
        items = []
        while not self.take(")"):
            items.append(self.object())
        rest: tuple = ("iri", PREFIXES["rdf"] + "nil")
        for item in reversed(items):
            own = self.new()
            self.add(own, PREFIXES["rdf"] + "first", item)
            self.add(own, PREFIXES["rdf"] + "rest", (*rest, None, None))
            rest = own
        return rest

    def object(self) -> tuple:
        kind, token = self.kind, self.token
        if kind in ("string", "long"):
            n = 3 if kind == "long" else 1
            text = _unescape(token[n:-n])
            self.next()
            if self.kind == "lang":
                lang = self.token[1:]
                self.next()
                return "literal", text, LANG_STRING, lang
            return "literal", text, (self.iri() if self.take("^^") else XSD_STRING), None
        if kind == "number":
            self.next()
            return "literal", token, XSD + ("double" if "e" in token.lower() else "decimal" if "." in token else "integer"), None
        if kind == "word" and token in ("true", "false"):
            self.next()
            return "literal", token, XSD + "boolean", None
        return (*self.resource(), None, None)

    def add(self, s: tuple[str, str], p: str, o: tuple) -> None:
        self.quads.append((s[0], s[1], p, o[0], o[1], o[2], o[3], self.graph))

    def properties(self, subject: tuple[str, str]) -> None:
        while True:
            p = RDF_TYPE if self.take("a") else self.iri()
            while True:
                self.add(subject, p, self.object())
                if not self.take(","):
                    break
            if not self.take(";"):
                return
            while self.take(";"):
                pass
            if self.kind == "punct" and self.token in ".]}" or self.kind == "end":
                return

    def directive(self) -> bool:
        word = self.token.lower().lstrip("@") if self.kind in ("lang", "word") else ""
        if word not in ("prefix", "base"):
            return False
        dotted = self.kind == "lang"
        self.next()
        if word == "prefix":
            if self.kind != "name" or not self.token.endswith(":"):
                raise self.fail("expected a prefix")
            name = self.token[:-1]
            self.next()
            self.prefixes[name] = self.iri()
        else:
            self.base = self.iri()
        if dotted:
            self.need(".")
        return True

    def triples(self) -> None:
        bracket = self.kind == "punct" and self.token == "["
        subject = self.resource()
        if not (bracket and self.kind == "punct" and self.token in ".}"):
            self.properties(subject)

    def told(self) -> list[tuple]:
        """The quads since the last call."""
        out, self.quads = self.quads, []
        return out

    def block(self) -> Iterator[tuple]:
        while not self.take("}"):
            self.triples()
            if not self.take(".") and not (self.kind == "punct" and self.token == "}"):
                raise self.fail("expected '.' or '}'")
            yield from self.told()
        self.graph = None

    def read(self) -> Iterator[tuple]:
        """The quads of one statement after the other; none is kept."""
        while self.kind != "end":
            if self.directive():
                continue
            if self.take("{"):
                yield from self.block()
                continue
            if self.kind == "word" and self.token.upper() == "GRAPH":
                self.next()
                self.graph = self.resource()[1]
                self.need("{")
                yield from self.block()
                continue
            mark = (self.at, self.kind, self.token)
            if self.kind in ("iri", "name", "blank"):
                name = self.resource()
                if self.take("{"):
                    self.graph = name[1]
                    yield from self.block()
                    continue
                self.at, self.kind, self.token = mark
            self.triples()
            self.need(".")
            yield from self.told()


def parse_turtle(text: str, base: str = "") -> tuple[list[tuple], dict[str, str]]:
    """Quads and prefixes of a Turtle or TriG document."""
    p = _Turtle(text, base)
    return list(p.read()), p.prefixes


def parse_jsonld(text: str) -> list[tuple]:
    """Quads of a JSON-LD document with inline contexts, as ``read_jsonld`` has them."""
    return list(read_jsonld(text))


def read_jsonld(text: str) -> Iterator[tuple]:
    """The quads of a JSON-LD document with inline contexts, of one node at the top after the other.

    Terms, prefixes, @vocab, @base, @language, type coercion, @reverse, @list, @set, @index and @language containers,
    @included, @nest and @graph; contexts by address are an error.
    """
    quads: list[tuple] = []
    count = [0]

    def context(value, outer: dict) -> dict:  # noqa: ANN001
        for part in value if isinstance(value, list) else [value]:
            if isinstance(part, str):
                raise ValueError(f"remote contexts are not loaded: {part}")
            outer = outer | (part or {})
        return outer

    def expand(name: str, ctx: dict, vocab: bool = True, seen: tuple = ()) -> str:
        own = ctx.get(name)
        own = own.get("@id") if isinstance(own, dict) else own
        if isinstance(own, str) and own != name and name not in seen:
            return expand(own, ctx, vocab, (*seen, name))
        if ":" in name:
            prefix, local = name.split(":", 1)
            base = ctx.get(prefix)
            base = base.get("@id") if isinstance(base, dict) else base
            if isinstance(base, str) and not local.startswith("//"):
                return base + local
            return name
        return ctx.get("@vocab", "") + name if vocab else ctx.get("@base", "") + name

    def node_id(value: str, ctx: dict) -> tuple[str, str]:
        return ("blank", value[2:]) if value.startswith("_:") else ("iri", expand(value, ctx, False))

    def emit(node: dict, ctx: dict, graph: str | None) -> tuple[str, str]:
        ctx = context(node["@context"], ctx) if "@context" in node else ctx
        if "@id" in node:
            own = node_id(node["@id"], ctx)
        else:
            count[0] += 1
            own = ("blank", f"j{count[0]}")
        for key, value in node.items():
            if key == "@type":
                for t in value if isinstance(value, list) else [value]:
                    quads.append((*own, RDF_TYPE, "iri", expand(t, ctx), None, None, graph))
            elif key == "@graph":
                for n in value if isinstance(value, list) else [value]:
                    emit(n, ctx, own[1] if "@id" in node else graph)
            elif key == "@reverse":
                for p, nodes in value.items():
                    for n in nodes if isinstance(nodes, list) else [nodes]:
                        back(n, expand(p, ctx), own, ctx, graph)
            elif key == "@included":
                for n in value if isinstance(value, list) else [value]:
                    emit(n, ctx, graph)
            elif key == "@nest":
                for n in value if isinstance(value, list) else [value]:
                    emit({**n, "@id": ("_:" if own[0] == "blank" else "") + own[1]}, ctx, graph)
            elif not key.startswith("@"):
                told(own, key, value, ctx, graph)
        return own

    def back(n, p: str, own: tuple[str, str], ctx: dict, graph: str | None) -> None:  # noqa: ANN001
        s = node_id(n, ctx) if isinstance(n, str) else node_id(n["@id"], ctx) if set(n) == {"@id"} else emit(n, ctx, graph)
        quads.append((*s, p, *own, None, None, graph))

    def told(own: tuple[str, str], key: str, value, ctx: dict, graph: str | None) -> None:  # noqa: ANN001
        term = ctx.get(key) if isinstance(ctx.get(key), dict) else {}
        container = term.get("@container")
        if "@reverse" in term:
            for n in value if isinstance(value, list) else [value]:
                back(n, expand(term["@reverse"], ctx), own, ctx, graph)
            return
        if container == "@language" and isinstance(value, dict):
            values = [{"@value": v, "@language": lang} for lang, vs in value.items() for v in (vs if isinstance(vs, list) else [vs])]
        elif container in ("@index", "@id") and isinstance(value, dict):
            values = [v if container == "@index" else {"@id": k, **v} for k, vs in value.items() for v in (vs if isinstance(vs, list) else [vs])]
        elif container == "@list" and not (isinstance(value, dict) and "@list" in value):
            values = [{"@list": value if isinstance(value, list) else [value]}]
        else:
            values = value if isinstance(value, list) else [value]
        for v in values:
            for o in objects(v, term, ctx, graph):
                quads.append((*own, expand(key, ctx), *o, graph))

    def objects(v, term: dict, ctx: dict, graph: str | None) -> list[tuple]:  # noqa: ANN001
        if v is None:
            return []
        if isinstance(v, dict) and "@set" in v:
            return [o for x in v["@set"] for o in objects(x, term, ctx, graph)]
        if isinstance(v, dict) and "@list" in v:
            rest: tuple = ("iri", PREFIXES["rdf"] + "nil", None, None)
            for item in reversed([o for x in v["@list"] for o in objects(x, term, ctx, graph)]):
                count[0] += 1
                own = ("blank", f"j{count[0]}")
                quads.append((*own, PREFIXES["rdf"] + "first", *item, graph))
                quads.append((*own, PREFIXES["rdf"] + "rest", *rest, graph))
                rest = (*own, None, None)
            return [rest]
        if isinstance(v, dict) and "@value" in v:
            raw, lang = v["@value"], v.get("@language")
            kind = expand(v["@type"], ctx) if "@type" in v else LANG_STRING if lang else None
            return [("literal", *scalar(raw, kind), lang)]
        if isinstance(v, dict):
            return [(*(node_id(v["@id"], ctx) if set(v) == {"@id"} else emit(v, ctx, graph)), None, None)]
        kind = term.get("@type")
        if kind == "@id" and isinstance(v, str):
            return [(*node_id(v, ctx), None, None)]
        if kind == "@vocab" and isinstance(v, str):
            return [("iri", expand(v, ctx), None, None)]
        lang = term.get("@language", ctx.get("@language"))
        if lang and not kind and isinstance(v, str):
            return [("literal", v, LANG_STRING, lang)]
        return [("literal", *scalar(v, expand(kind, ctx) if kind else None), None)]

    def scalar(v, kind: str | None) -> tuple[str, str]:  # noqa: ANN001
        if isinstance(v, bool):
            return ("true" if v else "false"), kind or XSD + "boolean"
        if isinstance(v, int):
            return str(v), kind or XSD + "integer"
        if isinstance(v, float):
            return repr(v), kind or XSD + "double"
        return v, kind or XSD_STRING

    doc = json.loads(text)
    for node in doc if isinstance(doc, list) else [doc]:
        inner = context(node["@context"], {}) if "@context" in node else {}
        if "@graph" in node and "@id" not in node:
            for n in node["@graph"]:
                emit(n, inner, None)
                yield from quads
                quads.clear()
        else:
            emit(node, {}, None)
            yield from quads
            quads.clear()


def read_document(text: str, fmt: str) -> Iterator[tuple]:
    """The quads of a whole document in any format, as it is read."""
    return read_jsonld(text) if fmt == "jsonld" else _Turtle(text).read()


def parse_document(text: str, fmt: str) -> list[tuple]:
    """Quads of a whole document in any format."""
    return list(read_document(text, fmt))


def syntax_errors(text: str, fmt: str) -> list[dict]:
    """What is wrong with a document: [] or one {message, line, column}."""
    try:
        parse_document(text, fmt)
    except ParseError as e:
        return [{"message": e.message, "line": e.line, "column": e.column}]
    except ValueError as e:
        return [{"message": str(e), "line": getattr(e, "lineno", None), "column": getattr(e, "colno", None)}]
    return []


def documents_quads(texts: DataFrame, fmt: str) -> DataFrame:
    """The quads of (path, value) documents, batch or stream, each parsed by one task; blank labels get their file's hash.

    What is parsed goes on by batches of QUADS rows, whether they come of many small documents or of one.
    """

    def parse(batches):  # noqa: ANN001, ANN202
        quads = ((path_, *q) for b in batches for path_, text in zip(b["path"], b["value"]) for q in read_document(text, fmt))
        while rows := list(itertools.islice(quads, QUADS)):
            yield pd.DataFrame(rows, columns=["path", *TERMS])

    out = texts.mapInPandas(parse, "path string, " + ", ".join(f"{t} string" for t in TERMS))
    scope = F.substring(F.sha1(F.col("path").cast("binary")), 1, 6)
    own = lambda kind, value: F.when(F.col(kind) == "blank", F.concat(scope, F.lit("_"), F.col(value))).otherwise(F.col(value))
    return out.withColumns({"s": own("s_type", "s"), "o": own("o_type", "o")}).select(*TERMS)


def read_documents(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """The quads of Turtle, TriG or JSON-LD files."""
    texts = spark.read.format("text").option("wholetext", True).option("recursiveFileLookup", True).load(path)
    return documents_quads(texts.select(F.col("_metadata.file_path").alias("path"), "value"), fmt)


def read_rdf(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """The quads of files in any format."""
    fmt = resolve_format(path, fmt)
    fmt = STAR_FORMATS[fmt][0] if fmt in STAR_FORMATS else fmt
    return read_nquads(spark, path) if fmt in ("nquads", "ntriples") else read_documents(spark, path, fmt)


# JSON-LD contexts.


def context_terms(quads: DataFrame, prefixes: dict[str, str]) -> DataFrame:
    """(term, iri, type, container) of a JSON-LD context inferred from quads, as two aggregations.

    type: ``@id`` if all objects are resources, the compact datatype if literals agree on one that is not
    plain, else null. container: ``@set`` if some subject has two different objects in a graph. IRIs that
    would share a term stay in full and get none.
    """
    obj = F.concat_ws("|", "o_type", "o", F.coalesce("o_datatype", F.lit("")), F.coalesce("o_lang", F.lit("")))
    by_subject = quads.groupBy("p", "s", F.coalesce("g", F.lit("")).alias("g")).agg(
        F.count_distinct(obj).alias("n"),
        F.bool_and(F.col("o_type") == "iri").alias("named"),
        F.min("o_datatype").alias("d0"),
        F.max("o_datatype").alias("d1"),
    )
    terms = by_subject.groupBy("p").agg(F.max("n").alias("n"), F.bool_and("named").alias("named"), F.min("d0").alias("d0"), F.max("d1").alias("d1"))
    terms = terms.withColumn("term", compact_iri(F.col("p"), prefixes))
    shared = terms.groupBy("term").agg(F.count(F.lit(1)).alias("shared"))
    plain = F.col("d0").isin(XSD_STRING, LANG_STRING)
    kind = F.when(F.col("named"), F.lit("@id")).when((F.col("d0") == F.col("d1")) & ~plain, compact_iri(F.col("d0"), prefixes))
    return terms.join(shared, "term").where("shared = 1").select("term", F.col("p").alias("iri"), kind.alias("type"), F.when(F.col("n") >= 2, F.lit("@set")).alias("container"))


def context_document(terms: DataFrame, prefixes: dict[str, str]) -> dict:
    """The context as a document (one entry a predicate: bounded by the vocabulary)."""
    out: dict = dict(prefixes)
    for r in terms.collect():
        out[r.term] = {"@id": r.term} | ({"@type": r.type} if r.type else {}) | ({"@container": "@set"} if r.container else {})
    return {"@context": {k: out[k] for k in sorted(out)}}
