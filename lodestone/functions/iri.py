"""IRIs, CURIEs, slugs and names as Columns."""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import urljoin, urlsplit, urlunsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.functions.pointer import string_at

# Common prefixes and datatypes.
PREFIXES = {
    "dct": "http://purl.org/dc/terms/",
    "owl": "http://www.w3.org/2002/07/owl#",
    "prov": "http://www.w3.org/ns/prov#",
    "rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#",
    "rdfs": "http://www.w3.org/2000/01/rdf-schema#",
    "schema": "https://schema.org/",
    "sh": "http://www.w3.org/ns/shacl#",
    "skos": "http://www.w3.org/2004/02/skos/core#",
    "xsd": "http://www.w3.org/2001/XMLSchema#",
}
RDF_TYPE = PREFIXES["rdf"] + "type"
XSD = PREFIXES["xsd"]
XSD_STRING = XSD + "string"
LANG_STRING = PREFIXES["rdf"] + "langString"


def slug(text: Column) -> Column:
    """Lower case, runs of anything but a-z and 0-9 to one dash, no dash at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def pascal_case(text: Column, separators: str = "[-_\\s]+") -> Column:
    """Parts between separators with a capital first letter, joined; other letters stay."""
    parts = F.filter(F.split(text, separators), lambda p: p != "")
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), p.substr(F.lit(2), F.length(p)))), "")


def segment(text: Column) -> Column:
    """Runs of anything but letters and digits to one dash (dashes at the ends stay)."""
    return F.regexp_replace(text, "[^A-Za-z0-9]+", "-")


def local_name(iri: Column) -> Column:
    """What follows the last ``#``, else the last ``/``."""
    after_hash = F.regexp_extract(iri, "#([^#]*)$", 1)
    return F.when(iri.contains("#"), after_hash).otherwise(F.regexp_extract(iri, "([^/]*)$", 1))


def is_absolute(iri: Column) -> Column:
    """Whether the IRI has a scheme."""
    return iri.rlike("^[A-Za-z][A-Za-z0-9+.-]*:")


def join_base(base: str, tail: Column) -> Column:
    """The tail under the base; absolute http(s) IRIs stay."""
    root = base if base.endswith("/") else base + "/"
    return F.when(tail.rlike("^https?://"), tail).otherwise(F.concat(F.lit(root), F.regexp_replace(tail, "^/", "")))


# Ports that a scheme implies.
PORTS = {"http": 80, "https": 443, "ws": 80, "wss": 443, "ftp": 21}


def normalized(iri: str) -> str:
    """An absolute IRI in normal form: scheme and host in lower case, no implied port, no dot segments, a path after a host."""
    parts = urlsplit(iri)
    if not re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", iri):
        raise ValueError(f"no absolute IRI: {iri!r}")
    if not parts.netloc:
        return f"{parts.scheme.lower()}:{iri.split(':', 1)[1]}"
    host = (parts.hostname or "").lower() + ("" if parts.port in (None, PORTS.get(parts.scheme)) else f":{parts.port}")
    user = parts.netloc.rpartition("@")[0]
    path = urlsplit(urljoin("http://x/", "http://x" + parts.path)).path if parts.path else "/"
    kept = []
    for segment in path.split("/")[1:]:
        if segment == "..":
            kept = kept[:-1]
        elif segment != ".":
            kept.append(segment)
    if path.rsplit("/", 1)[-1] in (".", ".."):
        kept.append("")
    return urlunsplit((parts.scheme.lower(), f"{user}@{host}" if user else host, "/" + "/".join(kept), parts.query, parts.fragment))


def resolved(base: str, ref: str) -> str:
    """A reference against a base, in normal form."""
    if not re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", base):
        raise ValueError(f"cannot resolve {ref!r} against {base!r}")
    return normalized(urljoin(base, ref))


def _or_null(make):  # noqa: ANN001, ANN202
    def told(value: str | None) -> str | None:
        try:
            return None if value is None else make(value)
        except ValueError:
            return None

    return told


def normalized_column(iri: Column) -> Column:
    """``normalized`` of each IRI, NULL for what is no absolute one."""
    return F.pandas_udf(lambda batch: pd.Series([_or_null(normalized)(v) for v in batch], dtype=object), "string")(iri)


def resolved_column(base: str, ref: Column) -> Column:
    """``resolved`` of each reference."""
    return F.pandas_udf(lambda batch: pd.Series([_or_null(lambda r: resolved(base, r))(v) for v in batch], dtype=object), "string")(ref)


def namespace(base: str):  # noqa: ANN201
    """A function from local names to IRIs; the base must end with ``/`` or ``#``."""
    if base[-1:] not in ("/", "#"):
        raise ValueError(f"a namespace ends with '/' or '#': {base!r}")
    return lambda name: base + name


def implicit_label(iri: Column, prefixes: dict[str, str]) -> Column:
    """A label from an IRI alone: what follows the prefix, without a short leading ``xxx-``."""
    compacted = compact_iri(iri, prefixes)
    local = F.when(compacted.contains(":"), F.regexp_extract(compacted, "^[^:]*:(.*)$", 1)).otherwise(compacted)
    dash = F.instr(local, "-") - 1
    return F.when((dash > 0) & (dash < 20), local.substr(dash + 2, F.length(local))).otherwise(local)


def vocab(base: str, name: Column | str) -> Column:
    """``<base>#name``."""
    return F.concat(F.lit(base.rstrip("#/") + "#"), F.lit(name) if isinstance(name, str) else name)


def expand_curie(curie: Column, prefixes: dict[str, str] | None = None) -> Column:
    """The CURIE in full; anything without a known prefix stays."""
    out = curie
    for label, base in (prefixes or PREFIXES).items():
        out = F.when(curie.startswith(f"{label}:"), F.concat(F.lit(base), curie.substr(F.lit(len(label) + 2), F.length(curie)))).otherwise(out)
    return out


def compact_iri(iri: Column, prefixes: dict[str, str]) -> Column:
    """The CURIE by the longest base that the IRI extends; otherwise the IRI."""
    out = iri
    for label, base in sorted(prefixes.items(), key=lambda p: (len(p[1]), p[0])):
        out = F.when(iri.startswith(base), F.when(iri == F.lit(base), iri).otherwise(F.concat(F.lit(f"{label}:"), iri.substr(F.lit(len(base) + 1), F.length(iri))))).otherwise(out)
    return out


def sanitize_iri(iri: Column) -> Column:
    """Characters that an IRI may not hold, percent-encoded."""
    forbidden = [chr(i) for i in range(0x21)] + list('<>"{}|^`\\')
    return F.when(iri.rlike('[\\x00-\\x20<>"{}|^`\\\\]'), reduce(lambda c, ch: F.replace(c, F.lit(ch), F.lit(f"%{ord(ch):02X}")), forbidden, iri)).otherwise(iri)


def url_tail(url: Column) -> Column:
    """Path and query of an absolute URL; other texts stay."""
    bare = F.regexp_replace(url, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+([^?#]*)(\\?[^#]+)?.*$", "\u0001$1$2")
    return F.regexp_replace(F.regexp_replace(bare, "^\u0001(?=\\?|$)", "/"), "^\u0001", "")


def url_host_path(url: Column) -> Column:
    """Host and path of an absolute URL; other texts stay."""
    parsed = "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]+)([^?#]*)"
    host, path = F.regexp_extract(url, parsed, 1), F.regexp_extract(url, parsed, 2)
    return F.when(host == "", url).otherwise(F.concat(F.lower(host), F.when(path == "", F.lit("/")).otherwise(path)))


SANITIZERS = {"url-tail": url_tail, "url-host-path": url_host_path, "slug": slug, "verbatim": lambda c: c}


def subject_iri(record: Column, path: Column, line: Column, run_base: str, policy: dict | None = None) -> Column:
    """A record's subject by policy ``{from, sanitize, fallback?}``, else by the hash of its place."""
    root = run_base if run_base.endswith("/") else run_base + "/"
    by_hash = F.concat(F.lit(f"{root}record/"), F.substring(F.sha1(F.concat_ws(":", path, line.cast("string")).cast("binary")), 1, 8))
    if policy is None:
        return by_hash
    found = F.nullif(string_at(record, policy["from"]), F.lit(""))
    if policy.get("fallback"):
        found = F.coalesce(found, F.nullif(string_at(record, policy["fallback"]), F.lit("")))
    return F.when(found.isNull(), by_hash).otherwise(join_base(run_base, SANITIZERS[policy["sanitize"]](found)))
