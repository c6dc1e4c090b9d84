"""Run configuration: defaults, validation matrix, prefixes, clamps."""

from __future__ import annotations

import json
import math
import re
from dataclasses import dataclass, field
from pathlib import Path
from urllib.parse import urlsplit

from lodestone.sources.rdf import FORMATS, resolve_format

ROOT_KEYS = frozenset("target targets input output classification enrichment squash plugin schemaPaths vocabulary graphs instances subjectIri provenance ontology".split())
OUTPUT_KEYS = frozenset("path format mode graph canonicalize validate dryRun bucketing catalog provenance encoding jsonldContext".split())


class ConfigError(ValueError):
    """A configuration that is not valid."""


@dataclass
class RunConfig:
    """A validated configuration with its defaults applied."""

    target: str
    input_path: str
    input_format: str = "json"
    output: dict = field(default_factory=dict)
    classification: dict = field(default_factory=dict)
    enrichment: dict = field(default_factory=dict)
    vocabulary: str = "urn:vocab"
    instances: str = "urn:instance"
    graphs: dict = field(default_factory=dict)
    subject_iri: dict | None = None
    prefixes: dict = field(default_factory=dict)
    plugins: list = field(default_factory=list)


def sanitize_target(name: str) -> str:
    """A target's name: lower case, letters, digits and dashes."""
    out = re.sub(r"^-+|-+$", "", re.sub(r"[^a-z0-9-]+", "-", name.lower()))
    if not out:
        raise ConfigError(f"a target needs a name: {name!r}")
    return out


def check_output(out: dict) -> dict:
    """The output block with defaults; raises ConfigError for combinations that exclude each other."""
    if unknown := set(out) - OUTPUT_KEYS:
        raise ConfigError(f"unknown output keys: {sorted(unknown)}")
    done = {"mode": "dataset", "dryRun": False} | out
    if done["mode"] not in ("dataset", "stream"):
        raise ConfigError(f"unknown mode {done['mode']!r}")
    try:
        done["format"] = resolve_format(done.get("path"), done.get("format"))
    except ValueError as e:
        raise ConfigError(str(e)) from e
    rules = [
        (done["mode"] == "stream" and (done.get("canonicalize") or done.get("validate")), "stream mode forbids canonicalize and validate"),
        (done.get("encoding") == "stream" and done.get("canonicalize"), "encoding stream forbids canonicalize"),
        (done.get("encoding") == "stream" and done["format"] == "jsonld", "encoding stream forbids jsonld"),
        (done.get("bucketing") is not None and done.get("graph") is not None, "bucketing forbids graph"),
        (done.get("catalog") is not None and done.get("bucketing") is None, "a catalog needs bucketing"),
        (done.get("jsonldContext") is not None and done["format"] != "jsonld", "jsonldContext needs the format jsonld"),
    ]
    for broken, message in rules:
        if broken:
            raise ConfigError(message)
    return done


def from_document(doc: dict, target: str | None = None) -> RunConfig:
    """A configuration from a document, in its root or per-target form."""
    if unknown := set(doc) - ROOT_KEYS:
        raise ConfigError(f"unknown keys: {sorted(unknown)}")
    own = dict(doc)
    if "targets" in doc:
        if target not in doc["targets"]:
            raise ConfigError(f"no target {target!r}")
        own = {k: v for k, v in doc.items() if k != "targets"} | doc["targets"][target] | {"target": target}
    if "input" not in own or "path" not in own["input"]:
        raise ConfigError("input.path is needed")
    name = sanitize_target(own.get("target") or target or "")
    return RunConfig(
        target=name,
        input_path=own["input"]["path"],
        input_format=own["input"].get("format", "json"),
        output=check_output(own.get("output", {"path": f"{name}.nq"})),
        classification=own.get("classification", {}),
        enrichment=own.get("enrichment", {}),
        vocabulary=own.get("vocabulary", f"urn:vocab:{name}"),
        instances=own.get("instances", f"urn:instance:{name}"),
        graphs=own.get("graphs", {}),
        subject_iri=own.get("subjectIri"),
        prefixes=own.get("ontology", {}).get("prefixes", {}),
        plugins=[own["plugin"]] if isinstance(own.get("plugin"), str) else list(own.get("plugin") or []),
    )


def load(path: str, target: str | None = None) -> RunConfig:
    """A configuration file."""
    try:
        return from_document(json.loads(Path(path).read_text(encoding="utf-8")), target)
    except json.JSONDecodeError as e:
        raise ConfigError(f"{path}: {e}") from e


def host_label(url: str) -> str | None:
    """A prefix for a URL: the longest telling label of its host."""
    host = (urlsplit(url).hostname or "").lower()
    labels = [x for x in host.split(".")[:-1] if x not in ("www", "m", "co", "com", "org", "net", "gov", "ac")]
    return max(labels, key=len) if labels else None


# Host labels that are no name.
COMMON_TLDS = frozenset("com net org io dev app co uk us ca".split())
TRIVIAL_LABELS = frozenset("www m 2e 1e 3e".split())


def host_prefix(host: str) -> str | None:
    """The longest label of a host (the first of equally long ones) that is neither a top-level one, nor trivial, nor of one letter."""
    found = [x for x in host.split(":")[0].split(".") if len(x) > 1 and x not in COMMON_TLDS and x not in TRIVIAL_LABELS]
    return max(found, key=len).lower() if found else None


def is_origin(iri: str) -> bool:
    """Whether a URL is an origin alone: path ``/``, no query, no fragment."""
    parts = urlsplit(iri)
    return bool(parts.scheme and parts.netloc) and parts.path in ("", "/") and not parts.query and not parts.fragment


def resolve_namespaces(target: str, prefixes: dict[str, str] | None = None, sample_url: str | None = None, base_iri: str | None = None) -> dict:
    """The namespaces of instances, graphs and vocabulary as {prefix, base}, and ``source``: the weakest tier that was used.

    Tiers: configured prefixes (an origin names the instances; ``<target>g`` or a base with ``/graph/`` the graphs;
    ``base_iri``, else the first base that ends with ``#``, the vocabulary); derived from a record's URL
    (instances only); else the fallback.
    """
    slug, tiers = sanitize_target(target), []
    by_base = {base: label for label, base in (prefixes or {}).items() if base}

    def pick(found: tuple[str, str, str]) -> dict:
        tiers.append(found[2])
        return {"prefix": found[0], "base": found[1]}

    origin = next(((label, base, "config") for base, label in by_base.items() if is_origin(base)), None)
    if origin is None and sample_url and sample_url.startswith(("http://", "https://")):
        parts = urlsplit(sample_url)
        if (label := host_prefix(parts.netloc)) is not None:
            origin = (label, f"{parts.scheme}://{parts.netloc}/", "derived")
    graph = next(((label, base, "config") for base, label in by_base.items() if label == f"{slug}g" or "/graph/" in base), None)
    if base_iri:
        segments = [x for x in urlsplit(base_iri).path.split("/") if x]
        words = (segments[-1].lower() if segments else slug, base_iri, "config")
    else:
        words = next(((by_base[base], base, "config") for base in sorted(by_base) if base.endswith("#")), None)
    out = {
        "instances": pick(origin or (slug, f"urn:instance:{slug}/", "fallback")),
        "graphs": pick(graph or (f"{slug}g", f"urn:graph:{slug}/", "fallback")),
        "vocabulary": pick(words or (slug, f"urn:vocabulary:{slug}#", "fallback")),
    }
    return out | {"source": next((t for t in ("fallback", "derived") if t in tiers), "config")}


def resolve_prefixes(configured: dict[str, str], bases: dict[str, str], fallback: str = "ns") -> dict[str, str]:
    """label to base: configured ones first, then by host, then numbered fallbacks."""
    out = dict(configured)
    for name, base in bases.items():
        if base in out.values():
            continue
        label = host_label(base) or name or fallback
        own, n = label, 2
        while own in out:
            own, n = f"{label}{n}", n + 1
        out[own] = base
    return out


def clamp(value: float, low: float, high: float) -> float:
    """The value within bounds; what is no finite number becomes the lower one."""
    return min(high, max(low, value)) if isinstance(value, (int, float)) and math.isfinite(value) else low


# Bounds of numeric settings, and why.
CLAMPS = {
    "rateLimitMs": (0, 60_000, "minimum gap between requests (0: none)"),
    "jitterMs": (0, 10_000, "random jitter a request"),
    "batchSize": (1, 50, "titles in one request of a wiki's interface"),
    "maxRetries": (0, 20, "attempts after a failure"),
    "retryBaseDelayMs": (50, 30_000, "first delay before another attempt"),
    "retryMaxDelayMs": (100, 300_000, "longest delay before another attempt"),
    "maxPages": (1, 10_000_000, "pages of a run"),
    "concurrency": (1, 32, "runs at the same time"),
}


def clamp_config(settings: dict, name: str = "config") -> tuple[dict, list[str]]:
    """The settings with their numbers within bounds, and a warning for each that was not; other values stay."""
    out, warnings = dict(settings), []
    for key, (low, high, reason) in CLAMPS.items():
        raw = settings.get(key)
        if isinstance(raw, bool) or not isinstance(raw, (int, float)):
            continue
        out[key] = clamp(raw, low, high)
        if out[key] != raw:
            warnings.append(f"{name}.{key}: {raw} -> {out[key]} ({reason}, {low} to {high})")
    return out, warnings


def topological(dependencies: dict[str, list[str]]) -> list[str]:
    """Names with what they need before them; a cycle keeps the given order."""
    done, out, names = set(), [], list(dependencies)
    while len(out) < len(names):
        ready = [n for n in names if n not in done and all(d in done or d not in dependencies for d in dependencies[n])]
        if not ready:
            return names
        out += ready
        done |= set(ready)
    return out


def media_type(fmt: str) -> str:
    """The media type of a format."""
    return FORMATS[fmt][1]
