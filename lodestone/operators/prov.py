"""Run provenance: one PROV activity a stage of a run, and a fluent builder of small quad tables."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from urllib.parse import urljoin

from pyspark.sql import DataFrame, SparkSession

from lodestone.functions.iri import LANG_STRING, PREFIXES, RDF_TYPE, XSD, XSD_STRING
from lodestone.operators.project import TERMS

PROV = PREFIXES["prov"]


class GraphBuilder:
    """Collects quads about subjects; names resolve against prefixes and a base."""

    def __init__(self, base: str = "", prefixes: dict[str, str] | None = None):
        self.base, self.prefixes = base, PREFIXES | (prefixes or {})
        self.quads: list[tuple] = []
        self._subject, self._graph, self._blanks = "", None, 0

    def iri(self, name: str) -> str:
        """A CURIE, absolute or relative IRI in full."""
        label, colon, local = name.partition(":")
        if colon and label in self.prefixes and not local.startswith("//"):
            return self.prefixes[label] + local
        return name if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", name) else urljoin(self.base, name) if "://" in self.base else self.base + name

    def subject(self, name: str) -> GraphBuilder:
        """What the next statements are about."""
        self._subject = self.iri(name)
        return self

    def graph(self, name: str | None) -> GraphBuilder:
        """The graph of the next statements."""
        self._graph = None if name is None else self.iri(name)
        return self

    def _put(self, predicate: str, kind: str, value: str, datatype: str | None = None, lang: str | None = None) -> GraphBuilder:
        if not self._subject:
            raise ValueError("name a subject first")
        self.quads.append(("iri", self._subject, self.iri(predicate), kind, value, datatype, lang, self._graph))
        return self

    def a(self, class_name: str) -> GraphBuilder:
        """rdf:type."""
        return self._put(RDF_TYPE, "iri", self.iri(class_name))

    def link(self, predicate: str, target: str) -> GraphBuilder:
        """An IRI object."""
        return self._put(predicate, "iri", self.iri(target))

    def add(self, predicate: str, value, lang: str | None = None) -> GraphBuilder:  # noqa: ANN001
        """A literal with the datatype of its Python value."""
        if lang:
            return self._put(predicate, "literal", str(value), LANG_STRING, lang)
        if isinstance(value, bool):
            return self._put(predicate, "literal", str(value).lower(), XSD + "boolean")
        kind = XSD + "integer" if isinstance(value, int) else XSD + "decimal" if isinstance(value, float) else XSD_STRING
        return self._put(predicate, "literal", str(value), kind)

    def build(self, spark: SparkSession | None = None):  # noqa: ANN201
        """The distinct quads, as tuples or as a table."""
        own = list(dict.fromkeys(self.quads))
        return own if spark is None else spark.createDataFrame(own, ", ".join(f"{t} string" for t in TERMS))


@dataclass
class StageLog:
    """The stages of a run in order: (name, start, end, agent)."""

    run: str
    stages: list[tuple[str, str, str, str]] = field(default_factory=list)

    def add(self, name: str, started: str, ended: str, agent: str = "engine") -> None:
        """One stage with its times (ISO 8601)."""
        self.stages.append((name, started, ended, agent))

    def quads(self, graph: str = "urn:prov:run") -> list[tuple]:
        """Activities with agents, times and what informed them."""
        b, before = GraphBuilder(self.run.rstrip("/") + "/").graph(graph), None
        for name, started, ended, agent in self.stages:
            own = b.iri(f"activity/{name}")
            b.subject(own).a(PROV + "Activity").link(PROV + "wasAssociatedWith", f"agent/{agent}")
            b._put(PROV + "startedAtTime", "literal", started, XSD + "dateTime")
            b._put(PROV + "endedAtTime", "literal", ended, XSD + "dateTime")
            if before:
                b.link(PROV + "wasInformedBy", before)
            b.subject(f"agent/{agent}").a(PROV + "Agent")
            before = own
        return b.build()

    def table(self, spark: SparkSession, graph: str = "urn:prov:run") -> DataFrame:
        """``quads`` as a table."""
        return spark.createDataFrame(self.quads(graph), ", ".join(f"{t} string" for t in TERMS))
