"""The build: records to classified, projected, enriched and written quads; and the bootstrap around it."""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.iri import subject_iri
from lodestone.operators import project, reconcile, runstats
from lodestone.operators.ontology import Ontology
from lodestone.operators.prov import StageLog
from lodestone.operators.shapes import shape_cache
from lodestone.plans.config import RunConfig, resolve_namespaces
from lodestone.plans.induce import induced_set, to_text
from lodestone.plans.plugins import Registry
from lodestone.plans.refine import refine_all
from lodestone.sources import records as sources
from lodestone.sources import sinks


@dataclass
class Build:
    """The tables of a run; nothing has been computed until one is used."""

    classified: DataFrame
    projected: DataFrame
    quads: DataFrame
    quarantine: DataFrame
    summary: DataFrame


def build(records: DataFrame, config: RunConfig, classes: dict[str, dict], run_start: str = "1970-01-01T00:00:00Z", closure: DataFrame | None = None, index: DataFrame | None = None, links: dict | None = None, registry: Registry | None = None) -> Build:
    """All per-record stages as one lazy plan.

    ``classes``: what ``project`` takes; ``closure``: (sub, sup) class IRIs for inheritance; ``index`` with
    ``links`` ({predicates, href}): the entity index for link collapse; ``registry``: plugins, whose classes
    come under the given ones.
    """
    registry = registry or plugins_of(config)
    classes = registry.merged("classes", classes)
    classified = registry.classify(sources.good(records), config.classification)
    c = F.col("classification")
    subject = subject_iri(F.col("rec"), F.col("record_path"), F.col("record_line"), config.instances, config.subject_iri)
    projected = project.project(classified, classes, config.vocabulary, subject, c["type"], config.graphs)
    own, e = F.col("quads"), registry.merged("enrichment", config.enrichment)
    if e.get("arrayEnumIri"):
        own = F.concat(own, project.array_enum(F.col("rec"), F.col("subject"), config.vocabulary, e["arrayEnumIri"]))
    if e.get("skolemSubject"):
        own = F.concat(own, project.skolem(F.col("rec"), F.col("subject"), config.vocabulary, e["skolemSubject"]))
    if e.get("provenanceIri"):
        own = F.concat(own, project.provenance_iri(F.col("rec"), F.col("subject"), e["provenanceIri"]["from"], e["provenanceIri"]["predicate"]))
    if e.get("provenance"):
        own = F.concat(own, project.record_provenance(config.instances, F.col("subject"), c, run_start, "urn:prov:records"))
    bucket = F.when(c["bucket"].isNotNull(), c["bucket"]).when(F.col("projection_error").isNotNull(), F.lit("projection"))
    projected = projected.withColumn("bucket", bucket).withColumn("quads", F.when(F.col("bucket").isNull(), own).otherwise(F.array().cast(f"array<{project.QUAD}>")))
    quads = project.exploded(projected)
    if e.get("predicateOverride"):
        quads = project.override_predicates(quads, e["predicateOverride"])
    if e.get("inverseOf"):
        quads = project.with_inverses(quads, e["inverseOf"], config.vocabulary)
    if closure is not None:
        quads = project.inherited_types(quads, closure)
    if index is not None and links:
        quads = reconcile.collapse_links(quads, index, links["predicates"], links["href"])
    error = F.coalesce("projection_error", F.when(c["bucket"].isNotNull(), F.concat(F.lit("tie: "), F.array_join(c["candidates"], ", "))))
    unread = sources.bad(records).withColumns({"bucket": F.lit("projection"), "_error": F.col("error_code")})
    rejected = projected.where("bucket IS NOT NULL").withColumn("_error", error)
    columns = ["record_path", "record_line", "target", "rec", "bucket", "_error"]
    quarantine = sinks.quarantine_rows(rejected.select(*columns).unionAll(unread.select(*columns)), F.col("bucket"), F.col("_error"), "build", run_start)
    done = projected.select("rid", "record_path", "record_line", "bucket", c["type"].alias("class_name"), F.size("quads").alias("n"), error.alias("error"))
    lost = unread.select("rid", "record_path", "record_line", "bucket", F.lit(None).cast("string").alias("class_name"), F.lit(0).alias("n"), F.col("error_code").alias("error"))
    summary = runstats.summaries(done.unionByName(lost), F.col("n"), F.col("bucket"), F.col("class_name"), F.col("error"))
    return Build(classified, projected, quads, quarantine, summary)


def plugins_of(config: RunConfig) -> Registry:
    """The plugins that a configuration names."""
    registry = Registry()
    for address in config.plugins:
        registry.load(address)
    return registry


def entity_index(spark: SparkSession, config: RunConfig, registry: Registry | None = None) -> tuple[DataFrame | None, dict | None]:
    """The index of link tails and what ``build`` needs of ``enrichment.entityLink``; a scan of its own, of the input's format strictly.

    Records that cannot be read are passed over; of several records with one tail the last by place wins.
    """
    link = (registry or plugins_of(config)).merged("enrichment", config.enrichment).get("entityLink")
    if not link:
        return None, None
    records = sources.good(sources.read_json_tree(spark, config.input_path, config.target, (config.input_format,)))
    subject = subject_iri(F.col("rec"), F.col("record_path"), F.col("record_line"), config.instances, config.subject_iri)
    index = reconcile.entity_index(records.select(subject.alias("subject"), "record_path", "record_line"), link["canonicalBase"], order=["record_path", "record_line"])
    return index, {"predicates": list(link["linkPredicates"]), "href": link["hrefPredicate"]}


def prefixes_of(config: RunConfig, sample_url: str | None = None) -> dict[str, str]:
    """The prefixes of the run's output: the configured ones, and those of instances, graphs and vocabulary."""
    found = resolve_namespaces(config.target, config.prefixes, sample_url)
    return {found[k]["prefix"]: found[k]["base"] for k in ("instances", "graphs", "vocabulary") if found["source"] != "fallback" or config.prefixes} | config.prefixes


def run(spark: SparkSession, config: RunConfig, classes: dict[str, dict], ontology: Ontology | None = None, dry_run: bool = False, run_start: str | None = None) -> tuple[sinks.OutputReport, dict]:
    """Reads, builds and writes; returns the report and the fold by outcome.

    Every output option of the configuration takes effect. The stages are logged as PROV activities into the
    provenance sidecar, with times from ``run_start`` on if it is given (so that a run can be repeated byte by
    byte), else the clock's. An ontology that cannot be emitted is a warning in the report, ONTOLOGY_EMIT_ERROR.
    """
    now = lambda: run_start or datetime.now(timezone.utc).isoformat(timespec="milliseconds").replace("+00:00", "Z")
    log, began, warnings, out = StageLog(f"{config.instances}/run"), now(), [], config.output
    registry = plugins_of(config)

    def stage(name: str) -> None:
        nonlocal began
        ended = now()
        log.add(name, began, ended)
        began = ended

    records = sources.read_json_tree(spark, config.input_path, config.target)
    stage("walk-input")
    index, links = entity_index(spark, config, registry)
    stage("index-entities")
    made = build(records, config, classes, run_start or "1970-01-01T00:00:00Z", ontology.subclass_table(spark) if ontology else None, index, links, registry)
    quads = made.quads.drop("rid")
    stage("process-all-records")
    if ontology is not None:
        try:
            quads = quads.unionByName(ontology.tbox_quads(spark, f"urn:graph:{config.target}/ontology"))
        except (KeyError, TypeError, ValueError, AttributeError) as e:
            warnings.append(f"ONTOLOGY_EMIT_ERROR: {type(e).__name__}: {e}")
    stage("ontology-emit")
    if out.get("provenance"):
        quads = quads.unionByName(log.table(spark))
    report = sinks.finalize(
        quads, out["path"], out["format"], config.target, prefixes=prefixes_of(config), graph=out.get("graph"), bucketing=_bucketing(out.get("bucketing")), dry_run=dry_run or out["dryRun"],
        canonicalize=bool(out.get("canonicalize")), validate=out.get("validate"), jsonld_context=out.get("jsonldContext"), catalog=(out.get("catalog") or {}).get("path"),
    )
    report.errors += warnings
    if dry_run or out["dryRun"]:
        return report, {}
    sinks.write_quarantine(made.quarantine, out["path"] + ".quarantine")
    return report, {r.outcome: (r.records, r.quads) for r in runstats.fold(made.summary).collect()}


def _bucketing(block: dict | None) -> dict | None:
    """The arguments of a configured bucketing; a block that is not enabled is none."""
    if block is None or block.get("enabled") is False:
        return None
    told = {"strategy": block.get("strategy", "per-graph-iri"), "buckets": block.get("buckets"), "on_unmapped": block.get("onUnmapped", "other")}
    return {k: v for k, v in told.items() if v is not None}


def bootstrap(spark: SparkSession, config: RunConfig, folder: str, specs: dict[str, dict] | None = None) -> dict:
    """Induces drafts, stops at the first gate that is not met, refines, builds.

    Drafts go to ``inferred``, what they share to its ``primitives`` and ``objects``. Without a refinement (given or
    ``<Class>.refine.json`` in ``folder``) it halts after induction; without a final schema before the build.
    """
    records = sources.read_json_tree(spark, config.input_path, config.target)
    typed = plugins_of(config).classify(sources.good(records), config.classification).withColumn("class_name", F.col("classification.type"))
    observed = [r.asDict() for r in shape_cache(typed.where("class_name IS NOT NULL")).collect()]  # a row a property
    found = induced_set(observed, config.vocabulary + "/")
    drafts, extracted = found["classes"], found["primitives"] | found["objects"]
    for sub, schemas in (("", drafts), ("primitives/", found["primitives"]), ("objects/", found["objects"])):
        for name, draft in schemas.items():
            sinks.atomic_write(f"{folder}/inferred/{sub}{name}.draft.json", to_text(draft))
    specs = dict(specs or {})
    for p in sorted(Path(folder).glob("*.refine.json")):
        specs.setdefault(p.name.removesuffix(".refine.json"), json.loads(p.read_text(encoding="utf-8")))
    if not specs:
        return {"halted": "refine-required", "drafts": sorted(drafts)}
    finals, warnings, tally = refine_all(drafts, specs)
    for name, schema in finals.items():
        sinks.atomic_write(f"{folder}/{name}.schema.json", to_text(schema | {"$id": f"{config.vocabulary}/{name}"}))
    if not finals:
        return {"halted": "build-ready", "tally": tally}
    ontology = Ontology(finals, config.vocabulary, extracted)
    classes = {name: {"properties": ontology.properties(name)} for name in finals}
    report, fold = run(spark, config, classes, ontology)
    return {"report": report, "fold": fold, "tally": tally, "warnings": warnings}
