"""Schema refinement: fifteen clauses applied to a draft in a fixed order.

References that do not resolve give warnings, never errors; the draft is not changed; keys are sorted.
"""

from __future__ import annotations

import copy
import json
from dataclasses import dataclass
from pathlib import Path

from lodestone.errors import LodestoneError
from lodestone.functions.pointer import PointerError, segments
from lodestone.plans.induce import HINT, sort_keys


@dataclass(frozen=True)
class Warning:  # noqa: A001
    """Something in a refinement that did not resolve."""

    code: str
    pointer: str
    message: str


class _Draft:
    def __init__(self, draft: dict):
        self.doc = copy.deepcopy(draft)
        self.properties: dict = self.doc.setdefault("properties", {}) or {}
        self.doc["properties"] = self.properties
        self.required: list = self.doc.get("required", [])
        self.warnings: list[Warning] = []

    def key(self, pointer: str, code: str) -> str | None:
        """The property that a pointer (or plain name) means, or a warning."""
        try:
            parts = segments(pointer if pointer.startswith("/") else f"/{pointer}")
        except PointerError:
            parts = []
        if parts[:1] == ["properties"] and len(parts) == 2:
            parts = parts[1:]
        if len(parts) == 1 and parts[0] in self.properties:
            return parts[0]
        self.warnings.append(Warning(code, pointer, f"{pointer!r} is no property of the draft"))
        return None


def _drop(d: _Draft, spec: list[str]) -> None:
    for pointer in spec:
        if (k := d.key(pointer, "DROP_UNRESOLVED")) is not None:
            del d.properties[k]
            if k in d.required:
                d.required.remove(k)


def _rename(d: _Draft, spec: dict[str, str]) -> None:
    for pointer, name in spec.items():
        k = d.key(pointer, "RENAME_UNRESOLVED")
        if k is not None and k != name:
            d.properties[name] = d.properties.pop(k)
            d.required[:] = [name if r == k else r for r in d.required]


def _closed_enum(d: _Draft, spec: list[str]) -> None:
    for name in spec:
        if (k := d.key(name, "CLOSED_ENUM_UNRESOLVED")) is None:
            continue
        prop = d.properties[k]
        prop[HINT + "closed-enum"] = True
        if "enum" not in prop:
            values = prop.get(HINT + "distinct-values", prop.get("examples"))
            if values:
                prop["enum"] = sorted(values)
            else:
                d.warnings.append(Warning("CLOSED_ENUM_NO_VALUES", name, f"{name!r} has no values to enumerate"))


def _open_vocabulary(d: _Draft, spec: list[str]) -> None:
    for name in spec:
        if (k := d.key(name, "OPEN_VOCAB_UNRESOLVED")) is not None:
            d.properties[k][HINT + "open-vocab"] = True
            d.properties[k].pop("enum", None)


def _promote_iri(d: _Draft, spec: list[str]) -> None:
    for pointer in spec:
        if (k := d.key(pointer, "PROMOTE_IRI_UNRESOLVED")) is not None:
            d.properties[k] |= {HINT + "iri-promotion": True, "format": "iri"}


def _by_property(hint: str, code: str):  # noqa: ANN202
    def apply(d: _Draft, spec: dict) -> None:
        for name, value in spec.items():
            if (k := d.key(name, code)) is not None:
                d.properties[k][HINT + hint] = value

    return apply


def _on_schema(hint: str):  # noqa: ANN202
    def apply(d: _Draft, spec) -> None:  # noqa: ANN001
        d.doc[HINT + hint] = spec

    return apply


def _parents(d: _Draft, spec: list[str]) -> None:
    every = d.doc.setdefault("allOf", [])
    for parent in spec:
        ref = {"$ref": parent}
        if ref not in every:
            every.append(ref)
    if not every:
        del d.doc["allOf"]


CLAUSES = [
    ("drop", _drop),
    ("rename", _rename),
    ("closedEnum", _closed_enum),
    ("openVocabulary", _open_vocabulary),
    ("promoteIri", _promote_iri),
    ("range", _by_property("range", "RANGE_UNRESOLVED")),
    ("rdfsLabel", _by_property("rdfs-label", "RDFS_LABEL_UNRESOLVED")),
    ("rdfsComment", _by_property("rdfs-comment", "RDFS_COMMENT_UNRESOLVED")),
    ("subjectIriPolicy", _on_schema("subject-iri")),
    ("arrayEnumIri", _by_property("array-enum-iri", "ARRAY_ENUM_IRI_UNRESOLVED")),
    ("skolemSubject", _by_property("skolem-subject", "SKOLEM_SUBJECT_UNRESOLVED")),
    ("provenanceIri", _on_schema("provenance-iri")),
    ("predicateOverride", _by_property("predicate-override", "PREDICATE_OVERRIDE_UNRESOLVED")),
    ("inverseOf", _on_schema("inverse-of")),
    ("parents", _parents),
]


def refine(draft: dict, spec: dict | None) -> tuple[dict, list[Warning]]:
    """The final schema and warnings; without a refinement the draft passes through."""
    if spec is None:
        return sort_keys(copy.deepcopy(draft)), []
    unknown = set(spec) - {name for name, _ in CLAUSES} - {"$schema", "class", "target"}
    if unknown:
        raise ValueError(f"unknown refinement clauses: {sorted(unknown)}")
    d = _Draft(draft)
    for name, apply in CLAUSES:
        if spec.get(name) is not None:
            apply(d, spec[name])
    if "required" in d.doc and not d.required:
        del d.doc["required"]
    return sort_keys(d.doc), d.warnings


def refine_all(drafts: dict[str, dict], specs: dict[str, dict]) -> tuple[dict[str, dict], dict[str, list[Warning]], dict[str, int]]:
    """Every draft with its refinement by class name: finals, warnings, and tallies."""
    finals, warnings, tally = {}, {}, {"refined": 0, "passthrough": 0, "errors": 0}
    for name, draft in drafts.items():
        try:
            finals[name], warnings[name] = refine(draft, specs.get(name))
            tally["refined" if name in specs else "passthrough"] += 1
        except ValueError as e:
            warnings[name] = [Warning("APPLY_REFINEMENT_ERROR", "", str(e))]
            tally["errors"] += 1
    return finals, warnings, tally


# Files.

DRAFT, REFINEMENT = ".draft.json", ".refine.json"


class RefineError(LodestoneError):
    """A draft or refinement file that cannot be used; ``stage`` tells which step failed and how."""

    def __init__(self, stage: str, message: str):
        super().__init__(message, {"stage": stage})
        self.stage = stage

    @property
    def code(self) -> str:
        """READ_DRAFT_IO, READ_DRAFT_PARSE, READ_DRAFT_NOT_OBJECT, the same of READ_REFINEMENT and its _INVALID, or APPLY_REFINEMENT_NULL_INPUT."""
        return self.stage


@dataclass(frozen=True)
class DraftFile:
    """A draft's file, the name of its class, and the file of its refinement if there is one."""

    path: str
    name: str
    refinement: str | None = None
    subfolder: str | None = None


def walk_drafts(inferred: str, refinements: str) -> list[DraftFile]:
    """The draft files of a folder and of its ``primitives`` and ``objects``, by path; those have no refinements."""
    found = []
    for sub in (None, "primitives", "objects"):
        folder = Path(inferred) / sub if sub else Path(inferred)
        for p in sorted(folder.glob(f"*{DRAFT}")) if folder.is_dir() else []:
            name = p.name.removesuffix(DRAFT)
            own = Path(refinements) / f"{name}{REFINEMENT}"
            found.append(DraftFile(str(p), name, str(own) if sub is None and own.is_file() else None, sub))
    return sorted(found, key=lambda d: d.path)


def read_object(path: str, step: str) -> dict:
    """The JSON object of a file, or a RefineError of the step."""
    try:
        text = Path(path).read_text(encoding="utf-8")
    except OSError as e:
        raise RefineError(f"{step}_IO", str(e)) from e
    try:
        found = json.loads(text)
    except ValueError as e:
        raise RefineError(f"{step}_PARSE", str(e)) from e
    if not isinstance(found, dict):
        raise RefineError(f"{step}_NOT_OBJECT", f"{path} is no JSON object")
    return found


def apply_refinement(draft: dict | None, spec: dict | None) -> tuple[dict, list[Warning]]:
    """``refine`` of what was read; either missing is an error of its own."""
    if draft is None or spec is None:
        raise RefineError("APPLY_REFINEMENT_NULL_INPUT", "a draft and a refinement are needed")
    try:
        return refine(draft, spec)
    except ValueError as e:
        raise RefineError("READ_REFINEMENT_INVALID", str(e)) from e


def refine_one(draft: DraftFile) -> tuple[dict, list[Warning]]:
    """A draft file with its refinement applied; without one the draft passes through, with a warning."""
    found = read_object(draft.path, "READ_DRAFT")
    if draft.refinement is None:
        return sort_keys(found), [Warning("REFINEMENT_MISSING", draft.path, f"no refinement for {draft.name!r}")]
    return apply_refinement(found, read_object(draft.refinement, "READ_REFINEMENT"))


def refine_folder(inferred: str, refinements: str) -> tuple[dict[str, dict], dict[str, list[Warning]], dict[str, int], dict[str, RefineError]]:
    """Every draft of a folder: finals, warnings, tallies and the errors by name."""
    finals, warnings, errors, tally = {}, {}, {}, {"refined": 0, "passthrough": 0, "errors": 0}
    for draft in walk_drafts(inferred, refinements):
        try:
            finals[draft.name], warnings[draft.name] = refine_one(draft)
            tally["passthrough" if draft.refinement is None else "refined"] += 1
        except RefineError as e:
            errors[draft.name] = e
            tally["errors"] += 1
    return finals, warnings, tally, errors
